"""One query per operator: (spark, sf_dir) -> DataFrame over the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, warc
from .bpe import encoded
from .decontaminate import contaminated
from .fingerprints import edited_likeness
from .html_text import extracted
from .jaccard import jaccard_components
from .secrets import as_text, base_only, count_of, found_secrets
from .sharding import placed
from .tables import materialize, table
from .token_alignment import alignment
from .toxicity import fit_machine, held_out, scored
from .url_rules import LINK_HOST, LOWER, RULES, UPPER, Walk, judged
from .vector_codes import compressed

#: Names of the shards that op1 places documents in.
SHARDS = [f"shard-{k:03d}" for k in range(64)]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_shard_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return placed(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), SHARDS)


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


def op3_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = encoded(table(spark, sf_dir, "documents"), tokenizer_path())
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundles = materialize(warc.archived(table(spark, sf_dir, "pages")), "warc")
    return warc.read_back(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scored(docs, fit_machine(docs, table(spark, sf_dir, "labels")))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_secret_lexer(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("spans")
    return found_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        count_of(s, "assign").alias("n_assign"),
        count_of(s, "access").alias("n_access"),
        count_of(s, "hex").alias("n_hex"),
        F.sha2(as_text(base_only(s)), 256).alias("base_sha256"),
        as_text(s).alias("spans"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit("\\### Assistant: </turn> ok")
    turn = F.col("id")
    role = F.when(turn == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), turn.alias("turn"), role.alias("role"), said.alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    return chat.read_back(chat.format_turns(rows))


def op9_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(table(spark, sf_dir, "embeddings"))


def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    "op1_shard_table": op1_shard_table,
    "op2_html_main_text": op2_html_main_text,
    "op3_bpe_chunks": op3_bpe_chunks,
    "op4_warc_bundles": op4_warc_bundles,
    "op5_toxicity_fm": op5_toxicity_fm,
    "op6_secret_lexer": op6_secret_lexer,
    "op7_decontaminate": op7_decontaminate,
    "op8_chat_round_trip": op8_chat_round_trip,
    "op9_bottom_k": op9_bottom_k,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_vector_codes": op11_vector_codes,
    "op12_url_rules": op12_url_rules,
    "op13_token_alignment": op13_token_alignment,
}

_EITHER_CASE = [*("".join(f"[{c}{c.upper()}]" for c in w) for w in ("password", "passwd", "secret", "token")), "[aA][pP][iI]_?[kK][eE][yY]"]
_ASSIGN_SQL = f"(?:{'|'.join(_EITHER_CASE)})[\"'']? *[:=] *[\"'']?([A-Za-z0-9+/_.=-]+)"
#: Patterns in the order of their kinds, and SQL for the length that counts; places come from the pieces between.
_SECRET_SQL = "\nUNION ALL ".join(
    f"SELECT doc_id, {k} AS o, '{kind}' AS kind, {least} AS least, '{counted}' AS counted, regexp_extract_all(t, '{pattern}') AS x, string_split_regex(t, '{pattern}') AS s FROM d"
    for k, (kind, pattern, least, counted) in enumerate((("assign", _ASSIGN_SQL, 12, "value"), ("access", "AKIA[A-Z0-9]+", 18, "all"), ("hex", "[0-9a-f]+", 16, "all")))
)



def _vector_code_sql(rounds: int = 2) -> str:
    """Codebooks by rounds: nearest entry of each part, then floor of the mean; floor division of signed sums by hand."""
    steps = """
        WITH v AS (SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (SELECT vec_id, label, part, e[part * (len(e) // 16) + 1 : (part + 1) * (len(e) // 16)] AS x FROM v, range(16) AS r(part)),
        b0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p WHERE vec_id IN (SELECT vec_id FROM v ORDER BY 1 LIMIT 64))"""
    for k in range(rounds + 1):
        steps += f""",
        a{k} AS MATERIALIZED (SELECT vec_id, label, part, x, arg_min(entry, d * 64 + entry) AS entry, min(d) AS d FROM (
            SELECT p.*, entry, list_sum([CAST((i[1] - i[2]) * (i[1] - i[2]) AS BIGINT) FOR i IN list_zip(x, c)]) AS d FROM p JOIN b{k} USING (part)) GROUP BY ALL)"""
        if k < rounds:
            steps += f""",
        m{k} AS (SELECT part, entry, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS c FROM (
            SELECT part, entry, i, CAST(sum(x[i]) AS BIGINT) AS s, count(*) AS n FROM a{k}, range(1, len(x) + 1) AS r(i) GROUP BY ALL)),
        n{k} AS (SELECT part, entry, list(c ORDER BY i) AS c FROM m{k} GROUP BY ALL),
        b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(n{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN n{k} USING (part, entry))"""
    return steps + f""",
        f AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY ALL)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
        FROM f
    """


def _url_rule_sql(walk: Walk = Walk()) -> str:
    """Rules by a join with their table; each step of the walk is one aggregate."""
    link = LINK_HOST.replace("'", "''")
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)
    steps = f"""
        WITH rules(verdict, rhost, rpath) AS (VALUES {rules}),
        p AS (SELECT page_id, html, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
              regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        q AS (SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, html FROM p),
        k AS (SELECT page_id, host, path, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(verdict, length(rhost || rpath)) AS said
              FROM q LEFT JOIN rules ON ('.' || host) LIKE ('%.' || rhost) AND starts_with(path, rpath) GROUP BY page_id, host, path),
        hosts AS (SELECT host, count(*) FILTER (said = 'allow') AS allowed, count(*) FILTER (said = 'block') AS blocked FROM k WHERE host <> '' GROUP BY 1),
        l AS (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{UPPER}', '{LOWER}') AS dst FROM q WHERE host <> ''),
        family AS (SELECT c.host AS a, d.host AS b FROM hosts c JOIN hosts d ON strpos(c.host, '.') > 0 AND d.host = substr(c.host, strpos(c.host, '.') + 1)),
        e AS (SELECT DISTINCT * FROM (FROM l UNION ALL SELECT a, b FROM family UNION ALL SELECT b, a FROM family) WHERE src <> dst),
        w AS (SELECT 'allow' AS kind, src AS host, dst FROM e UNION ALL SELECT 'block', dst, src FROM e),
        g AS (SELECT kind, host, count(*) AS degree FROM w GROUP BY ALL),
        s AS (SELECT CASE WHEN allowed > blocked THEN 'allow' ELSE 'block' END AS kind, host FROM hosts WHERE allowed <> blocked),
        z AS (SELECT kind, host, {walk.mass} // count(*) OVER (PARTITION BY kind) AS seed FROM s),
        n AS (SELECT kind, host, coalesce(seed, 0) AS seed, coalesce(degree, 0) AS degree FROM g FULL JOIN z USING (kind, host)),
        r0 AS (SELECT kind, host, seed AS rank, degree FROM n)"""
    for k in range(walk.steps):
        steps += f""",
        r{k + 1} AS MATERIALIZED (SELECT kind, host, CAST(sum(rank) AS BIGINT) AS rank, max(degree) AS degree FROM (
            SELECT kind, host, seed * {100 - walk.damping} // 100 AS rank, degree FROM n
            UNION ALL SELECT kind, dst, rank * {walk.damping} // (100 * degree), 0 FROM r{k} JOIN w USING (kind, host)) GROUP BY kind, host)"""
    return steps + f""",
        t AS (SELECT host, CAST(coalesce(sum(rank) FILTER (kind = 'allow'), 0) AS BIGINT) AS trust, CAST(coalesce(sum(rank) FILTER (kind = 'block'), 0) AS BIGINT) AS distrust
              FROM r{walk.steps} GROUP BY 1)
        SELECT page_id, host, path, rule, coalesce(said, CASE WHEN distrust > 0 AND distrust * {walk.den} >= (trust + distrust) * {walk.num} THEN 'block' ELSE 'allow' END) AS verdict,
               coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
        FROM k LEFT JOIN t USING (host)
    """


#: DuckDB SQL for the queries that SQL can express on whole tables.
ORACLE_SQL: dict[str, str] = {
    "op4_warc_bundles": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        k AS (SELECT payload_digest, max(page_id) AS kept FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT p.page_id, p.payload_bytes, p.payload_digest,
               CASE WHEN k.kept <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN k.kept <> p.page_id THEN k.kept END AS refers_to
        FROM p LEFT JOIN k ON p.payload_digest = k.payload_digest AND p.payload_bytes >= 1000
    """,
    # the lexer's own spans are none on these tables; where it finds some, this differs in `spans` alone
    "op6_secret_lexer": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), m AS ({_SECRET_SQL}),
        u AS (SELECT doc_id, o, kind, least, counted, x, s, unnest(range(1, len(x) + 1)) AS i FROM m),
        a AS (SELECT doc_id, o, kind, x[i] AS w, least, counted, list_sum(list_transform(s[1:i], lambda q: length(q))) + coalesce(list_sum(list_transform(x[1:i - 1], lambda q: length(q))), 0) AS start FROM u),
        f AS (SELECT doc_id, o, kind, CAST(start AS BIGINT) AS start, CAST(start + length(w) AS BIGINT) AS stop FROM a
              WHERE length(CASE counted WHEN 'value' THEN regexp_extract(w, '{_ASSIGN_SQL}', 1) ELSE w END) >= least),
        g AS (SELECT doc_id, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access, count(*) FILTER (o = 2) AS n_hex,
              string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, o) AS spans FROM f GROUP BY 1)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (doc_id)
    """,
    "op8_chat_round_trip": r"""
        WITH t AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(length(text) + length(role) + 15 + length(regexp_extract_all(text, '###|</turn>'))) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id
    """,
    "op10_jaccard_join": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
        ), s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM w
        ), f AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
        p AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM f a JOIN f b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
        ), e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
        r(id, c) AS (SELECT a, b FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.c)
        SELECT doc_id, len(g) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id FROM s LEFT JOIN (SELECT id, min(c) AS m FROM r GROUP BY 1) ON id = doc_id
    """,
    "op11_vector_codes": _vector_code_sql(),
    "op12_url_rules": _url_rule_sql(),
}
