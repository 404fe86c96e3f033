"""Search, conversations and work-queue analytics over the tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from larkspur.functions.exprs import rounded
from larkspur.operators import dialog, queue, search, sparse

from . import bind, similarity_queries as sim
from .bind import ATTRIBUTES, ITEMS, TAGS, with_
from .registry import query

PHRASES = {"the": "winter", "and": "summer", "que": "fall", "die": "day"}
STOP = ["of", "to", "in", "a"]
SAID = ("that", "est", "for", "und")


def _queries(spark, d):
    """Benchmark items as searches: the text, every third with a tag, every seventh like an item."""
    b = bind.t(spark, d, "benchmark")
    id_ = F.col("item_id")
    none = F.array().cast("array<string>")
    return b.select(
        id_.alias("query"), F.when(id_ % 4 != 1, F.col("text")).alias("text"), F.when(id_ % 7 == 0, F.concat(F.lit("k"), id_.cast("string"))).alias("like"),
        F.when(id_ % 3 == 0, F.array(F.lit("t1"))).otherwise(none).alias("tags"), none.alias("attributes"), F.when(id_ % 5 == 0, F.array(F.lit("night"))).otherwise(none).alias("axes"),
    )


_Q = """q AS (SELECT item_id AS query, CASE WHEN item_id % 4 <> 1 THEN text END AS text, CASE WHEN item_id % 7 = 0 THEN 'k' || item_id END AS "like",
item_id % 3 = 0 AS has_tags, item_id % 5 = 0 AS has_axes FROM benchmark)"""
_READ = """r AS (SELECT query, has_axes, list_filter(regexp_extract_all(lower(coalesce(text, '')), '[0-9a-zA-ZÀ-ỹ]+'), lambda x: length(x) > 1) AS words,
list_filter([CASE WHEN contains(lower(coalesce(text, '')), 'the') THEN 'winter' END, CASE WHEN contains(lower(coalesce(text, '')), 'and') THEN 'summer' END,
CASE WHEN contains(lower(coalesce(text, '')), 'que') THEN 'fall' END, CASE WHEN contains(lower(coalesce(text, '')), 'die') THEN 'day' END], lambda x: x IS NOT NULL) AS meant FROM q),
tokens AS (SELECT DISTINCT query, token FROM (SELECT query, unnest(words) AS token FROM r) WHERE token NOT IN ('of', 'to', 'in', 'a', 'that', 'est', 'for', 'und'))"""


def _read(spark, d):
    return search.read_text(_queries(spark, d), PHRASES, STOP, SAID)


@query(with_(_Q) + "SELECT query, CASE WHEN \"like\" IS NOT NULL THEN 'like' WHEN has_tags THEN 'terms' WHEN trim(coalesce(text, '')) <> '' THEN 'text' WHEN has_axes THEN 'axes' ELSE 'empty' END AS route FROM q")
def search_routes(spark, d):
    return search.route(_queries(spark, d)).select("query", "route")


@query(with_(_Q, _READ) + """SELECT query, CASE WHEN has_axes THEN 'night' ELSE
array_to_string(list_sort(list_distinct(list_concat(list_filter(words, lambda x: x IN ('that', 'est', 'for', 'und')), meant))), ',') END AS axes FROM r""")
def search_axes(spark, d):
    rows = search.effective_axes(_read(spark, d))
    return rows.select("query", F.array_join(F.array_sort("use_axes"), ",").alias("axes"))


@query(with_(_Q, _READ, "v AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS label FROM documents)") + """
SELECT q.query, coalesce(string_agg(token, ' ' ORDER BY token) FILTER (token IN (SELECT label FROM v)), '') AS matched,
coalesce(string_agg(token, ' ' ORDER BY token) FILTER (token NOT IN (SELECT label FROM v)), '') AS unknown
FROM q LEFT JOIN tokens USING (query) GROUP BY 1""")
def search_terms(spark, d):
    v = bind.t(spark, d, "documents").select(F.explode(F.split(F.lower("text"), " ")).alias("label"))
    rows = search.matched_terms(_read(spark, d), v)
    return rows.select("query", F.array_join("matched", " ").alias("matched"), F.array_join("unknown", " ").alias("unknown"))


_BEST = """SELECT word, label FROM w JOIN idf ON block = '{}' AND contains(label, word)
QUALIFY row_number() OVER (PARTITION BY word ORDER BY (label = word) DESC, df DESC, length(label), label) = 1"""


@query(with_(ATTRIBUTES, TAGS, sim.IDF, """tok AS (SELECT DISTINCT p_partkey AS query,
unnest(regexp_extract_all(lower(p_name || ' mùi ' || substr(p_name, 2, 3) || ' ' || split_part(p_type, ' ', 1) || ' zzq winter'), '[0-9a-zA-ZÀ-ỹ]+')) AS word FROM part),
w AS (SELECT DISTINCT word FROM tok WHERE length(word) > 1 AND word NOT IN ('mùi', 'winter'))""", f"n AS ({_BEST.format('note')})", f"a AS ({_BEST.format('acc')})") + """
SELECT query, coalesce(string_agg(DISTINCT coalesce(n.label, a.label), ',' ORDER BY coalesce(n.label, a.label)), '') AS matched,
coalesce(string_agg(word, ',' ORDER BY word) FILTER (n.label IS NULL AND a.label IS NULL), '') AS unknown
FROM tok JOIN w USING (word) LEFT JOIN n USING (word) LEFT JOIN a USING (word) GROUP BY 1""")
def search_resolved(spark, d):
    """Words of item names, parts of them and attributes, as searches with the default stop words."""
    p = bind.t(spark, d, "part")
    text = F.concat(F.col("p_name"), F.lit(" mùi "), F.substring("p_name", 2, 3), F.lit(" "), F.get(F.split("p_type", " "), 0), F.lit(" zzq winter"))
    rows = search.resolved_terms(search.read_text(p.select(F.col("p_partkey").alias("query"), text.alias("text"))), sim.idf(spark, d))
    return rows.select("query", F.array_join("matched", ",").alias("matched"), F.array_join("unknown", ",").alias("unknown"))


@query(with_(_Q, "c AS (SELECT *, has_tags AND query % 2 = 0 AS smell FROM q)") + """SELECT query, CASE WHEN smell THEN 't1' ELSE '' END AS tags,
CASE WHEN NOT smell THEN text END AS text, has_axes, CAST(greatest(1, least(query, 20)) AS BIGINT) AS lim FROM c""")
def chat_searches(spark, d):
    q = _queries(spark, d).withColumns({"tags": F.when(F.col("query") % 2 == 0, F.col("tags")), "limit": F.col("query")})
    rows = search.chat_query(q)
    return rows.select("query", F.array_join("tags", ",").alias("tags"), "text", (F.size("axes") > 0).alias("has_axes"), F.col("limit").cast("long").alias("lim"))


@query(with_(_Q, _READ, "v AS (SELECT word AS label, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[0-9a-zA-ZÀ-ỹ]+')) AS word FROM documents) GROUP BY 1 HAVING count(*) >= 20)")
       + "SELECT query, label, place FROM (SELECT query, label, row_number() OVER (PARTITION BY query ORDER BY df DESC, label) AS place FROM (SELECT DISTINCT query, label, df FROM tokens JOIN v ON contains(label, token))) WHERE place <= 24")
def mentioned_labels(spark, d):
    words = bind.t(spark, d, "documents").select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([0-9a-zA-ZÀ-ỹ]+)"), 1))).alias("label"))
    v = words.groupBy("label").agg(F.count("*").alias("df")).where("df >= 20")
    rows = search.mentioned_labels(_read(spark, d), v)
    return rows.select("query", "label", F.col("place").cast("long").alias("place"))


@query(with_(ATTRIBUTES, TAGS, sim.IDF, sim._WORDS, "res AS (" + sim._RES.format("(label = lower(word)) DESC,") + ")") + """
SELECT block AS query, string_agg(word || '=' || label, ',' ORDER BY word) FILTER (label <> word) AS resolved, string_agg(word, ',' ORDER BY word) FILTER (label IS NULL) AS unknown FROM res GROUP BY 1""")
def resolution_report(spark, d):
    r = sparse.resolved(sim._words(spark, d), sim.idf(spark, d)).withColumnRenamed("block", "query")
    rep = search.report(r)
    pairs = F.array_join(F.array_sort(F.transform(F.map_entries("resolved"), lambda e: F.concat_ws("=", e["key"], e["value"]))), ",")
    return rep.select("query", F.nullif(pairs, F.lit("")).alias("resolved"), F.nullif(F.array_join("unknown", ","), F.lit("")).alias("unknown"))


def _page(spark, d):
    rows = sparse.term_sum(sim._asked(spark, d), sim.terms(spark, d), 5)
    return rows.select("query", "item")


_PAGE = """page AS (SELECT query, item FROM (SELECT query, item, row_number() OVER (PARTITION BY query ORDER BY round(sum(weight), 9) DESC, item) AS rank FROM asked JOIN terms USING (block, label) GROUP BY 1, 2) WHERE rank <= 5),
why AS (SELECT query, item, block, label, weight FROM (SELECT query, item, block, label, weight, row_number() OVER (PARTITION BY query, item ORDER BY round(weight, 9) DESC, block, label) AS place FROM page JOIN asked USING (query) JOIN terms USING (item, block, label)) WHERE place <= 3)"""


@query(with_(*sim.ALL, sim._ASKED, _PAGE) + "SELECT query, item, block, label, round(weight * 1e6) / 1e6 AS weight FROM why")
def page_reasons(spark, d):
    rows = search.reasons(_page(spark, d), sim._asked(spark, d), sim.terms(spark, d))
    return rows.select("query", "item", "block", "label", rounded(F.col("weight"), 6).alias("weight"))


@query(with_(*sim.ALL, sim._ASKED, _PAGE) + """SELECT query, item, block, label, place FROM (
SELECT *, row_number() OVER (PARTITION BY query, item ORDER BY source, round(weight, 9) DESC, block, label) AS place FROM (
    SELECT * FROM (SELECT query, item, block, label, weight, 0 AS source FROM why UNION ALL SELECT query, item, block, label, weight, 1 FROM page JOIN terms USING (item) WHERE block IN ('acc', 'note', 'fam'))
    QUALIFY row_number() OVER (PARTITION BY query, item, label ORDER BY source, round(weight, 9) DESC, block) = 1)) WHERE place <= 3""")
def filled_reasons(spark, d):
    page, terms = _page(spark, d), sim.terms(spark, d)
    rows = search.filled_reasons(page, search.reasons(page, sim._asked(spark, d), terms), terms)
    return rows.withColumn("place", F.col("place").cast("long"))


@query(with_(ITEMS, "asked AS (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) AS text FROM part)", "r AS (SELECT text, item AS key, row_number() OVER (PARTITION BY text ORDER BY coalesce(votes, 0) DESC, item) AS rank FROM items JOIN asked ON contains(lower(name), text))")
       + "SELECT text, max(key) FILTER (rank = 1) AS seed, string_agg(key, ',' ORDER BY rank) FILTER (rank BETWEEN 2 AND 5) AS others FROM r GROUP BY 1")
def like_item_seeds(spark, d):
    asked = bind.t(spark, d, "part").select(F.lower(F.get(F.split("p_name", " "), 0)).alias("text")).distinct()
    rows = search.seeds(sparse.lookup_items(asked, bind.items(spark, d).withColumnRenamed("item", "key")))
    return rows.select("text", "seed", F.array_join(F.col("others").cast("array<string>"), ",").alias("others"))


@query("""WITH res AS (SELECT user_id AS query, event_id AS item, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events),
shown AS (SELECT query, item FROM res WHERE rank % 2 = 1 AND query % 5 <> 0 OR query % 6 = 0 AND rank <= 50), n AS (SELECT query, count(*) AS n FROM shown GROUP BY 1),
lim AS (SELECT DISTINCT user_id AS query, CAST(3 + user_id % 4 AS BIGINT) AS lim FROM events),
k AS (SELECT query, item, row_number() OVER (PARTITION BY query ORDER BY rank) AS place FROM res JOIN lim USING (query) LEFT JOIN n USING (query) WHERE rank <= least(2 * lim + coalesce(n, 0), 50) AND (query, item) NOT IN (SELECT (query, item) FROM shown))
SELECT lim.query, item, place, item IS NULL AS exhausted FROM lim LEFT JOIN k ON k.query = lim.query AND place <= lim""")
def unseen_results(spark, d):
    e = bind.t(spark, d, "events").select(F.col("user_id").alias("query"), F.col("event_id").alias("item"), "value")
    res = e.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("value"), "item")))
    shown = res.where("rank % 2 = 1 and query % 5 <> 0 or query % 6 = 0 and rank <= 50").select("query", "item")
    lim = e.select("query").distinct().withColumn("limit", 3 + F.col("query") % 4)
    return search.without_shown(res, shown, lim).select("query", "item", F.col("place").cast("long").alias("place"), "exhausted")


@query(with_(ITEMS) + "SELECT item FROM items WHERE lower(gender) = 'nam' AND coalesce(votes, 0) >= 30")
def filtered_items(spark, d):
    return search.filtered(bind.items(spark, d), "NAM", 30).select("item")


@query("SELECT event_id, greatest(1, least(coalesce(CAST(floor(value) AS INT), 10), 50)) AS lim FROM events")
def clamped_limits(spark, d):
    return bind.t(spark, d, "events").select("event_id", search.clamped(F.floor("value").cast("int")).alias("lim"))


# Conversations: frequent syllables of the tables stand for the marker phrases

AX = {"the": "winter", "des": "summer", "que": "fall", "die": "day"}
GE = {"and": "Nam", "la": "Nữ", "der": "Unisex"}
REFINE, POINT = (" in ", " la ", " die ", " el "), (" the ", " der ", " de ", " que")
POINTERS = dialog.Pointers(
    before_digits=("nr",), before_ends=("de", "the", "in"), ends={"la": 1, "and": -1}, before_spelled=("de", "the", "die", "in", "que"),
    spelled={"la": 1, "que": 2, "of": 3, "und": 9, "is": 2}, that_one=(" der ",),
)


def _turns(spark, d):
    c = bind.t(spark, d, "conversations")
    shown = F.when(F.col("role") == "assistant", F.slice(F.split("text", " "), 1, 3))
    return c.select("conv_id", "turn", "role", "text", shown.alias("shown"))


_SLOTS = """s AS (SELECT conv_id, turn, role, text, list_filter([CASE WHEN contains(lower(text), 'the') THEN 'winter' END, CASE WHEN contains(lower(text), 'des') THEN 'summer' END, CASE WHEN contains(lower(text), 'que') THEN 'fall' END,
CASE WHEN contains(lower(text), 'die') THEN 'day' END], lambda x: x IS NOT NULL) AS axes, CASE WHEN regexp_matches(lower(text), '(^|[^\\pL\\pN_])and([^\\pL\\pN_]|$)') THEN 'Nam' WHEN regexp_matches(lower(text), '(^|[^\\pL\\pN_])la([^\\pL\\pN_]|$)') THEN 'Nữ'
WHEN regexp_matches(lower(text), '(^|[^\\pL\\pN_])der([^\\pL\\pN_]|$)') THEN 'Unisex' END AS gender FROM conversations)"""


@query(with_(_SLOTS) + "SELECT conv_id, turn, array_to_string(axes, ',') AS axes, gender FROM s")
def turn_slots(spark, d):
    return dialog.slots(_turns(spark, d), axes=AX, genders=GE).select("conv_id", "turn", F.array_join("axes", ",").alias("axes"), "gender")


_ACT = r"""b AS (SELECT *, lower(trim(text)) AS low, count(*) FILTER (role = 'user') OVER w > 0 AS earlier,
    last_value(CASE WHEN role = 'assistant' THEN string_split(text, ' ')[1:3] END IGNORE NULLS) OVER w AS sh
    FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
pt AS (SELECT *, list_filter([TRY_CAST(nullif(regexp_extract(low, 'nr\s*(\d+)', 1), '') AS INT),
    CASE regexp_extract(low, '(?:de|the|in)\s+(la|and)(?:[^\pL\pM\pN_]|$)', 1) WHEN 'la' THEN 1 WHEN 'and' THEN -1 END,
    CASE regexp_extract(low, '(?:de|the|die|in|que)\s+(la|que|of|und|is)(?:[^\pL\pM\pN_]|$)', 1) WHEN 'la' THEN 1 WHEN 'que' THEN 2 WHEN 'of' THEN 3 WHEN 'und' THEN 9 WHEN 'is' THEN 2 END,
    CASE WHEN contains(low, ' der ') THEN 1 END], lambda x: x IS NOT NULL AND x <> 0 AND abs(x) <= len(sh))[1] AS p FROM b),
tg AS (SELECT *, CASE WHEN role = 'user' AND earlier AND (contains(low, ' the ') OR contains(low, ' der ') OR contains(low, ' de ') OR contains(low, ' que'))
    THEN CASE WHEN p > 0 THEN sh[p] ELSE sh[len(sh) + 1 + p] END END AS target FROM pt),
a AS (SELECT *, CASE WHEN role <> 'user' THEN NULL WHEN target IS NOT NULL THEN 'about'
    WHEN earlier AND (contains(low, ' in ') OR contains(low, ' la ') OR contains(low, ' die ') OR contains(low, ' el ')) THEN 'refine' ELSE 'new' END AS action FROM tg)"""


@query(with_(_SLOTS, _ACT) + "SELECT conv_id, turn, action, target FROM a WHERE action IS NOT NULL")
def turn_actions(spark, d):
    rows = dialog.classified(_turns(spark, d), REFINE, POINT, POINTERS)
    return rows.where("action is not null").select("conv_id", "turn", "action", "target")


def _acted(spark, d):
    t = dialog.classified(dialog.slots(_turns(spark, d), axes=AX, genders=GE), REFINE, POINT, POINTERS)
    words = F.slice(F.split("text", " "), 1, 2)
    return t.withColumns({"tags": words, "attributes": F.array().cast("array<string>"), "min_votes": F.col("turn")})


@query(with_(_SLOTS, _ACT, """g AS (SELECT *, sum(CASE WHEN action = 'new' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS segment, string_split(text, ' ')[1:2] AS tags FROM a WHERE action IN ('new', 'refine')),
m AS (SELECT conv_id, turn, segment, last_value(CASE WHEN len(axes) > 0 THEN axes END IGNORE NULLS) OVER w AS axes, last_value(gender IGNORE NULLS) OVER w AS gender, substr(trim(string_agg(nullif(text, ''), ' ') OVER w), 1, 300) AS text,
flatten(list(tags) OVER w) AS tags, first_value(turn) OVER w AS min_votes FROM g WINDOW w AS (PARTITION BY conv_id, segment ORDER BY turn ROWS UNBOUNDED PRECEDING))""") + """
SELECT conv_id, turn, CAST(segment AS BIGINT) AS segment, array_to_string(list_sort(list_distinct(tags)), ' ') AS tags, array_to_string(axes, ',') AS axes, gender, nullif(text, '') AS text, min_votes FROM m""")
def merged_slots(spark, d):
    rows = dialog.merged(_acted(spark, d))
    return rows.withColumns({"tags": F.array_join(F.array_sort("tags"), " "), "axes": F.array_join("axes", ",")}).drop("attributes")


@query(with_(_SLOTS, _ACT) + "SELECT conv_id, turn, max(CASE WHEN action IN ('new', 'refine') THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_search FROM a")
def last_searches(spark, d):
    return dialog.last_search(_acted(spark, d)).select("conv_id", "turn", "last_search")


@query("""WITH l AS (SELECT conv_id, turn, CASE role WHEN 'user' THEN 'Khách' ELSE 'Bạn' END || ': ' || coalesce(text, '') || CASE WHEN role = 'assistant' AND text IS NOT NULL THEN
chr(10) || '  (đã hiện cho khách: ' || array_to_string(list_transform(string_split(text, ' ')[1:3], lambda x, i: i || '. ' || x), '; ') || ')' ELSE '' END AS line FROM conversations)
SELECT conv_id, turn, md5(coalesce(string_agg(line, chr(10)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), '')) AS history FROM l""")
def turn_history(spark, d):
    return dialog.with_history(_turns(spark, d)).select("conv_id", "turn", F.md5(F.col("history").cast("binary")).alias("history"))


@query("SELECT conv_id, turn FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 3")
def newest_turns(spark, d):
    return dialog.newest_turns(_turns(spark, d), 3).select("conv_id", "turn")


_SESS = """g AS (SELECT user_id, ts, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 6 * 3600000000, true) AS fresh, event_id FROM events),
s AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)"""


@query(with_(_SESS) + "SELECT user_id, CAST(session AS BIGINT) AS session, epoch_us(min(ts)) AS start, epoch_us(max(ts)) AS \"end\", count(*) AS n FROM s GROUP BY 1, 2")
def idle_sessions(spark, d):
    e = bind.t(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return dialog.sessions(e, "user_id", "ts").withColumns({"start": F.unix_micros("start"), "end": F.unix_micros("end")})


@query(with_(_SESS, "x AS (SELECT user_id, session, max(ts) AS e FROM s GROUP BY 1, 2)") + "SELECT user_id, CAST(session AS BIGINT) AS session FROM x ORDER BY e DESC, user_id, session LIMIT 200")
def kept_sessions(spark, d):
    e = bind.t(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return dialog.kept_sessions(dialog.sessions(e, "user_id", "ts"), "user_id").select("user_id", "session")


@query(with_(ATTRIBUTES, TAGS, sim.IDF, "p AS (SELECT DISTINCT p_name AS proposal FROM part UNION SELECT DISTINCT substr(p_name, 1, 4) FROM part)") + """
SELECT proposal, label FROM p JOIN (SELECT DISTINCT label FROM idf) ON contains(label, lower(trim(proposal))) OR contains(lower(trim(proposal)), label)
QUALIFY row_number() OVER (PARTITION BY proposal ORDER BY (label = lower(trim(proposal))) DESC, length(label), label) = 1""")
def gated_labels(spark, d):
    p = bind.t(spark, d, "part")
    rows = p.select(F.col("p_name").alias("proposal")).union(p.select(F.substring("p_name", 1, 4)))
    return dialog.gated(rows, sim.idf(spark, d))


@query("SELECT event_id, CASE WHEN event_id % 5 > 1 THEN props END AS body FROM events")
def json_in_text(spark, d):
    k = F.col("event_id") % 5
    broken = F.when(k == 0, F.expr("left(props, length(props) - 1)")).when(k == 1, F.concat(F.lit("{"), F.col("props"))).otherwise(F.col("props"))
    text = F.concat(F.lit("```json\n"), broken, F.lit("\n``` done"))
    return bind.t(spark, d, "events").select("event_id", dialog.json_object(text).alias("body"))


@query(r"""WITH al AS (SELECT DISTINCT conv_id AS key, lower(split_part(text, ' ', 1) || ' ' || split_part(text, ' ', 2)) AS name FROM conversations WHERE turn = 0),
ok AS (SELECT key, name AS w FROM al UNION SELECT key, unnest(regexp_split_to_array(name, '[\s/&-]+')) FROM al),
ph AS (SELECT DISTINCT conv_id AS key, turn, unnest(regexp_extract_all(upper(regexp_replace(text, '[^\x00-\x7F]', '-', 'g')), '\b([A-Z][\w'']*(?:\s+[A-Z0-9][\w'']*)+)', 1)) AS phrase FROM conversations WHERE role = 'assistant'),
bad AS (SELECT key, turn, phrase FROM ph WHERE NOT EXISTS (SELECT 1 FROM ok WHERE ok.key = ph.key AND w = lower(phrase)) AND (SELECT count(*) FROM (SELECT unnest(regexp_split_to_array(lower(phrase), '\s+')) AS u) WHERE length(u) > 2 AND NOT EXISTS (SELECT 1 FROM ok WHERE ok.key = ph.key AND w = u AND length(w) > 2)) + (CASE WHEN (SELECT count(*) FROM (SELECT unnest(regexp_split_to_array(lower(phrase), '\s+')) AS u) WHERE length(u) > 2) = 0 THEN 1 ELSE 0 END) > 0)
SELECT DISTINCT key, phrase FROM bad""")
def ungrounded_names(spark, d):
    c = bind.t(spark, d, "conversations")
    w = F.split("text", " ")
    allowed = c.where("turn = 0").select(F.col("conv_id").alias("key"), F.concat_ws(" ", F.get(w, 0), F.coalesce(F.get(w, 1), F.lit(""))).alias("name"))
    loud = F.upper(F.regexp_replace("text", r"[^\x00-\x7F]", "-"))
    return dialog.ungrounded(c.where("role = 'assistant'").select(F.col("conv_id").alias("key"), loud.alias("text")), allowed)


_WHO = """r AS (SELECT grp AS query, name, grp, rating, votes, item, row_number() OVER (PARTITION BY grp ORDER BY coalesce(votes, 0) DESC, item) AS rank FROM items),
t AS (SELECT query, max(name) FILTER (rank = 1) AS name, max(rating) FILTER (rank = 1) AS rating, max(votes) FILTER (rank = 1) AS votes, max(item) FILTER (rank = 1) AS item,
      string_agg(name, ' và ' ORDER BY rank) FILTER (rank IN (2, 3)) AS others FROM r WHERE rank <= 3 GROUP BY 1),
b AS (SELECT DISTINCT p_brand AS query FROM part UNION ALL SELECT 'none')"""


@query(with_(ITEMS, _WHO) + """SELECT query, CASE WHEN t.item IS NULL THEN 'Mình chưa tìm được chai nào khớp ý này. Bạn thử nói theo note hương (ví dụ oud, vanilla, hoa hồng), hoặc theo lúc dùng — mùa lạnh hay nóng, đi làm hay đi tối?'
ELSE concat_ws(' ', 'Mình nghĩ ' || coalesce(name, 'chai này') || ' của ' || query || ' là sát ý bạn nhất' || CASE item % 3 WHEN 0 THEN '' WHEN 1 THEN ' — mùi fresh, hợp mùa lạnh, lưu hương lâu' ELSE ' — hợp mùa nóng' END || '.',
CASE WHEN rating IS NOT NULL AND votes > 0 THEN CASE WHEN votes * 20 >= 500 THEN 'Chai này có ' || replace(format('{:,}', votes * 20), ',', '.') || ' lượt đánh giá, trung bình ' || printf('%.2f', rating) || '/5 — khá nhiều người đã dùng.'
ELSE 'Mới có ' || votes * 20 || ' lượt đánh giá nên điểm ' || printf('%.2f', rating) || '/5 chưa chắc chắn lắm.' END END,
'Cùng hướng đó còn có ' || others || ', bạn xem thử bên cạnh.', 'Bạn thích mùi ngọt ấm hay khô nhẹ hơn?') END AS answer FROM b LEFT JOIN t USING (query)""")
def templated_answers(spark, d):
    """Each group's answer from its three items with most votes, and one for a group without items."""
    i = bind.items(spark, d)
    by = Window.partitionBy("grp").orderBy(F.desc(F.coalesce("votes", F.lit(0))), "item")
    why = lambda *pairs: F.array(*(F.struct(F.lit(b).alias("block"), F.lit(x).alias("label")) for b, x in pairs))
    k = F.col("item") % 3
    reasons = F.when(k == 1, why(("acc", "fresh"), ("occ", "winter"), ("str", "longevity"), ("str", "sillage"))).when(k == 2, why(("occ", "summer")))
    rows = i.withColumns({"rank": F.row_number().over(by), "query": F.col("grp"), "reasons": reasons, "votes": F.col("votes") * 20})
    asked = bind.t(spark, d, "part").select(F.col("p_brand").alias("query")).union(spark.range(1).select(F.lit("none")))
    return dialog.answers(rows, asked)


_ABOUT = """r AS (SELECT grp AS query, name, grp, rating, votes, item, row_number() OVER (PARTITION BY grp ORDER BY coalesce(votes, 0) DESC, item) AS rank FROM items),
t AS (SELECT query, max(name) FILTER (rank = 1) AS name, max(rating) FILTER (rank = 1) AS rating, max(votes) FILTER (rank = 1) AS votes, max(item) FILTER (rank = 1) AS item,
      string_agg(name, ' và ' ORDER BY rank) FILTER (rank IN (2, 3)) AS near, string_agg(name, ', ' ORDER BY rank) FILTER (rank <= 3) AS shown FROM r WHERE rank <= 3 GROUP BY 1)"""


def _by_votes(spark, d):
    """Items of each group in order of their votes, with reasons by their key."""
    by = Window.partitionBy("grp").orderBy(F.desc(F.coalesce("votes", F.lit(0))), "item")
    why = lambda *pairs: F.array(*(F.struct(F.lit(b).alias("block"), F.lit(x).alias("label")) for b, x in pairs))
    reasons = F.when(F.col("item") % 2 == 1, why(("acc", "fresh"), ("occ", "winter"), ("str", "longevity"), ("str", "sillage")))
    return bind.items(spark, d).withColumns({"rank": F.row_number().over(by), "query": F.col("grp"), "reasons": reasons, "votes": F.col("votes") * 20})


@query(with_(ITEMS, _ABOUT) + """SELECT query, concat_ws(' ', name || ' của ' || query || ' thì' || CASE item % 2 WHEN 1 THEN ' mùi fresh, hợp mùa lạnh, lưu hương lâu.' ELSE ' mình chưa có đủ dữ liệu về mùi của nó.' END,
CASE WHEN rating IS NOT NULL AND votes > 0 THEN CASE WHEN votes * 20 >= 500 THEN 'Có ' || replace(format('{:,}', votes * 20), ',', '.') || ' lượt đánh giá, trung bình ' || printf('%.2f', rating) || '/5.'
ELSE 'Mới ' || votes * 20 || ' lượt đánh giá nên điểm ' || printf('%.2f', rating) || '/5 chưa chắc chắn.' END END,
'Gần nó nhất là ' || near || '.', 'Bạn muốn mình so hai chai này không?') AS answer FROM t""")
def answers_about_item(spark, d):
    """Each group's first item described, with the next two as the ones nearest to it."""
    rows = _by_votes(spark, d)
    near = rows.where("rank > 1").withColumn("rank", F.col("rank") - 1).select("query", "rank", "name")
    return dialog.answers_about(rows.where("rank = 1"), near)


@query(with_(ITEMS, _ABOUT) + """SELECT query, 'Với điều kiện này thì mình chưa thấy chai nào khác ngoài ' || shown || ' đã gợi lúc trước. Bạn nới bớt một điều kiện nhé — bỏ mùa, hay cho mình thêm một note hương bạn thích?' AS answer FROM t""")
def answers_when_all_shown(spark, d):
    return dialog.answers_exhausted(_by_votes(spark, d).select("query", "rank", "name"))


# Work queue: suppliers are groups, parts items, events outcomes


def _items(spark, d):
    back = bind.t(spark, d, "lineitem").groupBy("l_partkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("r"), F.count("*").alias("comments"))
    rows = bind.t(spark, d, "part").join(back, F.col("p_partkey") == F.col("l_partkey"), "left")
    status = F.when(F.coalesce("r", F.lit(0)) < 8, "pending").when(F.col("p_partkey") % 11 == 0, "failed").otherwise("done")
    return rows.select(F.col("p_partkey").alias("item"), F.col("p_brand").alias("grp"), status.alias("status"), "comments")


def _groups(spark, d):
    n = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    g = bind.t(spark, d, "part").select("p_brand", n.alias("n")).distinct()
    rank = F.when(F.col("n") % 3 != 0, F.col("n"))
    until = F.when(F.col("n") % 7 == 0, F.lit("2024-02-01"))
    return g.select(F.col("p_brand").alias("grp"), F.col("p_brand").alias("name"), rank.alias("rank"), queue.priority(rank).alias("priority"), F.when(F.col("n") % 2 == 0, "pending").otherwise("done").alias("listing"), until.alias("blocked_until"))


_WQ = """wi AS (SELECT p_partkey AS item, p_brand AS grp, CASE WHEN coalesce(r, 0) < 8 THEN 'pending' WHEN p_partkey % 11 = 0 THEN 'failed' ELSE 'done' END AS status, comments
FROM part LEFT JOIN (SELECT l_partkey, count(*) FILTER (l_returnflag = 'R') AS r, count(*) AS comments FROM lineitem GROUP BY 1) ON l_partkey = p_partkey),
wn AS (SELECT DISTINCT p_brand, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) AS n FROM part),
wg AS (SELECT p_brand AS grp, p_brand AS name, CASE WHEN n % 3 <> 0 THEN n END AS rank, CASE WHEN n % 3 <> 0 THEN 1000 - n ELSE 0 END AS priority, CASE WHEN n % 2 = 0 THEN 'pending' ELSE 'done' END AS listing, CASE WHEN n % 7 = 0 THEN '2024-02-01' END AS blocked_until FROM wn)"""


@query("""SELECT coalesce(c_custkey, o_custkey) AS key, coalesce(n, c_nationkey) AS nation, greatest(p, c_acctbal) AS best, c_mktsegment AS segment, c_custkey IS NULL AS is_new
FROM (SELECT * FROM customer WHERE c_custkey % 4 <> 0) FULL JOIN (SELECT o_custkey, CAST(max(o_orderkey % 25) AS INT) AS n, max(o_totalprice) AS p FROM orders GROUP BY 1) ON c_custkey = o_custkey""")
def seeded_groups(spark, d):
    old = bind.t(spark, d, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("best"), F.col("c_mktsegment").alias("segment"))
    new = bind.t(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.max(F.col("o_orderkey") % 25).cast("int").alias("nation"), F.max("o_totalprice").alias("best"))
    return queue.upsert(old, new, "key", ["nation"], ["best"], ["segment"])


@query("SELECT count(*) FILTER (c_custkey IS NULL) AS added, count(*) AS seen FROM (SELECT * FROM customer WHERE c_custkey % 4 <> 0) FULL JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey")
def seeded_counts(spark, d):
    return queue.seeded(seeded_groups(spark, d))


@query(with_(_WQ) + "SELECT wg.grp, count(item) AS total FROM wg LEFT JOIN wi ON wi.grp = wg.grp AND wg.grp > 'Brand#2' GROUP BY 1")
def seeded_totals(spark, d):
    """Items without a known group count for none."""
    items = _items(spark, d).withColumn("grp", F.when(F.col("grp") > "Brand#2", F.col("grp")))
    return queue.group_totals(_groups(spark, d).select("grp"), items)


_NEXT = "nx AS (SELECT grp, rank, priority, name, listing, coalesce(p, 0) AS pending FROM wg LEFT JOIN (SELECT grp, count(*) AS p FROM wi WHERE status = 'pending' GROUP BY 1) USING (grp) WHERE (blocked_until IS NULL OR blocked_until <= '2024-01-15') AND (listing = 'pending' OR coalesce(p, 0) >= 3))"


def _next(spark, d, n):
    return queue.next_groups(_groups(spark, d), _items(spark, d), F.lit("2024-01-15"), 3, n)


@query(with_(_WQ, _NEXT) + "SELECT grp, priority, pending FROM nx ORDER BY priority DESC, rank NULLS LAST, name LIMIT 10")
def next_groups(spark, d):
    return _next(spark, d, 10).select("grp", "priority", "pending")


@query(with_(_WQ) + "SELECT grp, item, place FROM (SELECT grp, item, row_number() OVER (PARTITION BY grp ORDER BY coalesce(comments, 0) DESC, item) AS place FROM wi WHERE status = 'pending') WHERE place <= 5")
def pending_items(spark, d):
    return queue.pending_items(_items(spark, d), 5).select("grp", "item", F.col("place").cast("long").alias("place"))


@query(with_(_WQ, _NEXT, """c AS (SELECT grp, (CASE WHEN listing = 'pending' THEN 1 ELSE 0 END) + pending AS cost, priority, rank, name FROM nx ORDER BY priority DESC, rank NULLS LAST, name LIMIT 20),
b AS (SELECT grp, cost, coalesce(sum(cost) OVER (ORDER BY priority DESC, rank NULLS LAST, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)""") + "SELECT grp, CAST(least(cost, 30 - before) AS BIGINT) AS granted FROM b WHERE before < 30")
def budget_slice(spark, d):
    order = [F.desc("priority"), F.asc_nulls_last("rank"), F.col("name")]
    return queue.budget_slice(_next(spark, d, 1000), order, 30, 20).select("grp", "granted")


def _outcomes(spark, d):
    e = bind.t(spark, d, "events").where("event_type in ('error', 'purchase')")
    return e.select(F.col("user_id").alias("key"), "ts", "event_id", (F.col("event_type") == "purchase").alias("ok"), F.col("props").alias("error"))


_FOLD = """o AS (SELECT user_id AS key, ts, event_id, event_type = 'purchase' AS ok, props AS error FROM events WHERE event_type IN ('error', 'purchase')),
f AS (SELECT *, max(CASE WHEN ok THEN (ts, event_id) END) OVER (PARTITION BY key) AS won FROM o),
st AS (SELECT key, arg_max(ok, (ts, event_id)) AS ok, count(*) FILTER (NOT ok AND (won IS NULL OR (ts, event_id) > won)) AS fail_count, arg_max(error, (ts, event_id)) AS e FROM f GROUP BY 1)"""


@query(with_(_FOLD) + "SELECT key, CASE WHEN ok THEN 'done' ELSE 'failed' END AS status, fail_count, CASE WHEN NOT ok THEN e END AS last_error FROM st")
def folded_outcomes(spark, d):
    return queue.folded(_outcomes(spark, d), "key", ["ts", "event_id"])


@query(with_(_FOLD) + "SELECT key, CASE WHEN fail_count > 0 THEN [6, 24, 72][least(fail_count, 3)] END AS hours FROM st")
def cool_down(spark, d):
    return queue.folded(_outcomes(spark, d), "key", ["ts", "event_id"]).select("key", queue.cool_hours(F.col("fail_count")).alias("hours"))


@query("SELECT user_id, epoch_us(max(ts)) AS until, arg_max(props, (ts, props)) AS reason FROM events WHERE event_type = 'error' GROUP BY 1 HAVING max(ts) > TIMESTAMP '2024-01-25'")
def active_blocks(spark, d):
    e = bind.t(spark, d, "events").where("event_type = 'error'").select("user_id", F.col("ts").cast("timestamp").alias("until"), F.col("props").alias("reason"))
    return queue.blocks(e, "user_id", "until", "reason", F.lit("2024-01-25").cast("timestamp")).withColumn("until", F.unix_micros("until"))


@query("SELECT arg_max(event_id, (ts, event_id)) AS run_id FROM events WHERE value > 0 AND CAST(ts + INTERVAL 7 HOUR AS DATE) = DATE '2024-01-10'")
def ran_today(spark, d):
    e = bind.t(spark, d, "events")
    runs = e.select(F.col("event_id").alias("run_id"), F.col("ts").cast("timestamp").alias("started_at"), F.col("ts").alias("finished_at"), F.col("value").alias("used"))
    return queue.ran_on(runs, F.lit("2024-01-10").cast("date"))


@query(with_(_WQ, "p AS (SELECT wg.*, coalesce(x.p, 0) AS pending FROM wg LEFT JOIN (SELECT grp, count(*) FILTER (status = 'pending') AS p FROM wi GROUP BY 1) x USING (grp))") + """
SELECT count(*) AS groups, count(*) FILTER (listing = 'done') AS groups_listed, count(*) FILTER (listing = 'pending') AS groups_waiting, count(*) FILTER (listing = 'done' AND pending = 0) AS groups_finished, count(*) FILTER (pending >= 3) AS groups_above,
count(*) FILTER (pending BETWEEN 1 AND 2) AS groups_below, count(blocked_until) AS groups_blocked, (SELECT count(*) FROM wi) AS items, (SELECT count(*) FROM wi WHERE status = 'pending') AS items_pending,
(SELECT count(*) FROM wi WHERE status = 'done') AS items_done, (SELECT count(*) FROM wi WHERE status = 'failed') AS items_failed FROM p""")
def queue_progress(spark, d):
    return queue.progress(_groups(spark, d), _items(spark, d), 3)


@query(with_(_WQ) + "SELECT grp, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'failed') AS failed FROM wi GROUP BY 1")
def group_detail(spark, d):
    return queue.group_detail(_items(spark, d))


@query(with_(_WQ) + "SELECT grp, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'pending') AS pending FROM wi GROUP BY 1 HAVING count(*) FILTER (status = 'done') > 0 AND count(*) FILTER (status = 'pending') > 0 ORDER BY done DESC, grp LIMIT 5")
def groups_in_progress(spark, d):
    return queue.in_progress(_items(spark, d), 5)


_RUNS = "r AS (SELECT CAST(ts AS DATE) AS started_at, CAST(strftime(ts, '%Y%m%d') AS INT) AS run_id, count(*) FILTER (event_type = 'purchase') AS items_done FROM events GROUP BY 1, 2)"


def _runs(spark, d):
    day = F.to_date("ts")
    return bind.t(spark, d, "events").groupBy(day.alias("started_at"), F.date_format(day, "yyyyMMdd").cast("int").alias("run_id")).agg(F.count_if(F.col("event_type") == "purchase").alias("items_done"))


@query(with_(_RUNS) + "SELECT * FROM r ORDER BY started_at DESC LIMIT 5")
def recent_runs(spark, d):
    return queue.recent_runs(_runs(spark, d), 5)


@query(with_(_RUNS, _WQ) + "SELECT per_run, p AS pending, CAST(ceil(p / per_run) AS BIGINT) AS runs_left FROM (SELECT avg(items_done) AS per_run FROM (SELECT * FROM r WHERE items_done > 0 ORDER BY started_at DESC LIMIT 7)), (SELECT count(*) AS p FROM wi WHERE status = 'pending')")
def runs_remaining(spark, d):
    return queue.runs_remaining(_runs(spark, d), _items(spark, d))


@query(with_(_WQ) + "SELECT item, CASE WHEN h THEN 'done' ELSE status END AS status, coalesce(h AND status <> 'done', false) AS changed FROM (SELECT *, item IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 45) AS h FROM wi)")
def marked_done(spark, d):
    out = bind.t(spark, d, "lineitem").where("l_quantity >= 45").select(F.col("l_partkey").alias("item"))
    return queue.mark_done(_items(spark, d), out, "item").select("item", "status", "changed")


@query(with_(_WQ) + """SELECT item, CASE WHEN status = 'failed' THEN 'pending' ELSE status END AS status, CASE WHEN item % 7 = 9 THEN 'x' END AS blocked_until, status = 'failed' OR item % 7 = 0 AS changed FROM wi""")
def reset_failed(spark, d):
    """Failed items are pending again and blocks are cleared."""
    rows = _items(spark, d).withColumn("blocked_until", F.when(F.col("item") % 7 == 0, "2024-02-01"))
    return queue.reset(rows, blocks=True).select("item", "status", "blocked_until", "changed")


@query(with_(_WQ, "t AS (SELECT unnest([0, 5, 20, 30, 40]) AS threshold)") + """SELECT threshold, count(*) FILTER (coalesce(comments, 0) >= threshold) AS kept, round(100.0::DOUBLE * sum(CASE WHEN comments >= threshold THEN comments ELSE 0 END) / sum(comments) * 10) / 10 AS mass_pct,
CAST(ceil(count(*) FILTER (coalesce(comments, 0) >= threshold) / 150.0) AS BIGINT) AS runs FROM wi, t GROUP BY 1""")
def threshold_curve(spark, d):
    return queue.threshold_curve(_items(spark, d), [0, 5, 20, 30, 40])
