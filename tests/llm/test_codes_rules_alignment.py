"""Vector codes, URL rules and token alignment against brute force, with odd rows of every kind."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import pytest

pytest.importorskip("larkspur.llm")
import numpy as np  # noqa: E402
from conftest import SF  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from larkspur.llm import joins, queries, token_alignment, url_rules, vector_codes  # noqa: E402

# 11


def plain_codes(rows, entries=64, parts=16, rounds=2, scale=256):
    """rows: (id, vector, label) that are fit to be coded; Python integers throughout."""
    ints = [[math.floor(scale * x) for x in v] for _, v, _ in rows]
    d = len(ints[0]) // parts
    cut = [[v[p * d : (p + 1) * d] for p in range(parts)] for v in ints]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))[:entries]
    books = [[cut[i][p] for i in first] for p in range(parts)]

    def assign():
        out = []
        for v in cut:
            far = [[sum((x - c) ** 2 for x, c in zip(v[p], e)) for e in books[p]] for p in range(parts)]
            out.append([(f.index(min(f)), min(f)) for f in far])
        return out

    for _ in range(rounds):
        members = defaultdict(list)
        for v, a in zip(cut, assign()):
            for p, (k, _) in enumerate(a):
                members[p, k].append(v[p])
        for (p, k), vs in members.items():
            books[p][k] = [sum(x) // len(vs) for x in zip(*vs)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    done = [(r[0], "".join(f"{k:02x}" for k, _ in a), sum(f for _, f in a), r[2]) for r, a in zip(rows, assign())]
    label = Counter()
    for _, _, e, lab in done:
        label[lab] += e
    return sorted((str(i), c, e, label[lab], sha) for i, c, e, lab in done)


VECTORS = "vec_id long, embedding array<double>, label int, code int, error string, key long, part string, vector int"


def coded(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1, "e", 2, "p", 3) for r in rows], VECTORS).repartition(3)
    out = vector_codes.compressed(df, **kw)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in out.collect())


@pytest.mark.parametrize("n,size", [(5, 1.0), (90, 1.0), (90, 90_000.0)])
def test_vector_codes(spark, n, size):
    rng = random.Random(n)
    rows = [(i, [rng.gauss(0, size) for _ in range(32)], rng.choice([None, 1, 2])) for i in rng.sample(range(900), n)]
    rows += [rows[0], (None, rows[1][1], 1), (rows[2][0], rows[3][1], 2), (-3, [0.0] * 32, 7), (-2, [0.0] * 32, None)]
    odd = [(-9, None, 1), (1, [*rows[0][1][:-1], None], 1), (2, [math.nan] * 32, 1), (-8, [math.inf] + [0.0] * 31, 2), (3, [-math.inf] * 32, 1)]
    assert coded(spark, rows + odd) == plain_codes(rows)


def test_vectors_without_code(spark):
    """Other widths and numbers too large for int64 errors: kept, with a null code, without a part in the fit."""
    rows = [(k, [float(k % 3), 0.5] * 16, 1) for k in range(9)]
    odd = [(10, [], 4), (11, [1.0] * 16, 4), (12, [1e30] * 32, 4)]
    sha = plain_codes(rows)[0][-1]
    assert coded(spark, rows + odd) == sorted(plain_codes(rows) + [(str(k), None, None, None, sha) for k in (10, 11, 12)])
    assert [r[:4] for r in coded(spark, [(1, [1.0] * 15, 1), (2, [], 1)])] == [("1", None, None, None), ("2", None, None, None)]
    assert [r[1] for r in coded(spark, [(1, [1e30] * 16, 1)])] == [None]
    assert coded(spark, []) == [] and coded(spark, [(1, None, 1)]) == []
    with pytest.raises(ValueError):
        vector_codes.compressed(spark.createDataFrame([], VECTORS), vector_codes.Rule(entries=257))


def test_hot_label_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_IDS", 0)
    monkeypatch.setattr(joins, "HOT", 3)
    rows = [(k, [k / 7, 1.0] * 8, None if k % 2 else k) for k in range(30)]
    assert coded(spark, rows) == plain_codes(rows)


@pytest.mark.parametrize("most", [1, 255, 1 << 20, (1 << 28) - 1])
def test_products_by_limbs_are_exact(most):
    rng = np.random.default_rng(1)
    x, y = rng.integers(-most, most, (3, 40, 4), endpoint=True), rng.integers(-most, most, (3, 4, 9), endpoint=True)
    x[0, 0], y[0, :, 0] = most, -most
    want = np.array([[[sum(int(a) * int(b) for a, b in zip(r, c)) for c in m.T] for r in k] for k, m in zip(x, y)])
    assert (vector_codes.exact_products(x, y) == want).all()
    for terms in (1, 2, 3, 4, 64, 1000):
        assert terms << (2 * vector_codes.limb_bits(terms)) <= 1 << 53
    bits = vector_codes.limb_bits(4)
    assert len(vector_codes.limbs(x, bits)) == (2 if most >= 1 << bits else 1)
    # one product of doubles would not be exact here
    if most > 1 << 27:
        assert (np.matmul(x.astype(float), y.astype(float)).astype(np.int64) != want).any()


# 12


def plain_walk(edges, seeds, steps=20):
    """{host: (trust, distrust)} by dictionaries."""
    out = {}
    for kind, side in (("allow", 0), ("block", 1)):
        to = defaultdict(set)
        for s, d in edges:
            to[(s, d)[side]].add((s, d)[1 - side])
        own = [h for h, v in seeds.items() if v == kind]
        seed = {h: (1 << 50) // len(own) for h in own}
        rank = dict(seed)
        for _ in range(steps):
            new = Counter({h: v * 15 // 100 for h, v in seed.items()})
            for h, v in rank.items():
                for d in to[h]:
                    new[d] += v * 85 // (100 * len(to[h]))
            rank = new
        out[kind] = rank
    return {h: (out["allow"].get(h, 0), out["block"].get(h, 0)) for h in {*out["allow"], *out["block"]}}


PAGES = "page_id long, url string, html string, host string, rule int, verdict string, trust string, size int"


def judged(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "h", 1, "v", "t", 2) for r in rows], PAGES).repartition(3)
    out = url_rules.judged(df, **kw)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "trust", "distrust"]
    return {r.page_id: r for r in out.collect()}


def test_urls_and_rules(spark):
    cases = {
        None: ("", "", None), "": ("", "", None), "example.net/en/": ("", "", None), "http:/a.net/": ("", "", None),
        "http://A.Example.NET/en/x?y#z": ("a.example.net", "/en/x", "example.net/en/"),
        "https://example.net/EN/": ("example.net", "/EN/", "net/"),
        "http://net": ("net", "", None), "http://net/": ("net", "/", "net/"), "http://badnet/": ("badnet", "/", None),
        "x://b.example.com/de/": ("b.example.com", "/de/", "example.com/de/"), "x://myexample.com/de/": ("myexample.com", "/de/", None),
        "x://a.org/fr/q": ("a.org", "/fr/q", "org/fr/"), "x://a.org/fr": ("a.org", "/fr", None),
        "x://a.org?/fr/": ("a.org", "", None), "x://a.org#/fr/": ("a.org", "", None), "x://a.net:80/": ("a.net:80", "/", None),
        "x://ÄÖ.Net/": ("ÄÖ.net", "/", "net/"), "x://a/b://c/d": ("a", "/b://c/d", None), "x://\na.net/\nb?": ("\na.net", "/\nb", "net/"),
        "x:///p": ("", "/p", None), "http://" + "a." * 5000 + "net/" + "b" * 5000: ("a." * 5000 + "net", "/" + "b" * 5000, "net/"),
    }
    got = judged(spark, [(k, u, None) for k, u in enumerate(cases)])
    for k, (u, want) in enumerate(cases.items()):
        assert (got[k].host, got[k].path, got[k].rule) == want, u
        said = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
        assert want[2] is None or got[k].verdict == said[want[2]]
        assert want[0] or got[k].verdict == "allow"


@pytest.mark.parametrize("few,hub", [(1 << 20, 100_000), (-1, 2)])
def test_walk_over_links(spark, monkeypatch, few, hub):
    """Trust flows along links, distrust against them; ranks equal those of dictionaries, broadcast or shuffled."""
    monkeypatch.setattr(joins, "BROADCAST_IDS", few)
    monkeypatch.setattr(url_rules, "BROADCAST_IDS", few)
    monkeypatch.setattr(joins, "HOT", 3)
    link = '<a class=x HREF = "{}">t</a>'
    pages = [
        ("http://good.org/fr/1", ["https://friend.io/a", "//pal.io/b?c", "/own", "http://good.org/x"]),
        ("http://good.org/de/1", ["http://FRIEND.io"]),
        ("http://friend.io/", ["http://far.io/", "http://both.io/"]),
        ("http://spam.net/", ["http://target.io/"]),
        ("http://spam.net/2", ["http://good.org/", "http://unseen.io/x"]),
        ("http://booster.io/", ["http://spam.net/", "http://other.io"]),
        ("http://both.io/", ["http://spam.net/"]),
        ("http://www.booster.io/", []),
        ("http://mixed.net/", []), ("http://x.mixed.net/", []),
        ("http://half.example.net/en/", ["http://alone.io"]), ("http://half.example.net/de/", ["http://alone.io"]),
        ("http://alone.io/", []), ("nothing", ["http://spam.net/"]), (None, ["http://spam.net/"]),
    ]
    pages += [("http://hub.io/", [f"http://t{k}.io/" for k in range(9)])]
    pages += [(f"http://in{k}.io/", ["http://hub.io/"]) for k in range(5)] + [("http://hub.io/", ["http://spam.net/"])] * 4
    rows = [(k, u, "<p>" + "".join(link.format(t) for t in to)) for k, (u, to) in enumerate(pages)]
    got = judged(spark, rows, walk=url_rules.Walk(hub=hub))

    host = lambda u: u.split("://")[1].split("/")[0].lower() if "://" in (u or "") else ""
    edges, seen = set(), {host(u) for u, _ in pages} - {""}
    for u, to in pages:
        edges |= {(host(u), t.split("//")[1].split("/")[0].lower()) for t in to if "//" in t and host(u)}
    edges |= {e for h in seen if (p := h.partition(".")[2]) in seen for e in ((h, p), (p, h))}
    edges = {(s, d) for s, d in edges if s != d}
    votes = defaultdict(Counter)
    for r in got.values():
        if r.rule and r.host:
            votes[r.host][r.verdict] += 1
    seeds = {h: "allow" if c["allow"] > c["block"] else "block" for h, c in votes.items() if c["allow"] != c["block"]}
    want = plain_walk(edges, seeds)
    for r in got.values():
        assert (r.trust, r.distrust) == want.get(r.host, (0, 0)), r.host
    verdict = {r.host: r.verdict for r in got.values() if r.rule is None}
    assert verdict["friend.io"] == "allow" and verdict["booster.io"] == "block" and verdict["www.booster.io"] == "block"
    assert verdict["hub.io"] == "block" and verdict["alone.io"] == "allow" and verdict[""] == "allow"
    assert len(got) == len(pages)


def test_rules_of_an_empty_table_and_repeats(spark):
    assert judged(spark, []) == {}
    twice = [(1, "http://a.net/", "x")] * 3 + [(None, None, None)] * 2
    df = spark.createDataFrame([(*r, "h", 1, "v", "t", 2) for r in twice], PAGES)
    assert Counter((r.page_id, r.verdict) for r in url_rules.judged(df).collect()) == {(1, "block"): 3, (None, "allow"): 2}


def test_walk_is_native(spark):
    plan = queries.op12_url_rules(spark, SF)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_url_rules"])
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    sql = con.sql(queries.ORACLE_SQL[name])
    assert sorted(sql.columns) == sorted(df.columns)
    order = [sql.columns.index(c) for c in df.columns]
    assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(repr(tuple(r[i] for i in order)) for r in sql.fetchall())


# 13


def files():
    return queries.tokenizer_path("byte_bpe_50k.json"), queries.tokenizer_path("piece_bpe_32k.model")


def plain_alignment(texts):
    """All pairs of all tokens by their byte ranges, document by document."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(files()[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=files()[1])
    letters = token_alignment.byte_letters()
    docs = []
    for t in texts:
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        bx = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
        by = [bytes([int(p[3:5], 16)]) if len(p := b.id_to_piece(i)) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for i in y]
        if not t or b"".join(bx) != (" " + t).encode() or b"".join(by) != (" " + t).encode():
            docs.append(None)
            continue
        ends = lambda parts: [sum(map(len, parts[: k + 1])) for k in range(len(parts))]
        ex, ey = ends(bx), ends(by)
        cut = sorted(set(ex) & set(ey))
        groups = [([i for i, e in zip(x, ex) if lo < e <= hi], [i for i, e in zip(y, ey) if lo < e <= hi]) for lo, hi in zip([0, *cut], cut)]
        links = [(i, j) for i, e, p in zip(x, ex, bx) for j, f, q in zip(y, ey, by) if e - len(p) < f and f - len(q) < e]
        docs.append((x, y, groups, links))
    count = Counter(pair for d in docs if d for pair in set(d[3]))
    best = Counter()
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        x, y, groups, links = d
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        n_best = sum(count[p] == best[p[0]] for p in links)
        out.append((len(x), len(y), len(groups), len(links), n_best, sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


TEXTS = [
    None, "", " ", "  ", "a", "Hello  world", "tokenization of antidisestablishmentarianism", "<|endoftext|> and </s><s> <unk> <0x0A>",
    "line\nbreak\ttab\r\n  indented", "\u2581 marks \u2581", "na\u00efve caf\u00e9 \u00fcber stra\u00dfe", "cafe\u0301 \ufb01 \u2460 \uff21",
    "\U0001f600\U0001f468\u200d\U0001f469 \u4e2d\u6587\u5b57\u7b26 \u0431\u044b\u043b", "\x00\x01 control", "x" * 3000, "ab " * 700, "1234567890 3.14159 0xdeadbeef",
    "Hello  world", "the cat sat on the mat and the dog sat on the cat", "\u00a0nbsp\u3000wide", "trailing   ", "\ufeffbom",
]
DOCS = "doc_id long, text string, n_a int, row string, pairs int, links string, id int, pair int"


def align(spark, rows):
    df = spark.createDataFrame([(k, t, 1, "r", 2, "l", 3, 4) for k, t in rows], DOCS).repartition(3)
    out = token_alignment.alignment(df, *files())
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("most", [1 << 20, 40, 0])
def test_token_alignment(spark, monkeypatch, most):
    """The counts of few pairs are broadcast and the others shuffled, or all are, with the same result."""
    monkeypatch.setattr(token_alignment, "BROADCAST_PAIRS", most)
    monkeypatch.setattr(token_alignment, "GROUP_CHARS", 200)
    rng = random.Random(5)
    words = "the of and tokenizer Straße naïve don't x1 0.5 — “quote” unhappiness  \n".split(" ")
    texts = TEXTS + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    want = sorted(((k, *r) for k, r in enumerate(plain_alignment(texts))), key=repr)
    assert align(spark, list(enumerate(texts))) == want
    assert sum(r[1] > 0 for r in want) > 45 and any(r[1] == 0 for r in want)


def test_alignment_of_repeats_and_nothing(spark):
    rows = [(None, "one text"), (None, "one text"), (7, "one text"), (7, "another"), (8, None)]
    want = sorted(((k, *r) for (k, _), r in zip(rows, plain_alignment([t for _, t in rows]))), key=repr)
    assert align(spark, rows) == want
    assert align(spark, []) == [] and align(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_byte_level_encoder(tmp_path):
    """The same ids as the tokenizers library, character by character and on long runs; other files are left to it."""
    import json

    from tokenizers import Tokenizer

    a = Tokenizer.from_file(files()[0])
    a.encode_special_tokens = True
    encode = token_alignment.Aligner(*files()).encode_a
    chars = [chr(c) for c in (*range(0x3000), *range(0x3000, 0x110000, 61)) if not 0xD800 <= c < 0xE000]
    texts = [f" a{c}b1{c}2 {c}{c} .{c}'s{c} " for c in chars] + ["x" * 300_000, " " * 1_000_000, "\n " * 200_000 + "y", "", "<|endoftext|>"]
    assert encode(texts) == [x.ids for x in a.encode_batch(texts, add_special_tokens=False)]
    with open(files()[0], encoding="utf-8") as f:
        file = json.load(f)
    file["model"]["merges"][5:7] = file["model"]["merges"][6:4:-1]
    other = tmp_path / "other.json"
    other.write_text(json.dumps(file), encoding="utf-8")
    assert token_alignment.ranked_encoder(str(other)) is None
    assert token_alignment.ranked_encoder(queries.tokenizer_path("word_bpe_49k.json")) is None


def test_windows_are_kept(monkeypatch):
    """Windows of equal ids are aligned once, and again after the kept ones were dropped; joined windows are the whole."""
    tool = token_alignment.Aligner(*files())
    text = "unhappily aligned tokenizers misalign unhappily aligned " * 200
    (a, b), = tool.tokens([text])
    (windows,) = tool.align([(a, b)])
    assert tool.windows == len(windows) > 500 and tool.fresh < 20
    text, groups, pairs = b";".join(w.text for w in windows), sum(w.groups for w in windows), b"".join(w.pairs for w in windows)
    assert len(pairs) // 8 == len(a) + len(b) - groups and text.count(b"|") == groups
    assert [int(x) for x in text.replace(b"|", b",").replace(b";", b",").split(b",")].count(a[0]) >= a.count(a[0])
    distinct, links = token_alignment.totals(windows)
    assert (np.diff(distinct) > 0).all() and links.sum() == len(pairs) // 8
    monkeypatch.setattr(token_alignment, "KEPT", 20_000)
    tool.release()
    (again,) = tool.align([(a, b)])
    assert [w.text for w in again] == [w.text for w in windows] and tool.kept.size <= 10_000


def test_alignment_of_a_long_text(spark):
    text = ("word " * 200_000) + "y" * 200_000
    (row,) = align(spark, [(1, text)])
    assert row[1] > 200_000 and row[4] == row[1] + row[2] - row[3]


def test_whole_table_alignment(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = df.where(F.length("text") < 3000).collect()
    want = sorted((r.doc_id, *p) for r, p in zip(rows, plain_alignment([r.text for r in rows])))
    got = token_alignment.alignment(df.where(F.length("text") < 3000), *files())
    assert sorted(map(tuple, got.collect())) == want
