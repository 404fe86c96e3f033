"""Pairs of large tag sets, places, folded slots, answers and warehouse findings on small tables."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larkspur.operators import dialog, marts, places, quality, silver


@pytest.mark.parametrize("paired", [256, 3])
def test_pairs_of_tag_sets(spark, monkeypatch, paired):
    """Equal sets count once with their number; sets beyond a block are paired block by block."""
    monkeypatch.setattr(marts, "PAIRED", paired)
    rng = random.Random(1)
    sets = {i: {f"t{rng.randint(0, 12)}" for _ in range(rng.randint(0, 10))} for i in range(40)} | {100 + i: {"a", "b"} for i in range(9)} | {200: {f"t{k}" for k in range(13)}}
    rows = [(i, t) for i, s in sets.items() for t in s] + [(1, None), (100, "a")]
    got = {(r.tag_a, r.tag_b): (r.items_with_a, r.together) for r in marts.tag_pairs(spark.createDataFrame(rows, "item long, tag string")).collect()}
    n = Counter(t for s in sets.values() for t in s)
    both = Counter(p for s in sets.values() for p in itertools.permutations([t for t in s if n[t] >= 2], 2))
    assert got == {(a, b): (n[a], k) for (a, b), k in both.items()}


def test_a_set_of_many_tags_is_spread(spark):
    """The pairs of one item's 20,000 tags are dealt by blocks: about as many partitions as there are have work."""
    tags = spark.range(1).select(F.lit(1).alias("item"), F.explode(F.transform(F.sequence(F.lit(0), F.lit(1999)), lambda k: F.concat(F.lit("t"), k.cast("string")))).alias("tag"))
    assert marts.tag_pairs(tags, 1).count() == 2000 * 1999


@pytest.mark.parametrize("n", [0, 1, 500])
def test_places(spark, n):
    rng = random.Random(n)
    rows = [(k, rng.choice([None, 1, 2, 2, 2, 3]), rng.choice(["a", "B", None])) for k in range(n)]
    df = spark.createDataFrame(rows, "k long, v int, s string").repartition(5)
    got = {r.place: r.k for r in places.with_place(df, [F.desc_nulls_last("v"), F.asc_nulls_first("s"), "k"]).collect()}
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2] is not None, r[2] or "", r[0]))
    assert got == {i + 1: r[0] for i, r in enumerate(want)}


def test_directory_places(spark):
    rows = [(1, "B", "x"), (2, None, "a"), (3, "A", "b"), (4, "A", "B"), (5, "A", None)]
    got = silver.directory_places(spark.createDataFrame(rows, "k long, letter string, name string"), "letter", "name", "k")
    assert [r.k for r in got.orderBy("place").collect()] == [5, 3, 4, 1, 2]


def test_folded_slots(spark):
    """The fold against all that was said, with blanks, long texts, nulls and several conversations."""
    rng = random.Random(3)
    rows = []
    for conv in (1, 2, 3, None):
        for turn in range(25):
            text = rng.choice([None, "", "  ", " a ", "word", "x" * rng.randint(1, 150), "tail   "])
            rows.append((conv, turn, rng.choice(["new", "refine", "refine", "refine", "about"]), rng.choice([None, [], ["t1"], ["t1", "t2"], ["t3"]]), rng.choice([None, ["a"]]), rng.choice([None, [], ["winter"], ["day"]]), rng.choice([None, "Nam"]), text, turn))
    df = spark.createDataFrame(rows, "conv_id long, turn int, action string, tags array<string>, attributes array<string>, axes array<string>, gender string, text string, min_votes int").repartition(4)
    want = {}
    for conv in (1, 2, 3, None):
        segment, so_far = 0, []
        for r in (r for r in rows if r[0] == conv and r[2] != "about"):
            if r[2] == "new":
                segment, so_far = segment + 1, []
            so_far.append(r)
            flat = lambda c: list(dict.fromkeys(t for x in so_far for t in x[c] or ()))  # noqa: E731, B023
            last = lambda c: next((x[c] for x in reversed(so_far) if x[c]), None)  # noqa: E731, B023
            text = " ".join(x[7] for x in so_far if x[7]).strip(" ")[:300]
            want[conv, r[1]] = (segment, flat(3), flat(4), last(5), last(6), text or None, so_far[0][8])
    got = {(r.conv_id, r.turn): (r.segment, r.tags, r.attributes, r.axes, r.gender, r.text, r.min_votes) for r in dialog.merged(df).collect()}
    assert got == want
    assert dialog.merged(df.limit(0)).count() == 0


def test_answers_of_other_kinds(spark):
    why = [("note", "oud"), ("occ", "winter"), ("str", "longevity"), ("note", "x")]
    seeds = [(1, "Oud", "H", 4.25, 1200, why), (2, None, "", None, None, None), (3, "B", None, 3.0, 20, []), (4, "C", "G", 4.0, 0, None)]
    df = spark.createDataFrame(seeds, "query int, name string, grp string, rating double, votes long, reasons array<struct<block:string,label:string>>")
    near = spark.createDataFrame([(1, 2, "Q"), (1, 1, "P"), (1, 3, "R"), (3, 1, None), (3, 2, "Z")], "query int, rank int, name string")
    got = {r.query: r.answer for r in dialog.answers_about(df, near).collect()}
    assert got[1] == "Oud của H thì note oud, hợp mùa lạnh, lưu hương lâu. Có 1.200 lượt đánh giá, trung bình 4.25/5. Gần nó nhất là P và Q. Bạn muốn mình so hai chai này không?"
    assert got[2] == "chai này thì mình chưa có đủ dữ liệu về mùi của nó. Bạn muốn mình so hai chai này không?"
    assert "Mới 20 lượt đánh giá nên điểm 3.00/5 chưa chắc chắn. Gần nó nhất là Z." in got[3] and "lượt" not in got[4]
    shown = dialog.answers_exhausted(near)
    assert {r.query: r.answer[:70] for r in shown.collect()}[1].endswith("ngoài P, Q,") or "ngoài P, Q, R đã gợi" in {r.query: r.answer for r in shown.collect()}[1]


def test_drift_of_a_warehouse(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/good")
    spark.range(3).selectExpr("id", "cast(id as string) as v").write.parquet(f"{root}/late")
    spark.range(3).write.mode("append").parquet(f"{root}/late")
    spark.range(3).write.parquet(f"{root}/mixed")
    spark.range(3).selectExpr("cast(id as string) as id").write.mode("append").parquet(f"{root}/mixed")
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "a.parquet").write_bytes(b"no parquet")
    want = {name: StructType.fromDDL(ddl) for name, ddl in {"good": "id bigint", "late": "id bigint, v string", "mixed": "id bigint", "broken": "id bigint", "none": "id bigint"}.items()}
    got = sorted(map(tuple, quality.warehouse_drift(spark, root, want).collect()))
    assert [g[0] for g in got] == ["broken", "mixed", "none"] and all(g[1] == "" for g in got)
    assert quality.warehouse_drift(spark, root, {"good": want["good"]}).count() == 0


def test_stale_tables(spark, tmp_path):
    import os

    for k, name in enumerate(("source", "mart", "part=1", "odd")):
        folder = tmp_path / ("fact/" + name if "=" in name else name)
        spark.range(1).coalesce(1).write.parquet(str(folder))
        for f in folder.glob("*.parquet"):
            os.utime(f, (1_700_000_000 + 100 * k,) * 2)
    of = {"mart": ["source", "fact"], "fact": ["source"], "none": ["source", "lost"]}
    assert sorted(map(tuple, quality.stale_tables(spark, str(tmp_path), of).collect())) == [("mart", "fact"), ("none", "source")]
    assert {r.table: r.files for r in quality.file_times(spark, str(tmp_path)).collect()} == {"source": 1, "mart": 1, "fact": 1, "odd": 1}
