"""N-gram Jaccard join: size-banded tiles, hashed bitmap signatures, exact sorted-array intersection.

1. Each text becomes a sorted array of distinct word-shingle hashes.  Equal sets (copies) are
   collapsed to the smallest id by a pre-aggregated group, so a group of copies costs one row.
2. Sizes fall into bands, geometric in the set size; a set belongs to the tile of its band, and to
   the tile below if it can link with a set there.  Within a tile the hash space is cut into more
   ranges than linked sets can differ in, so linked sets agree on all hashes of at least one
   range (pigeonhole; no link is lost).  The tile key is band, range and the sum of its hashes.
3. Sets that share a tile key are gathered under the smallest id of the tile, once for all tiles that
   it leads.  Leaders come from an aggregate that combines before its shuffle, and members find
   theirs by a join that treats hot tiles apart, so no task holds a hot tile.  Pairs are compared by
   parity bitmaps: differing bits bound the symmetric difference from below, hence the overlap from
   above.
4. Pairs that pass are verified by intersecting the sorted arrays.  First members are paired with
   their leader only; sets so linked form components, and a group is done when all of its members but
   the leader are in one.  Large groups that are not done repeat this with the least ids of their
   largest components (of equal ones by hash) as leaders while that helps, so near copies do not make their square in pairs.
5. What remains is compared exhaustively, members of different components only, large groups in
   pairs of blocks that are dealt over the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .joins import BROADCAST_IDS as BROADCAST_IDS
from .joins import dealt, few, with_values
from .shingles import U, mix, shingle_sets
from .tables import materialize, scratch

#: Groups of more members get rounds of so many new leaders, as long as a round leaves at most this share of their rows.
SMALL, LEADERS, HELPS = 64, 8, 0.75
#: Members of a large group are compared in pairs of blocks; there are up to PARTS blocks of BLOCK members or
#: more, and more blocks than that once they would have MOST members.
BLOCK, PARTS, MOST = 128, 64, 2048


@dataclass(frozen=True)
class Rule:
    """Sets of `width`-word shingles link when den * intersection >= num * union."""

    width: int = 3
    num: int = 90
    den: int = 100
    ratio: float = 1.5

    def differing(self, size: int) -> int:
        """Largest symmetric difference of a set of at most `size` hashes and a linked, larger one."""
        return size * (self.den - self.num) // self.num

    def edges(self, largest: int) -> np.ndarray:
        """Lower ends of the bands; smaller sets link with equal sets only."""
        at = [-(-self.num // max(self.den - self.num, 1))]
        while at[-1] <= largest:
            at.append(max(at[-1] + 1, int(at[-1] * max(self.ratio, 1.2 * self.den / self.num))))
        return np.array([*at, at[-1] * 2])

    def ranges(self, edges: np.ndarray, band: int) -> tuple[int, int]:
        d = self.differing(int(edges[band + 1]) - 1)
        return d, d + 4 + (d // 4 if self.den < 10 * (self.den - self.num) else d // 20)

    def links(self, n: int, m: int, common: int) -> bool:
        return self.den * common >= self.num * (n + m - common)


def bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the hashes in each of w positions, w the power of two from twice the size, 64 at least."""
    w = max(64, 1 << max(0, (2 * len(hashes) - 1).bit_length()))
    odd = np.bincount((mix(hashes) & U(w - 1)).astype(np.int64), minlength=w) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _fold(bits: np.ndarray, to: int) -> np.ndarray:
    while len(bits) > to:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _tile_keys(hashes: np.ndarray, at: np.ndarray, rule: Rule, edges: np.ndarray) -> list[np.ndarray]:
    """The tile keys of each set of a group."""
    n = np.diff(at)
    band = np.searchsorted(edges, n, "right") - 1
    down = (band > 0) & (n * rule.num <= (edges[np.maximum(band, 0)] - 1) * rule.den)
    out: list[list[np.ndarray]] = [[] for _ in n]
    mixed = mix(hashes)
    for lower in (0, 1):
        use = np.flatnonzero(down if lower else band >= 0)
        if not len(use):
            continue
        tile = band[use] - lower
        limits = {int(b): rule.ranges(edges, int(b)) for b in np.unique(tile)}
        differ = np.array([limits[int(b)][0] for b in tile])
        parts = np.array([limits[int(b)][1] for b in tile])
        size = n[use]
        row = np.repeat(np.arange(len(use)), size)
        pick = np.repeat(at[use] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())
        where = ((hashes[pick] >> U(32)) * parts[row].astype(U)) >> U(32)
        first = np.ones(len(row), bool)
        first[1:] = (where[1:] != where[:-1]) | (row[1:] != row[:-1])
        start = np.flatnonzero(first)
        seed = mix(tile[row[start]].astype(U) * U(1 << 32) + where[start])
        keys = mix(seed + np.add.reduceat(mixed[pick], start)).astype(np.int64)
        cut = np.searchsorted(row[start], np.arange(len(use) + 1))
        for k, d in enumerate(use):
            out[d].append(keys[cut[k] : cut[k + 1]])
            if cut[k + 1] - cut[k] <= differ[k]:  # it may agree with another set on empty ranges alone
                empty = np.setdiff1d(np.arange(parts[k]).astype(U), where[start[cut[k] : cut[k + 1]]])
                out[d].append(mix(mix(U(int(tile[k])) * U(1 << 32) + empty)).astype(np.int64))
    return [np.concatenate(x) if x else np.empty(0, np.int64) for x in out]


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays) if arrays else [], kind))


def _sign(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = rule.edges(1 << 20)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, hashes, at in shingle_sets(texts, rule.width):
                n = np.diff(at)
                if len(n) and n.max() >= edges[-2]:
                    edges = rule.edges(int(n.max()))
                mixed = np.concatenate((np.zeros(1, U), np.cumsum(mix(hashes))))
                again = np.concatenate((np.zeros(1, U), np.cumsum(mix(hashes * U(0x9E3779B97F4A7C15) + U(1)))))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(first, len(n)).cast(pa.int64()),
                        pa.array(n.astype(np.int64)),
                        pa.array((mixed[at[1:]] - mixed[at[:-1]]).astype(np.int64)),
                        pa.array((again[at[1:]] - again[at[:-1]]).astype(np.int64)),
                        _lists(_tile_keys(hashes, at, rule, edges), pa.int64()),
                        pa.array([bitmap(hashes[a:b]) for a, b in zip(at[:-1], at[1:])], pa.binary()),
                    ],
                    ["id", "n", "d1", "d2", "keys", "bits"],
                )

    return run


def _bound(rule: Rule, n: np.ndarray, m: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Whether sets of n and m hashes may link if at least `differ` hashes are in one of them only."""
    common = np.minimum((n + m - differ) // 2, np.minimum(n, m))
    return rule.den * common >= rule.num * (n + m - common)


def _pass_bound(rule: Rule):
    """Of members with the heads of their group: the pairs of different components that the bitmaps allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for me, n, comp, bits, heads in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "comp", "bits", "heads"))):
                bits = np.frombuffer(bits, np.uint8)
                for h in heads:
                    if h["own"] == comp or h["head"] == me:
                        continue
                    other = np.frombuffer(h["bits"], np.uint8)
                    w = min(len(bits), len(other))
                    differ = int(np.bitwise_count(_fold(bits, w) ^ _fold(other, w)).sum())
                    if _bound(rule, n, h["n"], differ):
                        found.append((min(me, h["head"]), max(me, h["head"])))
            pairs = np.array(found, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def _cross(rule: Rule):
    """Of rows sorted by key and cell: the pairs in different components (and of different sides, if the
    cell has two) that the bitmaps allow."""

    def group(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        ids, n, comp, side, bits = (np.concatenate(x) for x in zip(*rows))
        if (comp == comp[0]).all():
            return
        width = np.array([len(x) for x in bits])
        order = np.argsort(width, kind="stable")
        ids, n, comp, side, bits, width = ids[order], n[order], comp[order], side[order], bits[order], width[order]
        for w in np.unique(width):  # a pair is compared at the smaller of its two widths
            start, end = np.searchsorted(width, [w, w + 1])
            m = np.vstack([_fold(np.frombuffer(x, np.uint8), w) for x in bits[start:]]).view(np.uint64)
            for i in range(start, end):
                other = (comp[i + 1 :] != comp[i]) & ((side[i + 1 :] != side[i]) | (side[i] < 0))
                ok = np.flatnonzero(other & _bound(rule, n[i + 1 :], n[i], np.zeros(1, np.int64))) + i + 1
                if len(ok):
                    differ = np.bitwise_count(m[ok - start] ^ m[i - start]).sum(1, dtype=np.int64)
                    ok = ok[_bound(rule, n[ok], n[i], differ)]
                if len(ok):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[ok], ids[i])), pa.array(np.maximum(ids[ok], ids[i]))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []
        for b in batches:
            for r in range(b.num_rows):
                key, cell, side = (b.column(c)[r].as_py() for c in range(3))
                if rows and (key, cell) != last:
                    yield from group(rows)
                    rows = []
                last, members = (key, cell), b.column(3).slice(r, 1).flatten()
                bits = np.empty(len(members), object)
                bits[:] = members.field("bits").to_pylist()
                ids, n, comp = (members.field(c).to_numpy() for c in ("id", "n", "comp"))
                rows.append([ids, n, comp, np.full(len(ids), side), bits])
        if rows:
            yield from group(rows)

    return run


def _set_rows(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for first, hashes, at in shingle_sets(texts, rule.width):
                sets = [hashes[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(sets)).cast(pa.int64()), pa.array(sets, pa.binary())], ["id", "hashes"])

    return run


def _exact(rule: Rule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x, y = (np.frombuffer(b.column(c)[i].as_py(), U) for c in (2, 3))
                both = np.concatenate((x, y))
                both.sort()
                keep[i] = rule.links(len(x), len(y), int((both[1:] == both[:-1]).sum()))
            yield b.select(["a", "b"]).filter(pa.array(keep))

    return run


def _led(reps: DataFrame) -> DataFrame:
    """(leader, id): who shares a tile with whom, each tile under its least id; reps: id, keys."""
    rows = reps.select(F.explode("keys").alias("key"), "id")
    tiles = rows.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last"), F.count("*").alias("size"))
    tiles = materialize(tiles.where("leader < last"), "tiles")
    # two members stand in the aggregate itself; only larger tiles are joined back
    pairs = tiles.where("size = 2").select("leader", F.explode(F.array("leader", "last")).alias("id"))
    large = with_values(rows, tiles.where("size > 2").select("key", "leader", "size"), ["key"])
    return materialize(pairs.union(large.where("leader is not null").select("leader", "id")).distinct(), "led")


def _verified(pairs: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Those of `pairs` whose sets link, by intersecting the sets themselves."""
    ids = materialize(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ids")
    wanted = docs.join(few(ids), "id", "left_semi")
    sets = materialize(wanted.mapInArrow(_set_rows(rule), "id long, hashes binary"), "sets")
    # the leader of a large group is an end of many pairs
    both = dealt(pairs, sets.toDF("a", "x"), "a", pairs)
    both = dealt(both, sets.toDF("b", "y"), "b", pairs).select("a", "b", "x", "y")
    return materialize(both.mapInArrow(_exact(rule), "a long, b long").distinct(), "linked")


def _met(members: DataFrame, heads: DataFrame, bits: DataFrame, rule: Rule) -> DataFrame:
    """Pairs (a, b) of members (key, id, comp) with the heads (key, own, head) of their group's other components
    that the bitmaps allow.  A group's few heads come to its members as one array, large groups in parts."""
    of_head = heads.join(bits.withColumnRenamed("id", "head"), "head")
    packed = of_head.groupBy("key").agg(F.collect_list(F.struct("own", "head", "n", "bits")).alias("heads"))
    rows = dealt(members.select("key", "id", "comp").join(bits, "id"), packed, "key", members)
    return materialize(rows.select("id", "n", "comp", "bits", "heads").mapInArrow(_pass_bound(rule), "a long, b long").distinct(), "star")


def _open(rest: DataFrame, found: DataFrame) -> DataFrame:
    """Rows key, id, comp, size of the groups whose members are of two components or more."""
    tagged = materialize(rest.select("key", "id").join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("comp")), "tagged")
    size = tagged.groupBy("key").agg(F.count("*").alias("size"), F.min("comp").alias("least"), F.max("comp").alias("most"))
    size = materialize(size.where("least < most").select("key", "size"), "open")
    return materialize(tagged.join(few(size), "key"), "rest")


def _cells(rest: DataFrame, bits: DataFrame) -> DataFrame:
    """The blocks of each group, packed into one row each, once for each pair of blocks that they take part
    in: key, cell, side (0 and 1 for the blocks of a pair, -1 if it is one block with itself), members."""
    block = F.least(F.greatest(F.lit(float(BLOCK)), F.col("size") / PARTS), F.lit(float(MOST)))
    parts = F.ceil(F.col("size") / block).cast("long")
    rows = rest.select("key", "id", "comp", parts.alias("parts")).join(bits, "id")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "key"), F.col("parts")))
    packed = rows.groupBy("key", "parts", "block").agg(F.collect_list(F.struct("id", "n", "comp", "bits")).alias("members"))
    packed = packed.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    cell = F.least("block", "with") * F.col("parts") + F.greatest("block", "with")
    side = F.when(F.col("block") == F.col("with"), -1).when(F.col("block") < F.col("with"), 0).otherwise(1)
    return packed.select("key", cell.alias("cell"), side.cast("long").alias("side"), "members")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id (smallest id reachable by links).

    Null and empty texts and texts without words have no shingles and link with nothing; a row
    with a null id keeps a null component.  A repeated id is one node of the links: rows that share
    it link by any of their texts.  Other columns of `docs` are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    with scratch(docs.sparkSession) as stays:
        return stays(_components(docs, rule), "components").toDF(id_col, "n_shingles", "component_id")


def _components(docs: DataFrame, rule: Rule) -> DataFrame:
    sigs = materialize(docs.mapInArrow(_sign(rule), "id long, n long, d1 long, d2 long, keys array<long>, bits binary"), "signatures")
    known = sigs.where("id is not null and n > 0")
    same = ["n", "d1", "d2"]
    groups = known.groupBy(*same).agg(F.min("id").alias("rep"), F.count("*").alias("size")).where("size > 1")
    groups = materialize(groups, "copies")

    reps = with_values(known.where("size(keys) > 0"), groups, same).where("rep is null or rep = id").select("id", "n", "keys", "bits")
    led = _led(reps)
    members = materialize(led.select("id").distinct(), "members")
    bits = materialize(reps.join(few(members), "id", "left_semi").select("id", "n", "bits").distinct(), "bits")

    leaders = led.select(F.col("leader").alias("key"), F.col("leader").alias("own"), F.col("leader").alias("head")).distinct()
    star = led.where("id <> leader").select(F.col("leader").alias("key"), "id", F.col("id").alias("comp"))
    done = _met(star, leaders, bits, rule)
    links = _verified(done, docs, rule)
    found = components(links)

    # a leader has met all others of its group, so it takes no further part there
    rest = _open(led.where("id <> leader").withColumnRenamed("leader", "key"), found)
    before = None
    while (n := rest.where(F.col("size") > SMALL).count()) and (before is None or n <= HELPS * before):
        before, large = n, rest.where(F.col("size") > SMALL)
        heads = _heads(large)
        pairs = materialize(_met(large, heads, bits, rule).join(done, ["a", "b"], "left_anti"), "new")
        done, links = done.union(pairs), links.union(_verified(pairs, docs, rule))
        found = components(links)
        led_by = heads.select("key", F.col("head").alias("id"))
        rest = _open(rest.join(few(led_by), ["key", "id"], "left_anti"), found)

    cross = _cells(rest, bits).repartition("key", "cell").sortWithinPartitions("key", "cell").mapInArrow(_cross(rule), "a long, b long")
    cross = materialize(cross.distinct().join(done, ["a", "b"], "left_anti"), "cross")
    more = _verified(cross, docs, rule)
    if not more.isEmpty():
        found = components(links.union(more))
    return _labelled(sigs, groups, found)


def _heads(large: DataFrame) -> DataFrame:
    """(key, own, head): the least ids of the largest components of each group, LEADERS of them."""
    order = Window.partitionBy("key").orderBy(F.desc("n"), F.xxhash64("head"))
    heads = large.groupBy("key", "comp").agg(F.min("id").alias("head"), F.count("*").alias("n"))
    heads = heads.withColumn("place", F.row_number().over(order)).where(F.col("place") <= LEADERS)
    return materialize(heads.select("key", F.col("comp").alias("own"), "head"), "heads")


def _labelled(sigs: DataFrame, groups: DataFrame, found: DataFrame) -> DataFrame:
    """(id, n, component) of every row: that of its group of copies, else that of its id, else its id."""
    rep = groups.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    named = materialize(rep.select("n", "d1", "d2", "size", F.coalesce("component", "rep").alias("of_copies")), "named")
    rows = with_values(sigs.where("id is not null and n > 0").select("id", "n", "d1", "d2"), named, ["n", "d1", "d2"])
    single = rows.where("of_copies is null").select("id", "n").join(few(found), "id", "left")
    single = single.select("id", "n", F.coalesce("component", "id"))
    without = sigs.where("id is null or n = 0").select("id", "n", F.col("id"))
    return rows.where("of_copies is not null").select("id", "n", "of_copies").union(single).union(without)
