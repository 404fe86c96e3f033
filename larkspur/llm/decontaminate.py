"""Benchmark decontamination by q-gram lemma filtering.

A passage within e edits of an item of m characters keeps at least m + 1 - q (e + 1) of its
q-grams, and all of them on at most e + 1 neighbouring diagonals (text position minus item
position).  Per document, q-grams shared with the items are counted in overlapping bands of
diagonals; bands that reach the bound are verified by a banded alignment.  Edits are one in ten
characters of an item, whatever its length, and q is shorter for short items, so that the lemma's bound
stays above zero.  Passages are whole words.  Texts are compared with each letter lower-cased by itself
and white-space runs as one space.  Nothing is shuffled:
documents are only mapped, against one block of the items at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .shingles import U
from .tables import materialize

#: Items are handled in blocks of about so many characters, which bounds what tasks receive.
BLOCK_CHARS = 2_000_000
_SPACES = np.array([*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000], np.uint32)
_IS_SPACE = np.zeros(1 << 16, bool)
_IS_SPACE[_SPACES] = True
#: Texts are searched in pieces of about so many characters, with at most about so many shared q-grams each.
_PIECE, _MOST_HITS = 1 << 16, 1 << 22
_BIG = 1 << 20
_SPREAD = U(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Budget:
    """q-gram length at most, edits allowed per item character, and whether passages are whole words.

    One rule for every length: the edits follow the length, and so do the q-grams, which are as long as the
    edits leave some of them whole in any passage.
    """

    q: int = 8
    rate: float = 0.1
    words: bool = True

    def edits(self, m: int) -> int:
        return int(self.rate * m)

    def gram(self, m: int) -> int:
        """Length of an item's q-grams: m + 1 - q (e + 1) of them stay at least, which is one or more."""
        return max(1, min(self.q, m // (self.edits(m) + 1)))


def folded(text: str) -> str:
    """Each letter in lower case by itself, whatever stands around it; İ, whose small form has two
    characters, stays."""
    return "İ".join(part.replace("Σ", "σ").lower() for part in text.split("İ"))


def normalized(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Folded code points with white-space runs as one space, and each one's offset in the text."""
    a = np.frombuffer(folded(text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    space = _IS_SPACE[np.minimum(a, 0xFFFF)]
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    keep[:1] = True
    at = np.flatnonzero(keep)
    return np.where(space[at], 32, a[at]).astype(np.uint32), at


def stripped(text: str | None) -> np.ndarray:
    """Normalized code points without white space at the ends."""
    a = normalized(text)[0]
    start, end = int(len(a) > 0 and a[0] == 32), len(a) - int(len(a) > 1 and a[-1] == 32)
    return a[start:end]


def _grams(a: np.ndarray, q: int) -> np.ndarray:
    if len(a) < q:
        return np.empty(0, U)
    h, size, step = a.astype(U) + U(0x9E3779B97F4A7C15), 1, 0xD1342543DE82EF95
    power, out, have = step, None, 0
    while True:  # polynomial hashes of 1, 2, 4, ... characters, put together to q
        if q & size:
            out = h if out is None else out[: len(a) - q + 1] * U(power) + h[have : have + len(a) - q + 1]
            have += size
        if 2 * size > q:
            break
        h = h[: len(h) - size] * U(power) + h[size:]
        size, power = 2 * size, power * power % (1 << 64)
    return out[: len(a) - q + 1]


class Block:
    """A block of items, and the search for them in texts."""

    def __init__(self, items: list[Row], budget: Budget):
        self.budget, self.ids, self.text = budget, [], []
        by_q: dict[int, list[int]] = {}
        for item_id, text in sorted(items, key=lambda r: (str(r[0]), r[1] or "")):
            a = stripped(text)
            if len(a):
                by_q.setdefault(budget.gram(len(a)), []).append(len(self.ids))
                self.ids.append(item_id)
                self.text.append(a)
        self.parts = [_Part(q, of, [self.text[k] for k in of], budget) for q, of in sorted(by_q.items())]

    def find(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, start, end, edits, shared q-grams) of each passage of an item in each text."""
        found = []
        for n, text in enumerate(texts):
            if text:
                a, at = normalized(text)
                for part in self.parts:
                    if len(a) >= part.q:
                        found += part.places(n, a, at)
        places, found = found, []
        for k in range(0, len(places), 256):
            for part in self.parts:
                found += part.aligned([p[1:] for p in places[k : k + 256] if p[0] is part])
        best: dict[tuple[int, int, int], tuple] = {}
        for x in found:  # overlapping bands find one passage twice
            key = (x[0], x[1], x[3])
            if key not in best or x[4] < best[key][4]:
                best[key] = x
        return sorted(best.values())


class _Part:
    """The items of a block that are searched by grams of one length."""

    def __init__(self, q: int, numbers: list[int], texts: list[np.ndarray], budget: Budget):
        self.q, self.numbers, self.text, self.words = q, numbers, texts, budget.words
        self.m = np.array([len(a) for a in texts], np.int64)
        self.e = np.array([budget.edits(m) for m in self.m], np.int64)
        self.need = self.m + 1 - q * (self.e + 1)
        grams = [_grams(a, q) for a in texts]
        h = np.concatenate(grams)
        order = np.argsort(h, kind="stable")
        self.item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order].astype(np.int64)
        self.pos = np.concatenate([np.arange(len(g)) for g in grams])[order]
        self.h, first = np.unique(h[order], return_index=True)
        self.first = np.append(first, len(h)).astype(np.int64)
        self.shift = U(64 - 22)
        self.seen = np.zeros(1 << 22, bool)
        self.seen[self.h * _SPREAD >> self.shift] = True

    def _pieces(self, a: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Text positions and gram numbers of the shared q-grams, piece by piece.

        Pieces overlap by the longest passage, so each passage lies in one whole.
        """
        over = int((self.m + 2 * self.e).max()) + self.q
        where, which = [], []
        for at in range(0, len(a) - self.q + 1, _PIECE):
            h = _grams(a[at : at + _PIECE + self.q - 1], self.q)
            maybe = np.flatnonzero(self.seen[h * _SPREAD >> self.shift])
            k = np.minimum(np.searchsorted(self.h, h[maybe]), len(self.h) - 1)
            ok = self.h[k] == h[maybe]
            where.append(maybe[ok] + at)
            which.append(k[ok])
        where, which = np.concatenate(where), np.concatenate(which)
        weight = np.cumsum(self.first[which + 1] - self.first[which])
        start = 0
        while start < len(where):
            before = weight[start - 1] if start else 0
            end = int(np.searchsorted(weight, before + _MOST_HITS, "right"))
            end = max(end, int(np.searchsorted(where, where[start] + 2 * over)))
            yield where[start:end], which[start:end]
            if end >= len(where):
                break
            start = max(start + 1, int(np.searchsorted(where, where[end] - over)))

    def _hits(self, where: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, item position and text position of every shared q-gram of a piece."""
        n = self.first[which + 1] - self.first[which]
        entry = np.repeat(self.first[which] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return self.item[entry], self.pos[entry], np.repeat(where, n)

    def bands(self, where: np.ndarray, which: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, least diagonal, largest diagonal, shared q-grams) of the bands that reach the bound."""
        item, i, j = self._hits(where, which)
        enough = np.bincount(item, minlength=len(self.m)) >= self.need
        keep = enough[item]
        if not keep.any():
            return
        item, i, d = item[keep], i[keep], (j - i)[keep]
        step = np.maximum(self.e[item], 8)
        b = d // step
        item, i, b = np.tile(item, 2), np.tile(i, 2), np.concatenate((b, b - 1))
        low = int(b.min())
        span = int(b.max()) - low + 1
        width = int(self.m.max()) + 1
        key = np.unique((item * span + (b - low)) * width + i) // width  # each item position counts once in a band
        band, count = np.unique(key, return_counts=True)
        of, b = band // span, band % span + low
        for k in np.flatnonzero(count >= self.need[of]):
            t, s = int(of[k]), max(int(self.e[of[k]]), 8)
            yield t, int(b[k]) * s, int(b[k] + 2) * s, int(count[k])

    def places(self, n: int, a: np.ndarray, at: np.ndarray) -> Iterator[tuple]:
        """(part, text, item, least and largest diagonal, shared q-grams, text, offsets) to be aligned."""
        for where, which in self._pieces(a):
            merged: list[list[int]] = []
            for t, lo, hi, count in self.bands(where, which):
                if not self.e[t]:  # without edits: each diagonal of the band by itself
                    yield from ((self, n, t, d, d, count, a, at) for d in self._exact(t, lo, hi, a))
                elif merged and merged[-1][0] == t and lo <= merged[-1][2] and hi - merged[-1][1] <= 6 * max(int(self.e[t]), 8):
                    merged[-1][2:] = [hi, max(merged[-1][3], count)]
                else:
                    merged.append([t, lo, hi, count])
            yield from ((self, n, t, lo - int(self.e[t]), hi + int(self.e[t]), count, a, at) for t, lo, hi, count in merged)

    def _exact(self, t: int, lo: int, hi: int, a: np.ndarray) -> list[int]:
        """Where an item stands in the text without an edit, of the places lo to hi."""
        item = self.text[t]
        return [d for d in range(max(0, lo), min(hi, len(a) - len(item)) + 1) if np.array_equal(a[d : d + len(item)], item)]

    def _whole_words(self, a: np.ndarray, first: int, end: int, edits: int) -> bool:
        """Whether the passage ends at words' ends, or no further from them than two alignments within the edits can
        end from each other."""
        return not self.words or all(_to_word_end(a, at, 2 * edits) <= 2 * edits for at in (first, end))

    def aligned(self, places: list[tuple]) -> list[tuple[int, int, int, int, int, int]]:
        """The passages of `places` within the items' edits."""
        if not places:
            return []
        items = [self.text[p[1]] for p in places]
        width = max(p[3] - p[2] for p in places) + 1
        windows = [_window(p[5], p[2], len(t) + width) for p, t in zip(places, items)]
        cost, last = _banded(items, windows, np.zeros((len(places), width), np.int32))
        good = [k for k in range(len(places)) if cost[k] <= self.e[places[k][1]]]
        if not good:
            return []
        ends = [places[k][2] + len(items[k]) + int(last[k]) for k in good]
        e = int(max(self.e[places[k][1]] for k in good))
        back = [_window(places[k][5][::-1], len(places[k][5]) - end - e, len(items[k]) + 2 * e + 1) for k, end in zip(good, ends)]
        k0 = np.arange(2 * e + 1, dtype=np.int32)
        start = np.tile(np.where(k0 >= e, k0 - e, _BIG), (len(good), 1)).astype(np.int32)
        _, begin = _banded([items[k][::-1] for k in good], back, start)
        out = []
        for k, end, off in zip(good, ends, begin):
            n, t, _, _, count, a, at = places[k]
            first = max(0, end - (len(items[k]) + int(off) - e))
            if not self._whole_words(a, first, end, int(self.e[t])):
                continue
            out.append((n, self.numbers[t], int(at[first]), int(at[min(end, len(at)) - 1]) + 1, int(cost[k]), count))
        return out


def _in_word(c: int) -> bool:
    """Whether a character belongs to words that stand apart from each other: letters and digits, but those of
    scripts that write without spaces."""
    return chr(c).isalnum() and (c < 0x0E00 or 0x10A0 <= c < 0x1780 or 0x1800 <= c < 0x2E80)


def _to_word_end(a: np.ndarray, at: int, most: int) -> int:
    """Characters from a place to the nearest one that is not inside a word; more than `most` if none is so near."""
    for far in range(most + 1):
        for k in (at - far, at + far):
            if 0 <= k <= len(a) and not (0 < k < len(a) and _in_word(a[k - 1]) and _in_word(a[k])):
                return far
    return most + 1


def _window(a: np.ndarray, start: int, size: int) -> np.ndarray:
    out = np.zeros(size, np.uint32)
    lo, hi = max(0, start), min(len(a), start + size)
    if lo < hi:
        out[lo - start : hi - start] = a[lo:hi]
    return out


def _banded(items: list[np.ndarray], windows: list[np.ndarray], cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of each item in its window, over the diagonals of `cost` (their cost at the start),
    and the diagonal on which the best alignment ends."""
    n, width = cost.shape
    most = max(map(len, items))
    p = np.zeros((n, most), np.uint32)
    w = np.zeros((n, most + width), np.uint32)
    for k, (item, window) in enumerate(zip(items, windows)):
        p[k, : len(item)] = item
        w[k, : min(len(window), most + width)] = window[: most + width]
    sizes = np.array([len(x) for x in items])
    steps = np.arange(width, dtype=np.int32)
    best, where = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in range(most):
        change = cost + (w[:, i : i + width] != p[:, i : i + 1])
        change[:, :-1] = np.minimum(change[:, :-1], cost[:, 1:] + 1)
        cost = np.minimum.accumulate(change - steps, axis=1) + steps
        done = np.flatnonzero(sizes == i + 1)
        if len(done):
            where[done] = cost[done].argmin(1)
            best[done] = cost[done, where[done]]
    return best, where


def blocks(items: DataFrame, id_col: str, text_col: str, budget: Budget) -> list[Callable[[], Block]]:
    """Makers of the items' blocks, each of bounded size; an item may not exceed a block."""
    items = items.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // BLOCK_CHARS))
    part = lambda k: items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
    return [lambda k=k: Block(part(k).collect(), budget) for k in range(n)]


def _in_blocks(spark: SparkSession, found: list[Callable[[], Block]], step: Callable[[Broadcast], DataFrame]) -> Iterator[DataFrame]:
    """`step` for each block.  Where there are several, its result is written and the block released
    before the next one is made, so that driver and tasks hold one at a time."""
    for make in found:
        shared = spark.sparkContext.broadcast(make())
        out = step(shared)
        if len(found) > 1:
            out = materialize(out, "block")
            shared.destroy()
        yield out


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", budget: Budget = Budget()
) -> DataFrame:
    """One row per passage: document id, item id, start and end (code points of the document's
    text), edits, shared_qgrams.

    Null and empty texts and items have no passages; items of fewer characters than allow an edit are
    found where they stand exactly; a row that occurs twice reports its passages twice.
    Null ids, of documents and of items, are kept.  Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))

    def step(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = ["id", "item", "start", "end", "edits", "shared_qgrams"]
            for b in batches:
                cols = list(zip(*shared.value.find(b.column(1).to_pylist()))) or [[]] * 6
                ids = b.column(0).take(pa.array(cols[0], pa.int64()))
                what = pa.array([shared.value.ids[t] for t in cols[1]], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, what, *(pa.array(c, pa.int64()) for c in cols[2:])], names)

        return docs.mapInArrow(run, "id long, item long, start long, end long, edits long, shared_qgrams long")

    parts = _in_blocks(docs.sparkSession, blocks(items, item_id, item_text, budget), step)
    return reduce(DataFrame.union, parts).toDF(id_col, item_id, "start", "end", "edits", "shared_qgrams")


def decontaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", budget: Budget = Budget()) -> DataFrame:
    """The rows of `docs` that hold no passage of any item, unchanged."""
    at, kept = docs.columns.index(text_col), [docs]

    def step(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hit = {x[0] for x in shared.value.find(b.column(at).to_pylist())}
                yield b.filter(pa.array([k not in hit for k in range(b.num_rows)], pa.bool_()))

        return kept[-1].mapInArrow(run, docs.schema)

    for part in _in_blocks(docs.sparkSession, blocks(items, item_id, item_text, budget), step):
        kept.append(part)
    return kept[-1]
