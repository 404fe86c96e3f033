"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum w_i + sum_{i<j} <v_i, v_j>) over the distinct informative terms of a text:
words and word beginnings, hashed into buckets.  The pair terms let two words together (an insult
and the mention of a group) weigh more or less than their sum, which additive weights cannot.

The machine is fitted on a bounded sample of labelled rows (`Fit.rows`); which terms are informative
is decided on that sample too, by the likelihood ratio of a bucket against the label.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from .tables import materialize

_WORD = re.compile(r"\w+")
#: Words whose buckets a worker keeps.
KEPT_WORDS = 150_000
#: The driver counts, and fits, the sample in blocks of about so many terms of whole texts.
BLOCK_COUNTED, BLOCK_FITTED = 1 << 20, 1 << 17
#: Buckets whose likelihood ratios are computed at a time.
BLOCK_BUCKETS = 1 << 16


@dataclass(frozen=True)
class Fit:
    """Bounds of the sample in rows and in bytes of terms, buckets, informative terms at most and their least
    likelihood ratio, factors; steps, rate and decay of the fit, and the weight of a toxic row in it."""

    rows: int = 12_000
    bytes: int = 48 << 20
    buckets: int = 1 << 20
    terms: int = 4096
    ratio: float = 10.0
    factors: int = 8
    steps: int = 300
    rate: float = 0.05
    decay: float = 1e-3
    toxic: float = 1.5


def word_terms(word: str, buckets: int) -> list[int]:
    """Buckets of a word and of its beginnings of 4, 5 and 6 characters."""
    starts = [word] + [f"{word[:k]}*" for k in (4, 5, 6) if len(word) > k]
    return [xxhash.xxh32_intdigest(s) % buckets for s in starts]


def text_terms(text: str | None, buckets: int) -> np.ndarray:
    words = set(_WORD.findall((text or "").lower()))
    return np.unique(np.array([t for w in words for t in word_terms(w, buckets)], np.int32))


class Machine:
    """Weights of the informative buckets; `at` maps a bucket to its row, -1 for others."""

    def __init__(self, buckets: int, chosen: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray):
        self.buckets, self.row = buckets, {int(b): k for k, b in enumerate(chosen)}
        self.w0, self.w, self.v = w0, w, v
        self.kept: dict[str, tuple[int, ...]] = {}

    def _rows(self, word: str) -> tuple[int, ...]:
        rows = tuple(self.row[t] for t in word_terms(word, self.buckets) if t in self.row)
        if len(self.kept) >= KEPT_WORDS:
            self.kept.clear()
        self.kept[word] = rows
        return rows

    def score(self, text: str | None) -> float:
        """0 to 1; a text without informative terms has the score of w0 alone."""
        kept, found = self.kept, set()
        for word in set(_WORD.findall((text or "").lower())):
            rows = kept.get(word)
            if rows is None:
                rows = self._rows(word)
            if rows:
                found.update(rows)
        z = self.w0
        if found:
            at = np.fromiter(sorted(found), np.int64, len(found))
            v = self.v[at]
            z += float(self.w[at].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum()))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _blocks(sizes: list[int], most: int) -> Iterator[slice]:
    """Runs of texts of about `most` terms."""
    first = total = 0
    for k, n in enumerate(sizes, 1):
        total += n
        if total >= most or k == len(sizes):
            yield slice(first, k)
            first, total = k, 0


def informative(bags: list[np.ndarray], y: np.ndarray, fit: Fit) -> np.ndarray:
    """Buckets by likelihood ratio (G squared) of their presence against the label."""
    a, b = np.zeros(fit.buckets), np.zeros(fit.buckets)
    for part in _blocks([len(x) for x in bags], BLOCK_COUNTED):
        flat = np.concatenate(bags[part])
        label = np.repeat(y[part] == 1, [len(x) for x in bags[part]])
        a += np.bincount(flat[label], minlength=fit.buckets)
        b += np.bincount(flat[~label], minlength=fit.buckets)
    p, n = max(float((y == 1).sum()), 1e-9), max(float((y == 0).sum()), 1e-9)
    g = np.zeros(fit.buckets)
    for first in range(0, fit.buckets, BLOCK_BUCKETS):
        of = slice(first, first + BLOCK_BUCKETS)
        both = (a[of] + b[of]) / (p + n)
        for seen, total in ((a[of], p), (b[of], n)):
            for x, share in ((seen, both), (total - seen, 1 - both)):
                expect = total * share
                g[of] += np.where(x > 0, 2 * x * np.log(np.maximum(x, 1e-9) / np.maximum(expect, 1e-9)), 0)
    top = np.argsort(-g, kind="stable")[: fit.terms]
    return np.sort(top[(g[top] >= fit.ratio) & (a[top] + b[top] >= 3)])


def train(bags: list[np.ndarray], y: np.ndarray, fit: Fit) -> Machine:
    """Logistic loss, full-batch Adam, fixed seed; gradients are summed over blocks of texts.  With one label only or no rows: a constant."""
    p = (float(y.sum()) + 0.5) / (len(y) + 1)
    if not len(y) or y.min() == y.max():
        return Machine(fit.buckets, np.empty(0, int), float(np.log(p / (1 - p))) if len(y) else -30.0, np.empty(0), np.empty((0, fit.factors)))
    chosen = informative(bags, y, fit)
    place = np.full(fit.buckets, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    at = [x[x >= 0] for x in (place[b] for b in bags)]
    # of each block of texts: which, the text of each of their terms, the terms
    blocks = [(of, np.repeat(np.arange(of.stop - of.start, dtype=np.int32), [len(x) for x in at[of]]), np.concatenate(at[of])) for of in _blocks([len(x) for x in at], BLOCK_FITTED)]
    del at
    weight = np.where(y > 0, fit.toxic, 1.0) / len(y)
    rng = np.random.default_rng(11)
    w0, w, v = np.log(p / (1 - p)), np.zeros(len(chosen)), rng.normal(0, 0.05, (len(chosen), fit.factors))
    by = lambda key, x, n: np.stack([np.bincount(key, x[:, f], n) for f in range(x.shape[1])], 1)
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(v), np.zeros_like(v), 0.0, 0.0]
    for step in range(1, fit.steps + 1):
        g0, gw, gv = 0.0, fit.decay * w / len(chosen), fit.decay * v / len(chosen)
        for of, row, col in blocks:
            vc, n = v[col], of.stop - of.start
            s = by(row, vc, n)
            z = w0 + np.bincount(row, w[col], n) + 0.5 * ((s**2).sum(1) - np.bincount(row, (vc**2).sum(1), n))
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[of]) * weight[of]
            g0 += err.sum()
            gw += np.bincount(col, err[row], len(chosen))
            gv += by(col, err[row][:, None] * (s[row] - vc), len(chosen))
        fix = fit.rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        for k, (x, g) in enumerate(((w, gw), (v, gv))):
            state[2 * k] = 0.9 * state[2 * k] + 0.1 * g
            state[2 * k + 1] = 0.999 * state[2 * k + 1] + 0.001 * g * g
            x -= fix * state[2 * k] / (np.sqrt(state[2 * k + 1]) + 1e-8)
        state[4], state[5] = 0.9 * state[4] + 0.1 * g0, 0.999 * state[5] + 0.001 * g0 * g0
        w0 -= fix * state[4] / (np.sqrt(state[5]) + 1e-8)
    return Machine(fit.buckets, chosen, float(w0), w, v)


def held_out(id_col: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text divides by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_machine(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit: Fit = Fit()
) -> Machine:
    """Learn from the labelled rows that are not held out, of which about `fit.rows` at most, chosen by a
    hash of the id, and of these as many as have about `fit.bytes` of terms.

    Null labels are left out; of several labels of an id the largest counts; each row of `docs` with a
    labelled id is learnt from, repeated ones too.
    """
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    usable = usable.where(F.col("y").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    usable = usable.groupBy("id").agg(F.max("y").alias("y"))
    share = lambda seed, part: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, part))
    part = usable.where(share(0, fit.rows / max(usable.count(), 1)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(part), "id").select("id", "text", "y")
    buckets = fit.buckets

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [text_terms(t, buckets).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2).cast(pa.int32()), pa.array(found, pa.binary())], ["id", "y", "bag"])

    found = materialize(rows.mapInArrow(bags, "id long, y int, bag binary"), "bags")
    size = found.agg(F.coalesce(F.sum(F.length("bag")), F.lit(0))).first()[0]
    sample = found.where(share(1, fit.bytes / max(size, 1))).toArrow()
    order = pc.sort_indices(sample, [("id", "ascending"), ("y", "ascending")]).to_numpy()
    y = (sample.column("y").to_numpy()[order] > 0).astype(float)
    bags = [np.frombuffer(x.as_buffer(), np.int32) for x in sample.column("bag")]  # without copies
    return train([bags[k] for k in order], y, fit)


def scored(docs: DataFrame, machine: Machine, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """`docs` with its score column, which replaces one of that name; null and empty texts score as
    texts without terms."""
    docs = docs.drop(score_col)
    names = docs.columns
    at, shared = names.index(text_col), docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            scores = pa.array([own.score(t) for t in b.column(at).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, scores], [*names, score_col])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add(score_col, DoubleType()))


def crc_fold(doc_id: object) -> int:
    """The fold of an id, as `held_out` computes it."""
    return zlib.crc32(str(doc_id).encode()) % 5
