"""Vector code compression: product quantisation in exact integer arithmetic.

Components become integers; each vector is cut into equal parts, and a part is coded by the index of
the nearest entry of its position's codebook.  Squared distances come from matrix products: integers
are broken into limbs so narrow that every float64 product sum stays below 2**53 and is exact, and
the products are put together again in int64.  Results therefore do not depend on the order of sums,
the batch or the BLAS library, and ties go to the first entry.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import with_values
from .tables import materialize

#: Rows whose distances a task holds at once.
ROWS = 1024


@dataclass(frozen=True)
class Rule:
    """`scale` times a component, floored, is its integer; `parts` codebooks of `entries`, fitted in `rounds`."""

    scale: int = 256
    parts: int = 16
    entries: int = 64
    rounds: int = 2

    def largest(self, width: int) -> int:
        """Largest absolute integer of a component for which a vector's error surely fits into int64."""
        return math.isqrt((1 << 60) // max(width, 1))


@dataclass(frozen=True)
class Codebooks:
    """entries: (parts, entries, part width) int64; width 0 if no vector could be fitted."""

    width: int
    entries: np.ndarray = field(repr=False)

    def sha256(self) -> str:
        """Hex digest of all integers in decimal, by part, entry and place in the part, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def limb_bits(terms: int) -> int:
    """Widest limb of which `terms` products sum below 2**53."""
    return (53 - max(terms - 1, 0).bit_length()) // 2


def limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """Float64 limbs, lowest first: x = sum of limb[i] << (bits * i); the last one bears the sign."""
    most = int(max(abs(int(x.min())), abs(int(x.max())))) if x.size else 0
    n = max(1, -(-most.bit_length() // bits))
    low = [(x >> (bits * i)) & ((1 << bits) - 1) for i in range(n - 1)]
    return [v.astype(np.float64) for v in (*low, x >> (bits * (n - 1)))]


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """int64 matrix products x @ y of int64 stacks, exact while the results fit into int64."""
    bits = limb_bits(x.shape[-1])
    out = np.zeros((*x.shape[:-1], y.shape[-1]), np.int64)
    for i, a in enumerate(limbs(x, bits)):
        for j, b in enumerate(limbs(y, bits)):
            out += np.matmul(a, b).astype(np.int64) << (bits * (i + j))
    return out


def nearest(parts: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and the squared distance to it, each (parts, rows)."""
    dots = exact_products(parts, books.transpose(0, 2, 1))
    far = (books * books).sum(2)[:, None, :] - 2 * dots
    codes = far.argmin(2)
    least = np.take_along_axis(far, codes[:, :, None], 2)[:, :, 0]
    return codes, least + (parts * parts).sum(2)


def _integers(column: pa.Array, rule: Rule, width: int) -> np.ndarray:
    """(parts, rows, part width) int64 of a column of lists of `width` numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(flat * rule.scale).astype(np.int64)
    return whole.reshape(len(column), rule.parts, width // rule.parts).transpose(1, 0, 2)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def _sums(rule: Rule, books: Codebooks):
    """Per task: rows (part, entry, n, s0, s1, ...), the parts nearest to an entry and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = books.entries.shape[1:]
        count, total = np.zeros(rule.parts * k, np.int64), np.zeros((rule.parts * k, d), np.int64)
        for b in _blocks(batches):
            parts = _integers(b.column(0), rule, books.width)
            codes, _ = nearest(parts, books.entries)
            at = (codes + np.arange(rule.parts)[:, None] * k).reshape(-1)
            count += np.bincount(at, minlength=len(count))
            np.add.at(total, at, parts.reshape(-1, d))
        used = np.flatnonzero(count)
        columns = [used // k, used % k, count[used], *total[used].T]
        names = ["part", "entry", "n", *(f"s{i}" for i in range(d))]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c, dtype=np.int64)) for c in columns], names)

    return run


def _codes(rule: Rule, books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            codes, far = nearest(_integers(b.column("vector"), rule, books.width), books.entries)
            text = [bytes(row.tolist()).hex() for row in codes.T.astype(np.uint8)]
            error = pa.array(far.sum(0))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), pa.array(text, pa.string()), error], ["id", "label", "code", "error"])

    return run


def fit(vectors: DataFrame, rule: Rule = Rule()) -> Codebooks:
    """Codebooks of `vectors` (id, vector), whose vectors hold finite numbers only.

    They start as the vectors of the smallest ids (null ids last, equal ids by vector) and are as wide as
    the first of these; each round is one pass whose tasks send one row per entry.
    """
    first = vectors.orderBy(F.col("id").asc_nulls_last(), "vector")
    head = first.select(F.size("vector").alias("n")).limit(1).collect()
    width = head[0].n if head else 0
    if width == 0 or width % rule.parts:
        return Codebooks(0, np.zeros((rule.parts, 0, 0), np.int64))
    vectors = vectors.where(_fits(rule, width))
    start = [r.vector for r in first.where(_fits(rule, width)).limit(rule.entries).select("vector").collect()]
    if not start:
        return Codebooks(0, np.zeros((rule.parts, 0, 0), np.int64))
    books = Codebooks(width, np.ascontiguousarray(_integers(pa.array(start, pa.list_(pa.float64())), rule, width)))
    d = width // rule.parts
    schema = "part long, entry long, n long, " + ", ".join(f"s{i} long" for i in range(d))
    for _ in range(rule.rounds):
        found = vectors.select("vector").mapInArrow(_sums(rule, books), schema)
        found = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(d)))
        entries = books.entries.copy()
        for r in found.collect():  # one row per entry of each codebook
            entries[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(d)]
        books = Codebooks(width, entries)
    return books


def _fits(rule: Rule, width: int):
    """Whether a vector has the width of the codebooks and its error fits into int64."""
    most = float(rule.largest(width) // rule.scale)
    return (F.size("vector") == width) & F.forall("vector", lambda x: F.abs(x) <= most)


def compressed(rows: DataFrame, rule: Rule = Rule(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row with a vector of finite numbers: id, code, error, label_error, codebooks_sha256.

    Rows whose vector is null or holds null or non-finite components are left out.  Repeated and
    null ids are rows like others.  A vector that is not as wide as that of the smallest id, whose
    width is no multiple of the parts, or whose error might leave int64 (beyond `Rule.largest`) takes
    no part in the codebooks and has a null code and error.  Fewer vectors than entries give smaller
    codebooks, no vectors an empty result.  Other columns are ignored.
    """
    if rule.entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    x = F.col(vector_col).cast("array<double>")
    vectors = rows.select(F.col(id_col).alias("id"), x.alias("vector"), F.col(label_col).alias("label"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    vectors = vectors.where(F.col("vector").isNotNull() & finite)
    books = fit(vectors.select("id", "vector"), rule)
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    coded = vectors.where(_fits(rule, books.width) if books.width else F.lit(False))
    coded = coded.mapInArrow(_codes(rule, books), f"id {kinds['id']}, label {kinds['label']}, code string, error long")
    other = vectors.where(~_fits(rule, books.width)) if books.width else vectors
    other = other.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    # one text per label, null apart from any text, so that equal labels meet in an ordinary join
    key = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    coded = materialize(coded.union(other).select("id", "code", "error", key.alias("key")), "codes")
    labels = coded.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("size"))
    labels = materialize(labels, "label_errors")
    out = with_values(coded, labels, ["key"])
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
