"""Alignment of two tokenizers' tokens over the same bytes.

Every text is tokenised whole by both.  Ends that both share and that stand before a space-marked
token on both sides are anchors: they cut a document into windows, about a word each.  What is
linked inside a window depends on its token ids alone, so alignments are kept by id tuples and a
window that was seen before costs a look-up.  Documents' linked id pairs are written once; the number
of documents of each pair is summed from them, and then meets the documents again: pairs of many
documents as a broadcast table of bounded size, rarer ones by a shuffle, in which no key is hot
because it has few documents.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialize

#: Texts are tokenised in groups of about so many characters.
GROUP_CHARS = 1 << 20
#: Bytes of windows that a task keeps, and what one has besides its texts.
KEPT, _ENTRY = 128 << 20, 420
#: Most pairs whose counts are broadcast (17 bytes each).
BROADCAST_PAIRS = 1 << 20
_SPACE_MARK = "▁"
#: White space in a row that the faster encoder is not given.
LONG_SPACE = 10_000
_LONG_RUN = re.compile(rf"\s{{{LONG_SPACE}}}")
_aligners: dict[tuple[str, str], "Aligner"] = {}


def byte_letters() -> dict[str, int]:
    """The letter of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the others for 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


#: Fixed value: the pattern that byte-level vocabularies cut texts by before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def ranked_encoder(path: str) -> Callable[[list[str]], list[list[int]]] | None:
    """An encoder of a byte-level vocabulary whose ids ascend with its merges, which gives the same ids in a
    third of the time; None for any other file."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    before, model = file.get("pre_tokenizer") or {}, file["model"]
    plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and not file.get("normalizer")
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if not plain or any(model.get(k) for k in options):
        return None
    letters, vocabulary = byte_letters(), model["vocab"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    special = {t["content"] for t in file.get("added_tokens", [])}
    if [vocabulary.get(m) for m in merged] != list(range(256, 256 + len(merged))):
        return None
    ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if t not in special}
    if sorted(ranks.values()) != list(range(256 + len(merged))):
        return None
    encoding = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [encoding.encode_ordinary(t) for t in texts]


class Window:
    """What a window's tokens amount to: its groups as text, how many, and the id pairs of its links as int64."""

    __slots__ = ("text", "groups", "pairs")


class _Kept:
    """Windows by their ids, bounded in bytes: what was used lately stays, in two generations."""

    def __init__(self, most: int):
        self.half, self.size, self.young, self.old = most // 2, 0, {}, {}

    def keep(self, key: tuple[bytes, bytes], window: Window) -> None:
        size = _ENTRY + len(key[0]) + len(key[1]) + len(window.text) + len(window.pairs)
        if size > self.half // 8:  # a long run without spaces is not met again
            return
        if self.size + size > self.half:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[key] = window
        self.size += size


def _ranges(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All indexes of the ranges, one after the other."""
    n = last - first
    ends = np.cumsum(n)
    return np.arange(int(ends[-1])) + np.repeat(first - (ends - n), n)


class Aligner:
    """Both tokenizers, the bytes of their entries and the windows aligned so far."""

    def __init__(self, byte_bpe: str, piece_bpe: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        import sentencepiece
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(byte_bpe)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = True
        self.whole = lambda texts: [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self.ranked = ranked_encoder(byte_bpe) or self.whole
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        letters = byte_letters()
        n = tokenizer.get_vocab_size(with_added_tokens=True)
        self.bytes_a = [bytes(letters[c] for c in tokenizer.id_to_token(t) or "" if c in letters) for t in range(n)]
        self.bytes_b = [self._piece(t) for t in range(self.b.get_piece_size())]
        self.len_a, self.len_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        #: An id in decimal, followed by nothing, a comma, a bar or a semicolon.
        self.written = [b"%d%s" % (t, mark) for t in range(max(n, len(self.bytes_b))) for mark in (b"", b",", b"|", b";")]
        self.marked_a, self.marked_b = (np.array([x[:1] == b" " for x in side]) for side in (self.bytes_a, self.bytes_b))
        #: Windows of the texts, and how many of them were aligned anew.
        self.windows = self.fresh = 0
        self.release()

    def release(self) -> None:
        self.kept = _Kept(KEPT)

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of the byte-level side.  The faster encoder's pattern has bounded steps, so texts with very long runs
        of white space go to the other one."""
        long = [k for k, t in enumerate(texts) if len(t) >= LONG_SPACE and _LONG_RUN.search(t)]
        out = self.ranked([t if k not in long else "" for k, t in enumerate(texts)] if long else texts)
        for k in long:
            out[k] = self.whole([texts[k]])[0]
        return out

    def _piece(self, t: int) -> bytes:
        piece = self.b.id_to_piece(t)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(t) else piece.replace(_SPACE_MARK, " ").encode()

    def tokens(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Both id lists of each text; two empty ones where either side's bytes are not those of the text."""
        spaced = [" " + t for t in texts]
        a = self.encode_a(spaced)
        b = self.b.encode(texts, num_threads=1)
        none: tuple[list[int], list[int]] = ([], [])
        return [(x, y) if t and self._same(x, y, s.encode()) else none for t, s, x, y in zip(texts, spaced, a, b)]

    def _same(self, a: list[int], b: list[int], data: bytes) -> bool:
        return b"".join(map(self.bytes_a.__getitem__, a)) == data and b"".join(map(self.bytes_b.__getitem__, b)) == data

    def align(self, docs: list[tuple[list[int], list[int]]]) -> list[list[Window]]:
        """The windows of each document in order; documents have tokens.

        A group begins after an end that both sides have, a window where both then go on with a space-marked
        token, and at each document's start.  Windows whose ids were met before are looked up; the others are
        aligned together.
        """
        if not docs:
            return []
        a, b = (np.fromiter(chain.from_iterable(d[side] for d in docs), np.int32) for side in (0, 1))
        tokens = _Tokens(a, b, np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))
        starts = np.cumsum([0, *(len(d[0]) for d in docs)])
        next_a, next_b = tokens.cut_a[1:-1], tokens.cut_b[1:-1]
        anchor = self.marked_a[a[next_a]] & self.marked_b[b[next_b]]
        anchor[np.searchsorted(next_a, starts[1:-1])] = True
        begin = np.concatenate(([0], np.flatnonzero(anchor) + 1, [len(tokens.cut_a) - 1]))
        data_a, data_b = a.tobytes(), b.tobytes()
        young, old, fresh, first, out = self.kept.young, self.kept.old, {}, [], []
        at_a, at_b = (4 * tokens.cut_a[begin]).tolist(), (4 * tokens.cut_b[begin]).tolist()
        i = k = 0
        for w, (j, m) in enumerate(zip(at_a[1:], at_b[1:])):
            key = (data_a[i:j], data_b[k:m])
            found = young.get(key) or fresh.get(key)
            if found is None:
                found = old.get(key)
                if found is None:
                    found = Window()
                    first.append(w)
                fresh[key] = found
            out.append(found)
            i, k = j, m
        if first:
            self._align_fresh(tokens, begin, np.array(first), [out[w] for w in first])
        for key, window in fresh.items():
            self.kept.keep(key, window)
        self.windows, self.fresh = self.windows + len(out), self.fresh + len(first)
        of = np.searchsorted(tokens.cut_a[begin], starts)
        return [out[x:y] for x, y in pairwise(of.tolist())]

    def _align_fresh(self, tokens: "_Tokens", begin: np.ndarray, which: np.ndarray, windows: list[Window]) -> None:
        """Groups and links of `windows`, which are these of the windows that begin with the groups `begin`."""
        code = tokens.written_order(begin)
        at = tokens.cut_a[begin] + tokens.cut_b[begin]
        from_, to = at[which], at[which + 1]
        written = list(map(self.written.__getitem__, code[_ranges(from_, to)].tolist()))
        pairs, pair_at = tokens.pairs(begin)
        data = pairs.tobytes()
        groups = (begin[which + 1] - begin[which]).tolist()
        s = 0
        for window, n, e, x, y in zip(windows, groups, np.cumsum(to - from_).tolist(), (8 * pair_at[which]).tolist(), (8 * pair_at[which + 1]).tolist()):
            window.text, window.groups, window.pairs = b"".join(written[s:e]), n, data[x:y]
            s = e


class _Tokens:
    """Tokens of documents one after the other: ids and byte ends of both sides, the groups they stand in, and
    where these begin, closed by the ends."""

    def __init__(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray):
        self.a, self.b, self.end_a = a, b, end_a
        self.is_a, self.is_b = (np.zeros(int(end_a[-1]) + 1, bool) for _ in range(2))
        self.is_a[end_a], self.is_b[end_b] = True, True
        both_a, both_b = self.is_b[end_a], self.is_a[end_b]
        self.cut_a, self.cut_b = (np.concatenate(([0], np.flatnonzero(x) + 1)) for x in (both_a, both_b))
        self.group_a, self.group_b = np.cumsum(both_a) - both_a, np.cumsum(both_b) - both_b

    def pairs(self, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The id pairs of all links in order, and where those of each window begin, closed by their number.

        Tokens are linked if their bytes overlap: each stretch of bytes between two neighbouring ends, of
        either side, lies in one token of each, and that is one link.
        """
        ends = np.flatnonzero(self.is_a | self.is_b)
        is_a, is_b = self.is_a[ends], self.is_b[ends]
        pairs = self.a[np.cumsum(is_a) - is_a].astype(np.int64) << 32 | self.b[np.cumsum(is_b) - is_b]
        last = self.end_a[self.cut_a[begin[1:]] - 1]
        return pairs, np.concatenate(([0], np.searchsorted(ends, last, "right")))

    def written_order(self, begin: np.ndarray) -> np.ndarray:
        """Four times each id, and 1 for a comma after it, 2 for a bar, 3 for a semicolon, 0 for nothing at a window's
        end: a group's tokens of one side, then those of the other."""
        code = np.empty(len(self.a) + len(self.b), np.int64)
        for ids, group, before, other in ((self.a, self.group_a, self.cut_b[self.group_a], 2), (self.b, self.group_b, self.cut_a[self.group_b + 1], 3)):
            mark = np.full(len(ids), other)
            mark[:-1][group[1:] == group[:-1]] = 1
            if other == 3:
                mark[self.cut_b[begin[1:]] - 1] = 0
            code[np.arange(len(ids)) + before] = ids.astype(np.int64) * 4 + mark
        return code


def aligner(byte_bpe: str, piece_bpe: str) -> Aligner:
    """One per process and pair of files."""
    if (byte_bpe, piece_bpe) not in _aligners:
        _aligners[byte_bpe, piece_bpe] = Aligner(byte_bpe, piece_bpe)
    return _aligners[byte_bpe, piece_bpe]


def totals(windows: list[Window]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs of a document, ascending, and the links of each."""
    return np.unique(np.frombuffer(b"".join([w.pairs for w in windows]), np.int64), return_counts=True)


_ALIGNED = "id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, links array<int>"


def _groups_of(texts: list[str | None]) -> Iterator[slice]:
    first = size = 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= GROUP_CHARS:
            yield slice(first, k + 1)
            first, size = k + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def _lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays), kind))


def _align(byte_bpe: str, piece_bpe: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_bpe, piece_bpe)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for part in _groups_of(texts):
                rows, tokens = [], tool.tokens([t or "" for t in texts[part]])
                aligned = iter(tool.align([d for d in tokens if d[0]]))
                for a, b in tokens:
                    windows = next(aligned) if a else []
                    pairs, links = totals(windows)
                    digest = hashlib.sha256(b";".join([w.text for w in windows])).hexdigest() if a else ""
                    rows.append((len(a), len(b), sum(w.groups for w in windows), int(links.sum()), digest, pairs, links))
                *plain, pairs, links = zip(*rows)
                kinds = [pa.int64()] * 4 + [pa.string()]
                columns = [pa.array(c, k) for c, k in zip(plain, kinds)]
                columns = [ids.slice(part.start, len(rows)), *columns, _lists(pairs, pa.int64()), _lists(links, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"])

    return run


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each pair in a batch, which has a document's pairs once each."""
    for b in batches:
        pairs, n = np.unique(b.column(0).flatten().to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], ["pair", "n"])


def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, pair and links of all pairs of a batch with columns pairs and links."""
    pairs, links = b.column("pairs"), b.column("links").flatten().to_numpy()
    row = np.repeat(np.arange(b.num_rows), np.diff(pairs.offsets.to_numpy()))
    return row, pairs.flatten().to_numpy(), links


class _Counts:
    """Sorted pairs with their number of documents, and whether that is the highest of the first id."""

    def __init__(self, pairs: np.ndarray, n: np.ndarray, best: np.ndarray):
        self.pairs, self.n, self.best = pairs, n, best

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each pair, and whether it is there."""
        at = np.minimum(np.searchsorted(self.pairs, pairs), max(len(self.pairs) - 1, 0))
        return at, (self.pairs[at] == pairs) if len(self.pairs) else np.zeros(len(pairs), bool)


def _score(shared):
    """n_best and count_sum of each row, over the pairs that the shared counts have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for b in batches:
            row, pairs, links = _flat(b)
            at, there = counts.find(pairs)
            row, at, links = row[there], at[there], links[there].astype(np.int64)
            best, total = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            np.add.at(best, row, links * counts.best[at])
            np.add.at(total, row, links * counts.n[at])
            names = [c for c in b.schema.names if c not in ("pairs", "links")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(best), pa.array(total)], [*names, "n_best", "count_sum"])

    return run


def _missing(shared):
    """(row, pair, links) of the pairs that the shared counts do not have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for b in batches:
            row, pairs, links = _flat(b)
            use = ~counts.find(pairs)[1]
            columns = [b.column("row").take(pa.array(row[use])), pa.array(pairs[use]), pa.array(links[use].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "pair", "links"])

    return run


def pair_counts(docs: DataFrame) -> DataFrame:
    """(pair, n, best) of all documents: n of them hold the pair; best: no pair of the same first id has more."""
    counts = docs.select("pairs").mapInArrow(_tally, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialize(counts, "pairs")
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))  # a row per id of the first vocabulary
    best = counts.join(F.broadcast(most), first == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    return materialize(best, "counts")


def _broadcast_above(counts: DataFrame) -> int:
    """Counts above this are broadcast: the least power of two (or 0) that leaves few enough pairs."""
    of = {r.k: r.n for r in counts.groupBy(F.floor(F.log2("n")).alias("k")).agg(F.count("*").alias("n")).collect()}
    left = sum(of.values())
    above = 0
    for k in sorted(of):
        if left <= BROADCAST_PAIRS:
            break
        left, above = left - of[k], (2 << k) - 1
    return above


def alignment(docs: DataFrame, byte_bpe: str, piece_bpe: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    byte_bpe, piece_bpe: files of a byte-level and of a sentencepiece BPE tokenizer.  Texts that are null or
    empty, or whose bytes the tokens of either side do not give back, have no tokens: zeros and an empty digest.
    Repeated rows are documents of their own; null ids stay.  Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.mapInArrow(_align(byte_bpe, piece_bpe), _ALIGNED).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "aligned")
    counts = pair_counts(rows)
    above = _broadcast_above(counts)
    known = counts.where(F.col("n") > above).orderBy("pair").toArrow()
    known = [known.column(c).to_numpy() for c in ("pair", "n", "best")]
    shared = docs.sparkSession.sparkContext.broadcast(_Counts(*known))
    plain = "row long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    kept = [c.split()[0] for c in plain.split(", ")]
    out = rows.select(*kept, "pairs", "links").mapInArrow(_score(shared), plain + ", n_best long, count_sum long")
    if above:
        rare = rows.select("row", "pairs", "links").mapInArrow(_missing(shared), "row long, pair long, links long")
        rare = rare.join(counts.where(F.col("n") <= above), "pair")
        best = F.sum(F.when(F.col("best"), F.col("links")).otherwise(0))
        rare = rare.groupBy("row").agg(best.alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more_sum"))
        more = lambda c, d: (F.col(c) + F.coalesce(F.col(d), F.lit(0))).alias(c)
        out = out.join(rare, "row", "left").select(*kept, more("n_best", "more_best"), more("count_sum", "more_sum"))
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
