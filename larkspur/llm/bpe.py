"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut before white space wherever a rolling hash of the bytes before it says so; equal
passages of different documents therefore give equal chunks wherever they stand.  Documents are
dealt by their least chunk hash, so documents with common content meet in a task, and there each
distinct chunk is encoded once.  Joins are then checked: the words on both sides of a join are
encoded together and must agree with the tokens of the two chunks.  Where they do not, both chunks
become one, which is encoded again, and its joins are checked in the next round, until all agree.

What a chunk holds anew is encoded word by word, each distinct word once a task, where the tokenizer's
file says that white space parts words (`Words`); other files' chunks are given to the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from . import shingles
from .shingles import U, mix

#: A chunk ends before a white space with this chance, over the hash of the WINDOW bytes before it.
ONE_IN = 128
WINDOW = 8
#: Bytes of chunks, and of joins and their words, that a task keeps.
KEPT_CHUNKS, KEPT_JOINS = 48 << 20, 16 << 20
#: Bytes of words that a task keeps, and what one has besides its text and tokens.
KEPT_WORDS, _WORD = 64 << 20, 200
#: Texts are encoded in groups of about so many characters.
GROUP_CHARS = 1 << 20
_ENTRY = 400  # bytes of objects an entry has besides its text and tokens
_codecs: dict[str, "Codec"] = {}


def cuts(data: bytes) -> tuple[np.ndarray, int]:
    """Offsets of the chunks' starts (0 first), and the least hash of the places of cutting.

    Chunks start at a white space (blank, \\t..\\r) that follows another character.
    """
    a = np.frombuffer(data, np.uint8)
    at = np.flatnonzero(shingles._SPACE[a])
    at = at[at >= WINDOW]
    at = at[a[at - 1] > 32]
    if not len(at):
        return np.zeros(1, np.int64), 0
    h = mix(np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))[at - WINDOW])
    cut = h % U(ONE_IN) == 0
    chosen = h[cut] if cut.any() else h
    return np.concatenate(([0], at[cut])), int((chosen.min() >> U(1)).astype(np.int64))


def last_word(chunk: str) -> str:
    """The end of a chunk: its last word with the white space around it."""
    bare = chunk.rstrip()
    word = bare.rsplit(None, 1)[-1] if bare else ""
    return chunk[len(bare[: len(bare) - len(word)].rstrip()) :]


def first_word(chunk: str) -> str:
    """The beginning of a chunk: its first word with the white space before it."""
    bare = chunk.lstrip()
    word = bare.split(None, 1)[0] if bare else ""
    return chunk[: len(chunk) - len(bare) + len(word)]


class _Kept:
    """A dictionary bounded in bytes that keeps what was used lately: two generations."""

    def __init__(self, most: int):
        self.half, self.size, self.young, self.old = most // 2, 0, {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> None:
        self.size += _ENTRY + 2 * len(key) + len(value)
        if self.size > self.half:
            self.old, self.young, self.size = self.young, {}, 0
        self.young[key] = value


#: The normalizers and the pattern of files whose words white space parts.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
END = "</w>"
#: Words of letters that normalizers change in case alone, and that the pattern leaves whole.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


class Words:
    """Tokens of words between white space, each distinct one encoded once until `release`."""

    def __init__(self, whole: Callable[[list[str]], list[bytes]], letters: Callable[[list[str]], list[bytes]]):
        self.whole, self.letters = whole, letters
        self.release()

    def release(self) -> None:
        self.known, self.size = {}, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [t.encode().split() for t in texts]  # at ASCII white space alone
        if self.size > KEPT_WORDS:
            self.release()
        new = set(chain.from_iterable(split)).difference(self.known)
        plain, other = [], []
        for w in map(bytes.decode, new):
            (plain if _LETTERS.fullmatch(w) else other).append(w)
        for words, encode in ((plain, self.letters), (other, self.whole)):
            for w, ids in zip(words, encode(words), strict=True):
                w = w.encode()
                self.known[w] = ids
                self.size += _WORD + len(w) + len(ids)
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in split]


def _letters_encoder(path: str) -> Callable[[list[str]], list[bytes]] | None:
    """An encoder of words of letters for a file of the kind of CLIP's; None for any other file.

    A last letter with END is the letter with a blank after it to the ranked encoder, whose merge comes before all
    others.  Ids ascend with the merges, so the ranks are the ids.
    """
    import tiktoken

    from .token_alignment import byte_letters

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, before, normal = file["model"], file.get("pre_tokenizer") or {}, file.get("normalizer") or {}
    split = {"type": "Split", "pattern": {"Regex": PATTERN}, "behavior": "Removed", "invert": True}
    levels = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
    same = before == {"type": "Sequence", "pretokenizers": [split, levels]} and normal == {"type": "Sequence", "normalizers": NORMALIZERS}
    options = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
    added = file.get("added_tokens", [])
    apart = all(not any(t[k] for k in ("single_word", "lstrip", "rstrip", "normalized")) and not re.search(r"\s", t["content"]) for t in added)
    if not same or not apart or model["type"] != "BPE" or model.get("end_of_word_suffix") != END or any(model.get(k) for k in options):
        return None
    letters, special = byte_letters(), {t["content"] for t in added}
    vocabulary = {t: k for t, k in model["vocab"].items() if t not in special}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    firsts = {*letters, *(c + END for c in letters)}
    if [vocabulary.get(m) for m in merged] != list(range(512, 512 + len(merged))) or {t for t, k in vocabulary.items() if k < 512} != firsts:
        return None
    ranks = {bytes(letters[c] for c in t.removesuffix(END)) + b" " * t.endswith(END): k for t, k in vocabulary.items()}
    if sorted(ranks.values()) != list(range(512 + len(merged))):
        return None
    encoding = tiktoken.Encoding("words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
    last = np.zeros(len(ranks), bool)
    last[[k for t, k in vocabulary.items() if t.endswith(END)]] = True

    def encode(words: list[str]) -> list[bytes]:
        if not words:
            return []
        ids = np.array(encoding.encode_ordinary(" ".join(words).lower() + " "), np.int32)
        ends = ((np.flatnonzero(last[ids]) + 1) * 4).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in pairwise([0, *ends])]

    return encode


class Codec:
    """One tokenizer file with the chunks it has encoded."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.plain = None
        if self.tokenizer.decoder is None:  # decoding is then the tokens with spaces between them
            n = self.tokenizer.get_vocab_size(with_added_tokens=True)
            self.plain = [self.tokenizer.id_to_token(i) or "" for i in range(n)]
        letters = _letters_encoder(path)
        self.words = Words(self._whole, letters) if letters else None
        #: Characters of the texts given, of chunks encoded and of joins encoded; joins that did not agree.
        self.given = self.encoded = self.joined = self.repaired = 0
        self.release()

    def release(self) -> None:
        """Forget what was encoded."""
        self.chunks, self.joins = _Kept(KEPT_CHUNKS), _Kept(KEPT_JOINS)
        if self.words:
            self.words.release()

    def _encode(self, texts: list[str]) -> list[bytes]:
        """Tokens of each text, as the bytes of 32-bit integers."""
        return self.words.encode(texts) if self.words else self._whole(texts)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("i", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _looked_up(self, texts: set[str], kept: _Kept) -> tuple[dict[str, bytes], int]:
        """Tokens of distinct texts, and the characters of those that had to be encoded."""
        tokens = {t: kept.get(t) for t in texts}
        new = [t for t, ids in tokens.items() if ids is None]
        for t, ids in zip(new, self._encode(new)):
            tokens[t] = ids
            kept.put(t, ids)
        return tokens, sum(map(len, new))

    def _chunk_tokens(self, chunks: set[str]) -> dict[str, bytes]:
        tokens, n = self._looked_up(chunks, self.chunks)
        self.encoded += n
        return tokens

    def _disagree(self, joins: set[tuple[str, str]], tokens: dict[str, bytes]) -> set[tuple[str, str]]:
        """The joins (left chunk, right chunk) whose words, encoded together, do not give the ends of the
        two chunks' tokens."""
        words = {j: (last_word(j[0]), first_word(j[1])) for j in joins}
        known, n = self._looked_up({w for x, y in words.values() for w in (x, y, x + y)}, self.joins)
        self.joined += n
        bad = set()
        for (a, b), (x, y) in words.items():
            left, right = known[x], known[y]
            if known[x + y] != left + right or not (tokens[a].endswith(left) and tokens[b].startswith(right)):
                bad.add((a, b))
        return bad

    def encode_arrays(self, texts: list[str | None]) -> list[np.ndarray]:
        """Tokens of whole texts, as the tokenizer gives them without special tokens; null: none."""
        split = []
        for text in texts:
            data = (text or "").encode("utf-8", "surrogatepass")
            at = [*cuts(data)[0].tolist(), len(data)]
            split.append([data[a:b].decode("utf-8", "surrogatepass") for a, b in pairwise(at)])
            self.given += len(text or "")
        tokens = self._chunk_tokens({c for parts in split for c in parts})
        joins = {j for parts in split for j in pairwise(parts)}
        checked: set[tuple[str, str]] = set()
        while bad := self._disagree(joins, tokens):
            checked |= joins
            self.repaired += len(bad)
            split = [_merged(parts, bad) for parts in split]
            tokens |= self._chunk_tokens({c for parts in split for c in parts if c not in tokens})
            joins = {j for parts in split for j in pairwise(parts)} - checked
        return [np.frombuffer(b"".join([tokens[c] for c in parts]), np.int32) for parts in split]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        return [ids.tolist() for ids in self.encode_arrays(texts)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        """Texts of tokens, special ones too, as the tokenizer decodes them."""
        if self.plain is None:
            return self.tokenizer.decode_batch(ids, skip_special_tokens=False)
        return [" ".join(map(self.plain.__getitem__, x)) for x in ids]


def _merged(parts: list[str], bad: set[tuple[str, str]]) -> list[str]:
    """Chunks with those made one whose join does not hold."""
    out = parts[:1]
    for left, right in pairwise(parts):
        if (left, right) in bad:
            out[-1] += right
        else:
            out.append(right)
    return out


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column(b.num_columns - 1).to_pylist()
        least = [cuts((t or "").encode("utf-8", "surrogatepass"))[1] for t in texts]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(least, pa.int64())], [*b.schema.names, "__least"])


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows of about GROUP_CHARS characters, as (first, number)."""
    first = total = 0
    for k, n in enumerate(sizes):
        total += n
        if total >= GROUP_CHARS:
            yield first, k + 1 - first
            first, total = k + 1, 0
    if first < len(sizes):
        yield first, len(sizes) - first


def encoded(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of `docs`: the kept columns, ids (array<int>), decoded (string).

    Null and empty texts give no tokens and an empty string; ids may be null or repeat, each row
    is encoded by itself.  Kept columns named ids or decoded give way to the results.  `path` is a
    tokenizers file that every executor can open.  A task forgets its chunks when it ends.
    """
    kept = [c for c in keep if c not in ("ids", "decoded")]
    rows = docs.select(*kept, F.col(text_col).alias("__text"))
    fields = rows.schema.fields
    signed = rows.mapInArrow(_sign, StructType([*fields]).add("__least", LongType()))
    # rebalancing splits a partition that a hot passage makes large
    rows = signed.hint("rebalance", "__least").sortWithinPartitions("__least").select(*kept, "__text")
    schema = StructType(fields[:-1]).add("ids", ArrayType(IntegerType())).add("decoded", StringType())
    return rows.mapInArrow(_run(path, schema.names), schema)


def _run(path: str, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        try:
            for b in batches:
                texts = b.column(b.num_columns - 1).to_pylist()
                for first, n in _groups([len(t or "") for t in texts]):
                    ids = own.encode_arrays(texts[first : first + n])
                    ends = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                    tokens = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids)))
                    decoded = pa.array(own.decode([x.tolist() for x in ids]), pa.string())
                    kept = [c.slice(first, n) for c in b.columns[:-1]]
                    yield pa.RecordBatch.from_arrays([*kept, tokens, decoded], names)
        finally:
            own.release()

    return run
