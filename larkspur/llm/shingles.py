"""Vectorised word and character hashing for whole Arrow batches of texts.

A text's words are the runs of bytes other than space and \\t..\\r, A-Z lower-cased.  A word's
hash comes from prefix sums of a byte polynomial modulo 2**64, so that a whole batch is hashed
in a few numpy passes; a shingle's hash mixes the hashes of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
#: Texts are hashed in groups of about so many bytes, which bounds the arrays of a task.
GROUP_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20240501).integers(0, 1 << 63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
_powers: dict[str, np.ndarray] = {"up": np.ones(1, U), "down": np.ones(1, U)}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        up = np.full(n, _BASE, U)
        down = np.full(n, pow(_BASE, -1, 1 << 64), U)
        up[0] = down[0] = 1
        _powers.update(up=np.cumprod(up), down=np.cumprod(down))
    return _powers["up"], _powers["down"]


def word_hashes(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start offset of every word of an already lower-cased piece of bytes."""
    a = np.frombuffer(blob, np.uint8)
    if not len(a):
        return np.empty(0, U), np.empty(0, np.int64)
    gap = np.concatenate(([True], _SPACE[a], [True]))
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    up, down = _grow(len(a) + 1)
    total = np.concatenate((np.zeros(1, U), np.cumsum(_BYTE[a] * up[: len(a)])))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(U)), start


def _pieces(blob: bytes) -> Iterator[tuple[int, bytes]]:
    """A long text in pieces that end at white space."""
    at = 0
    while at < len(blob):
        end = min(len(blob), at + GROUP_BYTES)
        while end < len(blob) and not _SPACE[blob[end]]:
            end += 1
        yield at, blob[at:end]
        at = end


def _groups(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    first, group, size = 0, [], 0
    for i, text in enumerate(texts):
        group.append((text or "").encode("utf-8", "surrogatepass").lower())
        size += len(group[-1])
        if size >= GROUP_BYTES:
            yield first, group
            first, group, size = i + 1, [], 0
    if group:
        yield first, group


def shingle_sets(texts: list[str | None], width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per group of texts: index of its first text, the sorted distinct shingle hashes of its
    texts one after the other, and the offsets of each text's hashes.

    A text of fewer than `width` words has one shingle, its whole word sequence; one without
    words has none.
    """
    for first, group in _groups(texts):
        blob = b"\n".join(group)
        found = [(h, s + at) for at, piece in _pieces(blob) for h, s in [word_hashes(piece)]]
        words = np.concatenate([h for h, _ in found] or [np.empty(0, U)])
        where = np.concatenate([s for _, s in found] or [np.empty(0, np.int64)])
        ends = np.cumsum([len(g) + 1 for g in group])
        split = np.concatenate(([0], np.searchsorted(where, ends)))
        n_words = np.diff(split)
        doc = np.repeat(np.arange(len(group)), n_words)
        acc = mix(words)
        full = len(words) - width + 1
        if full > 0:
            rolled = acc[:full]
            for k in range(1, width):
                rolled = mix(rolled * U(3) + words[k : full + k])
            inside = doc[:full] == doc[width - 1 :]
            hashes, owner = rolled[inside], doc[:full][inside]
        else:
            hashes, owner = np.empty(0, U), np.empty(0, np.int64)
        short = np.flatnonzero((n_words > 0) & (n_words < width))
        if len(short):
            own = []
            for d in short:
                h = U(int(n_words[d]))
                for w in words[split[d] : split[d + 1]]:
                    h = mix(np.array([h], U) * U(5) + w)[0]
                own.append(h)
            at = np.searchsorted(owner, short)
            hashes, owner = np.insert(hashes, at, np.array(own, U)), np.insert(owner, at, short)
        bounds = np.searchsorted(owner, np.arange(len(group) + 1))
        hashes = hashes.copy()
        for a, b in zip(bounds[:-1], bounds[1:]):
            hashes[a:b].sort()
        keep = np.ones(len(hashes), bool)
        keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        kept = np.concatenate(([0], np.cumsum(keep)))
        yield first, hashes[keep], kept[bounds]
