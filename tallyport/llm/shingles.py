"""Word shingles of whole texts as sorted sets of 64-bit hashes, computed with numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

WORDS = 5
# Fixed seeds: hashes must be the same in every task.
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_POWER = 0xD6E8FEB86659FD93
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTES[_SPACE] = 0
# Bytes hashed at once; a longer text is a slice of its own.
SLICE = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _POWER, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a buffer; words are runs of other bytes than white space."""
    space = _SPACE[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lengths = ends - starts
    total = int(lengths.sum())
    within = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    letters = data[~space]
    sums = np.add.reduceat(_BYTES[letters] * powers(int(lengths.max()))[within], np.cumsum(lengths) - lengths)
    return starts, mixed(sums + lengths.astype(np.uint64))


def slices(texts: Iterable[bytes | None]) -> Iterator[list[bytes]]:
    """Texts in lists of about `SLICE` bytes; null is empty."""
    held, size = [], 0
    for text in texts:
        text = text or b""
        if held and size + len(text) > SLICE:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield held


def runs(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts in order, and how many each text has.

    A-Z count as a-z. A text of fewer words than `words` has its whole sequence as one.
    """
    data = np.frombuffer(b" ".join(texts).lower(), np.uint8)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    starts, hashes = word_hashes(data)
    first = np.searchsorted(starts, begins)
    n_words = np.diff(first)
    counts = np.where(n_words == 0, 0, np.maximum(n_words - words + 1, 1))
    total = int(counts.sum())
    at = np.arange(total) + np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
    width = np.repeat(np.minimum(n_words, words), counts)
    out = width.astype(np.uint64)
    for k in range(words):
        inside = width > k
        word = hashes[np.where(inside, at + k, 0)] if total else out
        out = np.where(inside, mixed(out * _MULTIPLIER + word), out)
    return out, counts


def sets(texts: Iterable[bytes | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    for held in slices(texts):
        found, counts = runs(held, words)
        ends = np.cumsum(counts)
        for end, n in zip(ends, counts, strict=True):
            yield np.unique(found[end - n : end])


def fingerprint(shingle_set: np.ndarray) -> int:
    """64 bits that name a set; used together with its size."""
    return int(mixed(shingle_set * _MULTIPLIER).sum(dtype=np.uint64).astype(np.int64)) if len(shingle_set) else 0
