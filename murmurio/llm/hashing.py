"""Words and word shingles of many texts as 64-bit hashes, computed in numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D of the UTF-8 text after A-Z became a-z.
Equal words have equal hashes; two different words share one with a chance of 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
PIECE = 1 << 20  # bytes hashed at once
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_rng = np.random.default_rng(20240101)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_COEFF = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: a bijection that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of them."""
    if len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for i, base in enumerate((_BASE, inverse)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors, dtype=np.uint64)
    return _powers


def plain(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z lower-cased; a null text has none."""
    return (text or "").encode("utf-8", "replace").translate(LOWER)


def _hash_piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start offsets and hashes of the words in a piece of bytes."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.empty(len(raw) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[raw], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[0::2], edges[1::2]
    power, inverse = _power(len(raw) + 1)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[raw] * power[:len(raw)], out=total[1:])
    return starts, mix((total[ends] - total[starts]) * inverse[starts])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts (as ``plain`` gives them), and the words of each text."""
    buffer = b" ".join(texts)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    starts, hashes, at = [], [], 0
    while at < len(buffer):
        end = min(at + PIECE, len(buffer))
        while end < len(buffer) and not _SPACE[buffer[end]]:
            end += 1
        s, h = _hash_piece(buffer[at:end])
        starts.append(s + at)
        hashes.append(h)
        at = end
    if not starts:
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    counts = np.diff(np.searchsorted(np.concatenate(starts), offsets))
    return np.concatenate(hashes), counts


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one text; fewer words make one shingle of them all."""
    n = len(words)
    if not n:
        return words
    width = min(n, k)
    out = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        out += words[i:n - width + 1 + i] * _COEFF[i]
    return mix(out + np.uint64(width))


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles, in slices of bounded size."""
    for part in slices([plain(t) for t in texts]):
        words, counts = word_hashes(part)
        at = 0
        for n in counts:
            yield np.unique(shingle_hashes(words[at:at + n], k))
            at += n


def slices(texts: list, size=len, limit: int = PIECE) -> Iterator[list]:
    """Consecutive runs of texts of about ``limit`` bytes; a longer text is a run of its own."""
    part, total = [], 0
    for text in texts:
        part.append(text)
        total += size(text)
        if total >= limit:
            yield part
            part, total = [], 0
    if part:
        yield part
