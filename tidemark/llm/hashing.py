"""Words and word n-grams of many texts as 64-bit hashes, in numpy over Arrow buffers.

Whole texts, no per-word Python. Hashes stand for words and n-grams: two different ones
among n share a hash with a chance of about n * n / 2**65 (one in 1,600 for 150 million),
whatever the text holds that was not made to collide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# Bytes hashed at a time; whole texts are never cut, a longer one is a piece of its own.
PIECE_BYTES = 1 << 21

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = [np.uint64(m) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_FEW = np.uint64(0x8BB84B93962EACC9)

# The separators of the words `[^\x20\x09-\x0D]+`.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def text_buffers(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
        if isinstance(texts, pa.ChunkedArray):
            texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_string())
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES):
    """Ranges (first, end) of whole texts with about `limit` bytes each."""
    first, n = 0, len(offsets) - 1
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end
        first = end


def word_hashes(
    offsets: np.ndarray, data: np.ndarray, separators: np.ndarray = SEPARATORS, lower: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text) for texts given as offsets and bytes."""
    base = offsets[0]
    offsets = (offsets - base).astype(np.int64)
    data = data[base : base + offsets[-1]]
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    if lower:
        data = LOWER[data]
    inside = ~separators[data]
    cut = np.zeros(n + 1, bool)  # a text begins here
    cut[offsets] = True
    begins, ends = inside.copy(), np.empty(n, bool)
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends[:-1] = inside[:-1] & (~inside[1:] | cut[1:n])
    ends[-1] = inside[-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power = np.full(n + 1, _BASE, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=summed[1:])
    # Shift every word to the place 0: by B ** (n - start), then by B ** -n.
    back = np.uint64(pow(int(_BASE), -n, 1 << 64))
    hashes = mix((summed[end] - summed[start]) * power[n - start] * back)
    return hashes, np.searchsorted(start, offsets).astype(np.int64)


def ngram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each n-gram within a text, first n-gram of each text)."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(len(first), np.int64)
    m = len(words) - n + 1
    total = np.zeros(m, np.uint64)
    for i in range(n):
        total += (words[i : i + m] ^ (words[i : i + m] >> np.uint64(29))) * (_MIX[i % 4] + np.uint64(2 * (i // 4)))
    counts = np.maximum(np.diff(first) - n + 1, 0)
    return mix(total)[_whole(first, m, n)], np.concatenate([[0], np.cumsum(counts)])


def ngram_sums(values: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The sum of the words' values for each n-gram that `ngram_hashes` returns, in its order."""
    m = len(values) - n + 1
    if m < 1:
        return np.zeros(0, np.int64)
    total = np.zeros(m, np.int64)
    for i in range(n):
        total += values[i : i + m]
    return total[_whole(first, m, n)]


def _whole(first: np.ndarray, m: int, n: int) -> np.ndarray:
    """Which of m n-grams stay within one text."""
    good = np.ones(m, bool)
    for back in range(1, n):
        at = first[1:-1] - back
        good[at[(at >= 0) & (at < m)]] = False
    return good


def short_hash(words: np.ndarray) -> np.uint64:
    """One hash for a whole sequence of fewer words than an n-gram has."""
    h = np.array([len(words)], np.uint64) + _FEW
    for w in words:
        h = mix(h ^ w) * _MIX[2]
    return h[0]
