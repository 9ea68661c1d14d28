"""Blocks of whole documents, and tables in which all blocks look something up.

A block is a stretch of documents with about BLOCK_BYTES of text, handled by one task. What its
documents hold (words, pairs) is written by position as codes of the block's own list of distinct
entries; only that list is exploded into rows (entry, block, code) and joined with what is known
corpus-wide. An entry has one row per block at most, so one that every document holds is no hot
key. Answers go back to the block, which puts them into their places.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute

from tidemark.llm.hashing import pieces, text_buffers

BLOCK_BYTES = 1 << 24

_WHITE = np.zeros(256, bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x20), 0x20]] = True


def blocks_of(batches: Iterable[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(ids, texts) of whole documents with about `limit` bytes each; the batches hold an id and a text, null texts are empty.

    A longer document is a block of its own. What the work on a block took is given back before the next.
    """
    ids, texts, held = [], [], 0
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(1)).fill_null(0).to_numpy()
        for first, end in pieces(ends_of(sizes), max(limit // 8, 1)):
            size = int(sizes[first:end].sum())
            if ids and held + size > limit:
                yield pa.concat_arrays(ids), pa.concat_arrays(texts)
                ids, texts, held = [], [], 0
                give_back()
            ids.append(batch.column(0).slice(first, end - first))
            texts.append(batch.column(1).slice(first, end - first).cast(pa.large_string()).fill_null(""))
            held += size
    if ids:
        yield pa.concat_arrays(ids), pa.concat_arrays(texts)
    give_back()


def give_back() -> None:
    """Return freed memory to the system. A Python worker lives on for other tasks, and several share an executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)
    if trim:
        trim(0)


@lru_cache(1)
def _libc():
    try:
        return ctypes.CDLL(None)
    except OSError:
        return None


def block_id(ids: pa.Array, texts: pa.Array) -> int:
    """A 64-bit digest of all a block holds.

    A block that is computed again from rows in another order has another id, so answers never go to the wrong places.
    """
    offsets, data = text_buffers(texts)
    digest = hashlib.blake2b(str(ids.to_pylist()).encode(), digest_size=8)
    digest.update(np.diff(offsets).tobytes())
    digest.update(data[offsets[0] : offsets[-1]].tobytes())
    return int.from_bytes(digest.digest(), "little", signed=True)


def _after_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character before each place is white space, in UTF-8."""
    last = data[at - 1]
    white = _WHITE[last]
    wide = np.flatnonzero((last >= 0x80) & (at >= 2))
    if len(wide):
        one, two, three = last[wide], data[at[wide] - 2], data[np.maximum(at[wide] - 3, 0)]
        white[wide] = (
            ((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))
            | ((three == 0xE1) & (two == 0x9A) & (one == 0x80))
            | ((three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF)))
            | ((three == 0xE2) & (two == 0x81) & (one == 0x9F))
            | ((three == 0xE3) & (two == 0x80) & (one == 0x80))
        )
    return white


def stretches(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct stretches, code of each stretch of all texts in a row, first stretch of each text and the end).

    A text is cut in front of every space behind a character that is no white space: ` and`, `then`,
    ` a\\n\\nline`. Tokenizers that never merge across such a place can treat each stretch alone.
    """
    offsets, data = text_buffers(texts)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    begins = np.zeros(len(data) + 1, bool)
    space = np.flatnonzero(data == 0x20)
    space = space[space > 0]
    begins[space[~_after_white(data, space)]] = True
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    begins[-1] = True
    at = np.flatnonzero(begins)
    found = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)])
    coded = found.dictionary_encode()
    return coded.dictionary.cast(pa.large_string()), coded.indices.to_numpy(), np.searchsorted(at[:-1], offsets)


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places starts[i], starts[i] + 1, ... of all ranges in a row."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


def ends_of(lengths: np.ndarray) -> np.ndarray:
    """0 and the running total."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: np.ndarray, step: int = 1 << 18) -> np.ndarray:
    """values[starts[i] : starts[i] + lengths[i]] for every i of `at`, in a row; worked out a step at a time, to hold little beside the result."""
    parts = [at[i : i + step] for i in range(0, len(at), step)]
    sizes = ends_of(np.array([lengths[part].sum() for part in parts], np.int64))
    out = np.empty(sizes[-1], values.dtype)
    for part, a, b in zip(parts, sizes[:-1], sizes[1:], strict=True):
        out[a:b] = values[spread(starts[part], lengths[part])]
    return out


def packed(numbers: np.ndarray) -> list[bytes]:
    """Numbers below 2**32 as compressed planes of bytes, the lowest first."""
    planes = numbers.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    used = 1 + (int(numbers.max()).bit_length() - 1) // 8 if numbers.size and numbers.max() else 1
    return [pa.compress(np.ascontiguousarray(planes[:, i]), codec="zstd", asbytes=True) for i in range(used)]


def unpacked(planes: list[bytes], n: int) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    for i, plane in enumerate(planes):
        out[:, i] = np.frombuffer(pa.decompress(plane, n, "zstd"), np.uint8) if n else 0
    return out.view("<u4").reshape(-1)
