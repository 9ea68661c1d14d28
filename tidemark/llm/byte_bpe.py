"""Byte-level BPE: encoding by a global table of distinct words, and decoding by the table of token bytes.

The words of a text are the matches of the tokenizer's pattern. Every block of documents gives its
distinct words with the positions they stand at. The words of all blocks are shuffled by word, so
that each distinct one is encoded once in the whole corpus; its ids are joined back to the
blocks that hold it and put in place by position.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.blocks import BLOCK_BYTES, block_id, blocks_of, ends_of, gathered, give_back, packed, stretches, unpacked
from tidemark.llm.hashing import pieces

# Words of a block that are sent on at a time.
ROWS = 10_000
# Tokens decoded at a time; whole texts, a longer one by itself.
TOKENS = 1_000_000


@lru_cache(2)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file, without special tokens."""
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(ranks), special_tokens={})


@lru_cache(2)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@lru_cache(2)
def token_bytes(path: str) -> pa.Array:
    """The bytes of each id, at the place of the id; null where there is none."""
    by_id = {rank: token for token, rank in read_ranks(path).items()}
    return pa.array([by_id.get(i) for i in range(max(by_id) + 1)], pa.large_binary())


def word_pattern(pattern: str) -> regex.Pattern:
    """The tokenizer's pattern for the `regex` library, whose own white space holds U+001C to U+001F, too."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


class Words:
    """The distinct words of texts, the most frequent first, and the code of the word at every position.

    No match of the pattern goes on over a space behind another character, and none looks back, so
    distinct stretches are matched once.
    """

    def __init__(self, texts: pa.Array, pattern: regex.Pattern):
        stretch, self._at, first = stretches(texts)
        codes: dict[str, int] = {}
        flat, lengths = array("i"), array("i")
        for s in stretch.to_pylist():
            own = pattern.findall(s)
            lengths.append(len(own))
            flat.extend([codes.setdefault(word, len(codes)) for word in own])
        flat, self._lengths = np.array(flat, np.int32), np.array(lengths, np.int32)
        self._begins = ends_of(self._lengths)[:-1]
        times = np.bincount(self._at, minlength=len(self._lengths))
        order = np.argsort(-np.bincount(flat, np.repeat(times, self._lengths), len(codes)), kind="stable")
        rank = np.empty(len(codes), np.uint32)
        rank[order] = np.arange(len(codes), dtype=np.uint32)
        words = list(codes)
        self.words = [words[i] for i in order.tolist()]
        self._flat = rank[flat]
        #: The words of each text.
        self.counts = np.diff(ends_of(self._lengths[self._at])[first])

    def codes(self) -> np.ndarray:
        """The code of every word of all texts in a row."""
        return gathered(self._flat, self._begins, self._lengths, self._at)


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", id_col: str = "doc_id", *,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids) of every document: its token ids by a rank file, special tokens being ordinary text.

    Null and empty texts have no ids; repeated rows come back as often, rows without an id
    too; an empty table gives an empty result; other columns are not read. Whole texts are encoded;
    one of any length is one row of a task. `ranks` is a path that every executor can open.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.col(text).cast("string"))

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = word_pattern(pattern)
        for ids, texts in blocks_of(batches, block_bytes):
            words = Words(texts, match)
            columns = [[block_id(ids, texts)], [ids.to_pylist()], [words.counts], [len(words.words)], [packed(words.codes())]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, position_types, strict=True)], position_names)

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = word_pattern(pattern)
        for ids, texts in blocks_of(batches, block_bytes):
            words, block = pa.array(Words(texts, match).words, pa.string()), block_id(ids, texts)
            for i in range(0, len(words), ROWS):
                part = words.slice(i, ROWS)
                columns = [part, pa.array(np.full(len(part), block)), pa.array(np.arange(i, i + len(part), dtype=np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["word", "block", "code"])

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoding(ranks, pattern)
        last = (None, [])  # equal words come in a row, also over two batches
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            words = coded.dictionary.to_pylist()
            found = [last[1] if w == last[0] else own.encode_ordinary(w) for w in words]
            last = (words[-1], found[-1]) if words else last
            yield _answers(batch.column(1).to_numpy(), batch.column(2).to_numpy(), coded.indices.to_numpy(), found)

    position_names = ["block", "doc_ids", "n_words", "n_distinct", "planes"]
    id_type = _arrow_type(docs, id_col)
    position_types = [pa.int64(), pa.list_(id_type), pa.list_(pa.int64()), pa.int64(), pa.list_(pa.binary())]
    placed = rows.mapInArrow(positions, f"block long, doc_ids array<{kind}>, n_words array<long>, n_distinct long, planes array<binary>")
    words = rows.mapInArrow(words_of, "word string, block long, code int")
    answers = words.repartition("word").sortWithinPartitions("word").mapInArrow(encode_words, ANSWER)

    def reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for block in left.to_pylist():
            begins, lengths, ids = _joined(right, block["n_distinct"])
            counts = np.array(block["n_words"], np.int64)
            at = unpacked(block["planes"], int(counts.sum()))
            flat = gathered(ids, begins, lengths, at)
            ends = ends_of(lengths[at])[ends_of(counts)]
            give_back()
            out.append(pa.table([pa.array(block["doc_ids"], id_type), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], id_type), pa.array([], pa.list_(pa.int32()))], names)

    names = ["doc_id", "ids"]
    both = placed.groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(reassemble, f"doc_id {kind}, ids array<int>")


ANSWER = "block long, n int, n_ids int, codes array<binary>, lengths array<binary>, ids array<binary>"


def _answers(blocks: np.ndarray, codes: np.ndarray, at: np.ndarray, found: list[list[int]]) -> pa.RecordBatch:
    """One row per block for the words of a batch: their codes (as differences), the numbers of their ids, the ids; `at` says which of `found` a word has."""
    flat = np.fromiter((i for own in found for i in own), np.uint32)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    begins = ends_of(lengths)[:-1]
    order = np.lexsort((codes, blocks))
    blocks, codes, at = blocks[order], codes[order], at[order]
    cuts = np.append(np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])), len(blocks)).tolist() if len(blocks) else [0]
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = at[a:b]
        ids = gathered(flat, begins, lengths, own)
        rows.append((blocks[a], b - a, len(ids), packed(np.diff(codes[a:b], prepend=0)), packed(lengths[own]), packed(ids)))
    binaries = pa.list_(pa.binary())
    types = [pa.int64(), pa.int32(), pa.int32(), binaries, binaries, binaries]
    columns = zip(*rows) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["block", "n", "n_ids", "codes", "lengths", "ids"])


def _joined(answers: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, length) of the ids of each of a block's `n` words, and all ids."""
    begins, lengths = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    ids, held = [], 0
    for row in answers.to_pylist():
        codes = np.cumsum(unpacked(row["codes"], row["n"]).astype(np.int64))
        own = unpacked(row["lengths"], row["n"]).astype(np.int64)
        lengths[codes] = own
        begins[codes] = held + ends_of(own)[:-1]
        ids.append(unpacked(row["ids"], row["n_ids"]).astype(np.int32))
        held += row["n_ids"]
    if (lengths < 0).any():
        raise RuntimeError("a block was computed again from rows in another order; store the documents first")
    return begins, lengths, np.concatenate(ids) if ids else np.zeros(0, np.int32)


def _arrow_type(docs: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema[column].dataType)


def decode(encoded: DataFrame, ranks: str, ids: str = "ids") -> DataFrame:
    """Add `decoded`, the bytes of the tokens in `ids`, by a join with the token-byte table.

    The table has one row per id of the vocabulary, in order, so the join is a look-up by place in each batch.
    Null ids give null, no ids no bytes. An id that is not in the table is an error. Any number of rows, in
    other columns too, is passed on as it is.
    """
    names = [c for c in encoded.columns if c != "decoded"]
    at = names.index(ids)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(ranks)
        for batch in batches:
            sizes = batch.column(at).value_lengths().fill_null(0).to_numpy()
            for first, end in pieces(ends_of(sizes), TOKENS):
                part = batch.slice(first, end - first)
                lists = part.column(at)
                tokens = table.take(lists.flatten())
                if tokens.null_count:
                    raise ValueError("an id is not in the token-byte table")
                offsets = np.frombuffer(tokens.buffers()[1], np.int64, len(tokens) + 1) if len(tokens) else np.zeros(1, np.int64)
                data = tokens.buffers()[2] if len(tokens) else pa.py_buffer(b"")
                offsets = pa.py_buffer(offsets[ends_of(sizes[first:end])])
                whole = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, offsets, data]).cast(pa.binary())
                whole = pa.compute.if_else(lists.is_valid(), whole, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, whole], [*names, "decoded"])
        give_back()

    chosen = encoded.select(*[F.col(f"`{c}`") for c in names])
    return chosen.mapInArrow(join, T.StructType([*chosen.schema.fields, T.StructField("decoded", T.BinaryType())]))
