"""Alignment of the tokens of two tokenizers over the same bytes.

Tokens are byte ranges of a text. Within a batch, `merge_asof` by document finds for the start of every token the
token of the other side that covers it; both directions together are the overlaps. Where a token starts
together with the one that covers it, both sides ended before it: there the text is cut into groups. All pairs
of one group are linked. Every distinct pair of a document is counted once over the corpus, in a table of pairs that all
blocks of documents join for the counts of theirs.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.blocks import BLOCK_BYTES, block_id, blocks_of, ends_of, give_back, packed, spread, stretches, unpacked
from tidemark.llm.rows import settle
from tidemark.llm.tokens import _byte_of_char

# Bits of an id in a pair of ids.
ID_BITS = 24
# Groups with more links than this are paired by their distinct ids; the links are the same.
WIDE_GROUP = 1024
# Bytes of text whose tokens are aligned at a time.
BATCH_BYTES = 1 << 18

_SPACE = "▁"


# Stretches encoded at a time; what the libraries return for one takes far more room than its ids.
FEW = 5_000
# The words of a byte-level vocabulary in printable ASCII (fixed values): where the library itself is not needed to find them.
_PLAIN = re.compile(r"[ -~\n\t]*")
_PLAIN_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"


class ByteLevel:
    """Tokens of a byte-level vocabulary; special tokens are ordinary text.

    Where the ids are in the order of the merges, as they usually are, plain stretches are encoded by the ids as ranks;
    all others by the library.
    """

    def __init__(self, path: str):
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        as_byte = _byte_of_char()
        self.bytes = [b""] * self.model.get_vocab_size()
        for token, i in self.model.get_vocab().items():
            plain = all(c in as_byte for c in token)
            self.bytes[i] = bytes(as_byte[c] for c in token) if plain else token.encode()
        self.ranks = None
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, split = spec["model"]["vocab"], spec.get("pre_tokenizer") or {}
        merged = [vocab.get("".join(m) if isinstance(m, list) else m.replace(" ", "")) for m in spec["model"].get("merges", [])]
        if split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and spec.get("normalizer") is None and merged == list(range(256, 256 + len(merged))):
            ranks = {self.bytes[i]: i for i in range(256 + len(merged))}
            self.ranks = tiktoken.Encoding("plain", pat_str=_PLAIN_WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, stretches: list[str]) -> list[list[int]]:
        if self.ranks is None:
            return self._by_library(stretches)
        plain = [_PLAIN.fullmatch(s) is not None for s in stretches]
        others = iter(self._by_library([s for s, p in zip(stretches, plain, strict=True) if not p]))
        return [self.ranks.encode_ordinary(s) if p else next(others) for s, p in zip(stretches, plain, strict=True)]

    def _by_library(self, stretches: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(stretches, add_special_tokens=False)]


class Pieces:
    """Tokens of a sentence-piece vocabulary that puts a space in front of a text."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        self.space = self.model.piece_to_id(_SPACE)
        # Stretches begin at a space behind another character; no piece may go on over that place.
        if any(_SPACE in p.lstrip(_SPACE) for p in pieces):
            raise ValueError("a piece of the vocabulary holds a space behind another character")

    def encode(self, stretches: list[str]) -> list[list[int]]:
        found = self.model.encode([s[1:] for s in stretches], num_threads=1)
        return [ids if len(s) > 1 else [self.space] for s, ids in zip(stretches, found, strict=True)]


@lru_cache(4)
def _load(kind: type, path: str):
    loaded = kind(path)
    give_back()
    return loaded


class Side:
    """The tokens of distinct stretches by one tokenizer: ids and lengths in bytes, stretch after stretch."""

    def __init__(self, tokenizer, stretches: list[str]):
        count, flat = array("i"), array("i")
        for i in range(0, len(stretches), FEW):
            for ids in tokenizer.encode(stretches[i : i + FEW]):
                count.append(len(ids))
                flat.extend(ids)
        self.count, self.ids = np.array(count, np.int64), np.array(flat, np.int64)
        self.begin = ends_of(self.count)[:-1]
        table = pa.array(tokenizer.bytes, pa.large_binary())
        self.size = pyarrow.compute.binary_length(table).to_numpy()[self.ids]
        joined = table.take(pa.array(self.ids))
        ends = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1) if len(joined) else np.zeros(1, np.int64)
        data = joined.buffers()[2].to_pybytes() if len(joined) else b""
        cuts = ends[ends_of(self.count)].tolist()
        self.whole = np.fromiter(
            (data[a:b] == s.encode() for a, b, s in zip(cuts[:-1], cuts[1:], stretches, strict=True)), bool, len(stretches)
        )


def _tokens(side: Side, at: np.ndarray, doc: np.ndarray) -> pd.DataFrame:
    """The tokens of stretches in a row: document, id, first byte in the batch."""
    places = spread(side.begin[at], side.count[at])
    size = side.size[places]
    return pd.DataFrame({"doc": np.repeat(doc, side.count[at]), "id": side.ids[places], "start": np.cumsum(size) - size})


def groups_of(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """(group of each token of a, of each of b, number of overlaps); a and b cover the same bytes, in order of start."""
    left = pd.DataFrame({"doc": a["doc"], "start": a["start"]})
    right = pd.DataFrame({"doc": b["doc"], "start": b["start"]})
    left["at"], right["at"] = np.arange(len(a)), np.arange(len(b))
    in_b = pd.merge_asof(left, right.rename(columns={"at": "other"}).assign(begins=right["start"]), on="start", by="doc")
    in_a = pd.merge_asof(right, left.rename(columns={"at": "other"}).assign(begins=left["start"]), on="start", by="doc")
    opens_a, opens_b = (x["begins"].to_numpy() == x["start"].to_numpy() for x in (in_b, in_a))
    # A pair that starts together is found both ways.
    overlaps = len(a) + len(b) - int(opens_a.sum())
    return np.cumsum(opens_a) - 1, np.cumsum(opens_b) - 1, overlaps


def links_of(group_a: np.ndarray, ids_a: np.ndarray, group_b: np.ndarray, ids_b: np.ndarray, wide: int = WIDE_GROUP):
    """(group, id of a, id of b, number of links) over all groups; a pair of ids may come several times."""
    n = int(group_a[-1]) + 1 if len(group_a) else 0
    n_a, n_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
    first_a, first_b = ends_of(n_a)[:-1], ends_of(n_b)[:-1]
    narrow = np.flatnonzero(n_a * n_b <= wide)
    links = (n_a * n_b)[narrow]
    inner = spread(np.zeros(len(narrow), np.int64), links)
    width = np.repeat(n_b[narrow], links)
    group = [np.repeat(narrow, links)]
    a = [ids_a[np.repeat(first_a[narrow], links) + inner // np.maximum(width, 1)]]
    b = [ids_b[np.repeat(first_b[narrow], links) + inner % np.maximum(width, 1)]]
    times = [np.ones(len(inner), np.int64)]
    for g in np.flatnonzero(n_a * n_b > wide).tolist():
        own_a, times_a = np.unique(ids_a[first_a[g] : first_a[g] + n_a[g]], return_counts=True)
        own_b, times_b = np.unique(ids_b[first_b[g] : first_b[g] + n_b[g]], return_counts=True)
        a.append(np.repeat(own_a, len(own_b)))
        b.append(np.tile(own_b, len(own_a)))
        times.append(np.outer(times_a, times_b).ravel())
        group.append(np.full(len(a[-1]), g))
    return tuple(np.concatenate(x) for x in (group, a, b, times))


def _labels(n: int) -> pa.Array:
    """`i,` `i|` `i;` for every id i, at 3 i, 3 i + 1, 3 i + 2."""
    return pa.array([f"{i}{mark}".encode() for i in range(n) for mark in ",|;"], pa.large_binary())


def written(group_a, ids_a, group_b, ids_b, docs_first_a, docs_first_b, labels: pa.Array) -> list[bytes]:
    """`a1,a2|b1;a3|b2,b3` of every document: the ids of its groups in order."""
    last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (group_a, group_b))
    pick = np.concatenate([ids_a * 3 + last_a, ids_b * 3 + 2 * last_b])
    group = np.concatenate([group_a * 2, group_b * 2 + 1])
    order = np.argsort(group, kind="stable")
    joined = labels.take(pa.array(pick[order]))
    ends = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1) if len(joined) else np.zeros(1, np.int64)
    data = joined.buffers()[2].to_pybytes() if len(joined) else b""
    cuts = ends[docs_first_a + docs_first_b].tolist()
    return [data[x : y - 1] if y > x else b"" for x, y in zip(cuts[:-1], cuts[1:], strict=True)]


def _aligned(ids: pa.Array, texts: pa.Array, a_tokens, b_tokens, labels: pa.Array, with_pairs: bool):
    """Per document of a block: n_a, n_b, n_groups, n_links, n_overlaps and the groups written out; and (document, pair, links) of all distinct pairs."""
    n = len(ids)
    filled = pa.compute.not_equal(pa.compute.binary_length(texts), 0)
    led = pa.compute.if_else(filled, pa.compute.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())), texts)
    distinct, at, first = stretches(led)
    strings = distinct.to_pylist()
    side_a, side_b = Side(a_tokens, strings), Side(b_tokens, strings)
    bad = ends_of(~(side_a.whole & side_b.whole)[at])[first]
    usable = np.flatnonzero((np.diff(first) > 0) & (np.diff(bad) == 0))
    numbers = np.zeros((n, 5), np.int64)
    texts_of = [b""] * n
    owners, pairs, links = [], [], []
    size = ends_of(side_a.size)[side_a.begin + side_a.count] - ends_of(side_a.size)[side_a.begin]
    sizes = np.diff(ends_of(size[at])[first])[usable]
    part_of = np.cumsum(sizes) // BATCH_BYTES
    for part in np.split(usable, np.flatnonzero(np.diff(part_of)) + 1 if len(usable) else []):
        if not len(part):
            continue
        own = np.diff(first)[part]
        chosen, doc = at[spread(first[part], own)], np.repeat(np.arange(len(part)), own)
        a, b = _tokens(side_a, chosen, doc), _tokens(side_b, chosen, doc)
        group_a, group_b, _ = groups_of(a, b)
        doc_a, doc_b, ids_a, ids_b = a["doc"].to_numpy(), b["doc"].to_numpy(), a["id"].to_numpy(), b["id"].to_numpy()
        group, pair_a, pair_b, times = links_of(group_a, ids_a, group_b, ids_b)
        opens = np.append(True, group_a[1:] != group_a[:-1])
        doc_of_group = doc_a[opens]
        together = np.bincount(doc_a, np.isin(a["start"].to_numpy(), b["start"].to_numpy(), assume_unique=True), len(part)).astype(np.int64)
        n_a, n_b = np.bincount(doc_a, minlength=len(part)), np.bincount(doc_b, minlength=len(part))
        n_links = np.bincount(doc_of_group, np.bincount(group_a) * np.bincount(group_b), len(part)).astype(np.int64)
        numbers[part] = np.stack([n_a, n_b, np.bincount(doc_of_group, minlength=len(part)), n_links, n_a + n_b - together], 1)
        for i, text in zip(part.tolist(), written(group_a, ids_a, group_b, ids_b, ends_of(n_a), ends_of(n_b), labels), strict=True):
            texts_of[i] = text
        if with_pairs:
            pair = (pair_a << ID_BITS) | pair_b
            local, code = np.unique(pair, return_inverse=True)
            key, place = np.unique(doc_of_group[group] * len(local) + code, return_inverse=True)
            owners.append(part[key // len(local)])
            pairs.append(local[key % len(local)])
            links.append(np.bincount(place, times, len(key)).astype(np.int64))
    return numbers, texts_of, *(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owners, pairs, links))


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


def _rows(docs: DataFrame, text: str, id_col: str) -> tuple[DataFrame, str]:
    return docs.select(F.col(id_col), F.col(text).cast("string")), docs.schema[id_col].dataType.simpleString()


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", id_col: str = "doc_id", *,
          block_bytes: int = BLOCK_BYTES // 8) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_overlaps, groups) of every document.

    Side A is a byte-level vocabulary over a space and the text, side B a sentence-piece one, which adds the
    space itself. `groups` has the ids of the groups in order: `a1,a2|b1;a3|b2,b3`. All tokens of a group are linked with
    each other; those that share a byte overlap. A text that is null or empty, or that either side does not give back byte by
    byte, has no tokens: zeros and an empty `groups`. Repeated rows and rows without an id come back as they
    are, an empty table gives an empty result, other columns are not read. Whole texts are aligned.
    """
    rows, kind = _rows(docs, text, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_tokens, b_tokens = _load(ByteLevel, a_path), _load(Pieces, b_path)
        labels = _labels(max(len(a_tokens.bytes), len(b_tokens.bytes)))
        for ids, texts in blocks_of(batches, block_bytes):
            numbers, groups, *_ = _aligned(ids, texts, a_tokens, b_tokens, labels, False)
            columns = [ids, *[pa.array(np.ascontiguousarray(numbers[:, i])) for i in range(5)], pa.array([g.decode() for g in groups], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *NUMBERS, "groups"])

    return rows.mapInArrow(run, f"doc_id {kind}, {', '.join(f'{c} long' for c in NUMBERS)}, groups string")


def link_counts(docs: DataFrame, a_path: str, b_path: str, text: str = "text", id_col: str = "doc_id", *,
                block_bytes: int = BLOCK_BYTES // 8) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum, groups_sha256) of every document; cases as in `align`.

    A pair of ids counts the documents that hold it linked (rows, if ids repeat). `count_sum` adds the counts of a
    document's links, `n_best` is the number of links whose count is the highest of their id of A, ties included.
    `groups_sha256` is the digest of the groups of `align`, empty without tokens: written out, they are longer than the texts
    and would have to be stored. Every block of documents lists its distinct pairs once, with codes; documents are stored
    as numbers of links by code, in the shared checkpoint folder, so that they are aligned once.
    """
    import hashlib

    rows, kind = _rows(docs, text, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_tokens, b_tokens = _load(ByteLevel, a_path), _load(Pieces, b_path)
        labels = _labels(max(len(a_tokens.bytes), len(b_tokens.bytes)))
        for ids, texts in blocks_of(batches, block_bytes):
            numbers, groups, owners, pairs, links = _aligned(ids, texts, a_tokens, b_tokens, labels, True)
            keys, codes, n_docs = np.unique(pairs, return_inverse=True, return_counts=True)
            columns = [
                [block_id(ids, texts)],
                [ids.to_pylist()],
                *[[numbers[:, i]] for i in range(5)],
                [[hashlib.sha256(g).hexdigest() if g else "" for g in groups]],
                [np.bincount(owners, minlength=len(ids))],
                [packed(codes)],
                [packed(links)],
                [keys],
                [n_docs],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, stored, strict=True)], stored.names)

    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(docs.schema[id_col].dataType)
    longs, binaries = pa.list_(pa.int64()), pa.list_(pa.binary())
    fields = [("block", pa.int64()), ("doc_ids", pa.list_(id_type)), *[(c, longs) for c in NUMBERS], ("digests", pa.list_(pa.string()))]
    fields += [("n_pairs", longs), ("codes", binaries), ("links", binaries), ("pairs", longs), ("n_docs", longs)]
    stored = pa.schema(fields)
    ddl = f"block long, doc_ids array<{kind}>, {', '.join(f'{c} array<long>' for c in NUMBERS)}, digests array<string>, n_pairs array<long>, "
    blocks = settle(rows.mapInArrow(run, ddl + "codes array<binary>, links array<binary>, pairs array<long>, n_docs array<long>"))

    uses = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "n_docs")).alias("code", "use"))
    uses = uses.select("block", "code", F.col("use.pairs").alias("pair"), F.col("use.n_docs").alias("n"))
    counts = uses.groupBy("pair").agg(F.sum("n").alias("count"))
    counts = counts.withColumn("a", F.shiftright("pair", ID_BITS))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    known = counts.join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = uses.join(known, "pair").select(F.col("block").alias("to"), "code", "count", "best")

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        code = right.column("code").to_numpy()
        size = int(code.max()) + 1 if len(code) else 0
        count, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        count[code], best[code] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        out = []
        for block in left.to_pylist():
            own = np.array(block["n_pairs"], np.int64)
            codes, links = (unpacked(block[c], int(own.sum())) for c in ("codes", "links"))
            ends = ends_of(own)
            n_best, count_sum = (np.diff(ends_of(links * x[codes])[ends]) for x in (best, count))
            columns = [pa.array(block["doc_ids"], id_type), *[pa.array(block[c], pa.int64()) for c in NUMBERS]]
            columns += [pa.array(n_best), pa.array(count_sum), pa.array(block["digests"], pa.string())]
            out.append(pa.table(columns, names))
        return pa.concat_tables(out) if out else pa.table([pa.array([], t) for t in [id_type, *[pa.int64()] * 7, pa.string()]], names)

    names = ["doc_id", *NUMBERS, "n_best", "count_sum", "groups_sha256"]
    both = blocks.drop("pairs", "n_docs").groupBy("block").cogroup(answers.groupBy("to"))
    return both.applyInArrow(total, f"doc_id {kind}, {', '.join(f'{c} long' for c in names[1:-1])}, groups_sha256 string")
