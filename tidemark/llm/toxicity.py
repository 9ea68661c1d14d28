"""Toxicity scores by a factorization machine over hashed terms.

A linear weight for each term and, for pairs of terms, the product of their factors: so a
pair can count for more or less than its two terms. Terms are words and the beginnings of
words, hashed into a fixed number of weights; the model is the same size for any corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.hashing import _BASE, _BYTE, mix, pieces, text_buffers

BITS = 18
FACTORS = 8
# Labelled documents the model is fitted to, at most; the bound of what the driver gathers.
TRAIN_DOCS = 12_000
# A term is learned if this many of them hold it.
LEAST_DOCS = 4
PREFIXES = (4, 5, 6, 7, 8)
# Its share among toxic and other texts must differ by so many standard errors for a weight of its own;
# terms that tell nothing alone take part in pairs only.
LEAST_Z = 4.5
EPOCHS = 12
FACTOR_STEP, FACTOR_DECAY = 0.003, 2e-3
THRESHOLD = 0.3

# Letters and digits make words; A-Z are lower-cased. Bytes of other scripts count as letters.
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def terms(offsets: np.ndarray, data: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(hashed terms of all texts, each once a text, in a row; where each text begins).

    A word gives itself and its first 4 to 8 bytes, as far as it is longer.
    """
    base = offsets[0]
    at = (offsets - base).astype(np.int64)
    data = _LOWER[data[base : base + at[-1]]]
    # Latin letters with marks, as UTF-8 has them: capitals are 32 below.
    data[1:][(data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] < 0x9F)] += 32
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = _INSIDE[data]
    cut = np.zeros(n + 1, bool)
    cut[at] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    ends[:-1] &= ~inside[1:] | cut[1:n]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    power = np.full(n + 1, _BASE, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:n], out=summed[1:])
    back = np.uint64(pow(int(_BASE), -n, 1 << 64))
    doc = np.searchsorted(at, start, "right") - 1
    hashes, docs = [], []
    for size in (None, *PREFIXES):
        some = slice(None) if size is None else end - start > size
        s = start[some]
        e = end[some] if size is None else s + size
        # A beginning is another term than the word of the same letters.
        h = mix((summed[e] - summed[s]) * power[n - s] * back + np.uint64(size or 0))
        hashes.append((h >> np.uint64(64 - bits)).astype(np.int64))
        docs.append(doc[some])
    both = np.unique((np.concatenate(docs) << bits) + np.concatenate(hashes))
    return both & ((1 << bits) - 1), np.searchsorted(both >> bits, np.arange(len(offsets)))


@dataclass
class Model:
    bias: float
    linear: np.ndarray  # (terms,)
    factors: np.ndarray  # (terms, FACTORS)
    known: np.ndarray  # terms that were learned; others are left out

    def raw(self, term: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Bias + sum of weights + sum over pairs of factor products, for each text."""
        counts = np.diff(begins)
        keep = self.known[term]
        row = np.repeat(np.arange(len(counts)), counts)[keep]
        term = term[keep]
        share = _share(row, len(counts))
        out = self.bias + np.bincount(row, self.linear[term], len(counts))
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f] * share[row]
            out += 0.5 * (np.bincount(row, v, len(counts)) ** 2 - np.bincount(row, v * v, len(counts)))
        return out


def _share(row: np.ndarray, n: int) -> np.ndarray:
    """Factors of a text are scaled by the root of its terms, so that long texts do not outweigh all."""
    return 1 / np.sqrt(np.maximum(np.bincount(row, minlength=n), 1.0)) ** 0.5


def _difference(term: np.ndarray, counts: np.ndarray, label: np.ndarray, held_by: np.ndarray) -> np.ndarray:
    """How far the shares of toxic and of other texts with each term lie apart, in standard errors."""
    toxic = np.bincount(term, np.repeat(label, counts), len(held_by))
    n1, n0 = max(label.sum(), 1), max((1 - label).sum(), 1)
    share = held_by / (n1 + n0)
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
    return (toxic / n1 - (held_by - toxic) / n0) / error


def fit(term: np.ndarray, begins: np.ndarray, label: np.ndarray, bits: int = BITS, seed: int = 7) -> Model:
    """Logistic loss, Adagrad over small batches in a fixed order of a fixed seed."""
    rng = np.random.default_rng(seed)
    counts = np.diff(begins)
    held_by = np.bincount(term, minlength=1 << bits)
    known = held_by >= LEAST_DOCS
    weighs = known & (np.abs(_difference(term, counts, label, held_by)) >= LEAST_Z)
    linear, factors = np.zeros(1 << bits), rng.normal(0, 0.02, (1 << bits, FACTORS))
    rate = float(np.clip(label.mean() if len(label) else 0.5, 1e-3, 1 - 1e-3))
    model = Model(float(np.log(rate / (1 - rate))), linear, factors, known)
    if not len(label) or label.min() == label.max():
        return model
    g_linear, g_factors = np.full(1 << bits, 1e-6), np.full((1 << bits, FACTORS), 1e-6)
    keep = known[term]
    row_of = np.repeat(np.arange(len(counts)), counts)[keep]
    term = term[keep]
    at = np.searchsorted(row_of, np.arange(len(counts) + 1))
    # Common terms tell little about a text; their steps are smaller.
    rarity = 1 / np.sqrt(np.maximum(held_by, 1) / LEAST_DOCS) ** 0.25
    for _ in range(EPOCHS):
        order = rng.permutation(len(counts))
        for lo in range(0, len(order), 64):
            docs = order[lo : lo + 64]
            n = at[docs + 1] - at[docs]
            own = np.repeat(at[docs] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            row, t = np.repeat(np.arange(len(docs)), n), term[own]
            share = _share(row, len(docs))[row][:, None]
            v = factors[t] * share
            total = np.stack([np.bincount(row, v[:, f], len(docs)) for f in range(FACTORS)], 1)
            raw = model.bias + np.bincount(row, linear[t], len(docs))
            raw += 0.5 * ((total**2).sum(1) - np.bincount(row, (v * v).sum(1), len(docs)))
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[docs]
            model.bias -= 0.02 * float(error.mean())
            u, own = np.unique(t, return_inverse=True)
            grad = error[row] + 2e-4 * linear[t]
            g_linear[u] += np.bincount(own, grad * grad)
            linear[u] -= weighs[u] * 0.15 * rarity[u] * np.bincount(own, grad) / np.sqrt(g_linear[u])
            grad_v = error[row][:, None] * (total[row] - v) * share + FACTOR_DECAY * factors[t]
            for f in range(FACTORS):
                g_factors[u, f] += np.bincount(own, grad_v[:, f] ** 2)
                factors[u, f] -= FACTOR_STEP * np.bincount(own, grad_v[:, f]) / np.sqrt(g_factors[u, f])
    return model


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", id_col: str = "doc_id",
    *, train_docs: int = TRAIN_DOCS, bits: int = BITS,
) -> Model:
    """Fit a model to at most `train_docs` labelled documents.

    Of each label (0, 1; other rows are left out) those `train_docs / 2` are taken whose ids hash smallest, so
    that a rare label is seen; the bias is set back to the true rate. The chosen labels, no more than
    `train_docs` rows, are broadcast to the documents, and the driver gathers hashed terms of their texts: one
    row of each id, however often it is there (of several texts that whose terms sort first).
    """
    known = labels.where(F.col(label).isin(0, 1)).select(F.col(id_col).alias("labelled"), F.col(label).cast("int").alias("y"))
    rates = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}  # two rows
    zero, one = (known.where(F.col("y") == y).distinct().orderBy(F.xxhash64("labelled"), "labelled").limit(train_docs // 2) for y in (0, 1))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    rows = texts.join(F.broadcast(zero.union(one)), F.col("id") == F.col("labelled")).select("y", "t", "id")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            for first, end in pieces(offsets):
                term, begins = terms(offsets[first : end + 1], data, bits)
                cells = [term[a:b].astype(np.int32).tobytes() for a, b in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[first:end], pa.array(cells, pa.binary()), batch.column(2)[first:end]], ["y", "terms", "id"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.mapInArrow(emit, f"y int, terms binary, id {kind}").groupBy("id", "y").agg(F.min("terms").alias("terms")).toArrow()
    y = np.asarray(found["y"], float)
    cells = [np.frombuffer(b, np.int32).astype(np.int64) for b in found["terms"].to_pylist()]
    order = sorted(range(len(cells)), key=lambda i: (cells[i].tobytes(), y[i]))  # the same model whatever order rows come in
    cells, y = [cells[i] for i in order], y[order]
    begins = np.concatenate([[0], np.cumsum([len(c) for c in cells])]).astype(np.int64)
    model = fit(np.concatenate([*cells, np.zeros(0, np.int64)]), begins, y, bits)
    seen, true = y.mean() if len(y) else 0.5, rates.get(1, 0) / max(sum(rates.values()), 1)
    if 0 < seen < 1 and 0 < true < 1:
        model.bias += float(np.log(true / (1 - true)) - np.log(seen / (1 - seen)))
    return model


def score(docs: DataFrame, model: Model, text: str = "text", *, bits: int = BITS, out: str = "score") -> DataFrame:
    """Add `out`, the chance that a text is toxic, to every document, from its whole text alone.

    Null and empty texts have no terms and get the chance that goes with the bias. An input column named
    `out` is replaced; repeated rows get equal scores; an empty table gives an empty result.
    """
    others = [c for c in docs.columns if c.lower() != out.lower()]
    small = docs.select(F.struct(*others).alias("row"), F.col(text).cast("string").alias("t"))
    where = np.flatnonzero(model.known)
    # Only learned terms travel to the tasks.
    packed = (model.bias, where.astype(np.int32), model.linear[where].astype(np.float32), model.factors[where].astype(np.float32))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, at, linear, factors = packed
        known = np.zeros(1 << bits, bool)
        known[at] = True
        full = np.zeros(1 << bits)
        full[at] = linear
        full_v = np.zeros((1 << bits, factors.shape[1]))
        full_v[at] = factors
        own = Model(bias, full, full_v, known)
        for batch in batches:
            offsets, data = text_buffers(batch.column(1))
            chance = np.zeros(batch.num_rows)
            for first, end in pieces(offsets):
                raw = own.raw(*terms(offsets[first : end + 1], data, bits))
                chance[first:end] = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chance)], ["row", out])

    schema = small.select("row").schema.add(out, "double")
    return small.mapInArrow(emit, schema).select(*[F.col("row")[c].alias(c) for c in others], out)


def held_out(id_col: str | Column = "doc_id") -> Column:
    """Whether a document is kept for testing: crc32 of its id as text, modulo 4, is 2."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(4)) == 2
