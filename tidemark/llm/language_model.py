"""Stupid-backoff scores of documents under the n-grams of the whole corpus.

Documents are dealt to batches. A batch sends each of its distinct n-grams once, with its count,
to the part of the count table that its hash belongs to; the part adds up what all
batches sent and answers each with the totals, in the order of its question. The batch joins the answers to
its n-grams by their place and sums per document. So n-grams cross the network once per
batch, not once per occurrence, and a very frequent one is no hot key.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import hashing

ORDER = 2
ALPHA = 0.4
# n-grams of two words or more count if the corpus holds them this often.
LEAST_COUNT = 2
BATCH_BYTES = 12_000_000


def _grams(texts: pa.ChunkedArray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(for k = 1..order the hash of the k-gram that ends at each word, 0 where the text is too short; first words)."""
    offsets, data = hashing.text_buffers(texts)
    words, first = [], [np.zeros(1, np.int64)]
    for a, b in hashing.pieces(offsets):
        w, f = hashing.word_hashes(offsets[a : b + 1], data)
        words.append(w)
        first.append(f[1:] + first[-1][-1])
    words = np.concatenate([*words, np.zeros(0, np.uint64)])
    first = np.concatenate(first)
    place = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    grams = [words]
    for k in range(2, order + 1):
        own = np.zeros(len(words), np.uint64)
        own[place >= k - 1] = hashing.ngram_hashes(words, first, k)[0]
        grams.append(own)
    return grams, first


def _questions(grams: list[np.ndarray], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams in order, with 0 first for the number of words; where each bucket begins."""
    every = np.concatenate([np.zeros(1, np.uint64), *[g[g != 0] for g in grams]])
    found = np.unique(every, return_counts=True)
    cuts = np.searchsorted(found[0], np.arange(1, buckets, dtype=np.uint64) * np.uint64((1 << 64) // max(buckets, 2)))
    return *found, np.concatenate([[0], cuts, [len(found[0])]])


def _ask(order: int, buckets: int):
    def ask(key: tuple, part: pa.Table) -> pa.Table:
        grams, _ = _grams(part["text"], order)
        hashes, counts, cuts = _questions(grams, buckets)
        counts = counts.astype(np.uint32)
        counts[0] = len(grams[0])
        rows = range(buckets)
        return pa.table({
            "batch": pa.array([key[0].as_py()] * buckets, pa.int32()),
            "bucket": pa.array(rows, pa.int32()),
            "hashes": pa.array([hashes[cuts[i] : cuts[i + 1]].tobytes() for i in rows], pa.binary()),
            "counts": pa.array([counts[cuts[i] : cuts[i + 1]].tobytes() for i in rows], pa.binary()),
        })

    return ask


def _answer(bucket: pa.Table) -> pa.Table:
    parts = [np.frombuffer(b, np.uint64) for b in bucket["hashes"].to_pylist()]
    counts = np.frombuffer(b"".join(bucket["counts"].to_pylist()), np.uint32)
    _, at = np.unique(np.concatenate(parts), return_inverse=True)
    totals = np.bincount(at, counts).astype(np.int64)[at]
    ends = np.cumsum([len(p) for p in parts])
    answers = [totals[e - len(p) : e].tobytes() for e, p in zip(ends.tolist(), parts, strict=True)]
    return pa.table({"batch": bucket["batch"], "bucket": bucket["bucket"], "totals": pa.array(answers, pa.binary())})


def _sum_up(order: int, buckets: int, alpha: float, least_count: int):
    def sum_up(key: tuple, part: pa.Table, answers: pa.Table) -> pa.Table:
        grams, first = _grams(part["text"], order)
        hashes, _, _ = _questions(grams, buckets)
        by_bucket = np.argsort(np.asarray(answers["bucket"]))
        raw = answers["totals"].to_pylist()
        totals = np.frombuffer(b"".join(raw[i] for i in by_bucket.tolist()), np.int64)
        n_all = float(totals[0])
        count = [totals[np.searchsorted(hashes, g)] for g in grams]
        n_words = np.diff(first)
        place = np.arange(len(grams[0])) - np.repeat(first[:-1], n_words)
        penalty, backed = np.log(alpha), np.minimum(place, order - 1)
        score = np.log(count[0] / max(n_all, 1.0)) + penalty * backed
        for k in range(2, order + 1):  # a longer n-gram that counts takes the place of a shorter one
            hit = np.flatnonzero((place >= k - 1) & (count[k - 1] >= least_count))
            backed[hit] = np.minimum(place[hit], order - 1) - (k - 1)
            score[hit] = np.log(count[k - 1][hit] / count[k - 2][hit - 1]) + penalty * backed[hit]
        doc = np.repeat(np.arange(len(n_words)), n_words)
        sums = np.bincount(doc, score, len(n_words))
        return pa.table({
            "doc_id": part["doc_id"],
            "n_words": pa.array(n_words),
            "n_backed_off": pa.array(np.bincount(doc, backed > 0, len(n_words)).astype(np.int64)),
            "log_score": pa.array(sums),
            "mean_log_score": pa.array(sums / np.maximum(n_words, 1), mask=n_words == 0),
        })

    return sum_up


def score(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    *,
    order: int = ORDER,
    alpha: float = ALPHA,
    least_count: int = LEAST_COUNT,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_backed_off, log_score, mean_log_score) of every document.

    Words are runs of other characters than space, tab, LF, VT, FF and CR, case kept. The score of a word
    is count(n-gram) / count(context) for its longest n-gram, up to `order` words, that
    the corpus holds `least_count` times; one word alone always counts, against all words.
    Each step from the longest n-gram that the place allows costs a factor `alpha`. Counts are over all
    documents. log_score is the sum of logarithms; mean_log_score is per word. Null and empty texts have no
    words, a log_score of 0 and no mean. Repeated rows count and come back as often as they
    are there; an empty table gives an empty result; other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = int(size // batch_bytes) + 1
    dealt = own.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int").alias("batch"), "doc_id", "text")
    questions = dealt.groupBy("batch").applyInArrow(_ask(order, batches), "batch int, bucket int, hashes binary, counts binary")
    answers = questions.groupBy("bucket").applyInArrow(_answer, "batch int, bucket int, totals binary")
    answers = answers.select(F.col("batch").alias("to"), "bucket", "totals")
    return dealt.groupBy("batch").cogroup(answers.groupBy("to")).applyInArrow(
        _sum_up(order, batches, alpha, least_count),
        f"doc_id {kind}, n_words long, n_backed_off long, log_score double, mean_log_score double",
    )
