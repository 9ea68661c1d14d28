"""Best-fit packing of tokenised documents into sequences of a fixed length.

The plan is made from the histogram of piece lengths, which has at most `capacity` entries
whatever the corpus: patterns of one to three lengths that fill a sequence exactly are
enumerated, their repeat counts fitted to the histogram by non-negative least squares and
rounded down, and what is left is packed best-fit, longest first, by length and count. The pieces then
find their places by their rank within their length, in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.hashing import pieces as text_pieces
from tidemark.llm.hashing import text_buffers
from tidemark.llm.rows import settle

CAPACITY = 2048
END_ID = 0
# Pieces of one length are ranked in slots of about so many.
SLOT_ROWS = 100_000
FIT_STEPS = 300


def cut(docs: DataFrame, tokenizer: str, text: str = "text", id_col: str = "doc_id", *, capacity: int = CAPACITY,
        end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every piece of every document; with_ids adds ids.

    A document is its ids by the tokenizer file, then `end_id`; null text is empty. Only documents
    longer than `capacity` are cut. Whole texts are encoded, about 2 MB of them at a time.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tidemark.llm.tokens import word_tokenizer

        words = word_tokenizer(tokenizer, end_id)
        for batch in batches:
            offsets, _ = text_buffers(batch.column(1))
            for first, end in text_pieces(offsets):
                part = batch.slice(first, end - first)
                ids, at = words.encode([t or "" for t in part.column(1).to_pylist()])
                counts = -(-np.diff(at) // capacity)
                row = np.repeat(np.arange(len(counts)), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                length = np.minimum(np.diff(at)[row] - start, capacity)
                begin = at[row] + start
                raw = ids.astype("<u4")
                sums = [zlib.crc32(raw[b : b + n]) for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
                columns = [part.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(sums, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(np.append(begin - begin[:1].sum(), ids.size).astype(np.int32), ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return docs.select(F.col(id_col), F.col(text).cast("string")).mapInArrow(encode, ddl)


def patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (a, b, c), a <= b <= c, of lengths that fill a sequence exactly; 0 for no piece.

    At most capacity ** 2 / 12 or so: 350 thousand for 2048.
    """
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    there[0] = True
    found = []
    for a in np.flatnonzero(there).tolist():
        if 3 * a > capacity:
            break
        b = np.arange(a, (capacity - a) // 2 + 1)
        c = capacity - a - b
        good = there[b] & there[c] & ((a > 0) | (b > 0) | there[c])
        found.append(np.stack([np.full(good.sum(), a), b[good], c[good]], 1))
    return np.concatenate(found)


def fit(rows: np.ndarray, histogram: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns, least squares of (pieces used - histogram).

    Accelerated projected gradient; a pattern has three lengths, so products with the matrix are gathers and counts.
    """
    total = max(float(histogram.sum()), 1.0)
    goal = histogram / total
    goal[0] = 0.0

    def used(x):
        return sum(np.bincount(rows[:, i], x, len(goal)) for i in range(3)) * (np.arange(len(goal)) > 0)

    def slope(r):
        return r[rows[:, 0]] + r[rows[:, 1]] + r[rows[:, 2]]

    v = np.ones(len(rows))
    for _ in range(12):  # the largest eigenvalue sets the step
        v = slope(used(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1.0 / (1.05 * norm)
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(y - step * slope(used(y) - goal), 0.0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x * total


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[tuple[int, int]], int]]:
    """Groups (runs of (length, pieces in a row), number of sequences) that use up the histogram.

    histogram[l] is the number of pieces of length l; index 0 is not used. The work and the
    result depend on the capacity, not on the number of pieces.
    """
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    groups: list[tuple[list[tuple[int, int]], int]] = []
    if left[capacity]:
        groups.append(([(capacity, 1)], int(left[capacity])))
        left[capacity] = 0
    if left.any():
        rows = patterns(np.flatnonzero(left), capacity)
        if len(rows):
            x = np.floor(fit(rows, left.astype(float))).astype(np.int64)
            for i in np.argsort(-x, kind="stable")[: np.count_nonzero(x)].tolist():
                own = [n for n in rows[i].tolist() if n]
                runs = [(n, own.count(n)) for n in dict.fromkeys(sorted(own, reverse=True))]
                times = min(int(x[i]), *[int(left[n]) // m for n, m in runs])
                if times:
                    groups.append((runs, times))
                    for n, m in runs:
                        left[n] -= m * times
    return groups + _best_fit(left, capacity)


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best fit, longest first, over lengths and counts: equal sequences are filled together."""
    bins: list[list[tuple[list[tuple[int, int]], int]]] = [[] for _ in range(capacity + 1)]  # by room left
    for n in np.flatnonzero(left)[::-1].tolist():
        count = int(left[n])
        room = n
        while count:
            while room <= capacity and not bins[room]:
                room += 1
            if room > capacity:
                break
            runs, times = bins[room].pop()
            # Into each as many as it holds, as one after the other would go.
            deep = min(room // n, -(-count // times))
            full = min(times, count // deep)
            bins[room - deep * n].append(([*runs, (n, deep)], full))
            if times > full:
                bins[room].append((runs, times - full))
            count -= deep * full
        if count:
            each = capacity // n
            if count >= each:
                bins[capacity - each * n].append(([(n, each)], count // each))
            if count % each:
                bins[capacity - count % each * n].append(([(n, count % each)], 1))
    return [g for some in bins for g in some]


def _intervals(groups) -> np.ndarray:
    """Rows (length, first rank, pieces in a row, first sequence, offset), ordered."""
    rows, next_rank, sequence = [], {}, 0
    for runs, times in groups:
        offset = 0
        for n, m in runs:
            rank = next_rank.get(n, 0)
            rows.append((n, rank, m, sequence, offset))
            next_rank[n] = rank + m * times
            offset += n * m
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def place(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces with a `length` of 1 to `capacity`.

    `cut_pieces` is read twice, so it should be stored (see `pack`). Pieces alike in all
    columns may swap places.
    """
    counted = cut_pieces.groupBy("length").count().collect()  # at most `capacity` rows
    histogram = np.zeros(capacity + 1, np.int64)
    for n, count in counted:
        histogram[n] = count
    spots = _intervals(plan(histogram, capacity))
    slots = int(max(1, -(-histogram.max() // SLOT_ROWS)))

    numbered = cut_pieces.withColumn("_h", F.xxhash64("doc_id", "piece", "ids_crc32"))
    numbered = numbered.withColumn("_slot", F.pmod("_h", F.lit(slots)))
    in_slot = Window.partitionBy("length", "_slot").orderBy("_h", "doc_id", "piece")
    before = Window.partitionBy("length").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slot_sizes = numbered.groupBy("length", "_slot").count().select(
        "length", "_slot", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")
    )
    ranked = numbered.withColumn("_n", F.row_number().over(in_slot) - 1).join(slot_sizes, ["length", "_slot"])
    ranked = ranked.select(*cut_pieces.columns, (F.col("_before") + F.col("_n")).alias("_rank"))

    first = (spots[:, 0] << 44) + spots[:, 1]
    at_length, at_rank = cut_pieces.columns.index("length"), len(cut_pieces.columns)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, rank = (np.asarray(batch.column(i), np.int64) for i in (at_length, at_rank))
            spot = spots[np.searchsorted(first, (n << 44) + rank, "right") - 1]
            since = rank - spot[:, 1]
            sequence, offset = spot[:, 3] + since // spot[:, 2], spot[:, 4] + since % spot[:, 2] * n
            columns = [*batch.columns[:at_rank], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:at_rank], "sequence_id", "offset"])

    schema = cut_pieces.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(look_up, schema)


def pack(docs: DataFrame, tokenizer: str, text: str = "text", id_col: str = "doc_id", *, capacity: int = CAPACITY,
         end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pack all documents: a row for every piece with its sequence_id and offset.

    Columns as in `cut`, then sequence_id and offset. Null and empty texts are one piece of
    the end id; repeated rows are packed once each; an empty table gives an empty
    result; other columns than the two named are not read. Every sequence is gapless from
    0. The pieces are stored in the shared checkpoint folder, since the plan needs their lengths first.
    """
    return place(settle(cut(docs, tokenizer, text, id_col, capacity=capacity, end_id=end_id, with_ids=with_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed `with_ids`; at most `capacity` ids meet in a group."""
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids")
    )
