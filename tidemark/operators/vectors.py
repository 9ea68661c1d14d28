"""Exact nearest neighbours over a table of vectors, and vector upsert.

Vectors and queries are packed into blocks inside their own partitions, and blocks
are joined on the filter columns. One joined row stands for a whole block of
distances, which numpy computes at once; only the k best per query leave it, so no
query-vector pair ever becomes a row and only k rows per query and block shuffle.

The work of a filter value is dealt to a grid: a query block goes to one row of it, a vector block to one column,
and each pair of blocks meets in one piece. There are about PIECES_PER_CORE pieces a core in all, so a block is
copied no more often as the tables grow.

Where a filter value has many blocks, vectors and queries are dealt to cells around pivots first, and a block is a ball
of one cell. A first pass over one ball of a query's own cell bounds its k-th distance;
by the triangle inequality only balls that come nearer than that are joined in the second.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.lanes import latest_per_key

METRICS = ("l2", "cosine")
# Cells at most: their pivots and the distances between them are broadcast (256 vectors, 65,536 numbers).
MAX_CELLS = 256
# Blocks of the most frequent filter value for each cell: with fewer, cells only make blocks small.
CELL_BLOCKS = 4
# Pieces that the pairs of blocks are dealt to, for each core.
PIECES_PER_CORE = 2
# Vectors that a task packs together, so that its blocks fill up across Arrow batches.
CHUNK_BYTES = 16 << 20
# The cell of vectors that have no place among the pivots: all of them are searched.
ANYWHERE = -1

# Executors get these helpers inside the task, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def latest_vectors(vectors: DataFrame, *, id: str = "id", version: str = "updated_at") -> DataFrame:
    """The table after upserts: the newest row of each id."""
    return latest_per_key(vectors, [id], [F.col(version)])


def _chunks(batches: Iterator[pd.DataFrame], embedding: str) -> Iterator[pd.DataFrame]:
    """The rows of a partition, about CHUNK_BYTES of float32 numbers at a time."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += 4 * sum(map(len, batch[embedding]))
        if size >= CHUNK_BYTES:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _blocks(df: DataFrame, id: str, embedding: str, on: list[str], rows: int, prefix: str) -> DataFrame:
    """(on..., <prefix>_ids, <prefix>_data): blocks of at most `rows` vectors as float32 bytes."""
    schema = T.StructType(
        [df.schema[c] for c in on]
        + [
            T.StructField(f"{prefix}_ids", T.ArrayType(df.schema[id].dataType)),
            T.StructField(f"{prefix}_data", T.BinaryType()),
        ]
    )

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _chunks(batches, embedding):
            groups = batch.groupby(on, sort=False) if on else [((), batch)]
            out = []
            for key, group in groups:
                for start in range(0, len(group), rows):
                    part = group.iloc[start : start + rows]
                    data = np.stack(part[embedding].to_numpy()).astype(np.float32)
                    out.append((*key, part[id].to_list(), data.tobytes()))
            yield pd.DataFrame(out, columns=schema.names)

    return df.select(*on, id, embedding).mapInPandas(pack, schema)


def _usable(df: DataFrame, id: str, embedding: str, on: list[str]) -> DataFrame:
    """Rows that can be compared, with the number of dimensions as `_dim`."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(id).isNotNull() & F.col(embedding).isNotNull())
    rows = rows.na.drop(subset=on) if on else rows
    return rows.where((F.size(embedding) > 0) & finite).withColumn("_dim", F.size(embedding))


def _exact(queries: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    """Distances of paired rows, always summed in the same order so that equal vectors tie."""
    if metric == "l2":
        return np.square(queries - vectors).sum(axis=1)
    norms = np.sqrt(np.square(queries).sum(axis=1) * np.square(vectors).sum(axis=1))
    dots = (queries * vectors).sum(axis=1)
    return 1.0 - np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)


def _block_best(q_ids, q, v_ids, v, k: int, metric: str) -> list[dict]:
    """The k nearest of the block's vectors for each of its queries, ties to the smaller id."""
    rough = -(q @ v.T)
    if metric == "l2":
        rough = np.square(q).sum(axis=1)[:, None] + np.square(v).sum(axis=1)[None, :] + 2 * rough
    else:
        norms = np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(v, axis=1)[None, :]
        rough = np.divide(rough, norms, out=np.zeros_like(rough), where=norms > 0)
    k = min(k, v.shape[0])
    # The matrix product rounds differently from the exact sum, so take a margin and recompute.
    reach = np.partition(rough, k - 1, axis=1)[:, k - 1]
    margin = 1e-9 * (1.0 + np.abs(rough).max())
    best = []
    for i, q_id in enumerate(q_ids):
        near = np.flatnonzero(rough[i] <= reach[i] + margin)
        exact = _exact(np.broadcast_to(q[i], (len(near), q.shape[1])), v[near], metric)
        for j in np.lexsort((v_ids[near], exact))[:k]:
            best.append({"query_id": q_id, "id": v_ids[near[j]], "distance": float(exact[j])})
    return best


def knn(
    queries: DataFrame,
    vectors: DataFrame,
    *,
    k: int = 5,
    metric: str = "l2",
    on: list[str] | None = None,
    where: Column | None = None,
    query_id: str = "query_id",
    id: str = "id",
    embedding: str = "embedding",
    query_rows: int = 256,
    vector_rows: int = 4096,
    cells: int | None = None,
) -> DataFrame:
    """(query_id, id, rank, distance): the k nearest vectors of every query.

    `on` names metadata columns both sides have: a query only sees vectors with equal
    values. `where` is a condition on the vectors. Both apply before ranking. l2 is the
    squared distance, cosine is 1 - similarity. A query without candidates has no rows.
    A vector that is null or empty or holds a null or non-finite number takes no part on either
    side, and a query only sees vectors of its own number of dimensions.

    A filter value with much of the work, or none at all, is spread over a grid of pieces; others are one piece each.

    `cells` is the number of cells, by default one for each CELL_BLOCKS * `vector_rows` vectors of the most frequent filter
    value, up to MAX_CELLS; with fewer than two every query block meets every vector block of its filter values. It changes
    no result. The more the vectors lie in clusters, the fewer blocks meet.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    on = list(on or [])
    if where is not None:
        vectors = vectors.where(where)
    queries, vectors = _usable(queries, query_id, embedding, on), _usable(vectors, id, embedding, on)
    keys = [*on, "_dim"]
    buckets = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    best_schema = T.ArrayType(
        T.StructType(
            [
                T.StructField("query_id", queries.schema[query_id].dataType),
                T.StructField("id", vectors.schema[id].dataType),
                T.StructField("distance", T.DoubleType()),
            ]
        )
    )

    @F.pandas_udf(best_schema)
    def best_of(q_ids: pd.Series, q_data: pd.Series, v_ids: pd.Series, v_data: pd.Series) -> pd.Series:
        def matrix(data, n):
            return np.frombuffer(data, dtype=np.float32).reshape(n, -1).astype(np.float64)

        return pd.Series(
            [
                _block_best(qi, matrix(qd, len(qi)), np.asarray(vi), matrix(vd, len(vi)), k, metric)
                for qi, qd, vi, vd in zip(q_ids, q_data, v_ids, v_data)
            ]
        )

    most, sides = _sides(queries, vectors, keys, buckets)
    if cells is None:
        cells = min(MAX_CELLS, most // (CELL_BLOCKS * vector_rows))
    if cells < 2:
        query_blocks = _blocks(queries, query_id, embedding, keys, query_rows, "q")
        vector_blocks = _blocks(vectors, id, embedding, keys, vector_rows, "v")
        pairs = _met(query_blocks, vector_blocks, keys, buckets, sides)
    else:
        pivots = _pivots(vectors, id, embedding, cells, metric)
        query_blocks = _balls(queries, query_id, embedding, keys, query_rows, "q", pivots, metric)
        vector_blocks = _balls(vectors, id, embedding, keys, vector_rows, "v", pivots, metric)
        pairs = near_pairs(query_blocks, vector_blocks, keys, pivots, k, metric, buckets, sides)
    candidates = pairs.select(F.inline(best_of("q_ids", "q_data", "v_ids", "v_data")))
    nearest = Window.partitionBy("query_id").orderBy("distance", "id")
    return (
        candidates.withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select("query_id", "id", "rank", "distance")
    )


def _sides(queries: DataFrame, vectors: DataFrame, keys: list[str], buckets: int) -> tuple[int, DataFrame | None]:
    """(vectors of the most frequent filter value, grids of the values that are more than one piece).

    A value gets pieces by its share of all pairs; rows and columns of its grid are such that the copies are fewest.
    The driver sees only values with more than one piece, fewer than there are pieces.
    """
    spark = vectors.sparkSession
    pieces = max(1, min(buckets, PIECES_PER_CORE * spark.sparkContext.defaultParallelism))
    asked = queries.groupBy(*keys).agg(F.count("*").cast("double").alias("_q"))
    counted = vectors.groupBy(*keys).agg(F.count("*").cast("double").alias("_v")).join(asked, keys)
    most, work = counted.agg(F.max("_v"), F.sum(F.col("_q") * F.col("_v"))).first()
    if not work:
        return 0, None
    rows = []
    for found in counted.where(F.col("_q") * F.col("_v") * pieces >= 1.5 * work).collect():
        n_pieces = round(pieces * found["_q"] * found["_v"] / work)
        columns = min(max(1, round(math.sqrt(n_pieces * found["_v"] / found["_q"]))), n_pieces)
        rows.append((*[found[c] for c in keys], -(-n_pieces // columns), columns))
    schema = T.StructType([*[counted.schema[c] for c in keys], T.StructField("_rows", T.IntegerType()), T.StructField("_columns", T.IntegerType())])
    return int(most), spark.createDataFrame(rows, schema) if rows else None


def _met(
    query_blocks: DataFrame, vector_blocks: DataFrame, keys: list[str], buckets: int, sides: DataFrame | None, near: Column | None = None
) -> DataFrame:
    """The pairs of blocks of equal `keys`, each in one piece of the grid of its keys; only those that are `near`, if given."""

    def sized(blocks):
        if sides is None:
            return blocks.withColumns({"_rows": F.lit(1), "_columns": F.lit(1)})
        return blocks.join(F.broadcast(sides), keys, "left").fillna(1, ["_rows", "_columns"])

    def all_of(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def own(ids, n):
        return F.pmod(F.xxhash64(ids), F.col(n)).cast("int")

    q = sized(query_blocks).withColumn("_row", own("q_ids", "_rows")).withColumn("_column", all_of("_columns"))
    v = sized(vector_blocks).withColumn("_column", own("v_ids", "_columns")).withColumn("_row", all_of("_rows"))
    place = [*keys, "_row", "_column"]
    # Pieces are much work on few bytes, so that they must not be put together by their size.
    q, v = (side.drop("_rows", "_columns").repartition(buckets, *place) for side in (q, v))
    met = q.join(v, place)
    return met if near is None else met.where(near)


def _points(data: np.ndarray, metric: str) -> np.ndarray:
    """Where the vectors lie for the triangle inequality: cosine is half the squared distance of unit vectors."""
    points = data.astype(np.float64)
    if metric == "cosine":
        norms = np.linalg.norm(points, axis=1)[:, None]
        points = np.divide(points, norms, out=np.zeros_like(points), where=norms > 0)
    return points


def _pivots(vectors: DataFrame, id: str, embedding: str, cells: int, metric: str) -> dict[int, np.ndarray]:
    """Pivots by number of dimensions: at most `cells` vectors in all, those whose ids have the smallest hashes."""
    chosen = vectors.orderBy(F.xxhash64(id), id).select(embedding).limit(min(cells, MAX_CELLS)).collect()
    by_dim: dict[int, list] = {}
    for (vector,) in chosen:
        by_dim.setdefault(len(vector), []).append(vector)
    return {dim: np.unique(_points(np.array(some, np.float32), metric), axis=0) for dim, some in by_dim.items()}


def _balls(
    df: DataFrame, id: str, embedding: str, on: list[str], rows: int, prefix: str, pivots: dict[int, np.ndarray], metric: str
) -> DataFrame:
    """`_blocks` of one cell each, with the `<prefix>_cell` of the nearest pivot and the `<prefix>_radius` around it."""
    schema = T.StructType(
        [df.schema[c] for c in on]
        + [
            T.StructField(f"{prefix}_cell", T.IntegerType()),
            T.StructField(f"{prefix}_radius", T.DoubleType()),
            T.StructField(f"{prefix}_ids", T.ArrayType(df.schema[id].dataType)),
            T.StructField(f"{prefix}_data", T.BinaryType()),
        ]
    )

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _chunks(batches, embedding):
            out = []
            for key, group in batch.groupby(on, sort=False):
                data = np.stack(group[embedding].to_numpy()).astype(np.float32)
                ids = group[id].to_numpy()
                points = _points(data, metric)
                near = pivots.get(data.shape[1])
                if near is None:
                    cell, far = np.full(len(ids), ANYWHERE), np.full(len(ids), np.inf)
                else:
                    square = np.square(points).sum(1)[:, None] + np.square(near).sum(1)[None, :] - 2 * points @ near.T
                    cell = square.argmin(1)
                    far = np.linalg.norm(points - near[cell], axis=1)
                    if metric == "cosine":
                        lost = ~points.any(axis=1)
                        cell[lost], far[lost] = ANYWHERE, np.inf
                # The farthest last, so that the first blocks of a cell are small balls.
                order = np.lexsort((far, cell))
                cuts = np.flatnonzero(np.diff(cell[order])) + 1
                for part in np.split(order, cuts):
                    for start in range(0, len(part), rows):
                        own = part[start : start + rows]
                        out.append((*key, int(cell[own[0]]), float(far[own].max()), ids[own].tolist(), data[own].tobytes()))
            yield pd.DataFrame(out, columns=schema.names)

    return df.select(*on, id, embedding).mapInPandas(pack, schema)


def near_pairs(
    query_blocks: DataFrame,
    vector_blocks: DataFrame,
    keys: list[str],
    pivots: dict[int, np.ndarray],
    k: int,
    metric: str,
    buckets: int,
    sides: DataFrame | None = None,
) -> DataFrame:
    """The pairs of blocks that can hold one of the k nearest of a query, from `_balls` of both sides; `sides` as from `_sides`."""

    @F.pandas_udf("double")
    def bound_of(q_ids: pd.Series, q_data: pd.Series, v_ids: pd.Series, v_data: pd.Series) -> pd.Series:
        """No query of the block has its k-th nearest farther than this, as seen from one vector block."""
        out = []
        for qi, qd, vi, vd in zip(q_ids, q_data, v_ids, v_data):
            if len(vi) < k:
                out.append(np.inf)
                continue
            q, v = (_points(np.frombuffer(d, np.float32).reshape(len(i), -1), metric) for d, i in ((qd, qi), (vd, vi)))
            square = np.square(q).sum(1)[:, None] + np.square(v).sum(1)[None, :] - 2 * q @ v.T
            out.append(float(np.sqrt(max(np.partition(square, k - 1, axis=1)[:, k - 1].max(), 0.0))))
        return pd.Series(out)

    asked = query_blocks.withColumn("q_block", F.xxhash64(*keys, "q_ids", "q_data"))
    # One ball a cell is enough for a bound: the smallest that holds k vectors.
    filled = vector_blocks.where(F.size("v_ids") >= k)
    least = filled.groupBy(*keys, "v_cell").agg(F.min("v_radius").alias("v_radius"))
    inner = filled.join(least, [*keys, "v_cell", "v_radius"]).withColumnRenamed("v_cell", "q_cell")
    own = asked.join(inner, [*keys, "q_cell"])
    bounds = own.select("q_block", bound_of("q_ids", "q_data", "v_ids", "v_data").alias("bound"))
    bounds = bounds.groupBy(F.col("q_block").alias("of")).agg(F.min("bound").alias("bound"))

    # How far apart the pivots are: one row per pair of cells of equal dimension.
    rows = [
        (dim, i, j, float(d))
        for dim, near in pivots.items()
        for i, from_i in enumerate(np.linalg.norm(near[:, None] - near[None, :], axis=2))
        for j, d in enumerate(from_i)
    ]
    # Queries without a place look everywhere, and all look among the vectors without one.
    rows += [(dim, i, ANYWHERE, 0.0) for dim, near in pivots.items() for i in range(len(near))]
    rows += [(dim, ANYWHERE, j, 0.0) for dim, near in pivots.items() for j in [*range(len(near)), ANYWHERE]]
    ways = query_blocks.sparkSession.createDataFrame(rows, "_dim int, q_cell int, v_cell int, apart double")
    known = asked.select(*keys, "q_cell", "q_radius", "q_block").distinct()
    reach = known.join(bounds, F.col("q_block") == F.col("of"), "left").withColumn("reach", F.coalesce("bound", F.lit(float("inf"))) + F.col("q_radius"))
    # Dimensions without any pivot have one cell, ANYWHERE, on both sides.
    to = F.coalesce("v_cell", F.lit(ANYWHERE))
    reach = reach.join(F.broadcast(ways), ["_dim", "q_cell"], "left").withColumn("v_cell", to).fillna(0.0, ["apart"])

    def touches(apart, radius):
        slack = 1e-7 * (apart + F.when(F.col("reach") < float("inf"), F.col("reach")).otherwise(0.0) + 1.0)
        return apart <= F.col("reach") + radius + slack

    # Cells first, by their widest ball and without the vectors: a query block carries the cells it has to look into.
    widest = vector_blocks.groupBy(*keys, "v_cell").agg(F.max("v_radius").alias("widest"))
    going = reach.join(widest, [*keys, "v_cell"]).where(touches(F.col("apart"), F.col("widest")))
    going = going.groupBy(F.col("q_block").alias("of")).agg(
        F.first("reach").alias("reach"), F.map_from_entries(F.collect_list(F.struct("v_cell", "apart"))).alias("cells")
    )
    sent = asked.join(going, F.col("q_block") == F.col("of")).drop("of")
    apart = F.try_element_at("cells", F.col("v_cell"))
    return _met(sent, vector_blocks, keys, buckets, sides, touches(apart, F.col("v_radius")))


def with_metadata(found: DataFrame, vectors: DataFrame, *, id: str = "id", embedding: str = "embedding") -> DataFrame:
    """Add the metadata columns of the vectors to `knn` output."""
    return found.join(vectors.drop(embedding).withColumnRenamed(id, "id"), "id")
