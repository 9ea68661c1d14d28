"""Approximate nearest neighbours by cosine over balanced posting lists.

A bounded sample gives the centroids (k-means, too large lists split), a graph over them for
the search in memory, and the distance ratio that reaches the recall asked for. Every vector is put
into its nearest list, and near a boundary into further ones. A query searches the lists whose
centroid is nearly as close as the closest. Lists longer than a task should hold are dealt to parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import settle

# Vectors the centroids are fitted to, at most; every vector is indexed.
SAMPLE = 50_000
LIST_VECTORS = 400
MAX_LISTS = 4096
# A vector is in up to so many lists, if their squared distances are at most so many times the smallest.
REPLICAS = 4
BOUNDARY = 1.15
# Share of the true neighbours, within the sample, that the searched lists must hold.
RECALL = 0.97
LINKS = 16
PART_VECTORS = 20_000


@dataclass
class Lists:
    centroids: np.ndarray  # unit length
    graph: np.ndarray  # for each centroid the numbers of others it leads to
    ratio: float = np.inf
    width: int = 64

    def search(self, vectors: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, squared distances) of the nearest centroids, nearest first, by a best-first walk.

        A beam of `width` centroids per vector; the closest one not yet visited is left along its links, until
        all of the beam are visited.
        """
        n, k = len(vectors), len(self.centroids)
        width = min(width, k)
        beam = np.tile(np.linspace(0, k - 1, width).astype(np.int64), (n, 1))
        dist = 2 - 2 * vectors @ self.centroids[beam[0]].T
        order = np.argsort(dist, 1, kind="stable")
        beam, dist = np.take_along_axis(beam, order, 1), np.take_along_axis(dist, order, 1)
        visited = np.zeros((n, k), bool)
        met = np.zeros((n, k), bool)
        np.put_along_axis(met, beam, True, 1)
        live = np.arange(n)
        while len(live):
            fresh = ~np.take_along_axis(visited[live], beam[live], 1)
            live = live[fresh.any(1)]
            if not len(live):
                break
            at = beam[live, fresh[fresh.any(1)].argmax(1)]
            visited[live, at] = True
            to = self.graph[at]
            d = 2 - 2 * np.einsum("nd,nld->nl", vectors[live], self.centroids[to])
            d[np.take_along_axis(met[live], to, 1)] = np.inf
            met[live[:, None], to] = True
            both, both_d = np.concatenate([beam[live], to], 1), np.concatenate([dist[live], d], 1)
            order = np.argsort(both_d, 1, kind="stable")[:, :width]
            beam[live], dist[live] = np.take_along_axis(both, order, 1), np.take_along_axis(both_d, order, 1)
        return beam, np.maximum(dist, 0)

    def owners(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the nearest list of each vector, and those across a boundary near it.

        A further list is left out if it lies closer to one already chosen than to the vector.
        """
        near, d = self.search(vectors, max(4 * REPLICAS, 32))
        near, d = near[:, : 2 * REPLICAS], d[:, : 2 * REPLICAS]
        chosen = np.zeros(near.shape, bool)
        chosen[:, 0] = True
        for j in range(1, near.shape[1]):
            between = 2 - 2 * np.einsum("nd,nwd->nw", self.centroids[near[:, j]], self.centroids[near[:, :j]])
            shadowed = (chosen[:, :j] & (between < 0.5 * d[:, j : j + 1])).any(1)
            chosen[:, j] = (d[:, j] <= BOUNDARY * d[:, 0] + 1e-12) & ~shadowed & (chosen.sum(1) < REPLICAS)
        row, place = np.nonzero(chosen)
        return row, near[row, place]

    def searched(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs that a query looks into: pruned by the ratio of the distances."""
        near, d = self.search(vectors, self.width)
        row, place = np.nonzero(d <= self.ratio * d[:, :1] + 1e-12)
        return row, near[row, place]


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmax(vectors[i : i + 4096] @ centroids.T, 1) for i in range(0, len(vectors), 4096)])


def _k_means(vectors: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centroids = vectors[rng.choice(len(vectors), k, replace=False)]
    for _ in range(rounds):
        own = _nearest(vectors, centroids)
        order = np.argsort(own, kind="stable")
        counts = np.bincount(own, minlength=k)
        sums = np.add.reduceat(vectors[order], np.minimum(np.cumsum(counts) - counts, len(vectors) - 1), axis=0)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where((counts[:, None] > 0) & (norm > 1e-9), sums / np.maximum(norm, 1e-9), centroids)
    return centroids


def fit(sample: np.ndarray, total: int, *, recall: float = RECALL, k: int = 5, seed: int = 11) -> Lists:
    """Lists for `total` vectors from a sample of them (rows; any order gives the same lists)."""
    rng = np.random.default_rng(seed)
    sample = _unit(sample[np.lexsort(sample.T[::-1])])
    n_lists = int(np.clip(min(total // LIST_VECTORS, len(sample) // 4), 1, MAX_LISTS))
    centroids = _k_means(sample, n_lists, rng)
    for _ in range(4):  # split what is more than twice as long as the mean
        own = _nearest(sample, centroids)
        counts = np.bincount(own, minlength=len(centroids))
        long = np.flatnonzero(counts > max(2 * len(sample) / len(centroids), 8))
        if not len(long):
            break
        halves = [_k_means(sample[own == i], 2, rng, 4) for i in long.tolist()]
        centroids = np.concatenate([np.delete(centroids, long, 0), *halves])
    m = len(centroids)
    links = min(LINKS, m)
    close = np.argsort(-(centroids @ centroids.T), 1, kind="stable")[:, :links]
    far = rng.integers(0, m, (m, max(4, links // 2)))  # so that the graph hangs together
    lists = Lists(centroids, np.concatenate([close, far], 1))
    # The ratio that holds the true neighbours of some vectors of the sample.
    some = sample[rng.choice(len(sample), min(400, len(sample)), replace=False)]
    top = np.concatenate([np.argsort(-(some[i : i + 20] @ sample.T), 1)[:, : k + 1] for i in range(0, len(some), 20)])
    parts = [(i, *lists.owners(sample[i : i + 1024])) for i in range(0, len(sample), 1024)]
    row, own = np.concatenate([i + r for i, r, _ in parts]), np.concatenate([o for _, _, o in parts])
    at = np.searchsorted(row, np.arange(len(sample) + 1))
    near, d = lists.search(some, m)
    share = np.full((len(some), m), np.inf)
    np.put_along_axis(share, near, d / np.maximum(d[:, :1], 1e-12), 1)
    needed = np.array([[share[i, own[at[v] : at[v + 1]]].min() for v in top[i]] for i in range(len(some))])
    lists.ratio = float(np.quantile(needed[:, 1:] if k else needed, recall)) if needed.shape[1] > 1 else np.inf
    lists.width = int(min(m, max(32, 1.25 * (share <= lists.ratio).sum(1).max() + 8)))
    return lists


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column (no nulls, equal lengths) in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _takes_part(vector: str, dim: int) -> Column:
    numbers = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) == dim) & numbers & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    *,
    recall: float = RECALL,
    sample_rows: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of `is_query` its k nearest found among all other rows.

    score is the cosine in double precision, larger first, ties to the smaller id. Of equal vectors the
    k + 1 smallest ids take part in the search, since no other can be among k nearest; equal queries are searched once.
    Vectors that are null, zero, hold a null or non-finite number, or have another length than most (of two
    as frequent lengths the smaller) take no part; so do rows with a null id. Repeated rows count
    once per id. With fewer than k candidates all are returned; an empty table gives an empty result.
    """
    rows = vectors.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")
    )
    lengths = rows.where("v is not null").groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(_takes_part("v", lengths["n"] if lengths else 0))
    # Minus zero is zero, so that equal vectors are equal keys.
    rows = rows.select("id", F.transform("v", lambda x: x + 0.0).alias("v"), "q")
    same = Window.partitionBy("v").orderBy("id")
    few = rows.select("id", "v").distinct().withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
    unique = settle(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("u", F.element_at("ids", 1)))
    total = unique.count()
    if not total:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).where("1 = 0")
    share = min(1.0, sample_rows / total)
    sample = unique.where(F.pmod(F.xxhash64("v"), F.lit(1_000_000)) < int(share * 1_000_000)) if share < 1 else unique
    lists = fit(_matrix(sample.select("v").toArrow()["v"]), total, recall=recall, k=k)

    def own_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                row, own = lists.owners(_unit(_matrix(part.column(1))))
                some = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), part.column(0).take(some), part.column(1).take(some)], ["list", "u", "v"])

    def look_into(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                row, own = lists.searched(_unit(_matrix(part.column(1))))
                some = pa.array(row)
                yield pa.RecordBatch.from_arrays([part.column(0).take(some), part.column(1).take(some), pa.array(own.astype(np.int32))], ["query", "w", "to"])

    postings = settle(unique.select("u", "v").mapInArrow(own_lists, "list int, u long, v array<double>"))
    sizes = postings.groupBy("list").count()
    parts = sizes.select(F.col("list").alias("l"), F.ceil(F.col("count") / PART_VECTORS).cast("int").alias("parts"))  # MAX_LISTS * 2 rows at most
    parts = F.broadcast(parts)
    dealt = postings.join(parts, F.col("list") == F.col("l")).withColumn("part", F.pmod(F.xxhash64("u"), F.col("parts")).cast("int"))
    queries = rows.where("q").select("id", "v")
    unique_queries = queries.groupBy("v").agg(F.min("id").alias("query")).select("query", F.col("v").alias("w"))
    asked = unique_queries.select("query", "w").mapInArrow(look_into, "query long, w array<double>, to int")
    asked = asked.join(parts, F.col("to") == F.col("l")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_u, out_s = [], [], []
        if left.num_rows and right.num_rows:
            a, b = _matrix(left["v"]), _matrix(right["w"])
            u, q = np.asarray(left["u"], np.int64), np.asarray(right["query"], np.int64)
            order = np.argsort(u, kind="stable")  # ties to the smaller id
            a, u = a[order], u[order]
            norm_a, norm_b = np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1))
            for at in range(0, len(b), 256):
                s = (b[at : at + 256] @ a.T) / (norm_b[at : at + 256, None] * norm_a[None, :])
                best = np.argsort(-s, 1, kind="stable")[:, : k + 1]
                out_q.append(np.repeat(q[at : at + 256], best.shape[1]))
                out_u.append(u[best].ravel())
                out_s.append(np.take_along_axis(s, best, 1).ravel())
        none = np.zeros(0)
        return pa.table({
            "query": np.concatenate([*out_q, none]).astype(np.int64), "u": np.concatenate([*out_u, none]).astype(np.int64), "score": np.concatenate([*out_s, none]),
        })

    found = dealt.select("list", "part", "u", "v").groupBy("list", "part").cogroup(
        asked.select("to", "part", "query", "w").groupBy("to", "part")
    ).applyInArrow(compare, "query long, u long, score double")
    # A vector found in several lists counts once.
    found = found.groupBy("query", "u").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "u")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    named = found.join(unique.select("u", "ids"), "u").select("query", "score", F.explode("ids").alias("vec_id"))
    first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = named.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    # Back to every row that asked: all queries of one vector share its results.
    asked_by = queries.distinct().join(unique_queries, F.col("v") == F.col("w")).select(F.col("id").alias("query_id"), "query")
    results = asked_by.join(named, "query").where("vec_id <> query_id")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return results.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
