"""Approximate nearest neighbours by a forest of random-projection trees and exact reranking."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docharbor.llm.common import pick, received, shipped, stored


@dataclass(frozen=True)
class Forest:
    """``sample`` bounds the vectors that the trees are fitted to: those of the smallest hashes.

    ``leaf`` is the number of sampled vectors in a leaf, ``visits`` the leaves that a query's priority
    queue takes from all trees together. ``block`` bounds the rows and queries that meet in a task.
    """

    trees: int = 16
    sample: int = 16_384
    leaf: int = 32
    visits: int = 320
    block: int = 4_096
    seed: int = 7


class Trees:
    """Balanced trees: each inner node has a hyperplane between two sampled vectors, at the median."""

    def __init__(self, sample: np.ndarray, p: Forest) -> None:
        rng = np.random.default_rng(p.seed)
        self.depth = max(0, int(np.ceil(np.log2(max(1, len(sample)) / p.leaf))))
        inner = (1 << self.depth) - 1
        self.normals = np.zeros((p.trees, inner, sample.shape[1]))
        self.offsets = np.zeros((p.trees, inner))
        for t in range(p.trees):
            own = [np.arange(len(sample))]
            for node in range(inner):
                at = own[node]
                if len(at) > 1:
                    a, b = sample[rng.choice(at, 2, replace=False)]
                    normal = a - b
                else:
                    normal = rng.normal(size=sample.shape[1])
                normal /= np.linalg.norm(normal) or 1.0
                side = sample[at] @ normal
                self.normals[t, node], self.offsets[t, node] = normal, np.median(side) if len(at) else 0.0
                right = side > self.offsets[t, node]
                own += [at[~right], at[right]]

    def margins(self, tree: int, x: np.ndarray) -> np.ndarray:
        return x @ self.normals[tree].T - self.offsets[tree]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        out = np.zeros((len(x), len(self.normals)), np.int32)
        for t in range(len(self.normals)):
            margin, node = self.margins(t, x), np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (margin[np.arange(len(x)), node] > 0)
            out[:, t] = node - len(self.offsets[t])
        return out

    def search(self, x: np.ndarray, visits: int) -> list[list[tuple[int, int]]]:
        """The ``(tree, leaf)`` pairs of each vector, nearest first, by one queue over all trees."""
        inner = self.offsets.shape[1]
        margins = [self.margins(t, x).tolist() for t in range(len(self.normals))]
        out = []
        for i in range(len(x)):
            queue = [(-np.inf, t, 0) for t in range(len(self.normals))]
            found: list[tuple[int, int]] = []
            while queue and len(found) < visits:
                far, t, node = heapq.heappop(queue)
                if node >= inner:
                    found.append((t, node - inner))
                    continue
                m = margins[t][i][node]
                heapq.heappush(queue, (max(far, -m), t, 2 * node + 2))
                heapq.heappush(queue, (max(far, m), t, 2 * node + 1))
            out.append(found)
        return out


def usable(vector: str) -> Column:
    """Neither null nor zero, all components finite numbers."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(F.exists(vector, lambda v: v != 0) & ~bad, F.lit(False))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows of ``dim`` doubles; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (size == dim).all():
        return flat.reshape(len(size), dim)
    out = np.zeros((len(size), dim))
    out[np.arange(dim) < size[:, None]] = flat
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no square over- or underflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row, in an order of additions that doesn't depend on the rows around."""
    return (q * x).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1)))


def distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """``uid, k1, k2, vector, ids`` of every distinct usable vector, with its ``keep`` smallest ids.

    Copies of a vector are equally near to everything, so of each group no more ids can be wanted.
    """
    own = Window.partitionBy("k1", "k2").orderBy("id")
    ids = vectors.select("k1", "k2", "id").distinct().withColumn("r", F.row_number().over(own)).where(F.col("r") <= keep)
    ids = ids.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    few = vectors.groupBy("k1", "k2").agg(F.first("vector").alias("vector")).join(ids, ["k1", "k2"])
    return stored(few.select(F.monotonically_increasing_id().alias("uid"), "k1", "k2", "vector", "ids"), "vectors")


def fit(distinct: DataFrame, dim: int, p: Forest) -> Trees:
    rows = distinct.orderBy("k1", "k2").limit(p.sample).select("vector").toArrow()
    sample = _matrix(rows.column("vector"), dim) if rows.num_rows else np.zeros((0, dim))
    return Trees(_unit(sample) if len(sample) else sample, p)


def _placed(rows: DataFrame, sent, dim: int) -> DataFrame:
    """``tree, leaf, uid, vector, ids``: every row in its leaf of every tree."""

    def run(batches):
        trees: Trees = received(sent)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                leaf = trees.leaves(_unit(_matrix(part.column("vector"), dim)))
                take = pa.array(np.repeat(np.arange(part.num_rows), leaf.shape[1]))
                tree = np.tile(np.arange(leaf.shape[1], dtype=np.int32), part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tree), pa.array(leaf.ravel()), *(part.column(c).take(take) for c in ("uid", "vector", "ids"))],
                    ["tree", "leaf", "uid", "vector", "ids"],
                )

    kind = rows.schema["vector"].dataType.simpleString()
    schema = f"tree int, leaf int, uid long, vector {kind}, ids array<long>"
    return rows.select("uid", "vector", "ids").mapInArrow(run, schema)


def _asked(rows: DataFrame, sent, dim: int, visits: int) -> DataFrame:
    """``tree, leaf, uid, vector``: every query in the leaves that its search visits."""

    def run(batches):
        trees: Trees = received(sent)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = trees.search(_unit(_matrix(part.column("vector"), dim)), visits)
                take = pa.array(np.repeat(np.arange(part.num_rows), [len(f) for f in found]))
                pairs = np.array([x for f in found for x in f], np.int32).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), *(part.column(c).take(take) for c in ("uid", "vector"))],
                    ["tree", "leaf", "uid", "vector"],
                )

    kind = rows.schema["vector"].dataType.simpleString()
    return rows.select("uid", "vector").mapInArrow(run, f"tree int, leaf int, uid long, vector {kind}")


def _reranked(k: int, dim: int):
    """Exact cosines of the queries and rows of one block; the ``k`` best distinct vectors of each query."""

    def run(asked: pa.Table, rows: pa.Table) -> pa.Table:
        q, x = _matrix(asked.column("vector"), dim), _matrix(rows.column("vector"), dim)
        out_q, out_x, out_s = [], [], []
        if len(q) and len(x):
            unit = _unit(x)
            for at in range(0, len(q), 256):
                rough = _unit(q[at : at + 256]) @ unit.T
                least = np.partition(rough, max(0, len(x) - k), axis=1)[:, max(0, len(x) - k)]
                i, j = np.nonzero(rough >= least[:, None] - 1e-9)
                out_q.append(i + at)
                out_x.append(j)
                out_s.append(_cosines(q[i + at], x[j]))
        i, j = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (out_q, out_x))
        score = np.concatenate(out_s) if out_s else np.zeros(0)
        # Of equal scores all are near enough above; the best k by score and id go on.
        first = rows.column("ids").combine_chunks().flatten().to_numpy()[np.r_[0, np.cumsum(pc.list_value_length(rows.column("ids")).to_numpy())[:-1]].astype(np.int64)] if len(x) else np.zeros(0, np.int64)
        order = np.lexsort((first[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        keep = rank < k
        i, j, score = pa.array(i[keep]), pa.array(j[keep]), score[keep]
        return pa.table(
            {
                "query": asked.column("uid").take(i),
                "uid": rows.column("uid").take(j),
                "ids": rows.column("ids").take(j),
                "score": pa.array(score),
            }
        )

    return run


def nearest(vectors: DataFrame, queries: Column, *, k: int = 5, p: Forest = Forest()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows found to each row where ``queries`` holds.

    ``vectors`` has ``vec_id`` and ``embedding``; the measure is the cosine in double precision on the
    vectors as they are, ties go to the smaller id, a row is no neighbour of itself. Null, zero and
    non-finite vectors and null ids take no part; shorter vectors count as ending in zeros; of rows
    equal in id and vector one counts. All rows are indexed; only the trees' planes come from a sample.
    """
    kind = vectors.schema[vectors.columns.index("embedding")].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"  # doubles are made of floats in the tasks
    own = pick(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast(kind).alias("vector")
    )
    own = own.where("id is not null").where(usable("vector"))
    own = own.withColumns({"k1": F.xxhash64("vector"), "k2": F.xxhash64(F.lit(1), "vector")})
    distinct = distinct_vectors(own, k + 1)
    dim = distinct.agg(F.max(F.size("vector"))).first()[0] or 1
    trees = fit(distinct, dim, p)
    sent = shipped(vectors.sparkSession, trees)

    asking = own.withColumnRenamed("id", "vec_id").where(queries).select(F.col("vec_id").alias("query_id"), "k1", "k2").distinct()
    wanted = distinct.join(asking.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    rows, asked = _placed(distinct, sent, dim), _asked(wanted, sent, dim, p.visits)
    # Leaves and visits are counted first; larger ones are parted so that a task meets a block of each.
    most = lambda df: df.groupBy("tree", "leaf").count().agg(F.max("count")).first()[0] or 1
    parts, groups = (-(-most(df) // p.block) for df in (rows, asked))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(parts)).cast("int"))
    rows = rows.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = asked.withColumn("group", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("int"))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    place = ["tree", "leaf", "part", "group"]
    found = asked.groupBy(*place).cogroup(rows.groupBy(*place)).applyInArrow(
        _reranked(k + 1, dim), "query long, uid long, ids array<long>, score double"
    )

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near = found.dropDuplicates(["query", "uid"]).select("query", "score", F.explode("ids").alias("vec_id"))
    near = near.dropDuplicates(["query", "vec_id"]).withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
    lists = near.groupBy("query").agg(F.collect_list(F.struct("score", "vec_id")).alias("near"))
    lists = distinct.select("uid", "k1", "k2").join(lists, F.col("uid") == F.col("query"))
    out = asking.join(lists, ["k1", "k2"]).select("query_id", F.explode("near").alias("n"))
    out = out.select("query_id", F.col("n.vec_id").alias("vec_id"), F.col("n.score").alias("score")).where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
