"""Exact top-k inner products with a KD-tree per shard.

Each task holds one shard of the candidates and builds a KD-tree: nodes are split at the median of
their widest dimension, and every node keeps the tight box of its vectors. For a query ``q`` and a box
``[lo, hi]`` no vector inside scores more than ``sum(max(q * lo, q * hi))``. Nodes whose bound is below
the query's k-th score so far are left out; leaves are visited best bound first, all queries at
once, and scored by one matrix product each.

The k-th score is propagated: a first pass over a small part of the shards gives each query a k-th score,
which is the starting threshold in all others. Only scores that reach it leave a task.

Queries are taken in blocks of ``block`` rows, so what is broadcast is bounded; each block is one scan
of the candidates. Vectors are whole numbers; sums are exact in double precision as long as they stay
below 2**53, which is checked.

Defined results: rows whose vector is null or holds a null or a non-finite component take no part, as
query or as candidate; a vector of another length than the query's is no candidate for it; a query has
as many rows as there are candidates if these are fewer than k; ties go to the smaller id; rows that
repeat a query's id aren't its candidates, and a query id is answered once; a null id takes no part.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from hearthline.sources.stages import stage


@dataclass(frozen=True)
class Settings:
    k: int = 10
    leaf: int = 256
    shard: int = 32_768  # vectors of one tree
    block: int = 8_192  # queries at once
    first_part: int = 16  # one shard row in so many is searched first


def quantised(vector: str, scale: int = 1024) -> Column:
    """``floor(scale * x)`` of each component, or null if one is null or not finite."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(F.col(vector).isNotNull() & ~bad, F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Tree:
    """A KD-tree as arrays. Node ``i`` has children ``left[i]`` and ``left[i] + 1``, or none."""

    def __init__(self, vectors: np.ndarray, leaf: int):
        self.order = np.arange(len(vectors))
        self.low, self.high, self.left, self.span = [], [], [], []
        self._add(vectors, 0, len(vectors))
        node = 0
        while node < len(self.span):
            a, b = self.span[node]
            if b - a > leaf:
                rows = self.order[a:b]
                wide = int(np.argmax(self.high[node] - self.low[node]))
                if self.high[node][wide] > self.low[node][wide]:
                    middle = (b - a) // 2
                    self.order[a:b] = rows[np.argpartition(vectors[rows, wide], middle)]
                    self.left[node] = len(self.span)
                    self._add(vectors, a, a + middle)
                    self._add(vectors, a + middle, b)
            node += 1
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _add(self, vectors: np.ndarray, a: int, b: int) -> None:
        rows = vectors[self.order[a:b]]
        self.low.append(rows.min(axis=0))
        self.high.append(rows.max(axis=0))
        self.left.append(-1)
        self.span.append((a, b))

    def bounds(self, queries: np.ndarray, node: int) -> np.ndarray:
        """The most that any vector of a node scores, for each query."""
        up = np.maximum(queries, 0)
        return up @ self.high[node] + (queries - up) @ self.low[node]


def search(tree: Tree, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int):
    """For each query the best ``k`` (score, id) of the tree among those that reach ``least``.

    Returns two arrays with ``k`` columns; missing entries score ``-inf``.
    """
    n = len(queries)
    best = np.full((n, k), -np.inf)
    who = np.full((n, k), np.iinfo(np.int64).max)
    kth = least.astype(np.float64).copy()
    # Descend level by level; a query goes on into a child only if its bound can reach its k-th score.
    leaves, todo = [], [(0, np.arange(n), tree.bounds(queries, 0))]
    while todo:
        node, at, bound = todo.pop()
        alive = bound >= kth[at]
        at, bound = at[alive], bound[alive]
        if not len(at):
            continue
        if tree.left[node] < 0:
            leaves.append((node, at, bound))
            continue
        for child in (tree.left[node], tree.left[node] + 1):
            todo.append((child, at, tree.bounds(queries[at], child)))
    if not leaves:
        return best, who
    # Best first: in turn, every query visits the leaf with its next lower bound.
    query = np.concatenate([at for _, at, _ in leaves])
    leaf = np.concatenate([np.full(len(at), i) for i, (_, at, _) in enumerate(leaves)])
    bound = np.concatenate([b for _, _, b in leaves])
    order = np.lexsort((-bound, query))
    query, leaf, bound = query[order], leaf[order], bound[order]
    turn = np.arange(len(query)) - np.searchsorted(query, query)
    by_turn = np.argsort(turn, kind="stable")
    cuts = np.searchsorted(turn[by_turn], np.arange(int(turn.max()) + 2))
    for a, b in zip(cuts[:-1], cuts[1:]):
        now = by_turn[a:b]
        now = now[bound[now] >= kth[query[now]]]
        now = now[np.argsort(leaf[now], kind="stable")]
        for part in np.split(now, np.flatnonzero(np.diff(leaf[now])) + 1):
            if not len(part):
                continue
            at = query[part]
            lo, hi = tree.span[leaves[leaf[part[0]]][0]]
            rows = tree.order[lo:hi]
            score = queries[at] @ vectors[rows].T
            name = np.broadcast_to(ids[rows], score.shape)
            score = np.where((name == own[at][:, None]) | (score < kth[at][:, None]), -np.inf, score)
            score = np.concatenate([best[at], score], axis=1)
            name = np.concatenate([who[at], name], axis=1)
            top = np.lexsort((name, -score), axis=1)[:, :k]
            best[at] = np.take_along_axis(score, top, axis=1)
            who[at] = np.take_along_axis(name, top, axis=1)
            kth[at] = np.maximum(kth[at], best[at][:, -1])
    return best, who


def _matrix(batch_column) -> np.ndarray:
    flat = batch_column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(batch_column), -1) if len(batch_column) else flat.reshape(0, 0)


def _search(rows: DataFrame, shared, settings: Settings) -> DataFrame:
    """``query, id, score`` of the best candidates of each shard for the broadcast queries."""

    def answer(ids, vectors):
        q_ids, q_vectors, least = shared.value
        if vectors.shape[1] != q_vectors.shape[1]:
            return None
        if len(vectors) and np.abs(vectors).max() * np.abs(q_vectors).max() * vectors.shape[1] >= 2**53:
            raise ValueError("inner products may not be exact")
        best, who = search(Tree(vectors, settings.leaf), vectors, ids, q_vectors, q_ids, least, settings.k)
        found = best > -np.inf
        query = np.broadcast_to(q_ids[:, None], best.shape)[found]
        return pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(who[found]), pa.array(best[found].astype(np.int64))], names=["query", "id", "score"]
        )

    def run(batches):
        held, n = {}, {}
        for batch in batches:
            ids, column = batch.column(0).to_numpy(), batch.column(1)
            length = column.value_lengths().to_numpy()
            for size in np.unique(length):
                mine = np.flatnonzero(length == size)
                vectors = _matrix(column.take(pa.array(mine)))
                held.setdefault(size, []).append((ids[mine], vectors))
                n[size] = n.get(size, 0) + len(mine)
                if n[size] >= settings.shard:
                    parts = held.pop(size)
                    n[size] = 0
                    out = answer(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                    if out is not None:
                        yield out
        for parts in held.values():
            out = answer(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            if out is not None:
                yield out

    return rows.mapInArrow(run, "query long, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(rows: DataFrame, is_query: Column, id: str, vector: Column, settings: Settings = Settings()) -> DataFrame:
    """``query, rank, id, score``: for each query row its best rows by inner product.

    ``vector`` gives arrays of whole numbers, or null for rows that take no part.
    """
    spark = rows.sparkSession
    all_rows = rows.select(F.col(id).cast("long").alias("id"), vector.alias("v"), is_query.alias("q"))
    all_rows = stage(all_rows.where("id is not null and v is not null"), "vectors").withColumn("part", F.pmod(F.xxhash64("id"), F.lit(settings.first_part)))
    queries = all_rows.where("q").select("id", "v", F.size("v").alias("d"))
    sizes = queries.groupBy("d").count().collect()  # one row per vector length
    answers = []
    for d, total in sorted((r.d, r["count"]) for r in sizes):
        blocks = -(-total // settings.block)
        for b in range(blocks):
            block = queries.where((F.col("d") == d) & (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks)) == b)).dropDuplicates(["id"]).orderBy("id").toArrow()
            if not block.num_rows:
                continue
            ids, vectors = block["id"].to_numpy(), _matrix(block["v"].combine_chunks())
            none = np.full(len(ids), -np.inf)
            source = all_rows.select("id", "v", "part")
            first = spark.sparkContext.broadcast((ids, vectors, none))
            early = stage(_best(_search(source.where("part = 0").drop("part"), first, settings), settings.k), "early-answers")
            # The k-th score of the first part, for the queries that have one.
            known = early.where(F.col("rank") == settings.k).select("query", "score").toArrow()
            least = none.copy()
            least[np.searchsorted(ids, known["query"].to_numpy())] = known["score"].to_numpy()
            rest = spark.sparkContext.broadcast((ids, vectors, least))
            later = _search(source.where("part <> 0").drop("part"), rest, settings)
            answers.append(stage(_best(early.drop("rank").unionByName(later), settings.k), "answers"))
    if not answers:
        return spark.createDataFrame([], "query long, rank int, id long, score long")
    out = answers[0]
    for more in answers[1:]:
        out = out.unionByName(more)
    return out.select("query", F.col("rank").cast("int"), "id", "score")
