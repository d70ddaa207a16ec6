"""Exact top-k inner-product search with KD-trees per shard (operator 7).

Vectors are turned into integers, ``floor(256 * x)``, and dealt by hash into
shards of about ``SHARD_ROWS``. Each shard builds one KD-tree by median splits,
with the tight bounding box of every node, kept as one binary row. Queries
come in blocks. A block first searches one shard (its own number's), whose
k-th score bounds every query from below; with that bound it searches all
shards. In a shard each query visits nodes best first by the largest inner
product its box allows, stops when no open box reaches the k-th score (equal
ones are visited, for ties), and the bound rises as it goes.

Pairs of (query block, shard) are the rows of the search: both are bounded in
size, and their number is that of all queries against all rows in blocks,
which an exact search over every row needs.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firelog.llm.common import stored, unused

K = 5
SCALE = 256
SHARD_ROWS = 8192
LEAF_ROWS = 256
BLOCK_QUERIES = 256
# Products of components up to this size add up exactly in double precision.
EXACT = 1 << 20


class Tree:
    """A KD-tree over integer vectors: rows in leaf order, nodes in heap order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        n, d = vectors.shape
        self.depth = max(0, int(np.ceil(np.log2(max(1, n) / LEAF_ROWS))))
        order = np.arange(n)
        bounds = [(0, n)]
        for _ in range(self.depth):
            cut = []
            for a, b in bounds:
                part = order[a:b]
                mid = (b - a) // 2
                if b - a > 1:
                    v = vectors[part]
                    axis = int(np.argmax(v.max(axis=0) - v.min(axis=0)))
                    order[a:b] = part[np.argpartition(v[:, axis], mid)]
                cut += [(a, a + mid), (a + mid, b)]
            bounds = cut
        self.ids, self.vectors, self.bounds = ids[order], vectors[order], bounds
        leaves = len(bounds)
        empty = np.iinfo(np.int64)
        self.low = np.full((2 * leaves, d), empty.max, np.int64)
        self.high = np.full((2 * leaves, d), empty.min, np.int64)
        for i, (a, b) in enumerate(bounds):
            if b > a:
                self.low[leaves + i] = self.vectors[a:b].min(axis=0)
                self.high[leaves + i] = self.vectors[a:b].max(axis=0)
        for i in range(leaves - 1, 0, -1):
            self.low[i] = np.minimum(self.low[2 * i], self.low[2 * i + 1])
            self.high[i] = np.maximum(self.high[2 * i], self.high[2 * i + 1])

    def search(self, queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, k: int):
        """Up to k (score, vec_id) of every query with a score of at least its ``floor``, best first."""
        leaves = len(self.bounds)
        filled = self.low[:, 0] <= self.high[:, 0]
        kind = np.float64 if max(np.abs(queries).max(initial=0), np.abs(self.vectors).max(initial=0)) <= EXACT else np.int64
        q = queries.astype(kind)
        low, high = np.where(filled[:, None], self.low, 0).astype(kind), np.where(filled[:, None], self.high, 0).astype(kind)
        bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        vectors = self.vectors.astype(kind)
        out = []
        for i in range(len(q)):
            limit, best = floor[i], []  # best: a heap of (score, -vec_id), the worst on top
            open_ = [(-bound[i, 1], 1)] if filled[1] else []
            while open_:
                reach, node = heapq.heappop(open_)
                if -reach < limit:
                    break
                if node < leaves:
                    for child in (2 * node, 2 * node + 1):
                        if filled[child] and bound[i, child] >= limit:
                            heapq.heappush(open_, (-bound[i, child], child))
                    continue
                a, b = self.bounds[node - leaves]
                scores = vectors[a:b] @ q[i]
                near = np.flatnonzero(scores >= limit)
                near = near[self.ids[a + near] != query_ids[i]]
                if len(near) > k:
                    near = near[np.lexsort((self.ids[a + near], -scores[near]))[:k]]
                for j in near:
                    item = (int(scores[j]), -int(self.ids[a + j]))
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                if len(best) == k:
                    limit = max(limit, best[0][0])
            out.append(sorted(best, reverse=True))
        return out


def _vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, v)`` of rows with an id whose vector is not null, not empty and all finite."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & good).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x * SCALE)).alias("v"))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.stack(lists.to_numpy(zero_copy_only=False)).astype(np.int64)


def _pack(ids: np.ndarray, vectors: np.ndarray) -> bytes:
    return ids.astype(np.int64).tobytes() + vectors.astype(np.int64).tobytes()


def _unpack(raw: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(raw, np.int64)
    n = len(data) // (dim + 1)
    return data[:n], data[n:].reshape(n, dim)


_BLOCKS = "dim int, part int, rows binary"


def _blocks(rows: DataFrame, size: int, count: int) -> DataFrame:
    """Rows of equal dimension gathered into blocks of about ``size``, dealt by a hash of the id."""
    parts = max(1, -(-count // size))

    def gather(key, table):
        ids = table.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        raw = _pack(ids[order], _matrix(table.column("v"))[order])
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()),
                         "rows": pa.array([raw], pa.binary())})

    return (rows.withColumn("dim", F.size("v")).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
            .groupBy("dim", "part").applyInArrow(gather, _BLOCKS))


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """``(query_id, vec_id, score)`` of rows (dim, queries, floors, rows): each query block against one shard."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                qid, q = _unpack(r["queries"], r["dim"])
                ids, vectors = _unpack(r["rows"], r["dim"])
                floor = np.frombuffer(r["floors"], np.float64) if r["floors"] else np.full(len(qid), -np.inf)
                found = Tree(ids, vectors).search(q, qid, floor, k)
                rows = [(int(i), -v, s) for i, best in zip(qid, found, strict=True) for s, v in best]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], pa.int64()) for c in range(3)],
                                                 names=["query_id", "vec_id", "score"])

    return pairs.select("dim", "queries", "floors", "rows").mapInArrow(run, "query_id long, vec_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_k(table: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows of every query row, its own id apart.

    ``is_query`` is a condition on the table. Vectors that are null, empty or
    hold a null or non-finite component, and rows without id, take no part; a
    query meets vectors of its own length only. Ties go to the smaller id; a
    row that repeats id and vector is a candidate of its own, and as a query
    asks once. An empty table gives an empty result; components beyond ``EXACT`` are multiplied as 64-bit integers.
    """
    spark = table.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # a row is a block
    asks = unused(table, "is_query")
    marked = table.withColumn(asks, F.coalesce(is_query, F.lit(False)))
    rows = _vectors(marked, id_col, vector_col)
    queries = _vectors(marked.where(F.col(asks)), id_col, vector_col).distinct()
    rows, queries = stored(rows, "vectors"), stored(queries, "queries")
    shards = stored(_blocks(rows, SHARD_ROWS, rows.count()), "shards").withColumnRenamed("part", "shard")
    blocks = stored(_blocks(queries, BLOCK_QUERIES, queries.count()), "query-blocks").withColumnRenamed("rows", "queries")
    numbers = shards.groupBy("dim").agg(F.sort_array(F.collect_list("shard")).alias("shards"))  # one number per shard
    blocks = blocks.join(numbers, "dim")
    home = blocks.withColumn("shard", F.expr("shards[part % size(shards)]"))
    bound = F.lit(None).cast("binary").alias("floors")
    first = _search(home.join(shards, ["dim", "shard"]).select("dim", "queries", bound, "rows"), k)
    floors = stored(first.groupBy("query_id").agg(F.min("score").alias("s"), F.count(F.lit(1)).alias("n")), "floors")
    floors = floors.where(F.col("n") >= k).select("query_id", "s")
    known = queries.select(F.col("vec_id").alias("query_id"), F.size("v").alias("dim"),
                           F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-queries.count() // BLOCK_QUERIES)))).cast("int").alias("part"))

    def gather(key, t):
        ids, s = t.column("query_id").to_numpy(), t.column("s").to_numpy(zero_copy_only=False).astype(np.float64)
        order = np.argsort(ids, kind="stable")
        raw = np.where(np.isnan(s), -np.inf, s)[order].tobytes()
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()),
                         "floors": pa.array([raw], pa.binary())})

    by_block = known.join(floors, "query_id", "left").groupBy("dim", "part").applyInArrow(gather, "dim int, part int, floors binary")
    every = (blocks.join(by_block, ["dim", "part"]).withColumn("shard", F.explode("shards"))
             .join(shards, ["dim", "shard"]).repartition("part", "shard"))
    return _top(_search(every, k), k).select("query_id", "rank", "vec_id", "score")
