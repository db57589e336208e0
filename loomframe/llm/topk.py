"""Exact top-k inner-product search over KD-trees, one per shard."""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomframe.llm.common import Workspace, stored, table

#: Vectors in a shard on average, vectors in a leaf, queries that one task group puts to a shard, and rows in a block of boxes or queries.
SHARD_ROWS, LEAF_ROWS, GROUP_QUERIES, BLOCK = 8192, 256, 16384, 1024
#: At most so many vectors of each length are looked at to place the shards. They decide where a vector is searched, never whether.
SAMPLE = 4096
#: Doubles hold integers below this exactly.
EXACT = 2**53


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The most that the inner product of each query with a vector in each box can be, rounding included."""
    up, down = np.where(queries > 0, queries, 0), np.where(queries < 0, queries, 0)
    most = up @ high.T + down @ low.T
    slack = np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T
    return most + slack * 1e-12


class KDTree:
    """Median splits along the widest axis; every node keeps the tight box of its vectors (integers)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_ROWS):
        order = np.arange(len(ids))
        low, high, child, span = [], [], [], []
        todo = [(0, len(ids), -1)]
        while todo:
            start, end, parent = todo.pop()
            block = vectors[order[start:end]]
            low.append(block.min(0))
            high.append(block.max(0))
            node = len(child)
            child.append([-1, -1])
            span.append((start, end))
            if parent >= 0:
                child[parent][child[parent][0] >= 0] = node
            width = high[node].astype(float) - low[node]
            axis = int(np.argmax(width))
            if end - start > leaf and width[axis] > 0:
                middle = (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(block[:, axis], middle)]
                todo += [(start, start + middle, node), (start + middle, end, node)]
        self._set(np.array(low), np.array(high), np.array(child), np.array(span), ids[order], vectors[order])

    def _set(self, low: np.ndarray, high: np.ndarray, child: np.ndarray, span: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.parts = low, high, child, span, ids, vectors
        self.low, self.high, self.child, self.span, self.ids, self.vectors = low.astype(float), high.astype(float), child.tolist(), span.tolist(), ids, vectors
        self.doubles = vectors.astype(float)
        self.largest = max(int(high[0].max()), -int(low[0].min()), 1) * vectors.shape[1]

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, *self.parts)
        return out.getvalue()

    @classmethod
    def load(cls, raw: bytes) -> KDTree:
        with np.load(io.BytesIO(raw)) as parts:
            out = cls.__new__(cls)
            out._set(*[parts[f"arr_{i}"] for i in range(6)])
        return out

    def search(self, query: np.ndarray, own: int, k: int, least: float = -np.inf) -> list[tuple[int, int]]:
        """The k best (score, -id) of least or more. Boxes are visited best bound first; a bound below the kth score (or below least, the kth score
        that other shards have given) ends the search.

        Scores are sums of integers in doubles while these are exact, and of Python's integers where a score could reach 2 ** 53.
        """
        exact = self.largest * max(int(np.abs(query).max(initial=0)), 1) < EXACT
        as_double = query.astype(float)
        # ties must still be visited, for the smaller id
        bound = bounds(as_double[None], self.low, self.high)[0]
        best: list[tuple[int, int]] = []
        queue = [(-bound[0], 0)]
        while queue:
            most, node = heapq.heappop(queue)
            if -most < (best[0][0] if len(best) == k else least):
                break
            if self.child[node][0] >= 0:
                for c in self.child[node]:
                    if bound[c] >= (best[0][0] if len(best) == k else least):
                        heapq.heappush(queue, (-bound[c], c))
                continue
            start, end = self.span[node]
            ids = self.ids[start:end]
            scores = self.doubles[start:end] @ as_double if exact else self.vectors[start:end].astype(object) @ query.astype(object)
            ok = (ids != own) & (scores >= (best[0][0] if len(best) == k else least))
            scores, ids = scores[ok], ids[ok]
            if len(ids) > k:
                top = np.lexsort((ids, -scores))[:k] if exact else np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k])
                scores, ids = scores[top], ids[top]
            for s, i in zip(scores.tolist(), ids.tolist()):
                (heapq.heappush if len(best) < k else heapq.heappushpop)(best, (int(s), -i))
        return best


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): v holds floor(scale * x) of each component. Null ids, null vectors and vectors that hold a null or a non-finite component drop out."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite).select("vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


class Places:
    """Shards as the leaves of median splits of a sample, so that near vectors share a shard and the shards' boxes are small."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.splits: list[tuple[int, float, int, int]] = []
        self.leaves = 0
        self.root = self._split(sample.astype(float), ceil(log2(shards)) if shards > 1 else 0)

    def _split(self, x: np.ndarray, depth: int) -> int:
        """The number of a split, or -1 - the number of a leaf."""
        width = np.ptp(x, 0) if len(x) > 1 else np.zeros(x.shape[1])
        if not depth or len(x) < 2 or not width.any():
            self.leaves += 1
            return -self.leaves
        axis = int(width.argmax())
        value = float(np.median(x[:, axis]))
        value = value if (x[:, axis] > value).any() else float(x[:, axis].min())
        at = len(self.splits)
        self.splits.append((axis, value, 0, 0))
        self.splits[at] = (axis, value, self._split(x[x[:, axis] <= value], depth - 1), self._split(x[x[:, axis] > value], depth - 1))
        return at

    def shard(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            if node < 0:
                out[at] = -1 - node
            elif len(at):
                axis, value, left, right = self.splits[node]
                small = x[at, axis] <= value
                todo += [(left, at[small]), (right, at[~small])]
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def sharded(candidates: DataFrame, space: Workspace) -> DataFrame:
    """dim, shard, vec_id, v: candidates dealt to shards of near vectors. What would fill a shard too much (many equal vectors, say) is dealt to several
    shards by a hash of the id."""
    sizes = {r["dim"]: r["n"] for r in candidates.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    places: dict[int, Places] = {}
    for dim, n in sizes.items():
        every = max(1, n // SAMPLE)
        some = candidates.filter((F.size("v") == dim) & (F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(every)) == 0)).select("v").limit(2 * SAMPLE).collect()
        places[dim] = Places(np.array([r["v"] for r in some], float).reshape(len(some), dim), max(1, ceil(n / SHARD_ROWS)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(v) for v in batch.column(1)], np.int64)
            shard = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                shard[at] = places[dim].shard(_matrix(batch.column(1).take(pa.array(at))).astype(float)) if dim else 0
            yield pa.RecordBatch.from_arrays([pa.array(dims), pa.array(shard), *batch.columns], ["dim", "shard", "vec_id", "v"])

    placed = space.stored(candidates.select("vec_id", "v").mapInArrow(place, "dim long, shard long, vec_id long, v array<long>"), "placed")
    full = placed.groupBy("dim", "shard").agg(F.ceil(F.count(F.lit(1)) / (2 * SHARD_ROWS)).cast("int").alias("parts"))
    parts = {(r["dim"], r["shard"]): r["parts"] for r in full.filter("parts > 1").collect()}  # one number for more than 2 * SHARD_ROWS vectors

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = np.array([parts.get(x, 1) for x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.int64)
            part = (batch.column(2).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % np.maximum(most, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(batch.column(1).to_numpy() + (part << 40)), *batch.columns[2:]], batch.schema.names)

    return placed.mapInArrow(deal, placed.schema) if parts else placed


def wanted(queries: DataFrame, boxes: DataFrame, first: bool) -> DataFrame:
    """query rows (vec_id, v, dim, least, seen) with a shard: the one of the best bound, or (not first) each other one whose bound reaches least.

    Queries and boxes meet in blocks: bounds of BLOCK queries and BLOCK boxes are one product of matrices.
    """
    q_blocks, b_blocks = max(1, ceil(queries.count() / BLOCK)), max(1, ceil(boxes.count() / BLOCK))
    left = queries.withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(q_blocks)).cast("int")).withColumn("bb", F.explode(F.sequence(F.lit(0), F.lit(b_blocks - 1))))
    right = boxes.withColumn("bb", F.pmod(F.xxhash64("shard"), F.lit(b_blocks)).cast("int")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))

    def meet(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        columns = {"vec_id": "int64", "v": object, "dim": "int64", "least": float, "shard": "int64", "bound": float}
        if not len(asked) or not len(known):
            return pd.DataFrame({c: pd.Series([], dtype=t) for c, t in columns.items()})
        most = bounds(np.stack(asked["v"]).astype(float), np.stack(known["low"]).astype(float), np.stack(known["high"]).astype(float))
        shard = known["shard"].to_numpy()
        if first:
            x, y = np.arange(len(asked)), most.argmax(1)
        else:
            x, y = np.nonzero((most >= asked["least"].to_numpy()[:, None]) & (shard[None] != asked["seen"].to_numpy()[:, None]))
        return asked.iloc[x][["vec_id", "v", "dim", "least"]].assign(shard=shard[y], bound=most[x, y])[list(columns)]

    keys = ["qb", "bb", "dim"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "vec_id long, v array<long>, dim long, least double, shard long, bound double")
    if first:
        met = met.groupBy("vec_id").agg(F.max(F.struct("bound", "shard")).alias("m")).select("vec_id", F.col("m.shard").alias("shard"))
        return queries.join(met, "vec_id").select("vec_id", "v", "dim", "least", "shard")
    return met.drop("bound")


def searched(asked: DataFrame, trees: DataFrame, k: int, space: Workspace) -> DataFrame:
    """query_id, vec_id, score: what each query finds in the shard that it is sent to. A task loads a shard's tree once and puts the queries to it as they come."""
    asked = space.stored(asked, "asked")
    salts = space.stored(asked.groupBy("dim", "shard").agg(F.ceil(F.count(F.lit(1)) / GROUP_QUERIES).cast("int").alias("salts")), "salts")
    members = asked.join(salts, ["dim", "shard"]).select("dim", "shard", F.pmod(F.xxhash64("vec_id"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"), "vec_id", "v", "least", F.lit(None).cast("binary").alias("tree"))
    centres = trees.join(salts, ["dim", "shard"]).select("dim", "shard", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), F.lit(-1).cast("long").alias("vec_id"), F.expr("cast(array() as array<bigint>)").alias("v"), F.lit(0.0).alias("least"), "tree")
    parts = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = members.unionByName(centres).repartition(parts, "dim", "shard", "salt").sortWithinPartitions("dim", "shard", "salt", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for i in range(batch.num_rows):
                if batch.column(3)[i].as_py() == 0:
                    tree = KDTree.load(batch.column(7)[i].as_py())
                else:
                    own = batch.column(4)[i].as_py()
                    found = tree.search(np.array(batch.column(5)[i].as_py(), np.int64), own, k, batch.column(6)[i].as_py())
                    out += [(own, -j, s) for s, j in found]
            columns = list(zip(*out)) if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    return space.stored(rows.mapInArrow(run, "query_id long, vec_id long, score long"), "found")


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: for every query the k candidates of the largest inner product, its own id left out.

    Both tables have vec_id and v (array of long). Vectors meet vectors of their own length only. Each shard's tree is built once and stored.
    A query is first put to the shard whose box promises most; the kth score found there goes with it, and it is sent on only to shards whose box
    can reach that score. What is shuffled is the vectors, the queries, and a query once for each such shard. Ties go to the smaller id. Repeated candidate
    rows count as often as they occur; a repeated query is answered once; empty tables give an empty one. A score that doesn't fit 64 bits is an error.
    """
    with Workspace(candidates.sparkSession) as space:
        placed = sharded(candidates, space)

        def build(rows: pd.DataFrame) -> pd.DataFrame:
            v = np.stack(rows["v"].to_numpy()).astype(np.int64)
            tree = KDTree(rows["vec_id"].to_numpy(np.int64), v)
            return pd.DataFrame({"dim": rows["dim"].iloc[:1], "shard": rows["shard"].iloc[:1], "low": [v.min(0)], "high": [v.max(0)], "tree": [tree.dump()]})

        trees = space.stored(placed.filter("dim > 0").groupBy("dim", "shard").applyInPandas(build, "dim long, shard long, low array<long>, high array<long>, tree binary"), "trees")
        boxes = trees.select("dim", "shard", "low", "high")
        asked = queries.dropDuplicates(["vec_id"]).select("vec_id", "v", F.size("v").cast("long").alias("dim"), F.lit(float("-inf")).alias("least"), F.lit(-1).cast("long").alias("seen"))
        asked = space.stored(asked.filter("dim > 0"), "queries")
        home = space.stored(wanted(asked, boxes, True), "home")
        near = searched(home, trees, k, space)
        kth = near.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).otherwise(float("-inf")).alias("least"))
        again = home.select("vec_id", "v", "dim", F.col("shard").alias("seen")).join(kth, "vec_id", "left").na.fill({"least": float("-inf")})
        far = searched(wanted(space.stored(again, "again"), boxes, False), trees, k, space)
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        ranked = near.unionByName(far).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        return stored(ranked, "top_k")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


ORACLE = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
QUERIES = {"op1_top_k": op1_top_k}
ORACLES = {"op1_top_k": ORACLE}
