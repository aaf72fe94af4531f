"""Exact top-k inner products by ball trees, one per shard.

Vectors are dealt into shards of bounded size; a task builds its shard's ball
tree and streams the queries through it in blocks. Branch and bound: a node's
inner product with q is at most q.centre + |q| * radius; nodes are entered in
the order of that bound and left when it is below the query's kth score so far.
The kth score is shared: each query first searches one shard, and what it finds
there is its floor in all the others.

Components become floor(scale * x), so scores are integers. They are exact:
in floating point where all products stay below 2**53, else in Python's whole
numbers (a score beyond 64 bits is held at that limit).

Defined cases: vectors that are null or hold a null or non-finite component, and
rows without an id, take no part; vectors meet only vectors of their length;
equal scores rank by the lesser id; a row's own id never answers it; of several
query rows with one id the least vector asks, while repeated rows all answer;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featureflow.llm.common import partitions, stored

SHARD_ROWS = 32_768  # vectors in a tree, at most about
LEAST_SHARD = 2_048  # fewer are not split for the sake of more tasks
QUERY_ROWS = 100_000  # queries that one task streams through a tree
BLOCK = 512
LEAF = 64


class BallTree:
    """Centres and radii of nested halves of a set of vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.arange(len(x))
        as_float = x.astype(float)
        centres, radii, spans, children = [], [], [], []
        todo = [(0, len(x), -1, 0)]
        while todo:
            lo, hi, parent, side = todo.pop()
            part = as_float[order[lo:hi]]
            centre = part.mean(0)
            node = len(centres)
            if parent >= 0:
                children[parent][side] = node
            centres.append(centre)
            radii.append(math.sqrt(float(((part - centre) ** 2).sum(1).max())))
            spans.append((lo, hi))
            children.append([-1, -1])
            if hi - lo > LEAF and radii[-1] > 0:
                axis = int(part.var(0).argmax())
                mid = (hi - lo) // 2
                order[lo:hi] = order[lo:hi][np.argpartition(part[:, axis], mid)]
                todo += [(lo, lo + mid, node, 0), (lo + mid, hi, node, 1)]
        self.ids, self.x = ids[order], x[order]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.reach = np.sqrt((self.centres ** 2).sum(1)) + self.radii
        self.spans, self.children = spans, children

    def search(self, q_ids: np.ndarray, q: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids), k columns best first, of the queries of a block; unused places score -inf."""
        m = len(q)
        exact_float = q.dtype != object and self.x.dtype != object
        best = np.full((m, k), -np.inf) if exact_float else np.full((m, k), -math.inf, object)
        best_ids = np.full((m, k), np.iinfo(np.int64).max)
        as_float = q.astype(float)
        norms = np.sqrt((as_float ** 2).sum(1))

        def bound(node: int, who: np.ndarray) -> np.ndarray:
            # widened by more than the rounding error of the product
            slack = 1e-9 * norms[who] * self.reach[node] + 1e-6
            return as_float[who] @ self.centres[node] + norms[who] * self.radii[node] + slack

        everyone = np.arange(m)
        todo = [(0, everyone, bound(0, everyone))]
        while todo:
            node, who, upper = todo.pop()
            who = who[upper >= np.maximum(best[who, -1].astype(float) - 1e-6, floors[who])]
            if not len(who):
                continue
            left, right = self.children[node]
            if left < 0:
                lo, hi = self.spans[node]
                for at in range(lo, hi, 4 * LEAF):
                    self._meet(slice(at, min(hi, at + 4 * LEAF)), who, q_ids, q, best, best_ids)
                continue
            a, b = bound(left, who), bound(right, who)
            first, second = ((left, a), (right, b)) if a.sum() >= b.sum() else ((right, b), (left, a))
            todo += [(second[0], who, second[1]), (first[0], who, first[1])]
        return best, best_ids

    def _meet(self, rows: slice, who, q_ids, q, best, best_ids) -> None:
        k = best.shape[1]
        score = q[who] @ self.x[rows].T
        ids = np.broadcast_to(self.ids[rows], score.shape)
        score = np.where(ids == q_ids[who][:, None], -np.inf, score)
        better = (score >= best[who, -1][:, None]).any(1)
        who, score, ids = who[better], score[better], ids[better]
        if not len(who):
            return
        score, ids = np.concatenate((best[who], score), 1), np.concatenate((best_ids[who], ids), 1)
        if score.dtype == object:
            order = np.array([sorted(range(score.shape[1]), key=lambda j, r=r: (-score[r, j], ids[r, j]))[:k] for r in range(len(who))])
        else:
            order = np.lexsort((ids, -score))[:, :k]
        best[who], best_ids[who] = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)


def _whole(column: pa.Array, scale: float) -> np.ndarray:
    """The vectors of an array column as whole numbers: floats below 2**53 products, else objects."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    x = np.floor(scale * flat).reshape(len(column), -1)
    top = float(np.abs(x).max()) if x.size else 0.0
    if top * top * max(1, x.shape[1]) >= 2.0 ** 53:
        return np.array([[int(v) for v in r] for r in x], object).reshape(x.shape)
    return x


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.col(vector_col)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(v.isNotNull() & F.col(id_col).isNotNull()).where(~odd)
    return rows.select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v"))


def _search(shards: DataFrame, queries: DataFrame, k: int, scale: float, n_parts: int) -> DataFrame:
    """(query_id, id, score) of each query in each (dim, shard, part) it is sent to.

    Rows of one key arrive vectors first: the tree is built once, the queries
    behind it are searched a block at a time.
    """
    key = ["dim", "shard", "part"]
    rows = shards.select(*key, F.lit(0).alias("kind"), "id", "v", F.lit(float("-inf")).alias("floor")).union(
        queries.select(*key, F.lit(1).alias("kind"), "id", "v", "floor"))
    rows = rows.repartition(n_parts, *key).sortWithinPartitions(*key, "kind", "id")
    names = ["query_id", "id", "score"]

    def run(batches):
        now, tree, held = None, None, []

        def build():
            nonlocal held
            if held:
                ids = np.concatenate([i for i, _, _ in held])
                xs = [x for _, x, _ in held]
                if any(x.dtype == object for x in xs):
                    xs = [x.astype(object) for x in xs]
                x = np.concatenate(xs)
                if x.dtype == object:
                    x = np.array([[int(e) for e in r] for r in x], object).reshape(x.shape)
                held = []
                return BallTree(ids, x)
            return None

        def ask(ids, q, floors):
            x = tree.x
            top = float(np.abs(q).max()) * float(np.abs(x).max()) * x.shape[1] if q.size and x.size else 0.0
            if x.dtype == object or q.dtype == object or top >= 2.0 ** 53:
                q = np.array([[int(e) for e in r] for r in q], object).reshape(q.shape)
            score, found = tree.search(ids, q, floors, k)
            real = np.array(score > -math.inf, bool)
            who = np.broadcast_to(ids[:, None], real.shape)[real]
            limit = 2 ** 63 - 1
            whole = [max(-limit - 1, min(limit, int(s))) for s in score[real]]
            return pa.record_batch([pa.array(who, pa.int64()), pa.array(found[real], pa.int64()), pa.array(whole, pa.int64())], names=names)

        for b in batches:
            keys = list(zip(*(b.column(i).to_pylist() for i in range(4))))
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at] and end - at < BLOCK:
                    end += 1
                part, key_now, kind = b.slice(at, end - at), keys[at][:3], keys[at][3]
                if key_now != now:
                    now, tree, held = key_now, None, []
                ids, x = part.column(4).to_numpy(), _whole(part.column(5), scale)
                if kind == 0:
                    held.append((ids, x, None))
                else:
                    tree = build() or tree
                    if tree is not None:
                        yield ask(ids, x, part.column(6).to_numpy())
                at = end

    return rows.mapInArrow(run, "query_id long, id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = 1024.0) -> DataFrame:
    """(query_id, rank, id, score): the k best other rows of every row where ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = _valid(vectors, id_col, vector_col).withColumn("dim", F.size("v"))
    rows = stored(rows, "ball-rows")
    n = rows.count()
    parts = partitions(spark)
    shards = max(1, math.ceil(n / SHARD_ROWS), min(parts, math.ceil(n / LEAST_SHARD)))
    asked = stored(rows.withColumnRenamed("id", id_col).where(is_query).groupBy(F.col(id_col).alias("id")).agg(F.min("v").alias("v"))
                   .withColumn("dim", F.size("v")), "ball-queries")
    n_parts = max(1, math.ceil(asked.count() / QUERY_ROWS))
    split = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(n_parts)).cast("int")
    home = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).withColumn("part", every)
    tasks = max(parts, shards * n_parts)

    seed = asked.withColumn("part", split).withColumn("shard", home).withColumn("floor", F.lit(float("-inf")))
    first = stored(_search(dealt, seed, k, scale, tasks), "ball-first")
    # the kth score in its first shard: nothing below it can be among the k best
    floors = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").cast("double").alias("least"))
    floors = floors.where(F.col("n") >= k).select("query_id", "least")
    others = asked.withColumn("part", split).withColumn("home", home).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    others = others.join(floors, F.col("id") == F.col("query_id"), "left").withColumn(
        "floor", F.coalesce("least", F.lit(float("-inf"))))
    found = first.union(_search(dealt, others, k, scale, tasks))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
