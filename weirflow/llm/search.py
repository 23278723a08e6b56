"""Exact top-k search by MaxScore (operator 6).

A term is a dimension with a sign; its postings are the vectors of a shard whose component has that sign, with
the absolute component as impact.  A query's terms are its own signs; components of the other sign only
lower a score.  Terms are ordered by their bound (weight times the shard's largest impact).  Those whose
bounds together stay below the score of the k-th best so far are non-essential: a vector in none of
the essential postings can't enter.  Essential postings are traversed, the other terms are probed for the
vectors that are still competitive, and then the penalties; the results of shards are merged.

Queries go to the executors in blocks of bounded size, one after another, and each block meets all vectors; the
results of a block are written before the next one is read, so that the driver holds one block.  A task's
shards grow from FIRST_ROWS to SHARD_ROWS vectors, as there is no bound to beat before the first k scores.

Cases: vectors that are null or hold a null or non-finite component take no part, nor do rows with a null
vec_id; shorter vectors count as filled up with zeros; an empty vector scores 0; rows that have the query's
vec_id are its own and no candidates of it; repeated query rows are each answered; ties go to the smaller
vec_id; products are exact integers, and a score beyond 64 bits is an error; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

SCALE, TOP = 1024, 10
#: Bytes of query vectors that go to the executors at once.
BLOCK_BYTES = 24_000_000
#: Vectors of a task's first shard of postings, and of its largest.
FIRST_ROWS, SHARD_ROWS = 512, 8192


def matrix(rows: list, scale: int) -> np.ndarray:
    """floor(scale * x) of vectors, filled up with zeros; exact integers of any size."""
    width = max((len(r) for r in rows), default=0)
    if all(len(r) == width for r in rows):
        x = np.array(rows, np.float64).reshape(len(rows), width)
    else:
        x = np.zeros((len(rows), width))
        for k, r in enumerate(rows):
            x[k, : len(r)] = r
    x = np.floor(x * scale)
    if x.size and np.abs(x).max() >= 2**31:
        return np.array([[int(v) for v in r] for r in x], object).reshape(x.shape)
    return x.astype(np.int64)


def fitted(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.concatenate([x, np.zeros((len(x), width - x.shape[1]), x.dtype)], axis=1)


class Shard:
    """Postings of some vectors by dimension and sign, with the bound of each."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.postings = {}
        self.most = np.zeros((2, x.shape[1]), x.dtype)
        for d in range(x.shape[1]):
            for s, sign in enumerate((1, -1)):
                at = np.flatnonzero(sign * x[:, d] > 0)
                self.postings[s, d] = (at, sign * x[at, d])
                self.most[s, d] = max(self.postings[s, d][1], default=0)

    def search(self, q: np.ndarray, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of all vectors that score at least ``floor``; without one all terms are essential."""
        own = np.flatnonzero(q)
        side = (q[own] < 0).astype(int)
        weight = abs(q[own])
        bound = weight * self.most[side, own]
        order = np.argsort(bound, kind="stable")
        total = np.cumsum(bound[order])
        cut = 0  # terms whose bounds sum to less than the floor; they are non-essential
        if floor is not None and floor > 0:
            cut = int(np.searchsorted(total, floor, "left"))
        score = np.zeros(len(self.ids), self.x.dtype)
        for t in order[cut:][::-1]:
            at, impact = self.postings[side[t], own[t]]
            score[at] += weight[t] * impact
        rest = total[cut - 1] if cut else 0
        live = np.arange(len(score)) if floor is None else np.flatnonzero(score + rest >= floor)
        score = score[live]
        for t in order[:cut][::-1]:
            if not len(live):
                break
            value = self.x[live, own[t]] * (1 - 2 * side[t])
            score = score + weight[t] * np.maximum(value, 0)
            rest -= bound[t]
            keep = score + rest >= floor
            live, score = live[keep], score[keep]
        # penalties, heaviest first
        for t in np.argsort(-weight, kind="stable"):
            if not len(live):
                break
            value = self.x[live, own[t]] * (1 - 2 * side[t])
            score = score + weight[t] * np.minimum(value, 0)
            if floor is not None:
                keep = score >= floor
                live, score = live[keep], score[keep]
        return live, score


class Best:
    """The best k of one query so far: scores and ids, in order."""

    __slots__ = ("scores", "ids", "k")

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, [], []

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 4 * self.k:  # all that tie with the k-th stay for the moment
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k] if scores.dtype != object else sorted(scores)[-self.k]
            scores, ids = scores[scores >= least], ids[scores >= least]
        rows = sorted(zip(self.scores + [int(s) for s in scores], self.ids + [int(i) for i in ids]), key=lambda r: (-r[0], r[1]))[: self.k]
        self.scores, self.ids = [r[0] for r in rows], [r[1] for r in rows]

    @property
    def floor(self) -> int | None:
        return self.scores[-1] if len(self.scores) == self.k else None


def _exact(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether products can be summed in 53 bits."""
    if x.dtype == object or y.dtype == object or not x.size or not y.size:
        return False
    return float(abs(x).max()) * float(abs(y).max()) * x.shape[1] < 2**52


def search_batches(batches, query_ids: np.ndarray, queries: np.ndarray, scale: int, top: int):
    """Yields (query's place, its id, vec_id, score) of a task's best rows for each query."""
    best = [Best(top) for _ in query_ids]
    rows = min(FIRST_ROWS, SHARD_ROWS)
    ids: list[int] = []
    vectors: list = []

    def work() -> None:
        x, own = matrix(vectors, scale), np.array(ids, np.int64)
        width = max(x.shape[1], queries.shape[1])
        x, q = fitted(x, width), fitted(queries, width)
        if object in (x.dtype, q.dtype) or not _exact(q, x):
            x, q = x.astype(object), q.astype(object)
        shard = Shard(own, x)
        for b, v, i in zip(best, q, query_ids):
            at, scores = shard.search(v, b.floor)
            if len(at):
                other = shard.ids[at] != i
                b.add(scores[other], shard.ids[at][other])

    for batch in batches:
        ids += batch.column(0).to_pylist()
        vectors += batch.column(1).to_pylist()
        if len(ids) >= rows:
            work()
            ids, vectors, rows = [], [], min(4 * rows, SHARD_ROWS)
    if ids:
        work()
    for k, (b, i) in enumerate(zip(best, query_ids)):
        for s, v in zip(b.scores, b.ids):
            yield k, int(i), v, s


def top_k(vectors: DataFrame, every: int = 100, top: int = TOP, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score: rows whose vec_id is divisible by ``every`` against all rows."""
    spark = vectors.sparkSession
    common.arrow_rows(spark, 2000)
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = vectors.where("vec_id is not null and embedding is not null").where(~F.coalesce(bad, F.lit(False)))
    sound = sound.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    asked = sound.where(F.col("vec_id") % every == 0)
    cells = asked.agg(F.coalesce(F.sum(F.size("embedding") + 2), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(8 * cells / BLOCK_BYTES))
    # Few tasks see all vectors: each gives its best k of every query.
    tasks = max(1, 2 * spark.sparkContext.defaultParallelism)

    def block(k: int) -> DataFrame:
        part = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == k)
        rows = [tuple(r) for r in part.collect()]  # a block's bytes are bounded
        queries = matrix([r[1] for r in rows], scale)
        held = spark.sparkContext.broadcast((np.array([r[0] for r in rows], np.int64), queries))

        def run(batches):
            import pyarrow as pa

            got = list(zip(*search_batches(batches, *held.value, scale, top))) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in got], ["place", "query_id", "vec_id", "score"])

        found = sound.coalesce(tasks).mapInArrow(run, "place long, query_id long, vec_id long, score long").withColumn("block", F.lit(k))
        if blocks == 1:
            return found
        written = scratch.keep(found, f"block-{k}")
        held.destroy()
        return written

    scratch = common.Scratch(spark, "search")
    found = reduce(DataFrame.union, map(block, range(blocks)))
    order = Window.partitionBy("block", "place", "query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(common.table(spark, sf_dir, "embeddings"))


ORACLE = """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) e from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id vec_id, cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda k: q.e[k] * c.e[k])) as bigint) score
      from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from s qualify row_number() over (partition by query_id order by score desc, vec_id) <= 10
"""
