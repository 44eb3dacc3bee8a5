"""Exact top-k search by inner product: ball trees with branch and bound, per shard.

Candidates stay where they lie: they are written once, dealt to shards by hash, and every task
reads its own shards.  Queries come to them in blocks of bounded size, each sent to all tasks.  A
shard builds a ball tree (centre, radius) and visits its nodes in order of the upper bound
q.c + |q| r; a branch is left out for the queries whose bound is below their current k-th score.
That score is shared three times: within a shard it rises as leaves are scored, and a block's
rounds hand it on: a bounded pilot of candidates first, then one shard in EARLY, then the rest, each
round starting from the k-th scores of the one before.

Components are floor(1024 x) as 64-bit integers and scores are exact: products that fit in 53 bits
use floating matrix products, those below 63 bits integer ones, larger ones limbs of LIMB bits put
together as unbounded integers.  Candidates are ordered by the exact score (up to 2**124); what is
returned of a score beyond 64 bits is the nearest 64-bit number.

The work is queries times candidates at worst, as exact search with poor bounds is; memory per
task is one shard, a query block and k results per query.  A query gets at most k rows per shard,
of which only those at or above the shared k-th score leave the task.

Cases: vectors that are null, empty or hold null or non-finite components take no part; vectors
of other lengths than the query's are not compared; equal scores go to the smaller id; the rows
with the query's own id are left out; fewer candidates than k give them all; null ids take no
part; rows repeated with their id count each, as candidates, and once as queries; components
beyond 64 bits stop at its ends; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .staging import staged

K = 10
SCALE = 1024
EVERY = 100
SHARD_ROWS = 16_384
BLOCK_COMPONENTS = 1 << 20  # of the queries sent to the tasks at once (8 MB)
PILOT = 4_096
EARLY = 8
LEAF = 256
LIMB = 21
_LAST = np.iinfo(np.int64).max
_FIRST = np.iinfo(np.int64).min
_END = (1 << 124) - 1  # scores beyond it count as equal
_FOUND = "query_id long, vec_id long, hi long, lo long"


def _most(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of int64 rows: an int64 matrix, or one of unbounded integers."""
    most = _most(q) * _most(x) * q.shape[1]
    if most < 1 << 53:
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return q @ x.T
    out = np.zeros((len(q), len(x)), object)
    parts = lambda a: (a & ((1 << LIMB) - 1), a >> LIMB & ((1 << LIMB) - 1), a >> 2 * LIMB)
    for at in range(0, q.shape[1], 1 << 10):  # so many products of two limbs fit in 53 bits
        for i, a in enumerate(parts(q[:, at:at + (1 << 10)])):
            for j, b in enumerate(parts(x[:, at:at + (1 << 10)])):
                out += (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64).astype(object) << LIMB * (i + j)
    return out


class Ball:
    """A node: its rows, centre, radius and children."""

    __slots__ = ("rows", "centre", "radius", "children")

    def __init__(self, x: np.ndarray, rows: np.ndarray):
        part = x[rows]
        self.rows, self.centre, self.children = rows, part.mean(0), ()
        self.radius = float(np.sqrt(((part - self.centre) ** 2).sum(1).max()))
        if len(rows) > LEAF and self.radius > 0:
            a = part[((part - self.centre) ** 2).sum(1).argmax()]
            b = part[((part - a) ** 2).sum(1).argmax()]
            order = np.argsort(part @ (b - a), kind="stable")
            half = len(rows) // 2
            self.children = (Ball(x, rows[order[:half]]), Ball(x, rows[order[half:]]))


class Best:
    """The k best (score, id) of each query, scores descending and ids ascending.  Scores are int64
    as long as all fit, else unbounded integers; ``floor`` has each query's shared k-th score, or none."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, k: int, floor: list, wide: bool):
        self.q, self.ids, self.k, self.wide = queries, ids, k, wide
        self.none = -(1 << 200) if wide else _FIRST
        kind = object if wide else np.int64
        self.floor = np.array([self.none if f is None else f for f in floor], kind)
        self.real = queries.astype(np.float64)
        self.norm = np.sqrt((self.real ** 2).sum(1))
        self.score = np.full((len(queries), k), self.none, kind)
        self.found = np.full((len(queries), k), _LAST)

    def kth(self, active: np.ndarray) -> np.ndarray:
        return np.maximum(self.score[active, -1], self.floor[active])

    def bound(self, active: np.ndarray, ball: Ball) -> np.ndarray:
        size = self.norm[active] * (np.sqrt((ball.centre ** 2).sum()) + ball.radius)
        return self.real[active] @ ball.centre + self.norm[active] * ball.radius + 1e-6 * (1.0 + size)  # rounding never hides a tie

    def add(self, active: np.ndarray, x: np.ndarray, ids: np.ndarray) -> None:
        step = max(1, 1_000_000 // len(ids))
        for at in range(0, len(active), step):
            rows = active[at:at + step]
            score = products(self.q[rows], x)
            score = score.astype(object) if self.wide else score
            score[self.ids[rows][:, None] == ids[None, :]] = self.none
            better = score.max(1) >= self.kth(rows)
            rows, score = rows[better], score[better]
            score = np.concatenate([self.score[rows], score], 1)
            found = np.concatenate([self.found[rows], np.broadcast_to(ids, (len(rows), len(ids)))], 1)
            if self.wide:
                order = np.array([sorted(range(len(s)), key=lambda j, s=s, f=f: (-s[j], f[j]))[:self.k] for s, f in zip(score, found)], int).reshape(-1, self.k)
            else:
                order = np.lexsort((found, ~score), axis=1)[:, :self.k]
            self.score[rows] = np.take_along_axis(score, order, 1)
            self.found[rows] = np.take_along_axis(found, order, 1)

    def visit(self, x: np.ndarray, ids: np.ndarray, ball: Ball, active: np.ndarray) -> None:
        active = active[self.bound(active, ball) >= self.kth(active).astype(np.float64)]
        if not len(active):
            return
        if not ball.children:
            self.add(active, x[ball.rows], ids[ball.rows])
            return
        near = sorted(ball.children, key=lambda c: -float(self.bound(active, c).sum()))
        for child in near:
            self.visit(x, ids, child, active)

    def results(self) -> pd.DataFrame:
        """query_id, vec_id and the score as hi * 2**62 + lo."""
        a, b = np.nonzero((self.score != self.none) & (self.score >= self.floor[:, None]))
        s = self.score[a, b]
        s = np.array([max(-_END, min(_END, x)) for x in s], object) if self.wide else s
        return pd.DataFrame({"query_id": self.ids[a], "vec_id": self.found[a, b], "hi": (s >> 62).astype(np.int64), "lo": (s & ((1 << 62) - 1)).astype(np.int64)})


def _matrix(v) -> np.ndarray:
    return np.stack(list(v)).astype(np.int64)


def search(x: np.ndarray, ids: np.ndarray, q: np.ndarray, qids: np.ndarray, floor: list, k: int) -> Best:
    beyond = any(f is not None and abs(f) >= 1 << 63 for f in floor)
    best = Best(q, qids, k, floor, beyond or _most(q) * _most(x) * q.shape[1] >= 1 << 63)
    real = x.astype(np.float64)
    best.visit(x, ids, Ball(real, np.arange(len(x))), np.arange(len(q)))
    return best


def prepared(vectors: DataFrame, id_col="vec_id", vec_col="embedding", scale: int = SCALE) -> DataFrame:
    """Usable rows as (id, v array<long>, n)."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~bad).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(v, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long")).alias("v"), F.size(v).alias("n"))


def _scored(candidates: DataFrame, queries: dict, floors: dict, k: int) -> DataFrame:
    """The k best of each shard (query_id, vec_id, hi, lo) for one block of queries, which maps a
    vector length to (ids, vectors); ``floors`` maps query ids to their shared k-th score."""
    shared = candidates.sparkSession.sparkContext.broadcast((queries, floors))

    def shards(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, rows = [], 0
        for part in parts:
            held.append(part)
            rows += len(part)
            if rows >= SHARD_ROWS:
                yield pd.concat(held)
                held, rows = [], 0
        if rows:
            yield pd.concat(held)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted, least = shared.value
        for shard in shards(parts):
            for n, c in shard.groupby("n"):
                if n in wanted:
                    ids, q = wanted[n]
                    yield search(_matrix(c["v"]), c["id"].to_numpy(), q, ids, [least.get(i) for i in ids.tolist()], k).results()

    return candidates.select("id", "v", "n").mapInPandas(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("hi"), F.desc("lo"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _kth(found: DataFrame, k: int) -> dict:
    """Query id to its k-th score; one row per query of a block."""
    return {r.query_id: (r.hi << 62) + r.lo for r in _best(found, k).where(F.col("rank") == k).select("query_id", "hi", "lo").collect()}


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, shard_rows: int = SHARD_ROWS, block_components: int = BLOCK_COMPONENTS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every query row."""
    spark = vectors.sparkSession
    rows = staged(prepared(vectors), "vectors")
    total, widest = rows.agg(F.count("*"), F.max("n")).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shards = max(1, -(-total // shard_rows))
    if shards > 1:
        dealt = rows.withColumn("s", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))
        rows = staged(dealt.repartition(min(shards, 20_000), "s"), "shards")
    else:
        rows = rows.withColumn("s", F.lit(1))
    queries = staged(rows.where(F.col("id") % every == 0).select("id", "v", "n").distinct(), "queries")  # a repeated query row is one query
    blocks = max(1, -(-queries.count() * widest // block_components))
    pilot = rows.where(F.pmod(F.xxhash64("id"), F.lit(max(1, total // PILOT))) == 0)
    found = None
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toPandas()  # bounded by block_components
        by_length = {n: (g["id"].to_numpy(np.int64), _matrix(g["v"])) for n, g in block.groupby("n")}
        floors: dict = {}
        if shards > 1:
            floors = _kth(staged(_scored(pilot, by_length, {}, k), "pilot"), k)
        if shards >= 2 * EARLY:
            early = staged(_scored(rows.where(F.col("s") % EARLY == 0), by_length, floors, k), "early")
            floors |= _kth(early, k)
            late = staged(_scored(rows.where(F.col("s") % EARLY != 0), by_length, floors, k), "late")
            part = early.unionByName(late)
        else:
            part = staged(_scored(rows, by_length, floors, k), "found")
        found = part if found is None else found.unionByName(part)
    score = F.when(F.col("hi") >= 2, F.lit(_LAST)).when(F.col("hi") < -2, F.lit(_FIRST)).otherwise(F.expr("shiftleft(hi, 62) | lo"))
    return _best(found, k).select("query_id", "rank", "vec_id", score.alias("score"))


TOPK_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 100 = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: CAST(z[1] AS HUGEINT) * z[2])) AS BIGINT) AS score
      FROM q JOIN v c ON c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
