"""SimHash near-duplicates with vantage-point trees.

Fingerprints are 64-bit SimHashes of word shingles.  Equal fingerprints are collapsed first, so a
group of copies is one point, however large.  The distinct points are dealt to shards by three
vantage-point trees and searched exactly in each shard:

* A tree's first TOP levels part the points by their whole Hamming distance to a vantage point with search
  radius 2: points within the radius beyond a boundary are handed to the inner branch as well,
  so by the triangle inequality no pair is lost at a boundary.  Random fingerprints lie 32 +- 4 bits apart, so each
  such level copies a fifth of the points; a tree of such levels alone would copy each point some 20 times over at
  10**9 points.
* A pair within 2 bits agrees on one of three blocks of bits (pigeonhole).  Below its top, tree b uses the
  Hamming distance on block b, where the search radius is 0: a pair that agrees on the block has equal distances to
  every vantage point, so it is never separated, and nothing is copied.
* Where block values coincide and the block metric cannot part a large branch any further, the
  tree goes on with the whole distance and its overlapping boundaries.
* The trees are fitted on a sample chosen by hash, which grows with the table up to SAMPLE points, so shards stay
  small; every point is routed.  Inside a shard the same splitting goes on down to LEAF points, which are compared
  in full.  A dense cluster that no vantage point parts is compared in full up to DENSE points; a larger one looks
  up each point's neighbours within 2 bits, which grows in proportion to its points.

A shard returns a star for each of its clusters instead of its pairs, and the components over all
stars are found with distributed star steps (``components``).

Cases: null or blank texts have fingerprint zero and link like any other; texts with fewer words
than a shingle are one shingle; repeated rows are kept; null ids take part but never name a
component unless all ids of it are null; ties need no order, as all links count; very long texts are read
whole, in blocks of shingles; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from .staging import staged

RADIUS = 2
SAMPLE = 1 << 20  # points a tree is fitted on, at most (8 MB on the driver)
PER_SAMPLED = 8  # points for each of the sample, until SAMPLE is reached
SHARD_POINTS = 512
TOP = 2
LEAF = 192
DENSE = 32_768
BATCH_ROWS = 2000  # of an Arrow batch with texts
SEED = 42

_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_H = xxhash.xxh64_intdigest
#: Block masks of 22, 21 and 21 bits.
BLOCKS = tuple(np.uint64(((1 << w) - 1) << lo) for lo, w in ((0, 22), (22, 21), (43, 21)))
WHOLE = np.uint64((1 << 64) - 1)


def shingle_hashes(text: str | None, k: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every k-word shingle, repeats included, of the whole text."""
    words = (text or "").encode().translate(_UPPER).split()  # bytes.split: the six ASCII blanks
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    line = b" ".join(words)
    if n <= k:
        return np.array([_H(line, seed)], np.uint64)
    blanks = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    starts = [0, *(blanks + 1).tolist()]
    ends = [*blanks.tolist(), len(line)]
    return np.fromiter((_H(line[i:j], seed) for i, j in zip(starts, ends[k - 1:])), np.uint64, n - k + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit set where over half of the hashes have it; as a signed 64-bit number."""
    n = len(hashes)
    if not n:
        return 0
    votes = np.zeros(64, np.int64)
    for i in range(0, n, 65_536):  # bounded memory for very long texts
        part = hashes[i:i + 65_536].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.int64)[0])


def with_fingerprint(docs: DataFrame, text_col: str, k: int = 3, out: str = "fp") -> DataFrame:
    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series([fingerprint(shingle_hashes(t, k)) for t in s], dtype="int64")

    return docs.withColumn(out, of(F.col(text_col)))


def _distance(x: np.ndarray, v: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((x ^ v) & mask)


def _split(x: np.ndarray, mask: np.uint64, slack: int):
    """(vantage, mu, inner, outer) that parts x best, or None.  inner has the points up to mu +
    slack away, outer those beyond mu; only slack > 0 makes them overlap."""
    best = None
    for v in x[:: max(1, len(x) // 6)][:8]:
        d = _distance(x, v, mask)
        for mu in {int(np.median(d)), max(int(np.median(d)) - 1, 0)}:
            inner, outer = int((d <= mu + slack).sum()), int((d > mu).sum())
            if outer and inner < len(x) and (best is None or max(inner, outer) < best[0]):
                best = (max(inner, outer), inner + outer, v, mu)
    if best is None or best[1] > 1.7 * len(x) or best[0] > 0.9 * len(x):
        return None
    return best[2], best[3]


class Tree:
    """A vantage-point tree: nodes as arrays (vantage, mask of its metric, mu, slack, inner, outer);
    leaves are negative numbers."""

    def __init__(self, sample: np.ndarray, block: int, leaf: int, top: int = TOP):
        self.block, self.top, self.leaf, self.leaves, nodes = block, top, leaf, 0, []
        self.root = self._grow(sample, False, 0, nodes)
        self.vantage, self.mask = (np.array([n[i] for n in nodes], np.uint64) for i in (0, 1))
        self.mu, self.slack, self.inner, self.outer = (np.array([n[i] for n in nodes], np.int64) for i in (2, 3, 4, 5))

    def _grow(self, x: np.ndarray, whole: bool, depth: int, nodes: list) -> int:
        if len(x) > self.leaf and depth < 60:
            cut = _split(x, WHOLE, RADIUS) if whole or depth < self.top else None
            mask, slack = WHOLE, RADIUS
            if cut is None and not whole:
                mask, slack = BLOCKS[self.block], 0
                cut = _split(x, mask, slack)
            if cut is None and not whole and len(x) > 4 * self.leaf:
                whole, mask, slack = True, WHOLE, RADIUS
                cut = _split(x, mask, slack)
            if cut:
                v, mu = cut
                d = _distance(x, v, mask)
                at = len(nodes)
                nodes.append(None)
                inner = self._grow(x[d <= mu + slack], whole, depth + 1, nodes)
                nodes[at] = (v, mask, mu, slack, inner, self._grow(x[d > mu], whole, depth + 1, nodes))
                return at
        self.leaves += 1
        return -self.leaves

    def route(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, index) of all points, level by level; a point may be in several leaves."""
        idx, at, leaves, found = np.arange(len(x)), np.full(len(x), self.root), [], []
        while len(idx):
            done = at < 0
            leaves.append(-at[done])
            found.append(idx[done])
            idx, at = idx[~done], at[~done]
            d = _distance(x[idx], self.vantage[at], self.mask[at])
            near, far = d <= self.mu[at] + self.slack[at], d > self.mu[at]
            idx, at = np.concatenate([idx[near], idx[far]]), np.concatenate([self.inner[at[near]], self.outer[at[far]]])
        return (np.concatenate(leaves), np.concatenate(found)) if found else (idx, idx)


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Unite the clusters of the pairs (a, b) in label, in place; labels point at least members."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def _compare(x: np.ndarray, idx: np.ndarray, label: np.ndarray, step: int = 1024) -> None:
    """All pairs of x[idx] within RADIUS, block by block."""
    for i in range(0, len(idx), step):
        rows = idx[i:i + step]
        for j in range(i, len(idx), step):
            cols = idx[j:j + step]
            a, b = np.nonzero(np.bitwise_count(x[rows][:, None] ^ x[cols][None, :]) <= RADIUS)
            if len(a):
                _join(label, rows[a], cols[b])


def _look_up(x: np.ndarray, idx: np.ndarray, label: np.ndarray) -> None:
    """As _compare, by looking up every point's neighbours: x[idx] rises, and all neighbours of a
    point that matter differ from it in bits that vary at all."""
    part = x[idx]
    varying = [1 << b for b in range(64) if int(np.bitwise_or.reduce(part ^ part[0])) >> b & 1]
    for mask in (*varying, *(a | b for a, b in itertools.combinations(varying, 2))):
        want = part ^ np.uint64(mask)
        at = np.minimum(np.searchsorted(part, want), len(part) - 1)
        hit = part[at] == want
        if hit.any():
            _join(label, idx[hit], idx[at[hit]])


def _search(x: np.ndarray, idx: np.ndarray, block: int, whole: bool, label: np.ndarray) -> None:
    if len(idx) > LEAF:
        mask, slack = (WHOLE, RADIUS) if whole else (BLOCKS[block], 0)
        cut = _split(x[idx], mask, slack)
        if cut is None and not whole:
            return _search(x, idx, block, True, label)
        if cut:
            d = _distance(x[idx], cut[0], mask)
            _search(x, idx[d <= cut[1] + slack], block, whole, label)
            return _search(x, idx[d > cut[1]], block, whole, label)
    return _compare(x, idx, label) if len(idx) <= DENSE else _look_up(x, idx, label)


def shard_links(points: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars of the clusters that links of at most RADIUS bits make among a shard's points."""
    x = np.unique(points.astype(np.int64)).view(np.uint64)
    label = np.arange(len(x))
    _search(x, np.arange(len(x)), block, False, label)
    far = np.flatnonzero(label != np.arange(len(x)))
    return x[far].view(np.int64), x[label[far]].view(np.int64)


def _shard_id(b: int, leaf: int) -> int:
    return b * (1 << 24) + leaf


def fingerprint_links(points: DataFrame, fp: str = "fp") -> DataFrame:
    """Distinct fingerprints (a staged table) to links (a, b) that connect exactly what pairs
    within RADIUS bits connect."""
    spark = points.sparkSession
    total = points.count()
    if not total:
        return spark.createDataFrame([], "a long, b long")
    # Chosen by hash, so about total / every points, SAMPLE at most but for chance.
    every = max(PER_SAMPLED, -(-total // SAMPLE))
    sample = points.where(F.pmod(F.xxhash64(fp), F.lit(every)) == 0).select(fp).toPandas()
    x = np.sort(sample[fp].to_numpy(np.int64).view(np.uint64))
    x = x[np.argsort(x * np.uint64(0x9E3779B97F4A7C15), kind="stable")]  # mixed, but the same in every run
    trees = [Tree(x, b, max(4, SHARD_POINTS // every)) for b in range(3)]
    shared = spark.sparkContext.broadcast(trees)

    def route(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            v = part["p"].to_numpy(np.int64)
            got = [(_shard_id(b, leaf), idx) for b, tree in enumerate(shared.value) for leaf, idx in (tree.route(v.view(np.uint64)),)]
            yield pd.DataFrame({"shard": np.concatenate([g[0] for g in got]), "p": v[np.concatenate([g[1] for g in got])]})

    def search(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        a, b = shard_links(group["p"].to_numpy(np.int64), int(key[0]) >> 24)
        return pd.DataFrame({"a": a, "b": b})

    tasks = spark.sparkContext.defaultParallelism
    routed = points.select(F.col(fp).alias("p")).repartition(max(tasks, total // 500_000)).mapInPandas(route, "shard long, p long")
    return routed.groupBy("shard").applyInPandas(search, "a long, b long")


def simhash_components(docs: DataFrame, id_col="doc_id", text_col="text", k: int = 3) -> DataFrame:
    """Per row: id, fp (signed 64-bit) and the least id reachable by links."""
    rows = staged(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")), "t", k).drop("t"), "fingerprints", BATCH_ROWS)
    points = staged(rows.groupBy("fp").agg(F.min("id").alias("least")), "points")
    comp = staged(connected_components(fingerprint_links(points), "a", "b"), "components")
    points = points.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    leasts = points.groupBy("root").agg(F.min("least").alias("component"))
    return rows.join(points.select("fp", "root").join(leasts, "root").drop("root"), "fp").select("id", "fp", "component")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    c = simhash_components(docs)
    return c.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
