"""Nearest references by inner product, thresholds, and pooled vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MAX_REFERENCE_ROWS = 200_000


def nearest(queries: DataFrame, refs: DataFrame, k: int = 1, normalise: bool = True, max_rows: int = MAX_REFERENCE_ROWS) -> DataFrame:
    """queries (query_id, vec) x refs (ref_id, label, vec) to (query_id, rank, ref_id, label, sim).

    The reference table is a glyph or word index: it is counted, sent to the tasks, and query
    batches are multiplied with it in blocks.  A table of more than ``max_rows`` goes in several parts,
    by hash of ref_id, and the best of all parts count; equal similarities go to the smaller ref_id.
    """
    parts = -(-refs.count() // max_rows)
    if parts <= 1:
        return _nearest(queries, refs, k, normalise)
    out = None
    for at in range(parts):
        found = _nearest(queries, refs.where(F.pmod(F.xxhash64("ref_id"), F.lit(parts)) == at), k, normalise)
        out = found if out is None else out.unionByName(found)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("sim"), "ref_id"))
    return out.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "ref_id", "label", "sim")


def _nearest(queries: DataFrame, refs: DataFrame, k: int, normalise: bool) -> DataFrame:
    rows = refs.select("ref_id", "label", "vec").collect()  # one part, bounded by the caller
    rows.sort(key=lambda r: r.ref_id)
    schema = "query_id long, rank int, ref_id long, label string, sim double"
    if not rows:
        return queries.sparkSession.createDataFrame([], schema)

    def unit(x: np.ndarray) -> np.ndarray:
        if not normalise:
            return x
        n = np.sqrt((x * x).sum(1, keepdims=True))
        return x / np.where(n > 0, n, 1)

    ids, labels = np.array([r.ref_id for r in rows]), np.array([r.label for r in rows], dtype=object)
    shared = queries.sparkSession.sparkContext.broadcast(unit(np.array([r.vec for r in rows], np.float64)))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, top = shared.value, min(k, len(ids))
        step = max(1, 4_000_000 // len(ids))
        for part in parts:
            for at in range(0, len(part), step):
                p = part.iloc[at:at + step]
                nothing = np.zeros(table.shape[1])  # a null or empty vector is as near to all
                sim = unit(np.stack([nothing if v is None or not len(v) else v for v in p["vec"]]).astype(np.float64)) @ table.T
                order = np.argsort(-sim, axis=1, kind="stable")[:, :top] if top > 1 else sim.argmax(1)[:, None]
                n = len(p)
                yield pd.DataFrame({
                    "query_id": np.repeat(p["query_id"].to_numpy(), top), "rank": np.tile(np.arange(1, top + 1, dtype=np.int32), n),
                    "ref_id": ids[order].ravel(), "label": labels[order].ravel(), "sim": np.take_along_axis(sim, order, 1).ravel()})

    return queries.select("query_id", "vec").mapInPandas(run, schema)


def without_blacklist(refs: DataFrame, labels: list[str]) -> DataFrame:
    return refs.where(~F.col("label").isin(*labels)) if labels else refs


def with_fallback(found: DataFrame, fallback: DataFrame, threshold: float) -> DataFrame:
    """The nearest word where sim > threshold; all others take the fallback's label.  Two branches,
    so that the fallback is only worked out for the rows that need it."""
    sure = found.where(F.col("sim") > threshold).select("query_id", "label", F.lit("word").alias("level"))
    rest = found.where(~(F.col("sim") > threshold)).select("query_id").join(fallback, "query_id", "left").select("query_id", F.coalesce("label", F.lit("")).alias("label"), F.lit("char").alias("level"))
    return sure.unionByName(rest)


def pooled(vectors: DataFrame, key: str, vec: str = "vec", mask: str | None = None, how: str = "mean") -> DataFrame:
    """One vector per key: mean or max by dimension over rows whose mask is set."""
    if mask:
        vectors = vectors.where(F.col(mask))
    each = vectors.select(key, F.posexplode(vec).alias("dim", "x"))
    one = each.groupBy(key, "dim").agg((F.avg if how == "mean" else F.max)(F.col("x").cast("double")).alias("x"))
    return one.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "x"))), lambda p: p["x"]).alias(vec))
