"""Runs, chunks, surrogate ids and ordered limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import pad_left
from ..schemas import INDEX_CHUNK, MANIFEST_CHUNK
from .staging import small_side, staged


def ranged(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows in ranges of ``order`` with __p (the range) and __m (rising within it), staged: the ranges
    are sampled, so they must be fixed before anything is counted."""
    part = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(part.withColumn("__p", F.spark_partition_id()).withColumn("__m", F.monotonically_increasing_id()), "ranged")


def numbered(rows: DataFrame, order: list[str], out: str = "idx", partition_by: list[str] | None = None) -> DataFrame:
    """Index from 0 in ``order``, in each group or over all rows.

    Without groups no global window is used: rows are range-partitioned once, sorted and written,
    and each partition's offset comes from the counts of those before it.
    """
    if partition_by:
        return rows.withColumn(out, F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order)) - 1)
    part = ranged(rows, order)
    counts = part.groupBy("__p").agg(F.count("*").alias("__n"), F.min("__m").alias("__f"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = staged(counts.select("__p", "__f", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__o")), "offsets")
    return part.join(small_side(offsets), "__p").withColumn(out, F.col("__o") + F.col("__m") - F.col("__f")).drop("__p", "__m", "__o", "__f")


def chunked(rows: DataFrame, order: list[str], size: int = MANIFEST_CHUNK, partition_by: list[str] | None = None) -> DataFrame:
    """Adds ``idx`` and ``chunk``: files of ``size`` rows, the last one short."""
    return numbered(rows, order, "idx", partition_by).withColumn("chunk", F.expr(f"idx div {size}"))


def chunk_index(rows: DataFrame, group: list[str], order: list[str], size: int = INDEX_CHUNK) -> DataFrame:
    """(group, chunk, start, end): index ranges, the end exclusive."""
    return chunked(rows, order, size, group).groupBy(*group, "chunk").agg(F.min("idx").alias("start"), (F.max("idx") + 1).alias("end"))


def first_n(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in a stated order (no bare limit)."""
    return rows.orderBy(*order).limit(n)


def run_positions(rows: DataFrame, key: str, order: list[str], partition_by: list[str]) -> DataFrame:
    """Adds ``run`` and ``run_pos`` (from 1) for consecutive rows with equal ``key``, and ``page``,
    the position with two digits at least."""
    w = Window.partitionBy(*partition_by).orderBy(*order)
    new = (~F.col(key).eqNullSafe(F.lag(key).over(w)) | (F.row_number().over(w) == 1)).cast("int")
    out = rows.withColumn("__new", new).withColumn("run", F.sum("__new").over(w))
    pos = F.row_number().over(Window.partitionBy(*partition_by, "run").orderBy(*order))
    return out.withColumn("run_pos", pos).withColumn("page", pad_left(pos.cast("string"), 2)).drop("__new")


def up_to_total(rows: DataFrame, order: list[str], amount: str, limit: int) -> DataFrame:
    """Rows in order until their amounts (null counts 0, none below 0) reach the limit, the one that
    reaches it included.  Only ranges that begin below the limit are summed row by row."""
    part = ranged(rows, order)
    sums = part.groupBy("__p").agg(F.sum(amount).alias("__a"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = staged(sums.select("__p", F.coalesce(F.sum("__a").over(before), F.lit(0)).alias("__o")).where(F.col("__o") < limit), "offsets")
    within = Window.partitionBy("__p").orderBy("__m").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("__o") + F.coalesce(F.sum(amount).over(within), F.lit(0))
    return part.join(small_side(starts), "__p").withColumn("__before", at).where(F.col("__before") < limit).drop("__p", "__m", "__o", "__before")
