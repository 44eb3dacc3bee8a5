"""Sharding by proportional stratified interleaving.

Rows are ranked in a seeded shuffle within their source, put in order of their fractional rank
(rank + 1/2) / rows of the source, and cut into shards of equal row counts, so every run of the
order, and so every shard, has the sources in their proportions.  The law is ``rows``.

The shuffle is one of texts: its hash is that of the text, then that of the id.  Equal texts of a
source are neighbours in it, and those of different sources have about the same fractional rank,
so a group of equal texts lies in one shard unless a cut goes through it.  The law comes first: a
group that is larger than a shard, or lies on a cut, is parted.

Ranks come from hash buckets: a source's rows fall in buckets by the leading bits of the shuffle
hash, a bucket's offset is the count of rows in earlier buckets, and only the rows of a bucket
are sorted together.  A bucket of more than HOT_ROWS rows (many copies of one text) is parted by more bits, the
id's among them.  No task sees a whole source or a whole group, however large.

Cases: null texts have no bytes and equal empty ones; a null source is a stratum; rows that tie in hash are
ordered by id, size and checksum, and repeated rows are interchangeable, each with a slot of its own; very
long texts are hashed whole; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .staging import key_of, small_side, staged, unit_hash

SEED = 29
ROWS_PER_BUCKET = 20_000
HOT_ROWS = 4 * ROWS_PER_BUCKET
HASH_BITS, FINE_BITS = 52, 36  # a hash has 26 bits of the text, then 26 of the id


def bucket_count(rows: int, least: int = 256, most: int = 65_536) -> int:
    """Buckets, a power of two, for about ROWS_PER_BUCKET rows each."""
    n = least
    while n < most and n * ROWS_PER_BUCKET < rows:
        n *= 2
    return n


def interleave(rows: DataFrame, shards: int, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``rows`` must be a staged table with __key (stratum) and __h (52-bit shuffle hash) and
    tie-breaking columns; adds shard and slot."""
    ties = [c for c in rows.columns if not c.startswith("__")]
    total = rows.count()
    buckets = bucket_count(total)
    bits = buckets.bit_length() - 1
    rows = rows.withColumn("__b", F.shiftright("__h", HASH_BITS - bits))
    counts = staged(rows.groupBy("__key", "__b").agg(F.count("*").alias("__c")), "bucket_counts")
    by_key = staged(counts.groupBy("__key").agg(F.sum("__c").alias("__n")), "strata")
    hot = staged(counts.where(F.col("__c") > hot_rows).select("__key", "__b", F.lit(True).alias("__hot")), "hot_buckets")
    if hot.isEmpty():
        rows, counts = rows.withColumn("__f", F.lit(0).cast("long")), counts.withColumn("__f", F.lit(0).cast("long"))
    else:
        fine = F.when(F.col("__hot"), F.shiftright("__h", HASH_BITS - FINE_BITS)).otherwise(0).cast("long")
        rows = rows.join(small_side(hot), ["__key", "__b"], "left").withColumn("__f", fine).drop("__hot")
        counts = rows.groupBy("__key", "__b", "__f").agg(F.count("*").alias("__c"))
    earlier = Window.partitionBy("__key").orderBy("__b", "__f").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(counts.select("__key", "__b", "__f", F.coalesce(F.sum("__c").over(earlier), F.lit(0)).alias("__o")), "offsets")
    within = Window.partitionBy("__key", "__b", "__f").orderBy("__h", *ties)
    rows = rows.withColumn("__i", F.row_number().over(within) - 1)
    rows = rows.join(small_side(offsets), ["__key", "__b", "__f"]).join(small_side(by_key), "__key")
    # The bucket of a fractional rank, in integers.
    rows = rows.withColumn("__r", F.col("__o") + F.col("__i")).withColumn("__g", F.expr(f"((2 * __r + 1) * {buckets}L) div (2 * __n)"))
    rows = staged(rows.select(*ties, "__key", "__r", "__n", "__g"), "ranks")
    before = Window.orderBy("__g").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    starts = rows.groupBy("__g").agg(F.count("*").alias("__c"))
    starts = staged(starts.select("__g", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__s")), "starts")
    along = Window.partitionBy("__g").orderBy(F.expr("CAST(2 * __r + 1 AS DOUBLE) / CAST(2 * __n AS DOUBLE)"), "__key")
    rows = rows.withColumn("__j", F.row_number().over(along) - 1).join(small_side(starts), "__g")
    rows = rows.withColumn("__p", F.col("__s") + F.col("__j"))
    return rows.select(
        *ties,
        F.expr(f"CAST((__p * {shards}L) div {max(total, 1)}L AS INT)").alias("shard"),
        F.expr(f"__p - (((__p * {shards}L) div {max(total, 1)}L) * {total}L + {shards - 1}L) div {shards}L").alias("slot"),
    )


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = SEED, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per document: size, text_crc32, law, shard, slot, grown_shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    data = text.cast("binary")
    half = HASH_BITS // 2
    top = lambda h: F.shiftright(h, half)
    rows = staged(docs.select(
        "doc_id",
        (F.octet_length(data).cast("long") + 1).alias("size"),
        F.crc32(data).alias("text_crc32"),
        key_of(F.col("source")).alias("__key"),
        F.shiftleft(top(unit_hash(seed, text)), half).bitwiseOR(top(unit_hash(seed, F.col("doc_id")))).alias("__h"),
    ), "rows")
    return interleave(rows, shards, hot_rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
