"""Mixing sources to target weights.

Tokens are summed per source, the weighted targets are water-filled under a repetition cap, and
each document is emitted floor(rate) times plus one hash-seeded Bernoulli copy whose probability
is the fraction of the rate.

Cases: a null or empty text has size 0 and still gets its copies (taking no words); a null source
is a source of its own, last in order; a source without words has target 0 and rate 1, so its
documents pass once; rows that repeat id and source share one coin; a table without words gives
targets 0; an empty table gives no rows; very long texts are counted whole.  Extra columns are carried by ``mix``, whatever
their names; the report does not read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.windows import numbered
from .staging import fresh, key_of, small_side, staged, unit_hash

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = 17


def word_count(text) -> object:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(by_source: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(key, source, source_size) to the same with target.

    Weights follow from the sources' global places, which come from range partitions.  Then, as the
    rule says, what the sources that are above their caps leave over is shared again by weight until none is above: each
    round is one aggregate over the table of sources.  All sums are integers; a target takes one division.
    """
    places = numbered(by_source.withColumn("none", F.col("source").isNull()), ["none", "source"], "place")
    w = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    t = staged(places.select("key", "source", "source_size", w.alias("w"), (F.col("source_size") * max_repeat).alias("cap")), "weights")
    dec = lambda c: F.col(c).cast("decimal(38,0)")  # noqa: E731  sums and products may pass 2**63
    total, rest, wrest = t.agg(F.sum(dec("source_size")), F.sum(dec("source_size")), F.sum(dec("w"))).first()
    capped = F.lit(False)
    while wrest:
        capped = dec("cap") * F.lit(wrest) < dec("w") * F.lit(rest)
        spent, left = t.agg(F.sum(F.when(capped, dec("cap")).otherwise(0)), F.sum(F.when(capped, 0).otherwise(dec("w")))).first()
        if (total - spent, left) == (rest, wrest):
            break
        rest, wrest = total - spent, left
    share = F.try_divide(F.col("w").cast("double") * F.lit(float(rest or 0)), F.lit(float(wrest or 0)))
    return t.select("key", "source", "source_size", F.when(capped, F.col("cap").cast("double")).otherwise(share).alias("target"))


def rates(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(key, source, size) rows to one staged row per source: source_size, target, rate."""
    by_source = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(1.0))
    return staged(targets(by_source, weights, max_repeat).withColumn("rate", rate), "rates")


def copies(rate, seed: int, *ids) -> object:
    coin = unit_hash(seed, *ids).cast("double") / float(1 << 52)
    return (F.floor(rate) + (coin < rate - F.floor(rate)).cast("long")).cast("long")


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source",
        weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """``docs`` with every row as often as the mix takes it (zero times or more)."""
    sizes = docs.select(key_of(F.col(source_col)).alias("key"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    key, rate, copy = (fresh(docs, c) for c in ("__key", "__rate", "__copy"))
    r = rates(sizes, weights, max_repeat).select(F.col("key").alias(key), F.col("rate").alias(rate))
    out = docs.withColumn(key, key_of(F.col(source_col))).join(small_side(r), key)
    n = copies(F.col(rate), seed, F.col(id_col), F.col(source_col))
    return out.withColumn(copy, F.explode(F.array_repeat(F.lit(1), n.cast("int")))).drop(key, rate, copy)


def mixture_report(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """Per document its size, its source's size and target, and the words that the mix takes."""
    narrow = staged(docs.select(F.col("doc_id"), key_of(F.col("source")).alias("key"), F.col("source"), word_count(F.col("text")).alias("size")), "sizes")
    r = rates(narrow, weights, max_repeat).drop("source")
    n = copies(F.col("rate"), seed, F.col("doc_id"), F.col("source"))
    return narrow.join(small_side(r), "key").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * n).alias("taken"), n.alias("copies"))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::HUGEINT AS w,
             3 * source_size AS cap FROM s),
p AS (SELECT *, sum(source_size) OVER ()::HUGEINT AS total, sum(w) OVER ()::HUGEINT AS wtotal,
             coalesce(sum(cap) OVER b, 0)::HUGEINT AS cap_before, coalesce(sum(w) OVER b, 0)::HUGEINT AS w_before
      FROM w WINDOW b AS (ORDER BY cap * 10 // w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap * (wtotal - w_before) < w * (total - cap_before) AS capped FROM p),
r AS (SELECT *, total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS rest,
             wtotal - sum(CASE WHEN capped THEN w ELSE 0 END) OVER () AS wrest FROM c),
t AS (SELECT source, source_size,
             CASE WHEN capped THEN cap::DOUBLE ELSE w::DOUBLE * rest::DOUBLE / wrest::DOUBLE END AS target FROM r),
u AS (SELECT *, CASE WHEN source_size = 0 THEN 1.0::DOUBLE ELSE target / source_size::DOUBLE END AS rate FROM t),
j AS (SELECT d.doc_id, d.size, u.source_size, u.target, u.rate,
             ('0x' || substr(md5('17|' || coalesce('v' || d.doc_id::VARCHAR, 'n') || '|' || coalesce('v' || d.source, 'n')), 1, 13))::BIGINT::DOUBLE
               / 4503599627370496.0::DOUBLE AS coin
      FROM d JOIN u ON d.source IS NOT DISTINCT FROM u.source)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (floor(rate)::BIGINT + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken,
       (floor(rate)::BIGINT + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM j
"""
