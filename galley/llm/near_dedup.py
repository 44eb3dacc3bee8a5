"""Near-duplicate removal at a shingle similarity: SimHash links and samples, verified exactly.

At five-word shingles and a Jaccard similarity of 0.8 two 64-bit SimHashes differ by about 10
bits, so the 2-bit links of the vantage-point trees alone find few of these pairs.  Candidates
are therefore texts that share any of: a star of SimHashes within 2 bits (``simhash``), or one of
BANDS keys, each the hash of the ROWS least shingles under a seeded permutation, which agree with
probability J ** ROWS (all BANDS miss a pair at 0.8 once in 400).  Every candidate is verified by
the exact Jaccard similarity of the whole texts' shingle sets.

Before texts are compared, a pair's sketches (two bits of each of SKETCH minima) must differ in at most SKETCH_LIMIT
places: two texts at 0.8 differ in 76.8 on average with a deviation of 8.1, so the limit, five
deviations above, loses less than one such pair in a million, and drops most pairs below 0.7.

A key's members are not paired with each other: its least member leads, all others are verified
against it, and those that fail form the key's next group, which has four times as many leaders, and
so on until none is left.  Leaders are the least in the order in which rows are kept, so a row
that left a group by a match is never kept, and all kept rows that share a key have met: no two of them are
near-duplicates.  Two members that match different leaders don't meet; if no other key joins their leaders' components,
and the leaders themselves are unlike, both leaders stay.  (Comparing all such members as well was tried: in a
group of thousands of near copies it makes pairs as the square of the group.)  A key whose n members are all unlike costs
comparisons of sketches, in the JVM, of the order of n ** 2; only pairs that pass are rows.

Equal texts (after lower-casing A-Z and collapsing blanks) are collapsed first.  Of each group the
row with the least id stays (null ids last); rows that repeat id and text count as one.  Null
and blank texts are equal to each other.  Very long texts are read whole.  An empty table stays empty;
other columns are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.components import connected_components
from .simhash import _UPPER, fingerprint, fingerprint_links, shingle_hashes
from .staging import fresh, key_of, small_side, staged
from .worker import forget

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 20, 6
DESCRIBE_ROWS, VERIFY_ROWS = 1000, 250  # rows of an Arrow batch with texts
SKETCH, SKETCH_LIMIT = 512, 117
_PAIRS = 0x5555555555555555
_SKETCH_ODD = np.random.default_rng(12).integers(1, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = np.random.default_rng(11).integers(1, 1 << 63, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sample_keys(hashes: np.ndarray) -> list[int]:
    """BANDS keys from the ROWS least distinct shingles under each permutation."""
    h = np.unique(hashes)
    if not len(h):
        return []
    out = []
    wide = len(h) <= 50_000
    table = h[None, :] * _ODD[:, None] if wide else None
    for b in range(0, BANDS, BANDS if wide else 1):
        part = table if wide else h[None, :] * _ODD[b:b + 1, None]
        least = np.sort(np.partition(part, ROWS - 1, axis=1)[:, :ROWS] if len(h) > ROWS else part, axis=1)
        out += [xxhash.xxh64_intdigest(row.tobytes(), b + i) for i, row in enumerate(least)]
    return np.array(out, np.uint64).view(np.int64).tolist()


def sketch(hashes: np.ndarray) -> list[int]:
    """Two bits of the least shingle under each of SKETCH permutations, 32 to a number."""
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        np.minimum(least, (hashes[None, at:at + 512] * _SKETCH_ODD[:, None]).min(1), out=least)
    bits = (least >> np.uint64(20)).astype(np.uint8)
    return np.packbits(np.stack([bits & 1, bits >> 1 & 1], 1).ravel(), bitorder="little").view(np.int64).tolist()


def places_apart(a, b) -> object:
    """In how many places two sketches differ."""
    x = [F.col(a)[i].bitwiseXOR(F.col(b)[i]) for i in range(SKETCH // 32)]
    return sum((F.bit_count(v.bitwiseOR(F.shiftrightunsigned(v, 1)).bitwiseAND(F.lit(_PAIRS))) for v in x), F.lit(0))


def described(rows: DataFrame, shingle: int) -> DataFrame:
    """(k, id, t) to (k, id, same, fp, keys, sketch)."""
    @F.pandas_udf("same string, fp long, keys array<long>, sketch array<long>")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        forget()
        for s in texts:
            out = []
            for t in s:
                line = b" ".join((t or "").encode().translate(_UPPER).split())
                h = shingle_hashes(t, shingle)
                out.append((xxhash.xxh128_hexdigest(line), fingerprint(h), sample_keys(h), sketch(h)))
            yield pd.DataFrame(out, columns=["same", "fp", "keys", "sketch"])

    return rows.withColumn("d", of(F.col("t"))).select("k", "id", "d.same", "d.fp", "d.keys", "d.sketch")


def jaccard(a: str | None, b: str | None, shingle: int) -> float:
    x, y = (np.unique(shingle_hashes(t, shingle)) for t in (a, b))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """(a, b) pairs of nodes to (a, b, ok)."""
    @F.pandas_udf("boolean")
    def alike(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([jaccard(a, b, shingle) >= similarity for a, b in zip(x, y)], dtype=bool)

    t = lambda n: texts.select(F.col("node").alias(n), F.col("t").alias(f"t{n}"))
    return pairs.join(t("a"), "a").join(t("b"), "b").select("a", "b", alike("ta", "tb").alias("ok"))


def similar_links(groups: DataFrame, texts: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Staged (key, node, first, sketch) memberships to verified links (a, b).  Round r has 4 ** r
    leaders per key, the least by ``first``."""
    links, leaders = None, 1
    while True:
        rank = F.row_number().over(Window.partitionBy("key").orderBy("first"))
        lead = groups.withColumn("r", rank).where(F.col("r") <= leaders)
        lead = staged(lead.select("key", F.col("node").alias("a"), F.col("first").alias("lead_first"), F.col("sketch").alias("lead_sketch")), "leaders")
        rest = groups.join(lead, "key").where((F.col("first") > F.col("lead_first")) & (places_apart("sketch", "lead_sketch") <= SKETCH_LIMIT))
        rest = staged(rest.select("key", "a", F.col("node").alias("b")), "rest")
        done = staged(verified(rest.select("a", "b").distinct(), texts, shingle, similarity), "verified", VERIFY_ROWS)
        good = done.where("ok").select("a", "b")
        links = good if links is None else links.unionByName(good)
        led = lead.select("key", F.col("a").alias("node")).unionByName(rest.join(good, ["a", "b"]).select("key", F.col("b").alias("node")))
        groups = staged(groups.join(led.distinct(), ["key", "node"], "left_anti"), "groups")
        if groups.isEmpty():
            return links
        leaders *= 4


def row_key(id_col: str, text_col: str) -> object:
    return F.md5(F.concat_ws("|", key_of(F.col(id_col)), key_of(F.col(text_col))).cast("binary"))


def near_dedup(docs: DataFrame, id_col="doc_id", text_col="text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates; all columns stay."""
    k = row_key(id_col, text_col)
    rows = staged(described(docs.select(k.alias("k"), F.col(id_col).alias("id"), F.col(text_col).alias("t")), shingle), "described", DESCRIBE_ROWS)
    repeats = not rows.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").isEmpty()  # rows with one id and text
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("k")))
    points = rows.groupBy("same").agg(first.alias("first"), F.any_value("fp").alias("fp"), F.any_value("keys").alias("keys"), F.any_value("sketch").alias("sketch"))
    points = staged(points.select("first", "fp", "keys", "sketch", F.monotonically_increasing_id().alias("node")), "points")
    fps = staged(points.select("fp").distinct(), "fps")
    # A pair within 2 bits lies in one shard's star; the star's centre is its key, so no components are needed here.
    stars = staged(fingerprint_links(fps), "stars")
    centre = stars.select(F.col("a").alias("fp"), F.col("b").alias("centre")).unionByName(stars.select(F.col("b").alias("fp"), F.col("b").alias("centre"))).distinct()
    roots = points.select("fp", "node").join(centre.unionByName(fps.select("fp", F.col("fp").alias("centre"))).distinct(), "fp")
    roots = roots.select(F.xxhash64(F.lit("fp"), "centre").alias("key"), "node")
    groups = roots.unionByName(points.select(F.explode("keys").alias("key"), "node"))
    shared = groups.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    groups = groups.join(shared, "key").distinct()
    groups = staged(groups.join(points.select("node", "first", "sketch"), "node"), "groups")
    wanted = points.join(groups.select("node").distinct(), "node").select("node", F.col("first.k").alias("k"))
    texts = docs.select(k.alias("k"), F.col(text_col).alias("t")).join(small_side(staged(wanted, "wanted")), "k")
    texts = staged(texts.dropDuplicates(["node"]) if repeats else texts, "texts").select("node", "t")
    found = connected_components(similar_links(groups, texts, shingle, similarity), "a", "b")
    keepers = points.select("node", "first").join(found, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("first").alias("first"))
    name = fresh(docs, "__k")
    gone = staged(rows.select("k").join(keepers.select("first.k"), "k", "left_anti").distinct().withColumnRenamed("k", name), "gone")
    kept = docs.withColumn(name, k).join(small_side(gone), name, "left_anti")
    return (kept.dropDuplicates([name]) if repeats else kept).drop(name)
