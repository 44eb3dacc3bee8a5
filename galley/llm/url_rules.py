r"""URL filters: given host-and-path rules, and association rules mined from URL tokens.

A URL is split into host and path and judged by the longest given rule that fits; these verdicts
are the labels.  Spark's FP-growth mines combinations of URL tokens (host labels with their place
from the right, path words) together with the label items; rules whose consequent is a label are
pruned by support, confidence and lift over the label's base rate.  A URL without a given rule takes the verdict of the most
confident mined rule whose tokens it has, found through an inverted index from each rule's rarest
token, and is allowed if none matches.

Rules of any length count.  Tokens that occur in exactly the same labelled URLs (a site's fixed parts) are one
item of the mining, since any of them alone makes the same rule: their subsets, which would
grow as a power of two, are never enumerated, and no verdict changes.

Distinct URLs are judged, then joined back, so copies of one URL cost nothing more.  The number
of mined rules is counted before they are broadcast; beyond the bound the index join shuffles.

Cases: a null URL or one without ``://`` has empty host and path, no tokens and is allowed; ports
and user names stay part of the host as given; repeated rows are judged alike; of rules that fit, the highest
confidence wins, then support, then blocking; very long URLs are read whole; no labelled URL
gives no mined rules; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import small_side, staged

RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.7
LABELS = ("verdict=allow", "verdict=block")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url) -> object:
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, _UPPER, _LOWER), F.lit(""))


def path_of(url) -> object:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host, path, rules=RULES) -> object:
    """Struct (text, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<text:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tried first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("text"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens_of(host, path) -> object:
    """Distinct tokens: host labels (top two with their place), path words without digits."""
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    placed = F.transform(F.reverse(labels), lambda x, i: F.concat(F.when(i < 2, F.concat(F.lit("h"), i.cast("string"), F.lit(":"))).otherwise(F.lit("h:")), x))
    words = F.filter(F.split(F.lower(path), r"[^\p{L}]+"), lambda x: x != "")
    return F.array_sort(F.array_distinct(F.concat(placed, F.transform(words, lambda x: F.concat(F.lit("p:"), x)))))


def item_names(labelled: DataFrame, min_support: float) -> DataFrame:
    """(items) rows to staged (token, item) for tokens with enough support; tokens of the same rows
    share an item (equal counts and equal sums of row hashes)."""
    least = math.ceil(min_support * labelled.count())
    rows = F.sum(F.xxhash64("items").cast("decimal(38,0)"))
    often = labelled.select("items", F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("freq"), rows.alias("rows"))
    often = staged(often.where(F.col("freq") >= least), "frequent_tokens")
    names = often.groupBy("freq", "rows").agg(F.min("token").alias("item"))
    return staged(often.join(names, ["freq", "rows"]).select("token", "item", "freq"), "items")


def mined_rules(labelled: DataFrame, names: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(items, verdict) rows to staged rules: rule_items, size, verdict, confidence, support, index_item."""
    spark = labelled.sparkSession
    if labelled.isEmpty():
        return spark.createDataFrame([], "rule_items array<string>, size int, verdict string, confidence double, support double, index_item string")
    items = labelled.select(F.array_append("items", F.concat(F.lit("verdict="), F.col("verdict"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    found = model.associationRules.where(F.col("consequent")[0].isin(*LABELS))
    found = found.where(~F.exists("antecedent", lambda x: x.isin(*LABELS)) & (F.col("lift") > 1))
    found = staged(found.select(F.array_sort("antecedent").alias("rule_items"), F.regexp_replace(F.col("consequent")[0], "^verdict=", "").alias("verdict"), "confidence", "support"), "mined")
    often = names.groupBy("item").agg(F.max("freq").alias("freq"))
    each = found.select("*", F.explode("rule_items").alias("item")).join(often, "item")
    index = each.groupBy("rule_items", "verdict").agg(
        F.min_by("item", F.struct("freq", "item")).alias("index_item"), F.max("confidence").alias("confidence"), F.max("support").alias("support"))
    return staged(index.select("rule_items", F.size("rule_items").alias("size"), "verdict", "confidence", "support", "index_item"), "rules")


def judge(pages: DataFrame, id_col="page_id", url_col="url", rules=RULES, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict per row; source tells given, mined and default verdicts apart."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    urls = pages.select(F.col(url_col).cast("string").alias("url")).where("url IS NOT NULL").distinct()
    urls = urls.select("url", host.alias("host"), path.alias("path"))
    urls = urls.withColumn("given", given_rule(F.col("host"), F.col("path"), rules)).withColumn("items", tokens_of(F.col("host"), F.col("path")))
    urls = staged(urls.select("url", "items", F.col("given.verdict").alias("verdict")), "urls")
    names = item_names(urls.where("verdict IS NOT NULL").select("items"), min_support)
    coded = urls.select("url", F.explode("items").alias("token")).join(small_side(names.select("token", "item")), "token")
    coded = coded.groupBy("url").agg(F.collect_set("item").alias("items"))  # a URL's own tokens
    coded = staged(urls.drop("items").join(coded, "url", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>"))), "coded")
    mined = mined_rules(coded.where("verdict IS NOT NULL").select("items", "verdict"), names, min_support, min_confidence)
    open_ = coded.where("verdict IS NULL").select("url", "items", F.explode("items").alias("index_item"))
    hit = open_.join(small_side(mined.withColumnRenamed("verdict", "v")), "index_item")
    hit = hit.where(F.size(F.array_intersect("items", "rule_items")) == F.col("size"))
    # The most confident rule wins; then support, then blocking.
    best = hit.groupBy("url").agg(F.max(F.struct("confidence", "support", "v"))["v"].alias("learned"))
    best = small_side(staged(best, "verdicts"))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.withColumn("host", F.when(F.col("url").isNull(), "").otherwise(host)).withColumn("path", F.when(F.col("url").isNull(), "").otherwise(path))
    rows = rows.withColumn("given", given_rule(F.col("host"), F.col("path"), rules)).join(best, "url", "left")
    return rows.select("page_id", "host", "path", F.col("given.text").alias("rule"),
                       F.coalesce("given.verdict", "learned", F.lit("allow")).alias("verdict"),
                       F.when(F.col("given").isNotNull(), "given").when(F.col("learned").isNotNull(), "mined").otherwise("default").alias("source"))
