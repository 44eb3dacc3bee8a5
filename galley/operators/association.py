"""Headlines and bylines to articles.

All joins carry the page as an equality key, so they are hash or sort-merge joins with the ranges
as residual predicates, and the best candidate is an aggregate rather than a sort.  Boxes are
rows with page key, id, class, x0, y0, x1, y1; ``pos`` (the place in the page's list) breaks ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import GAP_SHARE, OVERLAP_SHARE, SLACK_SHARE


def with_page_extent(boxes: DataFrame, page: str = "scan_id") -> DataFrame:
    """Adds page_w and page_h as the largest x1 and y1 of the page (where a scan has no size)."""
    w = Window.partitionBy(page)
    return boxes.withColumn("page_w", F.max("x1").over(w)).withColumn("page_h", F.max("y1").over(w))


def _owner(boxes: DataFrame, page: str, max_gap) -> DataFrame:
    """Adds full_article_id: the topmost article of the page that the box stands over (integer products instead of
    quotients, all strict).  A page's articles come as one array of a window, so boxes are shuffled by page only,
    once, and not at all if they lie by page already."""
    pos = "pos" if "pos" in boxes.columns else "id"
    article = F.struct(F.col("y0").alias("y0"), F.col(pos).alias("pos"), F.col("id").alias("id"), F.col("x0").alias("x0"), F.col("x1").alias("x1"))
    every = F.collect_list(F.when(F.col("class") == "article", article)).over(Window.partitionBy(page))

    def fits(a):
        shared = F.least(F.col("x1"), a["x1"]) - F.greatest(F.col("x0"), a["x0"])
        over = (shared * OVERLAP_SHARE > F.col("page_w")) & ((F.col("y1") - a["y0"]) * SLACK_SHARE < F.col("page_h"))
        return over & (~max_gap | ((a["y0"] - F.col("y1")) * GAP_SHARE < F.col("page_h")))

    first = F.array_min(F.filter("__articles", fits))
    return boxes.withColumn("__articles", every).withColumn("full_article_id", F.when(F.col(page).isNotNull(), first["id"] + 1)).drop("__articles")


def associate(boxes: DataFrame, cls: str, page: str = "scan_id", max_gap: bool | None = None) -> DataFrame:
    """(page, id, full_article_id) for every box of class ``cls``: the topmost article that it
    stands over, null for none.  Headlines have a largest gap, bylines none."""
    owned = _owner(boxes, page, F.lit(cls == "headline" if max_gap is None else max_gap))
    return owned.where(F.col("class") == cls).select(page, "id", "full_article_id")


def article_ids(boxes: DataFrame, page: str = "scan_id") -> DataFrame:
    """All articles, headlines and bylines with full_article_id; an article is its own (id + 1)."""
    article, part = F.col("class") == "article", F.col("class").isin("headline", "author")
    owned = _owner(boxes, page, F.col("class") == "headline").where(article | (part & F.col(page).isNotNull() & F.col("id").isNotNull()))
    return owned.withColumn("full_article_id", F.when(article, F.col("id") + 1).otherwise(F.col("full_article_id")))


def above_pictures(boxes: DataFrame, page: str = "scan_id") -> DataFrame:
    """Headlines right above a picture or advertisement (off by default in the pipelines)."""
    pictures = boxes.where(F.col("class").isin("photograph", "cartoon_or_advertisement"))
    return boxes.where(F.col("class") == "headline").join(pictures.select(
        F.col(page).alias("p_page"), F.col("x0").alias("p_x0"), F.col("x1").alias("p_x1"), F.col("y0").alias("p_y0")),
        (F.col(page) == F.col("p_page")) & ((F.least("x1", "p_x1") - F.greatest("x0", "p_x0")) * OVERLAP_SHARE > F.col("page_w"))
        & ((F.col("y1") - F.col("p_y0")) * SLACK_SHARE < F.col("page_h")) & ((F.col("p_y0") - F.col("y1")) * GAP_SHARE < F.col("page_h")), "left_semi")


def _inside(v, lo, hi):
    return (v > lo) & (v < hi)


def interval_matches(boxes: DataFrame, page: str = "scan_id", other: str = "article") -> DataFrame:
    """(page, h_id, k, id): headlines whose padded ends reach into an article (or author) or the
    other way round, ten times the coordinates to stay in integers.  k numbers the headlines."""
    order = Window.partitionBy(page).orderBy("x1", "y1", "id")
    h = boxes.where(F.col("class") == "headline").select(
        page, F.col("id").alias("h_id"), *[F.col(c).alias(f"h_{c}") for c in ("x0", "y0", "x1", "y1")], (F.row_number().over(order) - 1).alias("k"))
    o = boxes.where(F.col("class") == other)
    p, x0, x1 = F.col("x1") - F.col("x0"), F.col("x0") * 10, F.col("x1") * 10
    h0, h1 = F.col("h_x0") * 10, F.col("h_x1") * 10
    across = _inside(h0 + p, x0, x1) | _inside(h1 - p, x0, x1) | _inside(x0 + p, h0, h1) | _inside(x1 - p, h0, h1)
    if other == "article":
        down = F.col("h_y1") <= F.col("y1")
    else:
        d, y0, y1 = F.col("y1") - F.col("y0"), F.col("y0"), F.col("y1")
        down = _inside(F.col("h_y0"), y0, y1) | _inside(F.col("h_y1"), y0, y1) | _inside(F.col("h_y0") - d, y0, y1) | _inside(F.col("h_y1") + d, y0, y1)
    return h.join(o, page).where(across & down).select(page, "h_id", "k", "h_y1", "id", "x1", "y1")


def interval_association(boxes: DataFrame, page: str = "scan_id") -> DataFrame:
    """(page, id, class, k): the article keeps the headline with the lowest bottom; a second-lowest
    headline that only one object holds is pointed to the lowest; authors keep their first."""
    m = interval_matches(boxes, page)
    rank = F.row_number().over(Window.partitionBy(page, "id").orderBy(F.desc("h_y1"), "k"))
    ranked = m.withColumn("r", rank).where("r <= 2").groupBy(page, "id").agg(
        F.max(F.when(F.col("r") == 1, F.col("k"))).alias("k"), F.max(F.when(F.col("r") == 2, F.col("k"))).alias("k2"))
    heads = m.select(page, F.col("h_id").alias("id"), "k").distinct()
    author_k = interval_matches(boxes, page, "author").groupBy(page, "id").agg(F.min("k").alias("k"))
    held = heads.select(page, "k").unionByName(ranked.select(page, "k")).unionByName(author_k.select(page, "k")).groupBy(page, "k").agg(F.count("*").alias("n"))
    moved = ranked.where("k2 IS NOT NULL").join(held.where("n = 1").withColumnRenamed("k", "k2"), [page, "k2"]).groupBy(page, "k2").agg(F.min("k").alias("to"))
    heads = heads.join(moved.withColumnRenamed("k2", "k"), [page, "k"], "left").select(page, "id", F.coalesce("to", "k").alias("k"))
    keys = heads.unionByName(ranked.select(page, "id", "k")).unionByName(author_k)
    return boxes.where(F.col("class").isin("article", "headline", "author")).select(page, "id", "class").join(keys, [page, "id"], "left")
