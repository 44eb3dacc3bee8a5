"""Reading order of boxes: greedy columns or rows, and headlines before them.

Only the greedy grouping around a seed depends on earlier choices; it runs in Arrow batches of
many pages.  Everything else is a window.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import COLUMN_MARGIN, ROW_MARGIN


def greedy_order(x0: list, y0: list, size: list, margin: float) -> list[int]:
    """Places 0..n-1.  In order of x0 the first unplaced box is a seed; its column is every unplaced
    box whose x0 is within margin * the smaller width of the seed's; a column goes by y0."""
    todo = sorted(range(len(x0)), key=lambda i: x0[i])
    place, at = [0] * len(x0), 0
    while todo:
        s = todo[0]
        column = [i for i in todo if i == s or abs(x0[s] - x0[i]) < margin * min(size[s], size[i])]
        for i in sorted(column, key=lambda i: y0[i]):
            place[i], at = at, at + 1
        taken = set(column)
        todo = [i for i in todo if i not in taken]
    return place


def _order(boxes: DataFrame, keys: list[str], margin: float, rows: bool, legacy_width: bool) -> DataFrame:
    @F.pandas_udf("array<int>")
    def places(a: pd.Series, b: pd.Series, size: pd.Series) -> pd.Series:
        return pd.Series([greedy_order(x.tolist(), y.tolist(), s.tolist(), margin) for x, y, s in zip(a, b, size)])

    pos = "pos" if "pos" in boxes.columns else "id"
    a, b, size = ("y0", "x0", F.col("y1") - F.col("y0")) if rows else ("x0", "y0", F.col("y1" if legacy_width else "x1") - F.col("x0"))
    # One row per page and article: its boxes as arrays, so that an Arrow batch has many pages.
    box = F.struct(F.col(pos).alias("p"), "id", F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"), size.cast("double").alias("s"))
    g = boxes.groupBy(*keys).agg(F.sort_array(F.collect_list(box)).alias("g"))
    g = g.withColumn("o", places("g.a", "g.b", "g.s"))
    return g.select(*keys, F.explode(F.arrays_zip(F.col("g.id").alias("id"), F.col("o").alias("o"))).alias("z")).select(*keys, "z.id", F.col("z.o").alias("reading_order_id"))


def column_order(boxes: DataFrame, keys=("scan_id",), margin: float = COLUMN_MARGIN, legacy_width: bool = False) -> DataFrame:
    """(keys, id, reading_order_id), column by column."""
    return _order(boxes, list(keys), margin, False, legacy_width)


def row_order(boxes: DataFrame, keys=("scan_id",), margin: float = ROW_MARGIN) -> DataFrame:
    """(keys, id, reading_order_id), row by row, over all classes."""
    return _order(boxes, list(keys), margin, True, False)


def with_lead_order(boxes: DataFrame, keys=("scan_id",), classes=("headline", "author")) -> DataFrame:
    """Adds reading_order_id to headlines and bylines of an article: by y0, numbered -n..-1; null for all others."""
    pos = "pos" if "pos" in boxes.columns else "id"
    lead = F.coalesce(F.col("class").isin(*classes), F.lit(False))
    group = Window.partitionBy(*keys, lead)
    order = F.row_number().over(group.orderBy("y0", pos)) - 1 - F.count("*").over(group)
    return boxes.withColumn("reading_order_id", F.when(lead, order.cast("int")))


def lead_order(boxes: DataFrame, keys=("scan_id",), classes=("headline", "author")) -> DataFrame:
    """(keys, id, reading_order_id) of headlines and bylines of an article."""
    return with_lead_order(boxes.where(F.col("class").isin(*classes)), keys, classes).select(*keys, "id", "reading_order_id")


def reading_order(boxes: DataFrame, page: str = "scan_id", margin: float = COLUMN_MARGIN) -> DataFrame:
    """Boxes that belong to an article, with reading_order_id; all others are left out."""
    keys = [page, "full_article_id"]
    own = boxes.where("full_article_id IS NOT NULL")
    ids = column_order(own.where(F.col("class") == "article"), keys, margin).unionByName(lead_order(own, keys))
    return own.join(ids, [*keys, "id"])
