"""Evaluation of associations and texts, cluster edges, and annotation audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_quotes, edit_share
from ..schemas import RELABEL_TOLERANCE
from .components import connected_components


def edges_of_clusters(members: DataFrame, keys: list[str], item: str) -> DataFrame:
    """(keys, a, b) with a < b: all pairs of a cluster.  Clusters are the boxes of one article."""
    m = members.select(*keys, F.col(item).alias("a")).distinct()
    return m.join(m.withColumnRenamed("a", "b"), keys).where("a < b")


def clusters_of_edges(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node on an edge."""
    found = connected_components(edges, a, b)
    return found.unionByName(found.select(F.col("root").alias("node"), "root").distinct())


def undirected(edges: DataFrame, keys: list[str], a: str = "a", b: str = "b") -> DataFrame:
    return edges.select(*keys, F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct()


def edge_scores(predicted: DataFrame, gold: DataFrame, keys: list[str], digits: int = 1) -> DataFrame:
    """tp, fp, fn, precision, recall and f1 in percent over undirected edges; pages without gold
    edges are left out of the predictions."""
    gold = undirected(gold, keys)
    predicted = undirected(predicted, keys).join(gold.select(*keys).distinct(), keys, "left_semi")
    on = [*keys, "a", "b"]
    one = lambda df, c: df.agg(F.count("*").alias(c))
    t = one(predicted.join(gold, on, "left_semi"), "tp").crossJoin(one(predicted.join(gold, on, "left_anti"), "fp")).crossJoin(one(gold.join(predicted, on, "left_anti"), "fn"))
    p = F.try_divide(100.0 * F.col("tp"), (F.col("tp") + F.col("fp")).cast("double"))
    r = F.try_divide(100.0 * F.col("tp"), (F.col("tp") + F.col("fn")).cast("double"))
    return t.select("tp", "fp", "fn", F.round(p, digits).alias("precision"), F.round(r, digits).alias("recall"), F.round(F.try_divide(2 * p * r, p + r), digits).alias("f1"))


def text_scores(pairs: DataFrame, gold: str = "gold", pred: str = "pred", spaces: bool = True, cased: bool = True, normalised: bool = False) -> DataFrame:
    """n, accuracy (percent of equal texts) and cer: summed edit distances over the summed length of
    the gold texts as given, or the mean of distance over the longer text."""
    def clean(c):
        c = F.trim(clean_quotes(F.col(c)))
        c = c if spaces else F.replace(c, F.lit(" "), F.lit(""))
        return c if cased else F.lower(c)

    p = pairs.select(F.length(gold).alias("raw"), clean(gold).alias("g"), clean(pred).alias("p"))
    cer = F.avg(edit_share(F.col("g"), F.col("p"))) if normalised else F.try_divide(F.sum(F.levenshtein("g", "p")).cast("double"), F.sum("raw").cast("double"))
    return p.agg(F.count("*").alias("n"), F.try_divide(F.count(F.when(F.col("g") == F.col("p"), 1)) * 100.0, F.count("*").cast("double")).alias("accuracy"), cer.alias("cer"))


def labels_on_several(rows: DataFrame, label: str, image: str) -> DataFrame:
    """Labels that occur on more than one image, with the number of images."""
    return rows.groupBy(label).agg(F.count_distinct(image).alias("images")).where("images > 1")


def multi_box_articles(boxes: DataFrame, keys: list[str]) -> DataFrame:
    return boxes.where(F.col("class") == "article").groupBy(*keys).agg(F.count("*").alias("boxes")).where("boxes > 1")


def unflipped_lines(new: DataFrame, old: DataFrame, file: str = "file", tolerance: float = RELABEL_TOLERANCE) -> DataFrame:
    """Lines (c, x, y, w, h) whose box an old line has, within the tolerance, but not with the other
    class, or that no old line has."""
    o = old.select(F.col(file).alias("o_file"), *[F.col(k).alias(f"o_{k}") for k in "cxywh"])
    same = F.col(file) == F.col("o_file")
    for k in "xywh":
        same &= F.abs(F.col(k) - F.col(f"o_{k}")) < tolerance
    return new.join(o, same & (F.col("c") == 1 - F.col("o_c")), "left_anti")


def singletons(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n = 1")
