"""Full articles from ordered boxes, and the scan document around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import union
from ..functions.text import words
from ..schemas import MIN_ARTICLE_TOKENS


def _texts(cls: str, sep: str) -> Column:
    part = F.filter("parts", lambda p: p["class"] == cls)
    return F.array_join(F.transform(part, lambda p: p["raw_text"]), sep)


def assemble(boxes: DataFrame, page: str = "scan_id", sep: str = "\n\n", name: str | None = None) -> DataFrame:
    """One row per page and full_article_id: object_ids, headline, article, byline, bbox_list, bbox, id.
    Parts go by reading order; articles whose text is blank without newlines are left out."""
    part = F.struct("reading_order_id", "id", "class", F.coalesce("raw_text", F.lit("")).alias("raw_text"), F.struct("x0", "y0", "x1", "y1").alias("box"))
    g = boxes.groupBy(page, "full_article_id").agg(F.sort_array(F.collect_list(part)).alias("parts"), *union())
    return g.select(
        page, "full_article_id", F.transform("parts", lambda p: p["id"]).alias("object_ids"),
        _texts("headline", sep).alias("headline"), _texts("article", sep).alias("article"), _texts("author", sep).alias("byline"),
        F.transform("parts", lambda p: p["box"]).alias("bbox_list"), F.array("x0", "y0", "x1", "y1").alias("bbox"),
        F.concat_ws("_", F.col("full_article_id").cast("string"), F.col(name or page).cast("string")).alias("id"),
    ).where(F.trim(F.replace("article", F.lit("\n"), F.lit(""))) != "")


def assemble_with_legibility(boxes: DataFrame, page: str = "scan_id", min_tokens: int = MIN_ARTICLE_TOKENS) -> DataFrame:
    """The variant with one image per article (checked), a legibility per object, texts that end in
    a blank, and a least number of tokens."""
    part = F.struct("reading_order_id", "id", "class", F.coalesce("raw_text", F.lit("")).alias("raw_text"), F.coalesce("legibility", F.lit("NA")).alias("legibility"), "image_path", F.array("x0", "y0", "x1", "y1").alias("box"))
    g = boxes.groupBy(page, "full_article_id").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.min("image_path").alias("least"), F.max("image_path").alias("most"), *union())
    g = g.where(F.when(F.coalesce(F.col("least") == F.col("most"), F.lit(True)), F.lit(True)).otherwise(F.raise_error("an article has parts on several images").cast("boolean")))

    def text(cls: str) -> Column:
        return F.array_join(F.transform(F.filter("parts", lambda p: p["class"] == cls), lambda p: F.concat(p["raw_text"], F.lit(" "))), "")

    out = g.select(
        page, "full_article_id", F.transform("parts", lambda p: p["id"]).alias("object_ids"), text("headline").alias("headline"), text("article").alias("article"),
        text("author").alias("byline"), F.transform("parts", lambda p: p["legibility"]).alias("legibility"), F.get("parts", F.lit(0))["image_path"].alias("image_path"),
        F.transform("parts", lambda p: p["box"]).alias("bbox_list"), F.array("x0", "y0", "x1", "y1").alias("bbox"))
    return out.where(F.size(words(F.col("article"))) > min_tokens)


def nonword_share(texts: DataFrame, dictionary: DataFrame, keys: list[str], text: str = "raw_text") -> DataFrame:
    """(keys, nonword_share): share of tokens outside the dictionary (column ``term``); null
    without tokens."""
    tokens = texts.select(*keys, F.explode_outer(words(F.lower(F.translate(F.col(text), ",.?!$%&():;-\"'", "")))).alias("term"))
    known = dictionary.select("term").distinct().withColumn("known", F.lit(1))
    return tokens.join(known, "term", "left").groupBy(*keys).agg(
        F.try_divide(F.count(F.when(F.col("term").isNotNull() & F.col("known").isNull(), 1)).cast("double"), F.count("term").cast("double")).alias("nonword_share"))


def keep_readable(boxes: DataFrame, share: str = "nonword_share") -> DataFrame:
    """Boxes with an article id; articles and headlines without a single known word are left out,
    bylines stay."""
    return boxes.where(F.col("full_article_id").isNotNull() & ((F.col("class") == "author") | (F.coalesce(share, F.lit(0.0)) < 1)))


def explode_boxes(scans: DataFrame, scan_id: str = "scan_id") -> DataFrame:
    """Scan documents to one row per box; ``pos`` keeps the place in the list."""
    b = scans.select(scan_id, F.col("scan.width").alias("scan_w"), F.col("scan.height").alias("scan_h"), F.posexplode("bboxes").alias("pos", "b"))
    return b.select(scan_id, "pos", "scan_w", "scan_h", "b.id", "b.class", "b.bbox.x0", "b.bbox.y0", "b.bbox.x1", "b.bbox.y1", "b.raw_text", F.coalesce("b.legibility", F.lit("NA")).alias("legibility"))


def scan_documents(scans: DataFrame, boxes: DataFrame, articles: DataFrame, scan_id: str = "scan_id") -> DataFrame:
    """Scans with associated boxes and full articles nested again, both in id order."""
    box = F.struct("id", F.struct("x0", "y0", "x1", "y1").alias("bbox"), "class", "raw_text", "legibility", "full_article_id", "reading_order_id")
    nested = boxes.groupBy(scan_id).agg(F.sort_array(F.collect_list(box)).alias("bboxes"))
    art = F.struct("full_article_id", "object_ids", "headline", "article", "byline", "bbox_list", "bbox", "id")
    full = articles.groupBy(scan_id).agg(F.sort_array(F.collect_list(art)).alias("full_articles"))
    return scans.drop("bboxes", "full_articles").join(nested, scan_id, "left").join(full, scan_id, "left")


def fill_defaults(scans: DataFrame, file_name: Column) -> DataFrame:
    """Page ``na`` becomes 1, a missing date comes from the file name, a missing size from the boxes
    (and is marked as approximate)."""
    from ..functions.text import file_date

    most = lambda c: F.array_max(F.transform("bboxes", lambda b: b["bbox"][c]))
    rough = F.col("scan.width").isNull() | F.col("scan.height").isNull()
    return scans.withColumns({
        "page_number": F.when(F.col("page_number") == "na", "1").otherwise(F.col("page_number")),
        "edition": F.struct(F.coalesce("edition.date", file_date(file_name)).alias("date")),
        "scan": F.struct(F.coalesce("scan.height", most("y1")).alias("height"), F.coalesce("scan.width", most("x1")).alias("width"), F.col("scan.jp2_url").alias("jp2_url"), rough.alias("dimensions_approx"))})


def scan_key(date: Column, page: Column, file: Column) -> Column:
    return F.concat(date, F.lit("_p"), page, F.lit("_"), file)


def page_key(lccn: Column, date: Column, edition: Column, page: Column) -> Column:
    return F.concat(lccn, F.lit("_"), date, F.lit("_e"), edition, F.lit("_p"), page)
