"""Sinks: scan documents, COCO documents, manifests, dead letters, reports and timings."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.text import output_name
from ..operators.windows import chunk_index, chunked, numbered


def scan_json(scans: DataFrame, path_col: str, url_mode: bool) -> DataFrame:
    """(name, value): one JSON text per scan, with the name of its file."""
    named = {"full_articles": "full articles"}
    body = [F.col(f"`{c}`").alias(named.get(c, c)) for c in scans.columns if c != path_col]
    return scans.select(output_name(scans[path_col], url_mode).alias("name"), F.to_json(F.struct(*body)).alias("value"))


def write_scan_json(scans: DataFrame, path_col: str, url_mode: bool, out: str) -> None:
    """One JSON file per scan; two scans of one name are an error, as is an existing target."""
    names = scans.select(output_name(scans[path_col], url_mode).alias("name"))
    twice = names.groupBy("name").count().where("count > 1").select("name").first()
    if twice:
        raise ValueError(f"two scans would be written as {twice.name}")
    write_files(scan_json(scans, path_col, url_mode), out)


def write_files(files: DataFrame, out: str, exist_ok: bool = False) -> None:
    """(name, value) to a text file per row.  The tasks write through Arrow's file systems; a repeated task writes
    the same files again, and ``_SUCCESS`` comes last."""
    spark = files.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(path) and not exist_ok:
        raise FileExistsError(out)
    system.mkdirs(path)
    uri = system.makeQualified(path).toString()
    uri = uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri.replace("s3a:", "s3:", 1)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        target, base = FileSystem.from_uri(uri)
        for part in parts:
            for name, value in zip(part["name"], part["value"]):
                with target.open_output_stream(f"{base}/{name}") as f:
                    f.write(value.encode())
            yield pd.DataFrame({"n": [len(part)]})

    files.select("name", "value").mapInPandas(run, "n long").agg(F.sum("n")).collect()
    system.create(spark._jvm.org.apache.hadoop.fs.Path(out, "_SUCCESS")).close()


def write_by_year(documents: DataFrame, out: str, key: str = "scan_id") -> DataFrame:
    """Append documents that the target does not have yet, by year; returns what was written.  Run
    again, it writes nothing."""
    spark = documents.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(out, "year=*")
    new = documents.dropDuplicates([key])
    if len(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p) or []):
        new = new.join(spark.read.parquet(out).select(key), key, "left_anti")
    from ..operators.staging import staged

    new = staged(new, "new")
    new.write.partitionBy("year").mode("append").parquet(out)
    return new


def write_manifests(urls: DataFrame, order: list[str], out: str, size: int = 100, url: str = "url") -> None:
    """Text files of ``size`` addresses in order, in a folder per chunk."""
    c = chunked(urls, order, size).select("chunk", "idx", F.col(url).alias("value"))
    c.repartition("chunk").sortWithinPartitions("chunk", "idx").select("chunk", "value").write.partitionBy("chunk").mode("errorifexists").text(out)


def split_results(rows: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good, failed) by an error column."""
    return rows.where(F.col(error).isNull()).drop(error), rows.where(F.col(error).isNotNull())


def index_of_chunks(rows: DataFrame, group: list[str], order: list[str], size: int = 20) -> DataFrame:
    return chunk_index(rows, group, order, size)


def write_errors(errors: DataFrame, out: str) -> None:
    """filename, stage, error as quoted CSV with a header."""
    errors.select("filename", "stage", "error").write.option("header", "true").option("quoteAll", "true").option("escape", '"').mode("append").csv(out)


def coco_document(images: DataFrame, boxes: DataFrame, categories: list[str], group: Column | None = None) -> DataFrame:
    """One COCO document per group: images (file_name, width, height) and boxes (file_name, class,
    x0..y1) with consecutive ids from 0 in name and list order.

    A document is a value, so a group should be a page or a shard of pages.
    """
    i = images.withColumn("g", F.lit(0) if group is None else group)
    return _coco(i, boxes, ["file_name"], ["file_name"], ["pos", "x0", "y0", "x1", "y1"], categories)


def _coco(images: DataFrame, boxes: DataFrame, key: list[str], order: list[str], box_order: list[str], categories: list[str], cropped: bool = False) -> DataFrame:
    """Images (g, key.., width, height) and their boxes by key; ids follow the orders.  What is cropped is named by its id."""
    cats = F.array(*[F.struct(F.lit(i).alias("id"), F.lit(c).alias("name")) for i, c in enumerate(categories)])
    number = F.create_map(*[F.lit(x) for i_, c in enumerate(categories) for x in (c, i_)])
    i = numbered(images, order, "image_id", ["g"])
    name = F.concat(F.col("image_id").cast("string"), F.lit(".png")) if cropped else F.col("file_name")
    b = numbered(boxes.join(i.select("g", *key, "image_id"), key), ["image_id", *box_order], "ann_id", ["g"])
    ann = b.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("ann_id", G.coco_annotation(G.box(), F.col("image_id"), F.col("ann_id"), number[F.col("class")]).alias("a")))).alias("anns"))
    img = i.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("image_id", G.coco_image(name, F.col("width"), F.col("height"), F.col("image_id")).alias("i")))).alias("imgs"))
    doc = F.to_json(F.struct(F.transform("imgs", lambda x: x["i"]).alias("images"), F.coalesce(F.transform("anns", lambda x: x["a"]), F.array()).alias("annotations"), cats.alias("categories")))
    return img.join(ann, "g", "left").select("g", doc.alias("value"))


def coco_levels(images: DataFrame, boxes: DataFrame, lines: DataFrame, marks: DataFrame, categories: list[str], group: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three linked COCO documents per group: scans with their boxes, boxes with their lines, lines with their
    characters and words.  What is an annotation of one level is an image of the next, under the same id.

    images (file_name, width, height), boxes (file_name, pos, class, x0..y1), lines (file_name, pos, line_idx,
    x0..y1 within the box), marks (file_name, pos, line_idx, mark_idx, class char or word, x0..y1 within the line).
    """
    g = images.withColumn("g", F.lit(0) if group is None else group)
    size = [(F.col("x1") - F.col("x0")).alias("width"), (F.col("y1") - F.col("y0")).alias("height")]
    crops = boxes.join(g.select("g", "file_name"), "file_name").select("g", "file_name", "pos", *size)
    strips = lines.join(crops.select("g", "file_name", "pos", "width"), ["file_name", "pos"]).select("g", "file_name", "pos", "line_idx", "y0", "width", size[1])
    layout = _coco(g, boxes, ["file_name"], ["file_name"], ["pos"], categories)
    line = _coco(crops, lines.withColumn("class", F.lit("line")), ["file_name", "pos"], ["file_name", "pos"], ["y0", "line_idx"], ["line"], cropped=True)
    order = ["file_name", "pos", "line_idx"]
    char = _coco(strips, marks, order, ["file_name", "pos", "y0", "line_idx"], ["class", "mark_idx"], ["char", "word"], cropped=True)
    return layout, line, char


def article_report(boxes: DataFrame, page: str = "scan_id") -> DataFrame:
    """Per page and article a readable text: the headline, then its parts in order."""
    part = F.struct(F.when(F.col("class") == "headline", 0).otherwise(1).alias("k"), "reading_order_id", "raw_text")
    return boxes.groupBy(page, "full_article_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["raw_text"]), "\n").alias("report")).where(F.length("report") > 0)


def timed(df: DataFrame, name: str):
    """(observed frame, observation): row count of a stage, without another pass."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
