"""Whole plans: scan images to text, scan documents to articles, evaluation, and the command line."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import models as M
from ..functions import geometry as G
from ..operators import articles, association, lines, nms, reading_order
from ..schemas import OCR_CLASSES, WORD_SIMILARITY


@dataclass(frozen=True)
class Settings:
    """Typed options; the defaults are those of the command line."""

    layout_canvas: int = 1280
    line_canvas: int = 640
    layout_iou: float = 0.1
    layout_conf: float = 0.01
    layout_max: int = 2000
    line_iou: float = 0.15
    line_conf: float = 0.2
    line_max: int = 200
    localizer_iou: float = 0.10
    localizer_conf: float = 0.15
    word_threshold: float = WORD_SIMILARITY
    line_sep: str = "\n"


def layout_regions(scans: DataFrame, make: Callable[[], M.Detector], names: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(regions, errors) of scans (scan_id, content, width, height): detected, suppressed and put
    back into source pixels; ids follow the score."""
    from ..operators.staging import staged
    from ..sources.tables import named_classes

    found = staged(M.detect(scans, make), "layout")
    kept = nms.suppress(found.where("error IS NULL"), ["scan_id"], s.layout_iou, s.layout_conf, s.layout_max)
    kept = named_classes(kept, names).join(scans.select("scan_id", "width", "height"), "scan_id")
    b = G.letterbox_inverse(G.box(), F.col("width"), F.col("height"), s.layout_canvas)
    regions = kept.select("scan_id", F.col("rank").alias("id"), "class", "conf", "width", "height", b.alias("b")).select("*", "b.*").drop("b")
    errors = found.where("error IS NOT NULL").select(F.col("scan_id").cast("string").alias("filename"), F.lit("layout").alias("stage"), "error")
    return regions, errors


def ocr_regions(regions: DataFrame) -> DataFrame:
    """The regions whose text is read, tall ones in overlapping chunks."""
    r = regions.where(F.col("class").isin(*OCR_CLASSES) & G.is_valid(G.box()))
    return r.withColumn("c", F.explode(G.tall_chunks(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))).select("*", "c.chunk", F.col("c.y0").alias("chunk_y0"), F.col("c.y1").alias("chunk_y1")).drop("c")


def region_lines(detected: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Line detections per chunk (scan_id, id, chunk, chunk_w, det, x0.., conf, cls) to lines of the region."""
    kept = nms.suppress(detected, ["scan_id", "id", "chunk", "chunk_w"], s.line_iou, s.line_conf, s.line_max)
    d = G.chunk_offset(F.col("chunk"), F.col("chunk_w"))
    moved = kept.withColumns({"y0": F.col("y0") + d, "y1": F.col("y1") + d, "det": F.col("chunk") * 1000 + F.col("det")})
    return nms.merge_chunk_lines(moved, ["scan_id", "id"], s.line_iou)


def region_texts(recognised: DataFrame, margins: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Words with text (bbox_id, line_idx, word_idx, text) and line margins to one text per region."""
    w = recognised.groupBy("bbox_id", "line_idx").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("word_idx", "text"))), lambda x: x["text"]), " ").alias("text"))
    scored = lines.paragraph_scores(margins)
    return lines.join_lines(scored.join(w, ["bbox_id", "line_idx"], "left").withColumn("text", F.coalesce("text", F.lit(""))), line_sep=s.line_sep)


def full_articles(boxes: DataFrame, page: str = "scan_id") -> tuple[DataFrame, DataFrame]:
    """(associated boxes in reading order, full articles).  Everything is keyed by page, so one
    shuffle by page serves the joins, windows and groups that follow."""
    b = boxes if "page_w" in boxes.columns else association.with_page_extent(boxes, page)
    ordered = reading_order.reading_order(association.article_ids(b.repartition(page), page), page)
    return ordered, articles.assemble(ordered, page)


def associate_scans(scans: DataFrame) -> DataFrame:
    """Scan documents (scan_id, file, ...) to scan documents with association and full articles."""
    filled = articles.fill_defaults(scans, F.col("file"))
    boxes = articles.explode_boxes(filled).withColumns({"page_w": F.col("scan_w"), "page_h": F.col("scan_h")})
    ordered, full = full_articles(boxes)
    return articles.scan_documents(filled, ordered, full)


def spell_checked(scans: DataFrame, dictionary: DataFrame, bigrams: DataFrame | None = None) -> DataFrame:
    """The scan documents (file, bboxes, ...) with the four corrected texts in every box."""
    from ..functions.spell import SEPARATORS, with_spell_checks

    each = scans.select("file", F.posexplode("bboxes").alias("pos", "b")).withColumn("raw_text", F.coalesce("b.raw_text", F.lit("")))
    box = F.col("b")
    for mode in SEPARATORS:
        box = box.withField(f"spell_check_{mode}", F.col(f"spell_check_{mode}"))
    checked = with_spell_checks(each, dictionary, bigrams=bigrams).select("file", "pos", box.alias("b"))
    lists = checked.groupBy("file").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "b"))), lambda x: x["b"]).alias("__boxes"))
    return scans.join(lists, "file", "left").withColumn("bboxes", F.coalesce("__boxes", F.array())).drop("__boxes")


def box_documents(scans: DataFrame) -> DataFrame:
    """(name, value): a COCO document per scan, named after its file."""
    from ..schemas import LAYOUT_CLASSES
    from ..sources.sinks import coco_document

    images = scans.select(F.col("file").alias("file_name"), F.col("scan.width").alias("width"), F.col("scan.height").alias("height"))
    boxes = scans.select(F.col("file").alias("file_name"), F.posexplode("bboxes").alias("pos", "b")).select("file_name", "pos", "b.class", "b.bbox.*")
    return coco_document(images, boxes, list(LAYOUT_CLASSES), F.col("file_name")).select(F.concat(F.lit("inference_coco_"), "g").alias("name"), "value")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Scan documents to full articles.")
    p.add_argument("--input", required=True, help="folder of scan documents")
    p.add_argument("--output_save_path", required=True, help="articles by year; _errors and _coco beside them")
    p.add_argument("--manifest_path", help="only the scans of these image paths or addresses")
    p.add_argument("--first_n", type=int, help="the first files by name")
    p.add_argument("--spell_check", action="store_true", help="adds corrected texts; needs --dictionary")
    p.add_argument("--dictionary", help="lines of a term and its count")
    p.add_argument("--bigrams", help="lines of two words and their count")
    p.add_argument("--bbox_output", action="store_true", help="also writes a COCO file per scan")
    return p


def main(argv: list[str] | None = None) -> None:
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.getOrCreate()
    run(spark, parser().parse_args(argv))
    spark.stop()


def run(spark, a: argparse.Namespace) -> None:
    """What the command line does.  A file that does not parse becomes a row of the errors."""
    from ..functions import spell
    from ..functions.text import output_name
    from ..operators.staging import staged
    from ..operators.windows import first_n
    from ..sources.sinks import write_by_year, write_errors, write_files
    from ..sources.tables import CORRUPT, json_scans, manifest

    if a.spell_check and not a.dictionary:
        raise ValueError("--spell_check needs --dictionary")
    read = json_scans(spark, a.input)
    if a.manifest_path:
        path = F.col("path")
        names = manifest(spark, a.manifest_path).select(F.when(path.rlike("^https?://"), output_name(path, True)).otherwise(output_name(path, False)).alias("file"))
        read = read.join(names.distinct(), "file", "left_semi")
    if a.first_n is not None:
        read = read.join(first_n(read.select("file"), ["file"], a.first_n), "file", "left_semi")
    read = staged(read, "scans")
    broken = read.where(F.col(CORRUPT).isNotNull()).select(F.col("file").alias("filename"), F.lit("read").alias("stage"), F.lit("not a scan document").alias("error"))
    scans = read.where(F.col(CORRUPT).isNull()).drop(CORRUPT).withColumn("scan_id", F.regexp_replace("file", r"\.json$", ""))
    out = associate_scans(scans)
    if a.spell_check:
        bigrams = spell.read_bigrams(spark, a.bigrams) if a.bigrams else None
        out = spell_checked(staged(out, "articles"), spell.read_frequencies(spark, a.dictionary), bigrams)
    write_by_year(out.withColumn("year", F.substring("edition.date", 1, 4).try_cast("int")), a.output_save_path)
    write_errors(broken, f"{a.output_save_path}/_errors")
    if a.bbox_output:
        write_files(box_documents(scans), f"{a.output_save_path}/_coco", exist_ok=True)


if __name__ == "__main__":
    main()
