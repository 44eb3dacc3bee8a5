"""Published tables, manifests, scan documents, directories, images and run logs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.staging import small_side
from ..schemas import SCAN_DDL

IMAGES = ("jpg", "jpeg", "png", "jp2")
CORRUPT = "_corrupt_record"


def published(spark: SparkSession, base: str, years: list[int | str] | None = None) -> DataFrame:
    """The articles or scans below a folder partitioned by ``year``; all years or some.  The filter
    prunes folders."""
    df = spark.read.parquet(base)
    return df if years is None else df.where(F.col("year").isin([int(y) for y in years]))


CONFIGS = {
    "subset_years": ("articles", True), "all_years": ("articles", False),
    "subset_years_content_regions": ("scans", True), "all_years_content_regions": ("scans", False),
}


def load_config(spark: SparkSession, base: str, config: str, year_list: list | None = None) -> DataFrame:
    """One of the four published configurations."""
    table, some = CONFIGS[config]
    if some and not year_list:
        raise ValueError(f"{config} needs a list of years")
    return published(spark, f"{base}/{table}", year_list if some else None)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(pos, path): the lines of a text file in order, or the files of a folder by name."""
    fs = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = fs.getFileSystem(spark._jsc.hadoopConfiguration())
    if not status.exists(fs):
        raise FileNotFoundError(path)
    if status.getFileStatus(fs).isDirectory():
        names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
        from ..operators.windows import numbered

        return numbered(names, ["path"], "pos").select("pos", "path")
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("pos", "path"))
    return lines.where(F.trim("path") != "")


def json_scans(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Scan documents of all ``pattern`` files below a folder, with file name; what does not parse is
    in _corrupt_record."""
    df = spark.read.schema(f"{SCAN_DDL}, {CORRUPT} string").option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).json(path)
    return df.withColumnRenamed("full articles", "full_articles").withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def old_format(scans: DataFrame) -> DataFrame:
    """Scan documents as one list of flat objects per image (image_file_name, object_id, label, box
    as a list, text, legibility)."""
    b = scans.select(F.col("file").alias("image_file_name"), F.posexplode("bboxes").alias("pos", "b"))
    return b.select("image_file_name", "pos", F.col("b.id").alias("object_id"), F.col("b.class").alias("label"), F.array("b.bbox.x0", "b.bbox.y0", "b.bbox.x1", "b.bbox.y1").alias("bbox"),
                    F.coalesce("b.raw_text", F.lit("")).alias("ocr_text"), F.coalesce("b.legibility", F.lit("NA")).alias("legibility"))


def layout_info(objects: DataFrame) -> DataFrame:
    """Layout rows by right edge, then bottom."""
    return objects.select("image_file_name", "object_id", "label", F.col("bbox")[0].alias("top_left_x"), F.col("bbox")[1].alias("top_left_y"), F.col("bbox")[2].alias("bottom_right_x"), F.col("bbox")[3].alias("bottom_right_y")).orderBy("image_file_name", "bottom_right_x", "bottom_right_y")


def ocr_objects(spark: SparkSession, path: str) -> DataFrame:
    """OCR results keyed by image name, one JSON document per file, to rows."""
    kind = "map<string,array<struct<object_id:int,label:string,bbox:array<int>,ocr_text:string>>>"
    m = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("m"))
    return m.select(F.explode("m").alias("image_file_name", "objects")).select("image_file_name", F.posexplode("objects").alias("pos", "o")).select("image_file_name", "pos", "o.*")


def directory(spark: SparkSession, path: str, id_col: str = "LCCN") -> DataFrame:
    """Pipe-delimited directory: the ruled second line is skipped, cells trimmed, rows without id
    dropped; distinct ids."""
    df = spark.read.option("header", "true").option("sep", "|").csv(path)
    ids = df.select(F.trim(F.col(next(c for c in df.columns if c.strip() == id_col))).alias(id_col))
    return ids.where(F.col(id_col).isNotNull() & (F.col(id_col) != "") & ~F.col(id_col).rlike("^[-=+ ]+$")).distinct()


def images(spark: SparkSession, path: str, kinds: tuple = IMAGES) -> DataFrame:
    """(path, stem, label, content): label is the parent folder.  The suffix is compared without case."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    ext = F.lower(F.element_at(F.split(name, r"\."), -1))
    return df.where(ext.isin(*kinds)).select("path", F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.element_at(F.split("path", "/"), -2).alias("label"), "content")


def image_folder(spark: SparkSession, path: str) -> DataFrame:
    """Images with ``paired`` for names that start with PAIRED; all others are rendered."""
    return images(spark, path).withColumn("paired", F.col("stem").startswith("PAIRED"))


def by_kind(paths: DataFrame, col: str = "path") -> tuple[DataFrame, DataFrame]:
    """(supported, dead letters): images and PDFs by suffix, everything else with its error."""
    kind = F.lower(F.regexp_extract(col, r"\.([A-Za-z0-9]+)$", 1))
    df = paths.withColumn("kind", kind)
    good = F.col("kind").isin(*IMAGES, "pdf")
    return df.where(good), df.where(~good).select(F.col(col).alias("filename"), F.lit("read").alias("stage"), F.concat(F.lit("unsupported kind: "), "kind").alias("error"))


def fetched(paths: DataFrame, fetch: Callable[[str, dict], tuple[int, bytes]], col: str = "url", agents: tuple = ("galley/1",), retries: int = 5) -> tuple[DataFrame, DataFrame]:
    """(pages, dead letters): an injected fetcher per row, agents in turn; a status other than 200 is
    retried, then one dead letter."""
    schema = "url string, content binary, error string"

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for i, url in enumerate(part["url"]):
                content, error = None, None
                for k in range(retries):
                    try:
                        status, body = fetch(url, {"User-Agent": agents[(i + k) % len(agents)]})
                        content, error = (body, None) if status == 200 else (None, f"status {status}")
                    except Exception as e:  # noqa: BLE001  any failure of a fetch is a dead letter
                        content, error = None, f"{type(e).__name__}: {e}"
                    if error is None:
                        break
                out.append((url, content, error))
            yield pd.DataFrame(out, columns=["url", "content", "error"])

    from ..operators.staging import staged

    df = staged(paths.select(F.col(col).alias("url")).mapInPandas(run, schema), "fetched")
    return df.where("error IS NULL").drop("error"), df.where("error IS NOT NULL").select(F.col("url").alias("filename"), F.lit("fetch").alias("stage"), "error")


def converted(files: DataFrame, convert: Callable[[bytes], bytes]) -> tuple[DataFrame, DataFrame]:
    """(images, dead letters): an injected converter (PDF or JP2 to JPEG) over binary files."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for path, content in zip(part["path"], part["content"]):
                try:
                    out.append((path, convert(content), None))
                except Exception as e:  # noqa: BLE001
                    out.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["path", "content", "error"])

    from ..operators.staging import staged

    df = staged(files.select("path", "content").mapInPandas(run, "path string, content binary, error string"), "converted")
    return df.where("error IS NULL").drop("error"), df.where("error IS NOT NULL").select(F.col("path").alias("filename"), F.lit("convert").alias("stage"), "error")


def run_log_files(spark: SparkSession, path: str, name_part: str = "") -> DataFrame:
    """(file, pos, page_url) of all pages in a folder of edition manifests."""
    from ..schemas import MANIFEST

    df = spark.read.schema(MANIFEST).option("multiLine", "true").json(path).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    df = df.where(F.col("file").contains(name_part))
    pages = F.transform(F.sort_array(F.map_entries("pages")), lambda e: e["value"])
    return df.select("file", F.posexplode(pages).alias("pos", "p")).select("file", "pos", "p.page_url")


# Labels and reference tables.
def label_map(spark: SparkSession, path: str) -> DataFrame:
    """``{"0": "article", ...}`` or a list of {id, name} to (cls, name)."""
    raw = spark.read.text(path, wholetext=True)
    pairs = raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("k", "name")).where(F.col("k").rlike("^[0-9]+$")).select(F.col("k").cast("int").alias("cls"), "name")
    listed = raw.select(F.explode(F.from_json("value", "array<struct<id:int,name:string>>")).alias("e")).where("e.name IS NOT NULL").select(F.col("e.id").alias("cls"), "e.name")
    return pairs.unionByName(listed)


def named_classes(rows: DataFrame, names: DataFrame, cls: str = "cls") -> DataFrame:
    """Adds ``class``: the name, or the number itself where it has none."""
    n = small_side(names.select(F.col("cls").alias("__c"), F.col("name").alias("__n")))
    return rows.join(n, F.col(cls) == F.col("__c"), "left").withColumn("class", F.coalesce("__n", F.col(cls).cast("string"))).drop("__c", "__n")


def reference_labels(spark: SparkSession, path: str, code_points: bool = False) -> DataFrame:
    """(ref_id, label) of a blank-separated list; words may be code points joined by underscores."""
    from ..functions.text import words_from_code_points

    t = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.trim("value"), r"\s+")).alias("ref_id", "label"))
    return t.withColumn("label", words_from_code_points(F.col("label"))) if code_points else t


def coco_stems(spark: SparkSession, path: str) -> DataFrame:
    """File stems of the images of a COCO document."""
    i = spark.read.option("multiLine", "true").schema("images array<struct<file_name:string>>").json(path).select(F.explode("images.file_name").alias("f"))
    return i.select(F.regexp_replace(F.element_at(F.split("f", "/"), -1), r"\.[^.]*$", "").alias("stem"))


def coco_boxes(spark: SparkSession, path: str, shrink: float = 0.0) -> DataFrame:
    """One row per annotation: pixel box of its segmentation, relative box, and a shrunk one."""
    from ..functions import geometry as G

    ddl = "images array<struct<id:int,file_name:string,height:int,width:int>>, annotations array<struct<id:int,image_id:int,category_id:int,segmentation:array<array<double>>>>"
    d = spark.read.option("multiLine", "true").schema(ddl).json(path)
    img = d.select(F.explode("images").alias("i")).select("i.*").withColumnRenamed("id", "image_id")
    ann = d.select(F.explode("annotations").alias("a")).select("a.*").join(img, "image_id")
    b = G.mask_box(F.flatten("segmentation"))
    return ann.select("file_name", "image_id", "id", "category_id", "width", "height", b.alias("box")).withColumns({
        "relative": G.xyxy_to_xywhn(F.col("box"), F.col("width"), F.col("height")), "inner": G.contract(F.col("box"), F.lit(shrink))})


_LABELS = "array<struct<id:string,annotations:array<struct<completed_by:int,result:array<struct<id:string,to_name:string,type:string,original_width:int,original_height:int,value:struct<rectanglelabels:array<string>,labels:array<string>,text:array<string>,x:double,y:double,width:double,height:double>>>>>,data:struct<image:string>>>"


def gold_results(spark: SparkSession, path: str) -> DataFrame:
    """Annotation export to one row per result of the first annotation."""
    t = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", _LABELS)).alias("t"))
    a = t.select(F.col("t.id").alias("task"), F.col("t.data.image").alias("image"), F.col("t.annotations")[0].alias("a"))
    return a.select("task", "image", "a.completed_by", F.posexplode("a.result").alias("pos", "r")).select(
        "task", "image", "completed_by", "pos", F.col("r.id").alias("result_id"), F.col("r.type").alias("type"), F.col("r.original_width").alias("w"), F.col("r.original_height").alias("h"),
        F.get("r.value.rectanglelabels", F.lit(0)).alias("box_label"), F.get("r.value.labels", F.lit(0)).alias("cluster"), F.get("r.value.text", F.lit(0)).alias("text"), "r.value.x", "r.value.y", "r.value.width", "r.value.height")


def gold_clusters(results: DataFrame) -> DataFrame:
    """(image, cluster, boxes): the boxes of every article label."""
    return results.where("cluster IS NOT NULL").groupBy("image", "cluster").agg(F.sort_array(F.collect_set("result_id")).alias("boxes"))


def predicted_boxes(results: DataFrame) -> DataFrame:
    """Results of one id (rectangle and text area) merged to one box in pixels."""
    g = results.groupBy("image", "result_id").agg(
        F.min("pos").alias("pos"), F.max("box_label").alias("class"), F.max("text").alias("raw_text"), F.max("x").alias("x"), F.max("y").alias("y"),
        F.max("width").alias("bw"), F.max("height").alias("bh"), F.max("w").alias("w"), F.max("h").alias("h"))
    px = lambda v, n: (F.floor(v * F.col(n) / 100)).cast("int")
    return g.select("image", "result_id", "pos", "class", F.coalesce("raw_text", F.lit("")).alias("raw_text"), px(F.col("x"), "w").alias("x0"), px(F.col("y"), "h").alias("y0"), px(F.col("x") + F.col("bw"), "w").alias("x1"), px(F.col("y") + F.col("bh"), "h").alias("y1"))


def corrected_only(results: DataFrame, annotator: int = 1) -> DataFrame:
    return results.where(F.col("completed_by") == annotator)


def yolo_labels(results: DataFrame, classes: dict[str, int]) -> DataFrame:
    """(image, pos, line): ``c x y w h`` with relative centres."""
    from ..functions.geometry import yolo_box

    b = yolo_box(F.col("x"), F.col("y"), F.col("width"), F.col("height"))
    c = F.create_map(*[F.lit(v) for kv in classes.items() for v in kv])[F.col("box_label")]
    return results.where("box_label IS NOT NULL").select("image", "pos", F.concat_ws(" ", c.cast("string"), b["x"].cast("string"), b["y"].cast("string"), b["w"].cast("string"), b["h"].cast("string")).alias("line"))
