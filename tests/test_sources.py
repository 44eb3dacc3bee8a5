"""Sources, sinks, models, plans and streaming over small files."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from galley import models
from galley.operators.lines import end_mark
from galley.plans import pipelines
from galley.sources import catalogue_xml as X
from galley.sources import sinks, tables
from galley.streaming import ingest

SCAN = {"page_number": "na", "scan_url": "u", "bboxes": [
    {"id": 0, "bbox": {"x0": 100, "y0": 100, "x1": 400, "y1": 150}, "class": "headline", "raw_text": "H", "legibility": "Legible"},
    {"id": 1, "bbox": {"x0": 90, "y0": 160, "x1": 410, "y1": 600}, "class": "article", "raw_text": "A"}]}


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_scans_to_articles(spark, tmp_path):
    write(tmp_path / "in/a/x_1900010201_p1.json", json.dumps(SCAN))
    write(tmp_path / "in/bad.json", "{")
    scans = tables.json_scans(spark, str(tmp_path / "in"))
    assert scans.where("_corrupt_record IS NOT NULL").cache().count() <= 1
    good = scans.where("bboxes IS NOT NULL").drop("_corrupt_record").withColumn("scan_id", F.regexp_replace("file", ".json$", ""))
    out = pipelines.associate_scans(good).first()
    assert out.edition.date == "1900-01-02" and out.page_number == "1" and out.scan.width == 410 and out.scan.dimensions_approx
    assert out.full_articles[0].headline == "H" and out.full_articles[0].article == "A" and [b.id for b in out.bboxes] == [0, 1]
    new = sinks.write_by_year(good.select("scan_id").withColumn("year", F.lit(1900)), str(tmp_path / "out"))
    assert new.count() == 1
    assert sinks.write_by_year(good.select("scan_id").withColumn("year", F.lit(1900)), str(tmp_path / "out")).count() == 0


def test_published_configs(spark, tmp_path):
    spark.range(4).select("id", (F.col("id") % 2 + 1900).alias("year")).write.partitionBy("year").parquet(str(tmp_path / "articles"))
    assert tables.load_config(spark, str(tmp_path), "subset_years", ["1900"]).count() == 2 and tables.load_config(spark, str(tmp_path), "all_years").count() == 4
    with pytest.raises(ValueError):
        tables.load_config(spark, str(tmp_path), "subset_years")


def test_manifest_and_directory(spark, tmp_path):
    p = write(tmp_path / "m.txt", "b\na\n\n")
    assert [(r.pos, r.path) for r in tables.manifest(spark, p).collect()] == [(0, "b"), (1, "a")]
    with pytest.raises(FileNotFoundError):
        tables.manifest(spark, str(tmp_path / "none"))
    d = write(tmp_path / "d.txt", "LCCN | title\n---- | ----\nsn1 | A\nsn1 | B\n | C\n")
    assert [r.LCCN for r in tables.directory(spark, d).collect()] == ["sn1"]


def test_dead_letters(spark, tmp_path):
    good, bad = tables.by_kind(spark.createDataFrame([("a.JPG",), ("b.txt",), ("c.pdf",)], "path string"))
    assert good.count() == 2 and bad.first().filename == "b.txt"

    def fetch(url, headers):
        return (200, b"x") if url == "ok" else (500, b"")

    ok, failed = tables.fetched(spark.createDataFrame([("ok",), ("no",)], "url string"), fetch, retries=2)
    assert [r.url for r in ok.collect()] == ["ok"] and failed.first().error == "status 500"
    sinks.write_errors(failed.withColumn("error", F.lit('a,"b"')), str(tmp_path / "e"))
    assert spark.read.option("header", "true").option("escape", '"').csv(str(tmp_path / "e")).first().error == 'a,"b"'


def test_labels(spark, tmp_path):
    p = write(tmp_path / "map.json", '{"0": "article", "3": "headline"}')
    names = tables.label_map(spark, p)
    assert {(r.cls, r["class"]) for r in tables.named_classes(spark.createDataFrame([(0,), (7,)], "cls int"), names).collect()} == {(0, "article"), (7, "7")}
    q = write(tmp_path / "list.json", '[{"id": 1, "name": "article"}]')
    assert [tuple(r) for r in tables.label_map(spark, q).collect()] == [(1, "article")]
    r = write(tmp_path / "ref.txt", "72_105 65")
    assert [x.label for x in tables.reference_labels(spark, r, code_points=True).orderBy("ref_id").collect()] == ["Hi", "A"]
    gold = [{"id": "1", "data": {"image": "p.jpg"}, "annotations": [{"completed_by": 1, "result": [
        {"id": "r1", "type": "rectanglelabels", "original_width": 200, "original_height": 100, "value": {"rectanglelabels": ["article"], "x": 10, "y": 10, "width": 50, "height": 20}},
        {"id": "r1", "type": "labels", "original_width": 200, "original_height": 100, "value": {"labels": ["Article 1"], "x": 10, "y": 10, "width": 50, "height": 20}},
        {"id": "r1", "type": "textarea", "original_width": 200, "original_height": 100, "value": {"text": ["hello"], "x": 10, "y": 10, "width": 50, "height": 20}}]}]}]
    g = tables.gold_results(spark, write(tmp_path / "g.json", json.dumps(gold)))
    assert tables.gold_clusters(g).first().boxes == ["r1"]
    b = tables.predicted_boxes(tables.corrected_only(g)).first()
    assert (b["class"], b.raw_text, b.x0, b.y0, b.x1, b.y1) == ("article", "hello", 20, 10, 120, 30)
    assert tables.yolo_labels(g, {"article": 0}).first().line == "0 0.35 0.2 0.5 0.2"


def test_coco(spark, tmp_path):
    images = spark.createDataFrame([("b.jpg", 10, 20), ("a.jpg", 30, 40)], "file_name string, width int, height int")
    boxes = spark.createDataFrame([("b.jpg", 0, "article", 1, 2, 3, 4)], "file_name string, pos int, class string, x0 int, y0 int, x1 int, y1 int")
    doc = json.loads(sinks.coco_document(images, boxes, ["article"]).first().value)
    assert [i["file_name"] for i in doc["images"]] == ["a.jpg", "b.jpg"] and doc["annotations"][0]["image_id"] == 1 and doc["annotations"][0]["bbox"] == [1, 2, 2, 2]
    p = write(tmp_path / "c.json", json.dumps({"images": doc["images"], "annotations": doc["annotations"]}))
    assert {r.stem for r in tables.coco_stems(spark, p).collect()} == {"a", "b"}
    assert tuple(tables.coco_boxes(spark, p).first().box) == (1.0, 2.0, 3.0, 4.0)


METS = """<mets xmlns="m" xmlns:mods="o" xmlns:xlink="l" LABEL="Daily News (Boston, Mass), 1900-01-02"><dmdSec ID="issueModsBib"><mods:mods>
<mods:identifier type="lccn">sn1</mods:identifier><mods:detail type="volume"><mods:number>5</mods:number></mods:detail></mods:mods></dmdSec>
<dmdSec ID="pageModsBib1"><mods:mods><mods:extent><mods:start>3</mods:start></mods:extent><mods:detail type="page number"><mods:number>1</mods:number></mods:detail><mods:identifier type="reel number">r9</mods:identifier></mods:mods></dmdSec>
<fileSec><file USE="service"><FLocat xlink:href="./0003.jp2"/></file></fileSec></mets>"""
RDF = """<rdf:RDF xmlns:rdf="r" xmlns:d="d" xmlns:o="o"><rdf:Description><d:title>Daily News</d:title><d:date>18??/1922</d:date>
<d:coverage rdf:resource="http://sws.geonames.org/4930956/"/><d:coverage rdf:resource="http://dbpedia.org/resource/Boston"/><d:language>eng</d:language>
<o:aggregates rdf:resource="/lccn/sn1/1900-01-02/ed-1#issue"/><d:successorOf rdf:resource="/lccn/sn0#title"/></rdf:Description></rdf:RDF>"""


def test_catalogue_records(spark):
    m = X.mets_manifest(spark.createDataFrame([("b/1900/1.xml", METS)], "url string, xml string")).first()
    assert (m.paper_name, m.paper_city, m.lccn, m.volume) == ("Daily News", "Boston", "sn1", "5")
    assert m.pages["1"].page_url == "b/1900/0003.jp2" and m.pages["1"].page_ocr == "b/1900/0003.xml" and m.pages["1"].reel_sequence_number == "0003"
    t = X.titles(spark.createDataFrame([("sn1", RDF)], "lccn string, xml string"), languages=spark.createDataFrame([("eng", "English")], "code string, name string")).first()
    assert (t.title, t.start_year, t.end_year, t.geonames_ids, t.dbpedia_ids, t.languages, t.succeeds, t.editions) == ("Daily News", "18??", "1922", ["4930956"], ["Boston"], ["English"], ["sn0"], ["1900-01-02/ed-1"])
    xml = '<r xmlns:rdf="r"><aggregates rdf:resource="/lccn/sn1/1900-01-02/ed-1/seq-1#page"/></r>'
    e = X.editions(spark.createDataFrame([("sn1", "1900010201", xml), ("sn1", "x", xml), ("sn1", "19000103", None)], "lccn string, edition string, xml string"))
    assert sorted((r.edition, r.pages) for r in e.collect()) == [("1900-01-02/ed-1", ["seq-1"]), ("1900-01-03/ed-1", [])]
    on = X.scans_on_date(spark.createDataFrame([("sn1", ["1900-01-02/ed-1"])], "lccn string, editions array<string>"), e, "1900-01-02")
    assert [tuple(r) for r in on.collect()] == [("sn1", "1900-01-02/ed-1", "seq-1")]
    lines = spark.createDataFrame([("b1", '<issue issueDate="1900-01-02">./print/sn1/x.xml</issue>'), ("b1", "<other/>"), ("b1", '<issue issueDate="1901-01-02">sn2/y.xml</issue>')], "batch string, value string")
    b = X.batch_editions(lines)
    assert sorted((r.date, r.path) for r in b.collect()) == [("1900-01-02", "sn1/x.xml"), ("1901-01-02", "sn2/y.xml")]
    assert X.editions_in_years(b, spark.createDataFrame([(1901,)], "year int")).count() == 1
    p = '<r xmlns:rdf="r"><aggregates rdf:resource="/a/seq-1.jp2"/><aggregates rdf:resource="/a/seq-1/ocr.xml"/><aggregates rdf:resource="http://h/iiif/2/batch%2Fx/full"/></r>'
    g = X.pages(spark.createDataFrame([("sn1", "1900-01-02", "ed-1", "1", p)], "lccn string, date string, edition string, page string, xml string")).first()
    assert g.page == "seq-1" and g.jp2_url == "/a/seq-1.jp2" and g.ocr_xml_url == "/a/seq-1/ocr.xml" and g.raw_data_loc == "batch/x"


def test_models(spark):
    images = spark.createDataFrame([(1, b"abc"), (2, b"bad")], "scan_id int, content binary")

    class Picky:
        def __call__(self, batch):
            if any(bytes(b) == b"bad" for b in batch):
                raise ValueError("broken")
            return [[(0, 0, 1280, 1280, 0.9, 0), (0, 0, 1280, 1270, 0.5, 0)] for _ in batch]

    sized = images.withColumns({"width": F.lit(1000), "height": F.lit(1000)})
    regions, errors = pipelines.layout_regions(sized, Picky, spark.createDataFrame([(0, "article")], "cls int, name string"))
    r = regions.collect()
    assert len(r) == 1 and r[0]["class"] == "article" and (r[0].x0, r[0].x1) == (0, 1000) and errors.first().filename == "2"
    crops = models.encode(images, models.HashEncoder)
    assert all(abs(sum(x * x for x in r.vec) - 1) < 1e-9 for r in crops.collect())
    refs = crops.select(F.col("scan_id").cast("long").alias("ref_id"), F.lit("w").alias("label"), "vec")
    words = crops.select(F.col("scan_id").cast("long").alias("word_id"), F.lit(1).alias("line_id"), F.lit(0).alias("word_idx"), "vec")
    chars = words.select("word_id", F.lit(0).alias("char_idx"), "vec")
    out = models.recognise(words, chars, refs, refs.withColumn("label", F.lit(".")), 0.5).collect()
    assert {x.text for x in out} == {"w."}
    assert spark.range(1).select(end_mark(F.lit("..")).alias("m")).first().m is None


def test_streaming(spark, tmp_path):
    write(tmp_path / "land/a.json", json.dumps(SCAN))
    seen = []
    q = ingest.run_batches(ingest.once_per_scan(ingest.landing(spark, str(tmp_path / "land"))), lambda df, i: seen.append(df.count()), str(tmp_path / "cp"))
    q.awaitTermination(60)
    assert sum(seen) == 1


def test_encoders_that_fail_or_are_long(spark):
    class Broken:
        width = 3

        def __call__(self, crops):
            raise ValueError("broken")

    rows = spark.createDataFrame([(1, "a b c d e"), (2, ""), (3, None)], "ref_id long, text string")
    failed = models.encode(rows.withColumn("content", F.lit(b"x")), Broken).select("ref_id", "vec")
    assert {tuple(r.vec) for r in failed.collect()} == {(0.0, 0.0, 0.0)}
    refs = spark.createDataFrame([(5, "x", [1.0, 0.0, 0.0])], "ref_id long, label string, vec array<double>")
    some = failed.select(F.col("ref_id").alias("query_id"), F.when(F.col("ref_id") == 1, F.col("vec")).alias("vec"))  # null vectors too
    assert {(r.ref_id, r.sim) for r in models.nearest(some, refs).collect()} == {(5, 0.0)}

    class Layers:
        """Two layers: the number of a token, then ten times that."""

        def __call__(self, texts):
            assert all(len(t.split()) <= 2 for t in texts)
            each = [np.array([[float(ord(w))] for w in t.split()]).reshape(-1, 1) for t in texts]
            return [np.stack([v, 10 * v]) for v in each]

    def got(**how):
        return {r.ref_id: r.vec for r in models.embed(rows, Layers, window=2, **how).collect()}

    assert got(layer=0) == {1: [99.0], 2: [], 3: []} and got()[1] == [990.0]
    assert got(layer=0, pooling="max")[1] == [101.0] and got(layer=0, pooling="cat")[1] == [99.0, 101.0] and got(layer=0, pooling="cls")[1] == [97.0]


def test_a_file_per_scan(spark, tmp_path):
    d = spark.createDataFrame([("in/a.jp2", "x"), ("in/b.pdf", "é")], "path string, scan_ocr string")
    out = tmp_path / "scans"
    sinks.write_scan_json(d, "path", False, str(out))
    assert {p.name: json.loads(p.read_text()) for p in out.glob("*.json")} == {"a.json": {"scan_ocr": "x"}, "b.json": {"scan_ocr": "é"}} and (out / "_SUCCESS").exists()
    with pytest.raises(FileExistsError):
        sinks.write_scan_json(d, "path", False, str(out))
    with pytest.raises(ValueError, match="a.json"):
        sinks.write_scan_json(d.union(d.where("path = 'in/a.jp2'")), "path", False, str(tmp_path / "other"))


def test_linked_coco_levels(spark):
    box = "x0 int, y0 int, x1 int, y1 int"
    images = spark.createDataFrame([("b.jpg", 100, 200), ("a.jpg", 100, 200)], "file_name string, width int, height int")
    boxes = spark.createDataFrame([("b.jpg", 0, "article", 0, 0, 50, 80), ("a.jpg", 1, "article", 10, 10, 40, 60), ("a.jpg", 0, "headline", 0, 0, 9, 9)], f"file_name string, pos int, class string, {box}")
    lines = spark.createDataFrame([("b.jpg", 0, 0, 0, 0, 50, 12), ("a.jpg", 1, 0, 1, 30, 29, 44), ("a.jpg", 1, 1, 2, 5, 28, 20)], f"file_name string, pos int, line_idx int, {box}")
    marks = spark.createDataFrame([("a.jpg", 1, 0, 0, "word", 0, 0, 9, 9), ("a.jpg", 1, 0, 0, "char", 0, 0, 4, 9), ("b.jpg", 0, 0, 0, "char", 1, 1, 4, 9)], f"file_name string, pos int, line_idx int, mark_idx int, class string, {box}")
    layout, line, char = (json.loads(d.first().value) for d in sinks.coco_levels(images, boxes, lines, marks, ["article", "headline"]))
    ids = lambda d, *keys: [tuple(x[k] for k in keys) for x in d["annotations"]]
    size = lambda d: [(i["id"], i["file_name"], i["width"], i["height"]) for i in d["images"]]
    assert ids(layout, "id", "image_id", "category_id") == [(0, 0, 1), (1, 0, 0), (2, 1, 0)]
    assert size(line) == [(0, "0.png", 9, 9), (1, "1.png", 30, 50), (2, "2.png", 50, 80)]
    assert ids(line, "id", "image_id") == [(0, 1), (1, 1), (2, 2)] and line["annotations"][0]["bbox"] == [2, 5, 26, 15]
    assert size(char) == [(0, "0.png", 30, 15), (1, "1.png", 30, 14), (2, "2.png", 50, 12)]
    assert ids(char, "id", "image_id", "category_id") == [(0, 1, 0), (1, 1, 1), (2, 2, 0)]


def test_command_line(spark, tmp_path):
    for name in ("a_1900010201_p1", "b_1901010201_p1", "c_1902010201_p1"):
        write(tmp_path / f"in/{name}.json", json.dumps({**SCAN, "bboxes": [{**b, "raw_text": "teh house"} for b in SCAN["bboxes"]]}))
    write(tmp_path / "in/aa_broken.json", "no document")
    words = write(tmp_path / "words.txt", "the 50\nhouse 5\n")
    wanted = write(tmp_path / "m.txt", "x/a_1900010201_p1.jp2\nx/b_1901010201_p1.jp2\nx/aa_broken.jp2\n")
    out = tmp_path / "out"
    args = ["--input", str(tmp_path / "in"), "--output_save_path", str(out), "--manifest_path", wanted, "--spell_check", "--dictionary", words, "--bbox_output"]
    for _ in range(2):  # run again, it writes no article twice
        pipelines.run(spark, pipelines.parser().parse_args(args))
    done = spark.read.parquet(str(out)).orderBy("file").collect()
    assert [r.year for r in done] == [1900, 1901]
    assert {(b.spell_check_full_text, b.spell_check_word) for r in done for b in r.bboxes} == {("the house", "the house")}
    errors = spark.read.option("header", "true").csv(str(out / "_errors"))
    assert {tuple(r) for r in errors.collect()} == {("aa_broken.json", "read", "not a scan document")}
    assert {p.name for p in (out / "_coco").glob("inference*")} == {"inference_coco_a_1900010201_p1.json", "inference_coco_b_1901010201_p1.json"}
    first = pipelines.parser().parse_args(["--input", str(tmp_path / "in"), "--output_save_path", str(tmp_path / "one"), "--first_n", "1"])
    pipelines.run(spark, first)
    assert [r.file for r in spark.read.parquet(str(tmp_path / "one")).collect()] == ["a_1900010201_p1.json"]
    with pytest.raises(ValueError):
        pipelines.run(spark, pipelines.parser().parse_args(["--input", "i", "--output_save_path", "o", "--spell_check"]))
