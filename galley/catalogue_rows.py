"""Queries that call the operators which ``catalogue`` reaches only within others, one by one, with oracle SQL.

The oracles state rules and values themselves and share no text with the engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import models
from .catalogue import _ORDERED, LAYOUT, ORACLE, QUERIES, layout, pages, query, table
from .functions import geometry as G
from .functions import text as T
from .operators import articles, association, lines, nms, reading_order, sampling, search
from .sources import catalogue_xml, tables

# Boxes -----------------------------------------------------------------------------------------


def _corners(*at: str):
    return F.array(*[F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")) for x, y in (p.split() for p in at)])


@query(LAYOUT + "SELECT scan_id, id FROM lay WHERE x0 >= 200 AND id % 3 <> 0")
def valid_boxes(spark, sf_dir):
    x0 = F.col("x0") - 200
    b = G.box(x0, "y0", F.when(F.col("id") % 3 == 0, x0).otherwise(F.col("x1") - 200), "y1")
    return layout(spark, sf_dir).where(G.is_valid(b)).select("scan_id", "id")


@query(LAYOUT + """SELECT a.scan_id, a.id AS a, b.id AS b, round(i::DOUBLE / least(a.w * a.h, b.w * b.h), 6) AS iom FROM lay a JOIN lay b ON a.scan_id = b.scan_id AND a.id < b.id,
  LATERAL (SELECT greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS i)""")
def iom_pairs(spark, sf_dir):
    a, b = layout(spark, sf_dir).alias("a"), layout(spark, sf_dir).alias("b")
    ba, bb = (G.box(*[F.col(f"{s}.{k}") for k in ("x0", "y0", "x1", "y1")]) for s in "ab")
    pairs = a.join(b, (F.col("a.scan_id") == F.col("b.scan_id")) & (F.col("a.id") < F.col("b.id")))
    return pairs.select("a.scan_id", F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.round(G.iom(ba, bb), 6).alias("iom"))


def _greedy(limit: str, which: str, same: str, end: str) -> str:
    """Recursive SQL of greedy suppression: ``which`` boxes, boxes that may meet, and what is selected from fin and s."""
    return LAYOUT.replace("WITH b", "WITH RECURSIVE b", 1) + f""", s AS (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY conf DESC, id) - 1 AS r FROM lay WHERE {which}),
pr AS (SELECT a.scan_id, a.r AS ra, b.r AS rb FROM s a JOIN s b ON a.scan_id = b.scan_id AND a.r < b.r AND {same}, LATERAL (SELECT (greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)))::DOUBLE AS i)
  WHERE i > {limit}::DOUBLE * (a.w * a.h + b.w * b.h - i + 1e-7::DOUBLE)),
hit AS (SELECT scan_id, rb, list(ra) AS above FROM pr GROUP BY 1, 2),
kept AS (SELECT scan_id, 0::BIGINT AS r, [0::BIGINT] AS ks FROM (SELECT DISTINCT scan_id FROM s) UNION ALL
  SELECT k.scan_id, k.r + 1, CASE WHEN h.above IS NOT NULL AND len(list_intersect(h.above, k.ks)) > 0 THEN k.ks ELSE list_append(k.ks, k.r + 1) END
  FROM kept k JOIN s ON s.scan_id = k.scan_id AND s.r = k.r + 1 LEFT JOIN hit h ON h.scan_id = k.scan_id AND h.rb = k.r + 1),
fin AS (SELECT scan_id, unnest(arg_max(ks, r)) AS r FROM kept GROUP BY scan_id)
{end}"""


@query(_greedy("0.15", "true", "true", "SELECT s.scan_id, s.id AS det, CAST(row_number() OVER (PARTITION BY s.scan_id ORDER BY s.y0, s.id) - 1 AS INTEGER) AS line_idx FROM fin JOIN s ON fin.scan_id = s.scan_id AND fin.r = s.r"))
def chunk_lines(spark, sf_dir):
    d = layout(spark, sf_dir).withColumn("cls", F.lit(0)).withColumnRenamed("id", "det")
    return nms.merge_chunk_lines(d, ["scan_id"]).select("scan_id", "det", "line_idx")


@query(_greedy("0.1", "conf > 30 AND class <> 'author'", "a.class = b.class", """SELECT scan_id, det, rank FROM (SELECT s.scan_id, s.id AS det, CAST(row_number() OVER (PARTITION BY s.scan_id ORDER BY s.r) - 1 AS INTEGER) AS rank
  FROM fin JOIN s ON fin.scan_id = s.scan_id AND fin.r = s.r) WHERE rank < 3"""))
def nms_by_class(spark, sf_dir):
    """Above a score, of two classes that do not suppress each other, three per page at most."""
    cls = F.when(F.col("class") == "article", 0).when(F.col("class") == "headline", 1).otherwise(2)
    d = layout(spark, sf_dir).withColumn("cls", cls).withColumnRenamed("id", "det")
    return nms.suppress(d, ["scan_id"], 0.1, conf=30, max_det=3, agnostic=False, classes=[0, 1]).select("scan_id", "det", "rank")


@query(LAYOUT + """, r AS (SELECT DISTINCT scan_id, page_w, page_h, least(1280.0::DOUBLE / page_h, 1280.0::DOUBLE / page_w) AS ratio FROM pg),
n AS (SELECT *, round_even(page_w * ratio, 0) AS nw, round_even(page_h * ratio, 0) AS nh FROM r)
SELECT scan_id, round(ratio, 6) AS ratio, CAST(nw AS INTEGER) AS w, CAST(nh AS INTEGER) AS h, CAST(round_even((1280 - nw) / 2.0::DOUBLE - 0.1::DOUBLE, 0) AS INTEGER) AS "left", CAST(round_even((1280 - nh) / 2.0::DOUBLE - 0.1::DOUBLE, 0) AS INTEGER) AS top FROM n""")
def letterbox(spark, sf_dir):
    p = pages(spark, sf_dir).select("scan_id", "page_w", "page_h").distinct()
    return p.select("scan_id", G.letterbox(F.col("page_w"), F.col("page_h"), 1280).alias("b")).select("scan_id", F.round("b.ratio", 6).alias("ratio"), "b.w", "b.h", "b.left", "b.top")


@query(LAYOUT + """SELECT scan_id, id, CAST(round_even(x0 * page_w / 640.0::DOUBLE, 0) AS INTEGER) AS hx0, CAST(round_even(x1 * page_w / 640.0::DOUBLE, 0) AS INTEGER) AS hx1, page_h AS hy1,
  CAST(round_even(y0 * page_h / 640.0::DOUBLE, 0) AS INTEGER) AS vy0, CAST(round_even(y1 * page_h / 640.0::DOUBLE, 0) AS INTEGER) AS vy1, page_w AS vx1 FROM pg""")
def line_boxes(spark, sf_dir):
    w, h = F.col("page_w"), F.col("page_h")
    a, v = G.line_box(G.box(), w, h), G.line_box(G.box(), w, h, vertical=True)
    return pages(spark, sf_dir).select("scan_id", "id", a["x0"].alias("hx0"), a["x1"].alias("hx1"), a["y1"].alias("hy1"), v["y0"].alias("vy0"), v["y1"].alias("vy1"), v["x1"].alias("vx1"))


@query(LAYOUT + "SELECT scan_id, id, CAST(y0 + id * ((w * 3) // 2) AS BIGINT) AS y0 FROM lay")
def chunk_offsets(spark, sf_dir):
    return layout(spark, sf_dir).select("scan_id", "id", (F.col("y0") + G.chunk_offset(F.col("id"), F.col("w"))).cast("long").alias("y0"))


@query(LAYOUT + "SELECT scan_id, id FROM pg WHERE w * 3 > page_w * 2 AND h::DOUBLE / (id + 1) > page_h / 50.0::DOUBLE")
def banner_headlines(spark, sf_dir):
    return pages(spark, sf_dir).where(G.is_banner(G.box(), F.col("page_w"), F.col("page_h"), F.col("id") + 1)).select("scan_id", "id")


@query(LAYOUT + """SELECT scan_id, id, min(x)::DOUBLE AS x0, min(y)::DOUBLE AS y0, max(x)::DOUBLE AS x1, max(y)::DOUBLE AS y1
  FROM (SELECT scan_id, id, unnest([x0, x1, x1, x0]) AS x, unnest([y0, y0, y1, y1]) AS y FROM lay) WHERE x <= 700 AND y <= 600 GROUP BY 1, 2""")
def segment_boxes(spark, sf_dir):
    b = G.segment_to_box(_corners("x0 y0", "x1 y0", "x1 y1", "x0 y1"), F.lit(700), F.lit(600))
    return layout(spark, sf_dir).select("scan_id", "id", F.inline(F.array_compact(F.array(b))))  # a filter would find the box twice


@query(LAYOUT + """SELECT scan_id, id, CAST(generate_subscripts([1, 2, 3, 4, 5], 1) - 1 AS INTEGER) AS at, unnest([x0, (x0 + x1) / 2.0, x1, (x0 + x1) / 2.0, x0])::DOUBLE AS x,
  unnest([y0, (y0 + y1) / 2.0, y1, (y0 + y1) / 2.0, y0])::DOUBLE AS y FROM lay""")
def segments_resampled(spark, sf_dir):
    """A segment of two points is closed by its first, so five points halve both ways."""
    s = layout(spark, sf_dir).select("scan_id", "id", _corners("x0 y0", "x1 y1").alias("s"))
    at = s.select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("at"))  # a row per point: its arithmetic is compiled, a lambda's is not
    return at.select("scan_id", "id", "at", G.segment_point(F.col("s"), F.col("at"), 5).alias("p")).select("scan_id", "id", "at", "p.x", "p.y")


@query(LAYOUT + "SELECT scan_id, id, round(x0 + w / 10.0::DOUBLE, 6) AS x0, round(y0 + h / 10.0::DOUBLE, 6) AS y0, round(x1 - w / 10.0::DOUBLE, 6) AS x1, round(y1 - h / 10.0::DOUBLE, 6) AS y1 FROM lay")
def masks_contracted(spark, sf_dir):
    m = layout(spark, sf_dir).select("scan_id", "id", G.mask_box(F.array("x0", "y1", "x1", "y0", "x0", "y0")).alias("m"))
    b = G.contract(F.col("m"), F.lit(0.1))
    return m.select("scan_id", "id", *[F.round(b[k], 6).alias(k) for k in ("x0", "y0", "x1", "y1")])


@query(LAYOUT + "SELECT scan_id, id, w * h AS area, concat_ws(',', x0, y0, w, h) AS bbox, concat_ws(',', x0, y0, x0, y1, x1, y1, x1, y0) AS segmentation FROM lay")
def coco_boxes(spark, sf_dir):
    a = layout(spark, sf_dir).select("scan_id", "id", G.coco_annotation(G.box(), F.col("scan_id"), F.col("id"), F.lit(0)).alias("a"))
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",")
    return a.select("scan_id", "id", "a.area", text(F.col("a.bbox")).alias("bbox"), text(F.get("a.segmentation", F.lit(0))).alias("segmentation"))


@query(LAYOUT + "SELECT scan_id, id, round((x0 + w / 2.0::DOUBLE) / 100, 6) AS x, round((y0 + h / 2.0::DOUBLE) / 100, 6) AS y, round(w / 100.0::DOUBLE, 6) AS w, round(h / 100.0::DOUBLE, 6) AS h FROM lay")
def percent_boxes(spark, sf_dir):
    b = G.yolo_box(*[F.col(c).cast("double") for c in ("x0", "y0", "w", "h")])
    return layout(spark, sf_dir).select("scan_id", "id", *[F.round(b[k], 6).alias(k) for k in "xywh"])


@query(LAYOUT + """, ids AS (SELECT list(i ORDER BY i) AS l FROM range(1, 91) t(i) WHERE i NOT IN (12, 26, 29, 30, 45, 66, 68, 69, 71, 83))
SELECT scan_id, id, CAST((w + 31) // 32 * 32 AS INTEGER) AS size, CAST(CASE WHEN w % 90 < 80 THEN l[w % 90 + 1] END AS INTEGER) AS category FROM lay, ids""")
def coco_numbers(spark, sf_dir):
    return layout(spark, sf_dir).select("scan_id", "id", G.make_divisible(F.col("w"), 32).alias("size"), G.coco91(F.col("w") % 90).alias("category"))


@query("""SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS dim, round(unnest(list_transform(embedding, lambda x: x::DOUBLE)) / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS x FROM embeddings""")
def unit_vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(G.l2_normalise(F.col("embedding"))).alias("dim", "x"))
    return e.select("vec_id", "dim", F.round("x", 6).alias("x"))


@query(LAYOUT + """SELECT scan_id, id, CAST(floor(list_aggregate([w, x1, 7, x0, h, y1, x0, y0, w, y1, id, 7], 'median')) AS INTEGER) AS fill,
  CAST(floor(list_aggregate([0, 0, 0, 0, h, 0, 0, 0, 0, 0, 5, 0], 'median')) AS INTEGER) AS other FROM lay""")
def border_medians(spark, sf_dir):
    """Three by three pixels of two channels; the one in the middle is no border."""
    pixel = lambda a, b=0: F.array(F.lit(a) if isinstance(a, int) else F.col(a).cast("int"), F.lit(b) if isinstance(b, int) else F.col(b).cast("int"))
    image = F.array(F.array(pixel("x0"), pixel("y0"), pixel("w")), F.array(pixel("h", "h"), pixel(10 ** 9), pixel("x1")), F.array(pixel("y1"), pixel("id", 5), pixel(7)))
    m = layout(spark, sf_dir).select("scan_id", "id", G.border_median(image, 2).alias("m"))
    return m.select("scan_id", "id", m["m"][0].alias("fill"), m["m"][1].alias("other"))


# Reading order ---------------------------------------------------------------------------------
def _places(a: str, b: str, size: str, margin: str) -> str:
    """Recursive SQL: the first box left in order of ``a`` takes all boxes left that are near it; groups go by ``b``."""
    return LAYOUT.replace("WITH b", "WITH RECURSIVE b", 1) + f""", s AS (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY {a}, id) - 1 AS r FROM lay),
near AS (SELECT p.scan_id, p.r, list(q.r) AS own FROM s p JOIN s q ON p.scan_id = q.scan_id AND (p.r = q.r OR abs(p.{a} - q.{a}) < {margin}::DOUBLE * least(p.{size}, q.{size})) GROUP BY 1, 2),
n AS (SELECT scan_id, count(*) AS n FROM s GROUP BY 1),
g AS (SELECT scan_id, 0 AS step, []::BIGINT[] AS taken, []::BIGINT[] AS own FROM n UNION ALL
  SELECT f.scan_id, f.step + 1, list_concat(f.taken, list_filter(near.own, lambda i: NOT list_contains(f.taken, i))), list_filter(near.own, lambda i: NOT list_contains(f.taken, i))
  FROM (SELECT g.*, list_min(list_filter(range(0, n.n), lambda i: NOT list_contains(g.taken, i))) AS seed FROM g JOIN n ON g.scan_id = n.scan_id WHERE len(g.taken) < n.n) f
  JOIN near ON near.scan_id = f.scan_id AND near.r = f.seed),
o AS (SELECT scan_id, step, unnest(own) AS r FROM g)
SELECT s.scan_id, s.id, CAST(row_number() OVER (PARTITION BY s.scan_id ORDER BY o.step, s.{b}, s.r) - 1 AS INTEGER) AS reading_order_id FROM o JOIN s ON o.scan_id = s.scan_id AND o.r = s.r"""


ORACLE["reading_order_columns"] = _places("x0", "y0", "w", "0.40")
ORACLE["reading_order_rows"] = _places("y0", "x0", "h", "0.10")


# Articles and scan documents -------------------------------------------------------------------
@query(_ORDERED + """SELECT scan_id, fa AS full_article_id, coalesce(string_agg(t || ' ', '' ORDER BY ro, id) FILTER (WHERE class = 'headline'), '') AS headline,
  string_agg(t || ' ', '' ORDER BY ro, id) FILTER (WHERE class = 'article') AS article, coalesce(string_agg(t || ' ', '' ORDER BY ro, id) FILTER (WHERE class = 'author'), '') AS byline,
  string_agg(CASE WHEN id % 2 = 0 THEN 'Legible' ELSE 'NA' END, ',' ORDER BY ro, id) AS legibility, 'scan-' || scan_id AS image_path
  FROM (SELECT *, class || '-' || id || repeat(' x', w % 25) AS t FROM o) GROUP BY scan_id, fa HAVING max(w % 25 + 1) FILTER (WHERE class = 'article') > 10""")
def legible_articles(spark, sf_dir):
    own = association.article_ids(pages(spark, sf_dir)).where("full_article_id IS NOT NULL")
    o = reading_order.with_lead_order(own, ("scan_id", "full_article_id")).withColumns({
        "reading_order_id": F.coalesce("reading_order_id", F.lit(0)), "legibility": F.when(F.col("id") % 2 == 0, "Legible"), "image_path": F.concat(F.lit("scan-"), "scan_id"),
        "raw_text": F.concat("class", F.lit("-"), "id", F.repeat(F.lit(" x"), F.col("w") % 25))})
    a = articles.assemble_with_legibility(o)
    return a.select("scan_id", "full_article_id", "headline", "article", "byline", F.array_join("legibility", ",").alias("legibility"), "image_path")


@query(LAYOUT + "SELECT scan_id, id FROM lay WHERE id % 4 <> 0 AND (class = 'author' OR id % 3 <> 2)")
def readable_boxes(spark, sf_dir):
    b = layout(spark, sf_dir).withColumns({"full_article_id": F.when(F.col("id") % 4 != 0, 1), "nonword_share": F.when(F.col("id") % 3 != 0, (F.col("id") % 3) / 2)})
    return articles.keep_readable(b).select("scan_id", "id")


def _scans(spark, sf_dir) -> DataFrame:
    """The layouts as nested scan documents without size, date and number of the page."""
    legible = F.when(F.col("id") % 2 == 0, "Legible")
    box = F.struct("id", F.struct("x0", "y0", "x1", "y1").alias("bbox"), "class", F.when(F.col("id") % 3 > 0, F.col("class")).alias("raw_text"), legible.alias("legibility"))
    g = layout(spark, sf_dir).groupBy("scan_id").agg(F.sort_array(F.collect_list(box)).alias("bboxes"))
    nothing = F.lit(None).cast("int")
    return g.withColumns({
        "file": F.concat(F.lit("paper_1901"), F.lpad((F.col("scan_id") % 12 + 1).cast("string"), 2, "0"), F.lit("0501_p1.json")), "page_number": F.when(F.col("scan_id") % 2 == 0, "na").otherwise("7"),
        "edition": F.struct(F.lit(None).cast("string").alias("date")), "scan": F.struct(nothing.alias("height"), nothing.alias("width"), F.lit("u").alias("jp2_url"))})


@query(LAYOUT + """SELECT 'paper_1901' || lpad(CAST(scan_id % 12 + 1 AS VARCHAR), 2, '0') || '0501_p1.json' AS image_file_name, scan_id, id AS pos, id AS object_id, class AS label, concat_ws(',', x0, y0, x1, y1) AS bbox,
  CASE WHEN id % 3 > 0 THEN class ELSE '' END AS ocr_text, CASE WHEN id % 2 = 0 THEN 'Legible' ELSE 'NA' END AS legibility FROM lay""")
def old_format(spark, sf_dir):
    s = _scans(spark, sf_dir)
    o = tables.old_format(s.withColumn("file", F.concat_ws("/", "file", "scan_id")))
    name = F.col("image_file_name")
    return o.select(F.split_part(name, F.lit("/"), F.lit(1)).alias("image_file_name"), F.split_part(name, F.lit("/"), F.lit(2)).cast("long").alias("scan_id"), "pos", "object_id", "label", F.array_join(F.transform("bbox", lambda v: v.cast("string")), ",").alias("bbox"), "ocr_text", "legibility")


@query(LAYOUT + "SELECT CAST(scan_id AS VARCHAR) AS image_file_name, id AS object_id, class AS label, x0 AS top_left_x, y0 AS top_left_y, x1 AS bottom_right_x, y1 AS bottom_right_y FROM lay")
def layout_info(spark, sf_dir):
    return tables.layout_info(tables.old_format(_scans(spark, sf_dir).withColumn("file", F.col("scan_id").cast("string"))))


@query(LAYOUT + """SELECT DISTINCT scan_id, CASE WHEN scan_id % 2 = 0 THEN '1' ELSE '7' END AS page_number, '1901-' || lpad(CAST(scan_id % 12 + 1 AS VARCHAR), 2, '0') || '-05' AS date, page_w AS width, page_h AS height, true AS approx FROM pg""")
def filled_scans(spark, sf_dir):
    f = articles.fill_defaults(_scans(spark, sf_dir), F.col("file"))
    return f.select("scan_id", "page_number", "edition.date", "scan.width", "scan.height", F.col("scan.dimensions_approx").alias("approx"))


@query(LAYOUT + "SELECT scan_id, id AS pos, page_w AS scan_w, page_h AS scan_h, id, class, x0, y0, x1, y1, CASE WHEN id % 3 > 0 THEN class END AS raw_text, CASE WHEN id % 2 = 0 THEN 'Legible' ELSE 'NA' END AS legibility FROM pg")
def box_rows(spark, sf_dir):
    return articles.explode_boxes(articles.fill_defaults(_scans(spark, sf_dir), F.col("file")))


# Lines -----------------------------------------------------------------------------------------
@query(LAYOUT + "SELECT scan_id AS bbox_id, string_agg(class || CASE WHEN id % 3 = 0 THEN chr(10) || chr(10) ELSE '' END, chr(10) ORDER BY id) AS text FROM lay GROUP BY 1")
def lines_joined(spark, sf_dir):
    b = layout(spark, sf_dir).select(F.col("scan_id").alias("bbox_id"), F.col("id").alias("line_idx"), F.col("class").alias("text"), (F.col("id") % 3 == 0).alias("break_after"))
    return lines.join_lines(b)


@query(LAYOUT + "SELECT scan_id AS line_id, min(x0) AS l_dist, max(x1) AS r_dist, count(*) AS n_chars FROM lay GROUP BY 1")
def line_margins(spark, sf_dir):
    return lines.line_margins(layout(spark, sf_dir).withColumnRenamed("scan_id", "line_id"))


@query(LAYOUT + """SELECT scan_id AS line_id, string_agg(CASE WHEN w * 10 > 2000 THEN class ELSE upper(class[1]) || 'b' END || CASE WHEN id % 2 = 0 THEN '!' ELSE '' END, ' ' ORDER BY id) AS text FROM lay GROUP BY 1""")
def words_recognised(spark, sf_dir):
    """A word's own label above a similarity of 0.2, else the first characters of its characters' labels, and the end mark."""
    first = F.upper(F.substring("class", 1, 1))
    w = layout(spark, sf_dir).select(F.col("scan_id").alias("line_id"), F.col("id").alias("word_idx"), F.col("class").alias("word_label"), (F.col("w") / 1000).alias("word_sim"),
                                     F.array(F.concat(first, F.lit("zz")), F.lit("b")).alias("char_labels"), lines.end_mark(F.when(F.col("id") % 2 == 0, "!").otherwise("x")).alias("end_mark"))
    return lines.line_texts(lines.recognised_words(w, 0.2))


_GLYPHS = "aenrEwuosvcxz-KT"


@query(LAYOUT + f""", c AS (SELECT *, substr('{_GLYPHS}', (w * 7 + id) % 16 + 1, 1) AS g FROM lay),
a AS (SELECT *, avg(h) FILTER (WHERE g IN ('a', 'e', 'n', 'r')) OVER (PARTITION BY scan_id) AS ah, avg(y1) FILTER (WHERE g IN ('a', 'e', 'n', 'r')) OVER (PARTITION BY scan_id) AS ab FROM c),
l AS (SELECT *, CASE WHEN coalesce(abs(h - ah) < 0.2::DOUBLE * ah, false) THEN lower(g) ELSE g END AS lo FROM a)
SELECT scan_id AS line_id, string_agg(CASE WHEN id % 3 = 0 AND id > 0 THEN ' ' ELSE '' END || CASE WHEN contains('wuosvcxz', lo) AND h - ah > 0.2::DOUBLE * 2 * ah THEN upper(lo)
  WHEN lo = '-' AND abs(y1 - ab) < 0.2::DOUBLE * ah THEN '.' ELSE lo END, '' ORDER BY id) AS text FROM l GROUP BY 1""")
def case_repaired(spark, sf_dir):
    label = F.substring(F.lit(_GLYPHS), (F.col("w") * 7 + F.col("id")) % 16 + 1, F.lit(1))
    c = layout(spark, sf_dir).select(F.col("scan_id").alias("line_id"), F.col("id").alias("char_idx"), label.alias("label"), "y0", "y1", (F.col("id") % 3 == 0).alias("starts_word"))
    return lines.repair_case(c, anchor_margin=0.2, anchor_multiplier=2)


@query(LAYOUT + "SELECT scan_id AS bbox_id, arg_max(class, id) AS legibility FROM lay GROUP BY 1")
def region_legibility(spark, sf_dir):
    return lines.region_legibility(layout(spark, sf_dir).select(F.col("scan_id").alias("bbox_id"), F.col("id").alias("chunk"), F.col("class").alias("legibility")))


@query(LAYOUT + "SELECT scan_id, id FROM lay WHERE class <> 'author'")
def legible_crops(spark, sf_dir):
    crops = layout(spark, sf_dir).withColumn("legibility", F.when(F.col("class") == "author", "Illegible").when(F.col("class") == "article", "Legible").otherwise("NA"))
    return models.keep_legible(crops).select("scan_id", "id")


# Samples and splits ----------------------------------------------------------------------------
@query("""SELECT CAST(p AS INTEGER) AS pass, b AS batch, CAST(4 AS BIGINT) AS labels, CAST(20 AS BIGINT) AS items FROM range(2) t(p), (SELECT unnest(range(count(DISTINCT label) // 4)) AS b FROM embeddings)""")
def batched_classes(spark, sf_dir):
    b = sampling.batched_m_per_class(table(spark, sf_dir, "embeddings").select("label", "vec_id"), "label", "vec_id", 5, 20, num_passes=2)
    return b.groupBy("pass", F.col("batch").cast("long").alias("batch")).agg(F.count_distinct("label").alias("labels"), F.count("*").alias("items"))


@query("""SELECT label, vec_id, false AS hard, true AS placed FROM embeddings UNION ALL SELECT label, vec_id, true, true FROM embeddings WHERE vec_id % 7 = 0""")
def hard_negatives(spark, sf_dir):
    """Every hard negative is put into one of the ten batches, and all other rows stay."""
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id")
    h = sampling.with_hard_negatives(e.withColumn("batch", F.col("vec_id") % 10), e.where("vec_id % 7 = 0"), "label")
    return h.select("label", "vec_id", "hard", F.col("batch").between(0, 9).alias("placed"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'render' WHEN p_size <= 10 THEN 'train' WHEN p_size <= 20 THEN 'val' WHEN p_size <= 30 THEN 'test' ELSE 'none' END AS split,
  CASE WHEN p_partkey % 3 = 0 THEN 'none' WHEN p_size <= 10 THEN 'train' WHEN p_size <= 20 THEN 'val' WHEN p_size <= 30 THEN 'test' ELSE 'none' END AS finetuned,
  CASE WHEN p_partkey % 3 = 0 THEN 'render' ELSE 'none' END AS pretrained FROM part""")
def paired_splits(spark, sf_dir):
    name = F.concat(F.when(F.col("p_partkey") % 3 == 0, "").otherwise("PAIRED_"), F.col("p_size").cast("string"), F.lit("_"), F.col("p_partkey").cast("string"))
    stem = sampling.paired_stem(name)
    sets = [[str(i) for i in range(at, at + 10)] for at in (1, 11, 21)]
    split = lambda tune, pre: sampling.split_of(stem, *sets, finetune=tune, pretrain=pre)
    return table(spark, sf_dir, "part").select("p_partkey", split(False, False).alias("split"), split(True, False).alias("finetuned"), split(False, True).alias("pretrained"))


@query("SELECT vec_id, label FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels)")
def subset_by_index(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return sampling.by_index(e, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("vec_id")), "vec_id")


@query("SELECT vec_id FROM embeddings")
def shuffled_rows(spark, sf_dir):
    return sampling.shuffled(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id")


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr')")
def language_subset(spark, sf_dir):
    return search.in_languages(table(spark, sf_dir, "documents"), ["en", "fr"]).select("doc_id", "lang")


@query("SELECT doc_id, CAST(len(list_distinct(list_filter(string_split(text, ' '), lambda w: w NOT IN ('the', 'and', 'die')))) AS BIGINT) AS n FROM documents WHERE text IS NOT NULL")
def set_difference(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return d.select("doc_id", F.size(models.outer_inputs(F.split("text", " "), F.array(*[F.lit(w) for w in ("the", "and", "die")]))).cast("long").alias("n"))


# Texts and names -------------------------------------------------------------------------------
@query("""SELECT doc_id, coalesce(CASE WHEN k < length(text) THEN regexp_matches(substr(text, k + 1, 1), '^\\p{L}$') END, true) AS alpha, coalesce(CASE WHEN k < length(text) THEN regexp_matches(substr(text, k + 1, 1), '^\\p{Nd}$') END, true) AS digit
  FROM (SELECT doc_id, text, CAST(doc_id * 13 % 900 AS INTEGER) AS k FROM documents)""")
def char_kinds(spark, sf_dir):
    k = (F.col("doc_id") * 13 % 900).cast("int")
    return table(spark, sf_dir, "documents").select("doc_id", T.char_is(F.col("text"), k, "alpha").alias("alpha"), T.char_is(F.col("text"), k, "digit").alias("digit"))


@query("""WITH w AS (SELECT doc_id, unnest(list_distinct(string_split(translate(text, 'olsn', '0151'), ' '))) AS w FROM documents),
c AS (SELECT *, regexp_extract_all(w, '(?s).') AS ch FROM w), k AS (SELECT *, list_transform(ch, lambda x: regexp_matches(x, '^\\p{L}$')) AS al, list_transform(ch, lambda x: regexp_matches(x, '^\\p{Nd}$')) AS di FROM c),
n AS (SELECT *, len(list_filter(al, lambda x: x)) AS na, len(list_filter(di, lambda x: x)) AS nd FROM k)
SELECT doc_id, w, CASE WHEN na > nd THEN array_to_string(list_transform(ch, lambda x, i: CASE WHEN di[i] AND coalesce(al[i - 1], true) AND coalesce(al[i + 1], true) THEN CASE x WHEN '0' THEN 'o' WHEN '1' THEN 'l' ELSE x END ELSE x END), '')
  WHEN nd > na THEN array_to_string(list_transform(ch, lambda x, i: CASE WHEN al[i] AND coalesce(di[i - 1], true) AND coalesce(di[i + 1], true) THEN CASE x WHEN 'a' THEN '4' WHEN 'e' THEN '3' ELSE x END ELSE x END), '') ELSE w END AS fixed FROM n""")
def majority_words(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(F.split(F.translate("text", "olsn", "0151"), " "))).alias("w"))
    return d.select("doc_id", "w", T.majority_normalise(F.col("w"), {"0": "o", "1": "l"}, {"a": "4", "e": "3"}).alias("fixed"))


@query("""SELECT doc_id, CAST(len(string_split_regex(text, '[ /"''-]')) + length(regexp_replace(text, '[^ /"''-]', '', 'g')) - len(list_filter(string_split_regex(text, '[ /"''-]'), lambda x: x = '')) AS BIGINT) AS n,
  md5(text) AS joined FROM documents WHERE text IS NOT NULL""")
def split_tokens(spark, sf_dir):
    t = T.split_keeping(F.col("text"))
    d = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    return d.select("doc_id", F.size(t).cast("long").alias("n"), F.md5(F.array_join(t, "").cast("binary")).alias("joined"))


@query("SELECT page_id, translate(url, '|@#!¡·$€%&()=?¿^*;:,¨´><+', repeat('_', 25)) AS name FROM pages")
def clean_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.clean_name(F.col("url")).alias("name"))


@query("SELECT p_partkey, chr(CAST(p_partkey * 37 % 8000 + 100 AS INTEGER)) || chr(CAST(128512 + p_size AS INTEGER)) || 'A' AS word FROM part")
def code_point_words(spark, sf_dir):
    codes = F.concat_ws("_", (F.col("p_partkey") * 37 % 8000 + 100).cast("string"), (F.col("p_size") + 128512).cast("string"), F.lit("65"))
    return table(spark, sf_dir, "part").select("p_partkey", T.words_from_code_points(codes).alias("word"))


@query("""SELECT page_id, p[-1] AS last, p[-2] AS before FROM (SELECT page_id, string_split(rtrim(split_part(url, '#', 1), '/'), '/') AS p FROM pages)""")
def uri_tails(spark, sf_dir):
    u = F.concat("url", F.lit("/#issue"))
    return table(spark, sf_dir, "pages").select("page_id", T.uri_tail(u).alias("last"), T.uri_tail(u, 2).alias("before"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date, 'a_' || strftime(o_orderdate, '%Y%m%d') || '01_p' || (o_orderkey % 9) || '.json' AS name, 'x_y_z_' || o_orderkey || '.json' AS from_url FROM orders""")
def file_names(spark, sf_dir):
    n = F.concat(F.lit("a_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("01_p"), (F.col("o_orderkey") % 9).cast("string"))
    url = F.concat(F.lit("https://w/x/y/z/"), F.col("o_orderkey").cast("string"), F.lit(".jp2"))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.file_date(F.concat(n, F.lit(".json"))).alias("date"), T.output_name(F.concat(F.lit("in/"), n, F.lit(".jpg")), False).alias("name"), T.output_name(url, True).alias("from_url"))


@query("""SELECT o_orderkey, 'https://w/lccn/sn' || o_custkey || '/' || strftime(o_orderdate, '%Y-%m-%d') || '/ed-' || (o_orderkey % 3 + 1) || '/seq-' || (o_orderkey % 40) || '.jp2' AS url,
  strftime(o_orderdate, '%Y-%m-%d') || '_p' || (o_orderkey % 40) || '_f' AS scan_key, 'sn' || o_custkey || '_d_e1_p' || (o_orderkey % 40) AS page_key FROM orders""")
def scan_urls(spark, sf_dir):
    day, page, lccn = F.date_format("o_orderdate", "yyyyMMdd"), (F.col("o_orderkey") % 40).cast("string"), F.concat(F.lit("sn"), F.col("o_custkey").cast("string"))
    edition = F.concat(day, F.lit("0"), (F.col("o_orderkey") % 3 + 1).cast("string"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", T.scan_url("https://w", lccn, edition, F.lpad(page, 4, "0")).alias("url"),
        articles.scan_key(T.dashed_date(day), page, F.lit("f")).alias("scan_key"), articles.page_key(lccn, F.lit("d"), F.lit("1"), page).alias("page_key"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 0 THEN CAST(year(o_orderdate) AS VARCHAR) END AS "start", CASE WHEN o_orderkey % 5 > 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN '19??' ELSE '1999' END END AS "end" FROM orders""")
def year_ranges(spark, sf_dir):
    year = F.year("o_orderdate").cast("string")
    s = F.concat(year, F.when(F.col("o_orderkey") % 5 == 0, "-").otherwise("/"), F.when(F.col("o_orderkey") % 2 == 0, "19??").otherwise("1999"))
    return table(spark, sf_dir, "orders").select("o_orderkey", T.year_range(s).alias("r")).select("o_orderkey", "r.start", "r.end")


# Batch listings and catalogue records ----------------------------------------------------------
def _listing(spark, sf_dir) -> DataFrame:
    """One line per order; odd ones have their serial number first, even ones a folder before it."""
    key = F.col("o_orderkey").cast("string")
    line = F.concat(F.lit('<issue issueDate="'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('"> ./'), F.when(F.col("o_orderkey") % 2 == 0, "data/").otherwise(""), F.lit("sn"), key, F.lit("/1.xml</issue>"))
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("batch"), line.alias("value"))


_BATCHES = "SELECT o_custkey AS batch, strftime(o_orderdate, '%Y-%m-%d') AS date, 'sn' || o_orderkey || '/1.xml' AS path FROM orders WHERE "


@query(_BATCHES + "year(o_orderdate) IN (1995, 1997)")
def batches_in_years(spark, sf_dir):
    years = spark.createDataFrame([(1995,), (1997,)], "year int")
    return catalogue_xml.editions_in_years(catalogue_xml.batch_editions(_listing(spark, sf_dir)), years).select("batch", "date", "path")


@query(_BATCHES + "CAST(o_orderdate AS DATE) IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_quantity < 3)")
def batches_on_dates(spark, sf_dir):
    dates = table(spark, sf_dir, "lineitem").where("l_quantity < 3").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"))
    return catalogue_xml.editions_on_dates(catalogue_xml.batch_editions(_listing(spark, sf_dir)), dates).select("batch", "date", "path")


@query("SELECT o_custkey AS batch, arg_min(o_comment, o_orderkey) AS content FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END AS o_comment FROM orders) WHERE o_comment IS NOT NULL GROUP BY 1")
def first_manifests(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("batch"), "o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("content"))
    return catalogue_xml.first_candidate(o, "batch", "o_orderkey", "content")


@query("SELECT o_orderkey AS file, CAST(o_orderkey % 50 AS INTEGER) AS number, CASE WHEN o_orderkey % 50 BETWEEN 1 AND 25 THEN 'page ' || (o_orderkey % 50) END AS page_number FROM orders")
def file_pages(spark, sf_dir):
    reels = spark.range(1, 26).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("reel_sequence_number"), F.concat(F.lit("page "), F.col("id").cast("string")).alias("page_number"))
    files = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("file"), (F.col("o_orderkey") % 50).alias("number"))
    return catalogue_xml.page_numbers(reels, files).select("file", "number", "page_number")


__all__ = ["ORACLE", "QUERIES"]
