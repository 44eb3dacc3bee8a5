"""Every registered query of the newspaper engine with its oracle SQL.

The page layouts are a deterministic view over ``lineitem``: an order is a page, a line a box.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import geometry as G
from .functions import spell
from .functions import text as T
from .operators import articles, association, evaluate, knn, lines, nms, reading_order, sampling, search, windows
from .operators.staging import small_side, staged
from .sources import catalogue_xml, sinks, tables
from .streaming import ingest

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
FLAGSHIP = "headline_assoc"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LAYOUT = """WITH b AS (
  SELECT l_orderkey AS scan_id,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
              l_extendedprice, l_discount, l_tax, l_shipdate) - 1 AS INT) AS id,
         CASE l_returnflag WHEN 'A' THEN 'article' WHEN 'N' THEN 'headline' ELSE 'author' END AS class,
         CAST((l_partkey * 37) % 800 AS INT) AS x0, CAST((l_suppkey * 53 + l_linenumber * 97) % 1000 AS INT) AS y0,
         CAST(100 + l_quantity * 4 AS INT) AS w, CAST(30 + l_quantity * 3 AS INT) AS h,
         CAST(round(l_discount * 1000) AS INT) + CAST(l_quantity AS INT) AS conf
  FROM lineitem),
lay AS (SELECT *, x0 + w AS x1, y0 + h AS y1 FROM b),
pg AS (SELECT *, max(x1) OVER (PARTITION BY scan_id) AS page_w, max(y1) OVER (PARTITION BY scan_id) AS page_h FROM lay)
"""


def layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    # By the page's own name, so that what is done by page next finds the rows where this window has put them.
    order = Window.partitionBy("scan_id").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    flag = F.when(F.col("l_returnflag") == "A", "article").when(F.col("l_returnflag") == "N", "headline").otherwise("author")
    b = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "scan_id").select(
        "scan_id", (F.row_number().over(order) - 1).cast("int").alias("id"), flag.alias("class"),
        F.expr("CAST((l_partkey * 37) % 800 AS INT)").alias("x0"), F.expr("CAST((l_suppkey * 53 + l_linenumber * 97) % 1000 AS INT)").alias("y0"),
        F.expr("CAST(100 + l_quantity * 4 AS INT)").alias("w"), F.expr("CAST(30 + l_quantity * 3 AS INT)").alias("h"),
        F.expr("CAST(round(l_discount * 1000) AS INT) + CAST(l_quantity AS INT)").alias("conf"))
    return b.withColumn("x1", F.col("x0") + F.col("w")).withColumn("y1", F.col("y0") + F.col("h"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return association.with_page_extent(layout(spark, sf_dir)).withColumn("pos", F.col("id"))


# Keyword queries -------------------------------------------------------------------------------
@query("SELECT doc_id FROM documents WHERE contains(text, 'and')")
def kw_single(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("text").contains("and")).select("doc_id")


@query("SELECT doc_id, CAST(pos AS BIGINT) AS pos FROM (SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents ORDER BY doc_id LIMIT 10) WHERE contains(text, 'and')")
def kw_first_rows(spark, sf_dir):
    hits = search.first_matches(table(spark, sf_dir, "documents"), "and", 10, ["doc_id"], "text")
    return hits.select("doc_id", F.col("pos").cast("long").alias("pos"))


@query("SELECT doc_id, source FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'and')")
def kw_cooccur(spark, sf_dir):
    return search.cooccurrence(table(spark, sf_dir, "documents"), "the", "And", text="text").select("doc_id", "source")


@query("SELECT lang, source, count(*) AS n FROM documents WHERE contains(lower(text), 'the') AND contains(lower(text), 'and') GROUP BY lang, source")
def kw_freq_by_group(spark, sf_dir):
    return search.frequency(search.cooccurrence(table(spark, sf_dir, "documents"), "the", "and", text="text"), "lang", "source")


@query("SELECT CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1")
def kw_freq_by_date(spark, sf_dir):
    return search.frequency(table(spark, sf_dir, "events"), F.to_date("ts").alias("date"))


@query("SELECT year(o_orderdate) AS year, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1995, 1997) GROUP BY 1")
def year_subset(spark, sf_dir):
    y = F.year("o_orderdate")
    return table(spark, sf_dir, "orders").where(y.isin(1995, 1997)).groupBy(y.cast("long").alias("year")).agg(F.count("*").alias("n"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_explode(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT conv_id, turn, role FROM conversations WHERE split_part(CAST(conv_id AS VARCHAR) || '.' || turn, '.', 1) = '7'")
def lookup_by_id(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return c.where(T.article_key(F.concat_ws(".", "conv_id", "turn")) == "7").select("conv_id", "turn", "role")


@query("SELECT a.conv_id, a.turn, b.turn AS other FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn <> b.turn")
def co_printed(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    return search.co_printed(c, "conv_id", "turn").select("conv_id", "turn", "other")


@query("SELECT scan, CAST(len(arts) AS BIGINT) AS n FROM (SELECT conv_id AS scan, list(text) AS arts FROM conversations GROUP BY conv_id) WHERE scan = 7")
def page_of_article(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    a = F.struct(F.concat(F.col("conv_id").cast("string"), F.lit("."), F.col("turn").cast("string"), F.lit(".json")).alias("id"), "text")
    scans = c.groupBy(F.col("conv_id").alias("scan")).agg(F.collect_list(a).alias("full_articles"))
    return search.page_of_article(scans, "7.json", "scan").groupBy("scan").agg(F.count("*").alias("n"))


@query("SELECT a.conv_id, a.role, count(*) AS n FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.role = b.role AND a.turn <> b.turn GROUP BY 1, 2")
def edition_mates(spark, sf_dir):
    m = search.edition_mates(table(spark, sf_dir, "conversations"), ["conv_id", "role"], "turn")
    return m.groupBy("conv_id", "role").agg(F.count("*").alias("n"))


# Lookups ---------------------------------------------------------------------------------------
@query("SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'NA') AS legibility FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def left_lookup_default(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels")
    return d.join(l, "doc_id", "left").select("doc_id", F.coalesce(F.col("quality").cast("string"), F.lit("NA")).alias("legibility"))


@query("SELECT vec_id, coalesce(name, CAST(label AS VARCHAR)) AS class FROM embeddings LEFT JOIN (VALUES (0, 'article'), (1, 'author'), (3, 'headline')) AS m(cls, name) ON label = cls")
def label_passthrough(spark, sf_dir):
    names = spark.createDataFrame([(0, "article"), (1, "author"), (3, "headline")], "cls int, name string")
    return tables.named_classes(table(spark, sf_dir, "embeddings").select("vec_id", "label"), names, "label").select("vec_id", "class")


# Association -----------------------------------------------------------------------------------
_ASSOC = LAYOUT + """, c AS (SELECT h.scan_id, h.id, arg_min(a.id, (a.y0, a.id)) + 1 AS fa FROM pg h JOIN pg a ON h.scan_id = a.scan_id AND h.class = '{cls}' AND a.class = 'article'
  AND (least(h.x1, a.x1) - greatest(h.x0, a.x0)) * 100 > h.page_w AND (h.y1 - a.y0) * 50 < h.page_h {gap} GROUP BY 1, 2)
SELECT pg.scan_id, pg.id, c.fa AS full_article_id FROM pg LEFT JOIN c ON pg.scan_id = c.scan_id AND pg.id = c.id WHERE pg.class = '{cls}'"""
_GAP = "AND (a.y0 - h.y1) * 10 < h.page_h"


@query(_ASSOC.format(cls="headline", gap=_GAP))
def headline_assoc(spark, sf_dir):
    return association.associate(pages(spark, sf_dir), "headline")


@query(_ASSOC.format(cls="author", gap=""))
def byline_assoc(spark, sf_dir):
    return association.associate(pages(spark, sf_dir), "author")


@query(LAYOUT + """SELECT scan_id, id FROM pg h WHERE class = 'headline' AND EXISTS (SELECT 1 FROM pg p WHERE p.scan_id = h.scan_id AND p.class = 'author'
  AND (least(h.x1, p.x1) - greatest(h.x0, p.x0)) * 100 > h.page_w AND (h.y1 - p.y0) * 50 < h.page_h AND (p.y0 - h.y1) * 10 < h.page_h)""")
def above_ad_semi(spark, sf_dir):
    p = pages(spark, sf_dir).withColumn("class", F.when(F.col("class") == "author", "photograph").otherwise(F.col("class")))
    return association.above_pictures(p).select("scan_id", "id")


_INTERVAL = """, m AS (SELECT h.scan_id, h.id AS h_id, h.k, h.y1 AS h_y1, a.id, a.class FROM
  (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY x1, y1, id) - 1 AS k FROM lay WHERE class = 'headline') h
  JOIN lay a ON h.scan_id = a.scan_id AND a.class IN ('article', 'author') AND (
    (h.x0 * 10 + a.w > a.x0 * 10 AND h.x0 * 10 + a.w < a.x1 * 10) OR (h.x1 * 10 - a.w > a.x0 * 10 AND h.x1 * 10 - a.w < a.x1 * 10)
    OR (a.x0 * 10 + a.w > h.x0 * 10 AND a.x0 * 10 + a.w < h.x1 * 10) OR (a.x1 * 10 - a.w > h.x0 * 10 AND a.x1 * 10 - a.w < h.x1 * 10))
  AND CASE WHEN a.class = 'article' THEN h.y1 <= a.y1 ELSE (h.y0 > a.y0 AND h.y0 < a.y1) OR (h.y1 > a.y0 AND h.y1 < a.y1)
    OR (h.y0 - a.h > a.y0 AND h.y0 - a.h < a.y1) OR (h.y1 + a.h > a.y0 AND h.y1 + a.h < a.y1) END)"""


@query(LAYOUT + _INTERVAL + "SELECT scan_id, h_id, CAST(k AS INTEGER) AS k, id FROM m WHERE class = 'article'")
def interval_overlap_join(spark, sf_dir):
    return association.interval_matches(layout(spark, sf_dir)).select("scan_id", "h_id", "k", "id")


@query(LAYOUT + _INTERVAL + """, r AS (SELECT *, row_number() OVER (PARTITION BY scan_id, id ORDER BY h_y1 DESC, k) AS r FROM m WHERE class = 'article'),
a AS (SELECT scan_id, id, max(CASE WHEN r = 1 THEN k END) AS k, max(CASE WHEN r = 2 THEN k END) AS k2 FROM r WHERE r <= 2 GROUP BY 1, 2),
h AS (SELECT DISTINCT scan_id, h_id AS id, k FROM m WHERE class = 'article'), u AS (SELECT scan_id, id, min(k) AS k FROM m WHERE class = 'author' GROUP BY 1, 2),
held AS (SELECT scan_id, k FROM (SELECT scan_id, k FROM h UNION ALL SELECT scan_id, k FROM a UNION ALL SELECT scan_id, k FROM u) GROUP BY 1, 2 HAVING count(*) = 1),
mv AS (SELECT a.scan_id, a.k2, min(a.k) AS dest FROM a JOIN held ON a.scan_id = held.scan_id AND a.k2 = held.k GROUP BY 1, 2),
keys AS (SELECT h.scan_id, h.id, coalesce(dest, h.k) AS k FROM h LEFT JOIN mv ON h.scan_id = mv.scan_id AND h.k = mv.k2 UNION ALL SELECT scan_id, id, k FROM a UNION ALL SELECT scan_id, id, k FROM u)
SELECT lay.scan_id, lay.id, lay.class, CAST(keys.k AS INTEGER) AS k FROM lay LEFT JOIN keys ON lay.scan_id = keys.scan_id AND lay.id = keys.id""")
def headline_second_lowest(spark, sf_dir):
    return association.interval_association(layout(spark, sf_dir)).select("scan_id", "id", "class", "k")


# Reading order and articles --------------------------------------------------------------------
_ORDERED = LAYOUT + """, f AS (SELECT *, id + 1 AS fa FROM pg WHERE class = 'article' UNION ALL
  SELECT h.*, c.fa FROM pg h JOIN (SELECT h.scan_id, h.id, arg_min(a.id, (a.y0, a.id)) + 1 AS fa FROM pg h JOIN pg a ON h.scan_id = a.scan_id AND h.class <> 'article' AND a.class = 'article'
    AND (least(h.x1, a.x1) - greatest(h.x0, a.x0)) * 100 > h.page_w AND (h.y1 - a.y0) * 50 < h.page_h AND (h.class = 'author' OR (a.y0 - h.y1) * 10 < h.page_h) GROUP BY 1, 2) c
  ON h.scan_id = c.scan_id AND h.id = c.id),
o AS (SELECT *, CASE WHEN class = 'article' THEN 0 ELSE row_number() OVER w - 1 - count(*) OVER (PARTITION BY scan_id, fa, class = 'article') END AS ro FROM f
  WINDOW w AS (PARTITION BY scan_id, fa, class = 'article' ORDER BY y0, id))
"""


def _with_text(boxes: DataFrame) -> DataFrame:
    return boxes.withColumn("raw_text", F.concat_ws("-", "class", F.col("id").cast("string")))


@query(_ORDERED + """SELECT scan_id, fa AS full_article_id, string_agg(CAST(id AS VARCHAR), ',' ORDER BY ro, id) AS ids,
  coalesce(string_agg(class || '-' || id, chr(10) || chr(10) ORDER BY ro, id) FILTER (WHERE class = 'headline'), '') AS headline,
  coalesce(string_agg(class || '-' || id, chr(10) || chr(10) ORDER BY ro, id) FILTER (WHERE class = 'article'), '') AS article,
  coalesce(string_agg(class || '-' || id, chr(10) || chr(10) ORDER BY ro, id) FILTER (WHERE class = 'author'), '') AS byline,
  min(x0) AS bx0, min(y0) AS by0, max(x1) AS bx1, max(y1) AS by1, fa || '_' || scan_id AS id FROM o GROUP BY scan_id, fa""")
def full_article(spark, sf_dir):
    own = association.article_ids(pages(spark, sf_dir)).where("full_article_id IS NOT NULL")
    # Every article is its own here, so no group has several article boxes and 0 is their place.
    lead = reading_order.with_lead_order(own, ("scan_id", "full_article_id"))
    ordered = lead.withColumn("reading_order_id", F.coalesce("reading_order_id", F.lit(0)))
    a = articles.assemble(_with_text(ordered))
    return a.select("scan_id", "full_article_id", F.array_join(F.transform("object_ids", lambda i: i.cast("string")), ",").alias("ids"), "headline", "article", "byline",
                    *[F.col("bbox")[i].alias(n) for i, n in enumerate(("bx0", "by0", "bx1", "by1"))], "id")


@query(_ORDERED + "SELECT scan_id, fa AS full_article_id, id, CAST(ro AS INTEGER) AS reading_order_id FROM o WHERE class <> 'article'")
def reading_order_headlines(spark, sf_dir):
    own = association.article_ids(pages(spark, sf_dir)).where("full_article_id IS NOT NULL")
    return reading_order.lead_order(own, ("scan_id", "full_article_id"))


@query()
def reading_order_columns(spark, sf_dir):
    return reading_order.column_order(layout(spark, sf_dir))


@query()
def reading_order_rows(spark, sf_dir):
    return reading_order.row_order(layout(spark, sf_dir))


@query(LAYOUT + "SELECT DISTINCT scan_id, page_w, page_h FROM pg")
def page_extent(spark, sf_dir):
    return layout(spark, sf_dir).groupBy("scan_id").agg(F.max("x1").alias("page_w"), F.max("y1").alias("page_h"))


@query(_ORDERED + "SELECT scan_id, fa AS full_article_id, 0 + CAST(count(*) AS BIGINT) AS boxes FROM o GROUP BY 1, 2 HAVING count(*) = 1")
def singleton_articles(spark, sf_dir):
    own = association.article_ids(pages(spark, sf_dir)).where("full_article_id IS NOT NULL")
    return evaluate.singletons(own, ["scan_id", "full_article_id"]).withColumnRenamed("n", "boxes")


# Boxes -----------------------------------------------------------------------------------------
_WORDS = "(SELECT * FROM lay WHERE class = 'headline') w", "(SELECT * FROM lay WHERE class = 'author') c"
_MEET = "w.scan_id = c.scan_id AND w.x0 < c.x1 AND c.x0 < w.x1 AND w.y0 < c.y1 AND c.y0 < w.y1"


def _words_chars(spark, sf_dir):
    b = layout(spark, sf_dir).withColumnRenamed("scan_id", "line_id")
    return b.where("class = 'headline'").withColumnRenamed("id", "word_id"), b.where("class = 'author'").withColumnRenamed("id", "char_id")


@query(LAYOUT + f"SELECT w.scan_id AS line_id, w.id AS word_id, c.id AS char_id FROM {_WORDS[0]} JOIN {_WORDS[1]} ON {_MEET}")
def box_overlap_join(spark, sf_dir):
    w, c = _words_chars(spark, sf_dir)
    w = w.select("line_id", "word_id", *[F.col(k).alias(f"w_{k}") for k in ("x0", "y0", "x1", "y1")])
    hit = G.overlaps(G.box("w_x0", "w_y0", "w_x1", "w_y1"), G.box())
    return w.join(c, "line_id").where(hit).select("line_id", "word_id", "char_id")


@query(LAYOUT + f"""SELECT w.scan_id AS line_id, w.id AS word_id, list_sort(list(c.x0 * 1000 + c.cid)) [1] AS first_char, CAST(count(*) AS INTEGER) AS n FROM {_WORDS[0]} JOIN (
  SELECT scan_id, x0, y0, x1, y1, id AS cid FROM {_WORDS[1]} UNION ALL SELECT w.scan_id, w.x0, w.y0, w.x1, w.y1, w.id FROM {_WORDS[0]} WHERE NOT EXISTS (SELECT 1 FROM {_WORDS[1]} WHERE {_MEET})) c
  ON {_MEET} GROUP BY 1, 2""")
def owned_chars(spark, sf_dir):
    o = lines.owned_chars(*_words_chars(spark, sf_dir))
    return o.select("line_id", "word_id", F.array_min(F.transform("chars", lambda c: c["x0"] * 1000 + c["char_id"])).alias("first_char"), F.size("chars").alias("n"))


@query(LAYOUT + f"SELECT w.scan_id AS line_id, w.id AS word_id FROM {_WORDS[0]} WHERE NOT EXISTS (SELECT 1 FROM {_WORDS[1]} WHERE {_MEET})")
def uncovered_words(spark, sf_dir):
    w, _ = _words_chars(spark, sf_dir)
    return w.join(box_overlap_join(spark, sf_dir), ["line_id", "word_id"], "left_anti").select("line_id", "word_id")


@query(LAYOUT + f""", c AS (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY x0, id) - 1 AS ci FROM lay WHERE class = 'author'),
w AS (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY x0, id) - 1 AS wi FROM lay WHERE class = 'headline'),
f AS (SELECT w.scan_id, w.id, w.wi, arg_min(c.ci, (c.x1 - w.x0, c.ci)) FILTER (WHERE c.x1 > w.x0) AS ci FROM w LEFT JOIN c ON w.scan_id = c.scan_id GROUP BY 1, 2, 3)
SELECT scan_id AS line_id, id AS word_id, CAST(wi AS INTEGER) AS word_idx, CAST(coalesce(last_value(ci IGNORE NULLS) OVER (PARTITION BY scan_id ORDER BY wi ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS INTEGER) AS char_idx FROM f""")
def nearest_right(spark, sf_dir):
    return lines.word_starts(*_words_chars(spark, sf_dir))


@query(LAYOUT + """SELECT a.scan_id, a.id AS a, b.id AS b, round(i::DOUBLE / (a.w * a.h + b.w * b.h - i::DOUBLE + 1e-7::DOUBLE), 6) AS iou FROM lay a JOIN lay b ON a.scan_id = b.scan_id AND a.id < b.id,
  LATERAL (SELECT greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)) AS i) WHERE i > 0""")
def iou_pairs(spark, sf_dir):
    a, b = layout(spark, sf_dir).alias("a"), layout(spark, sf_dir).alias("b")
    ba, bb = (G.box(*[F.col(f"{s}.{k}") for k in ("x0", "y0", "x1", "y1")]) for s in "ab")
    pairs = a.join(b, (F.col("a.scan_id") == F.col("b.scan_id")) & (F.col("a.id") < F.col("b.id")))
    return pairs.where(G.intersection(ba, bb) > 0).select("a.scan_id", F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.round(G.iou(ba, bb), 6).alias("iou"))


@query(LAYOUT.replace("WITH b", "WITH RECURSIVE b", 1) + """, s AS (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY conf DESC, id) - 1 AS r FROM lay),
pr AS (SELECT a.scan_id, a.r AS ra, b.r AS rb FROM s a JOIN s b ON a.scan_id = b.scan_id AND a.r < b.r, LATERAL (SELECT (greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0)))::DOUBLE AS i)
  WHERE i > 0.45::DOUBLE * (a.w * a.h + b.w * b.h - i + 1e-7::DOUBLE)),
hit AS (SELECT scan_id, rb, list(ra) AS above FROM pr GROUP BY 1, 2),
kept AS (SELECT scan_id, 0::BIGINT AS r, [0::BIGINT] AS ks FROM (SELECT DISTINCT scan_id FROM s) UNION ALL
  SELECT k.scan_id, k.r + 1, CASE WHEN h.above IS NOT NULL AND len(list_intersect(h.above, k.ks)) > 0 THEN k.ks ELSE list_append(k.ks, k.r + 1) END
  FROM kept k JOIN s ON s.scan_id = k.scan_id AND s.r = k.r + 1 LEFT JOIN hit h ON h.scan_id = k.scan_id AND h.rb = k.r + 1),
fin AS (SELECT scan_id, unnest(arg_max(ks, r)) AS r FROM kept GROUP BY scan_id)
SELECT s.scan_id, s.id AS det, CAST(row_number() OVER (PARTITION BY s.scan_id ORDER BY s.r) - 1 AS INTEGER) AS rank FROM fin JOIN s ON fin.scan_id = s.scan_id AND fin.r = s.r""")
def nms_boxes(spark, sf_dir):
    d = layout(spark, sf_dir).withColumn("cls", F.lit(0)).withColumnRenamed("id", "det")
    return nms.suppress(d, ["scan_id"], 0.45, conf=-1).select("scan_id", "det", "rank")


@query(LAYOUT + "SELECT scan_id, id AS det, r AS rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY scan_id ORDER BY conf DESC, id) AS INTEGER) AS r FROM lay) WHERE r <= 2")
def conf_topk(spark, sf_dir):
    return nms.top_by_confidence(layout(spark, sf_dir).withColumnRenamed("id", "det"), ["scan_id"], 2).select("scan_id", "det", "rank")


@query(LAYOUT + "SELECT scan_id, id, (x0 + x1) / 2.0::DOUBLE AS x, (y0 + y1) / 2.0::DOUBLE AS y, w, h, least(x0 + w, 600) AS cx1, least(y1, 700) AS cy1 FROM lay")
def box_convert(spark, sf_dir):
    c, k = G.xyxy_to_xywh(G.box()), G.clip_box(G.box(), F.lit(600), F.lit(700))
    return layout(spark, sf_dir).select("scan_id", "id", c["x"].alias("x"), c["y"].alias("y"), c["w"].alias("w"), c["h"].alias("h"), k["x1"].cast("int").alias("cx1"), k["y1"].cast("int").alias("cy1"))


@query(LAYOUT + """SELECT scan_id, id, CAST(floor(x0 * g / 1280.0::DOUBLE - (g - page_w) / 2.0::DOUBLE) AS INTEGER) AS sx0, CAST(floor(y0 * g / 1280.0::DOUBLE - (g - page_h) / 2.0::DOUBLE) AS INTEGER) AS sy0,
  CAST(ceil(x1 * g / 1280.0::DOUBLE - (g - page_w) / 2.0::DOUBLE) AS INTEGER) AS sx1, CAST(ceil(y1 * g / 1280.0::DOUBLE - (g - page_h) / 2.0::DOUBLE) AS INTEGER) AS sy1 FROM (SELECT *, greatest(page_w, page_h) AS g FROM pg)""")
def letterbox_inverse(spark, sf_dir):
    b = G.letterbox_inverse(G.box(), F.col("page_w"), F.col("page_h"), 1280)
    return pages(spark, sf_dir).select("scan_id", "id", *[b[k].alias(f"s{k}") for k in ("x0", "y0", "x1", "y1")])


@query(LAYOUT + """, t AS (SELECT scan_id, id, w AS cw, h * 4 AS ch, (w * 3) // 2 AS st FROM lay),
n AS (SELECT *, CASE WHEN ch > 2 * cw THEN len(list_filter(range(0, ch // st + 1), lambda i: i * st + 2 * cw <= ch)) ELSE 0 END AS n FROM t)
SELECT scan_id, id, CAST(c AS INTEGER) AS chunk, CAST(CASE WHEN n = 0 THEN 0 ELSE c * st END AS INTEGER) AS y0, CAST(CASE WHEN n = 0 OR c = n THEN ch ELSE c * st + 2 * cw END AS INTEGER) AS y1
FROM (SELECT *, unnest(range(0, n + 1)) AS c FROM n)""")
def tall_chunks(spark, sf_dir):
    c = layout(spark, sf_dir).select("scan_id", "id", F.explode(G.tall_chunks(F.col("w"), F.col("h") * 4)).alias("c"))
    return c.select("scan_id", "id", "c.chunk", "c.y0", "c.y1")


@query(LAYOUT + """, p AS (SELECT scan_id, id, 3 * lead(x0) OVER (PARTITION BY scan_id ORDER BY id) / nullif(avg(x0) OVER (PARTITION BY scan_id), 0)
  + coalesce((max(x1) OVER (PARTITION BY scan_id) - x1) / nullif(max(x1) OVER (PARTITION BY scan_id) - avg(x1) OVER (PARTITION BY scan_id), 0), 0) AS score FROM lay)
SELECT scan_id, id, coalesce(score > 5, false) AS break_after FROM p""")
def paragraph_breaks(spark, sf_dir):
    return lines.paragraph_scores(layout(spark, sf_dir), "scan_id", "id", "x0", "x1").select("scan_id", "id", "break_after")


# Runs, chunks, samples -------------------------------------------------------------------------
@query("""WITH a AS (SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM a),
c AS (SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS INTEGER) AS run_pos FROM b)
SELECT event_id, run_pos, CASE WHEN run_pos < 10 THEN '0' || run_pos ELSE CAST(run_pos AS VARCHAR) END AS page FROM c""")
def page_number_runs(spark, sf_dir):
    return windows.run_positions(table(spark, sf_dir, "events"), "event_type", ["ts", "event_id"], ["user_id"]).select("event_id", "run_pos", "page")


@query("SELECT doc_id, i AS idx, i // 100 AS chunk FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)")
def manifest_chunks(spark, sf_dir):
    c = windows.chunked(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"])
    return c.select("doc_id", F.col("idx").cast("long").alias("idx"), F.col("chunk").cast("long").alias("chunk"))


@query('SELECT source, i // 20 AS chunk, min(i) AS "start", max(i) + 1 AS "end" FROM (SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i FROM documents) GROUP BY 1, 2')
def chunk_index(spark, sf_dir):
    c = sinks.index_of_chunks(table(spark, sf_dir, "documents").select("doc_id", "source"), ["source"], ["doc_id"])
    return c.select("source", *[F.col(k).cast("long").alias(k) for k in ("chunk", "start", "end")])


@query("SELECT doc_id FROM documents ORDER BY doc_id LIMIT 25")
def first_n(spark, sf_dir):
    return windows.first_n(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], 25)


@query("SELECT p_partkey FROM (SELECT p_partkey, p_size, coalesce(sum(p_size) OVER (ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM part WHERE p_partkey >= 10) WHERE before < 4000")
def batches_up_to(spark, sf_dir):
    return catalogue_xml.batches_up_to(table(spark, sf_dir, "part"), "p_size", 10, 4000, "p_partkey").select("p_partkey")


@query("SELECT label, vec_id FROM (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings) WHERE r <= 5")
def m_per_class(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id")
    return sampling.m_per_class(e, "label", "vec_id", 5, seed=None).select("label", "vec_id")


@query("SELECT label, CAST(ceil(count(*) / 8.0) AS BIGINT) AS groups, CAST(ceil(count(*) / 8.0) * 8 AS BIGINT) AS slots, count(*) AS items FROM embeddings GROUP BY label")
def exhaustive_groups(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id")
    g = sampling.exhaustive_groups(e, "label", "vec_id", 8)
    return g.groupBy("label").agg(F.count_distinct("group").alias("groups"), F.count("*").alias("slots"), F.count_distinct("vec_id").alias("items"))


@query("SELECT 'good' AS a, 'toxic' AS b, count(*) AS n FROM (SELECT doc_id FROM labels WHERE quality = 1 INTERSECT SELECT doc_id FROM labels WHERE toxic = 1)")
def split_disjoint(spark, sf_dir):
    marks = table(spark, sf_dir, "labels")
    a, b = marks.where("quality = 1").select("doc_id"), marks.where("toxic = 1").select("doc_id")
    return a.intersect(b).agg(F.count("*").alias("n")).select(F.lit("good").alias("a"), F.lit("toxic").alias("b"), "n")


@query(LAYOUT + "SELECT scan_id, id, class FROM lay WHERE class = 'article' UNION ALL SELECT scan_id, id, class FROM lay WHERE class = 'headline'")
def union_boxes(spark, sf_dir):
    b = layout(spark, sf_dir).select("scan_id", "id", "class")
    return b.where("class = 'article'").unionByName(b.where("class = 'headline'"))


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def except_ids(spark, sf_dir):
    return sampling.remaining(table(spark, sf_dir, "documents").select("doc_id").distinct(), table(spark, sf_dir, "labels"), "doc_id")


# Vectors ---------------------------------------------------------------------------------------
_KNN = """WITH u AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
r AS (SELECT *, sqrt(list_inner_product(v, v)) AS norm, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM u),
p AS (SELECT q.vec_id AS query_id, r.vec_id AS ref_id, list_inner_product(q.v, r.v) / (q.norm * r.norm) AS sim FROM r q JOIN r ON r.n <= 5),
t AS (SELECT query_id, arg_max(ref_id, (sim, -ref_id)) AS ref_id, max(sim) AS sim FROM p GROUP BY 1) """


def _nearest(spark, sf_dir):
    """Every vector against a reference index of five samples of each class."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"), "label")
    refs = sampling.m_per_class(e, "label", "vec_id", 5, seed=None).select(F.col("vec_id").alias("ref_id"), F.col("label").cast("string").alias("label"), "vec").dropDuplicates(["ref_id"])
    return knn.nearest(e.select(F.col("vec_id").alias("query_id"), "vec"), refs)


@query(_KNN + "SELECT query_id, ref_id, round(sim, 4) AS sim FROM t")
def knn_top1(spark, sf_dir):
    return _nearest(spark, sf_dir).select("query_id", "ref_id", F.round("sim", 4).alias("sim"))


@query(_KNN + "SELECT query_id, CASE WHEN sim > 0.4 THEN 'word' ELSE 'char' END AS level FROM t")
def threshold_fallback(spark, sf_dir):
    found = _nearest(spark, sf_dir)
    return knn.with_fallback(found, found.select("query_id", F.lit("c").alias("label")), 0.4).select("query_id", "level")


@query("SELECT label, CAST(dim AS INTEGER) AS dim, round(avg(x::DOUBLE), 6) AS x FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings) GROUP BY 1, 2")
def class_centroid(spark, sf_dir):
    p = knn.pooled(table(spark, sf_dir, "embeddings"), "label", "embedding")
    return p.select("label", F.posexplode("embedding").alias("dim", "x")).select("label", "dim", F.round("x", 6).alias("x"))


@query("SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS dim FROM embeddings")
def argmax_dim(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", G.argmax(F.col("embedding")).alias("dim"))


# Texts -----------------------------------------------------------------------------------------
_PUNCT = ',.?!$%&():;-"'
_TOKENS = f"SELECT doc_id, unnest(string_split_regex(translate(lower(text), '{_PUNCT}', ''), '[ \\t\\n\\r\\f\\v]+')) AS term FROM documents"


@query(f"SELECT term, count(*) AS freq FROM ({_TOKENS}) WHERE term <> '' GROUP BY term")
def tokens_wordfreq(spark, sf_dir):
    return spell.word_frequencies(table(spark, sf_dir, "documents"))


@query(f"""WITH t AS ({_TOKENS}), d AS (SELECT term FROM t WHERE term <> '' GROUP BY term HAVING count(*) >= 5)
SELECT doc_id, round(count(*) FILTER (WHERE d.term IS NULL)::DOUBLE / nullif(count(*), 0)::DOUBLE, 6) AS share FROM t LEFT JOIN d ON t.term = d.term WHERE t.term <> '' GROUP BY doc_id""")
def nonword_rate(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    known = spell.word_frequencies(d).where("freq >= 5")
    rate = articles.nonword_share(d, known, ["doc_id"], "text").where("nonword_share IS NOT NULL")
    return rate.select("doc_id", F.round("nonword_share", 6).alias("share"))


@query(f"SELECT doc_id, md5(translate(text, '{_PUNCT}', '')) AS plain, length(translate(text, '{_PUNCT}', '')) AS n FROM documents")
def depunctuate(spark, sf_dir):
    p = T.depunctuate(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(p.cast("binary")).alias("plain"), F.length(p).cast("long").alias("n"))


@query("SELECT doc_id, md5(regexp_replace(text, '“|”|''''|‘‘|’’', '\"', 'g')) AS clean FROM documents")
def clean_quotes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(T.clean_quotes(F.col("text")).cast("binary")).alias("clean"))


@query("""SELECT doc_id, count(*) FILTER (WHERE right(p, 1) IN ('.', '!', '?') AND p <> '') AS after_end FROM (SELECT doc_id, w, lag(w) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM
  (SELECT doc_id, unnest(string_split(text, ' ')) AS w, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents)) GROUP BY doc_id""")
def caps_after_period(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.split("text", " ").alias("w"))  # split once, not per word
    hits = F.filter("w", lambda x, i: F.coalesce((i > 0) & F.get("w", i - 1).rlike(r"[.!?]\z"), F.lit(False)))
    return d.select("doc_id", F.size(hits).cast("long").alias("after_end"))


@query("SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines FROM documents")
def line_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("n_lines"))


@query("SELECT doc_id, t, regexp_matches(t, '^\\p{Nd}+$') AS is_number, regexp_matches(w, '^\\p{Lu}\\.$') AS is_initial, ((lower(w) = w AND upper(w) <> w) OR contains('!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~', w)) AS isnt_cap, regexp_matches(w, '^\\p{Lu}*$') AS all_caps FROM (SELECT doc_id, w, translate(w, '" + _PUNCT + "', '') AS t FROM (SELECT doc_id, unnest(list_distinct(string_split(text, ' '))) AS w FROM documents))")
def token_kinds(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(F.split("text", " "))).alias("w"))
    w = F.col("w")
    return d.select("doc_id", T.depunctuate(w).alias("t"), T.is_number(w).alias("is_number"), T.is_initial(w).alias("is_initial"), T.isnt_capital(w).alias("isnt_cap"), T.all_capitals(w).alias("all_caps"))


@query("SELECT page_id, unnest(regexp_extract_all(html, '<a\\s+href=\"([^\"]*)\"', 1)) AS link FROM pages")
def html_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(catalogue_xml.html_links(F.col("html"))).alias("link"))


@query("SELECT page_id, array_to_string(list_slice(string_split(url, '/'), greatest(len(string_split(url, '/')) - 3, 1), len(string_split(url, '/'))), '_') AS name FROM pages")
def url_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.path_tail(F.col("url")).alias("name"))


@query("SELECT p_partkey, p_name AS name, p_brand AS city, p_type AS state, '1900-01-01' AS date FROM part")
def title_parse(spark, sf_dir):
    t = T.title_parts(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(", "), "p_type", F.lit("), 1900-01-01")))
    return table(spark, sf_dir, "part").select("p_partkey", t.alias("t")).select("p_partkey", "t.name", "t.city", "t.state", "t.date")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || '/ed-1' AS edition, CAST(o_orderdate AS DATE) AS date FROM orders")
def edition_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("d"))
    return o.select("o_orderkey", T.edition_id(F.col("d")).alias("edition"), T.edition_parts(F.concat("d", F.lit("01")))["date"].alias("date"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n, min(l_partkey) AS c FROM lineitem GROUP BY 1, 2")
def yolo_lines(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    y = T.yolo_line(F.concat_ws(" ", F.col("l_partkey").cast("string"), F.lit("0.5 0.5 0.1 0.1")))
    return li.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"), F.min(y["c"]).cast("long").alias("c"))


@query("""WITH a AS (SELECT regexp_replace(text, '[^\\x01-\\x7F]', '', 'g') AS t FROM conversations),
p AS (SELECT t AS raw, trim(replace(t, '''''', '"'), ' ') AS g, trim(replace(replace(translate(t, 'ae', 'oi'), 'th', 't'), '''''', '"'), ' ') AS p FROM a)
SELECT count(*) AS n, round(100.0::DOUBLE * count(*) FILTER (WHERE g = p) / count(*), 6) AS accuracy, round(sum(levenshtein(g, p))::DOUBLE / sum(length(raw))::DOUBLE, 6) AS cer FROM p""")
def cer_eval(spark, sf_dir):
    a = F.regexp_replace("text", r"[^\x01-\x7F]", "")
    pairs = table(spark, sf_dir, "conversations").select(a.alias("gold"), F.replace(F.translate(a, "ae", "oi"), F.lit("th"), F.lit("t")).alias("pred"))
    s = evaluate.text_scores(pairs)
    return s.select("n", F.round("accuracy", 6).alias("accuracy"), F.round("cer", 6).alias("cer"))


_EDGES = LAYOUT + _INTERVAL + f""", c AS (SELECT h.scan_id, h.id, arg_min(a.id, (a.y0, a.id)) AS a_id FROM pg h JOIN pg a ON h.scan_id = a.scan_id AND h.class = 'headline' AND a.class = 'article'
  AND (least(h.x1, a.x1) - greatest(h.x0, a.x0)) * 100 > h.page_w AND (h.y1 - a.y0) * 50 < h.page_h {_GAP} GROUP BY 1, 2),
g AS (SELECT DISTINCT scan_id, least(h_id, id) AS a, greatest(h_id, id) AS b FROM m WHERE class = 'article'),
p AS (SELECT DISTINCT scan_id, least(id, a_id) AS a, greatest(id, a_id) AS b FROM c WHERE scan_id IN (SELECT scan_id FROM g)),
t AS (SELECT (SELECT count(*) FROM p SEMI JOIN g USING (scan_id, a, b)) AS tp, (SELECT count(*) FROM p ANTI JOIN g USING (scan_id, a, b)) AS fp, (SELECT count(*) FROM g ANTI JOIN p USING (scan_id, a, b)) AS fn)
SELECT tp, fp, fn, round(100.0::DOUBLE * tp / (tp + fp), 1) AS precision, round(100.0::DOUBLE * tp / (tp + fn), 1) AS recall, round(2.0::DOUBLE * (100.0::DOUBLE * tp / (tp + fp)) * (100.0::DOUBLE * tp / (tp + fn)) / ((100.0::DOUBLE * tp / (tp + fp)) + (100.0::DOUBLE * tp / (tp + fn))), 1) AS f1 FROM t"""


@query(_EDGES)
def edge_prf(spark, sf_dir):
    """The association by distance, held against the association by padded intervals."""
    found = association.associate(pages(spark, sf_dir), "headline").where("full_article_id IS NOT NULL")
    gold = association.interval_matches(layout(spark, sf_dir))
    return evaluate.edge_scores(found.select("scan_id", F.col("id").alias("a"), (F.col("full_article_id") - 1).alias("b")), gold.select("scan_id", F.col("h_id").alias("a"), F.col("id").alias("b")), ["scan_id"])


@query(LAYOUT + "SELECT scan_id, CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS edges FROM lay GROUP BY 1 HAVING count(*) > 1")
def cluster_edges(spark, sf_dir):
    e = evaluate.edges_of_clusters(layout(spark, sf_dir), ["scan_id"], "id")
    return e.groupBy("scan_id").agg(F.count("*").alias("edges"))


@query("SELECT doc_id AS node, min(doc_id) OVER (PARTITION BY text) AS root FROM documents QUALIFY count(*) OVER (PARTITION BY text) > 1")
def clusters(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("t"))
    star = d.join(d.groupBy("t").agg(F.min("doc_id").alias("a")), "t").where("doc_id <> a")
    return evaluate.clusters_of_edges(star, "a", "doc_id")


@query("SELECT l_partkey, count(DISTINCT l_orderkey) AS images FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_orderkey) > 1")
def multi_page_labels(spark, sf_dir):
    return evaluate.labels_on_several(table(spark, sf_dir, "lineitem"), "l_partkey", "l_orderkey")


@query(LAYOUT + "SELECT scan_id, count(*) AS boxes FROM lay WHERE class = 'article' GROUP BY 1 HAVING count(*) > 1")
def multi_box_articles(spark, sf_dir):
    return evaluate.multi_box_articles(layout(spark, sf_dir), ["scan_id"])


@query(LAYOUT + "SELECT n.scan_id, n.id FROM lay n WHERE NOT EXISTS (SELECT 1 FROM lay o WHERE o.scan_id = n.scan_id AND abs(o.x0 - n.x0) < 60 AND abs(o.y0 - n.y0) < 60 AND abs(o.w - n.w) < 60 AND abs(o.h - n.h) < 60 AND n.conf % 2 = 1 - o.conf % 2)")
def relabel_audit(spark, sf_dir):
    b = layout(spark, sf_dir).select(F.col("scan_id").alias("file"), "id", (F.col("conf") % 2).alias("c"), F.col("x0").alias("x"), F.col("y0").alias("y"), "w", "h")
    return evaluate.unflipped_lines(b, b, tolerance=60).select(F.col("file").alias("scan_id"), "id")


@query("SELECT event_id AS filename, 'parse' AS stage FROM events WHERE TRY_CAST(replace(event_type, 'click', '1') AS INTEGER) IS NULL")
def dead_letter(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("error", F.when(F.replace("event_type", F.lit("click"), F.lit("1")).try_cast("int").isNull(), "not a number"))
    _, bad = sinks.split_results(e)
    return bad.select(F.col("event_id").alias("filename"), F.lit("parse").alias("stage"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, sf_dir):
    return ingest.event_counts(table(spark, sf_dir, "events")).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


# Spelling and XML over constructed input -------------------------------------------------------
@query("SELECT doc_id, md5(regexp_replace(text, '[^A-Za-z \\n]+', '', 'g')) AS text FROM documents")
def alto_text(spark, sf_dir):
    word = lambda x: F.concat(F.lit('<alto:String ID="s" CONTENT="'), x, F.lit('"/>'))
    line = lambda x: F.concat(F.lit("<alto:TextLine>"), F.array_join(F.transform(F.split(x, " "), word), "<SP/>"), F.lit("</alto:TextLine>"))
    xml = F.array_join(F.transform(F.split(F.regexp_replace("text", "[^A-Za-z \n]+", ""), "\n"), line), "\n")  # the constructed page
    back = catalogue_xml.alto_text(table(spark, sf_dir, "documents").select("doc_id", xml.alias("xml")), keys=["doc_id"])
    return back.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text"))


def _spread(d: DataFrame) -> DataFrame:
    """Rows that take much work each: over all cores where the table has fewer parts, else as they lie."""
    cores = d.sparkSession.sparkContext.defaultParallelism
    return d if d.rdd.getNumPartitions() >= cores else d.repartition(cores)


@query()
def spelling(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    known = spell.word_frequencies(d).where("freq >= 40")
    texts = _spread(d.select("doc_id", F.col("text").alias("raw_text")))
    return spell.with_spell_checks(texts, known, distance=1).drop("raw_text")


@query()
def visual_spelling(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    known = spell.word_frequencies(d).where("freq >= 40")
    g = spell.homoglyphs(spark.createDataFrame([("o", "0", 0.9), ("l", "1", 0.8), ("s", "5", 0.6), ("e", "c", 0.5), ("h", "b", 0.2)], "a string, b string, sim_score double"))
    return spell.visual_check(_spread(d.select("doc_id", F.translate("text", "ol", "01").alias("raw_text"))), known, g).select("doc_id", "checked")


@query()
def postprocessed(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return spell.postprocess(_spread(d.select("doc_id", "text")), spell.word_frequencies(d).where("freq >= 40")).select("doc_id", "clean")


__all__ = ["FLAGSHIP", "ORACLE", "QUERIES", "small_side", "staged"]
