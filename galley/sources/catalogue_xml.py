"""Library catalogue records: RDF, METS, ALTO, HTML indexes and batch listings.

Documents are rows with an ``xml`` or ``html`` text.  Elements are matched by local name, so
namespace prefixes and their casing do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import batch_line_path, edition_id, pad_left, page_id, raw_location, title_parts, uri_tail, year_range
from ..operators.staging import small_side

L = "*[local-name()='%s']"


def _all(xml: str, path: str) -> Column:
    return F.xpath(F.col(xml), F.lit(path))


def _resources(xml: str, name: str) -> Column:
    return _all(xml, f"//*[local-name()='{name}']/@*[local-name()='resource']")


def _first(xml: str, path: str) -> Column:
    return F.nullif(F.trim(F.xpath_string(F.col(xml), F.lit(path))), F.lit(""))


def titles(docs: DataFrame, lccn: str = "lccn", xml: str = "xml", languages: DataFrame | None = None) -> DataFrame:
    """RDF of a title: name, places, ISSN, years, languages, predecessors, successors, editions.
    ``languages`` (code, name) is a small table of language names."""
    same = _resources(xml, "coverage")
    span = year_range(_first(xml, f"//{L % 'date'}"))
    tail = lambda c, n=1: F.transform(c, lambda u: uri_tail(u, n))
    out = docs.select(
        _first(xml, f"//{L % 'title'}").alias("title"),
        tail(F.filter(same, lambda u: u.contains("geonames"))).alias("geonames_ids"), tail(F.filter(same, lambda u: u.contains("dbpedia"))).alias("dbpedia_ids"),
        F.regexp_replace(_first(xml, f"//{L % 'sameAs'}/@*[contains(., 'issn')] | //{L % 'hasPart'}/@*[contains(., 'issn')]"), "^.*issn[:/]", "").alias("issn"),
        F.col(lccn).alias("lccn"), span["start"].alias("start_year"), span["end"].alias("end_year"),
        tail(F.concat(_resources(xml, "language"), _all(xml, f"//{L % 'language'}/text()"))).alias("languages"),
        F.transform(_resources(xml, "successorOf"), lambda u: F.split_part(uri_tail(u), F.lit("#"), F.lit(1))).alias("succeeds"),
        F.transform(_resources(xml, "successor"), lambda u: F.split_part(uri_tail(u), F.lit("#"), F.lit(1))).alias("successors"),
        tail2(F.filter(_resources(xml, "aggregates"), lambda u: u.contains("#issue"))).alias("editions"))
    if languages is None:
        return out
    names = out.select("lccn", F.explode("languages").alias("code")).join(small_side(languages), "code", "left").groupBy("lccn").agg(F.sort_array(F.collect_set(F.coalesce("name", "code"))).alias("languages"))
    return out.drop("languages").join(names, "lccn", "left")


def tail2(uris: Column) -> Column:
    """Last two parts of each URI, such as 1900-01-01/ed-1."""
    return F.transform(uris, lambda u: F.concat_ws("/", uri_tail(u, 2), uri_tail(u, 1)))


def editions(docs: DataFrame, lccn: str = "lccn", edition: str = "edition", xml: str = "xml") -> DataFrame:
    """RDF of an edition: its pages (none where the document is missing).  Edition ids are brought
    to YYYY-MM-DD/ed-N; rows with other ids are left out."""
    e = edition_id(F.col(edition))
    pages = F.coalesce(F.transform(_resources(xml, "aggregates"), lambda u: F.regexp_extract(u, r"(seq-\d+)", 1)), F.array().cast("array<string>"))
    return docs.where(e.isNotNull()).select(
        F.col(lccn).alias("lccn"), e.alias("edition"), F.coalesce(_first(xml, f"//{L % 'issued'}"), F.split_part(e, F.lit("/"), F.lit(1))).alias("date"),
        F.array_distinct(F.filter(pages, lambda p: p != "")).alias("pages"))


def pages(docs: DataFrame, lccn="lccn", date="date", edition="edition", page="page", xml: str = "xml") -> DataFrame:
    """RDF of a page: image, text and XML addresses by suffix, and where its raw data lies."""
    urls = _resources(xml, "aggregates")
    pick = lambda test: F.get(F.filter(urls, test), F.lit(0))
    iiif = pick(lambda u: u.contains("iiif"))
    return docs.where(page_id(F.col(page)).isNotNull()).select(
        lccn, edition, date, page_id(F.col(page)).alias("page"), pick(lambda u: u.endswith(".jp2")).alias("jp2_url"),
        pick(lambda u: u.endswith("ocr.txt") | u.endswith("/ocr/")).alias("ocr_text_url"), pick(lambda u: u.endswith("ocr.xml")).alias("ocr_xml_url"), raw_location(iiif).alias("raw_data_loc"))


def scans_on_date(title_rows: DataFrame, edition_rows: DataFrame, date: str) -> DataFrame:
    """(lccn, edition, page) of every page printed on a date."""
    e = title_rows.select("lccn", F.explode("editions").alias("edition")).where(F.col("edition").startswith(date))
    return e.join(edition_rows.select("lccn", "edition", F.explode("pages").alias("page")), ["lccn", "edition"])


def page_numbers(reels: DataFrame, files: DataFrame) -> DataFrame:
    """Files (file, number) with the page whose reel sequence number is the file's."""
    r = reels.select(F.col("reel_sequence_number").try_cast("int").alias("number"), "page_number").where("number IS NOT NULL")
    return files.withColumn("number", F.col("number").cast("int")).join(r, "number", "left")


def mets_manifest(docs: DataFrame, url: str = "url", xml: str = "xml", base: str = "") -> DataFrame:
    """METS of an edition to its manifest; page numbers map to records, the last one wins."""
    label = _first(xml, f"/{L % 'mets'}/@LABEL")
    t = title_parts(label)
    mods = lambda name, kind: _first(xml, f"//{L % name}[@type='{kind}']//{L % 'number'}")
    sect = f"//{L % 'dmdSec'}[starts-with(@ID, 'pageModsBib')]"
    field = lambda k: _all(xml, f"{sect}//{L % 'detail'}[@type='{k}']/{L % 'number'}/text()")
    d = docs.select(
        F.col(url).alias("paper_url"), t.alias("t"), _first(xml, f"//{L % 'identifier'}[@type='lccn']").alias("lccn"), mods("detail", "volume").alias("volume"),
        mods("detail", "issue").alias("issue"), mods("detail", "edition").alias("edition"), _first(xml, f"//{L % 'dateIssued'}").alias("issued"),
        field("page number").alias("numbers"), _all(xml, f"{sect}//{L % 'identifier'}[@type='reel number']/text()").alias("reels"),
        _all(xml, f"{sect}//{L % 'start'}/text()").alias("seqs"), service_files(F.col(xml)).alias("files"))
    n = F.size("numbers")
    folder = F.regexp_replace("paper_url", "[^/]*$", "")
    entry = lambda i: F.struct(F.get("numbers", i).alias("key"), F.struct(
        F.get("numbers", i).alias("page_number"), F.concat(F.lit(base), folder, F.get("files", i)).alias("page_url"),
        F.concat(F.lit(base), folder, F.regexp_replace(F.get("files", i), r"\.jp2$", ".xml")).alias("page_ocr"), F.get("reels", i).alias("reel_number"),
        pad_left(F.get("seqs", i), 4).alias("reel_sequence_number")).alias("value"))
    each = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), entry))
    last = F.filter(each, lambda e, i: F.size(F.filter(F.slice(each, i + 2, n), lambda o: o["key"] == e["key"])) == 0)
    return d.select(
        F.col("t.name").alias("paper_name"), F.coalesce("issued", "t.date").alias("paper_date"), F.col("t.city").alias("paper_city"), F.col("t.state").alias("paper_state"),
        "paper_url", "lccn", "volume", "issue", "edition", F.map_from_entries(last).alias("pages"))


def service_files(xml: Column) -> Column:
    """Service file names of a METS file section, without a leading ./"""
    names = F.xpath(xml, F.lit(f"//{L % 'file'}[@USE='service']/{L % 'FLocat'}/@*[local-name()='href']"))
    return F.transform(names, lambda n: F.regexp_replace(n, r"^(file://)?\./", ""))


def html_links(html: Column, pattern: str = r'<a\s+href="([^"]*)"') -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(1))


def numbered_manifests(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r"([0-9]{6,}\.xml)"), F.lit(1))


_ALTO = "TextLine array<struct<String:array<struct<_CONTENT:string>>>>"


def alto_text(docs: DataFrame, xml: str = "xml", keys: list[str] | None = None) -> DataFrame:
    """OCR XML to text: words by blanks, lines by newlines, in document order."""
    lines = F.regexp_extract_all(F.col(xml), F.lit(r"(?s)<(?:\w+:)?TextLine\b.*?</(?:\w+:)?TextLine>"), F.lit(0))
    words = lambda line: F.array_join(F.regexp_extract_all(line, F.lit(r'<(?:\w+:)?String\b[^>]*?\bCONTENT="([^"]*)"'), F.lit(1)), " ")
    text = F.array_join(F.transform(lines, words), "\n")
    for entity, char in (("&quot;", '"'), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return docs.select(*(keys or [c for c in docs.columns if c != xml]), text.alias("text"))


def batch_editions(lines: DataFrame, batch: str = "batch", line: str = "value") -> DataFrame:
    """Lines of batch listings to (batch, date, path), the rest left out."""
    d = lines.select(batch, F.regexp_extract(line, r'issueDate="(\d{4}-\d{2}-\d{2})"', 1).alias("date"), batch_line_path(F.col(line)).alias("path"))
    return d.where((F.col("date") != "") & (F.col("path") != ""))


def editions_on_dates(batches: DataFrame, dates: DataFrame) -> DataFrame:
    return batches.join(dates.select("date").distinct(), "date", "left_semi")


def editions_in_years(batches: DataFrame, years: DataFrame) -> DataFrame:
    return batches.join(years.select(F.col("year").cast("string").alias("y")).distinct(), F.substring("date", 1, 4) == F.col("y"), "left_semi")


def first_candidate(candidates: DataFrame, key: str, order: str, content: str) -> DataFrame:
    """Of several manifest names of a batch the first in order that could be read."""
    return candidates.where(F.col(content).isNotNull()).groupBy(key).agg(F.min_by(content, order).alias(content))


def batches_up_to(batches: DataFrame, scans: str, start: int, n_scans: int, order: str = "batch_no") -> DataFrame:
    """Batches from an offset until their scans reach n_scans."""
    from ..operators.windows import up_to_total

    return up_to_total(batches.where(F.col(order) >= start), [order], scans, n_scans)
