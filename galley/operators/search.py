"""Analyst queries over the published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import article_key


def any_order(*terms: str, text: str = "article") -> Column:
    """All terms occur in one text, whatever their case."""
    low = F.lower(text)
    out = F.lit(True)
    for t in terms:
        out &= low.contains(t.lower())
    return out


def first_matches(articles: DataFrame, term: str, n: int, order: list[str], text: str = "article") -> DataFrame:
    """Case-sensitive matches among the first ``n`` rows in ``order``, with their position."""
    head = articles.orderBy(*order).limit(n)
    at = head.withColumn("pos", F.row_number().over(Window.orderBy(*order)) - 1)  # n rows
    return at.where(F.col(text).contains(term))


def in_languages(rows: DataFrame, languages: list[str] | None = None, lang: str = "lang") -> DataFrame:
    """Rows of some languages; without a list the filter is off and all rows pass, also those without a language."""
    return rows if languages is None else rows.where(F.col(lang).isin(*languages))


def cooccurrence(articles: DataFrame, *terms: str, text: str = "article") -> DataFrame:
    return articles.where(any_order(*terms, text=text))


def frequency(hits: DataFrame, *keys) -> DataFrame:
    return hits.groupBy(*keys).agg(F.count("*").alias("n"))


def page_of_article(scans: DataFrame, article_id: str, scan_id: str = "scan_id") -> DataFrame:
    """Scans that hold the article; ids are compared up to their first point."""
    each = scans.select(scan_id, F.explode("full_articles").alias("a"))
    return each.where(article_key(F.col("a.id")) == article_id.split(".")[0]).select(scan_id, "a")


def co_printed(articles: DataFrame, page: str, article: str) -> DataFrame:
    """(page, article, other): pairs of different articles on one page."""
    other = articles.select(page, F.col(article).alias("other"))
    return articles.select(page, article).join(other, page).where(F.col(article) != F.col("other"))


def edition_mates(articles: DataFrame, edition: list[str], article: str) -> DataFrame:
    """(edition, article, other): the same over all pages of an edition."""
    other = articles.select(*edition, F.col(article).alias("other"))
    return articles.select(*edition, article).join(other, edition).where(F.col(article) != F.col("other"))


def parsed_scans(raw: DataFrame, column: str = "raw_data_string", ddl: str | None = None) -> DataFrame:
    """Published scan rows with their JSON parsed; only the fields of ``ddl`` are read."""
    from ..schemas import SCAN_DDL

    s = F.from_json(column, ddl or SCAN_DDL)
    out = raw.withColumn("s", s).select(*raw.columns, "s.*")
    return out.withColumnRenamed("full articles", "full_articles")
