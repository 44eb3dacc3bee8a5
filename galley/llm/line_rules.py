r"""Quality rules with cross-document line frequency, in DataFrame functions only.

Per document: word, symbol, duplicate-line and repeated-word counts.  Across documents: lines are
normalised (trimmed, blanks collapsed, lower case) and hashed, and per host (the ``source``
column) the distinct documents that have the line are counted.  Documents with one and the same
text count once: a clean text with many copies would otherwise make boilerplate of all its own
lines and be rejected whole, while copies are the business of deduplication.  A line above the limit, the larger
of ``min_docs`` and ``share`` of the host's distinct documents, is boilerplate and is removed
everywhere but in the document with the least id, so that one instance of it stays in the corpus;
a document that loses more than half of its words is depleted and rejected.  ``keep_good`` returns the documents
that stay, without the removed lines.

The text is scanned once into a narrow staged table; counts are aggregates with map-side
combining over (host, line) so that a frequent host or line never meets in one task.

Cases: null and blank texts have zero counts and fail the base rules; a null source is a host of
its own; null ids are never a line's first document; repeated rows get the same decision; an empty table gives
no rows; a very long text is one row's arrays; columns other than doc_id, text and source are carried
by ``keep_good``, whatever their names, and not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import fresh, key_of, small_side, staged

BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_DOCS = 10
SHARE = 0.01
MAX_REMOVED = 0.5


def normalised(line) -> object:
    """What counts as one line: trimmed, blanks collapsed, lower case."""
    return F.lower(F.regexp_replace(F.btrim(line, F.lit(BLANKS)), BLANK_RUN, " "))


def text_features(docs: DataFrame) -> DataFrame:
    """doc_id, key (host), same (hash of the text), row_key, counts, lines (hash, words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(
        "doc_id", key_of(F.col("source")).alias("key"), text.alias("t"),
        F.md5(F.concat_ws("|", key_of(F.col("doc_id")), key_of(F.col("source")), key_of(F.col("text"))).cast("binary")).alias("row_key"))
    d = d.withColumn("tt", F.btrim("t", F.lit(BLANKS)))
    d = d.withColumn("words", F.when(F.col("tt") == "", F.array().cast("array<string>")).otherwise(F.split("tt", BLANK_RUN)))
    d = d.withColumn("ls", F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    d = d.withColumn("n", F.size("words"))
    n, words = F.col("n"), F.col("words")
    d = d.withColumn("win", F.when(n >= 4, F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))))
    # Only where a window repeats: sort (window, place), flag equal neighbours, and add up the
    # words that the flagged windows cover, in order of place.
    d = d.withColumn("srt", F.when(F.size(F.array_distinct("win")) < F.size("win"), F.sort_array(
        F.transform("win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    srt, at = F.col("srt"), lambda j: F.get(F.col("srt"), j)["h"]
    d = d.withColumn("rep", F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size(srt) - 1),
                 lambda j: (F.coalesce(at(j) == at(j - 1), F.lit(False))) | F.coalesce(at(j) == at(j + 1), F.lit(False))),
        lambda j: F.get(srt, j)["i"])))
    covered = F.aggregate(
        "rep", F.struct(F.lit(0).alias("sum"), F.lit(-3).alias("last")),
        lambda a, p: F.struct((a["sum"] + F.least(F.lit(3), p - a["last"])).alias("sum"), p.alias("last")),
        lambda a: a["sum"])
    d = d.withColumn("norm", F.transform("ls", normalised))
    return d.select(
        "doc_id", "key", "row_key", F.xxhash64("t", F.length("t")).alias("same"),
        F.col("n").cast("long").alias("n_words"),
        F.length(F.translate("t", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("ls") - F.size(F.array_distinct("ls"))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.when(F.col("srt").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"),
        F.transform("norm", lambda x: F.struct(F.xxhash64(x).alias("h"), F.regexp_count(x, F.lit("[^ ]+")).alias("w"))).alias("lines"))


def frequent_lines(rows: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """Staged (key, h, first): lines above their host's limit, with the least doc_id that has it."""
    hosts = rows.select("key", "same").distinct().groupBy("key").agg(
        F.greatest(F.lit(float(min_docs)), F.lit(share) * F.count("*")).alias("limit"))
    hosts = small_side(staged(hosts, "hosts"))
    lines = rows.select("key", "same", "doc_id", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    often = lines.groupBy("key", "h").agg(F.count("*").alias("c")).where(F.col("c") > min_docs)
    often = staged(often.join(hosts, "key").where("c > limit").select("key", "h", "limit"), "often")
    exact = lines.join(small_side(often), ["key", "h"]).groupBy("key", "h").agg(
        F.count_distinct("same").alias("docs"), F.min("doc_id").alias("first"), F.min("limit").alias("limit"))
    return staged(exact.where("docs > limit").select("key", "h", "first"), "frequent")


def judged(docs: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE, max_removed: float = MAX_REMOVED) -> DataFrame:
    """Per row the counts, base_failed, removed_words, removed (hashes of lines) and kept (and row_key)."""
    rows = staged(text_features(docs).withColumn("rid", F.monotonically_increasing_id()), "features")
    lines = rows.select("rid", "key", "doc_id", F.explode("lines").alias("l")).select("rid", "key", "doc_id", "l.h", "l.w")
    gone = lines.join(small_side(frequent_lines(rows, min_docs, share)), ["key", "h"])
    gone = gone.where(~F.col("doc_id").eqNullSafe(F.col("first"))).groupBy("rid").agg(
        F.sum("w").alias("removed_words"), F.collect_set("h").alias("removed"))  # a document's own lines
    out = rows.drop("lines").join(gone, "rid", "left").withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("removed_words") <= max_removed * F.col("n_words")))


def rules_report(docs: DataFrame) -> DataFrame:
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.col("removed_words").cast("long").alias("removed_words"))


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without rejected documents and without the removed lines; all columns stay.  Only rows
    that are rejected or altered are looked up; texts without a removed line aren't touched."""
    found = judged(docs)
    key, kept, lines = (fresh(docs, c) for c in ("__row_key", "__kept", "__lines"))
    found = found.where(~F.col("kept") | F.col("removed").isNotNull()).groupBy(F.col("row_key").alias(key))
    found = staged(found.agg(F.any_value("kept").alias(kept), F.any_value("removed").alias(lines)), "verdicts")
    row_key = F.md5(F.concat_ws("|", key_of(F.col("doc_id")), key_of(F.col("source")), key_of(F.col("text"))).cast("binary"))
    out = docs.withColumn(key, row_key).join(small_side(found), key, "left").where(F.coalesce(F.col(kept), F.lit(True)))
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x: ~F.array_contains(F.col(lines), F.xxhash64(normalised(x)))), "\n")
    return out.withColumn("text", F.when(F.col(lines).isNotNull(), left).otherwise(F.col("text"))).select(*[F.col(f"`{c}`") for c in docs.columns])


RULES_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
f AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
        FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM f WHERE len(words) >= 3)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS c FROM win) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + o) AS n_repeat FROM rep, (VALUES (0), (1), (2)) AS o(o) GROUP BY rid),
ln AS (SELECT rid, doc_id, source, t, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'), ' ')) AS l
       FROM (SELECT rid, doc_id, source, t, unnest(ls) AS l FROM f)),
host AS (SELECT source, greatest(10.0::DOUBLE, 0.01::DOUBLE * count(DISTINCT t)) AS lim FROM d GROUP BY source),
freq AS (SELECT ln.source, l, min(doc_id) AS first FROM ln JOIN host ON ln.source IS NOT DISTINCT FROM host.source
         GROUP BY ln.source, l, lim HAVING count(DISTINCT t) > lim),
gone AS (SELECT rid, sum(len(string_split(ln.l, ' '))) AS removed FROM ln JOIN freq ON ln.l = freq.l AND ln.source IS NOT DISTINCT FROM freq.source
         WHERE doc_id IS DISTINCT FROM first GROUP BY rid),
r AS (SELECT doc_id, len(words)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, coalesce(removed, 0)::BIGINT AS removed_words
      FROM f LEFT JOIN cov USING (rid) LEFT JOIN gone USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       (n_words >= 50 AND 100 * n_repeat_words <= 50 * n_words AND removed_words <= 0.5 * n_words) AS kept, removed_words
FROM r
"""
