"""Text lines: words and characters, word starts, paragraphs and assembled texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import END_PUNCTUATION, PARAGRAPH_LIMIT, PARAGRAPH_WEIGHTS

DISTINCT_LOWER, PLAIN_LOWER = "aenr", "wuosvcxz"


def owned_chars(words: DataFrame, chars: DataFrame, line: str = "line_id") -> DataFrame:
    """(line, word_id, chars): each word's strictly overlapping characters by x0.  A word without
    any becomes a character itself and ownership is found again."""
    box = ("x0", "y0", "x1", "y1")
    w = words.select(line, "word_id", *[F.col(c).alias(f"w_{c}") for c in box])
    meets = (F.col("w_x0") < F.col("x1")) & (F.col("x0") < F.col("w_x1")) & (F.col("w_y0") < F.col("y1")) & (F.col("y0") < F.col("w_y1"))
    c = chars.select(line, "char_id", *box).withColumn("from_word", F.lit(False))
    empty = w.join(w.join(c, line).where(meets).select(line, "word_id"), [line, "word_id"], "left_anti")
    extra = empty.select(line, F.col("word_id").alias("char_id"), *[F.col(f"w_{k}").alias(k) for k in box]).withColumn("from_word", F.lit(True))
    every = c.unionByName(extra)
    owned = w.join(every, line).where(meets).groupBy(line, "word_id").agg(
        F.sort_array(F.collect_list(F.struct("x0", "from_word", "char_id"))).alias("chars"))
    return words.select(line, "word_id").join(owned, [line, "word_id"], "left")


def word_starts(words: DataFrame, chars: DataFrame, line: str = "line_id") -> DataFrame:
    """(line, word_id, char_idx): the character, by x0, with the nearest right edge strictly to the
    right of the word's left edge; a word without one takes the previous word's, the first 0."""
    by_x = lambda i: Window.partitionBy(line).orderBy("x0", i)
    c = chars.withColumn("char_idx", F.row_number().over(by_x("char_id")) - 1).select(line, "char_idx", F.col("x1").alias("right"))
    w = words.withColumn("word_idx", F.row_number().over(by_x("word_id")) - 1)
    near = w.join(c, line).where(F.col("right") > F.col("x0")).groupBy(line, "word_id").agg(F.min_by("char_idx", F.struct(F.col("right") - F.col("x0"), F.col("char_idx"))).alias("found"))
    seen = F.last("found", ignorenulls=True).over(Window.partitionBy(line).orderBy("word_idx"))
    return w.join(near, [line, "word_id"], "left").select(line, "word_id", "word_idx", F.coalesce(seen, F.lit(0)).alias("char_idx"))


def paragraph_scores(lines: DataFrame, region: str = "bbox_id", line: str = "line_idx", left: str = "l_dist", right: str = "r_dist") -> DataFrame:
    """Adds ``score`` and ``break_after``.  Null margins count as the region's average; no score
    without a next line or where the average left margin is missing or zero; equal right margins
    add nothing."""
    w = Window.partitionBy(region)
    l_avg, r_avg, r_max = F.avg(left).over(w), F.avg(right).over(w), F.max(right).over(w)
    d = lines.withColumns({"__la": l_avg, "__ra": r_avg, "__rm": r_max})
    nxt = F.lead(F.coalesce(F.col(left).cast("double"), F.col("__la"))).over(w.orderBy(line))
    edge = F.coalesce(F.try_divide(F.col("__rm") - F.coalesce(F.col(right).cast("double"), F.col("__ra")), F.col("__rm") - F.col("__ra")), F.lit(0.0))
    a, b = PARAGRAPH_WEIGHTS
    d = d.withColumn("score", a * F.try_divide(nxt, F.col("__la")) + b * edge)
    return d.withColumn("break_after", F.coalesce(F.col("score") > PARAGRAPH_LIMIT, F.lit(False))).drop("__la", "__ra", "__rm")


def join_lines(lines: DataFrame, region: str = "bbox_id", line: str = "line_idx", line_sep: str = "\n") -> DataFrame:
    """(region, text): lines in order, with two newlines appended where a paragraph ends."""
    part = F.struct(F.col(line).alias("at"), F.concat("text", F.when(F.col("break_after"), "\n\n").otherwise("")).alias("t"))
    return lines.groupBy(region).agg(F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["t"]), line_sep).alias("text"))


def recognised_words(words: DataFrame, threshold: float) -> DataFrame:
    """Adds ``text``: the nearest word where its similarity is above the threshold, else the first
    characters of the character labels; then the end mark that was cut off."""
    chars = F.trim(F.array_join(F.transform("char_labels", lambda c: F.substring(c, 1, 1)), ""))
    text = F.when(F.col("word_sim") > threshold, F.col("word_label")).otherwise(chars)
    return words.withColumn("text", F.concat(text, F.coalesce("end_mark", F.lit(""))))


def end_mark(label) -> object:
    """The label if it is one of the marks that end a word, else null."""
    return F.when(label.isin(*END_PUNCTUATION), label)


def line_texts(words: DataFrame, line: str = "line_id") -> DataFrame:
    """Words of a line in order, joined by blanks."""
    return words.groupBy(line).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("word_idx", "text"))), lambda w: w["text"]), " ").alias("text"))


def line_margins(chars: DataFrame, line: str = "line_id") -> DataFrame:
    """Least left and largest right edge and the number of characters; no row, no margin."""
    return chars.groupBy(line).agg(F.min("x0").alias("l_dist"), F.max("x1").alias("r_dist"), F.count("*").alias("n_chars"))


def repair_case(chars: DataFrame, line: str = "line_id", anchor_margin: float | None = None, anchor_multiplier: float = 4) -> DataFrame:
    """Characters (line, char_idx, label, y0, y1, starts_word) to one text per line, a blank before
    word starts.  With ``anchor_margin`` glyphs are compared with the average height and bottom of the
    line's unmistakable lower-case letters: within the margin of the height they become small,
    above margin times multiplier look-alike letters become capitals, and a dash with its bottom on theirs
    is a point."""
    h, bottom = F.col("y1") - F.col("y0"), F.col("y1")
    label = F.col("label")
    if anchor_margin is not None:
        w = Window.partitionBy(line)
        sure = label.isin(*DISTINCT_LOWER)
        avg_h, avg_b = F.avg(F.when(sure, h)).over(w), F.avg(F.when(sure, bottom)).over(w)
        near = F.coalesce(F.abs(h - avg_h) < anchor_margin * avg_h, F.lit(False))
        low = F.when(near, F.lower(label)).otherwise(label)
        tall = low.isin(*PLAIN_LOWER) & (h - avg_h > anchor_margin * anchor_multiplier * avg_h)
        label = F.when(tall, F.upper(low)).when((low == "-") & (F.abs(bottom - avg_b) < anchor_margin * avg_h), F.lit(".")).otherwise(low)
    c = chars.withColumn("t", F.concat(F.when(F.col("starts_word") & (F.col("char_idx") > 0), " ").otherwise(""), label))
    return c.groupBy(line).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("char_idx", "t"))), lambda x: x["t"]), "").alias("text"))


def region_legibility(chunks: DataFrame, region: str = "bbox_id") -> DataFrame:
    """A region's label is its last chunk's."""
    return chunks.groupBy(region).agg(F.max_by("legibility", "chunk").alias("legibility"))
