"""Multi-party chat formatting by perspective rotation.

For every participant of a conversation the whole dialogue is rendered once more with that
speaker as the assistant, all others as named users and system turns as they are; the loss mask
covers the assistant's content with its end mark.  A result row is one rendered turn with its
place in the dialogue's text, so that a conversation of any length is a set of rows, never one
value; ``rendered`` in order of ``turn_no`` and joined with nothing is the training text.

A turn's place is a running sum.  Turns are numbered inside spans of SPAN turn values, and the sums
of earlier spans are added; a span of more than HOT rows (turns that share a value, or have
none) is parted further by value and by hash.  Participants are joined by conversation and span, so no task
sees the whole of a very long conversation, and lengths are summed without the texts.

Cases: a null text is empty; a null or blank role speaks as ``unknown``; a null conversation id is
a conversation of its own; a null turn comes first; equal turns are ordered by the hash of role
and text, then by these, and repeated rows are repeated turns; a conversation of system turns
only has no participant and gives no rows; special marks inside texts and names are broken up and
line ends in names become blanks, so that neither closes a turn nor opens one; a very long
text stays one turn; clashing names don't matter, as other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .staging import key_of, small_side, staged

SPAN = 1024
HOT = 16_384
PARTS_BITS = 12  # of the hash, for spans with more rows than HOT
START, END = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"


def broken_up(s) -> object:
    """``s`` without the opening of a special mark."""
    return F.replace(s, F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", span: int = SPAN, hot: int = HOT) -> DataFrame:
    """conv_id, perspective, turn_no, turn, role, name, rendered, start, length, mask_start,
    mask_end (character offsets; null where the loss is masked out)."""
    speaker = F.coalesce(F.nullif(F.btrim(F.col(role_col)), F.lit("")), F.lit("unknown"))
    content = broken_up(F.coalesce(F.col(text_col), F.lit("")))
    t = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), speaker.alias("speaker"), content.alias("content"),
        F.length(content).cast("long").alias("__l"), key_of(F.col(conv_col)).alias("__c"),
        F.conv(F.substring(F.md5(F.concat(speaker, F.lit("\x01"), content).cast("binary")), 1, 13), 16, 10).cast("long").alias("__h"),
        F.coalesce(F.expr(f"CAST(`{turn_col}` AS BIGINT) div {span}"), F.lit(-(1 << 60))).alias("__g"))
    full = staged(t.groupBy("__c", "__g").agg(F.count("*").alias("__n")).where(F.col("__n") > hot).select("__c", "__g", F.lit(True).alias("__hot")), "hot_spans")
    if full.isEmpty():
        t = t.withColumn("__p", F.lit(0).cast("long"))
    else:
        within_span = F.coalesce(F.pmod(F.col("turn").cast("long"), F.lit(span)), F.lit(0))
        part = F.shiftleft(within_span, PARTS_BITS).bitwiseOR(F.shiftright("__h", 52 - PARTS_BITS))
        t = t.join(small_side(full), ["__c", "__g"], "left").withColumn("__p", F.when(F.col("__hot"), part).otherwise(0).cast("long")).drop("__hot")
    place = ["__c", "__g", "__p"]
    people = t.where(F.col("speaker") != SYSTEM).select("__c", F.col("speaker").alias("perspective")).distinct()
    t = t.join(t.select(*place).distinct().join(people, "__c"), place)
    mine = F.col("speaker") == F.col("perspective")
    role = F.when(mine, F.lit("assistant")).when(F.col("speaker") == SYSTEM, F.lit(SYSTEM)).otherwise(F.lit("user"))
    t = t.withColumn("role", role).withColumn("name", F.when(F.col("role") == "user", broken_up(F.translate("speaker", "\r\n", "  "))))
    head = F.concat(F.lit(START), F.col("role"), F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")), F.lit("\n"))
    t = t.withColumn("head", head).withColumn("length", F.length("head") + F.col("__l") + len(END) + 1)
    spans = t.groupBy("__c", "perspective", "__g", "__p").agg(F.sum("length").alias("__l"), F.count("*").alias("__n"))
    many = spans.groupBy("__c", "perspective").agg(F.count("*").alias("__s")).where("__s > 1")
    earlier = Window.partitionBy("__c", "perspective").orderBy("__g", "__p").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations that reach over several spans need offsets.
    offsets = staged(spans.join(many, ["__c", "perspective"]).select(
        *place, "perspective", F.coalesce(F.sum("__l").over(earlier), F.lit(0)).alias("ol"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("on")), "spans")
    within = Window.partitionBy("__c", "perspective", "__g", "__p").orderBy(F.col("turn").asc_nulls_first(), "__h", "speaker", "content")
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("__i", F.row_number().over(within) - 1).withColumn("__b", F.coalesce(F.sum("length").over(before), F.lit(0)))
    t = t.join(small_side(offsets), [*place, "perspective"], "left")
    start = F.col("__b") + F.coalesce("ol", F.lit(0))
    said = F.col("role") == "assistant"
    return t.select(
        "conv_id", "perspective", (F.col("__i") + F.coalesce("on", F.lit(0))).cast("long").alias("turn_no"), "turn", "role", "name",
        F.concat("head", "content", F.lit(END + "\n")).alias("rendered"), start.alias("start"), "length",
        F.when(said, start + F.length("head")).alias("mask_start"),
        F.when(said, start + F.col("length") - 1).alias("mask_end"))


CHAT_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(nullif(trim(role, ' '), ''), 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS content FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
j AS (SELECT t.*, perspective, substr(md5(speaker || chr(1) || content), 1, 13) AS h,
             CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS role
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
n AS (SELECT *, CASE WHEN role = 'user' THEN replace(replace(replace(speaker, chr(13), ' '), chr(10), ' '), '<|', '< |') END AS name FROM j),
h AS (SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM n),
r AS (SELECT *, head || content || '<|im_end|>' || chr(10) AS rendered FROM h),
w AS (SELECT *, length(rendered)::BIGINT AS len, row_number() OVER o - 1 AS turn_no,
             coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, h, speaker, content ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
      FROM r WINDOW o AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, h, speaker, content))
SELECT conv_id, perspective, turn_no, turn, role, name, rendered, start, len AS length,
       CASE WHEN role = 'assistant' THEN start + length(head) END AS mask_start,
       CASE WHEN role = 'assistant' THEN start + len - 1 END AS mask_end
FROM w
"""
