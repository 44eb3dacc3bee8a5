"""What keeps the work per row bounded: nothing is evaluated twice, nothing is shuffled twice."""

import numpy as np
from pyspark.sql import functions as F

from galley.functions import geometry as G
from galley.functions import spell
from galley.operators import association, nms, reading_order


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_segment_is_evaluated_once_for_all_its_points(spark):
    rows = [(0, [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0)]), (1, [(2.0, 3.0)]), (2, []), (3, None)]
    d = spark.createDataFrame(rows, "id int, s array<struct<x double, y double>>")
    named = d.select("id", G.resample_segment(F.reverse("s"), 7).alias("p"))
    assert plan(named).count("reverse(") == 1
    got = {r.id: r.p and [tuple(p) for p in r.p] for r in named.collect()}
    assert got[0] == [(4, 4), (4, 2), (4, 0), (2, 0), (0, 0), (2, 2), (4, 4)] and got[1] == [(2, 3)] * 7
    assert got[2] == got[3] == [(None, None)] * 7
    at = d.where("id = 0").select("s", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("i")).select("i", G.segment_point(F.col("s"), F.col("i"), 7).alias("p"))
    assert [tuple(r.p) for r in at.orderBy("i").collect()] == [(0, 0), (2, 0), (4, 0), (4, 2), (4, 4), (2, 2), (0, 0)]


def test_terms_that_begin_alike_are_no_candidates_at_distance_one(monkeypatch):
    calls = []
    plain = spell.edit_distance
    monkeypatch.setattr(spell, "edit_distance", lambda *a: calls.append(a) or plain(*a))
    terms = {f"abcdefg{i:04d}": 50 for i in range(500)}
    c = spell.SymmetricDelete(terms, 1)
    assert c.nearest("abcdefghijklm") is None and len(calls) == 0
    assert c.nearest("abcdefg001x7") == (1, "abcdefg0017") and len(calls) < 5


def test_cuts_of_a_corrected_word_take_no_searches(monkeypatch):
    c = spell.SymmetricDelete({"there": 50, "the": 90, "land": 70}, 1)
    found = []
    plain = c._search
    monkeypatch.setattr(c, "_search", lambda w: found.append(w) or plain(w))
    assert c.compound("thare") == "there" and found == ["thare"]
    assert c.compound("theland thexland") == "the land the land"  # the blank is put in, or takes a letter's place


def test_visual_check_makes_substitutes_only_where_one_can_be_chosen(monkeypatch):
    v = spell.VisualChecker({"soles": 50}, {"o": ["0"], "0": ["o"], "l": ["1"], "1": ["l"], "s": ["5"], "5": ["s"], "e": ["c"], "c": ["e"]})
    asked = []
    plain = v._reaches
    monkeypatch.setattr(v, "_reaches", lambda w: asked.append((w, plain(w))) or asked[-1][1])
    assert v.text("50lc5 s0ll0ss0ll0ss0lm x0x l0 50lc5") == "soles sollossollossolm xox 10 soles"
    assert asked == [("50lc5", True), ("s0ll0ss0ll0ss0lm", False), ("x0x", False), ("l0", True)]  # each token once


def test_postprocessing_corrects_a_word_once_and_keeps_its_lines(spark, monkeypatch):
    terms = {f"abcdefg{i:04d}": 50 for i in range(300)} | {"the": 90}
    c = spell.SymmetricDelete(terms, 1)
    asked = []
    monkeypatch.setattr(c, "lookup", lambda w: asked.append(w) or spell.SymmetricDelete.lookup(c, w))
    assert spell.postprocess_text("Thx abcdefg0x07 thx\nthx", c, {}) == "The abcdefg0007 the\nthe"
    assert sorted(asked) == ["abcdefg0x07", "thx", "thx"]  # Thx, thx and the long word, each as written


def test_pages_are_suppressed_together_as_each_alone():
    rng = np.random.default_rng(5)
    counts = [0, 1, 40, 3, 0, 17]
    boxes = rng.integers(0, 60, (sum(counts), 4)).astype(float)
    boxes[:, 2:] = boxes[:, :2] + rng.integers(0, 50, (sum(counts), 2))
    starts = np.concatenate([[0], np.cumsum(counts)])
    for limit in (0.1, 0.45):
        for most in (2, 100):
            rank = nms.greedy_ranks(boxes, starts, limit, most)
            for a, b in zip(starts, starts[1:]):
                alone = nms.greedy_nms(boxes[a:b], -np.arange(b - a, dtype=float), limit)[:most]
                assert [i for _, i in sorted((r, i) for i, r in enumerate(rank[a:b]) if r >= 0)] == alone


def test_articles_are_found_without_a_second_shuffle(spark):
    rows = [(1, 0, "article", 0, 50, 40, 90), (1, 1, "headline", 5, 30, 45, 45), (1, 2, "author", 5, 46, 45, 49), (1, 3, "photograph", 0, 0, 9, 9), (1, 4, "article", 0, 60, 40, 80), (None, 5, "headline", 5, 30, 45, 45)]
    d = spark.createDataFrame(rows, "scan_id int, id int, class string, x0 int, y0 int, x1 int, y1 int")
    own = association.article_ids(association.with_page_extent(d)).where("full_article_id IS NOT NULL")
    lead = reading_order.with_lead_order(own, ("scan_id", "full_article_id"))
    got = lead.groupBy("scan_id", "full_article_id").agg(F.sort_array(F.collect_list(F.struct("id", "reading_order_id"))).alias("b"))
    physical = got._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 1 and "Join" not in physical
    assert {r.full_article_id: [tuple(b) for b in r.b] for r in got.collect()} == {1: [(0, None), (1, -2), (2, -1)], 5: [(4, None)]}


def test_border_medians_sort_each_channel_once(spark):
    image = [[[4, 1], [9, None], [2, 5]], [[7, 0], [1000, 1000], [3, 8]], [[6, 2], [5, 5], [1, None]]]
    d = spark.createDataFrame([(image,), ([[[3, 4]]],), (None,)], "i array<array<array<int>>>").select(G.border_median(F.reverse(F.reverse("i")), 2).alias("m"))
    assert plan(d).count("reverse(reverse(") == 1 and plan(d).count("sort_array(") == 2
    # Twelve values each: 1 1 2 2 3 4 4 5 6 6 7 9, and 0 1 1 2 2 5 5 5 8 with three nulls as the largest.
    assert [r.m for r in d.collect()] == [[4, 5], [3, 4], [None, None]]


def test_a_segment_s_box_finds_its_inner_points_once(spark):
    d = spark.createDataFrame([([(1.0, 2.0), (3.0, 9.0), (2.0, 1.0)],), ([(7.0, 7.0)],), (None,)], "s array<struct<x double, y double>>")
    b = d.select(G.segment_to_box(F.col("s"), F.lit(5), F.lit(5)).alias("b"))
    assert plan(b).count("filter(") == 1 and [r.b and tuple(r.b) for r in b.collect()] == [(1, 1, 2, 2), None, None]
