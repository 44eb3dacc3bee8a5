"""Hand-made cases of the newspaper operators; expected values were derived from their definitions."""

import random

import pytest
from pyspark.sql import functions as F

from galley.functions import geometry as G
from galley.functions import spell
from galley.functions import text as T
from galley.operators import articles, association, components, evaluate, knn, lines, nms, reading_order, sampling, search, windows

BOX = "scan_id int, id int, class string, x0 int, y0 int, x1 int, y1 int"
PAGE = [
    (0, "headline", 100, 100, 400, 150), (1, "article", 90, 160, 410, 600), (2, "article", 420, 150, 700, 700), (3, "author", 110, 145, 390, 158),
    (4, "headline", 430, 40, 690, 60), (5, "headline", 800, 100, 950, 140), (6, "photograph", 700, 800, 900, 1000), (7, "article", 100, 620, 400, 900),
    (8, "headline", 100, 1200, 400, 1230), (9, "author", 120, 300, 300, 315), (10, "headline", 405, 100, 425, 140)]


@pytest.fixture(scope="module")
def page(spark):
    d = spark.createDataFrame([(1, *b) for b in PAGE], BOX)
    return d.withColumns({"page_w": F.lit(1000), "page_h": F.lit(2000), "pos": F.col("id"), "raw_text": F.concat(F.lit("t"), F.col("id").cast("string"))})


def value(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_association(page):
    got = {r.id: r.full_article_id for r in association.article_ids(page).collect()}
    assert got == {0: 2, 1: 2, 2: 3, 3: 2, 4: 3, 5: None, 7: 8, 8: None, 9: 8, 10: None}


def test_full_articles(page):
    ordered = reading_order.reading_order(association.article_ids(page))
    got = {r.full_article_id: r for r in articles.assemble(ordered).collect()}
    assert set(got) == {2, 3, 8}
    assert got[2].object_ids == [0, 3, 1] and got[2].headline == "t0" and got[2].byline == "t3" and got[2].bbox == [90, 100, 410, 600] and got[2].id == "2_1"
    assert got[8].object_ids == [9, 7] and got[8].headline == ""


def test_column_order(spark):
    rows = [(1, i, "article", *b) for i, b in enumerate([(100, 500, 300, 700), (110, 100, 310, 480), (330, 90, 530, 400), (320, 420, 520, 800), (560, 95, 760, 300)])]
    got = {r.id: r.reading_order_id for r in reading_order.column_order(spark.createDataFrame(rows, BOX)).collect()}
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == [1, 0, 2, 3, 4]


def test_seed_only_columns():
    assert reading_order.greedy_order([0, 39, 78], [0, 1, 2], [100, 100, 100], 0.40) == [0, 1, 2]
    assert reading_order.greedy_order([0, 39, 78], [5, 1, 0], [100, 100, 100], 0.40) == [1, 0, 2]
    assert reading_order.greedy_order([], [], [], 0.4) == []


@pytest.mark.parametrize("left,right,scores,breaks", [
    ([10, 10, 40, 10, 10], [600, 300, 600, 600, 600], [1.875, 12.5, 1.875, 1.875, None], [1]),
    ([10, None, 10], [600, 600, 600], [3.0, 3.0, None], []),
    ([10, 12, 30, 10, None, 11], [600, 250, 590, 600, 600, None], [2.465753, 11.025495, 2.193683, 3.0, 2.260274, None], [1]),
    ([None, None], [5, 9], [None, None], []),
    ([0, 0], [5, 9], [None, None], []),
])
def test_paragraphs(spark, left, right, scores, breaks):
    d = spark.createDataFrame([(1, i, l, r) for i, (l, r) in enumerate(zip(left, right))], "bbox_id int, line_idx int, l_dist int, r_dist int")
    got = lines.paragraph_scores(d).orderBy("line_idx").collect()
    assert [r.score if r.score is None else round(r.score, 6) for r in got] == scores
    assert [r.line_idx for r in got if r.break_after] == breaks


def test_join_lines(spark):
    d = spark.createDataFrame([(1, 1, "b", False), (1, 0, "a", True)], "bbox_id int, line_idx int, text string, break_after boolean")
    assert lines.join_lines(d).first().text == "a\n\n\nb" and lines.join_lines(d, line_sep=" ").first().text == "a\n\n b"


@pytest.mark.parametrize("w,h,chunks", [
    (100, 200, [(0, 200)]), (100, 201, [(0, 200), (150, 201)]), (100, 350, [(0, 200), (150, 350), (300, 350)]),
    (100, 500, [(0, 200), (150, 350), (300, 500), (450, 500)]), (101, 700, [(0, 202), (151, 353), (302, 504), (453, 655), (604, 700)])])
def test_tall_chunks(spark, w, h, chunks):
    assert [(c.y0, c.y1) for c in value(spark, G.tall_chunks(F.lit(w), F.lit(h)).alias("c")).c] == chunks


def test_nms(spark):
    import numpy as np

    a = np.array([(0, 0, 10, 10), (1, 1, 11, 11), (20, 20, 30, 30), (6, 0, 16, 10), (21, 20, 31, 30)], float)
    assert nms.greedy_nms(a, np.array([.9, .8, .7, .6, .95]), 0.45) == [4, 0, 3]
    b = np.array([(0, 0, 10, 10), (4, 0, 14, 10), (8, 0, 18, 10)], float)
    assert nms.greedy_nms(b, np.array([.9, .8, .7]), 0.40) == [0, 2]
    d = spark.createDataFrame([(1, i, *map(float, x), c, i % 2) for i, (x, c) in enumerate(zip(a, [.9, .8, .7, .6, .95]))], "img int, det int, x0 double, y0 double, x1 double, y1 double, conf double, cls int")
    assert [r.det for r in nms.suppress(d, ["img"], 0.45).orderBy("rank").collect()] == [4, 0, 3]
    assert {r.det for r in nms.suppress(d, ["img"], 0.45, agnostic=False).collect()} == {0, 1, 3, 4}  # 2 and 4 share a class
    assert {r.det for r in nms.suppress(d, ["img"], 0.45, conf=0.75).collect()} == {4, 0}


def test_chunks(spark):
    for n, want in ((0, {}), (50, {0: 50}), (100, {0: 100}), (200, {0: 100, 1: 100}), (250, {0: 100, 1: 100, 2: 50})):
        got = windows.chunked(spark.range(n).select((F.lit(1000) - F.col("id")).alias("u")), ["u"])
        assert {r.chunk: r["count"] for r in got.groupBy("chunk").count().collect()} == want
    assert sorted(r.idx for r in got.collect()) == list(range(250))


def test_geometry(spark):
    a, b = ({k: F.lit(v) for k, v in zip(("x0", "y0", "x1", "y1"), x)} for x in ((0, 0, 10, 10), (5, 5, 15, 15)))
    r = value(spark, G.iou(a, b).alias("iou"), G.iom(a, b).alias("iom"), G.overlaps(a, b).alias("o"), G.xyxy_to_xywh(a).alias("c"), G.make_divisible(F.lit(33), 32).alias("d"), G.coco91(F.lit(79)).alias("k"))
    assert round(r.iou, 6) == round(25 / 175, 6) and r.iom == 0.25 and r.o and tuple(r.c) == (5, 5, 10, 10) and r.d == 64 and r.k == 90
    back = value(spark, G.xywh_to_xyxy(G.xyxy_to_xywh(b)).alias("x"), G.ltwh_to_xyxy(G.xyxy_to_ltwh(b)).alias("y"), G.xywhn_to_xyxy(G.xyxy_to_xywhn(b, F.lit(20), F.lit(20)), F.lit(20), F.lit(20)).alias("z"))
    assert all(tuple(v) == (5, 5, 15, 15) for v in back)
    line = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 4), (-1, 9))])
    s = value(spark, G.segment_to_box(line, F.lit(5), F.lit(5)).alias("s"), F.size(G.resample_segment(line, 9)).alias("n"), G.l2_normalise(F.array(F.lit(3.0), F.lit(4.0))).alias("u"), G.argmax(F.array(F.lit(1), F.lit(7), F.lit(7))).alias("m"))
    assert tuple(s.s) == (0, 0, 4, 4) and s.n == 9 and s.u == [0.6, 0.8] and s.m == 1


def test_texts(spark):
    lit = F.lit
    r = value(
        spark, T.clean_quotes(lit("“a” ''b''")).alias("q"), T.depunctuate(lit("a,b-c'")).alias("p"), T.is_number(lit("1,900")).alias("n"), T.is_initial(lit("J.")).alias("i"),
        T.is_abbreviation(lit("Mr.")).alias("ab"), T.all_capitals(lit("")).alias("ac"), T.char_is(lit("a1"), lit(5), "alpha").alias("ci"), T.words_from_code_points(lit("72_8364_128512")).alias("cp"),
        T.path_tail(lit("http://x/a/b/c/d.jp2")).alias("pt"), T.pad_left(lit("123"), 2).alias("pl"), T.edition_id(lit("1900010203")).alias("e"), T.edition_id(lit("1900-01-02")).alias("e2"),
        T.page_id(lit("7")).alias("pg"), T.year_range(lit("18??/1900")).alias("y"), T.uri_tail(lit("http://g.org/123/about#x")).alias("u"), T.file_date(lit("lccn_1900010201_p1.json")).alias("fd"),
        T.title_parts(lit("Daily News. (Boston, Mass.) 1900-01-02")).alias("t"), T.title_parts(lit("Sun [Rome], 1901")).alias("t2"), T.title_parts(lit("Sun, Rome, 1901")).alias("t3"),
        T.yolo_line(lit("1 0.5 0.5 0.1 0.2")).alias("yl"), T.edit_share(lit("ab"), lit("abcd")).alias("es"), T.clean_name(lit("a|b@c")).alias("cn"), T.split_keeping(lit("a b-c")).alias("sk"),
        T.majority_normalise(lit("th1s"), {"1": "i"}, {}).alias("mn"), T.majority_normalise(lit("19O5"), {}, {"O": "0"}).alias("mn2"), T.dashed_date(lit("19000102")).alias("dd"))
    assert r.q == '"a" "b"' and r.p == "abc'" and r.n and r.i and r.ab and r.ac and r.ci and r.cp == "H€😀"
    assert r.pt == "a_b_c_d.jp2" and r.pl == "123" and r.e == "1900-01-02/ed-3" and r.e2 == "1900-01-02/ed-1" and r.pg == "seq-7" and tuple(r.y) == ("18??", "1900")
    assert r.u == "about" and r.fd == "1900-01-02" and tuple(r.t) == ("Daily News", "Boston", "Mass", "1900-01-02") and r.t2.name == "Sun" and r.t2.city == "Rome" and r.t3.date == "1901"
    assert r.yl.c == 1 and r.es == 0.5 and r.cn == "a_b_c" and "".join(r.sk) == "a b-c" and r.mn == "this" and r.mn2 == "1905" and r.dd == "1900-01-02"


def test_fixed_values_of_tokens(spark):
    """Expected values from the written semantics, not from the engine."""
    lit = F.lit
    r = value(
        spark, T.clean_quotes(lit("“a” ‘‘b’’ ''c'' „d“ `e`")).alias("q"), F.array(*[T.isnt_capital(lit(x)) for x in ("word", "don't", "a1", "1900", "eBay", "The", "!", "", "-.", ".-")]).alias("c"),
        F.array(*[T.is_abbreviation(lit(x)) for x in ("Est.", "i.e.", "OZ.", "st.", "no.", "dr")]).alias("a"))
    assert r.q == '"a" "b" "c" „d" `e`'
    assert r.c == [True, True, True, False, False, False, True, True, True, False]
    assert r.a == [True, True, True, False, False, False]


def test_case_is_repaired_by_heights(spark):
    rows = [(0, "a", 10, 20, True), (1, "W", 10, 20, False), (2, "s", 0, 20, False), (3, "o", 9, 20, False), (4, "-", 18, 20, False), (5, "-", 12, 14, True), (6, "e", 10, 20, False), (7, "T", 0, 20, False)]
    c = spark.createDataFrame([(1, *r) for r in rows], "line_id int, char_idx int, label string, y0 int, y1 int, starts_word boolean")
    assert lines.repair_case(c, anchor_margin=0.2).first().text == "awSo. -eT"
    assert lines.repair_case(c).first().text == "aWso- -eT"


def test_spelling(spark):
    terms = {"the": 50, "cat": 10, "cart": 3, "house": 5}
    c = spell.SymmetricDelete(terms, 2)
    assert c.lookup("teh") == "the" and c.lookup("cst") == "cat" and c.lookup("zzzzzz") == "zzzzzz"
    # Compound correction leaves words only; the separators of the other modes stay.
    assert spell.correct_text("Teh cst.", c, "full_text") == "The cat" and spell.correct_text("teh  cst", c, "word") == "the cat"
    assert spell.correct_text("Teh cst. thehouse", c, "period") == "The cat.the house" and spell.correct_text("TEH\n\nho use", c, "paragraph") == "THE\n\nhouse"
    assert spell.correct_text("", c, "full_text") == "" and spell.correct_text("qqqqqqqq 7", c, "full_text") == "qqqqqqqq 7"
    # A cut in known words; a whole word that is as near wins over it by frequency, unless the pair is known.
    known = {"is": 8_000_000_000, "land": 900_000_000, "i": 70}
    assert spell.SymmetricDelete(known, 1).compound("island IsLand") == "is land Is Land"
    known["sland"] = 10_000_000
    assert spell.SymmetricDelete(known, 1).compound("island") == "sland"
    assert spell.SymmetricDelete(known, 1, {"is land": 20_000_000}).compound("island") == "is land"
    v = spell.VisualChecker(terms, {"0": ["o"], "c": ["e"], "1": ["l", "i"]})
    assert v.text("h0use THE 1900 thc") == "house THE 1900 the"
    assert spell.join_broken_words(["a big ho-", "use the", "", "ca", "t x"], terms) == ["a big house", "the", "", "cat", "x"]
    assert spell.join_broken_words(["a ho-", "", "use"], terms) == ["a ho-", "", "use"]  # not over a blank line
    assert spell.fix_capitals(["Hi.", "the", "CAT", "", "I"], terms) == ["Hi.", "The", "CAT", "", "I"]
    assert spell.fix_capitals(["Hi!", "oNCE", "the", "i"], terms) == ["Hi!", "Once", "the", "i"]
    d = spark.createDataFrame([(1, "Teh ho-\nuse"), (2, None)], "id int, text string")
    words = spark.createDataFrame(list(terms.items()), "term string, freq long")
    got = {r.id: r.clean for r in spell.postprocess(d, words).collect()}
    assert got == {1: "The house\n", 2: None}
    checks = spell.with_spell_checks(d.withColumnRenamed("text", "raw_text"), words).where("id = 1").first()
    assert checks.spell_check_word.startswith("the") and checks.spell_check_full_text.startswith("The")
    g = {r.char: r.others for r in spell.homoglyphs(spark.createDataFrame([("o", "0", .9), ("o", "c", .95), ("a", "b", .1)], "a string, b string, sim_score double")).collect()}
    assert g == {"o": ["c", "0"], "0": ["o"], "c": ["o"]}


def plain_distance(a, b):
    d = [[i + j if not i * j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_nearest_terms_are_those_of_a_full_search():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(1, 11)))
    terms = {word(): rng.randint(1, 9) for _ in range(400)}
    for distance in (1, 2):
        c = spell.SymmetricDelete.of(spell.SymmetricDelete(terms, distance).parts)
        for w in [word() for _ in range(300)]:
            best = min((plain_distance(w, t), -n, t) for t, n in terms.items())
            assert c.nearest(w) == ((best[0], best[2]) if best[0] <= distance else None)


def test_evaluation(spark):
    p = spark.createDataFrame([("abc", "abd"), ("xy", "xy"), ("", "")], "gold string, pred string")
    s = evaluate.text_scores(p).first()
    assert s.n == 3 and round(s.accuracy, 4) == 66.6667 and s.cer == 0.2
    e = lambda rows: spark.createDataFrame(rows, "img int, a int, b int")
    r = evaluate.edge_scores(e([(1, 1, 2), (1, 3, 4), (2, 1, 2)]), e([(1, 2, 1), (1, 5, 6)]), ["img"]).first()
    assert (r.tp, r.fp, r.fn, r.precision, r.recall, r.f1) == (1, 1, 1, 50.0, 50.0, 50.0)
    assert evaluate.edge_scores(e([]), e([]), ["img"]).first().f1 is None


def test_components(spark):
    d = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 2), (8, 8), (None, 1)], "a int, b int")
    assert sorted(map(tuple, components.connected_components(d, "a", "b").collect())) == [(3, 2), (4, 2), (5, 2), (9, 8)]
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components.connected_components(chain, "a", "b").collect()} == {0}


def test_sampling(spark):
    items = spark.createDataFrame([(c, i) for c, n in (("a", 7), ("b", 2)) for i in range(n)], "label string, item int")
    got = sampling.m_per_class(items, "label", "item", 5).groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("item").alias("d")).collect()
    assert {(r.label, r.n, r.d) for r in got} == {("a", 5, 5), ("b", 5, 2)}
    g = sampling.exhaustive_groups(items, "label", "item", 3).groupBy("label", "group").agg(F.count("*").alias("n")).collect()
    assert {(r.label, r.group, r.n) for r in g} == {("a", 0, 3), ("a", 1, 3), ("a", 2, 3), ("b", 0, 3)}
    assert sampling.batched_m_per_class(items, "label", "item", 2, 4, num_passes=2).groupBy("pass", "batch").count().count() == 2
    with pytest.raises(ValueError):
        sampling.assert_disjoint(items, items)


def test_lines_and_words(spark):
    w = spark.createDataFrame([(1, 0, 0, 0, 20, 10), (1, 1, 50, 0, 60, 10)], "line_id int, word_id int, x0 int, y0 int, x1 int, y1 int")
    c = spark.createDataFrame([(1, 7, 1, 0, 8, 10), (1, 8, 9, 0, 19, 10)], "line_id int, char_id int, x0 int, y0 int, x1 int, y1 int")
    got = {r.word_id: [(x.from_word, x.char_id) for x in r.chars] for r in lines.owned_chars(w, c).collect()}
    assert got == {0: [(False, 7), (False, 8)], 1: [(True, 1)]}
    assert {r.word_id: r.char_idx for r in lines.word_starts(w, c).collect()} == {0: 0, 1: 0}
    words = spark.createDataFrame([(1, "cat", 0.9, ["c1", "a"], "."), (2, "dog", 0.86, ["d", "ox"], None)], "word_id int, word_label string, word_sim double, char_labels array<string>, end_mark string")
    assert {r.word_id: r.text for r in lines.recognised_words(words, 0.86).collect()} == {1: "cat.", 2: "do"}


def test_nearest(spark):
    refs = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "b", [0.0, 2.0])], "ref_id long, label string, vec array<double>")
    q = spark.createDataFrame([(10, [3.0, 1.0]), (11, [0.1, 9.0])], "query_id long, vec array<double>")
    assert {r.query_id: r.label for r in knn.nearest(q, refs).collect()} == {10: "a", 11: "b"}
    assert knn.nearest(q, refs, k=5).count() == 4
    whole = sorted(map(tuple, knn.nearest(q, refs, k=2).collect()))
    assert sorted(map(tuple, knn.nearest(q, refs, k=2, max_rows=1).collect())) == whole  # in parts


def test_search(spark):
    a = spark.createDataFrame([(1, "p", "The Mayor spoke of trade"), (2, "p", "trade"), (3, "q", None)], "id int, page string, article string")
    assert [r.id for r in search.cooccurrence(a, "mayor", "TRADE").collect()] == [1]
    assert {tuple(r) for r in search.co_printed(a, "page", "id").collect()} == {("p", 1, 2), ("p", 2, 1)}


def test_runs(spark):
    d = spark.createDataFrame([(1, 0, "a"), (1, 1, "a"), (1, 2, "b"), (1, 3, None), (1, 4, None), (1, 5, "a")], "g int, t int, e string")
    got = windows.run_positions(d, "e", ["t"], ["g"]).orderBy("t").collect()
    assert [r.run_pos for r in got] == [1, 2, 1, 1, 2, 1] and got[1].page == "02"
