"""The pipeline's stages, one after the other, against plain versions on hand-made documents."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from galley.llm import knn_quality, line_rules, mixing, near_dedup, packing
from tests.llm.test_operators import plain_counts, prose

pipeline = pytest.importorskip("corpus_pipeline")
NOTICE = "All rights reserved, ask the editor of this paper"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    rows = [(i, prose(i, 80 + i), f"s{i % 4}") for i in range(60)]  # clean
    rows += [(100 + i, f"{prose(300 + i, 60)}\n{NOTICE}\n{prose(400 + i, 30)}", "s0") for i in range(20)]  # a frequent line
    rows += [(200 + i, rows[i][1], "s1") for i in range(6)]  # exact copies
    rows += [(210 + i, rows[10 + i][1].replace(" ", "  ") if i == 0 else "start " + rows[10 + i][1], "s2") for i in range(6)]  # near copies
    rows += [(300 + i, prose(500 + i, 70).upper().replace(" ", "!! "), "s3") for i in range(40)]  # of bad quality
    rows += [(400, None, "s0"), (401, "", None), (402, "short text", "s1"), (403, "w " * 60, "s1"), (None, prose(900, 90), None)]
    data = [(d, t, "en", s, None if t is None else len(t)) for d, t, s in rows]
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    marks = [(i, 1, 0) for i in range(60)] + [(300 + i, 0, 0) for i in range(40)]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def plain(df):
    return sorted(((-1 if r.doc_id is None else r.doc_id), r.text, r.lang, r.source or "", r.n_chars) for r in df.collect())


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, results = docs.columns, []
    for name, stage in pipeline.STAGES:
        results.append((name, docs, stage(spark, docs, folder)))
        docs = pipeline.staged(results[-1][2], name)
    for name, before, after in results[:-1]:
        assert after.columns == columns and dict(after.dtypes) == dict(before.dtypes), name
    got = {name: (plain(before), plain(after)) for name, before, after in results[:-1]}

    before, after = got["quality_rules"]
    first = min(d for d, t, *_ in before if t and NOTICE in t)
    want = []
    for d, t, lang, s, _ in before:
        c = plain_counts(t)
        if c[0] >= line_rules.MIN_WORDS and 100 * c[4] <= line_rules.MAX_REPEAT_PERCENT * c[0]:
            t = t if d == first else "\n".join(x for x in t.split("\n") if x != NOTICE)
            want.append((d, t, lang, s, len(t)))
    assert after == sorted(want) and len(want) < len(before)

    before, after = got["quality_classifier"]
    stages = dict((n, b) for n, b, _ in results)
    model = knn_quality.fit(stages["quality_classifier"], spark.read.parquet(f"{folder}/labels.parquet"))
    scores = model.score([r[1] for r in before])
    assert after == [r for r, s in zip(before, scores) if s >= knn_quality.THRESHOLD]
    assert {r[0] for r in before} - {r[0] for r in after} == {300 + i for i in range(40)}

    before, after = got["simhash_dedup"]
    kept = []
    for r in sorted(before, key=lambda r: (r[0] < 0, r[0])):  # the families here are stars of two
        if not any(near_dedup.jaccard(r[1], k[1], 5) >= 0.8 for k in kept):
            kept.append(r)
    assert after == sorted(kept) and {200 + i for i in range(6)} | {210 + i for i in range(6)} <= {r[0] for r in before} - {r[0] for r in after}

    before, after = got["source_mixing"]
    report = {r.doc_id: r.copies for r in mixing.mixture_report(stages["source_mixing"]).collect()}
    assert Counter(after) == Counter({r: report[None if r[0] < 0 else r[0]] for r in before if report[None if r[0] < 0 else r[0]]})

    before, pieces = plain(stages["sequence_packing"]), results[-1][2].toPandas()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    want = Counter()
    for d, t, *_ in before:
        ids, at = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], "<u4"), 0
        for length, _ in packing.cut(len(ids)):
            want[(d, at, length, zlib.crc32(ids[at:at + length].tobytes()), len(ids))] += 1
            at += length
    seen = pieces.assign(doc_id=pieces.doc_id.fillna(-1).astype(int))[["doc_id", "start", "length", "ids_crc32", "doc_tokens"]]
    assert Counter(map(tuple, seen.itertuples(index=False))) == want
    room = defaultdict(int)
    for r in pieces.itertuples():
        room[r.sequence_id] += r.length
    assert max(room.values()) <= packing.CAPACITY


def test_run_removes_what_it_no_longer_needs(spark, folder):
    before = set(pipeline.made(spark))
    out = pipeline.run(spark, folder)
    assert out.count() > 0 and len([p for p in pipeline.made(spark) if p not in before]) == 1
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "quality_classifier", "simhash_dedup", "source_mixing", "sequence_packing"]
