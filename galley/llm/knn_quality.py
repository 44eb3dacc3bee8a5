"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A text becomes a bag of hashed features (its words, and its word shapes, which carry casing,
symbols and layout), weighted by log counts and inverse document frequency, and is projected to
DIM latent dimensions: a seeded random sketch followed by the leading eigenvectors of the
sketches' second moments, a randomised truncated SVD.  The labelled vectors, a bounded sample of
PER_CLASS documents of each label, are sent to the tasks; every document is compared with all of
them in exact blocked cosine products, and its K nearest vote with their similarity as weight
(times the inverse of their class's sampling rate, so a bounded sample votes as all would; and with a
vote of PRIOR for the base rate, which decides where no neighbour is similar).

The sample is chosen by hash of the id from documents whose crc32(doc_id) mod 4 is not 2.  Only
texts enter a score.  Bounds: 2 x PER_CLASS x DIM floats are broadcast (1.5 MB); a class's counts
come from all labelled rows.

Cases: empty and null texts get a feature of their own; a text whose vector is zero, or a table
without labels, scores the base rate of label 1 (1 without labels); null ids are never held out
and never learned from; repeated rows score alike; ids labelled several times count each time;
labelled texts that tie with the K-th neighbour all vote; very long texts are read whole; an empty
table gives no rows; other columns are carried, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import fresh, staged
from .worker import memo

WORDS, SHAPES = 1 << 14, 1 << 12
SIZE = WORDS + SHAPES
SKETCH, DIM = 192, 48
PER_CLASS = 3_000
K = 25
PRIOR = 0.2
THRESHOLD = 0.7
SEED = 7
BLOCK = 256
SHAPE_WEIGHT, WORD_WEIGHT = 1.0, 0.5
MEMO_ITEMS = 300_000


def shape_of(word: str) -> str:
    """Casing, digits and symbols of a whole word, runs cut to two: ``THE!!`` is ``AA!!``."""
    marks = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return re.sub(r"(?s)(.)\1+", r"\1\1", marks)


class WordCodes(dict):
    """Word to its word and shape features in one number."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_ITEMS:
            self.clear()
        code = zlib.crc32(word.lower().encode()) % WORDS * SHAPES + zlib.crc32(shape_of(word).encode()) % SHAPES
        if len(word) <= 100:
            self[word] = code
        return code


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (words, then shapes) with their counts, over the whole text."""
    text = text or ""
    lines = text.split("\n")
    words = text.split()
    extra = ["\x00empty"] if not words else []
    codes = np.fromiter(map(memo("word codes", WordCodes).__getitem__, words + extra), np.int64, len(words) + len(extra))
    w, wc = np.unique(codes // SHAPES, return_counts=True)
    s, sc = np.unique(codes % SHAPES, return_counts=True)
    n = max(1, len(words))
    facts = [f"\x00lines{int(4.99 * (1 - len(set(lines)) / len(lines)))}", f"\x00size{len(words).bit_length()}",
             f"\x00same{int(4.99 * sum(map(str.__eq__, words, words[1:])) / n)}", f"\x00few{int(4.99 * (1 - len(w) / n))}"]
    f = np.array([WORDS + zlib.crc32(x.encode()) % SHAPES for x in facts])
    return np.concatenate([w, WORDS + s, f]), np.concatenate([wc, sc, np.full(len(f), max(1, len(words) // 8))])


def _weights(at: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1 + np.log(count)) * idf[at]
    for part, weight in ((at < WORDS, WORD_WEIGHT), (at >= WORDS, SHAPE_WEIGHT)):
        norm = np.sqrt((v[part] ** 2).sum())
        if norm:
            v[part] *= weight / norm
    return v


def sketch_matrix() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((SIZE, SKETCH)).astype(np.float32) / np.float32(np.sqrt(SKETCH))


def project(texts, idf: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), matrix.shape[1]), np.float32)
    for i, text in enumerate(texts):
        at, count = features(text)
        out[i] = _weights(at, count, idf).astype(np.float32) @ matrix[at]
    return out


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(1, keepdims=True))
    return (x / np.where(norm > 0, norm, 1)).astype(np.float32)


def vote(x: np.ndarray, vectors: np.ndarray, labels: np.ndarray, weights: np.ndarray, base: float, k: int = K) -> np.ndarray:
    """Scores of unit rows x against the labelled unit vectors, block by block: the k nearest, and all
    that tie with the k-th, vote with their similarity."""
    out = np.full(len(x), base)
    k = min(k, len(vectors))
    for i in range(0, len(x), BLOCK) if k else ():
        sim = x[i:i + BLOCK] @ vectors.T
        least = np.partition(sim, len(vectors) - k, axis=1)[:, len(vectors) - k, None]
        s = np.where(sim >= np.maximum(least, 0), sim, 0).astype(np.float64)
        out[i:i + BLOCK] = (s @ (weights * labels) + PRIOR * base) / (s @ weights + PRIOR)
    return out


class Model:
    """What scoring needs: idf, projection, labelled vectors, labels, vote weights, base rate."""

    def __init__(self, idf, matrix, vectors, labels, weights, base):
        self.idf, self.matrix, self.vectors, self.labels, self.weights, self.base = idf, matrix, vectors, labels, weights, base

    def score(self, texts) -> np.ndarray:
        return np.clip(vote(unit(project(texts, self.idf, self.matrix)), self.vectors, self.labels, self.weights, self.base), 0.0, 1.0)


def held_out(doc_id) -> object:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("y")).where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    totals = {r["y"]: r["c"] for r in marked.groupBy("y").agg(F.count("*").alias("c")).collect()}
    parts = [marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1])  # at most 2 x per_class rows
    sample = staged(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y"), "labelled")

    def partial_df(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(SIZE), 0
        for part in parts:
            for text in part["text"]:
                df[features(text)[0]] += 1
                n += 1
        yield pd.DataFrame({"n": [n], "v": [df.tobytes()]})

    got = [(r.n, np.frombuffer(r.v)) for r in sample.select("text").mapInPandas(partial_df, "n long, v binary").collect()]
    n = sum(g[0] for g in got)
    idf = np.log((1 + n) / (1 + sum((g[1] for g in got), np.zeros(SIZE)))) + 1

    def vectors(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            m = sketch_matrix() if matrix is None else matrix
            for part in parts:
                yield pd.DataFrame({"y": part["y"], "v": [r.tobytes() for r in project(part["text"], idf, m)]})

        rows = sample.mapInPandas(run, "y int, v binary").collect()  # bounded by the sample
        rows.sort(key=lambda r: (r.v, r.y))
        width = SKETCH if matrix is None else matrix.shape[1]
        return np.frombuffer(b"".join(r.v for r in rows), np.float32).reshape(-1, width), np.array([r.y for r in rows], np.float64)

    x, y = vectors(None)
    x = unit(x)
    values, axes = np.linalg.eigh((x.T @ x).astype(np.float64)) if len(x) else (np.ones(SKETCH), np.eye(SKETCH))
    axes = axes[:, ::-1][:, :DIM].astype(np.float32)
    matrix, x = sketch_matrix() @ axes, unit(x @ axes)
    every = sum(totals.values())
    base = totals.get(1, 0) / every if every else 1.0
    taken = {c: int((y == c).sum()) for c in (0, 1)}
    weights = np.array([totals[int(c)] / taken[int(c)] for c in y])
    if len(weights):
        weights /= weights.max()
    return Model(idf, matrix, x, y, weights, base)


def with_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((model.idf, model.matrix, model.vectors, model.labels, model.weights, model.base))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = Model(*shared.value)
        for s in texts:
            yield pd.Series(m.score(s), dtype="float64")

    return docs.withColumn(out, score(F.col(text_col)))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without documents that score below the threshold; all columns stay."""
    score = fresh(docs, "__score")
    return with_score(docs, fit(docs, labels), out=score).where(F.col(score) >= threshold).drop(score)
