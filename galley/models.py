"""Model stages: interfaces, batched Arrow calls around them, and what surrounds each call.

Weights are not part of this package.  A backend is any picklable callable; it is made once per
Python worker by its factory and fed whole Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .operators.knn import nearest, pooled, with_fallback
from .operators.lines import end_mark, recognised_words
from .operators.staging import staged
from .schemas import LEGIBILITY, NO_LEGIBILITY

BATCH = 64


class Detector(Protocol):
    """Images as bytes to lists of (x0, y0, x1, y1, conf, cls) on the model's canvas."""

    def __call__(self, images: list[bytes]) -> list[list[tuple[float, float, float, float, float, int]]]: ...


class Encoder(Protocol):
    """Crops as bytes to unit vectors."""

    def __call__(self, crops: list[bytes]) -> np.ndarray: ...


class Classifier(Protocol):
    """Crops as bytes to class scores."""

    def __call__(self, crops: list[bytes]) -> np.ndarray: ...


class Embedder(Protocol):
    """Texts to token vectors (tokens x width) per text."""

    def __call__(self, texts: list[str]) -> list[np.ndarray]: ...


class TextReader(Protocol):
    """A page or region image to text (an OCR service or engine)."""

    def __call__(self, images: list[bytes]) -> list[str]: ...


class BlankDetector:
    """A stand-in: the whole canvas is one article."""

    def __call__(self, images):
        return [[(0.0, 0.0, 1280.0, 1280.0, 1.0, 0)] for _ in images]


class HashEncoder:
    """A stand-in: a seeded unit vector per content."""

    def __init__(self, width: int = 16):
        self.width = width

    def __call__(self, crops):
        out = np.zeros((len(crops), self.width))
        for i, c in enumerate(crops):
            seed = int.from_bytes((bytes(c) + b"\0" * 8)[:8], "little") % (1 << 32)
            out[i] = np.random.default_rng(seed).standard_normal(self.width)
        return out / np.linalg.norm(out, axis=1, keepdims=True)


def outer_inputs(inputs: Column, initialisers: Column) -> Column:
    """Names of a model graph's inputs that a caller must feed: those that no initialiser fills."""
    return F.array_except(inputs, initialisers)


def detect(images: DataFrame, make: Callable[[], Detector], key: str = "scan_id", content: str = "content", batch: int = BATCH) -> DataFrame:
    """(key, det, x0, y0, x1, y1, conf, cls, error): a failing batch is tried image by image, and a
    failing image gives one row with its error."""
    schema = images.select(key).schema.add("det", "integer")
    for c in ("x0", "y0", "x1", "y1", "conf"):
        schema = schema.add(c, "double")
    schema = schema.add("cls", "integer").add("error", "string")
    names = schema.names

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for part in parts:
            rows: list[tuple] = []
            for at in range(0, len(part), batch):
                p = part.iloc[at:at + batch]
                try:
                    found = list(zip(p[key], model(list(p[content])), [None] * len(p)))
                except Exception:  # noqa: BLE001  one bad image must not lose its batch
                    found = []
                    for k, c in zip(p[key], p[content]):
                        try:
                            found.append((k, model([c])[0], None))
                        except Exception as e:  # noqa: BLE001
                            found.append((k, [], f"{type(e).__name__}: {e}"))
                for k, dets, error in found:
                    rows += [(k, i, *map(float, d[:5]), int(d[5]), None) for i, d in enumerate(dets)]
                    if error:
                        rows.append((k, -1, None, None, None, None, None, None, error))
            frame = pd.DataFrame(rows, columns=names)
            yield frame.astype({"det": "Int32", "cls": "Int32"}) if len(frame) else frame

    return images.select(key, content).mapInPandas(run, schema)


def encode(crops: DataFrame, make: Callable[[], Encoder], content: str = "content", out: str = "vec", batch: int = BATCH) -> DataFrame:
    """Adds unit vectors; batches are of a fixed size at most, and a crop that fails gives zeros.  Their width is
    the model's ``width`` if it has one, else that of the vectors before; null while none is known."""
    @F.pandas_udf("array<double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        width = getattr(model, "width", 0)
        for s in parts:
            rows: list = []
            for at in range(0, len(s), batch):
                p = list(s.iloc[at:at + batch])
                try:
                    rows += list(np.asarray(model(p), np.float64))
                except Exception:  # noqa: BLE001
                    for c in p:
                        try:
                            rows.append(np.asarray(model([c]), np.float64)[0])
                        except Exception:  # noqa: BLE001
                            rows.append(None)
            width = next((len(r) for r in rows if r is not None), width)
            nothing = [0.0] * width if width else None
            yield pd.Series([nothing if r is None else r.tolist() for r in rows], dtype=object)

    return crops.withColumn(out, run(F.col(content)))


def legibility(crops: DataFrame, make: Callable[[], Classifier], content: str = "content") -> DataFrame:
    """Adds ``legibility``, the best of three classes; NA without content."""
    from .functions.geometry import argmax

    scored = encode(crops, make, content, "__scores")
    label = F.get(F.array(*[F.lit(x) for x in LEGIBILITY]), argmax(F.col("__scores")))
    return scored.withColumn("legibility", F.coalesce(F.when(F.col(content).isNotNull(), label), F.lit(NO_LEGIBILITY))).drop("__scores")


def keep_legible(crops: DataFrame) -> DataFrame:
    return crops.where(F.col("legibility") != "Illegible")


def recognise(words: DataFrame, chars: DataFrame, word_refs: DataFrame, char_refs: DataFrame, threshold: float) -> DataFrame:
    """Words (word_id, line_id, word_idx, vec) and their characters (word_id, char_idx, vec) to words
    with text: the last character is looked at for an end mark, the word's nearest neighbour counts
    above the threshold, else its characters do."""
    found = nearest(words.select(F.col("word_id").alias("query_id"), "vec"), word_refs).select(F.col("query_id").alias("word_id"), F.col("label").alias("word_label"), F.col("sim").alias("word_sim"))
    # A character has two keys; in a written table one number of its own stands for both.
    each = staged(chars.select("word_id", "char_idx", "vec").withColumn("query_id", F.monotonically_increasing_id()), "chars")
    near = nearest(each.select("query_id", "vec"), char_refs).select("query_id", "label")
    spelled = each.select("word_id", "char_idx", "query_id").join(near, "query_id").groupBy("word_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("char_idx", "label"))), lambda c: c["label"]).alias("labels"))
    last = end_mark(F.element_at("labels", -1))
    spelled = spelled.select("word_id", last.alias("end_mark"), F.when(last.isNotNull(), F.slice("labels", 1, F.size("labels") - 1)).otherwise(F.col("labels")).alias("char_labels"))
    all_ = words.select("word_id", "line_id", "word_idx").join(found, "word_id").join(spelled, "word_id", "left").withColumn("char_labels", F.coalesce("char_labels", F.array().cast("array<string>")))
    return recognised_words(all_, threshold)


def read_pages(images: DataFrame, make: Callable[[], TextReader], content: str = "content", out: str = "scan_ocr") -> DataFrame:
    """Adds the text that a page reader gives, ``na`` where it fails."""
    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = make()
        for s in parts:
            try:
                yield pd.Series(reader(list(s)), dtype=object)
            except Exception:  # noqa: BLE001
                yield pd.Series(["na"] * len(s), dtype=object)

    return images.withColumn(out, run(F.col(content)))


def embed(texts: DataFrame, make: Callable[[], Embedder], text: str = "text", pooling: str = "mean", out: str = "vec", layer: int = -1, window: int | None = None) -> DataFrame:
    """Adds one vector per text: mean, max, cls (first token) or cat (mean and max side by side) of its tokens.

    An embedder that gives all its layers (layers x tokens x width) is read at ``layer``.  With a window, a text of
    more blank-separated words goes in pieces of that many words, whose tokens are pooled together: whole texts,
    however long, at a bounded size per call.  A text without tokens gives an empty vector.
    """
    def pool(v: np.ndarray) -> list[float]:
        if not len(v):
            return []
        parts = {"mean": [v.mean(0)], "max": [v.max(0)], "cls": [v[0]], "cat": [v.mean(0), v.max(0)]}[pooling]
        return np.concatenate(parts).astype(float).tolist()

    def pieces(t: str) -> list[str]:
        words = t.split() if window else []
        return [t] if not window or len(words) <= window else [" ".join(words[i:i + window]) for i in range(0, len(words), window)]

    @F.pandas_udf("array<double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for s in parts:
            cut = [pieces("" if t is None else t) for t in s]
            flat, found = [p for c in cut for p in c], []
            for at in range(0, len(flat), BATCH):
                found += [a[layer] if a.ndim == 3 else a for a in map(np.asarray, model(flat[at:at + BATCH]))]
            each, rows = iter(found), []
            for c in cut:
                own = [a for a in (next(each) for _ in c) if len(a)]
                rows.append(pool(np.concatenate(own)) if own else [])
            yield pd.Series(rows, dtype=object)

    return texts.withColumn(out, run(F.col(text)))


def reduced(vectors: DataFrame, k: int, vec: str = "vec", out: str = "low") -> DataFrame:
    """Adds k principal components."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = vectors.withColumn("__v", array_to_vector(F.transform(vec, lambda x: x.cast("double"))))
    return PCA(k=k, inputCol="__v", outputCol="__o").fit(v).transform(v).withColumn(out, vector_to_array("__o")).drop("__v", "__o")


__all__ = ["Classifier", "Detector", "Embedder", "Encoder", "TextReader", "detect", "embed", "encode", "keep_legible", "legibility", "pooled", "read_pages", "recognise", "reduced", "with_fallback"]
