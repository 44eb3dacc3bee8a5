"""Greedy non-maximum suppression, per image, in Arrow batches of many images."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import NMS_CLASS_OFFSET, NMS_ROWS


def greedy_nms(boxes: np.ndarray, conf: np.ndarray, limit: float) -> list[int]:
    """Indices kept, best first; equal scores go by place."""
    order = np.argsort(-conf, kind="stable")
    x0, y0, x1, y1 = boxes.T
    area = (x1 - x0) * (y1 - y0)
    kept = []
    while len(order):
        i, rest = order[0], order[1:]
        kept.append(int(i))
        w = np.clip(np.minimum(x1[i], x1[rest]) - np.maximum(x0[i], x0[rest]), 0, None)
        h = np.clip(np.minimum(y1[i], y1[rest]) - np.maximum(y0[i], y0[rest]), 0, None)
        both = w * h
        order = rest[both <= limit * (area[i] + area[rest] - both + 1e-7)]
    return kept


def greedy_ranks(boxes: np.ndarray, starts: np.ndarray, limit: float, max_det: int) -> np.ndarray:
    """The place at which each box is kept, -1 for none.  Page p has rows starts[p] to starts[p + 1], best first; each
    step keeps the best box left of every page at once, so the steps are those of the page with most boxes kept."""
    x0, y0, x1, y1 = boxes.T
    area = (x1 - x0) * (y1 - y0)
    page = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    rank = np.full(len(boxes), -1, np.int32)
    left = np.arange(len(boxes))
    for step in range(max_det):
        if not len(left):
            break
        own = page[left]
        first = np.concatenate([[True], own[1:] != own[:-1]])
        rank[left[first]] = step
        i, rest = left[first][np.cumsum(first) - 1][~first], left[~first]
        w = np.clip(np.minimum(x1[i], x1[rest]) - np.maximum(x0[i], x0[rest]), 0, None)
        h = np.clip(np.minimum(y1[i], y1[rest]) - np.maximum(y0[i], y0[rest]), 0, None)
        both = w * h
        left = rest[both <= limit * (area[i] + area[rest] - both + 1e-7)]
    return rank


def suppress(detections: DataFrame, keys: list[str], iou: float, conf: float = 0.0, max_det: int = 300, agnostic: bool = True, classes=None) -> DataFrame:
    """Detections (keys, det, x0..y1, conf, cls) that stay, with their rank by score.  Scores must
    be above ``conf``; classes suppress each other only if ``agnostic``."""
    d = detections.where(F.col("conf") > conf)
    if classes is not None:
        d = d.where(F.col("cls").isin(*classes))
    box = F.struct((-F.col("conf")).alias("c"), "det", "x0", "y0", "x1", "y1", "conf", "cls")
    g = d.groupBy(*keys).agg(F.slice(F.sort_array(F.collect_list(box)), 1, NMS_ROWS).alias("g"))

    @F.arrow_udf("array<int>")
    def ranks(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array, cls: pa.Array) -> pa.Array:
        starts = x0.offsets.to_numpy() - x0.offsets[0].as_py()
        flat = lambda a: a.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        boxes = np.stack([flat(a) for a in (x0, y0, x1, y1)], 1)
        if not agnostic:
            boxes += flat(cls)[:, None] * NMS_CLASS_OFFSET
        rank = greedy_ranks(boxes, starts, iou, max_det)
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(rank, pa.int32(), mask=rank < 0))

    # One row per image with its detections as arrays, best first, so that an Arrow batch has many images.
    g = g.withColumn("r", ranks(*[F.col(f"g.{c}") for c in ("x0", "y0", "x1", "y1", "cls")]))
    each = g.select(*keys, F.explode(F.arrays_zip("g", "r")).alias("z")).where("z.r IS NOT NULL")
    return each.select(*keys, *[F.col(f"z.g.{c}").alias(c) for c in ("det", "x0", "y0", "x1", "y1", "conf", "cls")], F.col("z.r").alias("rank"))


def best_class(scores: DataFrame, with_objectness: bool, conf: float) -> DataFrame:
    """Rows with an array ``scores`` (and ``objectness``) to conf and cls of the best class.  With
    objectness, rows below the threshold go first and class scores are multiplied by it."""
    if with_objectness:
        scores = scores.where(F.col("objectness") > conf).withColumn("scores", F.transform("scores", lambda s: s * F.col("objectness")))
    best = F.array_max("scores")
    return scores.withColumn("cls", (F.array_position("scores", best) - 1).cast("int")).withColumn("conf", best).where(F.col("conf") > conf)


def merge_chunk_lines(lines: DataFrame, keys: list[str], iou: float = 0.15) -> DataFrame:
    """Lines of overlapping chunks, already in the region's coordinates: suppressed, in y order."""
    kept = suppress(lines, keys, iou, conf=float("-inf"), max_det=NMS_ROWS)
    return kept.withColumn("line_idx", F.row_number().over(Window.partitionBy(*keys).orderBy("y0", "det")) - 1)


def top_by_confidence(detections: DataFrame, keys: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("conf"), "det"))
    return detections.withColumn("rank", rank).where(F.col("rank") <= k)
