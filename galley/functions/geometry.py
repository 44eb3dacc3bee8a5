"""Box geometry as Column expressions: everything stays inside whole-stage code generation.

A box argument is any Column with struct fields x0, y0, x1, y1, or the dict that ``box`` makes
from four columns.  Quotients by zero-sized boxes are null rather than errors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-7
COCO80_TO_91 = (
    1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 25, 27, 28, 31, 32, 33, 34, 35, 36, 37, 38, 39, 40, 41,
    42, 43, 44, 46, 47, 48, 49, 50, 51, 52, 53, 54, 55, 56, 57, 58, 59, 60, 61, 62, 63, 64, 65, 67, 70, 72, 73, 74, 75, 76, 77, 78, 79, 80, 81,
    82, 84, 85, 86, 87, 88, 89, 90)


def bound(value: Column, f) -> Column:
    """``f`` of a value that is evaluated once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def box(x0="x0", y0="y0", x1="x1", y1="y1") -> dict[str, Column]:
    return {k: F.col(v) if isinstance(v, str) else v for k, v in (("x0", x0), ("y0", y0), ("x1", x1), ("y1", y1))}


def width(b) -> Column:
    return b["x1"] - b["x0"]


def height(b) -> Column:
    return b["y1"] - b["y0"]


def area(b) -> Column:
    return width(b) * height(b)


def interval_overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Length that two intervals share, zero when apart."""
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def overlaps(a, b) -> Column:
    """Whether the interiors meet (touching edges do not)."""
    return (a["x0"] < b["x1"]) & (b["x0"] < a["x1"]) & (a["y0"] < b["y1"]) & (b["y0"] < a["y1"])


def intersection(a, b) -> Column:
    return interval_overlap(a["x0"], a["x1"], b["x0"], b["x1"]) * interval_overlap(a["y0"], a["y1"], b["y0"], b["y1"])


def iou(a, b, eps: float = EPS) -> Column:
    """Intersection over union."""
    both = intersection(a, b).cast("double")
    return F.try_divide(both, area(a) + area(b) - both + F.lit(eps))


def iom(a, b) -> Column:
    """Intersection over the smaller box."""
    return F.try_divide(intersection(a, b).cast("double"), F.least(area(a), area(b)).cast("double"))


def is_valid(b) -> Column:
    """Neither degenerate nor left of the image."""
    return (b["x0"] != b["x1"]) & (b["y0"] != b["y1"]) & (b["x0"] >= 0)


def union(columns=("x0", "y0", "x1", "y1")) -> list[Column]:
    """Aggregates of the bounding box of a group."""
    x0, y0, x1, y1 = columns
    return [F.min(x0).alias("x0"), F.min(y0).alias("y0"), F.max(x1).alias("x1"), F.max(y1).alias("y1")]


def make(x0, y0, x1, y1) -> Column:
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


# Conversions.  xywh has the centre, ltwh the upper left corner; an n at the end means relative
# to the image's width and height.
def xyxy_to_xywh(b) -> Column:
    return F.struct(((b["x0"] + b["x1"]) / 2).alias("x"), ((b["y0"] + b["y1"]) / 2).alias("y"), width(b).alias("w"), height(b).alias("h"))


def xywh_to_xyxy(b) -> Column:
    return make(b["x"] - b["w"] / 2, b["y"] - b["h"] / 2, b["x"] + b["w"] / 2, b["y"] + b["h"] / 2)


def xyxy_to_xywhn(b, w: Column, h: Column, clip: bool = False, eps: float = 0.0) -> Column:
    c = xyxy_to_xywh(clip_box(b, w, h, eps) if clip else b)
    return F.struct((c["x"] / w).alias("x"), (c["y"] / h).alias("y"), (c["w"] / w).alias("w"), (c["h"] / h).alias("h"))


def xywhn_to_xyxy(b, w: Column, h: Column, pad_w=0, pad_h=0) -> Column:
    return make(w * (b["x"] - b["w"] / 2) + pad_w, h * (b["y"] - b["h"] / 2) + pad_h, w * (b["x"] + b["w"] / 2) + pad_w, h * (b["y"] + b["h"] / 2) + pad_h)


def xyxy_to_ltwh(b) -> Column:
    return F.struct(b["x0"].alias("x"), b["y0"].alias("y"), width(b).alias("w"), height(b).alias("h"))


def ltwh_to_xyxy(b) -> Column:
    return make(b["x"], b["y"], b["x"] + b["w"], b["y"] + b["h"])


def xywh_to_ltwh(b) -> Column:
    return F.struct((b["x"] - b["w"] / 2).alias("x"), (b["y"] - b["h"] / 2).alias("y"), b["w"].alias("w"), b["h"].alias("h"))


def ltwh_to_xywh(b) -> Column:
    return F.struct((b["x"] + b["w"] / 2).alias("x"), (b["y"] + b["h"] / 2).alias("y"), b["w"].alias("w"), b["h"].alias("h"))


def relative_points(points: Column, w: Column, h: Column, pad_w=0, pad_h=0) -> Column:
    """Relative segment points (array of x, y structs) to pixels."""
    return F.transform(points, lambda p: F.struct((p["x"] * w + pad_w).alias("x"), (p["y"] * h + pad_h).alias("y")))


def clip_box(b, w, h, eps: float = 0.0) -> Column:
    def into(v, most):
        return F.least(F.greatest(v, F.lit(0)), most - F.lit(eps))

    return make(into(b["x0"], w), into(b["y0"], h), into(b["x1"], w), into(b["y1"], h))


def scale_box(b, from_w, from_h, to_w, to_h) -> Column:
    """A box of a letterboxed canvas in the coordinates of the image, clipped to it."""
    gain = F.least(from_w / to_w, from_h / to_h)
    dx, dy = (from_w - to_w * gain) / 2, (from_h - to_h * gain) / 2
    return clip_box(make((b["x0"] - dx) / gain, (b["y0"] - dy) / gain, (b["x1"] - dx) / gain, (b["y1"] - dy) / gain), to_w, to_h)


def letterbox(w, h, canvas: int) -> Column:
    """Scaled size and left and top padding of an image that is fitted into a square canvas."""
    r = F.least(F.lit(float(canvas)) / h, F.lit(float(canvas)) / w)
    nw, nh = F.bround(w * r), F.bround(h * r)
    dw, dh = (canvas - nw) / 2, (canvas - nh) / 2
    return F.struct(r.alias("ratio"), nw.cast("int").alias("w"), nh.cast("int").alias("h"), F.bround(dw - 0.1).cast("int").alias("left"), F.bround(dh - 0.1).cast("int").alias("top"))


def letterbox_inverse(b, w, h, canvas: int) -> Column:
    """A canvas box in source pixels: lower ends are floored, upper ends are raised.  The longer
    side fills the canvas, the shorter one is centred."""
    side = F.greatest(w, h)
    fit = lambda v, own: (v * side / F.lit(canvas)) - (side - own) / 2
    return make(F.floor(fit(b["x0"], w)).cast("int"), F.floor(fit(b["y0"], h)).cast("int"), F.ceil(fit(b["x1"], w)).cast("int"), F.ceil(fit(b["y1"], h)).cast("int"))


def line_box(b, w, h, canvas: int = 640, vertical: bool = False) -> Column:
    """A character box of the localizer's canvas in its line image, over the full line height
    (or width, for vertical lines)."""
    if vertical:
        return make(F.lit(0), F.bround(b["y0"] * h / canvas).cast("int"), w, F.bround(b["y1"] * h / canvas).cast("int"))
    return make(F.bround(b["x0"] * w / canvas).cast("int"), F.lit(0), F.bround(b["x1"] * w / canvas).cast("int"), h)


def tall_chunks(w: Column, h: Column) -> Column:
    """Array of (chunk, y0, y1): one window for a region up to twice as tall as wide, else windows
    of 2w at a stride of int(1.5w), and a last one from the next stride to the bottom."""
    w, h = w.cast("int"), h.cast("int")
    stride = F.floor(w * 1.5).cast("int")
    whole = F.filter(F.sequence(F.lit(0), F.floor(h / stride).cast("int")), lambda i: i * stride + 2 * w <= h)
    n = F.size(whole)
    windows = F.transform(whole, lambda i: F.struct(i.alias("chunk"), (i * stride).alias("y0"), (i * stride + 2 * w).alias("y1")))
    rest = F.array(F.struct(n.alias("chunk"), (n * stride).alias("y0"), h.alias("y1")))
    one = F.array(F.struct(F.lit(0).alias("chunk"), F.lit(0).alias("y0"), h.alias("y1")))
    return F.when((h <= 2 * w) | (w <= 0), one).otherwise(F.concat(windows, rest))


def chunk_offset(chunk: Column, w: Column) -> Column:
    """What the rows of a chunk's detections are moved by."""
    return chunk * F.floor(w * 1.5).cast("int")


def is_banner(b, page_w: Column, page_h: Column, lines: Column) -> Column:
    """A headline over two thirds of the page whose lines are taller than a fiftieth of it."""
    return (width(b) * 3 > page_w * 2) & (F.try_divide(height(b).cast("double"), lines.cast("double")) > page_h / 50)


def segment_to_box(points: Column, w: Column, h: Column) -> Column:
    """Bounding box of a segment's points inside the image; null if none is."""
    inside = F.filter(points, lambda p: (p["x"] >= 0) & (p["y"] >= 0) & (p["x"] <= w) & (p["y"] <= h))

    def ends(found: Column) -> Column:
        xs, ys = F.transform(found, lambda p: p["x"]), F.transform(found, lambda p: p["y"])
        return F.when(F.size(found) > 0, make(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))

    return bound(inside, ends)


def segment_point(points: Column, i: Column, n: int = 1000) -> Column:
    """Point ``i`` (from 0) of ``n`` at even steps along the closed segment's point index, interpolated."""
    last = F.size(points)  # of the closed segment, whose last point is the first
    step = i.cast("double") * last / F.lit(max(n - 1, 1))
    lo = F.least(F.floor(step).cast("int"), last - 1)
    a, b = F.get(points, lo), F.get(points, F.when(lo + 1 < last, lo + 1).otherwise(0))
    return F.struct(*[(a[c] + (b[c] - a[c]) * (step - lo)).alias(c) for c in "xy"])


def resample_segment(points: Column, n: int = 1000) -> Column:
    """``n`` points at even steps along the closed segment's point index, as an array.  The points are bound once:
    a lambda evaluates anew, for every element, what it names."""
    return bound(points, lambda p: F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: segment_point(p, i, n)))


def mask_box(points: Column) -> Column:
    """Bounding box of segmentation points, (x, y) alternating in one array."""
    even = F.filter(points, lambda v, i: i % 2 == 0)
    odd = F.filter(points, lambda v, i: i % 2 == 1)
    return make(F.array_min(even), F.array_min(odd), F.array_max(even), F.array_max(odd))


def contract(b, share: float) -> Column:
    """A box shrunk by ``share`` of its size on each side."""
    return make(b["x0"] + width(b) * share, b["y0"] + height(b) * share, b["x1"] - width(b) * share, b["y1"] - height(b) * share)


def coco_annotation(b, image_id: Column, annotation_id: Column, category_id: Column, score: Column | None = None) -> Column:
    corner = F.array(b["x0"], b["y0"], b["x0"], b["y1"], b["x1"], b["y1"], b["x1"], b["y0"])
    return F.struct(
        F.array(corner).alias("segmentation"), area(b).alias("area"), F.lit(0).alias("iscrowd"), image_id.alias("image_id"),
        F.array(b["x0"], b["y0"], width(b), height(b)).alias("bbox"), category_id.alias("category_id"), annotation_id.alias("id"),
        (F.lit(1.0) if score is None else score).alias("score"))


def coco_image(name: Column, w: Column, h: Column, image_id: Column) -> Column:
    return F.struct(name.alias("file_name"), h.alias("height"), w.alias("width"), image_id.alias("id"))


def border_median(image: Column, channels: int = 3) -> Column:
    """Per channel the median (cut to a whole number) of the four edges of an image, an array of rows of pixels;
    corners count twice.  It fills what is padded."""
    def values(edge: Column, c: int) -> Column:
        return F.sort_array(F.transform(edge, lambda p: p[c]))  # nulls first; they count as the largest

    def middle(v: Column) -> Column:
        n, nulls = F.size(v), F.size(v) - F.size(F.array_compact(v))
        return F.floor((F.get(v, nulls + F.shiftright(n - 1, 1)) + F.get(v, nulls + F.shiftright(n, 1))) / 2).cast("int")

    def edge(i: Column) -> Column:
        return F.concat(F.transform(i, lambda r: F.element_at(r, -1)), F.transform(i, lambda r: r[0]), i[0], F.element_at(i, -1))

    return bound(bound(image, edge), lambda e: F.array(*[bound(values(e, c), middle) for c in range(channels)]))


def yolo_box(percent_x, percent_y, percent_w, percent_h) -> Column:
    """A percent box with its upper left corner to a relative box with its centre."""
    return F.struct(((percent_x + percent_w / 2) / 100).alias("x"), ((percent_y + percent_h / 2) / 100).alias("y"), (percent_w / 100).alias("w"), (percent_h / 100).alias("h"))


def make_divisible(x: Column, by: int) -> Column:
    return (F.ceil(x / by) * by).cast("int")


def coco91(cls: Column) -> Column:
    """Category of 91 for a class of 80 (from 0); null outside."""
    return F.get(F.array(*[F.lit(i) for i in COCO80_TO_91]), cls)


def l2_normalise(v: Column) -> Column:
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: F.try_divide(x.cast("double"), norm))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def argmax(v: Column) -> Column:
    """Index from 0 of the first largest element."""
    return (F.array_position(v, F.array_max(v)) - 1).cast("int")
