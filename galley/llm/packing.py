"""Harmonic packing of tokenised documents into sequences of fixed capacity.

Class k (reciprocal of the capacity) holds pieces of more than capacity / (k + 1) and at most capacity / k
tokens, and a bin of the class is filled with exactly k of them.  A document gives full pieces as
long as a whole capacity is left; the remainder is classified whole, or cut first where that
saves padding: into a piece that fills a class and a rest, again cut or not.  Of all ways to
do so the one with the least padding is taken (a cut counts as CUT_COST tokens of it), and no piece that a cut makes is shorter than
FLOOR; whole remainders alone would waste a quarter and more, and free cuts would shred documents.

Bins are filled independently: a piece's rank in its class is the offset of its hash bucket plus
its place in it, rank // k names the bin, and no task sees a whole class.  The last bins of the
classes that stay short of k pieces hold fewer than sum(k) pieces altogether, a constant of the
capacity, and are packed once more by first fit in one small task.

Tokens: ids of the public word-level BPE file, then id 1.  Blank-separated chunks are encoded
through a memo, which is exact since that tokenizer never merges across blanks.

Cases: null and empty texts have the one token 1; very long texts give many pieces; pieces of one
length are ranked by hash, so ties fall anyhow; repeated rows are packed as often as they occur; null ids are
kept; an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .sharding import bucket_count
from .staging import small_side, staged
from .worker import memo

CAPACITY = 2048
FLOOR = 128  # no cut makes a shorter piece
CUT_COST = 12.0
END = 1
TOKENIZER = "word_bpe_49k.json"
MEMO_ITEMS = 700_000
BATCH_ROWS = 2000  # of an Arrow batch with texts


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Letters that lower-case and normalise one by one, then marks that the tokenizer cuts off.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\[-`{-~]*)")


class Memo(dict):
    """Chunk to the bytes of its ids.  Letters with marks behind them are put together from the
    entries of the lower-case letters and of the marks, so fewer chunks reach the tokenizer.  When
    full, the memo starts anew over the entries of the last generation."""

    def __init__(self, tokenizer, simple):
        super().__init__({"": b""})
        self.tokenizer, self.simple, self.last = tokenizer, simple, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.last.get(chunk)
        if ids is None:
            letters, marks = m.groups() if (m := self.simple(chunk)) else (None, None)
            if marks:
                ids = self[letters.lower()] + self[marks]
            elif letters and letters != (low := letters.lower()):
                ids = self[low]
            else:
                ids = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        if len(chunk) <= 200:
            if len(self) >= MEMO_ITEMS:
                self.last = dict(self)
                self.clear()
                self[""] = b""
            self[chunk] = ids
        return ids


def token_encoder(path: str):
    """text to little-endian uint32 ids, as bytes; the memo lives as long as the worker."""
    def make() -> Memo:
        from tokenizers import Tokenizer

        return Memo(Tokenizer.from_file(path), _SIMPLE.fullmatch)

    known = memo(f"tokens of {path}", make)

    def encode(text: str | None) -> bytes:
        chunks = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(known.__getitem__, chunks))

    return encode


@functools.lru_cache(8)
def _cuts(capacity: int, floor: int, cost: float) -> list[tuple[float, int]]:
    """By length up to capacity + floor: padding of the best way, and its first piece."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    sizes = [(capacity // k, capacity / k - capacity // k) for k in range(2, capacity // floor + 1)]
    for r in range(1, capacity + floor):
        ways = [(capacity / (capacity // r) - r, r)] if r <= capacity else []
        ways += [(waste + cost + best[r - size][0], size) for size, waste in sizes if r - size >= floor]
        best.append(min(ways, key=lambda w: (w[0], -w[1]), default=(float("inf"), 0)))
    return best


def cut(length: int, capacity: int = CAPACITY, floor: int = FLOOR, cost: float = CUT_COST) -> list[tuple[int, int]]:
    """Piece lengths of a document with their classes, in order."""
    best = _cuts(capacity, floor, cost)
    full, rest = divmod(length, capacity)
    if full and 0 < rest < floor and best[capacity + rest][1]:  # too little for a piece of its own
        full, rest = full - 1, rest + capacity
    pieces = [(capacity, 1)] * full
    while rest:
        size = best[rest][1]
        pieces.append((size, capacity // size))
        rest -= size
    return pieces


def pieces_of(docs: DataFrame, id_col: str, text_col: str, path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, k."""
    id_type = dict(docs.dtypes)[id_col]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = token_encoder(path)
        end = np.array([END], "<u4").tobytes()
        for part in parts:
            out: list[tuple] = []
            for doc, text in zip(part["d"].array, part["t"].array):
                ids = encode(None if text is None or text is pd.NA else text) + end
                n, at = len(ids) // 4, 0
                for length, k in cut(n):
                    out.append((doc, at, length, zlib.crc32(ids[4 * at:4 * (at + length)]), n, k))
                    at += length
            frame = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "k"])
            yield frame.astype({"doc_id": part["d"].dtype})

    d = docs.select(F.col(id_col).cast("string").alias("d"), F.col(text_col).alias("t"))
    made = d.mapInPandas(run, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, k int")
    return made.withColumn("doc_id", F.col("doc_id").cast(id_type))


def first_fit(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each length, longest first into the first bin with room.  The bins are at
    most a few hundred (the remainders of the classes)."""
    filled: list[int] = []
    out: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        for b, f in enumerate(filled):
            if f + lengths[i] <= capacity:
                break
        else:
            b, f = len(filled), 0
            filled.append(0)
        out[i] = (b, f)
        filled[b] += lengths[i]
    return out


def pack(docs: DataFrame, id_col="doc_id", text_col="text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset per piece."""
    made = pieces_of(docs, id_col, text_col, path or tokenizer_path())
    rows = staged(made.withColumn("__id", F.monotonically_increasing_id()), "pieces", BATCH_ROWS)
    buckets = bucket_count(rows.count())
    rows = rows.withColumn("__b", F.pmod(F.xxhash64("__id"), F.lit(buckets)))
    counts = staged(rows.groupBy("k", "__b").agg(F.count("*").alias("__c")), "counts")
    earlier = Window.partitionBy("k").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("k", "__b", F.coalesce(F.sum("__c").over(earlier), F.lit(0)).alias("__o"), F.sum("__c").over(Window.partitionBy("k")).alias("__n"))
    offsets = staged(offsets, "offsets")
    within = Window.partitionBy("k", "__b").orderBy("__id")
    rows = rows.withColumn("__r", F.row_number().over(within) - 1).join(small_side(offsets, 1_000_000), ["k", "__b"])
    rows = rows.withColumn("__r", F.col("__r") + F.col("__o"))
    rows = rows.withColumn("__bin", F.expr("__r div k")).withColumn("__whole", F.expr("__bin < __n div k"))
    rows = staged(rows.drop("__b", "__o", "__n"), "ranked")
    # Inside a bin pieces are laid end to end: their places follow from the bin's pieces.
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    place = Window.partitionBy("k", "__bin").orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)
    full = rows.where("__whole").select(
        *cols, F.expr(f"__bin * {capacity + 1}L + k").alias("sequence_id"),
        F.coalesce(F.sum("length").over(place), F.lit(0)).alias("offset"))
    id_type = dict(rows.dtypes)["doc_id"]

    def rest(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["k", "__r"], kind="stable")
        at = first_fit(group["length"].tolist(), capacity)
        return group.assign(sequence_id=[-1 - b for b, _ in at], offset=[o for _, o in at])[[*cols, "sequence_id", "offset"]]

    short = rows.where("NOT __whole").withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("__one", F.lit(1))
    tail = short.groupBy("__one").applyInPandas(rest, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return full.unionByName(tail.withColumn("doc_id", F.col("doc_id").cast(id_type)))


def packing_summary(packed: DataFrame, capacity: int = CAPACITY, short: int = 64) -> DataFrame:
    """One row: documents, pieces, pieces shorter than ``short`` of documents that aren't, sequences, share of padding."""
    by_sequence = packed.groupBy("sequence_id").agg(
        F.count("*").alias("p"), F.sum((F.col("start") == 0).cast("long")).alias("d"), F.sum("length").alias("t"),
        F.sum(((F.col("length") < short) & (F.col("doc_tokens") >= short)).cast("long")).alias("s"))
    return by_sequence.agg(
        F.sum("d").alias("documents"), F.sum("p").alias("pieces"), F.sum("s").alias("shreds"), F.count("*").alias("sequences"),
        (1 - F.sum("t") / (F.count("*") * capacity)).alias("padding"))
