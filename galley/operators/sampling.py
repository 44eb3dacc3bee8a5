"""Class-balanced samples and splits, seeded by hash: equal input gives equal batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _shuffled(label: str, item: str, seed: int):
    return Window.partitionBy(label).orderBy(F.xxhash64(F.col(item), F.lit(seed)), item)


def m_per_class(items: DataFrame, label: str, item: str, m: int, seed: int | None = 0, batch_size: int | None = None) -> DataFrame:
    """m items of each class without repeats; classes with fewer are topped up with repeats.  A seed
    of None takes them in order of the item.  With a batch size the length is cut to whole batches."""
    w = Window.partitionBy(label).orderBy(item) if seed is None else _shuffled(label, item, seed)
    ranked = items.withColumn("__r", F.row_number().over(w)).withColumn("__n", F.count("*").over(Window.partitionBy(label)))
    # Rank r also stands in for r + n, r + 2n, ... as far as m.
    out = ranked.where(F.col("__r") <= m).withColumn("slot", F.explode(F.sequence(F.col("__r").cast("int"), F.lit(m), F.col("__n").cast("int"))))
    out = out.drop("__r", "__n")
    if batch_size:
        at = F.row_number().over(Window.orderBy(F.xxhash64(F.col(label), F.lit(seed or 0)), label, "slot"))  # m rows per class
        out = out.withColumn("__at", at).withColumn("__all", F.count("*").over(Window.partitionBy()))
        out = out.where(F.col("__at") <= F.expr(f"(__all div {batch_size}) * {batch_size}")).drop("__at", "__all")
    return out


def exhaustive_groups(items: DataFrame, label: str, item: str, m: int, seed: int = 0) -> DataFrame:
    """Every item once in groups of m of its class; the last group is filled up from the class's
    first items."""
    n = F.count("*").over(Window.partitionBy(label))
    r = items.withColumn("__r", F.row_number().over(_shuffled(label, item, seed)) - 1).withColumn("__n", n)
    r = r.withColumn("__missing", F.expr(f"({m} - __n % {m}) % {m}"))
    extra = r.withColumn("__slot", F.explode(F.expr(
        "filter(transform(sequence(0, cast(__missing as int)), i -> cast(__n + i as bigint)), s -> s < __n + __missing AND (s - __n) % __n = __r)")))
    own = r.withColumn("__slot", F.col("__r").cast("bigint"))
    out = own.unionByName(extra).withColumn("group", F.expr(f"__slot div {m}")).withColumn("slot", F.expr(f"__slot % {m}"))
    return out.drop("__r", "__n", "__missing", "__slot")


def batched_m_per_class(items: DataFrame, label: str, item: str, m: int, batch_size: int, num_passes: int = 1, seed: int = 0) -> DataFrame:
    """Batches of batch_size // m classes with m items each, num_passes times over; adds pass, batch."""
    if batch_size % m:
        raise ValueError("the batch size must be a multiple of m")
    per = batch_size // m
    out = None
    for p in range(num_passes):
        s = m_per_class(items, label, item, m, seed * 1000 + p)
        classes = items.select(label).distinct()
        order = F.row_number().over(Window.orderBy(F.xxhash64(F.col(label), F.lit(seed * 1000 + p)), label)) - 1  # classes
        classes = classes.withColumn("__c", order).withColumn("batch", F.expr(f"__c div {per}")).withColumn("__all", F.count("*").over(Window.partitionBy()))
        classes = classes.where(F.expr(f"__c < (__all div {per}) * {per}")).select(label, "batch")
        one = s.join(classes, label).withColumn("pass", F.lit(p))
        out = one if out is None else out.unionByName(one)
    return out


def with_hard_negatives(batches: DataFrame, negatives: DataFrame, label: str, seed: int = 0) -> DataFrame:
    """Each hard negative (label, with repeats) goes to a batch by hash, at its boundary; rows get
    ``hard`` and the columns that they have."""
    n = batches.select("batch").distinct().count()
    repeat = F.row_number().over(Window.partitionBy(label).orderBy(*negatives.columns))  # equal input, equal batches
    extra = negatives.withColumn("batch", F.pmod(F.xxhash64(F.col(label), repeat, F.lit(seed)), F.lit(max(n, 1))))
    return batches.withColumn("hard", F.lit(False)).unionByName(extra.withColumn("hard", F.lit(True)), allowMissingColumns=True)


def split_of(stem, train: list[str], val: list[str], test: list[str], finetune: bool, pretrain: bool):
    """render, train, val, test or none for a file: ``PAIRED_{stem}_...`` belongs to its stem's split,
    everything else is rendered.  Finetuning leaves renders out, pretraining pairs."""
    if finetune and pretrain:
        raise ValueError("finetune and pretrain exclude each other")
    paired = stem.isNotNull()
    out = F.when(stem.isin(*train), "train").when(stem.isin(*val), "val").when(stem.isin(*test), "test").otherwise("none")
    return F.when(~paired, "none" if finetune else "render").otherwise(F.lit("none") if pretrain else out)


def paired_stem(name):
    return F.nullif(F.regexp_extract(name, r"^PAIRED_(.*)_[^_]*$", 1), F.lit(""))


def assert_disjoint(*sets: DataFrame) -> None:
    """Raises if two of the sets share a row."""
    for i, a in enumerate(sets):
        for b in sets[:i]:
            if not a.intersect(b).isEmpty():
                raise ValueError("splits overlap")


def by_index(items: DataFrame, indices: DataFrame, item: str) -> DataFrame:
    return items.join(indices.select(item).distinct(), item, "left_semi")


def shuffled(items: DataFrame, item: str, seed: int = 0) -> DataFrame:
    return items.orderBy(F.xxhash64(F.col(item), F.lit(seed)), item)


def remaining(items: DataFrame, chosen: DataFrame, item: str) -> DataFrame:
    return items.join(chosen.select(item).distinct(), item, "left_anti")
