"""Written tables and size-checked broadcasts, as ``operators.staging`` has them, with bounded Arrow batches."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import staging as plain
from ..operators.staging import key_of, made, new_path, remove, small_side, unit_hash

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def staged(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back.  ``batch_rows`` bounds the rows of an
    Arrow batch while it is written, for Python stages over long texts."""
    if not batch_rows:
        return plain.staged(df, label)
    conf = df.sparkSession.conf
    before = conf.get(_BATCH)
    conf.set(_BATCH, str(batch_rows))
    try:
        return plain.staged(df, label)
    finally:
        conf.set(_BATCH, before)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


__all__ = ["fresh", "key_of", "made", "new_path", "remove", "small_side", "staged", "unit_hash"]
