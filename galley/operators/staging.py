"""Written tables in the folder that the cluster shares, and size-checked broadcasts.

``checkpoint()`` on a DataFrame evaluates it twice (once to count, once to write), so lineage is
cut with a written Parquet table instead: one evaluation, columnar, readable after an executor
is lost.  The folder is ``spark.checkpoint.dir``; only a local[*] session may go without one.
An application's tables are deleted when it ends; a job in steps can ``remove`` them earlier.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its counted rows are at most this many (narrow rows: some MB).
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a private one in a local[*] session without it."""
    where = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not where:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="galley-")
        spark.conf.set("spark.checkpoint.dir", where)
        atexit.register(shutil.rmtree, where.removeprefix("file://"), ignore_errors=True)
    return where.rstrip("/")


#: Paths made in this process, by application id, oldest first.
_made: dict[str, list[str]] = {}


def _file_system(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's own folder, which is deleted when the driver ends."""
    app = spark.sparkContext.applicationId
    folder = f"{shared_dir(spark)}/galley-{app}"
    if app not in _made:
        files, at = _file_system(spark, folder)
        files.mkdirs(at)
        files.deleteOnExit(at)
    _made.setdefault(app, []).append(f"{folder}/{uuid.uuid4().hex}/{label}")
    return _made[app][-1]


def made(spark: SparkSession) -> list[str]:
    """The written tables of this application that have not been removed, oldest first."""
    return list(_made.get(spark.sparkContext.applicationId, []))


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that nothing will read again."""
    for path in paths:
        files, at = _file_system(spark, path)
        files.delete(at.getParent(), True)
        _made[spark.sparkContext.applicationId].remove(path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a staged table) with a broadcast hint if it has at most ``max_rows`` rows;
    otherwise unchanged, so that the join shuffles and AQE may split skewed keys."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def key_of(col) -> object:
    """A never-null text key of a column: null and every value stay apart."""
    return F.when(col.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), col.cast("string")))


def unit_hash(seed: int, *cols) -> object:
    """A number in [0, 2**52) from the MD5 of the seed and the columns (nulls apart)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[key_of(c) for c in cols])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
