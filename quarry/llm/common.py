"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, and the words between it (fixed values of the query contracts)
SPACE_CLASS = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE_CLASS}]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, UPPER, LOWER)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in
    ``spark.checkpoint.dir``; the warehouse where that is unset (tests)."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; never reused."""
    return f"{shared_root(spark)}/quarry-llm/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts lineage: later jobs reread the files, so a lost executor costs
    at most the tasks it ran.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """From now on this session's Arrow batches hold at most ``limit`` bytes, so that
    a batch of long texts does not fill a Python worker.  A smaller setting stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(name).rstrip("bB")
    if not now.isdigit() or int(now) > limit:
        spark.conf.set(name, str(limit))


def crc_bucket(ids: Sequence, buckets: int) -> list[int]:
    """``crc32(id as text) mod buckets``; a null id counts as the empty text."""
    return [zlib.crc32(b"" if i is None else str(int(i)).encode()) % buckets for i in ids]


def crc_mod(col: Column, buckets: int) -> Column:
    """The same as a column."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")), F.lit(0)) % buckets
