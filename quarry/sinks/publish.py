"""Replace an output without a moment in which it is absent or half there (SNK6).

``mode("overwrite")`` deletes the old files before the new ones are complete.
``publish`` writes every version into a folder of its own and then appends one row to
a manifest table; readers follow the newest row.  The append is a single file that
Spark's committer renames into place, so a reader sees the old version or the new one,
and a write that dies on the way leaves the old one standing.

Old versions stay: a running query may still read them.  ``versions`` lists them for
whatever retention the folder has.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = "version LONG, folder STRING"

Writer = Callable[[DataFrame, str], None]
Reader = Callable[[SparkSession, str], DataFrame]


def _manifest(path: str) -> str:
    return f"{path.rstrip('/')}/manifest"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """``(version, folder)`` of everything published at ``path``; empty if nothing is."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(_manifest(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def _newest(spark: SparkSession, path: str):
    # of two versions published at once, all readers take the same one
    return versions(spark, path).orderBy(F.col("version").desc(), F.col("folder").desc()).first()


def publish(df: DataFrame, path: str, write: Writer | None = None) -> int:
    """Write ``df`` as the next version of ``path`` and make it current; returns the
    version.  ``write(df, folder)`` writes into a folder that does not exist yet
    (Parquet if not given), e.g. ``write_tsv``."""
    spark = df.sparkSession
    newest = _newest(spark, path)
    version = newest.version + 1 if newest else 1
    folder = f"v{version:09d}-{uuid.uuid4().hex}"
    target = f"{path.rstrip('/')}/{folder}"
    if write is None:
        df.write.mode("errorifexists").parquet(target)
    else:
        write(df, target)
    row = spark.createDataFrame([(version, folder)], MANIFEST_SCHEMA).coalesce(1)
    row.write.mode("append").parquet(_manifest(path))
    return version


def published_folder(spark: SparkSession, path: str) -> str:
    """The folder of the current version."""
    newest = _newest(spark, path)
    if newest is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return f"{path.rstrip('/')}/{newest.folder}"


def read_published(spark: SparkSession, path: str, read: Reader | None = None) -> DataFrame:
    """The current version of ``path`` through ``read(spark, folder)`` (Parquet if not given)."""
    folder = published_folder(spark, path)
    return spark.read.parquet(folder) if read is None else read(spark, folder)
