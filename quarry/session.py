"""Session construction and lineage-cutting support.

Settings every operator relies on:

* ``spark.sql.session.timeZone=UTC`` — epoch-second → year and timestamp
  ranges are evaluated in UTC.
* ``spark.sql.ansi.enabled=true`` — bad casts fail loudly; the tolerant paths
  use ``try_cast`` / ``try_to_timestamp`` explicitly.
* AQE with skew-join splitting and partition coalescing — runtime re-planning
  turns small shuffle joins into broadcasts and splits hot join keys.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce small post-shuffle partitions by size, not "one per core":
    # fewer, fuller tasks (the recommended setting on a shared cluster)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # whole-table counts of DataSource V2 scans come from file footers
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
}

MIB = 1024 * 1024


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 split_mib: int = 512) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of data.

    * scans: ``split_mib`` per input split, so a task's input fits in its
      share of executor memory while the number of map tasks stays moderate;
    * shuffles: about one partition per GiB of input, and at least 3 waves of
      the cluster's cores; AQE then coalesces small partitions
      towards an advisory size, splits skewed ones and turns joins whose
      measured side is small into broadcasts.

    For 100 TB on 1000 executors x 8 cores: 512 MiB splits (~205k map tasks)
    and ~102k initial shuffle partitions.
    """
    cores = max(1, executors * cores_per_executor)
    by_size = input_bytes // (1024 * MIB)
    initial = max(by_size, 3 * cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_mib * MIB),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * MIB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MIB),
    }


def build_session(master: str | None = None, app_name: str = "quarry",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's required settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_sql_conf(spark)
    return spark


def apply_sql_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to a session we did not build."""
    for key, value in DEFAULT_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure reliable checkpoints have a shared directory.

    The cluster names it in ``spark.checkpoint.dir``; that setting always wins.
    Where it is unset, a folder in the warehouse is used, which the driver and
    all executors share; never a machine-local one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set at runtime either
            configured = None
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")
    return sc.getCheckpointDir()


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a DataFrame reading it back.

    This cuts lineage like ``checkpoint()`` but in a single job (an eager RDD
    checkpoint computes, then recomputes to write) and the re-read plan has
    real file statistics for the optimizer.  The folder is the cluster's
    ``spark.checkpoint.dir``, so the result survives executor loss.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/quarry-tables/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
