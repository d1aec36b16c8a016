"""Dataset profile (SRC14): one row per (dataset, column).

Row counts are one-row aggregates per dataset: over frames of ``tables.read_footers``
they come from file footers and no column is read, over others from a count in
every task.  The column listing comes from schema metadata.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PROFILE_SCHEMA = ("dataset string, ordinal int, column_name string, data_type string, "
                  "n_cols int")


def dataset_profile(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """``(dataset, n_rows, n_cols, ordinal, column_name, data_type)``;
    ``data_type`` is Spark's simple type string (``bigint``, ``string``...)."""
    if not datasets:
        raise ValueError("no datasets")
    any_df = next(iter(datasets.values()))
    spark = any_df.sparkSession
    meta = [(name, i + 1, f.name, f.dataType.simpleString(), len(df.schema.fields))
            for name, df in datasets.items() for i, f in enumerate(df.schema.fields)]
    columns = spark.createDataFrame(meta, PROFILE_SCHEMA)
    counts = None
    for name, df in datasets.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("dataset"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return (columns.join(F.broadcast(counts), "dataset", "inner")
            .select("dataset", "n_rows", "n_cols", "ordinal", "column_name", "data_type")
            .orderBy("dataset", "ordinal"))
