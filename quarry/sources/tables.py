"""Parquet tables of a benchmark directory.

Tables are read with their declared schema: an inferred read runs a Spark
job per table just to read file footers (on a large table, thousands of
them), before any query work starts.  ``spark.read.parquet`` is lazy:
projections and filters applied later are pushed into the scan
(``ReadSchema`` / ``PushedFilters``), so the loaders return the full logical
table and let Catalyst prune.

``stored_rows`` counts a table from its file footers: the DataSource V2 reader
takes ``count(*)`` into the scan, and no column is read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The benchmark tables and their column types.
TABLE_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
             "p_retailprice DOUBLE"),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
               "props STRING"),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}
TABLES = tuple(TABLE_SCHEMAS)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLE_SCHEMAS:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(table_path(sf_dir, name))


def read_footers(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table through the DataSource V2 reader.  Counts, minima and maxima of
    whole tables are answered from file footers there
    (``spark.sql.parquet.aggregatePushdown``, set by ``quarry.session``)."""
    v1_sources = spark.conf.get("spark.sql.sources.useV1SourceList")
    kept = [s for s in v1_sources.split(",") if s != "parquet"]
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(kept))  # decides while the reader is resolved
    try:
        return read_table(spark, sf_dir, name)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", v1_sources)


def stored_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One row ``(n_rows)``, from the footers."""
    return read_footers(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n_rows"))
