"""Incremental word statistics with Structured Streaming.

The batch jobs (J8, J11) re-expressed for documents that keep arriving as
files: the same ``clean_words`` operator runs on each micro-batch, the
``(category, word)`` counts are kept in Spark's state store, and after every
trigger the top-k per category is recomputed from the full counts and written
to a table, in place or as a new version.  Recovery comes from the query checkpoint, which lives under the
session's shared checkpoint folder unless a location is given.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.reviews import clean_words, rank_word_counts
from quarry.session import ensure_checkpoint_dir
from quarry.sinks.publish import publish
from quarry.sources.tables import TABLE_SCHEMAS


def document_stream(spark: SparkSession, directory: str, file_glob: str = "*.parquet",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over Parquet document files in ``directory``, which may
    still be empty: the columns are those declared for documents."""
    reader = spark.readStream.schema(TABLE_SCHEMAS["documents"]).option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(directory)


def word_counts(documents: DataFrame, stopwords: DataFrame | None) -> DataFrame:
    """Running ``(category, word, freq)`` over a document stream
    ``(doc_id, text, lang, ...)``; category = ``lang``."""
    reviews = documents.select(F.col("doc_id").alias("rid"), F.col("text").alias("comment"),
                               F.col("lang").alias("category"))
    words = clean_words(reviews, stopwords, keep=("category",))
    return words.groupBy("category", "word").agg(F.count(F.lit(1)).alias("freq"))


def start_top_words(documents: DataFrame, stopwords: DataFrame | None, output_path: str, *,
                    k: int = 5, query_name: str = "top_words_by_category",
                    checkpoint_location: str | None = None,
                    available_now: bool = False, versioned: bool = False) -> StreamingQuery:
    """Start the incremental top-k job; every trigger rewrites ``output_path``
    (Parquet) with the current ``(category, word, freq, rank_in_category)``.

    ``versioned`` publishes each as a version of its own, to be read with
    ``sinks.read_published``: readers then see whole tables only."""
    spark = documents.sparkSession
    if checkpoint_location is None:
        checkpoint_location = os.path.join(ensure_checkpoint_dir(spark), "streams", query_name)
    counts = word_counts(documents, stopwords)

    def publish_top(batch: DataFrame, _epoch: int) -> None:
        top = rank_word_counts(batch, k)
        if versioned:
            publish(top, output_path)
        else:
            top.write.mode("overwrite").parquet(output_path)

    writer = (counts.writeStream.outputMode("complete").queryName(query_name)
              .option("checkpointLocation", checkpoint_location).foreachBatch(publish_top))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()

