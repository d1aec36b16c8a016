"""The training corpus pipeline: documents in, token files out.

Every stage is a function of (spark, docs, sf_dir).  Its result is written as
Parquet and reread as the next stage's docs; all stages but the last return
the columns of ``documents``, and any others that the docs have.

Odd rows, in every stage: a null or empty text is a text without words (it scores as
the prior, is alike to other such texts, holds no benchmark item, has size 0 in the
mix and is one end token); a null id stays null and counts as the empty text where
its digest decides; repeated rows are judged alike, and of near copies one stays;
texts are taken whole, however long; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm.common import written
from quarry.llm.decontaminate import drop_contaminated
from quarry.llm.mixing import mix
from quarry.llm.queries import table, tokenizer_path
from quarry.llm.simhash import drop_near_duplicates
from quarry.llm.token_files import token_digest
from quarry.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; learns from the labels of those at hand."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that links of at most 2 bits connect."""
    return drop_near_duplicates(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, in shard order."""
    return mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what they hold of each."""
    return token_digest(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_output", token_output),
]

# the stages learn, walk and tokenise, which SQL cannot express; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
