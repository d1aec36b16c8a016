"""The operators bound to the benchmark tables, one thin query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .decontaminate import benchmark_matches
from .html_text import extract_main_text
from .lm_score import lm_scores
from .mixing import plan_mix
from .periodic import periodic_runs
from .pii import find_personal_data, labelled_lines
from .repeats import repeat_digest
from .simhash import hex_fingerprint, simhash_classes
from .token_files import token_digest
from .toxicity import score_toxicity
from .url_rules import judge_urls, rules_frame
from .whitening import whiten

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"),
             ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
TOKENIZER = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), queries=F.col("vec_id") % 20 == 0, k=20)


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(table(spark, sf_dir, "documents"), shingle=3, max_bits=2).select(
        "doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rules_frame(spark, URL_RULES))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = plan_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc.doc_id", "size", "source_size", "target",
                        (F.col("size") * F.size("draws")).alias("taken"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"), labelled_lines(spark))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_multi_index_hashing, op2_html_text, op3_simhash, op4_toxicity, op5_url_filter, op6_decontamination, op7_token_files, op8_lm_score, op9_source_mix, op10_repeats,
                                    op11_personal_data, op12_periodic_runs, op13_whitening)}

ORACLE_SQL = {
    "op5_url_filter": r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(r_host, r_path, r_verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
SELECT page_id, host, path,
       (SELECT max_by(r_host || r_path, length(r_host || r_path)) FROM rules
        WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS rule,
       coalesce((SELECT max_by(r_verdict, length(r_host || r_path)) FROM rules
        WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)), 'allow') AS verdict
FROM u""",
}
