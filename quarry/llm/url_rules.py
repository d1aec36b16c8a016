"""URL filters: host-suffix / path-prefix expressions, joined on hash prefixes.

Every URL is expanded into expressions ``host suffix + path directory``; every
rule is filed under its host and the directory part of its path.  The two
meet in an equi-join on the first 4 bytes of a SHA-256, then the full digest
and the rest of the rule's path are confirmed, and the longest rule wins.
Everything is a DataFrame expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii

PREFIX_HEX = 8  # 4 bytes of the digest
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """Text between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    """Text between the host and ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules ``(host, path, verdict)`` given as literals."""
    if not rules:
        return spark.range(0).select(*(F.lit("").alias(c) for c in ("host", "path", "verdict")))
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
            for h, p, v in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge_urls(pages: DataFrame, rules: DataFrame, *, url: str = "url",
               keep: Sequence[str] = ("page_id",), default: str = "allow") -> DataFrame:
    """One row per page: the ``keep`` columns, ``host``, ``path``, ``rule``, ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``).
    A rule fits its host and all subdomains if the URL's path starts with the
    rule's; the rule with the longest ``host + path`` wins, at equal length the
    longer host, then ``block``, then the larger rule text.

    Distinct ``(host, path)`` pairs are judged once, so a URL or host that
    holds a third of all rows is expanded once, and AQE splits it in the last
    join.  Expressions are made only as deep as the deepest rule, which loses
    no match and bounds the work for very long URLs.

    Edge cases: a null URL, or one without ``://``, has an empty host and path
    and gets the default; repeated rows are judged alike and all kept; rules
    with a null host, path or verdict are ignored; without rules every page
    gets the default; other columns, of whatever name, are not read.
    """
    rules = (rules.select(lower_ascii(F.col("host")).alias("r_host"), F.col("path").alias("r_path"),
                          F.col("verdict").alias("r_verdict"))
             .dropna().where("r_host <> ''").distinct()
             .withColumn("r_dir", F.regexp_replace("r_path", r"[^/]*\z", "")))
    deepest = rules.agg(F.max(F.size(F.split("r_host", r"\."))).alias("labels"),
                        F.max(F.size(F.split("r_dir", "/")) - 1).alias("dirs")).first()
    labels, dirs = deepest.labels or 0, deepest.dirs or 0

    rows = pages.select(*(F.col(k) for k in keep), url_host(F.col(url)).alias("host"),
                        url_path(F.col(url)).alias("path"))
    pairs = rows.select("host", "path").where("host <> ''").distinct()

    parts = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.greatest(F.lit(1), F.size(parts) - labels + 1), F.size(parts)),
                        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    segments = F.split("path", "/")
    folders = F.transform(F.sequence(F.lit(0), F.least(F.lit(dirs), F.size(segments) - 1)),
                          lambda j: F.when(j == 0, F.lit("")).otherwise(
                              F.concat(F.array_join(F.slice(segments, 1, j), "/"), F.lit("/"))))
    expressions = F.flatten(F.transform(hosts, lambda h: F.transform(folders, lambda f: F.concat(h, f))))

    looked_up = (pairs.select("host", "path", F.explode(expressions).alias("expression"))
                 .withColumn("digest", F.sha2("expression", 256))
                 .withColumn("short", F.substring("digest", 1, PREFIX_HEX)))
    filed = (rules.withColumn("r_digest", F.sha2(F.concat("r_host", "r_dir"), 256))
             .withColumn("short", F.substring("r_digest", 1, PREFIX_HEX)))
    rule_text = F.concat("r_host", "r_path")
    precedence = F.struct(F.length(rule_text).alias("n"), F.length("r_host").alias("h"),
                          (F.col("r_verdict") == "block").alias("b"),
                          rule_text.alias("rule"), F.col("r_verdict").alias("verdict"))
    best = (looked_up.join(filed, "short")
            .where((F.col("digest") == F.col("r_digest")) & F.col("path").startswith(F.col("r_path")))
            .groupBy("host", "path").agg(F.max(precedence).alias("best")))
    return (rows.join(best, ["host", "path"], "left")
            .select(*(F.col(k) for k in keep), "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
