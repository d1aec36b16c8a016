"""Mixing sources to target weights with a multivariate-hypergeometric tree.

Every source's documents are dealt into blocks by hash.  A source's target
says how many whole passes over its blocks the mix makes and how far one more
pass goes, in permuted block order.  That fixes an exact quota of block draws
per source.  A binary tree over the output shards splits the quotas: each
node gives its left child a multivariate-hypergeometric sample, so that every
shard holds what a uniform shuffle of all draws would put there.  The draws of
a source, in permuted order, are then cut at the tree's counts, which makes
the shards' blocks disjoint, and each shard is shuffled locally.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ranking import dense_rank_global

from .common import WORD, written

GROUPS = 64          # source groups whose quotas the root tree splits, at least
GROUP_DRAWS = 50_000  # block draws a group holds on average, at most; one source has few (blocks x passes)


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def split_tree(quotas: np.ndarray, shard_totals: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Split integer ``quotas`` over shards that hold ``shard_totals`` draws each.

    Returns a matrix (shard, source) whose rows sum to the shard totals and
    whose columns sum to the quotas.
    """
    if len(shard_totals) == 1:
        return quotas[None, :]
    half = len(shard_totals) // 2
    left = rng.multivariate_hypergeometric(quotas, int(shard_totals[:half].sum()), method="marginals")
    return np.vstack([split_tree(left, shard_totals[:half], rng),
                      split_tree(quotas - left, shard_totals[half:], rng)])


def source_targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Add ``target`` to the written table ``(source, source_size, n_blocks)``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    ``share`` times all sizes; a target stops at ``cap`` times its source's
    size and the excess is shared by weight until none is above.  That is
    ``least(cap * size, level * weight)`` for one common level, which is raised
    until the set of capped sources no longer grows.
    """
    distinct = sources.select("source").where("source is not null")
    ranked = dense_rank_global(distinct, "source", "place", descending=False)
    last = distinct.count()
    weighed = written(
        sources.join(ranked, "source", "left")
        .withColumn("place", F.coalesce("place", F.lit(last + 1)))
        .withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)),
                                           (F.col("place") - 1) % len(weights) + 1))
        .withColumn("most", F.col("source_size") * F.lit(float(cap))).drop("place"), "mix-sources")
    level, capped = 0.0, -1
    while True:
        full = F.col("most") <= level * F.col("weight")
        row = weighed.agg(F.sum("source_size").alias("all"), F.count_if(full).alias("capped"),
                          F.sum(F.when(full, F.col("most")).otherwise(0.0)).alias("used"),
                          F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if row.capped == capped or not row.open:
            break
        capped = row.capped
        level = (share * row["all"] - row.used) / row.open
    target = F.least("most", F.lit(level) * F.col("weight")) if row.open else F.col("most")
    return weighed.select("source", "source_size", "n_blocks", target.alias("target"))


def _shard_totals(total: int, shards: int) -> np.ndarray:
    return np.diff(np.linspace(0, total, shards + 1).round().astype(np.int64))


def draw_plan(sized: DataFrame, *, weights: Sequence[float], share: float, cap: float,
              blocks: int, shards: int, seed: int) -> DataFrame:
    """What is drawn of each ``(source, block)``: one row with ``source_size``,
    ``target``, ``passes``, ``rest`` (``all``, ``part`` or ``none`` of one more
    pass), ``cut`` and ``patch`` (a part is the documents up to the key ``cut``
    and the one with the key ``patch``) and ``draws`` (copy, shard)."""
    per_block = written(sized.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    sources = per_block.groupBy("source").agg(F.sum("words").alias("source_size"),
                                              F.count(F.lit(1)).alias("n_blocks"))
    targets = source_targets(written(sources, "mix-totals"), weights, share, cap)
    targets = targets.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                                 .otherwise(0).cast("int"))
    targets = targets.withColumn("more", F.col("target") - F.col("passes") * F.col("source_size"))

    # one more pass: blocks in permuted order until the words still wanted are reached
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), F.lit("block"), "source", "block"), "block")
    joined = per_block.alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))) \
        .select("b.*", "t.source_size", "t.target", "t.passes", "t.more")
    planned = written(
        joined.withColumn("upto", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("want", F.col("more") - (F.col("upto") - F.col("words")))
        .withColumn("rest", F.when((F.col("words") > 0) & (F.col("want") >= F.col("words")), "all")
                    .when((F.col("words") > 0) & (F.col("want") > 0), "part").otherwise("none")), "mix-plan")

    # the block that the target cuts: its documents in permuted order, while they fit
    def same(left: DataFrame, right: DataFrame) -> Column:
        return left["source"].eqNullSafe(right["p_source"]) & (left["block"] == right["p_block"])

    def renamed(frame: DataFrame) -> DataFrame:
        return frame.withColumnsRenamed({"source": "p_source", "block": "p_block"})

    within = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    cut_blocks = renamed(planned.where("rest = 'part'").select("source", "block", "want"))
    cuts = written(sized.join(cut_blocks, same(sized, cut_blocks))
                   .withColumn("fits", F.sum("size").over(within) <= F.col("want"))
                   .groupBy("source", "block", "want")
                   .agg(F.max(F.when(F.col("fits"), F.col("key"))).alias("cut"),
                        (F.col("want") - F.coalesce(F.sum(F.when(F.col("fits"), F.col("size"))), F.lit(0))).alias("left")), "mix-cuts")
    # then one more document, of the size nearest to the words still wanted, if that helps
    missing = cuts.select(F.col("source").alias("m_source"), "cut", "left")
    states = renamed(planned.select("source", "block", "rest"))
    untaken = sized.join(states, same(sized, states)).join(missing, sized["source"].eqNullSafe(F.col("m_source"))) \
        .where("rest = 'none' or (rest = 'part' and (cut is null or key > cut))")
    gap = F.abs(F.col("size") - F.col("left"))
    patches = untaken.where((F.col("size") > 0) & (gap < F.col("left"))).groupBy("source") \
        .agg(F.min(F.struct(gap.alias("gap"), "key", "block")).alias("best")) \
        .select("source", F.col("best.block").alias("block"), F.col("best.key").alias("patch"))
    cuts, patches = renamed(cuts.select("source", "block", "cut")), renamed(patches)
    planned = planned.join(cuts, same(planned, cuts), "left").drop("p_source", "p_block")
    planned = planned.join(patches, same(planned, patches), "left").drop("p_source", "p_block")
    planned = written(planned.withColumn("rest", F.when((F.col("rest") != "all") & F.col("cut").isNull() & F.col("patch").isNull(), "none")
                                         .when(F.col("rest") != "all", "part").otherwise("all")), "mix-draws")

    # every block draw, and the tree that deals them to the shards
    copies = F.concat(F.when(F.col("passes") > 0, F.sequence(F.lit(0), F.col("passes") - 1)).otherwise(F.array().cast("array<int>")),
                      F.when(F.col("rest") != "none", F.array("passes")).otherwise(F.array().cast("array<int>")))
    n_draws = planned.agg(F.sum(F.size(copies))).first()[0] or 0
    groups = max(GROUPS, -(-n_draws // GROUP_DRAWS))
    draws = planned.select("source", "block", F.explode(copies).alias("copy")).select(
        "*", F.pmod(F.xxhash64(F.lit("group"), "source"), F.lit(groups)).cast("int").alias("grp"),
        F.xxhash64(F.lit(seed), F.lit("draw"), "source", "block", "copy").alias("place"))
    totals = {r.grp: r["n"] for r in draws.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a group
    quotas = np.array([totals.get(g, 0) for g in range(groups)], dtype=np.int64)
    per_shard = split_tree(quotas, _shard_totals(int(quotas.sum()), shards), np.random.default_rng(seed))

    def deal(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["grp"].iloc[0])
        frame = frame.assign(name=frame["source"].fillna(""), none=frame["source"].isna())
        frame = frame.sort_values(["none", "name", "place", "block", "copy"]).reset_index(drop=True)
        code = frame.groupby(["none", "name"], sort=False).ngroup().to_numpy()
        counts = split_tree(np.bincount(code), per_shard[:, group], np.random.default_rng([seed, group]))
        frame["shard"] = np.concatenate([np.repeat(np.arange(shards), counts[:, s]) for s in range(counts.shape[1])])
        return frame[["source", "block", "copy", "shard"]]

    dealt = draws.groupBy("grp").applyInPandas(deal, "source string, block int, copy int, shard int")
    per = dealt.groupBy("source", "block").agg(F.array_sort(F.collect_list(F.struct("copy", "shard"))).alias("draws"))
    per = renamed(per)
    return planned.join(per, same(planned, per), "left") \
        .select("source", "block", "source_size", "target", "passes", "rest", "cut", "patch", "draws")


def plan_mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
             blocks: int = 1024, shards: int = 16, seed: int = 20) -> DataFrame:
    """Every input row with what the mix takes of it.

    Returns a struct ``doc`` of the input's columns plus ``size`` (words),
    ``source_size``, ``target`` (the source's, double) and ``draws``: an array
    of ``(copy, shard)``, one entry for each time the document is taken (never
    more than ``ceil(cap)``).  The source is read as a string.

    Work per group is bounded: block tables have at most ``blocks`` rows a
    source, only the documents of the one block that the target cuts are
    ordered, the one nearest fit is an aggregate, and texts are not moved unless the plan is too large to
    broadcast.  The result depends on the rows, the parameters and the seed
    only, so reruns agree.

    Edge cases: a null or empty text has size 0 and is taken with its block;
    null sources are one source, last in order; null ids are allowed; rows equal
    in id, text and source are drawn alike; an empty table gives an empty result;
    other columns are carried inside ``doc`` and cannot clash.
    """
    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    sized = rows.select(
        "doc", F.col(f"doc.`{source}`").cast("string").alias("source"), word_count(F.col(f"doc.`{text}`")).alias("size"),
        F.xxhash64(F.lit(seed), F.lit("doc"), F.col(f"doc.`{doc_id}`"), F.col(f"doc.`{text}`")).alias("pick"))
    sized = sized.withColumn("block", F.pmod(F.xxhash64(F.lit("deal"), "pick"), F.lit(blocks)).cast("int")) \
        .withColumn("key", F.struct("pick", "size"))
    light = written(sized.select("source", "size", "block", "key"), "mix-sizes")
    plan = draw_plan(light, weights=weights, share=share, cap=cap, blocks=blocks, shards=shards, seed=seed)
    plan = plan.withColumnsRenamed({"source": "p_source", "block": "p_block"})
    joined = sized.join(plan, sized["source"].eqNullSafe(F.col("p_source")) & (sized["block"] == F.col("p_block")), "left")
    taken = F.filter("draws", lambda d: (d["copy"] < F.col("passes")) | (F.col("rest") == "all")
                     | ((F.col("rest") == "part") & (F.coalesce(F.col("key") <= F.col("cut"), F.lit(False)) | F.col("key").eqNullSafe(F.col("patch")))))
    empty = F.array().cast("array<struct<copy:int,shard:int>>")
    return joined.select("doc", "size", "source_size", "target", F.coalesce(taken, empty).alias("draws"))


def mix(docs: DataFrame, *, seed: int = 20, **options) -> DataFrame:
    """The mixed corpus: the input's columns, one row per draw, in shard order.

    Rows are range-partitioned by ``(shard, hash)`` and sorted there, which is
    the local shuffle of every shard; options and edge cases as in ``plan_mix``.
    """
    drawn = plan_mix(docs, seed=seed, **options).select("doc", F.explode("draws").alias("draw"))
    place = F.xxhash64(F.lit(seed), F.lit("place"), "draw.copy", F.struct(F.col("doc.*")))
    drawn = drawn.select("doc", F.col("draw.shard").alias("shard"), place.alias("place"))
    return drawn.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place") \
        .select(*(F.col(f"doc.`{c}`") for c in docs.columns))
