"""How the text queries meet their labels."""

import pytest

from conftest import SF_SMALL
from quarry.plans.catalog import QUERIES

LARGE = {  # as on a corpus beyond every broadcast and runtime-filter threshold
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}


@pytest.fixture()
def large(spark):
    before = {k: spark.conf.get(k, None) for k in LARGE}
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["top_positive_words_by_category", "top_negative_words_by_category"])
def test_only_texts_of_the_sentiment_leave_the_scan(large, name):
    plan = QUERIES[name](large, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    side = plan[:plan.index("Relation [doc_id")]
    assert "might_contain" in side.split("Join Inner")[-1]  # between the join and the documents


@pytest.mark.parametrize("name", ["clean_words", "normalized_comments"])
def test_texts_are_shuffled_once(large, name):
    lines = QUERIES[name](large, SF_SMALL)._jdf.queryExecution().executedPlan().toString().split("\n")
    by_id = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(doc_id" in line]
    assert len([i for i in by_id if "text#" in " ".join(lines[i + 1:i + 4])]) == 1


def test_counts_by_aspect_read_no_text(large):
    plan = QUERIES["positive_aspect_counts"](large, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan
