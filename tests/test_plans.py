"""Plans of the main queries: how often data is exchanged and what is read."""

import re

import pytest
from pyspark.sql import functions as F

from docweave.operators.running import by_history_length, running
from docweave.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, exchanges",
    [
        ("cdc_parse", 0),
        ("price_parse", 0),
        ("stock_parse", 0),
        ("stale_filter", 1),
        ("delete_epochs", 1),
        ("product_price_changelog", 1),
        ("product_price_latest", 1),  # partial rows only
        ("enriched_changelog", 1),
        ("dedup_changelog", 1),
        ("stock_running", 1),
        ("ttl_full_pipeline", 1),
        ("enriched_latest", 3),  # partial pairs by product; stock by warehouse, then by product
    ],
)
def test_exchanges(spark, name, exchanges):
    assert len(re.findall(r"Exchange (?:hash|range|single)", plan(spark, name))) == exchanges


@pytest.mark.parametrize("name", ["enriched_latest", "product_price_latest", "snapshot_bootstrap"])
def test_snapshots_combine_partial_rows(spark, name):
    """No history is sorted, and what crosses the exchange is aggregated before."""
    text = plan(spark, name)
    assert "Window" not in text and "Python" not in text and "Arrow" not in text
    below = text[: text.index("BroadcastHashJoin")]
    assert re.search(r"Exchange hashpartitioning\(product_id.*\n.*(?:Sort|Hash|ObjectHash)Aggregate", below)


@pytest.mark.parametrize("name", ["stock_totals", "stock_running", "delete_epochs"])
def test_columns_are_pruned(spark, name):
    schema = re.search(r"ReadSchema: (.*)", plan(spark, name)).group(1)
    assert "value" not in schema


def test_lookup_reads_one_product(spark):
    text = plan(spark, "doc_lookup")
    assert re.search(r"Filter .*product-7", text[text.rindex("Window") :])


@pytest.mark.parametrize(
    "name",
    ["index_upsert", "index_typed", "doc_json", "doc_lookup", "doc_count", "docs_complete", "doc_sample", "latency_oldest",
     "latency_newest", "index_requests", "pipeline_from_messages"],
)
def test_the_index_needs_no_python(spark, name):
    assert not re.search("InArrow|Python|Pandas", plan(spark, name))


def test_no_cross_joins_and_no_broadcast_without_long_keys(spark):
    for name in QUERIES:
        text = plan(spark, name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        assert "ResolvedHint" not in text, name


def test_blocks_bound_the_rows_of_a_task(spark):
    """No window of a long history is partitioned by the product alone."""
    changes = spark.range(1000).selectExpr("id AS seq", "'hot' AS product_id")
    seen = {}

    def compute(rows, layout):
        seen["group"] = layout.group
        seen["largest"] = max(
            r["count"] for r in layout.arrange(rows).groupBy(*layout.group).count().collect()
        )
        return layout.arrange(rows)

    by_history_length(changes, lambda r, layout: r, max_rows=100, compute_long=compute)
    assert seen == {"group": ["product_id", "_block"], "largest": 100}


def test_rows_of_long_keys_do_not_meet(spark):
    """Long histories are picked out where their rows are, and a large table gets tasks by its rows."""
    changes = spark.range(0, 1000, 1, 8).selectExpr("id AS seq", "'hot' AS product_id", "timestamp_seconds(id) AS at")

    def largest(df):
        return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

    picked = by_history_length(changes, lambda r, layout: r, max_rows=100)
    assert largest(picked) <= 125
    spread = by_history_length(
        changes, lambda r, layout: running(layout.arrange(r), layout, maxes={"latest": F.col("at")}), max_rows=100
    )
    assert [r.latest for r in spread.orderBy("seq").collect()] == [r["at"] for r in changes.orderBy("seq").collect()]


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr("docweave.operators.running.ROWS_PER_TASK", 50)
    changes = spark.range(1000).selectExpr("id AS seq", "concat('p', id % 40) AS product_id")
    made = by_history_length(changes, lambda r, layout: layout.arrange(r), max_rows=100)
    assert made.rdd.getNumPartitions() == 20
