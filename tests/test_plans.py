"""What the optimizer makes of the operators."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tillstream.operators.enrich import enrich_country, enrich_product
from tillstream.operators.fraud import fraud_alerts
from tillstream.operators.kpi import recent_transactions
from tillstream.operators.latest import latest_per_key
from tillstream.operators.parse import classify_messages, parse_transactions, without_null_literals
from tillstream.operators.sales import running_totals, sales_per_category, sales_per_day
from tillstream.schema import COLUMNS
from tillstream.sources.messages import spread


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, operator):
    return len(re.findall(rf"[-+:] ?\*?(?:\(\d+\) )?{operator}\b", plan(df)))


@pytest.fixture
def stored(spark, transactions, tmp_path):
    """Enough files that nothing is decided by there being a single partition."""
    df = transactions([{"seq": i, "customer_id": f"c{i % 3}"} for i in range(40)])
    df.repartition(4).write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def test_sales_read_two_columns_and_combine_early(stored):
    df = sales_per_day(stored)
    assert "ReadSchema: struct<total_amount:double,transaction_date:timestamp>" in plan(df)
    assert count(df, "HashAggregate") == 2 and count(df, "Exchange") == 1


def test_day_as_written_shuffles_only_totals(stored):
    df = sales_per_day(stored, "as_written")
    assert "LeftSemi" in plan(df) and count(df, "HashAggregate") == 4


def test_category_as_written_windows_over_sums(stored):
    df = sales_per_category(stored, "as_written")
    assert plan(df).index("Window") < plan(df).index("HashAggregate")
    assert count(df, "Exchange") == 2


def test_fraud_filters_before_the_edges_meet(stored):
    df = fraud_alerts(stored)
    text = plan(df)
    # Ranges, pieces, and the two rows per piece; the filter comes before the last.
    assert re.findall(r"(Window|Filter|Exchange)\b", text)[:7] == [
        "Filter", "Window", "Exchange", "Filter", "Window", "Exchange", "Exchange"
    ]
    assert text.count("rangepartitioning") >= 1
    columns = re.search(r"FileScan parquet \[(.*?)\]", plan(df)).group(1)
    assert {column.split("#")[0] for column in columns.split(",")} == {
        "customer_id", "seq", "customer_country", "transaction_date", "product_name", "total_amount",
    }


def test_running_totals_keep_the_rows_in_place(stored):
    """The written rows are joined with a few rows per piece, without a shuffle of their own."""
    df = running_totals(stored, "customer_id", ranges=5)
    assert count(df, "BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan(df)


def test_latest_limits_before_the_shuffle(stored):
    text = plan(latest_per_key(stored, "transaction_id"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    assert text.count("WindowGroupLimit") == 2


def test_recent_is_a_top_k(stored):
    df = recent_transactions(stored)
    assert "TakeOrderedAndProject" in plan(df) and count(df, "Exchange") == 0


def test_dimensions_are_broadcast(stored):
    df = enrich_country(enrich_product(stored))
    assert plan(df).count("BroadcastHashJoin") == 2 and "LocalTableScan" in plan(df)


def test_filters_reach_the_scan(stored):
    df = sales_per_day(stored.where(F.col("transaction_date") >= "2025-01-01"))
    assert "GreaterThanOrEqual(transaction_date" in plan(df)


def test_message_is_read_once(spark, tmp_path):
    spark.createDataFrame([("{}",)], "value string").write.parquet(str(tmp_path / "m"))
    good, rejects = parse_transactions(spark.read.parquet(str(tmp_path / "m")))
    for df in (good.select(*COLUMNS), rejects, good.groupBy("customer_id").count()):
        assert plan(df).count("from_json") == 1
        assert "json_object_keys" not in plan(df)


def test_recent_messages_are_chosen_before_they_are_parsed(spark, tmp_path):
    rows = [(i, "null" if i % 3 else "{}") for i in range(100)]
    spark.createDataFrame(rows, "seq long, value string").repartition(4).write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    df = classify_messages(recent_transactions(without_null_literals(stored), n=5))
    text = plan(df)
    assert text.index("from_json") < text.index("TakeOrdered")
    later = recent_transactions(classify_messages(stored), n=5)
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, later.collect()), key=repr)


def test_spread_deals_a_single_task_to_all_cores(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/one")
    one, cores = spark.read.parquet(f"{tmp_path}/one"), spark.sparkContext.defaultParallelism
    dealt = spread(one)
    assert one.rdd.getNumPartitions() == 1 and dealt.rdd.getNumPartitions() == cores
    assert sorted(r.id for r in dealt.collect()) == list(range(1000))
    many = spark.range(0, 1000, 1, cores + 1)
    assert spread(many) is many
    assert spread(one.limit(0)).count() == 0
