"""Shapes of the physical plans."""

import re

import pytest
from conftest import SMALL

from cardwatch.operators import aggregates, dashboards, periods, profiles, windows
from cardwatch.plans import QUERIES
from cardwatch.sources.tables import transactions


def plan(df, run=True):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tx") / "t")
    transactions(spark, SMALL, balance=True).write.parquet(path)
    return spark.read.parquet(path)


def test_no_python_in_any_plan(spark):
    for name in ("fraud_score_batch", "sql_velocity", "customer_profile", "merchant_rankings", "score_deciles",
                 "win_session", "feature_corr", "group_rows"):
        text = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", text), name


def test_windows_of_a_customer_share_one_exchange_of_rows(stored):
    for job in (windows.velocity_trace, windows.rolling, windows.features, windows.fraud_patterns):
        text = plan(job(stored))
        assert len(re.findall(r"\bExchange hashpartitioning", text)) == 1, job


def test_filter_and_columns_reach_the_scan(stored):
    from cardwatch.operators import shape
    text = plan(shape.high_value(stored, 1000).select("transaction_id", "amount"))
    assert "GreaterThan(amount,1000.0)" in text and "ReadSchema: struct<transaction_id:string,amount:double>" in text


def test_aggregates_combine_before_the_shuffle(stored):
    text = plan(aggregates.total_by_customer(stored))
    assert text.count("partial_sum") >= 1 and len(re.findall(r"\bExchange ", text)) == 1
    assert "ReadSchema: struct<customer_id:string,amount_cents:bigint>" in text


def test_one_scan_for_global_figures(stored):
    assert plan(aggregates.global_stats(stored)).count("FileScan") == 1
    from cardwatch.functions import rules
    from cardwatch.operators import shape
    scored = rules.apply(shape.enrich(stored), rules.stream_rules())
    assert plan(dashboards.chart_data(scored)).count("FileScan") == 1
    assert plan(dashboards.precision_recall(scored)).count("FileScan") == 1


def test_top_lists_do_not_sort_everything(stored):
    assert "TakeOrderedAndProject" in plan(aggregates.top_customers(stored))


def test_top_k_per_customer_is_cut_before_the_shuffle(stored):
    assert "WindowGroupLimit" in plan(profiles.preferred(stored, "merchant_id", "m"), run=False)


def test_join_spreads_a_customer_with_a_third_of_the_rows(spark, medium_tx):
    """No place of the spread join holds the busy customer's rows together, and the result is that of a plain join."""
    from pyspark.sql import functions as F

    from cardwatch.operators.spread import join_per_key
    hot = medium_tx.withColumn("customer_id", F.when(F.pmod(F.hash("transaction_id"), F.lit(3)) == 0, "CUST1")
                               .otherwise(F.col("customer_id")))
    stats = hot.groupBy("customer_id").agg(F.count("*").alias("n"))
    for how in ("left", "inner"):
        known = stats if how == "left" else stats.where("n > 60")
        plain = hot.join(known, "customer_id", how)
        spread = join_per_key(hot, known, how=how, rows_per_copy=100)
        assert spread.count() == plain.count()
        assert spread.select(plain.columns).exceptAll(plain).isEmpty()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        placed = join_per_key(hot, stats, rows_per_copy=100).where("customer_id = 'CUST1'").groupBy(
            F.spark_partition_id()).count()
        assert max(r["count"] for r in placed.collect()) < 600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_reports_of_a_period_read_its_days_only(spark, tmp_path):
    from pyspark.sql import functions as F

    from cardwatch.functions import rules, times
    from cardwatch.operators import shape
    scored = rules.apply(shape.enrich(transactions(spark, SMALL, balance=True)), rules.stream_rules())
    scored.withColumn("transaction_date", times.event_date()).write.partitionBy("transaction_date").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        for name in periods.REPORTS:
            text = plan(periods.report(name, table, F.lit("2024-01-20").cast("date"), 2), run=name == "hours_of_day")
            filters = re.search(r"PartitionFilters: \[[^]]*\]", text)[0]
            assert "2024-01-18" in filters and "2024-01-20" in filters, name
            assert "GreaterThanOrEqual(timestamp_ms,1705536000000)" in text, name
            assert "LessThan(timestamp_ms,1705795200000)" in text, name
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_a_report_ends_with_its_day_and_rows_without_a_time_are_in_none(spark):
    from pyspark.sql import functions as F
    rows = [(t, "m") for t in ("2024-01-01 23:59:59.999", "2024-01-02 00:00:00", "2024-01-03 23:59:59.999",
                               "2024-01-04 00:00:00", None)]
    table = spark.createDataFrame(rows, "t string, merchant_id string").withColumn(
        "timestamp_ms", F.unix_millis(F.col("t").cast("timestamp")))
    day = F.lit("2024-01-03").cast("date")
    kept = dashboards.last_days(table, 1, day).select("t").collect()
    assert sorted(r.t for r in kept) == ["2024-01-02 00:00:00", "2024-01-03 23:59:59.999"]
    assert dashboards.last_days(table.limit(0), 1).count() == 0
