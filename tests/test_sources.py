"""Readers on odd input, sinks, tables and upkeep."""

import json

import pytest
from conftest import MEDIUM, values
from pyspark.sql import functions as F

from cardwatch.functions import times
from cardwatch.operators import intake, profiles, shape, statistics, upkeep
from cardwatch.schemas import CLOUD_MESSAGE, NOTEBOOK_RECORD, TRANSACTION
from cardwatch.sources import readers, writers

GOOD = "TX1-1,CUST1,MERCH1,12.5,EUR,PURCHASE,ONLINE,Paris,,,1000,CREDIT,false,RETAIL,100.0,true"


def test_positional_lines(spark, tmp_path):
    header = ",".join(f.name for f in TRANSACTION)
    lines = [header, GOOD, GOOD.rsplit(",", 1)[0].replace("TX1-1", "TX2-2"), GOOD.replace("12.5", "abc"),
             ",".join(GOOD.split(",")[:14]), GOOD.replace("TX1-1", "TX3-3").replace(",true", ","), ""]
    (tmp_path / "in.csv").write_text("\n".join(lines))
    path = str(tmp_path / "in.csv")
    df = readers.read_text(spark, path)
    assert values(df, "transaction_id", "amount", "device_id", "ip_address", "is_fraud") == [
        ("TX1-1", 12.5, None, None, True), ("TX2-2", 12.5, None, None, None), ("TX3-3", 12.5, None, None, None)]
    rejected = [r[0] for r in readers.read_text_rejects(spark, path).collect()]
    assert len(rejected) == 3 and rejected[0] == header


def test_csv_with_header_and_json(spark, tmp_path):
    fields = ("transactionId,customerId,merchantId,amount,currency,transactionType,channel,location,deviceId,ipAddress,"
              "timestamp,cardType,isInternational,merchantCategory,previousBalance,isFraud")
    (tmp_path / "h.csv").write_text(fields + "\n" + GOOD + "\n")
    record = dict(zip(fields.split(","), GOOD.split(",")))
    record |= {"amount": 12.5, "timestamp": 1000, "isInternational": False, "previousBalance": 100.0, "isFraud": True,
               "deviceId": None, "ipAddress": None}
    (tmp_path / "r.json").write_text(json.dumps(record) + "\n")
    a, b = readers.read_csv(spark, str(tmp_path / "h.csv")), readers.read_json(spark, str(tmp_path / "r.json"))
    assert a.collect() == b.select(a.columns).collect()
    assert a.first()["amount_cents"] == 1250


def test_variants_converge(spark, tmp_path):
    record = {"transactionId": "TX1-1", "customerId": "CUST1", "amount": 3.0, "timestamp": 5, "country": "FR",
              "timestampStr": "x", "fraudType": "geo_anomaly", "isFraud": True}
    (tmp_path / "c.json").write_text(json.dumps(record))
    for schema in (CLOUD_MESSAGE, NOTEBOOK_RECORD):
        df = readers.read_json(spark, str(tmp_path / "c.json"), schema)
        assert {f.name for f in TRANSACTION} <= set(df.columns)
        row = df.first()
        assert (row.customer_id, row.amount_cents, row.device_id, row.transaction_type) == ("CUST1", 300, None, None)


def test_partitioned_sink_and_pruned_read(spark, make, tmp_path):
    from cardwatch.functions import rules, times
    rows = make({"amount": 20000.0, "is_international": True}, {"amount": 1.0}, {"amount": 2.0})
    scored = rules.apply(shape.enrich(rows), rules.stream_rules()).withColumn("transaction_date", times.event_date())
    writers.write_scored(profiles.to_warehouse(scored, "transactions"), str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    high = back.where("risk_level <> 'LOW' AND amount > 5000").select("transaction_id")
    plan = high._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(risk_level" in plan and "GreaterThan(amount,5000.0)" in plan
    assert "ReadSchema: struct<transaction_id:string,amount:double>" in plan
    assert high.count() == 1


def test_views(spark, make):
    writers.publish_view(make({}), "transactions_view")
    writers.publish_view(make({}), "transactions_view", shared=True)
    assert spark.sql("SELECT count(*) FROM transactions_view").first()[0] == 1
    assert spark.sql("SELECT count(*) FROM global_temp.transactions_view").first()[0] == 1


def test_new_files_only(spark, make, tmp_path):
    make({}).write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    assert upkeep.input_present(upkeep.files_since(df, "2001-01-01"))
    assert not upkeep.input_present(upkeep.files_since(df, "2999-01-01"))


def test_archive_is_repeatable(spark, make, tmp_path):
    day = 86_400_000
    rows = shape.with_dates(make({"timestamp_ms": 0}, {"timestamp_ms": 5 * day})).drop("processing_date")
    writers.write_table(rows, "archive_me", str(tmp_path / "t"), ["transaction_date"])
    for _ in range(2):
        upkeep.archive_before(spark, "archive_me", str(tmp_path / "a"), "transaction_date", "1970-01-03")
    assert spark.table("archive_me").count() == 1
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1


def test_union_and_pairs(make):
    a, b = make({"location": "Paris"}), make({"location": "Paris"})
    both = shape.union_batches([a, b.select(*reversed(b.columns))])
    assert both.count() == 2 and shape.customer_locations(both).count() == 2
    assert shape.customer_locations(both, unique=True).count() == 1


def test_messages(make):
    df = make({"amount": 6000.0}).withColumns({
        "fraud_score": F.lit(0.5), "risk_level": F.lit("HIGH"), "alert_reasons": F.array(F.lit("HIGH_AMOUNT")),
        "processed_at": F.timestamp_millis(F.lit(0))})
    row = writers.alert_messages(df).first()
    assert row.key == "TX1-1"
    assert json.loads(row.value) == {
        "transaction_id": "TX1-1", "customer_id": "CUST1", "amount": 6000.0, "fraud_score": 0.5, "risk_level": "HIGH",
        "alert_reasons": ["HIGH_AMOUNT"], "processed_at": "1970-01-01T00:00:00.000Z"}

def test_a_damaged_copy_keeps_the_days_in_the_table(spark, make, tmp_path):
    day = 86_400_000
    df = make(*[{"timestamp_ms": i * day // 3, "amount": float(i)} for i in range(9)]).withColumn("d", times.event_date())
    df.write.partitionBy("d").option("path", str(tmp_path / "t")).saveAsTable("damaged_days")
    archive, before = str(tmp_path / "archive"), "1970-01-03"
    upkeep.copy_before(spark, "damaged_days", archive, "d", before)
    spare = spark.read.parquet(archive).where("d = '1970-01-02'").drop("d")
    good = spare.collect()
    bad = spark.createDataFrame([(*r[:3], r[3] + 1, *r[4:]) if i == 0 else tuple(r) for i, r in enumerate(good)], spare.schema)
    bad.write.mode("overwrite").parquet(f"{archive}/d=1970-01-02")
    with pytest.raises(upkeep.DamagedCopy, match="1970-01-02"):
        upkeep.drop_archived(spark, "damaged_days", archive, "d", before)
    upkeep.refresh(spark, "damaged_days", statistics=False)
    assert spark.table("damaged_days").count() == 9
    upkeep.archive_before(spark, "damaged_days", archive, "d", before)
    assert spark.table("damaged_days").count() == 3 and spark.read.parquet(archive).count() == 6


def test_checksums_see_nulls_and_repeated_rows_but_no_order(spark):
    rows = [(1, "a", None), (1, None, "a"), (1, "b", "c"), (1, "b", "c"), (2, None, None)]
    schema = "d int, x string, y string"
    df = spark.createDataFrame(rows, schema)
    assert upkeep.differing_days(df, spark.createDataFrame(rows[::-1], schema).repartition(3), "d") == []
    assert upkeep.differing_days(df, spark.createDataFrame([rows[0], rows[0], *rows[2:]], schema), "d") == ["1"]
    assert upkeep.differing_days(df, spark.createDataFrame(rows[:2] + rows[3:], schema), "d") == ["1"]
    assert upkeep.differing_days(df, spark.createDataFrame(rows[:4], schema), "d") == ["2"]


@pytest.mark.parametrize("few", [0, 1000])
def test_runs_read_new_files_once_and_again_when_repeated(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(intake, "FEW_FILES", few)
    folder, ledger = str(tmp_path / "in"), str(tmp_path / "ledger")
    schema = spark.range(1).schema

    def arrive(start, stop):
        spark.range(start, stop).write.mode("append").parquet(folder)

    def read(run):
        return sorted(r.id for r in intake.read_claimed(spark, folder, intake.claim(spark, folder, ledger, run), schema).collect())
    arrive(0, 10)
    assert read("a") == list(range(10))
    arrive(10, 15)
    assert read("a") == list(range(10)) and read("b") == list(range(10, 15)) and read("c") == []
    # a claim without its mark is made again
    intake.files(spark, folder).limit(0).write.parquet(f"{ledger}/claims/run=d")
    arrive(15, 18)
    assert read("d") == [15, 16, 17] and read("b") == list(range(10, 15))


@pytest.mark.parametrize("few", [0, 1000])
def test_statistics_scan_new_files_only_and_forget_rewritten_ones(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(intake, "FEW_FILES", few)
    folder, store = str(tmp_path / "t"), str(tmp_path / "s")
    schema = "id bigint, name string, empty string, words array<string>, day date"
    schema = spark.createDataFrame([], schema).schema

    def days(start, stop, day):
        return spark.range(start, stop).selectExpr("id", "if(id % 4 = 0, null, concat('n', id % 100)) as name",
                                                   "cast(null as string) as empty", "array('x') as words", f"date'{day}' as day")

    def told():
        return {r[0]: tuple(r)[1:] for r in statistics.merged(spark, folder, store, schema).collect()}
    days(0, 4000, "2024-01-01").write.partitionBy("day").parquet(folder)
    old = set(spark.read.parquet(folder).inputFiles())
    statistics.renew(spark, folder, store, schema)
    days(4000, 9000, "2024-01-02").write.mode("append").partitionBy("day").parquet(folder)
    seen = statistics.unseen_rows(spark, folder, store, schema)
    assert seen.select("id").agg(F.min("id"), F.count("*")).first()[:] == (4000, 5000)
    assert few == 0 or not old & set(seen.inputFiles())
    for _ in range(2):
        statistics.renew(spark, folder, store, schema)
    got = told()
    assert set(got) == {"id", "name", "empty", "day"} and got["id"][:4] == (9000, 0, "0", "8999")
    assert abs(got["id"][4] - 9000) < 0.05 * 9000 and abs(got["name"][4] - 75) <= 3
    assert got["empty"] == (9000, 9000, None, None, 0) and got["day"][2:] == ("2024-01-01", "2024-01-02", 2)
    days(0, 10, "2024-01-01").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(folder)
    statistics.renew(spark, folder, store, schema)
    assert told()["id"][:4] == (5010, 0, "0", "8999")


def test_statistics_of_a_table_without_files(spark, tmp_path):
    (tmp_path / "t").mkdir()
    schema = spark.range(1).schema
    statistics.renew(spark, str(tmp_path / "t"), str(tmp_path / "s"), schema)
    assert [tuple(r) for r in statistics.merged(spark, str(tmp_path / "t"), str(tmp_path / "s"), schema).collect()] == [
        ("id", 0, 0, None, None, 0)]


def test_a_channel_is_compacted_into_one_file_whatever_its_size(spark, monkeypatch):
    from functools import partial

    from cardwatch.plans import QUERIES
    monkeypatch.setattr(upkeep, "compact_partition", partial(upkeep.compact_partition, file_bytes=4096))
    assert [r.files for r in QUERIES["compact_partition"](spark, MEDIUM).collect()] == [1, 1, 1, 1]


@pytest.mark.parametrize("file_bytes,files", [(None, 3), (2 ** 20, 1), (20_000, None)])
def test_compaction_counts_the_bytes_of_files(spark, tmp_path, file_bytes, files):
    spark.range(20_000).selectExpr("id", "id % 2 AS part").repartition(5).write.partitionBy("part").format("parquet").option(
        "path", str(tmp_path / "small")).saveAsTable("small_files")
    try:
        wanted = {"files": files} if file_bytes is None else {"file_bytes": file_bytes}
        upkeep.compact_partition(spark, "small_files", {"part": "1"}, str(tmp_path / "new"), **wanted)
        rows = spark.table("small_files").where("part = 1").select("id", "_metadata.file_path", "_metadata.file_size")
        sizes = [r.file_size for r in rows.select("file_path", "file_size").distinct().collect()]
        assert rows.select("id").distinct().count() == rows.count() == 10_000
        assert len(sizes) == files if files else len(sizes) > 1 and all(10_000 < n < 30_000 for n in sizes)
    finally:
        spark.sql("DROP TABLE small_files")
