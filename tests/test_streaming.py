"""Streams give what the batch gives; late data, gaps, restart, sinks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardwatch.streaming import outbox, pipeline, sessions, source, upsert, windows
from cardwatch.streaming.source import ARRIVAL

MESSAGE = "key string, value string, timestamp timestamp"
T0 = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)


def at(seconds):
    return int((T0.timestamp() + seconds) * 1000)


@pytest.fixture
def feed(spark, make, tmp_path):
    """Appends a file of messages; rows arrive in the order of the files."""
    folder = tmp_path / "in"
    folder.mkdir()

    def add(*rows):
        source.to_messages(make(*rows)).coalesce(1).write.mode("append").parquet(str(folder))

    def stream(watermark="10 minutes", **options):
        return source.parse(source.read_folder(spark, str(folder), MESSAGE, files_per_trigger=1), watermark=watermark)

    add.stream = stream
    return add


def drain(spark, df, tmp_path, name, mode="append"):
    """Runs what has arrived; the same name goes on from its checkpoint."""
    query = (df.writeStream.format("parquet").option("path", str(tmp_path / name)).outputMode(mode)
             .option("checkpointLocation", str(tmp_path / f"{name}-cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(str(tmp_path / name))


def test_broken_json_goes_to_the_rejects(spark):
    df = spark.createDataFrame([("a", "{oops", T0), ("b", '{"transactionId": "TX1-1"}', T0), ("c", None, T0)], MESSAGE)
    assert [r.transaction_id for r in source.parse(df).collect()] == ["TX1-1"]
    assert sorted(((r.raw or ""), r.arrival_time is not None) for r in source.rejects(df).collect()) == [("", True), ("{oops", True)]


def test_late_rows_are_dropped_and_out_of_order_rows_kept(spark, feed, tmp_path):
    feed({"timestamp_ms": at(0), "transaction_id": "TX1-1"})
    feed({"timestamp_ms": at(1800), "transaction_id": "TX2-1"})
    # Spark compares late rows with the watermark of the batch before.
    feed({"timestamp_ms": at(1860), "transaction_id": "TX6-1"})
    feed({"timestamp_ms": at(1500), "transaction_id": "TX3-1"},  # within the watermark
         {"timestamp_ms": at(60), "transaction_id": "TX4-1"})  # too late
    feed({"timestamp_ms": at(9000), "transaction_id": "TX5-1"})
    out = drain(spark, windows.sliding(feed.stream(), length="1 minute", slide="1 minute"), tmp_path, "late")
    starts = sorted((r.window_start.replace(tzinfo=dt.timezone.utc) - T0).total_seconds() for r in out.collect())
    assert starts == [0, 1500, 1800, 1860]


def test_sessions_batch_equals_stream_on_gaps(spark, make, feed, tmp_path):
    rows = [{"timestamp_ms": at(s), "transaction_id": f"TX{i}-1", "location": p, "merchant_category": c}
            for i, (s, p, c) in enumerate([(0, "Paris", "RETAIL"), (599, "Tokyo", "CRYPTO"),  # 9:59
                                           (599 + 601, "Paris", "RETAIL"),  # 10:01
                                           (599 + 601 + 600, "Paris", "ODD")])]  # 10:00
    late = {"timestamp_ms": at(99_999), "transaction_id": "TX9-1"}
    feed(*rows[:2])
    feed(*rows[2:], late)
    streamed = drain(spark, windows.sessions(feed.stream()), tmp_path, "sessions")
    batch = windows.sessions_batch(source.parse(source.to_messages(make(*rows, late))))
    whole = windows.sessions(source.parse(source.to_messages(make(*rows, late))))
    order = "session_start"
    assert batch.orderBy(order).collect() == whole.orderBy(order).collect()
    closed = batch.orderBy(order).collect()[:-1]
    assert streamed.orderBy(order).collect() == closed
    assert (closed[0].first_location, closed[0].last_location, closed[0].has_location_change) == ("Paris", "Tokyo", True)
    assert closed[0].session_duration_minutes == (599 + 600) / 60
    assert [(c.category, c.row_count) for c in closed[-1].merchant_categories][-1] == ("ODD", 1)


def test_session_blocks_equal_plain_sessions(medium_tx):
    timed = medium_tx.withColumn(ARRIVAL, F.timestamp_millis("timestamp_ms"))
    for gap in (600_000, 7_200_000):
        a = windows.sessions(timed, gap=f"{gap} milliseconds").drop("merchant_categories")
        b = windows.sessions_batch(timed, gap_ms=gap).drop("merchant_categories")
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    with pytest.raises(ValueError):
        windows.sessions_batch(timed, gap_ms=1000)


def test_restart_goes_on_from_the_checkpoint(spark, feed, tmp_path):
    stored, alerts, progress = (str(tmp_path / n) for n in ("stored", "alerts", "cp"))
    feed({"amount": 20000.0, "is_international": True, "timestamp_ms": at(0), "transaction_id": "TX1-1"})
    pipeline.run_pipeline(feed.stream(), stored, alerts, progress, None).awaitTermination()
    feed({"amount": 1.0, "timestamp_ms": at(10), "transaction_id": "TX2-1"})
    feed({"amount": 15000.0, "is_international": True, "timestamp_ms": at(20), "transaction_id": "TX3-1"})
    pipeline.run_pipeline(feed.stream(), stored, alerts, progress, None).awaitTermination()
    back = pipeline.read_back(spark, stored)
    assert sorted(r.transaction_id for r in back.collect()) == ["TX1-1", "TX2-1", "TX3-1"]
    assert sorted(r.key for r in pipeline.read_back(spark, alerts).collect()) == ["TX1-1", "TX3-1"]
    assert {(r.batch_id, r.transactions, r.predicted) for r in pipeline.batch_counts(
        back.withColumn("is_fraud", F.lit(False))).collect()} == {(0, 1, 1), (1, 1, 0), (2, 1, 1)}


def test_repeated_batch_replaces_itself(spark, make, tmp_path):
    stored, alerts = str(tmp_path / "s"), str(tmp_path / "a")
    batch = pipeline.score(source.parse(source.to_messages(make({"timestamp_ms": at(0)}, {"timestamp_ms": at(1)}))))
    write = pipeline.store_and_alert(stored, alerts)
    write(batch, 7)
    write(batch, 7)
    assert pipeline.read_back(spark, stored).count() == 2


def test_memory_sink_and_metrics(spark, feed, tmp_path):
    feed({"timestamp_ms": at(0), "amount": 20000.0, "is_international": True}, {"timestamp_ms": at(30)})
    df = windows.metrics(pipeline.score(feed.stream()))
    pipeline.to_memory(df, "live_metrics", "update", None, str(tmp_path / "cp")).awaitTermination()
    row = spark.table("live_metrics").first()
    assert (row.total_transactions, row.fraud_count, row.high_risk_count, row.fraud_rate) == (2, 1, 1, 0.5)


def test_message_sink(spark, feed, tmp_path):
    feed({"timestamp_ms": at(0), "amount": 20000.0, "is_international": True})
    alerts = pipeline.score(feed.stream()).where("alert_required")
    pipeline.to_messages(alerts, str(tmp_path / "cp"), "parquet", None, path=str(tmp_path / "out")).awaitTermination()
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert row.key == "TX1-1" and '"alert_reasons":["HIGH_AMOUNT","HIGH_INTERNATIONAL_TX"]' in row.value


def test_event_hub_options():
    options = source.event_hub_options("endpoint", "group")
    assert options["eventhubs.consumerGroup"] == "group" and '"offset": "-1"' in options["eventhubs.startingPosition"]


def test_versions_equal_the_batch_and_survive_repetition_and_compaction(spark, make, feed, tmp_path):
    place, progress = str(tmp_path / "versions"), str(tmp_path / "cp")
    rows = [{"timestamp_ms": at(40 * i), "transaction_id": f"TX{i}-1", "customer_id": f"CUST{i % 2}"} for i in range(12)]
    df, keys = windows.sliding(feed.stream()), ["customer_id", "window_start", "window_end"]
    for part in (rows[:5], rows[5:9], rows[9:]):
        feed(*part)
        upsert.write_versions(df, place, progress).awaitTermination()
    expected = sorted(map(tuple, windows.sliding(source.parse(source.to_messages(make(*rows)))).collect()))

    def now():
        return sorted(map(tuple, upsert.latest(spark, place, df.schema, keys).collect()))
    assert now() == expected
    last = upsert.latest(spark, place, df.schema, keys).limit(3)
    last.write.mode("overwrite").parquet(f"{place}/versions/batch_id=90")
    assert now() == expected
    upsert.compact(spark, place, df.schema, keys, 1)
    assert now() == expected
    upsert.compact(spark, place, df.schema, keys, 90)
    upsert.compact(spark, place, df.schema, keys, 2)
    assert now() == expected


def test_no_changes_are_an_empty_table(spark, feed, tmp_path):
    feed()
    df = windows.sliding(feed.stream())
    upsert.write_versions(df, str(tmp_path / "v"), str(tmp_path / "cp")).awaitTermination()
    assert upsert.latest(spark, str(tmp_path / "v"), df.schema, ["customer_id", "window_start"]).collect() == []


def test_session_states_equal_the_batch(spark, make, feed, tmp_path):
    rng = random.Random(1)
    rows = [{"timestamp_ms": at(rng.randrange(40_000)), "transaction_id": f"TX{i}-1", "customer_id": rng.choice(["A", "B", None]),
             "merchant_category": rng.choice(["RETAIL", "ODD", None, "x y"]), "location": rng.choice(["Paris", "Tokyo"])}
            for i in range(150)]
    rows.sort(key=lambda r: r["timestamp_ms"])
    for start in range(0, 150, 30):
        part = rows[start:start + 30]
        rng.shuffle(part)
        feed(*part)
    feed({"timestamp_ms": at(99_999), "transaction_id": "TX999-1", "customer_id": "Z"})
    got = drain(spark, sessions.sessions(feed.stream()), tmp_path, "states")
    expected = windows.sessions_batch(source.parse(source.to_messages(make(*rows))))

    def plain(df):
        return sorted((str(r.customer_id), r.session_start, r.session_end, r.session_tx_count, r.session_total_amount, r.first_location,
                       r.last_location, r.has_location_change, r.session_duration_minutes,
                       sorted((str(c.category), c.row_count) for c in r.merchant_categories)) for r in df.collect())
    assert plain(got) == plain(expected)


def test_session_states_hold_one_count_per_category():
    import pandas as pd
    rows = pd.DataFrame({"us": range(5000), "transaction_id": [str(i) for i in range(5000)], "location": "Paris",
                         "merchant_category": ["a", None] * 2500, "amount_cents": 1})
    now = []
    for at_ in range(0, 5000, 500):
        now = sessions.merged(now + sessions.pieces(rows[at_:at_ + 500], 10), 10)
    assert len(now) == 1 and sorted(now[0][6], key=str) == [["a", 2500], [None, 2500]] and now[0][2] == 5000


def test_many_sessions_of_a_customer_take_no_frames_of_their_own():
    import time

    import pandas as pd
    n = 20_000
    rows = pd.DataFrame({"us": range(0, 100 * n, 100), "transaction_id": [str(i) for i in range(n)], "location": "Paris",
                         "merchant_category": [None, "a"] * (n // 2), "amount_cents": 1})
    start = time.process_time()
    found = sessions.pieces(rows[::-1], 10)
    assert time.process_time() - start < 2  # a data frame operation each took more than ten times as long
    assert len(found) == n and found[1] == [100, 100, 1, 1, [100, "1", "Paris"], [100, "1", "Paris"], [["a", 1]]]
    assert sessions.pieces(rows, 10, after_us=100 * (n - 1)) == [found[-1]]


def test_windows_from_panes_equal_sliding_windows(spark, make, feed, tmp_path):
    rng = random.Random(4)
    rows = [{"timestamp_ms": at(rng.randrange(-600, 900)), "transaction_id": f"TX{i}-1", "customer_id": rng.choice(["A", "B", None]),
             "amount": rng.choice([1.5, 9000.0, None]), "location": rng.choice(["Paris", "Tokyo", "Dubai", "London", None])} for i in range(120)]
    place, keys = str(tmp_path / "versions"), ["customer_id", "window_start", "window_end"]
    stream = windows.panes(feed.stream())
    for part in (rows[:50], rows[50:]):
        feed(*part)
        upsert.write_versions(stream, place, str(tmp_path / "cp")).awaitTermination()
    kept = upsert.latest(spark, place, stream.schema, keys)
    batch = source.parse(source.to_messages(make(*rows)))

    def plain(df):
        return sorted(tuple(map(str, r)) for r in df.collect())
    assert plain(windows.sliding_from_panes(windows.panes(batch))) == plain(windows.sliding(batch))
    assert kept.agg({"_n": "sum"}).first()[0] >= 50  # rows of the second part may be late
    assert windows.sliding_from_panes(kept).columns == windows.sliding(batch).columns


def test_the_state_of_sliding_windows_has_one_entry_a_minute(spark, monkeypatch):
    from cardwatch.plans import QUERIES
    from cardwatch.plans import stream_queries
    taken = []
    whole = upsert.write_versions
    monkeypatch.setattr(stream_queries.upsert, "write_versions", lambda df, *a: taken.append(whole(df, *a)) or taken[0])
    assert not QUERIES["win_sliding_stream"](spark, "/root/testdata/sf0.001").isEmpty()
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    minutes = events.selectExpr("user_id", "unix_micros(CAST(ts AS TIMESTAMP)) DIV 60000000").distinct().count()
    assert max(p.stateOperators[0].numRowsUpdated for p in taken[0].recentProgress) == minutes


class Broken(Exception):
    pass


def test_a_failed_sink_loses_and_doubles_nothing(spark, feed, tmp_path):
    stored, place, progress, ledger, sink = (str(tmp_path / n) for n in ("s", "outbox", "cp", "ledger", "sink"))
    big = {"amount": 20000.0, "is_international": True}
    send, received = outbox.to_folder(sink)
    failures = ["half", "before"]

    def shaky(messages, batch_id):
        if failures:
            if failures.pop(0) == "half":
                send(messages.orderBy("key").limit(2), batch_id)
            raise Broken("sink is gone")
        send(messages, batch_id)

    feed(*[{**big, "timestamp_ms": at(i), "transaction_id": f"TX{i}-1"} for i in range(5)])
    feed({"amount": 1.0, "timestamp_ms": at(9), "transaction_id": "TX9-1"})
    feed(*[{**big, "timestamp_ms": at(i), "transaction_id": f"TX{i}-1"} for i in range(20, 23)])

    def run():
        pipeline.run_pipeline(feed.stream(), stored, place, progress, None, ledger=ledger, send=shaky,
                              received=received).awaitTermination()
    for _ in range(2):
        with pytest.raises(Exception, match="sink is gone"):
            run()
    run()
    expected = sorted(f"TX{i}-1" for i in [*range(5), *range(20, 23)])
    assert sorted(r.key for r in spark.read.parquet(sink).collect()) == expected
    assert pipeline.read_back(spark, stored).count() == 9
    assert outbox.deliver(spark, place, ledger, shaky, received) == 0


def test_without_a_list_of_received_messages_a_batch_is_sent_again(spark, make, tmp_path):
    place, ledger = str(tmp_path / "outbox"), str(tmp_path / "ledger")
    alerts = pipeline.score(source.parse(source.to_messages(make({"amount": 20000.0, "is_international": True}))))
    outbox.put(alerts, place, 3)
    outbox.put(alerts, place, 3)
    sent = []

    def send(messages, batch_id):
        sent.append((batch_id, [r.key for r in messages.collect()]))
        if len(sent) == 1:
            raise Broken
    with pytest.raises(Broken):
        outbox.deliver(spark, place, ledger, send)
    assert outbox.deliver(spark, place, ledger, send) == 1 and sent == [(3, ["TX1-1"])] * 2
