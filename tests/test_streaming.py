"""Streams in several micro-batches against the batch results."""

from __future__ import annotations

import glob
import json
import random
import threading
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_fraud import at, random_rows

from tillstream.operators.fraud import fraud_alerts
from tillstream.operators.latest import latest_per_key
from tillstream.operators.parse import accepted, parse_transactions
from tillstream.operators.project import to_sink_columns, transactions_view
from tillstream.operators.sales import running_totals, sales_per_category, sales_per_day, sales_per_month
from tillstream.session import scratch_folder
from tillstream.sinks.documents import to_messages
from tillstream.sinks.tables import FolderTables
from tillstream.sources.messages import KAFKA_SEQ, file_source
from tillstream.streaming import as_written, headline, pipeline, progress, running
from tillstream.streaming.fraud import start_fraud_alerts
from tillstream.streaming.run import AVAILABLE_NOW


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(v is not None, v) for v in r])


def alert_rows(df):
    return rows_of(df, "customer_id", "previous_date", "date", "minutes", "seconds", "seq")


def write_slices(df, folder, bounds):
    """One folder entry per slice of the arrival order, written one after the other."""
    for low, high in zip(bounds, bounds[1:]):
        part = df.where(F.col("seq").between(low, high - 1))
        part.coalesce(1).write.mode("append").parquet(folder)


class Repeating:
    """Passes every batch on twice, as after a crash between the write and the commit."""

    def __init__(self, write):
        self.write = write

    def __call__(self, *args):
        self.write(*args)
        self.write(*args)


def test_fraud_over_many_batches(spark, transactions, tmp_path):
    df = transactions(random_rows(5, 300))
    expected = alert_rows(fraud_alerts(df))
    messages, alerts = str(tmp_path / "in"), str(tmp_path / "alerts")
    write = Repeating(pipeline.folder_alerts(alerts))

    def run():
        stream = file_source(spark, messages, df.schema, max_files=1)
        start_fraud_alerts(stream, write, str(tmp_path / "work"), trigger=AVAILABLE_NOW, ranges=9)

    bounds = [0, 40, 41, 150, 5300, 50300, 10**9]
    write_slices(df, messages, bounds[:4])
    run()
    write_slices(df, messages, bounds[3:])
    run()  # goes on from the checkpoint
    found = spark.read.parquet(alerts)
    assert alert_rows(found) == expected
    parts = {r.part: r.n for r in found.groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert parts["inside"] > 0 and parts["across"] > 0


def test_fraud_ignores_a_run_written_twice(spark, transactions, tmp_path):
    """A repeated first step leaves a second file for the same batch, read later."""
    df = transactions(random_rows(6, 100))
    messages, work, alerts = (str(tmp_path / n) for n in ("in", "work", "alerts"))

    def run():
        stream = file_source(spark, messages, df.schema, max_files=1)
        start_fraud_alerts(stream, pipeline.folder_alerts(alerts), work, trigger=AVAILABLE_NOW)

    write_slices(df, messages, [0, 30])
    run()
    runs = spark.read.parquet(f"{work}/runs").toPandas()
    spark.createDataFrame(runs, spark.read.parquet(f"{work}/runs").schema).write.mode("append").parquet(f"{work}/runs")
    write_slices(df, messages, [30, 10**9])
    run()
    assert alert_rows(spark.read.parquet(alerts)) == alert_rows(fraud_alerts(df))


def test_fraud_in_kafka_order(spark, transactions, tmp_path):
    rows = random_rows(7, 120)
    for row in rows:
        row["ingest_ts"] = at(row["seq"] // 3)
    df = transactions(rows).withColumnRenamed("ingest_ts", "timestamp").withColumns(
        {"partition": (F.col("seq") % 2).cast("int"), "offset": F.col("seq")}
    )
    messages, alerts = str(tmp_path / "in"), str(tmp_path / "alerts")
    write_slices(df, messages, [0, 60, 10**9])
    stream = file_source(spark, messages, df.schema, max_files=1)
    start_fraud_alerts(
        stream, pipeline.folder_alerts(alerts), str(tmp_path / "work"), KAFKA_SEQ, AVAILABLE_NOW
    )
    columns = ("customer_id", "previous_date", "date", *KAFKA_SEQ)
    assert rows_of(spark.read.parquet(alerts), *columns) == rows_of(
        fraud_alerts(df, KAFKA_SEQ), *columns
    )


def test_printed_and_stored_alert_texts(spark, transactions, tmp_path, capfd):
    """More alerts in every batch than any preview shows, from both parts; none is lost, no batch fails."""
    rows = [
        {"customer_id": f"c{c}", "customer_country": f"L{visit}", "transaction_date": at(visit * 1000), "seq": visit * 100 + c}
        for visit in range(6) for c in range(100)
    ]
    df = transactions(rows)
    messages = str(tmp_path / "in")
    write_slices(df, messages, [0, 200, 300, 600])
    for name, target in (("print", pipeline.console_alerts()), ("text", pipeline.text_alerts(str(tmp_path / "texts")))):
        stream = file_source(spark, messages, df.schema, max_files=1)
        start_fraud_alerts(stream, target, str(tmp_path / name), trigger=AVAILABLE_NOW)
    assert capfd.readouterr().out.count("0 phút 1 giây") == 500
    lines = spark.read.text(str(tmp_path / "texts")).where(F.col("value").contains("0 phút 1 giây"))
    assert {(r.part, r["count"]) for r in lines.groupBy("part").count().collect()} == {("inside", 300), ("across", 200)}


def test_file_limits_change_no_alert(spark, transactions, tmp_path):
    """One commit in several files that are not in order: a later query takes it whole."""
    rows = random_rows(13, 200)
    for number, row in enumerate(rows):
        row["customer_id"] = row["customer_id"] or "e"
        row["transaction_id"] = f"t{number}"
    df = transactions(rows)
    messages = to_messages(df, "seq").select("seq", "value").repartition(6, "value")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    messages.write.parquet(source)
    stream = file_source(spark, source, messages.schema)
    pipeline.start_pipeline(stream, pipeline.folder_targets(out), str(tmp_path / "work"), trigger=AVAILABLE_NOW)
    assert alert_rows(spark.read.parquet(f"{out}/alerts")) == alert_rows(fraud_alerts(df))


def test_headline_over_many_batches(spark, tmp_path):
    schema = "seq long, reason string, total_amount double"
    rows = [(i, "bad" if i % 4 == 0 else None, 0.1) for i in range(60)]
    df = spark.createDataFrame(rows, schema)
    messages, folder = str(tmp_path / "in"), str(tmp_path)
    assert headline.read_newest(spark, f"{folder}/kpi") is None
    for bounds in ([0, 10, 25], [25, 60]):
        write_slices(df, messages, bounds)
        stream = file_source(spark, messages, df.schema, max_files=1)
        headline.start_kpi(stream, f"{folder}/kpi", f"{folder}/c1", AVAILABLE_NOW)
        headline.start_recent(stream, f"{folder}/recent", f"{folder}/c2", n=7, trigger=AVAILABLE_NOW)
    assert tuple(headline.read_newest(spark, f"{folder}/kpi").first()) == (60, 45, 15, 4.5)
    assert rows_of(headline.read_newest(spark, f"{folder}/recent"), "seq") == [(i,) for i in range(53, 60)]


def test_fraud_state_can_be_forgotten(spark, transactions, tmp_path):
    from tillstream.streaming import fraud

    class State:
        hasTimedOut, exists, gone, kept_for = True, True, False, None
        get = (4, "A", 0, "p", 1.0)

        def remove(self):
            self.gone = True

        def update(self, value):
            self.value = value

        def setTimeoutDuration(self, ms):
            self.kept_for = ms

    columns = ["customer_id", *(f"{e}_{n}" for e in ("first", "last") for n in fraud._NAMES), "seq", "batch_id"]
    carry, state = fraud._carrier(columns, ["customer_id"], 360_000, 5_000), State()
    assert list(carry(("c",), iter([]), state)) == [] and state.gone
    frame = pd.DataFrame([["c", "B", 1, "p", 1.0, "B", 1, "p", 1.0, 1, 5]], columns=columns)
    state.hasTimedOut = False
    [found] = carry(("c",), iter([frame]), state)
    assert len(found) == 1 and state.kept_for == 5_000
    with pytest.raises(ValueError):
        start_fraud_alerts(transactions([{}]), None, str(tmp_path), trigger=AVAILABLE_NOW, forget_ms=1)


def test_state_function_speed():
    """Calls per second for customers with one run each, without the state store."""
    from tillstream.streaming import fraud

    columns = ["customer_id", *(f"{e}_{n}" for e in ("first", "last") for n in fraud._NAMES), "seq", "batch_id"]
    carry = fraud._carrier(columns, ["customer_id", *(f"first_{n}" for n in fraud._NAMES), "seq"], 360_000)
    frame = pd.DataFrame([["c", "A", 1, "p", 1.0, "A", 1, "p", 1.0, 1, 5]], columns=columns)

    class State:
        exists, get = True, (4, "A", 0, "p", 1.0)

        def update(self, value):
            self.value = value

    state, start = State(), time.perf_counter()
    for _ in range(300):
        assert list(carry(("c",), iter([frame]), state)) == []
    assert state.value == (5, "A", 1, "p", 1.0)
    assert 300 / (time.perf_counter() - start) > 1000


@pytest.mark.parametrize("table", sorted(pipeline.SALES))
def test_sales_over_many_batches(spark, transactions, tmp_path, table):
    rng = random.Random(1)
    rows = [
        {"transaction_date": at(rng.randrange(0, 10**10)), "total_amount": rng.randrange(1, 999) / 100,
         "product_category": rng.choice(["home", "beauty"])}
        for _ in range(90)
    ]
    df = transactions(rows)
    messages, tables = str(tmp_path / "in"), FolderTables(str(tmp_path / "tables"))

    def run():
        stream = file_source(spark, messages, df.schema, max_files=1)
        pipeline.start_sales(stream, table, tables, str(tmp_path / "checkpoint"), AVAILABLE_NOW)

    write_slices(df, messages, [0, 30, 60])
    run()
    write_slices(df, messages, [60, 90])
    run()
    expected = pipeline.SALES[table](df)
    assert rows_of(tables.read(spark, table), *expected.columns) == rows_of(expected, *expected.columns)


def test_as_written_streams(spark, transactions, tmp_path):
    """Batches across midnight, and one millisecond in two batches."""
    rows = [
        {"transaction_date": at(i // 2 * 86_400_000 * 40 + i // 3), "total_amount": 1.0 + i,
         "product_category": "home" if i % 3 else "beauty"}
        for i in range(16)
    ]
    df = transactions(rows)
    messages = str(tmp_path / "in")
    write_slices(df, messages, [0, 1, 4, 5, 11, 16])
    for table, batch in (
        ("sales_per_day", sales_per_day(df, "as_written")),
        ("sales_per_category", sales_per_category(df, "as_written")),
        ("sales_per_month", sales_per_month(df, "as_written")),
    ):
        tables = FolderTables(str(tmp_path / "tables"))
        stream = file_source(spark, messages, df.schema, max_files=1)
        pipeline.start_sales(
            stream, table, tables, str(tmp_path / f"c_{table}"), AVAILABLE_NOW, mode="as_written"
        )
        assert rows_of(tables.read(spark, table), *batch.columns) == rows_of(batch, *batch.columns)


@pytest.fixture
def one_partition(spark):
    """For many tiny micro-batches."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("table", ["sales_per_day", "sales_per_category"])
def test_as_written_state_stays_small(spark, transactions, tmp_path, monkeypatch, one_partition, table):
    """Batches in and out of date order: bounded folders, the batch operator's rows."""
    monkeypatch.setattr(as_written, "MERGE_EVERY", 3)
    rng = random.Random(3)
    rows = [
        {"transaction_date": at((i // 4 + (-7 if i % 11 == 0 else 0)) * 43_200_000 + rng.randrange(9) * 3_600_000),
         "total_amount": rng.choice([None, 0.001, 12.34, 99.999999, -3.1]),
         "product_category": rng.choice(["home", "beauty", None])}
        for i in range(120)
    ]
    df = transactions(rows)
    tables, state = FolderTables(str(tmp_path / "tables")), as_written.state_tables(str(tmp_path / "c"))
    name = {"sales_per_day": "last_ms", "sales_per_category": "category_days"}[table]
    folders = []

    class Store:
        def upsert(self, totals, target, batch_id):
            tables.upsert(totals, target, batch_id)
            folders.append(len(state.snapshot(spark, name).folders()))

    messages = str(tmp_path / "in")
    write_slices(df, messages, list(range(0, 121, 10)))
    stream = file_source(spark, messages, df.schema, max_files=1)
    pipeline.start_sales(stream, table, Store(), str(tmp_path / "c"), AVAILABLE_NOW, mode="as_written")
    expected = pipeline.SALES[table](df, "as_written", "transaction_date")
    assert rows_of(tables.read(spark, table), *expected.columns) == rows_of(expected, *expected.columns)
    # As many folders are read at the end as after the first few batches.
    assert len(folders) == 12 and max(folders[-4:]) == max(folders[:6]) <= 5
    assert len(glob.glob(f"{tmp_path}/c-state/{name}/*-*")) <= 8


def test_late_dates_reach_the_scan(spark, transactions, tmp_path):
    """A batch reads the stored dates from its earliest one on, not the whole state."""
    state = as_written.state_tables(str(tmp_path / "c"))
    for batch in range(2):
        df = transactions([{"transaction_date": at(86_400_000 * (i + batch)), "product_category": "x"} for i in range(5)])
        new = df.groupBy(F.to_date("transaction_date").alias("transaction_date"),
                         F.col("product_category").alias("category")).agg(*as_written.part_sums())
        sums = [F.col(p).alias(t) for p, t in zip(as_written.PARTS, as_written.TOTALS)]
        state.upsert(new.select("*", *sums), "category_days", batch)
    days = state.read_before(spark, "category_days", 2).where(F.col("transaction_date") >= F.lit(at(0).date()))
    scan = days._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(transaction_date" in scan


def test_sub_cent_sums_of_one_millisecond_stay_exact(spark):
    """Ten thousand batches with a tenth of a millionth-exact cent each: parts add up where rounded doubles drift."""
    amounts = spark.range(10_000).select(
        F.lit(at(0).date()).alias("transaction_date"), F.lit(5).cast("long").alias("ms"),
        F.lit(0.001).alias("total_amount"), F.col("id").alias("batch"),
    )
    per_batch = amounts.groupBy("transaction_date", "ms", "batch").agg(*as_written.part_sums()).drop("batch")
    half = per_batch.limit(5_000)
    found = as_written.last_ms_totals(per_batch.exceptAll(half).unionByName(half), None)
    assert found.select(as_written.part_total().alias("t")).first().t == 10.0
    # Batch after batch: what was stored meets the next one.
    stored = None
    for _ in range(20):
        stored = as_written.last_ms_totals(per_batch.limit(1), stored)
    assert stored.select(as_written.part_total().alias("t")).first().t == 0.02


@pytest.mark.parametrize("key", ["product_category", "seconds"])
def test_running_totals_over_many_batches(spark, transactions, tmp_path, key):
    """Null and heavy keys, missing amounts, repeated batches, a restart: the batch operator's totals, few folders."""
    rng = random.Random(4)
    rows = [
        {"product_category": rng.choice(["home"] * 6 + ["beauty", None, "home x"]),
         "total_amount": rng.choice([None, 0.01, 0.000001, 12.34, -7.5, 1e15]), "transaction_date": at(rng.randrange(5) * 1000)}
        for _ in range(60)
    ]
    df = transactions(rows).withColumn("seconds", F.unix_seconds("transaction_date"))
    messages, out, work = (str(tmp_path / n) for n in ("in", "out", "work"))

    def store(found, batch_id):
        found.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    def run():
        stream = file_source(spark, messages, df.schema, max_files=1)
        running.start_running_totals(stream, Repeating(store), work, key, trigger=AVAILABLE_NOW, ranges=3)

    write_slices(df, messages, [0, 1, 20])
    run()
    sums = spark.read.parquet(f"{work}/sums")
    spark.createDataFrame(sums.collect(), sums.schema).write.mode("append").parquet(f"{work}/sums")
    write_slices(df, messages, [20, 45, 60])
    run()
    expected = running_totals(df, key)
    columns = ("seq", key, "running_total")
    assert rows_of(spark.read.parquet(out), *columns) == rows_of(expected, *columns)
    assert len(glob.glob(f"{work}/rows/*")) <= 4 and len(glob.glob(f"{work}/before/*")) == 1


def test_repeated_transactions_count_once(spark, transactions, tmp_path):
    """Late rows count; a transaction that comes again, in the same or a later batch, does not."""
    rows = [{"transaction_id": f"t{i}", "transaction_date": at(i * 40_000_000), "total_amount": 1.0} for i in range(12)]
    df = transactions(rows)
    again = df.withColumn("seq", F.col("seq") + 100)
    messages = str(tmp_path / "in")
    # Newest dates first, so the second slice is late; then everything once more.
    write_slices(df, messages, [6, 12])
    write_slices(df.union(df), messages, [0, 6])
    write_slices(again, messages, [100, 112])
    for replays, times in (("30 days", 1), (None, 2)):
        tables = FolderTables(str(tmp_path / f"tables{times}"))
        stream = file_source(spark, messages, df.schema, max_files=1)
        pipeline.start_sales(
            stream, "sales_per_day", tables, str(tmp_path / f"c{times}"), AVAILABLE_NOW, replays=replays
        )
        total = tables.read(spark, "sales_per_day").agg(F.sum("total_sales")).first()[0]
        assert total == (12 if replays else 30)


def test_pipeline_folders_stay_bounded(spark, transactions, tmp_path, one_partition):
    """Batch after batch with restarts: parsed messages, runs, links and lists go, no row is lost, counts are stored."""
    rows = random_rows(14, 120)
    for number, row in enumerate(rows):
        row["customer_id"], row["transaction_id"] = row["customer_id"] or "e", f"t{number}"
    df = transactions(rows)
    messages = to_messages(df, "seq").select("seq", "value").union(
        spark.createDataFrame([(11, "{bad")], "seq bigint, value string")
    )
    source, out, work = (str(tmp_path / n) for n in ("in", "out", "work"))
    targets = pipeline.folder_targets(out)
    bounds = [0, 12, 24, 40, 60, 90, 10**9]
    for low, high in ((0, 3), (2, 4), (3, 7)):
        write_slices(messages, source, bounds[low:high])
        stream = file_source(spark, source, messages.schema, max_files=1)
        pipeline.start_pipeline(stream, targets, work, trigger=AVAILABLE_NOW)
        assert glob.glob(f"{work}/parsed/parsed_at=*") == []
        assert len(glob.glob(f"{work}/fraud/links/*")) <= 2
        for name in ("kpi", "recent"):
            assert len(glob.glob(f"{work}/headline/{name}/*")) <= headline.KEPT_BATCHES
    assert targets.tables.read(spark, "transactions").count() == 120
    expected = sales_per_day(df)
    assert rows_of(targets.tables.read(spark, "sales_per_day"), *expected.columns) == rows_of(expected, *expected.columns)
    assert alert_rows(spark.read.parquet(f"{out}/alerts")) == alert_rows(fraud_alerts(df))
    assert headline.read_newest(spark, f"{work}/headline/kpi").first().total_transactions == 121
    stored = progress.read_progress(spark, f"{work}/progress")
    assert tuple(stored.agg(F.sum("messages"), F.sum("rejected")).first()) == (121, 1)
    assert stored.count() >= 5


def test_parsed_parts_wait_for_the_slowest_reader(spark, tmp_path):
    """Nothing goes before every reader has it, also after a restart of the driver."""
    folder, state = str(tmp_path / "parsed"), str(tmp_path / "reached.json")
    for part in ("t1", "t2", "t3"):
        (tmp_path / "parsed" / f"at={part}").mkdir(parents=True)
    left = lambda: sorted(p.name for p in (tmp_path / "parsed").iterdir())
    first = progress.Retention(spark, folder, "at", ["a", "b"], state)
    first.seen("q", 0, None, {"a": {"upto": "t3"}, "other": {"upto": "t9"}})
    first.seen("q", 1, None, {"b": {"upto": None}})
    assert left() == ["at=t1", "at=t2", "at=t3"]
    again = progress.Retention(spark, folder, "at", ["a", "b"], state)
    again.seen("r", 0, None, {"b": {"upto": "t2"}})
    assert left() == ["at=t3"]
    again.seen("r", 0, None, {"b": {"upto": "t1"}})  # a repeated batch
    again.seen("r", 1, None, {"b": {"upto": "t3"}})
    assert left() == []


def test_watermark_is_optional(spark, transactions, tmp_path):
    df = transactions([{}])
    df.write.parquet(str(tmp_path / "in"))
    stream = file_source(spark, str(tmp_path / "in"), df.schema)
    assert "EventTimeWatermark" in plan_of(transactions_view(stream, None, "5 seconds"))
    assert "EventTimeWatermark" not in plan_of(transactions_view(stream, None))


def plan_of(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_pipeline(spark, transactions, tmp_path):
    """Every sink of the whole pipeline, restarted half-way, against the batch operators."""
    rng = random.Random(2)
    rows = random_rows(8, 240)
    for number, row in enumerate(rows):
        row["customer_id"] = row["customer_id"] or "e"
        row["transaction_id"] = f"t{number // 2}"
        row["product_category"] = rng.choice(["home", "beauty", "sports"])
        row["total_amount"] = rng.randrange(1, 99999) / 100
    df = transactions(rows)
    valid = to_messages(df, "seq").select("seq", "value")
    broken = spark.createDataFrame(
        [(7, "{bad"), (8, "[]"), (9, "null"), (90_000, '{"zzz":1}')], "seq bigint, value string"
    )
    messages = valid.union(broken)
    good, rejects = parse_transactions(messages)
    assert good.count() == 240

    folder, out = str(tmp_path / "work"), str(tmp_path / "out")
    source = str(tmp_path / "in")
    targets = pipeline.folder_targets(out)

    def run():
        stream = file_source(spark, source, messages.schema, max_files=1)
        return pipeline.start_pipeline(stream, targets, folder, trigger=AVAILABLE_NOW)

    write_slices(messages, source, [0, 50, 140])
    queries = run()
    metrics = [p["observedMetrics"]["ingest"] for p in queries[0].recentProgress if p["numInputRows"]]
    assert sum(m["messages"] for m in metrics) > 0 and sum(m["rejected"] for m in metrics) == 2
    write_slices(messages, source, [140, 60_000, 10**9])
    run()

    tables = targets.tables
    latest = to_sink_columns(latest_per_key(good, "transaction_id"))
    assert rows_of(tables.read(spark, "transactions"), *latest.columns) == rows_of(latest, *latest.columns)
    for name, operator in pipeline.SALES.items():
        expected = operator(good)
        assert rows_of(tables.read(spark, name), *expected.columns) == rows_of(expected, *expected.columns)
    assert alert_rows(spark.read.parquet(f"{out}/alerts")) == alert_rows(fraud_alerts(good))
    found = spark.read.parquet(f"{out}/rejects")
    assert rows_of(found, "seq", "value", "reason") == rows_of(rejects, "seq", "value", "reason")

    documents = {}
    for batch in sorted(glob.glob(f"{out}/documents/batch_id=*"), key=lambda p: int(p.split("=")[-1])):
        lines = [line for f in glob.glob(f"{batch}/part-*") for line in open(f, encoding="utf-8")]
        for action, body in zip(lines[::2], lines[1::2]):
            documents[json.loads(action)["index"]["_id"]] = json.loads(body)
    assert len(documents) == 120
    amounts = {r.transaction_id: r.total_amount for r in latest.collect()}
    assert {i: d["totalAmount"] for i, d in documents.items()} == amounts


def test_pipeline_live(spark, transactions, tmp_path):
    """All queries at once on an interval; each is waited for in the order of the data's way."""
    rows = random_rows(12, 80)
    for row in rows:
        row["customer_id"] = row["customer_id"] or "e"
    df = transactions(rows)
    messages = to_messages(df, "seq").select("seq", "value")
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    write_slices(messages, source, [0, 20])
    stream = file_source(spark, source, messages.schema, max_files=1)
    targets = pipeline.folder_targets(out)
    queries = pipeline.start_pipeline(stream, targets, str(tmp_path / "work"), trigger="1 second")
    try:
        assert len(queries) == 9 and all(query.isActive for query in queries)
        write_slices(messages, source, [20, 10**9])
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    expected = sales_per_day(df)
    found = targets.tables.read(spark, "sales_per_day")
    assert rows_of(found, *expected.columns) == rows_of(expected, *expected.columns)
    assert targets.tables.read(spark, "transactions").count() == 80
    assert alert_rows(spark.read.parquet(f"{out}/alerts")) == alert_rows(fraud_alerts(df))


class ClusterSession:
    """Stands in for a session on a cluster; the setting is fixed when a real one starts."""

    def __init__(self, **settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": "yarn"})


def test_scratch_folder(spark):
    assert scratch_folder(spark, "x") != scratch_folder(spark, "x")
    shared = ClusterSession(**{"spark.checkpoint.dir": "hdfs://shared/"})
    assert scratch_folder(shared, "x").startswith("hdfs://shared/x-")
    with pytest.raises(ValueError):
        scratch_folder(ClusterSession(), "x")


def test_parts_of_events_have_small_files(spark, tmp_path, monkeypatch):
    """A file is one task of the stream that reads it."""
    from tillstream.plans import queries

    monkeypatch.setattr(queries, "FILE_ROWS", 10)
    table = str(tmp_path / "sf")
    # One sorted file, as the events come.
    events = spark.range(300).selectExpr("id AS event_id", "id AS user_id", "timestamp'2025-01-01' AS ts",
                                         "1.0D AS value", "'{}' AS props")
    events.coalesce(1).write.parquet(f"{table}/events.parquet")
    spark.createDataFrame([(0, "X")], "n_nationkey int, n_name string").write.parquet(f"{table}/nation.parquet")
    found = []
    for parts in (queries._event_parts, queries._across_event_time):
        folder = str(tmp_path / parts.__name__)
        parts(spark, table, folder, lambda rows, at=folder: found.append(len(glob.glob(f"{at}/source/*.parquet"))))
    assert found == [10, 20, 30, 10, 20, 40]


def test_raw_keeps_the_text_of_rejects_only(spark, tmp_path, monkeypatch):
    messages = spark.createDataFrame([('{"a":1}', 0), ("[]", 1), (json.dumps({
        "transactionId": "t", "productCategory": "c", "customerId": "k", "transactionDate": "2025-01-01T00:00:00Z",
    }), 2)], "value string, seq long")
    messages.write.parquet(str(tmp_path / "in"))
    seen = []
    monkeypatch.setattr(pipeline, "accepted", lambda df: seen.append(df.collect()) or accepted(df))
    rows = pipeline.classify_messages(file_source(spark, str(tmp_path / "in"), messages.schema))
    targets = pipeline.folder_targets(str(tmp_path / "out"))
    pipeline.start_raw(rows, targets, str(tmp_path / "checkpoint"), ["seq"], AVAILABLE_NOW)
    [batch] = seen
    assert {row.seq: row.value for row in batch} == {0: '{"a":1}', 1: "[]", 2: None}
    assert spark.read.parquet(str(tmp_path / "out" / "rejects")).where("value IS NOT NULL").count() == 2


def test_readers_run_together(spark, tmp_path, monkeypatch):
    """With a trigger that ends by itself several readers of the parsed messages are at work at a time."""
    together = threading.Barrier(pipeline.TOGETHER, timeout=60)

    def first_four(name, many=False):
        def start(*args, **kwargs):
            if name in ("raw", "sales"):
                together.wait()
            return [name] if many else name

        return start

    monkeypatch.setattr(pipeline, "start_parse", lambda *args: "parse")
    for name in ("raw", "sales", "kpi", "recent"):
        monkeypatch.setattr(pipeline, f"start_{name}", first_four(name))
    monkeypatch.setattr(pipeline, "start_fraud_alerts", first_four("fraud", many=True))
    monkeypatch.setattr(progress.Observer, "wait_for", lambda self, queries: None)
    (tmp_path / "in").mkdir()
    messages = file_source(spark, str(tmp_path / "in"), "value string, seq long")
    targets = pipeline.folder_targets(str(tmp_path / "out"))
    queries = pipeline.start_pipeline(messages, targets, str(tmp_path / "work"), trigger=AVAILABLE_NOW)
    assert queries == ["parse", "raw", "sales", "sales", "sales", "kpi", "recent", "fraud"]


def test_running_parts_are_joined_in_place(spark, transactions):
    """One row per piece is broadcast, whatever its size on paper; a stream's batches are not planned again."""
    from tillstream.operators.sales import running_parts

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        rows = transactions([{"customer_id": f"c{i % 3}"} for i in range(20)])
        df = running_parts(rows, "customer_id", "seq", "total_amount", 4)
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
