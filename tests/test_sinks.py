from __future__ import annotations

import glob
import json
import uuid

import pytest

from tillstream.schema import FIELDS, TABLES
from tillstream.sinks import tables
from tillstream.sinks.documents import (
    message_options,
    send_bulk,
    to_bulk_lines,
    to_documents,
    to_messages,
    write_bulk,
)
from tillstream.sinks.tables import FolderTables, JdbcTables, create_table_sql, merge_sql
from tillstream.sources.messages import kafka_options


def test_documents(transactions):
    [row] = to_documents(transactions([{"customer_country": None, "total_amount": 1.23456789e7}])).collect()
    assert row.doc_id == "t0"
    body = json.loads(row.body)
    assert list(body) == [f.wire for f in FIELDS]
    assert body["transactionDate"] == 1735689600000 and body["customerCountry"] is None
    assert '"totalAmount":1.23456789E7,' in row.body


def test_bulk_files(transactions, tmp_path):
    documents = to_documents(transactions([{}, {}]))
    for _ in range(2):
        write_bulk(documents, str(tmp_path / "bulk"))
    lines = [line for f in sorted(glob.glob(str(tmp_path / "bulk" / "part-*"))) for line in open(f)]
    assert len(lines) == 4
    assert json.loads(lines[0]) == {"index": {"_index": "transactions", "_id": "t0"}}
    assert json.loads(lines[1])["transactionId"] == "t0"


def test_send_bulk(transactions, tmp_path):
    folder = str(tmp_path)

    def send(body):
        with open(f"{folder}/{uuid.uuid4()}", "w") as request:
            request.write(body)

    documents = to_documents(transactions([{}] * 25)).coalesce(1)
    send_bulk(documents, send, actions=10)
    sizes = sorted(len(open(f).readlines()) for f in glob.glob(f"{folder}/*"))
    assert sizes == [10, 20, 20]
    assert to_bulk_lines(documents).count() == 25


def test_messages(transactions):
    rows = [{"transaction_id": "a"}, {"transaction_id": None}]
    [row] = to_messages(transactions(rows)).collect()
    assert row.key == "a"
    assert json.loads(row.value)["transactionDate"] == "2025-01-01T00:00:00.000Z"


def test_kafka_group():
    assert kafka_options("host:1", group="mine")["kafka.group.id"] == "mine"


def test_kafka_options():
    assert kafka_options("host:1", max_offsets=10) == {
        "kafka.bootstrap.servers": "host:1", "subscribe": "financial_transactions",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "10",
    }
    assert message_options("host:1") == {
        "kafka.bootstrap.servers": "host:1", "topic": "financial_transactions",
    }


def totals(spark, *rows):
    return spark.createDataFrame(rows, "year int, month int, total_sales double")


def test_folder_tables(spark, tmp_path):
    target = FolderTables(str(tmp_path))
    target.upsert(totals(spark, (2025, 1, 1.0), (2025, 2, 2.0)), "sales_per_month", 0)
    for _ in range(2):  # a batch that is repeated
        target.upsert(totals(spark, (2025, 2, 5.0), (2025, 3, 3.0)), "sales_per_month", 1)
    found = target.read(spark, "sales_per_month").collect()
    assert sorted(tuple(r) for r in found) == [(2025, 1, 1.0), (2025, 2, 5.0), (2025, 3, 3.0)]


def test_compaction_keeps_the_newest_rows(spark, tmp_path):
    target = FolderTables(str(tmp_path))
    for batch in range(4):
        target.upsert(totals(spark, (2025, 1, float(batch)), (2025, 2 + batch, 1.0)), "sales_per_month", batch)
    before = sorted(tuple(r) for r in target.read(spark, "sales_per_month").collect())
    for _ in range(2):
        target.compact(spark, "sales_per_month")
        assert sorted(tuple(r) for r in target.read(spark, "sales_per_month").collect()) == before
    # The newest batch stays by itself: it may be repeated.
    now = target.snapshot(spark, "sales_per_month")
    assert now.merged == 2 and list(now.batches) == [3]
    target.upsert(totals(spark, (2025, 1, 9.0)), "sales_per_month", 4)
    assert (2025, 1, 9.0) in {tuple(r) for r in target.read(spark, "sales_per_month").collect()}
    assert target.read_before(spark, "sales_per_month", 4).count() == len(before)
    assert target.read_before(spark, "sales_per_day", 4) is None


def test_batches_count_as_numbers(spark, tmp_path):
    target = FolderTables(str(tmp_path))
    for batch in (2, 10):
        target.upsert(totals(spark, (2025, 1, float(batch))), "sales_per_month", batch)
    assert target.read(spark, "sales_per_month").first().total_sales == 10.0


def test_create_table():
    assert create_table_sql("sales_per_month") == (
        "CREATE TABLE IF NOT EXISTS sales_per_month "
        "(year INTEGER, month INTEGER, total_sales DOUBLE PRECISION, PRIMARY KEY (year, month))"
    )
    assert "customer_country" not in create_table_sql("transactions")


def test_merge_statements():
    assert merge_sql("sales_per_day", "s") == (
        "INSERT INTO sales_per_day (transaction_date, total_sales) "
        "SELECT transaction_date, total_sales FROM s "
        "ON CONFLICT (transaction_date) DO UPDATE SET total_sales = EXCLUDED.total_sales"
    )
    assert merge_sql("sales_per_day", "s", "ansi") == (
        "MERGE INTO sales_per_day t USING s s ON t.transaction_date = s.transaction_date "
        "WHEN MATCHED THEN UPDATE SET total_sales = s.total_sales "
        "WHEN NOT MATCHED THEN INSERT (transaction_date, total_sales) "
        "VALUES (s.transaction_date, s.total_sales)"
    )
    with pytest.raises(ValueError):
        merge_sql("sales_per_day", "s", "other")


def test_jdbc_tables(spark, monkeypatch):
    monkeypatch.setattr(tables, "FLUSH_SECONDS", 0)
    statements, staged, failures = [], [], [True, True]

    def execute(session, sql):
        if sql.startswith("INSERT") and failures:
            failures.pop()
            raise OSError("connection lost")
        statements.append(sql)

    target = JdbcTables(
        "jdbc:none", {"user": "u"}, execute=execute,
        stage=lambda df, name: staged.append((name, df.collect())),
    )
    target.ensure_tables(spark)
    assert statements == [create_table_sql(name) for name in TABLES]
    rows = spark.createDataFrame(
        [(2025, 1, 1.0, 1), (2025, 1, 2.0, 2)],
        "year int, month int, total_sales double, seq int",
    )
    target.upsert(rows, "sales_per_month", 0, ["seq"])
    assert [(name, [tuple(r) for r in found]) for name, found in staged] == [
        ("sales_per_month_staging_0", [(2025, 1, 2.0)])
    ]
    assert statements[-2:] == [
        merge_sql("sales_per_month", "sales_per_month_staging_0"), "DROP TABLE IF EXISTS sales_per_month_staging_0"
    ]
    assert target.write_options() == {"user": "u", "batchsize": "1000", "truncate": "true"}


def test_jdbc_gives_up(spark, monkeypatch):
    monkeypatch.setattr(tables, "FLUSH_SECONDS", 0)
    calls = []

    def execute(session, sql):
        calls.append(sql)
        raise OSError("connection lost")

    target = JdbcTables("jdbc:none", {}, execute=execute, stage=lambda df, name: None)
    with pytest.raises(OSError):
        target.upsert(totals(spark, (2025, 1, 1.0)), "sales_per_month", 0)
    assert len(calls) == tables.MAX_RETRIES + 1


# Folder tables: repeated batches, interrupted calls, several writers


def month_rows(df):
    return sorted(tuple(r) for r in df.collect())


def three_batches(spark, target):
    """Batches 0 and 1 of the months 1 and 2, and 2 and 3."""
    target.upsert(totals(spark, (2025, 1, 1.0), (2025, 2, 2.0)), "sales_per_month", 0)
    target.upsert(totals(spark, (2025, 2, 5.0), (2025, 3, 3.0)), "sales_per_month", 1)


THREE = [(2025, 1, 1.0), (2025, 2, 5.0), (2025, 3, 3.0)]


def test_a_batch_is_repeated_after_a_compaction(spark, tmp_path):
    target = FolderTables(str(tmp_path))
    three_batches(spark, target)
    target.compact(spark, "sales_per_month")
    target.upsert(totals(spark, (2025, 2, 5.0), (2025, 3, 3.0)), "sales_per_month", 1)
    assert month_rows(target.read(spark, "sales_per_month")) == THREE
    assert month_rows(target.read_before(spark, "sales_per_month", 1)) == [(2025, 1, 1.0), (2025, 2, 2.0)]
    target.upsert(totals(spark, (2025, 4, 4.0)), "sales_per_month", 2)
    target.compact(spark, "sales_per_month")
    # A batch that was merged long ago changes nothing.
    target.upsert(totals(spark, (2025, 1, 1.0), (2025, 2, 2.0)), "sales_per_month", 0)
    assert month_rows(target.read(spark, "sales_per_month")) == [*THREE, (2025, 4, 4.0)]
    with pytest.raises(ValueError):
        target.read_before(spark, "sales_per_month", 1)


@pytest.mark.parametrize("step", ["rows", "manifest", "half a manifest", "delete"])
def test_a_compaction_is_interrupted(spark, tmp_path, monkeypatch, step):
    """Broken off at any point, with a new batch before the next call: no row is lost."""
    target = FolderTables(str(tmp_path), grace=0)
    three_batches(spark, target)
    target.upsert(totals(spark, (2025, 3, 7.0)), "sales_per_month", 2)

    class Stopped(Exception):
        pass

    create, delete = tables.Files.create, tables.Files.delete

    def stop(self, path, text="", overwrite=False):
        if step == "half a manifest":
            create(self, path, text[: len(text) // 2])
        raise Stopped

    with monkeypatch.context() as patched:
        if step == "rows":
            patched.setattr(FolderTables, "_commit", stop)
        elif step == "delete":
            patched.setattr(tables.Files, "delete", lambda self, path: stop(self, path))
        else:
            patched.setattr(tables.Files, "create", stop)
        if step != "delete":
            with pytest.raises(Stopped):
                target.compact(spark, "sales_per_month")
        else:
            target.compact(spark, "sales_per_month")
            with pytest.raises(Stopped):
                target.upsert(totals(spark, (2025, 9, 9.0)), "sales_per_month", 3)
    assert month_rows(target.read(spark, "sales_per_month")) == [*THREE[:2], (2025, 3, 7.0)]
    target.upsert(totals(spark, (2025, 4, 4.0)), "sales_per_month", 3)
    target.compact(spark, "sales_per_month")
    target.upsert(totals(spark, (2025, 4, 4.0)), "sales_per_month", 3)
    assert month_rows(target.read(spark, "sales_per_month")) == [*THREE[:2], (2025, 3, 7.0), (2025, 4, 4.0)]
    assert delete is tables.Files.delete


def test_a_write_is_interrupted(spark, tmp_path, monkeypatch):
    """Rows without a manifest belong to no version; the repeated batch replaces them."""
    target = FolderTables(str(tmp_path))
    target.upsert(totals(spark, (2025, 1, 1.0)), "sales_per_month", 0)
    with monkeypatch.context() as patched:
        patched.setattr(FolderTables, "_commit", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            target.upsert(totals(spark, (2025, 2, 2.0)), "sales_per_month", 1)
    assert month_rows(target.read(spark, "sales_per_month")) == [(2025, 1, 1.0)]


def test_a_write_during_a_compaction(spark, tmp_path, monkeypatch):
    """Whoever commits second builds upon the first: a new batch, the same compaction, a repeated batch."""
    target = FolderTables(str(tmp_path))
    three_batches(spark, target)
    commit, calls = FolderTables._commit, []

    def meanwhile(self, session, table, change):
        if not calls:
            calls.append(1)
            self.compact(session, table)
            self.upsert(totals(session, (2025, 2, 5.0), (2025, 3, 3.0)), table, 1)
            self.upsert(totals(session, (2025, 4, 4.0)), table, 2)
        commit(self, session, table, change)

    monkeypatch.setattr(FolderTables, "_commit", meanwhile)
    target.compact(spark, "sales_per_month")
    assert month_rows(target.read(spark, "sales_per_month")) == [*THREE, (2025, 4, 4.0)]
    now = target.snapshot(spark, "sales_per_month")
    assert now.merged == 0 and sorted(now.batches) == [1, 2]


def test_two_writers_take_different_versions(spark, tmp_path, monkeypatch):
    target = FolderTables(str(tmp_path))
    three_batches(spark, target)
    create, calls = tables.Files.create, []

    def late(self, path, text, overwrite=False):
        if not calls:
            calls.append(1)
            create(self, path, tables.Snapshot(version=3).text())  # another writer's
        return create(self, path, text, overwrite)

    monkeypatch.setattr(tables.Files, "create", late)
    target.upsert(totals(spark, (2025, 4, 4.0)), "sales_per_month", 2)
    assert target.snapshot(spark, "sales_per_month").version == 4


def test_an_open_reader_keeps_its_folders(spark, tmp_path):
    now = [1000.0]
    target = FolderTables(str(tmp_path), grace=60, clock=lambda: now[0])
    three_batches(spark, target)
    reader = target.read(spark, "sales_per_month")
    target.compact(spark, "sales_per_month")
    now[0] += 59
    target.upsert(totals(spark, (2025, 4, 4.0)), "sales_per_month", 2)
    assert month_rows(reader) == THREE
    now[0] += 2
    target.upsert(totals(spark, (2025, 5, 5.0)), "sales_per_month", 3)
    held = {p.name for p in (tmp_path / "sales_per_month").iterdir()} - {"_manifests"}
    assert held == set(target.snapshot(spark, "sales_per_month").folders())


def test_merging_along_the_way_bounds_the_folders(spark, tmp_path):
    target = FolderTables(str(tmp_path), compact_every=3, grace=0)
    for batch in range(30):
        for _ in range(1 + batch % 2):  # every second batch is repeated
            target.upsert(totals(spark, (2025, batch % 4, float(batch)), (batch, 1, 1.0)), "sales_per_month", batch)
        assert target.read_before(spark, "sales_per_month", batch + 1).count() == target.read(
            spark, "sales_per_month"
        ).count()
        assert len(target.snapshot(spark, "sales_per_month").folders()) <= 5
        assert len(list((tmp_path / "sales_per_month").iterdir())) <= 12
    assert len(list((tmp_path / "sales_per_month" / "_manifests").iterdir())) <= 2 * (tables.KEPT_VERSIONS + 1)
    found = {r[:2]: r[2] for r in month_rows(target.read(spark, "sales_per_month"))}
    assert [found[2025, k] for k in range(4)] == [28.0, 29.0, 26.0, 27.0] and len(found) == 34


# Chunks: by size, by time, sent again


def test_chunks_by_size_and_time():
    now, sent, slept, failures = [0.0], [], [], []

    def send(chunk):
        if failures:
            raise failures.pop()
        sent.append(list(chunk))

    def rows(*steps):
        for number, step in enumerate(steps):
            now[0] += step
            yield number

    def write(*steps):
        sent.clear()
        tables.chunk_writer(send, rows=3, seconds=0.2, clock=lambda: now[0], sleep=slept.append)(rows(*steps))
        return [len(chunk) for chunk in sent]

    assert write() == [] and write(0) == [1]
    assert write(0, 0, 0, 0, 0, 0, 0) == [3, 3, 1]
    # The chunk goes out with the row that finds its first one 0.2 s old.
    assert write(0, 0.1, 0.1, 0, 0.1, 0.05) == [3, 3] and write(5, 0.25, 0.1, 0.1) == [2, 2]
    failures += [OSError("lost"), OSError("lost")]
    assert write(0, 0, 0, 0) == [3, 1] and slept == [0.2, 0.4]
    failures += [OSError("lost")] * 6
    with pytest.raises(OSError):
        write(0, 0, 0, 0)
    assert sent == []


def test_connection_tables(spark, tmp_path):
    """Rows arrive once per key and in chunks, although the first connection of each partition breaks."""
    folder = str(tmp_path)

    def connect():
        import json
        import os

        class Connection:
            def cursor(self):
                self.rows = []
                return self

            def execute(self, sql):
                with open(f"{folder}/created", "a") as out:
                    out.write(sql + "\n")

            def executemany(self, sql, rows):
                self.rows = [(sql, *row) for row in rows]

            def commit(self):
                if self.rows and not os.path.exists(f"{folder}/broken-{os.getpid()}"):
                    open(f"{folder}/broken-{os.getpid()}", "w").close()
                    raise OSError("connection lost")
                for k, row in enumerate(self.rows):
                    with open(f"{folder}/row-{row[1]}-{row[2]}.json", "w") as out:
                        json.dump([len(self.rows), *row], out)

            def close(self):
                pass

        return Connection()

    target = tables.ConnectionTables(connect, "?", rows=4, sleep=lambda s: None)
    target.ensure_tables(spark)
    assert len(open(f"{folder}/created").readlines()) == 4
    rows = [(2000 + i // 12, i % 12 + 1, float(s), s) for i in range(40) for s in range(2)]
    df = spark.createDataFrame(rows, "year int, month int, total_sales double, seq int").repartition(3)
    for _ in range(2):
        target.upsert(df, "sales_per_month", 0, ["seq"])
    found = [json.load(open(f)) for f in glob.glob(f"{folder}/row-*.json")]
    assert len(found) == 40 and max(row[0] for row in found) <= 4
    assert {row[1] for row in found} == {tables.upsert_sql("sales_per_month", "?")}
    assert {row[4] for row in found} == {1.0}
    assert glob.glob(f"{folder}/broken-*")


def test_bulk_results_per_document(transactions, tmp_path):
    """Only what failed is sent again; what is refused is kept with its status."""
    from tillstream.sinks.documents import file_transport

    documents = to_documents(transactions([{"product_quantity": i % 5} for i in range(50)])).coalesce(2)
    sent, rejects = str(tmp_path / "sent"), str(tmp_path / "rejects")
    send_bulk(documents, file_transport(sent, '"productQuantity":3,', 3), actions=4, rejects=rejects, wait=0)
    lines = [line for f in glob.glob(f"{sent}/*.txt") for line in open(f)]
    ids = [json.loads(line)["index"]["_id"] for line in lines[::2]]
    assert len(ids) == len(set(ids)) == 40
    spark = documents.sparkSession
    refused = spark.read.parquet(rejects).collect()
    assert {r.doc_id for r in refused} == {f"t{i}" for i in range(50) if i % 5 == 3}
    assert {r.status for r in refused} == {400} and all(r.value.startswith('{"index"') for r in refused)
    with pytest.raises(Exception, match="refused"):
        send_bulk(documents, file_transport(sent, '"productQuantity":3,'), actions=4, wait=0)


def test_bulk_gives_up(transactions):
    def send(body):
        return [503] * (len(body.splitlines()) // 2)

    with pytest.raises(Exception, match="were not taken"):
        send_bulk(to_documents(transactions([{}])), send, retries=2, wait=0)


def test_bulk_goes_on_while_documents_wait(transactions, tmp_path):
    """What was not taken comes again later, at the head of a body; other documents need not wait for it."""
    folder = str(tmp_path)

    def send(body):
        number = len(glob.glob(f"{folder}/*"))
        ids = [json.loads(line)["index"]["_id"] for line in body.splitlines()[::2]]
        with open(f"{folder}/{number}", "w") as request:
            json.dump(ids, request)
        return [503 if number == 0 else 200] * len(ids)

    send_bulk(to_documents(transactions([{}] * 35)).coalesce(1), send, actions=10, wait=1)
    requests = [json.load(open(f"{folder}/{k}")) for k in range(len(glob.glob(f"{folder}/*")))]
    assert [len(ids) for ids in requests] == [10, 10, 10, 5, 10]
    assert requests[4] == requests[0]
    assert sorted(sum(requests[1:], [])) == sorted(f"t{i}" for i in range(35))


def test_rows_of_single_folders_stay_in_place(spark, tmp_path):
    """Batches with one row per key are not grouped again: older ones lose the keys of newer ones, null keys too."""
    target = FolderTables(str(tmp_path))
    schema = "year int, month int, total_sales double, seq int"

    def store(batch_id, rows, **options):
        target.upsert(spark.createDataFrame(rows, schema), "sales_per_month", batch_id, **options)

    def stored():
        return sorted(map(tuple, target.read(spark, "sales_per_month").collect()), key=repr)

    def plan(now):
        return target._latest(spark, "sales_per_month", now)._jdf.queryExecution().executedPlan().toString()

    store(0, [(2000, None, 1.0, 1), (2000, None, 2.0, 2), (2000, 1, 3.0, 1)], seq=["seq"])
    only = plan(target.snapshot(spark, "sales_per_month"))
    assert "Window" not in only and "Exchange" not in only
    store(1, [(2000, None, 4.0, 1), (2001, 1, 5.0, 1), (2001, 1, 6.0, 2)], seq=["seq"])
    want = sorted([(2000, None, 4.0), (2000, 1, 3.0), (2001, 1, 6.0)], key=repr)
    assert stored() == want and "Window" not in plan(target.snapshot(spark, "sales_per_month"))
    target.compact(spark, "sales_per_month")
    assert stored() == want and "Window" not in plan(target.snapshot(spark, "sales_per_month"))
    # Rows that were stored as they came may repeat a key.
    target.upsert(spark.createDataFrame([(2000, 1, 7.0)] * 2, "year int, month int, total_sales double"),
                  "sales_per_month", 2)
    assert stored() == sorted([(2000, None, 4.0), (2000, 1, 7.0), (2001, 1, 6.0)], key=repr)
    text = json.dumps({"version": 1, "schema": "", "base": None, "merged": -1, "batches": {}, "old": []})
    assert tables.Snapshot.of(text).single == ()
