"""Keyed upserts into the result tables.

A target takes one micro-batch at a time and is safe to repeat: writing the same batch again
leaves the same table.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstream.operators.latest import latest_per_key
from tillstream.schema import TABLES, TableDef
from tillstream.sinks.files import Files

BATCH = "batch_id"
BATCH_ROWS = 1000
MAX_RETRIES = 5
FLUSH_SECONDS = 0.2
GRACE_SECONDS = 600.0
KEPT_VERSIONS = 20
# Up to so many folders the older ones are joined with the keys of the newer ones; more of them are grouped together.
JOINED_FOLDERS = 3


@dataclass(frozen=True)
class Snapshot:
    """What a table consists of: a merged folder, and a folder for each later batch.

    ``merged`` is the last batch whose rows are in ``base``. ``old`` are folders of earlier snapshots that a
    reader may still have open, with the time (in seconds) they were replaced. ``single`` are the folders with one row
    per key.
    """

    version: int = 0
    schema: str = ""
    base: str | None = None
    merged: int = -1
    batches: dict[int, str] = field(default_factory=dict)
    old: tuple[tuple[float, str], ...] = ()
    single: tuple[str, ...] = ()

    def folders(self) -> list[str]:
        """Later batches come later."""
        return [*([self.base] if self.base else []), *(self.batches[b] for b in sorted(self.batches))]

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of(text: str) -> Snapshot:
        found = json.loads(text)
        batches = {int(k): v for k, v in found.pop("batches").items()}
        old, single = tuple(map(tuple, found["old"])), tuple(found.get("single", ()))
        return Snapshot(**found | {"batches": batches, "old": old, "single": single})


class FolderTables:
    """Tables as Parquet folders that a small manifest names.

    A write puts its batch into a folder of its own and then a new version of the manifest next to the old one;
    that file appears at once, so a reader sees the whole batch or nothing of it, and what an interrupted
    write leaves behind belongs to no version. Reading keeps the newest batch's row per key.

    Merging never touches the newest batch: a batch that is repeated after a crash replaces its own folder,
    before and after a compaction, and what was stored before it can still be read. A batch that was merged long ago and
    comes again is left out, as the table holds its rows or later ones. With ``compact_every`` a write that finds
    so many batches merges them first. Folders that are no longer named are deleted ``grace`` seconds later.
    """

    def __init__(
        self,
        root: str,
        tables: dict[str, TableDef] | None = None,
        compact_every: int | None = None,
        grace: float = GRACE_SECONDS,
        clock: Callable[[], float] = time.time,
    ):
        self.root = root.rstrip("/")
        self.tables = TABLES if tables is None else tables
        self.compact_every = compact_every
        self.grace = grace
        self.clock = clock

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def ensure_tables(self, spark: SparkSession) -> None:
        """Folders appear with the first write."""

    def upsert(self, df: DataFrame, table: str, batch_id: int, seq: Sequence[str] = ()) -> None:
        """Store a batch; with ``seq`` only its last row per key."""
        spark = df.sparkSession
        # Batches before this one are complete, whatever happens to it.
        if self.compact_every and self._before(self.snapshot(spark, table), batch_id) >= self.compact_every:
            self._merge(spark, table, batch_id)
        rows = latest_per_key(df, self.tables[table].keys, seq).drop(*seq) if seq else df
        rows = rows.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        folder = f"{batch_id}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path(table)}/{folder}")
        schema = rows.schema.json()

        def stored(now: Snapshot) -> Snapshot:
            if batch_id <= now.merged:
                return replace(now, old=(*now.old, (self.clock(), folder)))
            gone = [(self.clock(), now.batches[batch_id])] if batch_id in now.batches else []
            single = (*now.single, folder) if seq else now.single
            batches = now.batches | {batch_id: folder}
            return replace(now, schema=schema, batches=batches, old=(*now.old, *gone), single=single)

        self._commit(spark, table, stored)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """The table; a ValueError if nothing was ever stored."""
        rows = self._latest(spark, table, self.snapshot(spark, table))
        if rows is None:
            raise ValueError(f"nothing is stored in {self.path(table)}")
        return rows.drop(BATCH)

    def read_before(self, spark: SparkSession, table: str, batch_id: int) -> DataFrame | None:
        """The table as it was before a batch; None if nothing was stored. For targets that build on it."""
        now = self.snapshot(spark, table)
        if batch_id <= now.merged:
            raise ValueError(f"batch {batch_id} of {self.path(table)} is merged with later ones")
        rows = self._latest(spark, table, replace(now, batches={b: f for b, f in now.batches.items() if b < batch_id}))
        return None if rows is None else rows.drop(BATCH)

    def read_batch(self, spark: SparkSession, table: str, batch_id: int) -> DataFrame:
        """What one batch stored; it must not be merged yet."""
        now = self.snapshot(spark, table)
        return self._rows(spark, table, Snapshot(schema=now.schema, batches={0: now.batches[batch_id]})).drop(BATCH)

    def compact(self, spark: SparkSession, table: str) -> None:
        """Merge all batches but the newest into one folder with the newest row per key.

        Queries may read and write the table meanwhile. The merged folder is named by a new version of the manifest
        when it is complete; a call that was interrupted has changed nothing. It rewrites the table, so its
        cost is that of the table, not of the batches.
        """
        batches = self.snapshot(spark, table).batches
        if batches:
            self._merge(spark, table, max(batches))

    @staticmethod
    def _before(now: Snapshot, batch_id: int) -> int:
        return sum(b < batch_id for b in now.batches)

    def _merge(self, spark: SparkSession, table: str, batch_id: int) -> None:
        """Merge the batches before ``batch_id``."""
        now = self.snapshot(spark, table)
        taken = {b: f for b, f in now.batches.items() if b < batch_id}
        if not taken:
            return
        rows = self._latest(spark, table, replace(now, batches=taken))
        folder = f"base-{uuid.uuid4().hex}"
        # Sorted by the first key, so that a reader of some of its values skips the rest.
        merged = rows.sortWithinPartitions(self.tables[table].keys[0])
        merged.write.parquet(f"{self.path(table)}/{folder}")

        def stored(then: Snapshot) -> Snapshot:
            if (then.base, then.merged) != (now.base, now.merged):
                # Another call was faster: its result stays.
                return replace(then, old=(*then.old, (self.clock(), folder)))
            # A batch that was written again meanwhile holds the same rows: the new folder goes, too.
            gone = [then.base] if then.base else []
            gone += [f for b, f in then.batches.items() if b in taken]
            left = {b: f for b, f in then.batches.items() if b not in taken}
            old = (*then.old, *((self.clock(), f) for f in gone))
            return replace(then, base=folder, merged=max(taken), batches=left, old=old, single=(*then.single, folder))

        self._commit(spark, table, stored)

    def _latest(self, spark: SparkSession, table: str, now: Snapshot) -> DataFrame | None:
        """The newest batch's row per key, with its number.

        A folder with one row per key only loses the keys of later folders: the newest folder stays where it is, and the
        later ones send their keys.
        """
        folders, keys = now.folders(), self.tables[table].keys
        if len(folders) > JOINED_FOLDERS or not set(folders) <= set(now.single):
            rows = self._rows(spark, table, now)
            return None if rows is None else latest_per_key(rows, keys, BATCH)
        parts = [self._rows(spark, table, replace(now, base=folder, batches={})) for folder in folders]
        later, found = None, []
        for part in reversed(parts):
            own = part.select(*(F.col(key).alias(f"_later_{key}") for key in keys))
            if later is not None:
                same = [F.col(key).eqNullSafe(F.col(f"_later_{key}")) for key in keys]
                # Keys take far more memory than their files say: they are no matter for a broadcast by size.
                part = part.join(later.hint("merge"), reduce(Column.__and__, same), "left_anti")
            found.append(part)
            later = own if later is None else later.unionAll(own)
        return reduce(DataFrame.unionAll, found) if found else None

    def _rows(self, spark: SparkSession, table: str, now: Snapshot) -> DataFrame | None:
        folders = [f"{self.path(table)}/{folder}" for folder in now.folders()]
        if not folders:
            return None
        return spark.read.schema(StructType.fromJson(json.loads(now.schema))).parquet(*folders)

    def snapshot(self, spark: SparkSession, table: str) -> Snapshot:
        """The newest version that is whole."""
        files = Files(spark, self.root)
        for version in sorted(self._versions(files, table), reverse=True):
            try:
                return Snapshot.of(files.read(self._manifest(table, version)))
            except ValueError:
                # Its writer was interrupted.
                continue
        return Snapshot()

    def _manifest(self, table: str, version: int) -> str:
        return f"{self.path(table)}/_manifests/{version}.json"

    def _versions(self, files: Files, table: str) -> list[int]:
        names = files.names(f"{self.path(table)}/_manifests")
        return [int(name.removesuffix(".json")) for name in names if name.endswith(".json")]

    def _commit(self, spark: SparkSession, table: str, change: Callable[[Snapshot], Snapshot]) -> None:
        """Add a version; whoever else writes the table meanwhile is not overwritten but built upon."""
        files = Files(spark, self.root)
        while True:
            now = self.snapshot(spark, table)
            versions = self._versions(files, table)
            version = max(versions, default=0) + 1
            # A stored version has given them up already, and this one forgets them.
            due = {folder for when, folder in now.old if when <= self.clock() - self.grace}
            for folder in due:
                files.delete(f"{self.path(table)}/{folder}")
            new = change(now)
            single = tuple(folder for folder in new.single if folder in new.folders())
            new = replace(new, version=version, old=tuple(x for x in new.old if x[1] not in due), single=single)
            if files.create(self._manifest(table, version), new.text()):
                break
        for old in versions:
            if old <= version - KEPT_VERSIONS:
                files.delete(self._manifest(table, old))


def create_table_sql(table: str) -> str:
    definition = TABLES[table]
    columns = ", ".join(f"{name} {sql_type}" for name, sql_type in definition.columns)
    keys = ", ".join(definition.keys)
    return f"CREATE TABLE IF NOT EXISTS {table} ({columns}, PRIMARY KEY ({keys}))"


def merge_sql(table: str, staging: str, dialect: str = "postgresql") -> str:
    """One statement that moves the staged rows into the table, replacing rows by key."""
    definition = TABLES[table]
    names = [name for name, _ in definition.columns]
    others = [name for name in names if name not in definition.keys]
    columns = ", ".join(names)
    if dialect == "postgresql":
        updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in others)
        return (
            f"INSERT INTO {table} ({columns}) SELECT {columns} FROM {staging} "
            f"ON CONFLICT ({', '.join(definition.keys)}) DO UPDATE SET {updates}"
        )
    if dialect == "ansi":
        same = " AND ".join(f"t.{k} = s.{k}" for k in definition.keys)
        updates = ", ".join(f"{c} = s.{c}" for c in others)
        values = ", ".join(f"s.{c}" for c in names)
        return (
            f"MERGE INTO {table} t USING {staging} s ON {same} "
            f"WHEN MATCHED THEN UPDATE SET {updates} "
            f"WHEN NOT MATCHED THEN INSERT ({columns}) VALUES ({values})"
        )
    raise ValueError(f"unknown dialect {dialect!r}")


def chunk_writer(
    send: Callable[[list], None],
    rows: int = BATCH_ROWS,
    seconds: float = FLUSH_SECONDS,
    retries: int = MAX_RETRIES,
    clock: Callable[[], float] = time.monotonic,
    sleep: Callable[[float], None] = time.sleep,
) -> Callable[[Iterable], None]:
    """A writer of one partition's rows, chunk by chunk.

    A chunk goes out when it has ``rows`` rows or its first row has waited for ``seconds``, whichever comes first;
    the time is looked at with each row. A failed chunk is sent again up to ``retries`` times, the others are not.
    """

    def flush(chunk: list) -> None:
        for attempt in range(retries + 1):
            try:
                return send(chunk)
            except Exception:
                if attempt == retries:
                    raise
                sleep(seconds * 2**attempt)

    def write(partition: Iterable) -> None:
        chunk, since = [], 0.0
        for row in partition:
            if not chunk:
                since = clock()
            chunk.append(row)
            if len(chunk) >= rows or clock() - since >= seconds:
                flush(chunk)
                chunk = []
        if chunk:
            flush(chunk)

    return write


def upsert_sql(table: str, placeholder: str = "%s") -> str:
    """One statement per row that inserts it or replaces the row of its key."""
    definition = TABLES[table]
    names = [name for name, _ in definition.columns]
    updates = ", ".join(f"{c} = EXCLUDED.{c}" for c in names if c not in definition.keys)
    return (
        f"INSERT INTO {table} ({', '.join(names)}) VALUES ({', '.join([placeholder] * len(names))}) "
        f"ON CONFLICT ({', '.join(definition.keys)}) DO UPDATE SET {updates}"
    )


class ConnectionTables:
    """Tables in a relational database, written by the executors through Python connections.

    ``connect`` opens a connection (with ``cursor``, ``commit`` and ``close``) and must be importable or a closure.
    Each partition has one; its rows go out in chunks of BATCH_ROWS or FLUSH_SECONDS, each a transaction of its own. A
    chunk that fails gets a new connection. A repeated batch writes the same rows again, and no two partitions hold the
    same key.
    """

    def __init__(self, connect: Callable[[], object], placeholder: str = "%s", **options):
        self.connect, self.placeholder, self.options = connect, placeholder, options

    def ensure_tables(self, spark: SparkSession) -> None:
        connection = self.connect()
        try:
            for table in TABLES:
                connection.cursor().execute(create_table_sql(table))
            connection.commit()
        finally:
            connection.close()

    def upsert(self, df: DataFrame, table: str, batch_id: int, seq: Sequence[str] = ()) -> None:
        definition = TABLES[table]
        rows = latest_per_key(df, definition.keys, seq) if seq else df
        connect, statement = self.connect, upsert_sql(table, self.placeholder)
        writer, options = chunk_writer, self.options

        def write(partition: Iterable) -> None:
            open_now = []

            def send(chunk: list) -> None:
                if not open_now:
                    open_now.append(connect())
                try:
                    open_now[0].cursor().executemany(statement, [tuple(row) for row in chunk])
                    open_now[0].commit()
                except Exception:
                    open_now.pop().close()
                    raise

            try:
                writer(send, **options)(partition)
            finally:
                for connection in open_now:
                    connection.close()

        rows.select(*[name for name, _ in definition.columns]).foreachPartition(write)


def file_connections(folder: str, fail_every: int = 0) -> Callable[[], object]:
    """A stand-in for a database: each commit adds a file with lines of (at, values), ``at`` in nanoseconds.

    The folder must be one that the executors can open. Of every ``fail_every`` commits of a task one breaks.
    """
    path = folder.removeprefix("file://") if folder.startswith("file://") else folder.removeprefix("file:")
    commits = []

    def connect() -> object:
        class Connection:
            rows = ()

            def cursor(self) -> object:
                return self

            def execute(self, sql: str) -> None:
                os.makedirs(path, exist_ok=True)

            def executemany(self, sql: str, rows: list[tuple]) -> None:
                self.rows = rows

            def commit(self) -> None:
                commits.append(1)
                if fail_every and len(commits) % fail_every == 0:
                    raise OSError("connection lost")
                if self.rows:
                    at, name = time.time_ns(), uuid.uuid4().hex
                    with open(f"{path}/.{name}", "w", encoding="utf-8") as out:
                        for row in self.rows:
                            values = [None if value is None else str(value) for value in row]
                            out.write(json.dumps({"at": at, "values": values}) + "\n")
                    os.replace(f"{path}/.{name}", f"{path}/{name}.json")

            def close(self) -> None:
                pass

        return Connection()

    return connect


class JdbcTables:
    """Tables in a relational database.

    The executors write a staging table of the batch in parallel; the driver then issues a single merge statement
    and drops it. ``staging`` names the query, so that two queries never share one. ``execute`` runs one statement and can be replaced, by default it goes through
    the JVM's driver manager.
    """

    def __init__(
        self,
        url: str,
        properties: dict[str, str],
        dialect: str = "postgresql",
        execute: Callable[[SparkSession, str], None] | None = None,
        stage: Callable[[DataFrame, str], None] | None = None,
        staging: str = "staging",
    ):
        self.url = url
        self.properties = properties
        self.dialect = dialect
        self.staging = staging
        self._execute = execute or self._execute_jdbc
        self._stage = stage or self._stage_jdbc

    def write_options(self) -> dict[str, str]:
        return {**self.properties, "batchsize": str(BATCH_ROWS), "truncate": "true"}

    def ensure_tables(self, spark: SparkSession) -> None:
        for table in TABLES:
            self._retry(lambda sql=create_table_sql(table): self._execute(spark, sql))

    def upsert(self, df: DataFrame, table: str, batch_id: int, seq: Sequence[str] = ()) -> None:
        definition = TABLES[table]
        # One row per key: a merge refuses to touch a row twice.
        rows = latest_per_key(df, definition.keys, seq) if seq else df
        staging = f"{table}_{self.staging}_{batch_id}"
        staged = rows.select(*[name for name, _ in definition.columns])
        self._retry(lambda: self._stage(staged, staging))
        merge = merge_sql(table, staging, self.dialect)
        self._retry(lambda: self._execute(df.sparkSession, merge))
        self._retry(lambda: self._execute(df.sparkSession, f"DROP TABLE IF EXISTS {staging}"))

    @staticmethod
    def _retry(action: Callable[[], None]) -> None:
        for attempt in range(MAX_RETRIES + 1):
            try:
                return action()
            except Exception:
                if attempt == MAX_RETRIES:
                    raise
                time.sleep(FLUSH_SECONDS * 2**attempt)

    def _stage_jdbc(self, rows: DataFrame, staging: str) -> None:
        rows.write.mode("overwrite").options(**self.write_options()).jdbc(self.url, staging)

    def _execute_jdbc(self, spark: SparkSession, sql: str) -> None:
        jvm = spark._jvm
        if "driver" in self.properties:
            jvm.java.lang.Class.forName(self.properties["driver"])
        settings = jvm.java.util.Properties()
        for name, value in self.properties.items():
            settings.setProperty(name, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, settings)
        try:
            statement = connection.createStatement()
            statement.execute(sql)
            statement.close()
        finally:
            connection.close()
