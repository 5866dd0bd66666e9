"""Transactions as JSON documents under an id, and as keyed messages."""

from __future__ import annotations

import os
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillstream.schema import DOCUMENT_INDEX, FIELDS, TOPIC
from tillstream.streaming.run import Trigger, run

BULK_ACTIONS = 1000
MAX_RETRIES = 5
RETRY_SECONDS = 0.2
# Bodies of documents that a task holds back for a later attempt.
WAITING = 32
_KEEP_NULLS = {"ignoreNullFields": "false"}


def to_documents(df: DataFrame) -> DataFrame:
    """(doc_id, body): all 13 properties, nulls kept, the date as epoch milliseconds."""
    properties = [
        (F.unix_millis(f.column) if f.type == "timestamp" else F.col(f.column)).alias(f.wire)
        for f in FIELDS
    ]
    body = F.to_json(F.struct(*properties), _KEEP_NULLS)
    return df.select(F.col("transaction_id").alias("doc_id"), body.alias("body"))


def bulk_line(index: str) -> Column:
    """The action line and the document line of an index request, newline between."""
    action = F.to_json(
        F.struct(F.struct(F.lit(index).alias("_index"), F.col("doc_id").alias("_id")).alias("index"))
    )
    return F.concat_ws("\n", action, F.col("body"))


def to_bulk_lines(documents: DataFrame, index: str = DOCUMENT_INDEX) -> DataFrame:
    """(value): the two lines of each index request."""
    return documents.select(bulk_line(index).alias("value"))


def write_bulk(documents: DataFrame, path: str, index: str = DOCUMENT_INDEX) -> None:
    """Write newline-delimited bulk requests; writing the same folder again replaces it."""
    to_bulk_lines(documents, index).write.mode("overwrite").text(path)


def send_bulk(
    documents: DataFrame,
    send: Callable[[str], list[int] | None],
    index: str = DOCUMENT_INDEX,
    actions: int = BULK_ACTIONS,
    rejects: str | None = None,
    retries: int = MAX_RETRIES,
    wait: float = RETRY_SECONDS,
) -> None:
    """Call ``send`` on the executors with one bulk body per ``actions`` documents.

    ``send`` returns a status per document, in order, or None if all were taken. Documents with status 429 or from 500
    on are sent again, without the others, and so is the whole body if ``send`` fails; what is left after
    ``retries`` makes the task fail. While they wait for ``wait`` seconds (twice as long with each attempt) other
    documents go out; then they lead the next body, and new ones fill it up. A task stops to wait when ``WAITING`` bodies
    are held back or nothing else is left. Documents with another status from 400 on are refused for good: they are stored in
    ``rejects`` as (doc_id, status, value), and are an error without it. A retried task sends its documents again; they
    overwrite themselves by id.
    """

    def deliver(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(*(column.to_pylist() for column in b.columns), strict=True) for b in batches)
        # What was not taken, by the number of attempts so far: (when to send it again, document).
        late = [deque() for _ in range(retries + 1)]
        while True:
            body = []
            for attempt in range(retries, 0, -1):
                while late[attempt] and len(body) < actions and late[attempt][0][0] <= time.monotonic():
                    body.append((attempt, late[attempt].popleft()[1]))
            if sum(map(len, late)) < WAITING * actions:
                body += ((0, row) for row in islice(rows, actions - len(body)))
            if not body:
                due = [waiting[0][0] for waiting in late if waiting]
                if not due:
                    return
                time.sleep(max(min(due) - time.monotonic(), 0))
                continue
            try:
                statuses = send("".join(f"{value}\n" for _, (_, value) in body)) or [200] * len(body)
            except Exception:
                if any(attempt == retries for attempt, _ in body):
                    raise
                statuses = [503] * len(body)
            refused, given_up = [], 0
            for (attempt, row), status in zip(body, statuses, strict=True):
                if status == 429 or status >= 500:
                    if attempt == retries:
                        given_up += 1
                    else:
                        late[attempt + 1].append((time.monotonic() + wait * 2**attempt, row))
                elif status >= 400:
                    refused.append((row[0], status, row[1]))
            if given_up:
                raise RuntimeError(f"{given_up} documents were not taken")
            if refused:
                if rejects is None:
                    raise RuntimeError(f"{len(refused)} documents were refused, the first with {refused[0][1]}")
                ids, codes, values = zip(*refused, strict=True)
                columns = [pa.array(ids, pa.string()), pa.array(codes, pa.int32()), pa.array(values, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "status", "value"])

    lines = documents.select("doc_id", bulk_line(index).alias("value"))
    results = lines.mapInArrow(deliver, "doc_id string, status int, value string").write.mode("overwrite")
    if rejects is None:
        results.format("noop").save()
    else:
        results.parquet(rejects)


def file_transport(folder: str, refuse: str | None = None, fail_every: int = 0) -> Callable[[str], list[int]]:
    """A stand-in for a document index: a text file per request, in a folder that the executors can open.

    Documents that contain ``refuse`` are refused (400); of every ``fail_every``-th request the later half is not taken
    (503) and has to come again.
    """
    path = folder.removeprefix("file://") if folder.startswith("file://") else folder.removeprefix("file:")
    requests = []

    def send(body: str) -> list[int]:
        requests.append(1)
        lines = body.splitlines(keepends=True)
        items = list(zip(lines[::2], lines[1::2], strict=True))
        late = fail_every and len(requests) % fail_every == 0
        statuses = [
            400 if refuse and refuse in document else 503 if late and k >= len(items) // 2 else 200
            for k, (_, document) in enumerate(items)
        ]
        os.makedirs(path, exist_ok=True)
        name = uuid.uuid4().hex
        with open(f"{path}/.{name}", "w", encoding="utf-8") as out:
            out.writelines(line for item, status in zip(items, statuses, strict=True) if status == 200 for line in item)
        os.replace(f"{path}/.{name}", f"{path}/{name}.txt")
        return statuses

    return send


def to_messages(df: DataFrame, *extra: str) -> DataFrame:
    """(key, value): the transaction as published, keyed by its id, the date as ISO text.

    ``extra`` columns are passed on.
    """
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    properties = [
        (F.date_format(f.column, iso) if f.type == "timestamp" else F.col(f.column)).alias(f.wire)
        for f in FIELDS
    ]
    value = F.to_json(F.struct(*properties), _KEEP_NULLS)
    return df.where(F.col("transaction_id").isNotNull()).select(
        F.col("transaction_id").alias("key"), value.alias("value"), *extra
    )


def message_options(servers: str, topic: str = TOPIC) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def start_publish(
    messages: DataFrame, servers: str, checkpoint: str, topic: str = TOPIC, trigger: Trigger = "5 seconds"
) -> StreamingQuery:
    """Keep publishing a stream of messages; a message may be sent again after a failure, under its key."""
    writer = messages.writeStream.format("kafka").options(**message_options(servers, topic))
    return run(writer, checkpoint, trigger)


def publish(messages: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Write a batch of messages to the topic; needs Spark's Kafka package."""
    messages.write.format("kafka").options(**message_options(servers, topic)).save()
