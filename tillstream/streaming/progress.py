"""What queries have done, from their progress events: stored counts, and the deletion of what all readers have taken.

Progress events come after a micro-batch is committed, in order, on a thread of the driver; they do not slow the
queries.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tillstream.sinks.files import Files

WAIT_SECONDS = 60


class Observer(StreamingQueryListener):
    """Calls ``seen`` with each committed micro-batch that has observed metrics."""

    def __init__(self):
        self._ended: set[str] = set()

    def seen(self, query: str, batch_id: int, progress, metrics: dict[str, dict]) -> None:
        raise NotImplementedError

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        metrics = {name: row.asDict() for name, row in event.progress.observedMetrics.items()}
        if metrics and event.progress.numInputRows:
            self.seen(str(event.progress.id), event.progress.batchId, event.progress, metrics)

    def onQueryTerminated(self, event) -> None:
        self._ended.add(str(event.runId))

    def wait_for(self, queries: list[StreamingQuery]) -> None:
        """Until the events of ended queries have been taken in."""
        runs, until = {str(query.runId) for query in queries}, time.monotonic() + WAIT_SECONDS
        while not runs <= self._ended:
            if time.monotonic() > until:
                raise TimeoutError("progress events did not arrive")
            time.sleep(0.05)


class ProgressStore(Observer):
    """Keeps the observed metrics ``name`` of each micro-batch as a small file; a repeated batch replaces its own."""

    def __init__(self, spark: SparkSession, folder: str, name: str):
        super().__init__()
        self.spark, self.folder, self.name = spark, folder, name

    def seen(self, query: str, batch_id: int, progress, metrics: dict[str, dict]) -> None:
        if self.name in metrics:
            facts = {"query": query, "batch_id": batch_id, "at": progress.timestamp, **metrics[self.name]}
            path = f"{self.folder}/{query}-{batch_id}.json"
            Files(self.spark, self.folder).create(path, json.dumps(facts, default=str), overwrite=True)


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """A row per micro-batch; inputs of a query that was started again go on counting its batches."""
    return spark.read.json(folder)


class Retention(Observer):
    """Deletes the parts of a folder that all of its readers have taken in.

    ``readers`` are the names under which the readers observe ``upto``, the greatest part they have seen. Parts are
    sub-folders ``column=value`` whose values ascend in the order they were written, and readers take them in that
    order. What a reader has reached is kept in a file, so an interrupted driver goes on where it was.
    """

    def __init__(self, spark: SparkSession, folder: str, column: str, readers: list[str], state: str):
        super().__init__()
        self.spark, self.folder, self.column, self.readers, self.state = spark, folder, column, readers, state
        files = Files(spark, state)
        self.reached = json.loads(files.read(state)) if files.exists(state) else {}

    def seen(self, query: str, batch_id: int, progress, metrics: dict[str, dict]) -> None:
        new = {name: metrics[name]["upto"] for name in self.readers if name in metrics and metrics[name]["upto"]}
        if not new:
            return
        before = self._done()
        for name, upto in new.items():
            self.reached[name] = max(upto, self.reached.get(name, upto))
        files = Files(self.spark, self.folder)
        files.create(self.state, json.dumps(self.reached), overwrite=True)
        if self._done() != before:
            for part in files.names(self.folder):
                if part.startswith(f"{self.column}=") and part.split("=")[1] <= self._done():
                    files.delete(f"{self.folder}/{part}")

    def _done(self) -> str:
        """The last part that every reader has taken in."""
        return min((self.reached.get(name, "") for name in self.readers), default="")
