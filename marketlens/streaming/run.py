"""Start and await streaming queries."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_console(rows: DataFrame, checkpoint: str | None = None) -> StreamingQuery:
    """Print each batch in full, as soon as it is there."""
    writer = rows.writeStream.outputMode("append").format("console").option("truncate", False)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.start()


def write_parquet(
    rows: DataFrame, path: str, checkpoint: str, available_only: bool = False
) -> StreamingQuery:
    """Append to a Parquet dataset. The checkpoint lets a restart go on where it stopped."""
    writer = rows.writeStream.outputMode("append").format("parquet").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_only else writer).start()


def run_available(rows: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process all that is there now into a Parquet dataset, and read it back."""
    write_parquet(rows, path, checkpoint, available_only=True).awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def await_all(queries: Sequence[StreamingQuery], timeout: float | None = None) -> bool:
    """Wait until one of these queries ends or the time is over, then stop the others of them.

    True if one ended, False if the time was over. A failed query raises its error.
    """
    until = None if timeout is None else time.monotonic() + timeout
    ended = False
    while not ended and (until is None or time.monotonic() < until):
        for query in queries:
            left = 0.5 if until is None else max(0.0, min(0.5, until - time.monotonic()))
            ended = ended or bool(query.awaitTermination(left))
    for query in queries:
        query.stop()
    return ended


@dataclass
class Progress:
    """Rows read per query and batch, and the errors of the queries that failed."""

    rows: dict[tuple[str, int], int] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)

    def note(self, name: str, query: StreamingQuery) -> None:
        for batch in query.recentProgress:
            if batch["numInputRows"]:
                self.rows[name, batch["batchId"]] = batch["numInputRows"]


def stop_gently(query: StreamingQuery, drain: bool = False, timeout: float = 60) -> None:
    """Stop between two batches, so that none is cut off; with ``drain``, once all input is read.

    A query that has ended, or whose batch takes longer than ``timeout`` seconds, is stopped as is.
    """
    until = time.monotonic() + timeout
    try:
        if drain and query.isActive:
            query.processAllAvailable()
        while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
            time.sleep(0.05)
    except StreamingQueryException:
        pass
    query.stop()


def run_together(
    queries: dict[str, StreamingQuery],
    drain: bool = True,
    stop_on_error: bool = True,
    timeout: float | None = None,
    poll: float = 0.2,
) -> Progress:
    """Follow several queries until all have ended, one has failed, or the time is over.

    Then the others stop gently. Progress is read from the queries themselves, more often than
    they forget it. The error of a failed query is noted and does not hide what the others did.
    """
    progress = Progress()
    until = None if timeout is None else time.monotonic() + timeout
    while any(q.isActive for q in queries.values()):
        for name, query in queries.items():
            progress.note(name, query)
        if stop_on_error and any(q.exception() for q in queries.values()):
            break
        if until is not None and time.monotonic() > until:
            break
        time.sleep(poll)
    for name, query in queries.items():
        stop_gently(query, drain)
        progress.note(name, query)
        if error := query.exception():
            progress.errors[name] = str(error)
    return progress
