"""Reports from a streaming query's progress."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from docweave.streaming.job import COUNTERS

_HISTORY = (
    "run_id string, batch_id bigint, at string, rows bigint, checkpoint_ms bigint, batch_ms bigint,"
    " sources array<struct<source string, rows bigint, metrics map<string,string>>>, counters map<string,bigint>"
)


class ProgressHistory(StreamingQueryListener):
    """Keeps the progress of every batch in a table, where a query itself holds the last hundred only.

    Add it to ``spark.streams``. Rows go out ``every`` batches and when a query ends, as one file each time; up to
    so many batches are lost if the driver is. A batch that is run again has a row for each run.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 50):
        self._spark, self._path, self._every = spark, path, every
        self._rows: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        spent = p.durationMs
        observed = p.observedMetrics.get(COUNTERS)
        self._rows.append(
            (
                str(p.runId), p.batchId, p.timestamp, sum(s.numInputRows for s in p.sources),
                sum(spent.get(k, 0) for k in ("walCommit", "commitOffsets")), spent.get("triggerExecution", 0),
                [(s.description, s.numInputRows, dict(s.metrics or {})) for s in p.sources],
                {} if observed is None else {k: v or 0 for k, v in observed.asDict().items()},
            )
        )
        if len(self._rows) >= self._every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        rows, self._rows = self._rows, []
        if rows:
            self._spark.createDataFrame(rows, _HISTORY).coalesce(1).write.mode("append").parquet(self._path)

    def history(self) -> DataFrame:
        """One row per batch: its checkpoint and run time, lag by source, and the stage counters."""
        return self._spark.read.schema(_HISTORY).parquet(self._path)


def checkpoint_report(query: StreamingQuery) -> list[dict[str, Any]]:
    """Per batch: time to commit its log entries and offsets, and to run it, in ms."""
    return [
        {
            "batch_id": p["batchId"],
            "checkpoint_ms": sum(p["durationMs"].get(k, 0) for k in ("walCommit", "commitOffsets")),
            "batch_ms": p["durationMs"].get("triggerExecution", 0),
        }
        for p in query.recentProgress
    ]


def lag_report(query: StreamingQuery) -> list[dict[str, Any]]:
    """Per source of the last batch: offsets behind the latest, as the source reports them."""
    last = query.lastProgress
    if last is None:
        return []
    return [
        {"source": s["description"], "rows": s["numInputRows"], **(s["metrics"] or {})}
        for s in last["sources"]
    ]


def counter_report(query: StreamingQuery) -> dict[str, int]:
    """Stage counters summed over the batches still held in the progress."""
    totals: dict[str, int] = {}
    for progress in query.recentProgress:
        row = progress["observedMetrics"].get(COUNTERS)
        if row is not None:
            for name, value in row.asDict().items():
                totals[name] = totals.get(name, 0) + (value or 0)
    return totals
