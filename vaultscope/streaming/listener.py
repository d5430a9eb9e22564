"""Throughput and latency of running queries (MET-1, MET-2, MET-4).

A ``StreamingQueryListener`` records, per query name, the rows each
micro-batch emitted to its sink and the time since the query started; the
reference's two metrics follow: rows per second, and milliseconds per row.
Only one small record per micro-batch reaches the driver.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


EMITTED = "emitted"


def count_emitted(df: DataFrame) -> DataFrame:
    """Count the rows a streaming query emits, per micro-batch, for
    :class:`EmissionListener` (sink independent)."""
    return df.observe(EMITTED, F.count(F.lit(1)).alias("rows"))


class EmissionListener(StreamingQueryListener):
    """Keeps the last ``keep`` micro-batches of each query; ``n`` counts from its first one on."""

    def __init__(self, keep: int = 10_000) -> None:
        self._lock = threading.Lock()
        self._keep = keep
        self._sent: dict[str, int] = {}
        self._start: dict[str, dt.datetime] = {}
        self._ended: dict[str, threading.Event] = {}
        self._records: dict[str, deque] = {}

    @property
    def records(self) -> list[dict]:
        return [r for kept in self._records.values() for r in kept]

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._start[str(event.id)] = dt.datetime.fromisoformat(event.timestamp.replace("Z", "+00:00"))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        start = self._start.get(str(p.id))
        if start is None:
            return
        now = dt.datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        # rows counted by ``count_emitted`` work for every sink; the sink's own
        # count is -1 for sinks that do not report (e.g. files)
        observed = (p.observedMetrics or {}).get(EMITTED)
        sink_rows = observed["rows"] if observed is not None else (p.sink.numOutputRows if p.sink is not None else -1)
        name = p.name or str(p.id)
        with self._lock:
            self._sent[name] = self._sent.get(name, 0) + max(sink_rows, 0)
            self._records.setdefault(name, deque(maxlen=self._keep)).append(
                {
                    "query": name,
                    "batch_id": p.batchId,
                    "input_rows": p.numInputRows,
                    "output_rows": max(sink_rows, 0),
                    "n": self._sent[name],
                    "elapsed_ms": (now - start).total_seconds() * 1000.0
                    + sum(v for k, v in (p.durationMs or {}).items() if k == "triggerExecution"),
                }
            )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end_of(str(event.id)).set()

    def _end_of(self, query_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(query_id, threading.Event())

    def wait(self, query) -> None:
        """Until the end of a stopped query was seen; events are delivered in order,
        so every micro-batch of it was seen before."""
        self._end_of(str(query.id)).wait()

    def metrics(self, spark: SparkSession) -> DataFrame:
        """query, batch_id, input_rows, output_rows, n (cumulative), elapsed_ms,
        rows_per_s, ms_per_row."""
        with self._lock:
            rows = self.records
        schema = "query string, batch_id long, input_rows long, output_rows long, n long, elapsed_ms double"
        df = spark.createDataFrame(rows, schema) if rows else spark.createDataFrame([], schema)
        n = F.col("n")
        return df.select(
            "query", "batch_id", "input_rows", "output_rows", "n", "elapsed_ms",
            F.try_divide(n, F.col("elapsed_ms") / 1000.0).alias("rows_per_s"),
            F.try_divide(F.col("elapsed_ms"), n).alias("ms_per_row"),
        )


def observe_sent(df: DataFrame, name: str = "sent") -> DataFrame:
    """MET-4: a running count of records passing this point, read from
    ``StreamingQueryProgress.observedMetrics`` (or ``Observation`` in batch)."""
    return df.observe(name, F.count(F.lit(1)).alias("records"))
