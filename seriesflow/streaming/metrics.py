"""Quality metrics of streaming flows: what :meth:`Expectations.observe` counts, as a table."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

METRICS_SCHEMA = (
    "flow string, query_id string, batch_id bigint, rule string, failed bigint, passed bigint, recorded_at string"
)

_PREFIX = "quality_"


def metric_name(flow: str) -> str:
    return _PREFIX + flow


class QualityRecorder(StreamingQueryListener):
    """Collects the counts of every micro-batch: a few numbers for each batch and rule, never rows.

    Call :meth:`flush` after a drain, :meth:`keep_flushing` beside continuous flows.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._rows: list[tuple] = []
        self._ended: dict[str, threading.Event] = {}

    def _event(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._event(str(event.runId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._event(str(event.runId)).set()

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = []
        for name, row in (progress.observedMetrics or {}).items():
            if not name.startswith(_PREFIX):
                continue
            counts = row.asDict()
            total = counts.pop("rows")
            for column, failed in counts.items():
                rule = column.removeprefix("failed_")
                found.append(
                    (
                        name.removeprefix(_PREFIX),
                        str(progress.id),
                        progress.batchId,
                        rule,
                        failed,
                        total - failed,
                        progress.timestamp,
                    )
                )
        with self._lock:
            self._rows.extend(found)

    def wait(self, *queries: StreamingQuery, timeout: float = 60) -> None:
        """Block until the events of ended queries have arrived; the listener bus is asynchronous.

        Counts that do not arrive in time are an error, not a smaller table.
        """
        for query in queries:
            if not self._event(str(query.runId)).wait(timeout):
                raise TimeoutError(f"no end of query {query.runId} within {timeout} s: its counts may be incomplete")

    def keep_flushing(self, spark: SparkSession, path: str, seconds: float = 60) -> Callable[[], None]:
        """Flush beside continuous flows; returns a function that stops it and flushes what is left."""
        done = threading.Event()

        def work() -> None:
            while not done.wait(seconds):
                self.flush(spark, path)

        thread = threading.Thread(target=work, name="quality-metrics", daemon=True)
        thread.start()

        def stop() -> None:
            done.set()
            thread.join()
            self.flush(spark, path)

        return stop

    def flush(self, spark: SparkSession, path: str) -> None:
        """Append what was collected to the metrics table."""
        with self._lock:
            rows, self._rows = self._rows, []
        if not rows:
            return
        try:
            spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        except Exception:
            # Nothing is lost: the next flush takes them along, and a batch that is there twice counts once.
            with self._lock:
                self._rows = rows + self._rows
            raise


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(flow, rule, failed, passed) over all batches. A batch reported twice, after a restart, counts once."""
    found = spark.read.schema(METRICS_SCHEMA).parquet(path)
    counts = F.max_by(F.struct("failed", "passed"), "recorded_at").alias("c")
    once = found.groupBy("flow", "query_id", "batch_id", "rule").agg(counts)
    return once.groupBy("flow", "rule").agg(
        F.sum("c.failed").alias("failed"), F.sum("c.passed").alias("passed")
    )
