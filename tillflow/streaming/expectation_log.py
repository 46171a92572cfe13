"""Violation counts of a running stream, a row per batch and expectation.

The counts are observed while the rows pass by, so they cost no job over the
data. Spark reports them with the progress of each batch; a listener writes
each report as the batch's folder of a table, which a repeated batch
overwrites.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tillflow.functions.clock import AsOf
from tillflow.operators import contracts as c
from tillflow.operators.contracts import Contract
from tillflow.operators.customers import guarded_customers
from tillflow.streaming.sinks import append_batch, read_appended

OBSERVED = "expectations"
COUNTS = Contract(
    "expectation_counts",
    T.StructType(
        [
            T.StructField("query_id", T.StringType(), False),
            T.StructField("batch", T.LongType(), False),
            T.StructField("expectation", T.StringType(), False),
            T.StructField("n_judged", T.LongType(), False),
            T.StructField("n_violations", T.LongType(), False),
        ]
    ),
    True,
    "silver",
)


class ExpectationLog(StreamingQueryListener):
    """Writes what ``apply_expectations(observe_as=name)`` counts, for one stream.

    Batches without rows are reported by no counts and leave no rows. A report
    that can't be written is kept and raised by ``close``.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = OBSERVED):
        self.spark, self.path, self.name = spark, path, name
        self.failed: Exception | None = None
        self._run: str | None = None
        self._ended: set[str] = set()
        self._early: list = []
        self._changed = threading.Condition()

    def start(self, writer: DataStreamWriter) -> StreamingQuery:
        """Starts the stream of ``writer`` with this listener."""
        self.spark.streams.addListener(self)
        try:
            query = writer.start()
        except Exception:
            self.spark.streams.removeListener(self)
            raise
        with self._changed:
            # Which reports are this stream's is known only now.
            self._run = str(query.runId)
            early, self._early = self._early, []
        for progress in early:
            self._write(progress)
        return query

    def close(self, timeout: float = 60) -> None:
        """Waits until the ended stream's last report is written."""
        with self._changed:
            reported = self._changed.wait_for(lambda: self._run in self._ended, timeout)
        self.spark.streams.removeListener(self)
        if self.failed is not None:
            raise self.failed
        if not reported:
            raise TimeoutError("the stream's last report did not arrive")

    def _write(self, progress) -> None:
        observed = progress.observedMetrics.get(self.name)
        if observed is None or str(progress.runId) != self._run:
            return
        counts = observed.asDict()
        judged = counts.pop("n_rows")
        stream = str(progress.id)
        rows = [(stream, progress.batchId, name, judged, n) for name, n in counts.items()]
        try:
            table = self.spark.createDataFrame(rows, COUNTS.schema).coalesce(1)
            append_batch(table, self.path, progress.batchId, COUNTS, stream)
        except Exception as error:  # the listener's thread has nobody to raise it to
            self.failed = error

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._changed:
            if self._run is None:
                self._early.append(event.progress)
                return
        self._write(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()


def expectation_log(spark: SparkSession, path: str) -> DataFrame:
    return read_appended(spark, path, COUNTS.schema)


def run_guarded(
    spark: SparkSession, flagged: DataFrame, path: str, checkpoint: str, log: str, as_of: AsOf = None
) -> None:
    """Drains flagged profiles into the cleaned table, and their violations into the log."""
    kept = guarded_customers(flagged, as_of, observe_as=OBSERVED)
    checked = c.enforce_contract(kept, c.CUSTOMERS_CLEANED)
    counts = ExpectationLog(spark, log)
    writer = checked.writeStream.format("parquet").outputMode("append").option("path", path)
    query = counts.start(
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    )
    try:
        query.awaitTermination()
    finally:
        counts.close()
