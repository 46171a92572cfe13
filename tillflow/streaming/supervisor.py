"""Several streams as one job: restarts of those that fail, a stop between batches."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

Start = Callable[[], StreamingQuery]
_LOOK_SECONDS = 0.2


class _BetweenBatches(StreamingQueryListener):
    """Notes for each stream when it last finished a batch or had none to do."""

    def __init__(self):
        self.at: dict[str, int] = {}

    def _note(self, run: str) -> None:
        self.at[run] = self.at.get(run, 0) + 1

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._note(str(event.progress.runId))

    def onQueryIdle(self, event) -> None:
        self._note(str(event.runId))

    def onQueryTerminated(self, event) -> None:
        pass


class Supervisor:
    """Runs streams side by side until they end, fail too often, or are told to stop.

    ``starts`` names functions that start a stream from its checkpoint, in the
    order in which they are to be started. A failed stream is started again
    while the others run on, ``retries`` times at most without a finished
    batch in between; its checkpoint and sinks that know their batches make
    the repeated batch the same batch. After that all are stopped and the
    error is raised. ``stop`` lets each stream finish the batch that it is in.
    """

    def __init__(
        self, spark: SparkSession, starts: Mapping[str, Start], retries: int = 3, pause: float = 1.0
    ):
        self.spark, self.starts = spark, dict(starts)
        self.retries, self.pause = retries, pause
        self.queries: dict[str, StreamingQuery] = {}
        self.restarts = {name: 0 for name in self.starts}
        self._told = threading.Event()
        self._between = _BetweenBatches()

    def stop(self) -> None:
        self._told.set()

    def _failures_since_progress(self, name: str, before: int) -> int:
        run = str(self.queries[name].runId)
        return 1 if self._between.at.get(run) else before + 1

    def run(self, grace: float = 600) -> None:
        """Until all have ended. ``grace`` bounds the wait for a batch once told to stop."""
        self.spark.streams.addListener(self._between)
        failures = {name: 0 for name in self.starts}
        try:
            for name, start in self.starts.items():
                self.queries[name] = start()
            while any(q.isActive for q in self.queries.values()):
                if self._told.wait(_LOOK_SECONDS):
                    self._stop_between_batches(grace)
                    break
                self._restart_failed(failures)
            self._restart_failed(failures, last=True)
        finally:
            for query in self.queries.values():
                query.stop()
            self.spark.streams.removeListener(self._between)

    def _restart_failed(self, failures: dict[str, int], last: bool = False) -> None:
        for name, query in list(self.queries.items()):
            error = None if query.isActive else query.exception()
            if error is None:
                continue
            failures[name] = self._failures_since_progress(name, failures[name])
            if failures[name] > self.retries or last:
                raise error
            time.sleep(self.pause)
            self.restarts[name] += 1
            self.queries[name] = self.starts[name]()

    def _stop_between_batches(self, grace: float) -> None:
        """Stops each stream as soon as it reports a batch, or at once if it waits for data."""
        waiting = {n: q for n, q in self.queries.items() if q.isActive}
        seen = {n: self._between.at.get(str(q.runId), 0) for n, q in waiting.items()}
        ends = time.monotonic() + grace
        while waiting and time.monotonic() < ends:
            for name, query in list(waiting.items()):
                idle = not query.status["isTriggerActive"]
                if idle or self._between.at.get(str(query.runId), 0) > seen[name]:
                    query.stop()
                if not query.isActive:
                    del waiting[name]
            time.sleep(_LOOK_SECONDS / 4)
