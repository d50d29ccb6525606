"""What streaming runs do, told by Spark's own events: start, batches, end and its reason."""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

ENDED = "ended"
_ROWS = "run string, batch_id bigint, batch_messages bigint, total_messages bigint, reason string"


@dataclass
class Run:
    """A run of a query: (batch, its messages, messages so far) rows, and why it ended."""

    run_id: str
    batches: list[tuple[int, int, int]] = field(default_factory=list)
    reason: str | None = None
    over: threading.Event = field(default_factory=threading.Event)

    @property
    def total(self) -> int:
        return self.batches[-1][2] if self.batches else 0


class RunLog(StreamingQueryListener):
    """Keeps the runs of a session by run id; ``tell`` gets a line for every event.

    Batches without messages are left out, so the log of an idle run does not grow, and
    of a long run only the last ``kept`` batches stay.
    """

    def __init__(self, tell: Callable[[str], None] | None = None, kept: int = 10_000):
        self.runs: dict[str, Run] = {}
        self._tell = tell or (lambda _line: None)
        self._kept = kept

    def __enter__(self) -> RunLog:
        self._spark.streams.addListener(self)
        return self

    def __exit__(self, *_error) -> None:
        self._spark.streams.removeListener(self)

    def on(self, spark: SparkSession) -> RunLog:
        """For ``with RunLog().on(spark) as log``."""
        self._spark = spark
        return self

    def _run(self, run_id) -> Run:
        return self.runs.setdefault(str(run_id), Run(str(run_id)))

    def onQueryStarted(self, event) -> None:
        run = self._run(event.runId)
        self._tell(f"run {run.run_id} started")

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if not progress.numInputRows:
            return
        run = self._run(progress.runId)
        total = run.total + progress.numInputRows
        run.batches.append((progress.batchId, progress.numInputRows, total))
        del run.batches[: -self._kept]
        self._tell(f"batch {progress.batchId}: {progress.numInputRows} messages, {total} in all")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = self._run(event.runId)
        run.reason = ENDED
        if event.exception:
            kind = event.errorClassOnException or "error"
            run.reason = f"failed: {kind}: {event.exception.strip().splitlines()[0]}"
        self._tell(f"run {run.run_id} {run.reason} after {run.total} messages")
        run.over.set()

    def of(self, query: StreamingQuery, seconds: float = 60) -> Run:
        """The run of a query that is over, once its last event has come."""
        run = self._run(query.runId)
        if not run.over.wait(seconds):
            raise TimeoutError(f"run {run.run_id} has not ended")
        return run

    def frame(self, spark: SparkSession) -> DataFrame:
        """A row per batch of all runs."""
        rows = [(run.run_id, *batch, run.reason) for run in self.runs.values() for batch in run.batches]
        return spark.createDataFrame(rows, _ROWS)
