"""Counters of a stream that Spark pushes after every trigger."""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from winnower.config import Sampling
from winnower.storage import file_names
from winnower.streaming.clean import KEPT_NAME, PROGRESS_NAME


def next_batch(spark: SparkSession, checkpoint_dir: str) -> int:
    """Number of the trigger that a stream with this checkpoint runs next."""
    done = [int(name) for name in file_names(spark, f"{checkpoint_dir}/commits") if name.isdigit()]
    return max(done, default=-1) + 1


@dataclass
class RunCounts:
    """What one run of a stream has counted so far."""

    next_batch: int | None = None
    counts: dict[str, int] = field(default_factory=dict)
    triggers: int = 0
    elapsed_ms: int = 0
    rows_per_sec: float | None = None
    missed: list[tuple[int, int]] = field(default_factory=list)
    ended: threading.Event = field(default_factory=threading.Event)


class PushedProgress(StreamingQueryListener):
    """Adds the counters of every trigger as Spark reports it, for all streams of a session.

    A log that polls sees the latest triggers only. Spark calls a listener for each
    trigger, in order, so none can go by between two looks; a number that is left
    out all the same is noted and makes ``report`` raise.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._runs: dict[str, RunCounts] = {}

    def _run(self, run_id: object) -> RunCounts:
        with self._lock:
            return self._runs.setdefault(str(run_id), RunCounts())

    def expect(self, query: StreamingQuery, first_batch: int) -> None:
        """The run begins at this trigger; see ``next_batch``, before the stream is started."""
        run = self._run(query.runId)
        with self._lock:
            seen = run.next_batch
            if seen is None:
                run.next_batch = first_batch
            elif seen - run.triggers > first_batch:
                run.missed.append((first_batch, seen - run.triggers - 1))

    def onQueryStarted(self, event) -> None:  # noqa: N802  named by Spark
        self._run(event.runId)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        run = self._run(progress.runId)
        observed = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        with self._lock:
            if run.next_batch is not None and progress.batchId < run.next_batch:
                return  # a report of waiting carries the number of the trigger before
            if run.next_batch is not None and progress.batchId > run.next_batch:
                run.missed.append((run.next_batch, progress.batchId - 1))
            run.next_batch = progress.batchId + 1
            run.triggers += 1
            run.elapsed_ms += progress.batchDuration
            run.rows_per_sec = progress.processedRowsPerSecond
            for name in (PROGRESS_NAME, KEPT_NAME):
                for counter, value in observed.get(name, {}).items():
                    run.counts[counter] = run.counts.get(counter, 0) + value

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._run(event.runId).ended.set()

    def report(self, query: StreamingQuery, sampling: Sampling, wait_sec: float = 60) -> dict:
        """The counters of a run, after its end if it ends in time."""
        run = self._run(query.runId)
        if not query.isActive:
            run.ended.wait(wait_sec)
        with self._lock:
            if run.missed:
                spans = ", ".join(f"{first} to {last}" for first, last in run.missed)
                raise RuntimeError(f"triggers {spans} were not reported")
            counts = dict(run.counts)
            if counts:
                counts["dropped_dedup"] = counts["selected_rows"] - counts["kept_rows"]
            pace = run.rows_per_sec
            return counts | {
                "p": round(sampling.probability, 6),
                "elapsed_min": round(run.elapsed_ms / 60_000, 2),
                "rows_per_sec": None if pace is None else round(pace, 2),
            }
