"""Decode metrics of streaming queries: sums over all micro-batches, and skip warnings."""

from __future__ import annotations

import datetime as dt
import logging
import threading
import weakref
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from ..operators.decode import DECODE_METRICS

log = logging.getLogger("logweave.decode")
_registered: "weakref.WeakSet" = weakref.WeakSet()


def observed(progress, name: str = DECODE_METRICS) -> dict | None:
    """The observed metrics row ``name`` of one progress update, as a dict."""
    metrics = getattr(progress, "observedMetrics", None) or {}
    row = metrics.get(name)
    return None if row is None else row.asDict()


class _Quiet(StreamingQueryListener):
    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


class RunTotals(_Quiet):
    """Sums of one observed metric over every micro-batch of each run.

    A query's own list of recent progress forgets all but the newest updates;
    a listener sees each of them."""

    def __init__(self, name: str = DECODE_METRICS):
        self.name = name
        self._sums: dict[str, dict[str, int]] = {}
        self._batches: dict[str, int] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryProgress(self, event):
        got = observed(event.progress, self.name)
        if got is None:
            return
        run = str(event.progress.runId)
        with self._change:
            sums = self._sums.setdefault(run, dict.fromkeys(got, 0))
            for k, v in got.items():
                sums[k] += v
            self._batches[run] = self._batches.get(run, 0) + 1

    def onQueryTerminated(self, event):
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def of(self, run_id: str, timeout: float = 60) -> tuple[dict[str, int], int]:
        """(sums, micro-batches) of a run that has ended; waits for its last event."""
        with self._change:
            if not self._change.wait_for(lambda: str(run_id) in self._ended, timeout):
                raise TimeoutError(f"no end of run {run_id} seen")
            self._ended.discard(str(run_id))
            return self._sums.pop(str(run_id), {}), self._batches.pop(str(run_id), 0)


class EventTimes(_Quiet):
    """How event time went on in each run: the greatest event time of every micro-batch,
    the watermark that held in it, and the rows that its stateful operators dropped as too
    late (after partial aggregation, so a row here may stand for several records)."""

    def __init__(self):
        self._rows: dict[str, dict[int, tuple]] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()

    def onQueryProgress(self, event):
        p = event.progress
        seen = p.eventTime or {}
        if "watermark" not in seen:
            return
        dropped = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        with self._change:
            self._rows.setdefault(str(p.runId), {})[p.batchId] = (
                p.batchId, p.numInputRows, _instant(seen.get("max")), _instant(seen["watermark"]), dropped)

    def onQueryTerminated(self, event):
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    def of(self, run_id: str, timeout: float = 60) -> list[tuple]:
        """(batch id, input rows, greatest event time, watermark, dropped rows) of a run that has ended."""
        with self._change:
            if not self._change.wait_for(lambda: str(run_id) in self._ended, timeout):
                raise TimeoutError(f"no end of run {run_id} seen")
            self._ended.discard(str(run_id))
            return [row for _, row in sorted(self._rows.pop(str(run_id), {}).items())]


def _instant(text: str | None) -> dt.datetime | None:
    """An instant of a progress update; None for the start of the epoch, where a watermark begins."""
    at = None if text is None else dt.datetime.fromisoformat(text)
    return None if at is None or at.timestamp() == 0 else at


EVENT_TIMES_SCHEMA = "batch_id long, input_rows long, max_event_time timestamp, watermark timestamp, dropped_rows long"


class SkipReporter(_Quiet):
    """Warns for every micro-batch that dropped undecodable records; ignores
    queries without the decode metrics.  Keeps two counts."""

    def __init__(self, name: str = DECODE_METRICS):
        self.name = name
        self.batches = 0
        self.skipped = 0

    def onQueryProgress(self, event):
        p = event.progress
        m = observed(p, self.name)
        if m is not None and m["skipped"] > 0:
            self.batches += 1
            self.skipped += m["skipped"]
            log.warning("Query %s batch %s: skipped %s of %s log records that are not framed Avro",
                        p.name, p.batchId, m["skipped"], m["received"])


def _once(spark: SparkSession, kind: type, make: Callable[[], _Quiet]) -> tuple[_Quiet, bool]:
    """The session's listener of a kind, registered at the first call."""
    for r in list(_registered):
        if type(r) is kind and getattr(r, "_session", None) is spark:
            return r, False
    rep = make()
    rep._session = spark
    spark.streams.addListener(rep)
    _registered.add(rep)
    return rep, True


def report_skips(spark: SparkSession) -> SkipReporter | None:
    """Register one SkipReporter per session (later calls return None)."""
    rep, new = _once(spark, SkipReporter, SkipReporter)
    return rep if new else None


def run_totals(spark: SparkSession) -> RunTotals:
    """The session's RunTotals listener."""
    return _once(spark, RunTotals, RunTotals)[0]


def event_times(spark: SparkSession) -> EventTimes:
    """The session's EventTimes listener."""
    return _once(spark, EventTimes, EventTimes)[0]
