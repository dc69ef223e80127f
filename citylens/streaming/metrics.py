"""Progress, lag and counters of running streaming queries."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Sequence
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def _offset_total(o) -> int | None:
    """Sum of per-partition offsets of a Kafka offset JSON, or a file
    source's ``logOffset``."""
    if o is None:
        return None
    if isinstance(o, str):
        try:
            o = json.loads(o)
        except ValueError:
            return None
    if isinstance(o, dict):
        if "logOffset" in o:
            return int(o["logOffset"])
        total = 0
        for parts in o.values():
            if isinstance(parts, dict):
                total += sum(int(v) for v in parts.values())
        return total
    return None


def lag_report(spark: SparkSession, queries: Sequence[StreamingQuery]) -> DataFrame:
    """One row per (query, source): rows in the last batch, rates, and the
    lag = latest available offset - processed end offset."""
    rows = []
    for q in queries:
        p = q.lastProgress
        if not p:
            continue
        for s in p.get("sources", []):
            end, latest = _offset_total(s.get("endOffset")), _offset_total(s.get("latestOffset"))
            rows.append((q.name or str(q.id), s.get("description"), p.get("batchId"),
                         int(s.get("numInputRows") or 0),
                         float(s.get("inputRowsPerSecond") or 0.0),
                         float(s.get("processedRowsPerSecond") or 0.0),
                         end, latest, (latest - end) if end is not None and latest is not None else None))
    schema = ("query string, source string, batch_id long, input_rows long, input_rows_per_sec double, "
              "processed_rows_per_sec double, end_offset long, latest_offset long, lag long")
    return spark.createDataFrame(rows, schema)


class ProgressRecorder(StreamingQueryListener):
    """Keeps the last ``keep`` progress events (and the observed metrics inside
    them) of the session's queries, and the number of rows of all;
    ``spark.streams.addListener(rec)``."""

    def __init__(self, keep: int = 1000) -> None:
        self.events: deque[dict] = deque(maxlen=keep)
        self.rows = 0
        self._by_run: dict[str | None, int] = {}
        self._ended: dict[str, Event] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = json.loads(event.progress.json)
        self.events.append(p)
        n = int(p.get("numInputRows") or 0)
        self.rows += n
        run = p.get("runId")
        self._by_run[run] = self._by_run.get(run, 0) + n

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._ended.setdefault(str(event.runId), Event()).set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until all progress of a query that has ended is here (it arrives
        behind the query, in order)."""
        if not self._ended.setdefault(str(query.runId), Event()).wait(seconds):
            raise TimeoutError(f"no end of query run {query.runId} after {seconds} s")

    def observed(self, name: str, run: str | None = None) -> list[dict]:
        """Values of one ``df.observe(name, ...)`` metric set, per kept batch
        (of one run of a query)."""
        out = []
        for e in self.events:
            if run is not None and e.get("runId") != run:
                continue
            m = (e.get("observedMetrics") or {}).get(name)
            if m is not None:
                out.append(m)
        return out

    def rows_processed(self, run: str | None = None) -> int:
        return self.rows if run is None else self._by_run.get(run, 0)
