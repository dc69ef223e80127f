"""Stateful incident detectors for Structured Streaming.

Each detector keeps per-key state in Spark's state store through
``applyInPandasWithState`` with an event-time timeout, so state for a key is
dropped once the watermark makes it irrelevant.  Where keys are many (sensors,
junctions) a call takes all keys of one of ``BUCKETS`` groups by array
operations: calls follow the buckets, not the keys.  Rows of one micro-batch are processed in (event time,
id) order; across micro-batches, rows behind the watermark are dropped by
Spark.  The work per call is bounded by the rows of one key (or bucket) in one
micro-batch (``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``), never by
the key's history.

The batch detectors in ``operators.detect`` give the same answer on
in-order input and are the ones to use for backfills.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.geo import haversine_m_np
from ..functions.scalar import epoch_micros
from ..operators.detect import keyed
from ..operators.sequence import micros


def _with_keys(df: DataFrame, ts: str, id_col: str) -> DataFrame:
    return df.withColumn("__tus", epoch_micros(ts)).withColumn("__id", F.col(id_col).cast("long"))


def _sorted(pdfs: Iterator[pd.DataFrame]) -> pd.DataFrame:
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return pd.DataFrame()
    return pd.concat(frames, ignore_index=True).sort_values(["__tus", "__id"], kind="stable")


def _expire_at(state: GroupState, micros_ts: int) -> None:
    """Event-time timeout at ``micros_ts`` (never before the watermark, which
    is global and may already be past a quiet key's horizon)."""
    state.setTimeoutTimestamp(max(int(micros_ts) // 1000 + 1, state.getCurrentWatermarkMs() + 1))


def _out_schema(df: DataFrame, extra: Sequence[T.StructField] = ()) -> T.StructType:
    fields = [f for f in df.schema.fields if f.name not in ("__tus", "__id", "__bucket")]
    return T.StructType(fields + list(extra))


# --------------------------------------------------------------------- late cut
def mark_late_stream(df: DataFrame, topic: str | Sequence[str], ts: str, arrival: str, lateness="30 seconds") -> DataFrame:
    """Streaming twin of ``detect.mark_late``: adds ``watermark`` and ``is_late``.

    Spark's own watermark moves between micro-batches and drops late rows
    unseen; this rule moves it with every event and keeps both sides.  State per
    key (topic, or topic and partition -- what arrives in one order): the
    largest event time so far.  The rows of a key in a micro-batch are taken
    in the order of ``arrival`` (an offset); a late row cannot raise the maximum,
    an event exactly at the watermark is kept, one without a time is never late."""
    lat, keys = micros(lateness), [topic] if isinstance(topic, str) else list(topic)
    rows = df.withColumn("__tus", epoch_micros(ts)).withColumn("__id", F.col(arrival).cast("long"))
    schema = T.StructType([*rows.schema.fields, T.StructField("__wm", T.LongType()), T.StructField("is_late", T.BooleanType())])

    def fn(k, pdfs, state: GroupState):
        frames = [p for p in pdfs if len(p)]
        if not frames:
            return
        pdf = pd.concat(frames, ignore_index=True).sort_values("__id", kind="stable")
        none = np.iinfo(np.int64).min
        before = state.get[0] if state.exists else none
        missing = pdf["__tus"].isna().to_numpy()
        t = pdf["__tus"].fillna(0).to_numpy(dtype="int64")
        top = np.maximum.accumulate(np.concatenate([[before], np.where(missing, none, t)]))
        state.update((int(top[-1]),))
        seen = top[:-1] > none
        wm = top[:-1] - np.where(seen, lat, 0)
        pdf["__wm"] = pd.array(np.where(seen, wm, 0), dtype="Int64")
        pdf.loc[~seen, "__wm"] = pd.NA
        pdf["is_late"] = seen & ~missing & (t < wm)
        yield pdf

    marked = rows.groupBy(*keys).applyInPandasWithState(fn, schema, "top long", "append", GroupStateTimeout.NoTimeout)
    return marked.withColumn("watermark", F.timestamp_micros("__wm")).select(*df.columns, "watermark", "is_late")


#: groups the keys of a detector are dealt into: a call of Python takes all keys of one
BUCKETS = 256


def _dealt(df: DataFrame, key: str, ts: str, id_col: str, buckets: int) -> DataFrame:
    """Rows that have a key, with their time, id and the bucket of the key."""
    return _with_keys(keyed(df, [key]), ts, id_col).withColumn("__bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


# --------------------------------------------------------------------- cooldown
def _cooldown_fires(code: np.ndarray, t: np.ndarray, last: np.ndarray, known: np.ndarray, cool: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which rows, sorted by (key number, time), fire; and the keys' last alerts
    after them (``last`` where ``known``).  All keys jump from alert to alert
    together: the next one is the first breach at or after last + cooldown."""
    fire, last, known = np.zeros(len(t), bool), last.copy(), known.copy()
    times = np.unique(t)
    steps = len(times) + 1
    place = code * steps + np.searchsorted(times, t)
    after = np.maximum(np.searchsorted(place, code * steps + np.searchsorted(times, t + cool)), np.arange(1, len(t) + 1))
    keys = np.unique(code)
    ends = np.searchsorted(code, keys, side="right")
    at = np.where(known[keys], np.searchsorted(place, keys * steps + np.searchsorted(times, last[keys] + cool)), np.searchsorted(code, keys))
    while len(at):
        live = at < ends
        at, ends = at[live], ends[live]
        fire[at] = True
        last[code[at]], known[code[at]] = t[at], True
        at = after[at]
    return fire, last, known


def cooldown_alerts_stream(df: DataFrame, key: str, ts: str, condition, cooldown="120 seconds",
                           id_col: str = "event_id", buckets: int = BUCKETS) -> DataFrame:
    """Streaming twin of ``detect.cooldown_alerts``.  State per bucket of keys: the
    time of the last alert of each key, dropped once the watermark passes
    ``last + cooldown`` -- after that any breach fires anyway."""
    cool = micros(cooldown)
    breaches = _dealt(df.filter(F.coalesce(condition, F.lit(False))), key, ts, id_col, buckets)
    schema = _out_schema(breaches)
    cols = schema.fieldNames()

    def fn(k, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        pdf = _sorted(pdfs)
        if len(pdf) == 0:
            return
        held = state.get if state.exists else ([], [])
        code, names = pd.factorize(pd.Series([*held[0], *pdf[key]], dtype=object))
        m = len(held[0])
        last, known = np.zeros(len(names), np.int64), np.arange(len(names)) < m
        last[:m] = held[1]
        own = code[m:]
        order = np.argsort(own, kind="stable")
        pdf, own = pdf.iloc[order], own[order]
        fire, last, known = _cooldown_fires(own, pdf["__tus"].to_numpy(dtype="int64"), last, known, cool)
        kept = np.flatnonzero(known & (last + cool > state.getCurrentWatermarkMs() * 1000))
        state.update(([names[i] for i in kept], [int(x) for x in last[kept]]))
        _expire_at(state, int(last[known].max()) + cool)
        out = pdf.loc[fire, cols]
        if len(out):
            yield out

    kind = df.schema[key].dataType.simpleString()
    return breaches.groupBy("__bucket").applyInPandasWithState(
        fn, schema, f"keys array<{kind}>, last_alert array<long>", "append", GroupStateTimeout.EventTimeTimeout)


# --------------------------------------------------------------------- consecutive
def consecutive_breach_stream(df: DataFrame, key: str, ts: str, value: str, threshold: float,
                              n: int = 3, within="300 seconds", id_col: str = "event_id", buckets: int = BUCKETS) -> DataFrame:
    """Streaming twin of ``detect.consecutive_breach``.  State per bucket of keys:
    the last ``n-1`` readings (time, value) of each key; dropped once the
    watermark passes them by ``within``."""
    span = micros(within)
    rows = _dealt(df, key, ts, id_col, buckets)
    schema = _out_schema(rows, [T.StructField("avg_last_n", T.DoubleType()),
                                T.StructField("consecutive_readings", T.IntegerType())])
    cols = [f for f in rows.columns if not f.startswith("__")]

    def fn(k, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        pdf = _sorted(pdfs)
        if len(pdf) == 0:
            return
        held = state.get if state.exists else ([], [], [])
        m = len(held[0])
        code, names = pd.factorize(pd.Series([*held[0], *pdf[key]], dtype=object))
        t = np.concatenate([np.array(held[1], dtype="int64"), pdf["__tus"].to_numpy(dtype="int64")])
        v = np.concatenate([np.array(held[2], dtype="float64"), pdf[value].to_numpy(dtype="float64")])
        # merge kept readings and this batch by key and time (a row may arrive
        # a batch late, earlier than kept readings, within the watermark);
        # ties keep arrival order
        src = np.lexsort((np.arange(len(t)), t, code))
        code, t, v = code[src], t[src], v[src]
        fire = np.zeros(len(t), dtype=bool)
        avg = np.full(len(t), np.nan)
        if len(t) >= n:
            win = np.lib.stride_tricks.sliding_window_view(v, n)
            first = slice(0, len(t) - n + 1)
            fire[n - 1:] = (win > threshold).all(axis=1) & (code[first] == code[n - 1:]) & (t[first] >= t[n - 1:] - span)
            avg[n - 1:] = win.mean(axis=1)
        sel = fire & (src >= m)
        from_end = np.searchsorted(code, code, side="right") - np.arange(len(code))
        keep = np.flatnonzero((from_end < n) & (t >= state.getCurrentWatermarkMs() * 1000 - span))
        state.update(([names[i] for i in code[keep]], [int(x) for x in t[keep]], [float(x) for x in v[keep]]))
        _expire_at(state, int(t.max()) + span)
        if sel.any():
            out = pdf.iloc[src[sel] - m][cols].copy()
            out["avg_last_n"] = avg[sel]
            out["consecutive_readings"] = n
            yield out

    kind = df.schema[key].dataType.simpleString()
    return rows.groupBy("__bucket").applyInPandasWithState(
        fn, schema, f"keys array<{kind}>, ts array<long>, v array<double>", "append", GroupStateTimeout.EventTimeTimeout)


# --------------------------------------------------------------------- bunching (clock mode)
BUNCHING_OUT = T.StructType([
    T.StructField("route_id", T.StringType()), T.StructField("bus_1", T.StringType()),
    T.StructField("bus_2", T.StringType()), T.StructField("distance_m", T.DoubleType()),
    T.StructField("duration_sec", T.DoubleType()), T.StructField("event_time", T.TimestampType()),
    T.StructField("event_id", T.LongType()),
])


def _meetings(bus: np.ndarray, t: np.ndarray, lat: np.ndarray, lon: np.ndarray, first: int, gap: int,
              max_distance_m: float, block: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Events from ``first`` on against the latest event of every other bus:
    (event, other's event, distance) of those close in time and space.  Events
    are in order; a running maximum per bus over the event numbers gives each
    bus's latest event at any event."""
    n, buses = len(bus), int(bus.max()) + 1
    at, other, far = [], [], []
    last = np.full(buses, -1)
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        seen = np.full((hi - lo + 1, buses), -1)
        seen[0] = last
        seen[np.arange(1, hi - lo + 1), bus[lo:hi]] = np.arange(lo, hi)
        seen = np.maximum.accumulate(seen, axis=0)
        last = seen[-1]
        seen = seen[1:]
        seen[np.arange(hi - lo), bus[lo:hi]] = -1                  # not with itself
        i, b = np.nonzero(seen >= 0)
        j = seen[i, b]
        i = i + lo
        ok = (i >= first) & (t[i] - t[j] <= gap)
        i, j = i[ok], j[ok]
        d = haversine_m_np(lat[i], lon[i], lat[j], lon[j])
        at.append(i[d <= max_distance_m])
        other.append(j[d <= max_distance_m])
        far.append(d[d <= max_distance_m])
    return np.concatenate(at), np.concatenate(other), np.concatenate(far)


def _clock_alerts(times: np.ndarray, clock: int | None, duration: int) -> tuple[list[tuple[int, int]], int | None]:
    """A pair's meetings against its clock: [(meeting, clock it ran from)] and
    the clock left.  A meeting starts a clock that does not run; the first one
    at least ``duration`` later alerts and stops it, or, beyond twice the
    duration, starts it anew."""
    alerts, k = [], 0
    while k < len(times):
        if clock is None:
            clock, k = int(times[k]), k + 1
        k += int(np.searchsorted(times[k:], clock + duration, side="left"))
        if k >= len(times):
            break
        if times[k] - clock <= 2 * duration:
            alerts.append((k, clock))
            clock = None
        else:
            clock = int(times[k])
        k += 1
    return alerts, clock


def bunching_stream(df: DataFrame, route: str = "route_id", bus: str = "bus_id", ts: str = "timestamp",
                    lat: str = "lat", lon: str = "lon", id_col: str = "event_id",
                    max_distance_m: float = 200.0, max_gap="60 seconds",
                    duration="300 seconds") -> DataFrame:
    """Clock-mode bunching: each pair of buses of a route has a clock of its own.

    A pair meets when an event of one is within ``max_distance_m`` of the
    other's latest position, at most ``max_gap`` old.  The rule of the clock is
    ``_clock_alerts``'; pairs do not wait for each other, so one event can
    alert for several (a rule that stops at an event's first alert would tie
    the pairs of a route together and depend on the order of its buses).

    State per route: the latest position of each bus and the running clocks;
    positions older than the watermark less ``max_gap`` and clocks that would
    start anew anyway are dropped.  Meetings are found by array operations over
    a micro-batch of the route, alerts by jumps from clock to alert.
    """
    gap, dur = micros(max_gap), micros(duration)
    rows = _with_keys(keyed(df, [route, bus]).select(route, bus, ts, lat, lon, id_col), ts, id_col)

    def fn(k, pdfs, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        pdf = _sorted(pdfs)
        if len(pdf) == 0:
            return
        held = [list(x) for x in state.get] if state.exists else [[] for _ in range(6)]
        known = pd.DataFrame(dict(zip(("b", "t", "la", "lo"), held[:4])))
        fresh = pd.DataFrame({"b": pdf[bus].to_numpy(), "t": pdf["__tus"].to_numpy(), "la": pdf[lat].to_numpy(), "lo": pdf[lon].to_numpy()})
        every = fresh if known.empty else pd.concat([known, fresh], ignore_index=True)
        names, code = np.unique(every["b"].to_numpy(dtype=object).astype(str), return_inverse=True)
        t = every["t"].to_numpy(dtype="int64")
        first = len(known)
        at, other, far = _meetings(code, t, every["la"].to_numpy(float), every["lo"].to_numpy(float), first, gap, max_distance_m)
        one, two = np.minimum(code[at], code[other]), np.maximum(code[at], code[other])
        order = np.lexsort((at, two, one))
        at, far, one, two = at[order], far[order], one[order], two[order]
        clocks = {tuple(p.split("\x1f")): c for p, c in zip(held[4], held[5])}
        out = []
        starts = np.flatnonzero(np.r_[True, (np.diff(one) != 0) | (np.diff(two) != 0)]) if len(at) else []
        for s, e in zip(starts, [*starts[1:], len(at)]):
            pair = (str(names[one[s]]), str(names[two[s]]))
            alerts, left = _clock_alerts(t[at[s:e]], clocks.pop(pair, None), dur)
            if left is not None:
                clocks[pair] = left
            for m, since in alerts:
                row = int(at[s + m])
                out.append((k[0], *pair, float(far[s + m]), (int(t[row]) - since) / 1e6, pdf[ts].iloc[row - first], int(pdf[id_col].iloc[row - first])))
        wm = state.getCurrentWatermarkMs() * 1000
        latest = every.drop_duplicates("b", keep="last")
        latest = latest[latest["t"] >= wm - gap]
        clocks = {p: c for p, c in clocks.items() if wm - c <= 2 * dur}
        state.update((latest["b"].astype(str).tolist(), [int(x) for x in latest["t"]], [float(x) for x in latest["la"]], [float(x) for x in latest["lo"]],
                      ["\x1f".join(p) for p in clocks], list(clocks.values())))
        _expire_at(state, int(t.max()) + gap + 2 * dur)
        if out:
            yield pd.DataFrame(out, columns=BUNCHING_OUT.fieldNames())

    state_schema = ("buses array<string>, bus_t array<long>, bus_lat array<double>, bus_lon array<double>, "
                    "pairs array<string>, pair_t array<long>")
    return rows.groupBy(route).applyInPandasWithState(
        fn, BUNCHING_OUT, state_schema, "append", GroupStateTimeout.EventTimeTimeout)
