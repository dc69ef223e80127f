"""Clock-mode bunching on three chained keyed states: bus, place, pair.

1. Per (route, bus): the place of its latest position.  An event is passed on
   to the cell it lies in and, if the bus came from another cell, as a
   departure to that one.
2. Per (route, cell): the buses that are there now.  An event is compared with
   those in its own cell and in the cells it is near to; a meeting is
   another bus whose latest position is close enough and not too old.
3. Per pair of buses: its clock.

So no task holds a route: a busy one is spread over its buses, its places and its
pairs.  The keys of a state are dealt into ``BUCKETS`` groups; a call gets the
rows of one group in one micro-batch, which the source bounds.
``transformWithStateInPandas`` hands Python its rows one by one, so the rows of a
group in an Arrow batch travel to the second and third state as one.  Spark drops
late rows before the first state; each row carries the watermark on, and a call
drops what it can change nothing more.

Needs RocksDB state (``transformWithState``).  The answer is that of ``stateful.bunching_stream``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.geo import haversine_m_np, unit_xyz
from ..functions.scalar import epoch_micros
from ..operators.detect import _offsets, keyed
from ..operators.sequence import micros
from .stateful import BUCKETS, BUNCHING_OUT, _clock_alerts

_MOVE = "route_id string, bus string, t long, id long, lat double, lon double, home string, gone string, wm long"
_MEETING = "route_id string, bus_1 string, bus_2 string, distance_m double, t long, id long, wm long"
_ALERT = "route_id string, bus_1 string, bus_2 string, distance_m double, duration_sec double, t long, event_id long"
#: what an event is to a cell: the bus is there now, it is near, it has left
HERE, NEAR, GONE = range(3)


def _rows(frames: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(frames, ignore_index=True).sort_values(["t", "id"], kind="stable", ignore_index=True)


def _parts(pdf: pd.DataFrame, keys: list[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """(key, its rows in order) of every key of a group."""
    return ((k, at) for k, at in pdf.groupby(keys, sort=False).indices.items())


def _entries(columns) -> list[tuple]:
    """The entries of a group's state, which is kept as a list per column."""
    return list(zip(*columns, strict=True))


def _columns(entries: list[tuple]) -> tuple:
    return tuple(list(c) for c in zip(*entries, strict=True))


def _packed(rows: DataFrame) -> DataFrame:
    """The rows of each group (column __bucket) in an Arrow batch as one row."""
    def run(batches):
        for b in batches:
            bucket = b.column("__bucket").to_numpy()
            order = np.argsort(bucket, kind="stable")
            first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
            own, packs = b.take(pa.array(order)), []
            for s, e in zip(first, [*first[1:], len(order)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema) as out:
                    out.write_batch(own.slice(s, e - s))
                packs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(bucket[order[first]], pa.int32()), pa.array(packs, pa.binary())], names=["__bucket", "pack"])

    return rows.mapInArrow(run, "__bucket int, pack binary")


class _Group(StatefulProcessor):
    """``step`` (rows, entries held -> frames, entries) on the packed rows of a group."""

    def __init__(self, step, schema: str):
        self.step, self.schema = step, schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        frames = [pa.ipc.open_stream(x).read_pandas() for p in rows for x in p["pack"]]
        if not frames:
            return
        out, entries = self.step(_rows(frames), _entries(self.held.get()) if self.held.exists() else [])
        if entries:
            self.held.update(_columns(entries))
        else:
            self.held.clear()
        yield from out

    def close(self) -> None:
        pass


def _moves(gap: int):
    def fn(k, rows, state: GroupState):
        frames = [p for p in rows if len(p)]
        if not frames:
            return
        pdf = _rows(frames)
        wm = state.getCurrentWatermarkMs() * 1000
        known = {(r, b): (c, t) for r, b, c, t in (_entries(state.get) if state.exists else [])}
        own, t = pdf["home"].to_numpy(object), pdf["t"].to_numpy("int64")
        gone = np.full(len(pdf), None, object)
        for key, at in _parts(pdf, ["route_id", "bus"]):
            came = np.concatenate([[known[key][0] if key in known else None], own[at[:-1]]])
            gone[at] = np.where(came != own[at], came, None)
            known[key] = own[at[-1]], int(t[at[-1]])
        entries = [(*key, c, last) for key, (c, last) in known.items() if last >= wm - gap]
        if entries:
            state.update(_columns(entries))
        elif state.exists:
            state.remove()
        pdf["gone"], pdf["wm"] = gone, wm
        yield pdf[["route_id", "bus", "t", "id", "lat", "lon", "home", "gone", "wm"]]

    return fn


def _meet(known: dict, bus: np.ndarray, kind: np.ndarray, t: np.ndarray, lat: np.ndarray, lon: np.ndarray, gap: int, far_m: float):
    """(event, other bus, distance) of the meetings in one cell; ``known`` (bus:
    its latest position, if there) is brought up to date."""
    ask = np.flatnonzero(kind != GONE)
    moves: dict[str, list[int]] = {}
    for i in np.flatnonzero(kind != NEAR).tolist():
        moves.setdefault(bus[i], []).append(i)
    at, other, far = [np.zeros(0, np.int64)], [], [np.zeros(0)]
    for b in {**known, **moves}:
        # the bus's latest change in this cell before each event: a row of this batch, or what was known
        own = np.array(moves.get(b, []), np.int64)
        j = np.searchsorted(own, ask, side="left") - 1
        row = own[np.maximum(j, 0)] if len(own) else np.zeros(len(ask), np.int64)
        kt, klat, klon = known.get(b, (None, 0.0, 0.0))
        here = np.where(j >= 0, kind[row] == HERE, kt is not None) & (bus[ask] != b)
        since = np.where(j >= 0, t[row], kt or 0)
        here &= t[ask] - since <= gap
        hit = ask[here]
        d = haversine_m_np(np.where(j >= 0, lat[row], klat)[here], np.where(j >= 0, lon[row], klon)[here], lat[hit], lon[hit])
        close = d <= far_m
        at.append(hit[close])
        other += [b] * int(close.sum())
        far.append(d[close])
    for b, own in moves.items():
        i = own[-1]
        if kind[i] == HERE:
            known[b] = int(t[i]), float(lat[i]), float(lon[i])
        else:
            known.pop(b, None)
    return np.concatenate(at), other, np.concatenate(far)


def _places(gap: int, far_m: float):
    def step(pdf: pd.DataFrame, entries: list[tuple]):
        wm = int(pdf["wm"].max())
        known: dict[tuple, dict] = {}
        for r, c, b, *place in entries:
            known.setdefault((r, c), {})[b] = tuple(place)
        out = []
        bus, kind, t, lat, lon, id_ = (pdf[c].to_numpy() for c in ("bus", "kind", "t", "lat", "lon", "id"))
        for key, at in _parts(pdf, ["route_id", "cell"]):
            hit, other, far = _meet(known.setdefault(key, {}), bus[at], kind[at], t[at], lat[at], lon[at], gap, far_m)
            if len(hit):
                me = bus[at[hit]].tolist()
                out.append(pd.DataFrame({"route_id": key[0], "bus_1": [min(x) for x in zip(me, other)], "bus_2": [max(x) for x in zip(me, other)],
                                         "distance_m": far, "t": t[at[hit]], "id": id_[at[hit]], "wm": wm}))
        return out, [(*key, b, *p) for key, there in known.items() for b, p in there.items() if p[0] >= wm - gap]

    return step


def _clocks(duration: int):
    def step(pdf: pd.DataFrame, entries: list[tuple]):
        wm = int(pdf["wm"].max())
        clocks = {(r, one, two): since for r, one, two, since in entries}
        t, out, ran = pdf["t"].to_numpy("int64"), [], []
        for key, at in _parts(pdf, ["route_id", "bus_1", "bus_2"]):
            alerts, left = _clock_alerts(t[at], clocks.pop(key, None), duration)
            if left is not None:
                clocks[key] = left
            out += [at[m] for m, _ in alerts]
            ran += [since for _, since in alerts]
        frames = []
        if out:
            got = pdf.iloc[out].rename(columns={"id": "event_id"})
            got["duration_sec"] = (got["t"].to_numpy() - np.array(ran, np.int64)) / 1e6
            frames.append(got[["route_id", "bus_1", "bus_2", "distance_m", "duration_sec", "t", "event_id"]])
        return frames, [(*key, since) for key, since in clocks.items() if wm - since <= 2 * duration]

    return step


def bunching_chained(df: DataFrame, route: str = "route_id", bus: str = "bus_id", ts: str = "timestamp", lat: str = "lat", lon: str = "lon",
                     id_col: str = "event_id", max_distance_m: float = 200.0, max_gap="60 seconds", duration="300 seconds",
                     cell_factor: float = 4.0, buckets: int = BUCKETS) -> DataFrame:
    """``stateful.bunching_stream`` for routes of any traffic; ``df`` has a
    watermark on ``ts``.  Cells are cubes of side ``cell_factor * max_distance_m``
    on earth-centred coordinates; an event is near the neighbour cells within
    ``max_distance_m``.  Positions without coordinates or a time are ignored."""
    gap, cell = micros(max_gap), max_distance_m * cell_factor
    # columns of their own: written out in every name of a cell they would take seconds to plan, and be computed again each time
    axes = {f"__{part}{axis}": e for axis, v in enumerate(unit_xyz("lat", "lon"))
            for part, e in zip(("at", "by"), _offsets(v, cell, max_distance_m + 1e-3), strict=True)}

    def name(offsets):
        return F.concat_ws(",", *[(F.col(f"__at{axis}") + o).cast("string") for axis, o in enumerate(offsets)])

    around = F.flatten(F.transform("__by0", lambda a: F.flatten(F.transform("__by1", lambda b: F.transform(
        "__by2", lambda c: name([a, b, c]))))))

    def dealt(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))

    def then(rows: DataFrame, keys: list[str], step, out: str, state: str) -> DataFrame:
        return _packed(dealt(rows, *keys)).groupBy("__bucket").transformWithStateInPandas(_Group(step, state), out, "Append", "None")

    rows = keyed(df, [route, bus, ts, lat, lon]).select(
        F.col(route).alias("route_id"), F.col(bus).alias("bus"), epoch_micros(ts).alias("t"), F.col(id_col).cast("long").alias("id"),
        F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"), F.col(ts).alias("event_time"))
    rows = rows.withColumns(axes).withColumn("home", name([F.lit(0)] * 3)).drop(*axes)
    # no timeout (what follows would not be allowed): the state is that of the buses alive at the last call of each group
    moves = dealt(rows, "route_id", "bus").groupBy("__bucket").applyInPandasWithState(
        _moves(gap), _MOVE, "routes array<string>, buses array<string>, cells array<string>, t array<long>", "append", GroupStateTimeout.NoTimeout)

    def as_kind(cells, kind: int):
        return F.transform(cells, lambda c: F.struct(c.alias("cell"), F.lit(kind).alias("kind")))

    told = F.concat(as_kind(F.array("home"), HERE), as_kind(F.array_remove(around, F.col("home")), NEAR),
                    as_kind(F.filter(F.array("gone"), lambda c: c.isNotNull()), GONE))
    seen = moves.withColumns(axes).select("*", F.explode(told).alias("c")).select("route_id", "bus", "t", "id", "lat", "lon", "wm", "c.cell", "c.kind")
    met = then(seen, ["route_id", "cell"], _places(gap, max_distance_m), _MEETING,
               "routes array<string>, cells array<string>, buses array<string>, t array<long>, lat array<double>, lon array<double>")
    alerts = then(met, ["route_id", "bus_1", "bus_2"], _clocks(micros(duration)), _ALERT,
                  "routes array<string>, one array<string>, two array<string>, since array<long>")
    return alerts.withColumn("event_time", F.timestamp_micros("t")).select(*BUNCHING_OUT.fieldNames())
