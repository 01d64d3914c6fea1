"""Keyed stateful processors for streams.

Processors run under ``transformWithStateInPandas`` with the RocksDB state
store.  Row order inside a micro-batch is not guaranteed, so each key's rows
are sorted by (ts, seq) before the fold; timers due between two rows of the
same batch are fired inline, in order, exactly like the batch fold.  Where a
rule needs the order of all rows (T5, T6) a key's rows of one micro-batch are
held at once, so the source's trigger size bounds them.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.time import duration_ms, floor_to, to_ms, watermark_delay
from ..operators.rising import ALERT_PREFIX, ALERT_SUFFIX
from ..operators.routing import CLICK_WARNING, DAY_MS, write_routes
from ..session import ship_package
from .gate import gate_join


def _chunks(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The non-empty chunks of a key's rows (column names must not start with an underscore here)."""
    return (chunk for chunk in rows if len(chunk))


def _sorted(rows: Iterator[pd.DataFrame], ts: str, seq: str) -> pd.DataFrame:
    frames = list(rows)
    if not frames:
        return pd.DataFrame()
    pdf = pd.concat(frames, ignore_index=True)
    return pdf.sort_values([ts, seq], kind="stable").reset_index(drop=True)


# ------------------------------------------------------------------ T1


class DailyLimitProcessor(StatefulProcessor):
    """Per key: count clicks per UTC day; pass the first ``passing``, warn once
    on the next, drop the rest.  Each day has its own count, so a late click
    of a past day neither resets nor uses up another day's limit; a day's count
    is cleared by an event-time timer at its end.

    Of a micro-batch only the rows that can still pass or warn are held: at most
    ``passing + 1`` per day besides the chunk at hand.
    """

    def __init__(self, ts: str, seq: str, max_count: int, inclusive_quirk: bool, columns: list[str]):
        self.ts, self.seq, self.columns = ts, seq, columns
        self.passing = max_count + 1 if inclusive_quirk else max_count

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "day bigint", "cnt bigint")

    def _count(self, day: int) -> int:
        return int(self.counts.getValue((day,))[0]) if self.counts.containsKey((day,)) else 0

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        seen: dict[int, int] = {}
        before: dict[int, int] = {}
        held = None
        for chunk in _chunks(rows):
            chunk = chunk.assign(_day=chunk[self.ts] // DAY_MS)
            for day, n in chunk["_day"].value_counts().items():
                seen[int(day)] = seen.get(int(day), 0) + int(n)
            for day in set(seen) - set(before):
                before[day] = self._count(day)
            both = chunk if held is None else pd.concat([held, chunk], ignore_index=True)
            both = both.sort_values([self.ts, self.seq], kind="stable")
            nth = both["_day"].map(before) + both.groupby("_day").cumcount() + 1
            held = both[nth <= self.passing + 1]
        if held is None:
            return
        for day, n in seen.items():
            if not before[day]:
                self.handle.registerTimer((day + 1) * DAY_MS)
            self.counts.updateValue((day,), (before[day] + n,))
        if len(held):
            nth = held["_day"].map(before) + held.groupby("_day").cumcount() + 1
            out = held[self.columns].copy()
            out["route"] = nth.le(self.passing).map({True: "pass", False: "warn"})
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        day = expiredTimerInfo.getExpiryTimeInMs() // DAY_MS - 1
        if self.counts.containsKey((day,)):
            self.counts.removeKey((day,))
        return iter([])

    def close(self) -> None:
        pass


def daily_limit_stream(
    stream: DataFrame, keys: list[str], ts_ms: str, seq: str, max_count: int,
    inclusive_quirk: bool = True, time_col: str = "ts",
) -> DataFrame:
    """T1 stream: input columns + ``route`` ('pass' / 'warn')."""
    cols = stream.columns
    schema = stream.select(*cols, F.lit("x").alias("route")).schema
    ship_package(stream.sparkSession)
    proc = DailyLimitProcessor(ts_ms, seq, max_count, inclusive_quirk, cols)
    return stream.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=schema, outputMode="Append", timeMode="EventTime",
    )


def warnings_of(routed: DataFrame, keys: list[str], ts_ms: str, max_count: int) -> DataFrame:
    return routed.where(F.col("route") == "warn").select(
        *[F.col(k).cast("string").alias(k) for k in keys],
        F.floor(F.col(ts_ms) / F.lit(DAY_MS)).cast("bigint").alias("day"),
        F.lit(CLICK_WARNING.format(n=max_count)).alias("msg"),
    )


# ------------------------------------------------------------------ T5


class RisingProcessor(StatefulProcessor):
    """Per sensor: ``prev`` temperature and an ``armed`` event-time timer."""

    def __init__(self, key: str, ts: str, seq: str, value: str, interval_ms: int):
        self.key, self.ts, self.seq, self.value = key, ts, seq, value
        self.interval_ms = interval_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("rise", "prev double, armed bigint")

    def _emit(self, key, t) -> pd.DataFrame:
        return pd.DataFrame({"id": [str(key)], "alert_ts": [int(t)]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.ts, self.seq)
        if pdf.empty:
            return
        cur = self.state.get() if self.state.exists() else None
        prev = None if cur is None or pd.isna(cur[0]) else float(cur[0])
        armed = None if cur is None or cur[1] is None or pd.isna(cur[1]) else int(cur[1])
        alerts = []
        k = key[0] if isinstance(key, tuple) else key
        for t, v in zip(pdf[self.ts].tolist(), pdf[self.value].tolist()):
            t = int(t)
            if armed is not None and t >= armed:
                alerts.append(armed)
                self.handle.deleteTimer(armed)
                armed = None
            if prev is None or v < prev:
                if armed is not None:
                    self.handle.deleteTimer(armed)
                armed = None
            elif v > prev and armed is None:
                armed = t + self.interval_ms
                self.handle.registerTimer(armed)
            prev = float(v)
        self.state.update((prev, armed))
        if alerts:
            yield pd.DataFrame({"id": [str(k)] * len(alerts), "alert_ts": alerts})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        k = key[0] if isinstance(key, tuple) else key
        cur = self.state.get() if self.state.exists() else None
        fired = expiredTimerInfo.getExpiryTimeInMs()
        if cur is not None and cur[1] is not None and not pd.isna(cur[1]) and int(cur[1]) == fired:
            self.state.update((cur[0], None))
            yield self._emit(k, fired)

    def close(self) -> None:
        pass


def rising_alerts_stream(
    stream: DataFrame, key: str, ts_ms: str, seq: str, value: str, interval_ms: int
) -> DataFrame:
    """T5 stream: (id, alert_ts, msg); an alert is emitted once the watermark
    passes its time, or inline when a later row of the key arrives first."""
    ship_package(stream.sparkSession)
    proc = RisingProcessor(key, ts_ms, seq, value, interval_ms)
    out = stream.where(F.col(value).isNotNull()).groupBy(key).transformWithStateInPandas(
        statefulProcessor=proc, outputStructType="id string, alert_ts bigint",
        outputMode="Append", timeMode="EventTime",
    )
    return out.select("id", "alert_ts", F.concat(F.lit(ALERT_PREFIX), F.col("id"), F.lit(ALERT_SUFFIX)).alias("msg"))


# ------------------------------------------------------------------ T6


class SequenceProcessor(StatefulProcessor):
    """Per key: the last n-1 rows; each new row closes a candidate of n rows.

    A tail that can no longer take part in a match (its last row is ``within``
    behind the watermark) is cleared by an event-time timer.
    """

    def __init__(self, ts: str, seq: str, steps: list[Callable[[dict], bool]], within_ms: int,
                 emit: str, columns: list[str]):
        self.ts, self.seq, self.steps, self.within_ms = ts, seq, steps, within_ms
        self.emit, self.columns = emit, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getListState("tail", "ts bigint, seq bigint, payload string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.ts, self.seq)
        if pdf.empty:
            return
        n = len(self.steps)
        tail = [(int(t), int(s), json.loads(p)) for t, s, p in self.state.get()] if self.state.exists() else []
        if tail:
            self.handle.deleteTimer(tail[-1][0] + self.within_ms)
        matches = []
        for rec in pdf[self.columns].to_dict("records"):
            tail.append((int(rec[self.ts]), int(rec[self.seq]), rec))
            tail = tail[-n:]
            if len(tail) == n and tail[-1][0] - tail[0][0] < self.within_ms and all(
                step(r[2]) for step, r in zip(self.steps, tail)
            ):
                matches.append([r[2][self.emit] for r in tail])
        if n > 1:
            self.state.put([(t, s, json.dumps(p, default=str)) for t, s, p in tail[-(n - 1):]])
            self.handle.registerTimer(tail[-1][0] + self.within_ms)
        if matches:
            k = key[0] if isinstance(key, tuple) else key
            out = pd.DataFrame(matches, columns=[f"s{i + 1}" for i in range(n)])
            out.insert(0, "key", k)
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def strict_sequence_stream(
    stream: DataFrame, key: str, ts_ms: str, seq: str, steps: list[Callable[[dict], bool]],
    within_ms: int, emit: str, emit_type: str = "bigint", key_type: str = "bigint", time_col: str = "ts",
) -> DataFrame:
    """T6 stream: one row per match with the ``emit`` value of each step.

    ``stream`` carries a watermark on ``time_col``, which ends idle keys' state.
    """
    cols = [c for c in stream.columns if c != time_col]
    ship_package(stream.sparkSession)
    proc = SequenceProcessor(ts_ms, seq, steps, within_ms, emit, cols)
    n = len(steps)
    schema = f"key {key_type}, " + ", ".join(f"s{i + 1} {emit_type}" for i in range(n))
    return stream.groupBy(key).transformWithStateInPandas(
        statefulProcessor=proc, outputStructType=schema, outputMode="Append", timeMode="EventTime",
    )


# ------------------------------------------------------------------ A7


class FirstSightingFilter(StatefulProcessor):
    """Per (window, user): pass the earliest row once; state cleared at window end."""

    def __init__(self, ts: str, seq: str, columns: list[str]):
        self.ts, self.seq, self.columns = ts, seq, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for chunk in _chunks(rows):  # only the least row so far is held
            both = chunk if first is None else pd.concat([first, chunk], ignore_index=True)
            first = both.sort_values([self.ts, self.seq], kind="stable").iloc[:1]
        if first is None or self.state.exists():
            return
        self.state.update((True,))
        self.handle.registerTimer(int(first["window_end"].iloc[0]))
        yield first[self.columns]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


class FirstSightingCounter(StatefulProcessor):
    """Per window: a counter of distinct users, fed only first sightings."""

    def __init__(self, user: str, ts: str, seq: str):
        self.user, self.ts, self.seq = user, ts, seq

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows, self.ts, self.seq)
        if pdf.empty:
            return
        cur = self.state.get() if self.state.exists() else None
        n0 = int(cur[0]) if cur else 0
        if cur is None:
            self.handle.registerTimer(int(pdf["window_end"].iloc[0]))
        self.state.update((n0 + len(pdf),))
        yield pd.DataFrame({
            "window_end": pdf["window_end"].astype("int64").tolist(),
            self.user: pdf[self.user].tolist(),
            self.ts: pdf[self.ts].astype("int64").tolist(),
            "uv_running": list(range(n0 + 1, n0 + 1 + len(pdf))),
        })

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


def running_distinct_stream(stream: DataFrame, user: str, ts: str, ts_ms: str, seq: str, size,
                            user_type: str = "bigint", delay="0 seconds") -> DataFrame:
    """A7 stream: first sighting per (window, user), then a counter per window.

    The first processor spreads over (window, user) keys and forwards one row
    per user and window; the counter per window therefore sees at most the
    window's distinct users, and keeps one number of state: numbering them is
    one sequence per window by definition.  Both clear their state by event-time
    timers at the window end.  Rows may be late by up to ``delay``.
    """
    size_ms = duration_ms(size)
    ship_package(stream.sparkSession)
    rows = (
        stream.withWatermark(ts, watermark_delay(delay))
        .withColumn("window_end", floor_to(F.col(ts_ms), size_ms) + F.lit(size_ms))
        .select("window_end", user, ts, ts_ms, seq)
    )
    cols = ["window_end", user, ts, ts_ms, seq]
    firsts = rows.groupBy("window_end", user).transformWithStateInPandas(
        statefulProcessor=FirstSightingFilter(ts_ms, seq, cols),
        outputStructType=rows.select(*cols).schema,
        outputMode="Append", timeMode="EventTime",
    )
    return firsts.groupBy("window_end").transformWithStateInPandas(
        statefulProcessor=FirstSightingCounter(user, ts_ms, seq),
        outputStructType=f"window_end bigint, {user} {user_type}, {ts_ms} bigint, uv_running bigint",
        outputMode="Append", timeMode="EventTime",
    )


def routed_outputs(
    keys: list[str],
    ts_ms: str,
    max_count: int,
    main_sink: Callable[[DataFrame, int], None],
    side_sink: Callable[[DataFrame, int], None],
):
    """T2 stream: ``foreachBatch`` body feeding both limiter outputs from one
    routed micro-batch (persisted once, written twice)."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            main_sink(batch.where(F.col("route") == "pass").drop("route"), batch_id)
            side_sink(warnings_of(batch, keys, ts_ms, max_count), batch_id)
        finally:
            batch.unpersist()

    return run


def routed_folder(folder: str, routes: list[str], counted: Callable[[dict[str, int], int], None] | None = None):
    """T2 stream in one pass: a ``foreachBatch`` body that writes a routed micro-batch
    once, partitioned by route, into ``folder/batch=<id>``.

    A replayed batch replaces its own folder.  ``counted`` is told the number of
    rows of each route, taken by the write itself.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        _, counts = write_routes(batch, f"{folder}/batch={batch_id}", routes)
        if counted is not None:
            counted(counts, batch_id)

    return run


# ------------------------------------------------------------------ J1


class GateProcessor(StatefulProcessor):
    """Per key: how long the gate is open, and the rows the watermark has not passed yet.

    Rows wait until the watermark passes them, so controls and readings are
    folded in time order (controls first on ties) whatever order they arrive in.
    A key has one timer, at its earliest waiting row; when it fires, all rows up to
    the watermark are folded, so the waiting rows are read once per micro-batch.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", "until bigint")
        self.due = handle.getValueState("due", "due bigint")
        self.waiting = handle.getListState("waiting", "t bigint, kind int, open_to bigint, row string")

    def _wake_at(self, t: int) -> None:
        """One timer, at the earliest time asked for."""
        if self.due.exists():
            due = int(self.due.get()[0])
            if due <= t:
                return
            self.handle.deleteTimer(due)
        self.handle.registerTimer(t)
        self.due.update((t,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(rows):
            values = [
                (int(t), int(k), 0 if pd.isna(e) else int(e), r)
                for t, k, e, r in chunk[["gate_t", "gate_kind", "gate_open_to", "gate_row"]].itertuples(index=False)
            ]
            self.waiting.appendList(values)
            self._wake_at(min(v[0] for v in values))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.due.clear()
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        until = int(self.until.get()[0]) if self.until.exists() else -(1 << 62)
        held = [tuple(v) for v in self.waiting.get()] if self.waiting.exists() else []
        passed, rest = [], []
        for v in sorted(held):
            t, kind, open_to, row = v
            if t > now:
                rest.append(v)
            elif kind == 0:
                until = max(until, open_to)
            elif t < until:
                passed.append(row)
        if rest:
            self.waiting.put(rest)
            self._wake_at(rest[0][0])
        elif held:
            self.waiting.clear()
        if until > now:
            self.until.update((until,))
            self._wake_at(until)
        elif self.until.exists():
            self.until.clear()
        if passed:
            yield pd.DataFrame({"gate_row": passed})

    def close(self) -> None:
        pass


#: Times in the waiting rows' JSON keep their microseconds.
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def gate_stream(
    readings: DataFrame, controls: DataFrame, key: str, ts: str, control_key: str, control_ts: str,
    duration_ms_col: str, delay="0 seconds", max_duration=None,
) -> DataFrame:
    """J1 stream: readings whose key is open at their time.

    With ``max_duration``, which bounds the controls' durations, this is Spark's
    interval join (``gate.gate_join``).  Without it a stateful processor folds both
    inputs, whatever the controls' durations.
    """
    if max_duration is not None:
        return gate_join(readings, controls, key, ts, control_key, control_ts, duration_ms_col, max_duration, delay)
    ship_package(readings.sparkSession)
    schema = readings.schema
    r = readings.select(
        F.col(key).alias("gate_key"), F.col(ts).alias("gate_ts"), to_ms(F.col(ts)).alias("gate_t"), F.lit(1).alias("gate_kind"),
        F.lit(None).cast("bigint").alias("gate_open_to"), F.to_json(F.struct(*readings.columns), EXACT_TIMES).alias("gate_row"),
    )
    c = controls.select(
        F.col(control_key).alias("gate_key"), F.col(control_ts).alias("gate_ts"), to_ms(F.col(control_ts)).alias("gate_t"),
        F.lit(0).alias("gate_kind"),
        (to_ms(F.col(control_ts)) + F.col(duration_ms_col)).cast("bigint").alias("gate_open_to"), F.lit("").alias("gate_row"),
    )
    both = r.unionByName(c).withWatermark("gate_ts", watermark_delay(delay))
    passed = both.groupBy("gate_key").transformWithStateInPandas(
        statefulProcessor=GateProcessor(), outputStructType="gate_row string", outputMode="Append", timeMode="EventTime",
    )
    return passed.select(F.from_json("gate_row", schema, EXACT_TIMES).alias("r")).select("r.*")


# ------------------------------------------------------------------ L5


class RevisionProcessor(StatefulProcessor):
    """Per key and window: the count, fired at the window's end and again for each late row."""

    def __init__(self, columns: list[str], size_ms: int, allowed_ms: int):
        self.columns, self.size_ms, self.allowed_ms = columns, size_ms, allowed_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("count", "n bigint, fired boolean")

    def _row(self, key, n: int, update: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, n, update)], columns=[*self.columns, "cnt", "is_update"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        # the engine's watermark lags the stream's by the allowance and a window, so it drops no row of an open window
        last = int(key[-1]) - 1
        behind = last - timerValues.getCurrentWatermarkInMs()
        if behind <= self.size_ms:
            return  # past the allowance
        closed = behind <= self.size_ms + self.allowed_ms
        n, fired = self.state.get() if self.state.exists() else (0, False)
        n, fired = int(n), bool(fired)
        if closed and n and not fired:  # the first firing is due, its timer has not run yet
            yield self._row(key, n, False)
            fired = True
        for chunk in _chunks(rows):
            if not closed:
                n += len(chunk)
                continue
            for _ in range(len(chunk)):
                n += 1
                yield self._row(key, n, fired)
                fired = True
        self.state.update((n, fired))
        self.handle.registerTimer(last - self.size_ms - (0 if closed else self.allowed_ms))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = int(key[-1]) - 1
        if not self.state.exists():
            return
        if expiredTimerInfo.getExpiryTimeInMs() >= last - self.size_ms:
            self.state.clear()
            return
        n, fired = self.state.get()
        if not fired:
            self.state.update((int(n), True))
            yield self._row(key, int(n), False)
        self.handle.registerTimer(last - self.size_ms)

    def close(self) -> None:
        pass


def late_revisions_stream(
    stream: DataFrame, keys: list[str], ts: str, ts_ms: str, size, delay, allowed_lateness
) -> DataFrame:
    """L5 stream: keys, window_end, cnt, is_update; one row when the watermark reaches a
    window's last instant and one per row that comes after it within the allowance."""
    ship_package(stream.sparkSession)
    size_ms, allowed_ms = duration_ms(size), duration_ms(allowed_lateness)
    rows = stream.withWatermark(ts, watermark_delay(duration_ms(delay) + allowed_ms + size_ms)).select(
        *keys, ts, (floor_to(F.col(ts_ms), size_ms) + F.lit(size_ms)).alias("window_end")
    )
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in [*keys, "window_end"]) + ", cnt bigint, is_update boolean"
    return rows.groupBy(*keys, "window_end").transformWithStateInPandas(
        statefulProcessor=RevisionProcessor([*keys, "window_end"], size_ms, allowed_ms), outputStructType=schema,
        outputMode="Append", timeMode="EventTime",
    )


# ------------------------------------------------------------------ L6


class PaneProcessor(StatefulProcessor):
    """Per key and window: least and largest value per pane; each pane's end reports the window so far."""

    def __init__(self, columns: list[str], value: str, pane_ms: int):
        self.columns, self.value, self.pane_ms = columns, value, pane_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "pane_end bigint", "low double, high double")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(rows):
            for pane, values in chunk.groupby("own_pane")[self.value]:
                k, low, high = (int(pane),), float(values.min()), float(values.max())
                if self.panes.containsKey(k):
                    was = self.panes.getValue(k)
                    low, high = min(low, was[0]), max(high, was[1])
                self.panes.updateValue(k, (low, high))
                for t in range(int(pane), int(key[-1]) + 1, self.pane_ms):
                    self.handle.registerTimer(t)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, end = expiredTimerInfo.getExpiryTimeInMs(), int(key[-1])
        held = [v for (pane,), v in self.panes.iterator() if pane <= now]
        if held:
            row = (*key, now, min(v[0] for v in held), max(v[1] for v in held), now == end)
            names = [*self.columns, "pane_end", f"min_{self.value}", f"max_{self.value}", "is_final"]
            yield pd.DataFrame([row], columns=names)
        if now == end:
            self.panes.clear()

    def close(self) -> None:
        pass


def early_results_stream(
    stream: DataFrame, keys: list[str], ts: str, ts_ms: str, value: str, size, pane, delay="0 seconds"
) -> DataFrame:
    """L6 stream: keys, window_end, pane_end, min, max, is_final at every pane end of a window."""
    ship_package(stream.sparkSession)
    size_ms, pane_ms = duration_ms(size), duration_ms(pane)
    rows = stream.withWatermark(ts, watermark_delay(delay)).where(F.col(value).isNotNull()).select(
        *keys, ts, F.col(value).cast("double").alias(value),
        (floor_to(F.col(ts_ms), size_ms) + F.lit(size_ms)).alias("window_end"),
        (floor_to(F.col(ts_ms), pane_ms) + F.lit(pane_ms)).alias("own_pane"),
    )
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in [*keys, "window_end"])
    return rows.groupBy(*keys, "window_end").transformWithStateInPandas(
        statefulProcessor=PaneProcessor([*keys, "window_end"], value, pane_ms),
        outputStructType=f"{schema}, pane_end bigint, min_{value} double, max_{value} double, is_final boolean",
        outputMode="Append", timeMode="EventTime",
    )
