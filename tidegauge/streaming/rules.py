"""Rules over closed bars as they arrive: every bar of a session is decided once, with what came in time.

A bar counts if it arrives within the tolerance after its end; what comes later is dropped before any state. The stream's
watermark is that of arrivals. A session (a key's day) decides its bars in order: one as soon as all its series are there,
else when a timer at its deadline fires, with those that are. So verdicts don't depend on how rows fall into batches, a bar
that never comes is told as missed at its deadline, and a session's state ends with it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

VERDICT_SCHEMA = "key string, bar_start long, verdict string"
#: What a session remembers between bars: the next bar, whether the one before was there and hot, the end of the hold, and
#: whether the session's event has been.
_MEMORY = "upcoming long, present boolean, hot boolean, until long, entered boolean"


@dataclass
class Memory:
    upcoming: int
    present: bool = False
    hot: bool = False
    until: int = -(1 << 62)
    entered: bool = False


@dataclass(frozen=True)
class LeaderRule:
    """Some leader's value reaches its threshold and the confirmer's is above zero, and one bar before that wasn't so, though
    there was a bar; blocked within ``hold`` seconds of a signal. Missed without the confirmer or any leader."""

    leaders: dict[str, float]
    confirmer: str
    hold: int

    @property
    def names(self) -> set[str]:
        return {*self.leaders, self.confirmer}

    def judge(self, start: int, values: dict[str, float | None], inside: bool, m: Memory) -> str | None:
        led = any(values.get(k) is not None and values[k] >= least for k, least in self.leaders.items())
        hot = inside and led and (values.get(self.confirmer) or 0.0) > 0
        edge, m.present, m.hot = hot and m.present and not m.hot, bool(values), hot
        if inside and (self.confirmer not in values or not values.keys() & self.leaders.keys()):
            return "missed"
        if not edge:
            return None
        if start < m.until:
            return "blocked"
        m.until = start + self.hold * 1_000_000
        return "signal"


@dataclass(frozen=True)
class TailRule:
    """The session's first bar at or below the threshold that follows none such. Missed without the bar."""

    threshold: float
    name: str = "bar"

    @property
    def names(self) -> set[str]:
        return {self.name}

    def judge(self, start: int, values: dict[str, float | None], inside: bool, m: Memory) -> str | None:
        if self.name not in values:
            return "missed" if inside else None
        below = values[self.name] is not None and values[self.name] <= self.threshold
        entry, m.hot = below and not m.hot and not m.entered, below
        m.entered |= entry
        return "signal" if entry and inside else None


class SessionProcessor(StatefulProcessor):
    """Rows: key, day (its first microsecond), name, bar_start (microseconds), value. first and last: seconds of the day between
    which a session's bars start; bars of the day outside are only looked back on."""

    def __init__(self, rule: LeaderRule | TailRule, step: int, tolerance: int, first: int, last: int):
        self.rule, self.step, self.tolerance, self.first, self.last = rule, step * 1_000_000, tolerance * 1_000_000, first * 1_000_000, last * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.memory = handle.getValueState("memory", _MEMORY)
        self.waiting = handle.getListState("waiting", "bar_start long, name string, value double")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """A session that another run had begun: the columns of Memory."""
        r = initialState.iloc[0]
        self.memory.update((int(r["upcoming"]), bool(r["present"]), bool(r["hot"]), int(r["until"]), bool(r["entered"])))
        self._remind(int(r["upcoming"]), timerValues.getCurrentWatermarkInMs())

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = [(b, n, None if v is None or v != v else v) for part in rows for b, n, v in zip(part["bar_start"].tolist(), part["name"], part["value"].tolist(), strict=True)]
        yield self._decided(key, fresh, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._decided(key, [], timerValues.getCurrentWatermarkInMs())

    def _deadline(self, start: int) -> int:
        return (start + self.step + self.tolerance) // 1000

    def _remind(self, start: int, watermark: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old[0] if isinstance(old, tuple) else old)
        self.handle.registerTimer(max(self._deadline(start), watermark) + 1)

    def _decided(self, key, fresh: list[tuple], watermark: int) -> pd.DataFrame:
        name, day = key
        m = Memory(*self.memory.get()) if self.memory.exists() else Memory(day)
        bars: dict[int, dict[str, float | None]] = {}
        for start, series, value in [*(tuple(x) for x in self.waiting.get()), *fresh]:
            bars.setdefault(start, {})[series] = value
        out, end = [], day + 86_400_000_000
        while m.upcoming < end:
            values = bars.get(m.upcoming, {})
            if values.keys() != self.rule.names and self._deadline(m.upcoming) >= watermark:
                break
            bars.pop(m.upcoming, None)
            verdict = self.rule.judge(m.upcoming, values, self.first <= m.upcoming - day <= self.last, m)
            if verdict is not None:
                out.append((name, m.upcoming, verdict))
            m.upcoming += self.step
        if m.upcoming < end:
            self.memory.update((m.upcoming, m.present, m.hot, m.until, m.entered))
            left = [(start, series, value) for start, values in bars.items() for series, value in values.items()]
            self.waiting.put(left) if left else self.waiting.clear()
            self._remind(m.upcoming, watermark)
        else:
            self.memory.clear()
            self.waiting.clear()
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old[0] if isinstance(old, tuple) else old)
        return pd.DataFrame(out, columns=["key", "bar_start", "verdict"])

    def close(self) -> None:
        pass


def live_sessions(
    bars: DataFrame, rule: LeaderRule | TailRule, key: Column, name: Column, step: int, tolerance: int = 90, session: tuple[int, int] = (0, 86_400), watermark: str = "0 seconds", initial: DataFrame | None = None,
) -> DataFrame:
    """key, bar_start and verdict (signal, blocked, missed) of closed bars: columns bar_start, arrived (timestamps) and value.

    ``key`` is what a rule watches together (a market, or an entity), ``name`` the series within it. Of several values of a
    series for a bar the last one seen counts. ``initial``: key, day and the columns of Memory, of sessions that are open.
    """
    micros = F.unix_micros(F.col("bar_start").cast("timestamp"))
    rows = bars.select(key.cast("string").alias("key"), name.cast("string").alias("name"), micros.alias("bar_start"), F.col("value").cast("double").alias("value"), F.col("arrived").cast("timestamp").alias("arrived"))
    rows = rows.withWatermark("arrived", watermark)
    wanted = F.col("name").isin(sorted(rule.names)) & F.col("bar_start").isNotNull()
    timely = F.unix_micros("arrived") <= F.col("bar_start") + (step + tolerance) * 1_000_000
    day = F.floor(F.col("bar_start") / 86_400_000_000).cast("long") * 86_400_000_000
    grouped = rows.where(wanted & timely).withColumn("day", day).groupBy("key", "day")
    start = None if initial is None else initial.groupBy("key", "day")
    found = grouped.transformWithStateInPandas(SessionProcessor(rule, step, tolerance, *session), outputStructType=VERDICT_SCHEMA, outputMode="Append", timeMode="EventTime", initialState=start)
    return found.select("key", F.timestamp_micros("bar_start").alias("bar_start"), "verdict")
