"""Session memory in typed state variables: values and lists per key, event-time timers, time to live."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from textsignal.constants import TOOLS
from textsignal.streaming.jobs import KEEP

COUNTS = "n long, by_tool array<long>, by_label array<long>"
LAST = "turn long, final int"
SESSION = "conv_id long, n long, by_tool array<long>, by_label array<long>, turns array<long>, finals array<int>"
VISIT = "start long, last long, n long, total double"
CLOSED = "user_id long, start long, end long, n long, total double"


class SessionMemory(StatefulProcessor):
    """Counters of a session in a value, its newest turns in a list; a row whenever it changes.

    With ``ttl_ms`` both variables are forgotten that long after their last change, by the clock.
    """

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getValueState("counts", COUNTS, self.ttl_ms)
        self.last = handle.getListState("last", LAST, self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        n, by_tool, by_label = self.counts.get() if self.counts.exists() else (0, [0] * len(TOOLS), [0] * 3)
        last = dict(self.last.get()) if self.last.exists() else {}
        for part in rows:
            n += len(part)
            by_tool = [old + int((part["tool"] == t).sum()) for old, t in zip(by_tool, TOOLS)]
            by_label = [old + int((part["final"] == c).sum()) for c, old in enumerate(by_label)]
            newest = part.nlargest(KEEP, "turn")  # by turn number, so a late turn does no harm
            last.update(zip(newest["turn"].astype(int).tolist(), newest["final"].astype(int).tolist()))
            last = dict(sorted(last.items())[-KEEP:])
        self.counts.update((n, list(by_tool), list(by_label)))
        self.last.put(list(last.items()))
        yield pd.DataFrame(
            {"conv_id": [key[0]], "n": [n], "by_tool": [list(by_tool)], "by_label": [list(by_label)], "turns": [list(last)], "finals": [list(last.values())]}
        )

    def close(self) -> None:
        pass


def session_memory(routed: DataFrame, ttl_hours: float | None = None) -> DataFrame:
    """Stream of (conv_id, counters, newest turns) from a stream of ``conv_id, turn, final, tool``."""
    ttl = None if ttl_hours is None else int(ttl_hours * 3_600_000)
    rows = routed.select("conv_id", "turn", "final", "tool").groupBy("conv_id")
    time_mode = "None" if ttl is None else "ProcessingTime"
    return rows.transformWithStateInPandas(SessionMemory(ttl), SESSION, "Update", time_mode)


class Visits(StatefulProcessor):
    """Visits of a user: events less than ``gap_ms`` apart.  The open one is a value; a timer closes it.

    A timer on event time stands ``gap_ms`` after the last event.  It fires once the watermark has passed it, so a user
    that stays away is closed and forgotten without another event of theirs.
    """

    def __init__(self, gap_ms: int):
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", VISIT)

    def _timer(self, last: int) -> int:
        return last // 1000 + self.gap_ms

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        parts = pd.concat(list(rows))
        times, order = parts["us"].to_numpy(np.int64), np.argsort(parts["us"].to_numpy(np.int64), kind="stable")
        values, times = parts["value"].to_numpy(float)[order], times[order]
        visit = self.open.get() if self.open.exists() else None
        if visit is not None:
            self.handle.deleteTimer(self._timer(visit[1]))
        starts = np.flatnonzero(np.diff(times) > self.gap_ms * 1000) + 1
        closed = []
        for piece, amounts in zip(np.split(times, starts), np.split(values, starts)):
            new = (int(piece[0]), int(piece[-1]), len(piece), float(amounts.sum()))
            if visit is None:
                visit = new
            elif new[0] - visit[1] > self.gap_ms * 1000:
                closed.append(visit)
                visit = new
            else:  # an event may be older than those seen, as far as the watermark allows
                visit = (min(visit[0], new[0]), max(visit[1], new[1]), visit[2] + new[2], visit[3] + new[3])
        self.open.update(visit)
        self.handle.registerTimer(self._timer(visit[1]))
        if closed:
            yield self._rows(key, closed)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            yield self._rows(key, [self.open.get()])
            self.open.clear()

    def _rows(self, key: Any, visits: list) -> pd.DataFrame:
        return pd.DataFrame([(key[0], *v) for v in visits], columns=["user_id", "start", "end", "n", "total"])

    def close(self) -> None:
        pass


def visits(events: DataFrame, gap_minutes: int, lateness: str) -> DataFrame:
    """Stream of closed visits from a stream of ``user_id, ts, us, value`` (``us``: the time in microseconds)."""
    rows = events.select("user_id", "ts", "us", "value").withWatermark("ts", lateness).groupBy("user_id")
    return rows.transformWithStateInPandas(Visits(gap_minutes * 60_000), CLOSED, "Append", "EventTime")
