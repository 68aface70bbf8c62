"""Alert rules on live data: absence by timers, conditions that must hold, rates joined with backlogs.

Each function takes streams; the functions of operators.metrics that it names are its batch twins.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class _Absence(StatefulProcessor):
    """Slots of one expected series: which were seen, and the first that is not decided yet. A timer at its end decides it."""

    def __init__(self, slot_ms: int, since_ms: int):
        self.slot_ms, self.first = slot_ms, since_ms // slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.next = handle.getValueState("next", "slot bigint")
        self.seen = handle.getMapState("seen", "slot bigint", "n int")

    def _expect(self, slot: int) -> None:
        self.next.update((slot,))
        self.handle.registerTimer((slot + 1) * self.slot_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._expect(self.first)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.next.exists():  # other series are not expected
            open_ = self.next.get()[0]
            for part in rows:
                for slot in set((part["ts"].astype("datetime64[ms]").astype("int64") // self.slot_ms).tolist()):
                    if slot >= open_:
                        self.seen.updateValue((slot,), (1,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        silent, slot = [], self.next.get()[0]
        until = timerValues.getCurrentWatermarkInMs() // self.slot_ms
        while slot < until:
            if self.seen.containsKey((slot,)):
                self.seen.removeKey((slot,))
            else:
                silent.append(slot)
            slot += 1
        self._expect(slot)
        yield pd.DataFrame({"series": [key[0]] * len(silent), "start": pd.to_datetime([s * self.slot_ms for s in silent], unit="ms")})

    def close(self) -> None:
        pass


def absence(expected: DataFrame, events: DataFrame, series: str, since: str, width_s: int = 3600, late: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """(series, start): each window from since on in which an expected series stayed silent, emitted once the watermark has passed its
    end, whether or not the series ever sends anything. Twin: metrics.absent.

    expected is a table of series; events are a stream. State: one row per expected series, and one per window that it was
    seen in and that isn't over yet.
    """
    start = int(pd.Timestamp(since).value // 1_000_000)
    kind = expected.schema[series].dataType.simpleString()
    return (
        events.select(F.col(series).alias("series"), F.col(ts).alias("ts")).withWatermark("ts", late).groupBy("series")
        .transformWithStateInPandas(
            statefulProcessor=_Absence(width_s * 1000, start), outputStructType=f"series {kind}, start timestamp", outputMode="Append", timeMode="EventTime",
            initialState=expected.select(F.col(series).alias("series")).distinct().groupBy("series"),
        )
        .withColumnRenamed("series", series)
    )


class _Held(StatefulProcessor):
    """For how many steps without a gap one rule's condition has held."""

    def __init__(self, steps: int, every_s: int, columns: list[str]):
        self.steps, self.every_s, self.columns = steps, every_s, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("run", "last bigint, run bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, run = self.state.get() if self.state.exists() else (-1, 0)
        steps = pd.concat(list(rows)).sort_values("at")
        firing = []
        for at, bad in zip(steps["at"].tolist(), steps["bad"].tolist()):
            run = (run + 1 if last >= 0 and at - last == self.every_s else 1) if bad else 0
            last = at
            firing.append(run > self.steps)
        self.state.update((last, run))
        yield steps[self.columns].assign(firing=firing)

    def close(self) -> None:
        pass


def held_stream(windows: DataFrame, condition: Column, steps: int, every_s: int, by: str | None = None, end: str = "end") -> DataFrame:
    """windows with firing: the condition held in this step and in so many before, without a gap. windows is a stream of closed
    windows, as a windowed aggregate in append mode gives them: in order from batch to batch. Twin: metrics.held.

    by: a column that tells rules apart; one state row per rule.
    """
    rule = F.col(by).cast("string") if by else F.lit("")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in windows.schema)
    flagged = windows.select(rule.alias("_x_rule"), F.unix_seconds(F.col(end).cast("timestamp")).alias("at"), F.coalesce(condition, F.lit(False)).alias("bad"), *windows.columns)
    return flagged.groupBy("_x_rule").transformWithStateInPandas(
        statefulProcessor=_Held(steps, every_s, windows.columns), outputStructType=f"{fields}, firing boolean", outputMode="Append", timeMode="None"
    )


def throughput_collapse(
    done: DataFrame, backlog: DataFrame, least_rate: float, most_backlog: float, width: str = "15 minutes", late_done: str = "5 minutes", late_backlog: str = "5 minutes"
) -> DataFrame:
    """(start, rate, backlog, firing) of tumbling windows: finished items a second beside the summed last gauges of all sources.

    done: (ts) of finished items; backlog: gauges (ts, source, value). Two streams with watermarks of their own, joined on the
    window; a window without any finished item has rate 0, as a collapse is just that. Streams and tables alike: a table is
    the twin of a stream, which leaves out what comes later than the watermarks.
    """
    seconds = pd.Timedelta(width).total_seconds()
    if done.isStreaming:
        done, backlog = done.withWatermark("ts", late_done), backlog.withWatermark("ts", late_backlog)
    rates = done.groupBy(F.window("ts", width).alias("w")).agg(F.count(F.lit(1)).alias("n")).select("w", "n")
    per_source = backlog.groupBy(F.window("ts", width).alias("w"), "source").agg(F.max_by("value", F.struct("ts", "value")).alias("value"))
    waiting = per_source.groupBy("w").agg(F.sum("value").alias("backlog")).select("w", "backlog")
    rate = F.coalesce(F.col("n"), F.lit(0)) / seconds
    both = waiting.join(rates, "w", "left_outer")
    return both.select(F.col("w.start").alias("start"), rate.alias("rate"), "backlog", ((rate < least_rate) & (F.col("backlog") > most_backlog)).alias("firing"))

