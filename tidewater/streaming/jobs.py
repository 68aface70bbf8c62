"""Structured Streaming jobs. Each takes a streaming or batch DataFrame, so a batch run over the same rows is its check."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import web as W
from ..operators.metrics import claim_step


def read_events(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    """JSON event files as a stream; the number of files per trigger is the back-pressure."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def filter_messages(messages: DataFrame, platform: str | None = None, entity: str | None = None, owner: str | None = None, version: str | None = None) -> DataFrame:
    """Messages (data struct with platform, entity, data_url) that meet all given filters."""
    url = W.data_url(F.col("data.data_url"))
    for want, have in ((platform, F.col("data.platform")), (entity, F.col("data.entity")), (owner, url["owner"]), (version, url["version"])):
        if want is not None:
            messages = messages.filter(have == want)
    return messages


def sla_windows(rows: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(start, tier, on_time, overdue) of tumbling windows over (ts, tier, ok)."""
    if rows.isStreaming:
        rows = rows.withWatermark("ts", late)
    out = rows.groupBy(F.window("ts", width).alias("w"), "tier").agg(F.count_if("ok").alias("on_time"), F.count_if(~F.col("ok")).alias("overdue"))
    return out.select(F.col("w.start").alias("start"), "tier", "on_time", "overdue")


def success_ratio(rows: DataFrame, width: str = "15 minutes", every: str = "30 seconds", late: str = "5 minutes") -> DataFrame:
    """(end, n, good) of sliding windows over (ts, ok)."""
    out = rows.withWatermark("ts", late).groupBy(F.window("ts", width, every).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("good"))
    return out.select(F.col("w.end").alias("end"), "n", "good")


def first_claims(claims: DataFrame, late: str = "1 hour") -> DataFrame:
    """Claims without release: the first claim of a resource inside the watermark's span."""
    return claims.withWatermark("ts", late).dropDuplicatesWithinWatermark(["resource"])


def ever_had_feed(rows: DataFrame) -> DataFrame:
    """Sticky flag: each creator once, at its first success. Its state is the set of creators that ever had a feed, and is meant to grow with them."""
    return rows.filter("ok").select("key").dropDuplicates(["key"])


class _Timed(StatefulProcessor):
    """State of one key that ends: apply() folds the events in event order and says until when the state can matter. A timer at
    that time forgets it once the watermark has passed; a state that can't matter any more is forgotten at once."""

    columns: list[str]
    fields: str

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.fields)

    def apply(self, state: tuple | None, row) -> tuple[tuple | None, tuple]:
        """(state after an event, or None if it equals that of an unknown key; what to put out beside key and event)."""
        raise NotImplementedError

    def ends(self, state: tuple) -> int | None:
        """Milliseconds of event time from which on the state is that of an unknown key; None: it has no end."""
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        state = self.state.get() if self.state.exists() else None
        out = []
        for r in pd.concat(list(rows)).sort_values(["ts", "event_id"]).itertuples():
            state, told = self.apply(state, r)
            out.append((key[0], r.event_id, *told))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if state is None:
            self.state.clear()
        else:
            self.state.update(state)
            if (end := self.ends(state)) is not None:
                self.handle.registerTimer(end)
        yield pd.DataFrame(out, columns=self.columns)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def _millis(row) -> int:
    return row.ts.value // 1_000_000


def _keyed(rows: DataFrame, key: str, late: str, processor: _Timed, schema: str) -> DataFrame:
    """The processor over rows by key, in event time: rows later than the watermark are left out."""
    return rows.withWatermark("ts", late).groupBy(key).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime")


class _Breaker(_Timed):
    """Failures in a row, openings and the cooldown of one key."""

    columns, fields = ["key", "event_id", "streak", "opens", "cooldown_s"], "run bigint, last bigint"

    def __init__(self, threshold: int, least: float, most: float, forget_ms: int | None):
        self.threshold, self.least, self.most, self.forget_ms = threshold, least, most, forget_ms

    def apply(self, state, row):
        run, last = state or (0, 0)
        now = _millis(row)
        if self.forget_ms is not None and now - last > self.forget_ms:
            run = 0
        run = 0 if row.ok else run + 1
        opens = run // self.threshold
        return (run, now) if run else None, (run, opens, min(self.least * 2.0 ** (opens - 1), self.most) if opens else 0.0)

    def ends(self, state):
        return None if self.forget_ms is None else state[1] + self.forget_ms + 1


def breaker_stream(rows: DataFrame, threshold: int = 5, least: float = 60.0, most: float = 3600.0, forget_s: int | None = 7 * 86_400, late: str = "1 hour") -> DataFrame:
    """(key, event_id, streak, opens, cooldown_s) for (key, event_id, ts, ok). A success forgets the key, and so does a silence of more
    than forget_s. The batch twin is metrics.breaker over metrics.failure_runs (forget_s None) or metrics.failures_with_ttl."""
    forget = None if forget_s is None else forget_s * 1000
    return _keyed(rows, "key", late, _Breaker(threshold, least, most, forget), "key bigint, event_id bigint, streak bigint, opens int, cooldown_s double")


class _FailureCount(_Timed):
    """Failures of one key since its last success; forgotten when none came for the time to live."""

    columns, fields = ["key", "event_id", "failures"], "n bigint, last bigint"

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def apply(self, state, row):
        n, last = state or (0, 0)
        now = _millis(row)
        n = 0 if row.ok else (n if now - last <= self.ttl_ms else 0) + 1
        return (n, now) if n else None, (n,)

    def ends(self, state):
        return state[1] + self.ttl_ms + 1


def failure_counts(rows: DataFrame, ttl_s: int = 86_400, late: str = "1 hour") -> DataFrame:
    """(key, event_id, failures): the count is refreshed by each failure, cleared by a success, and expires after ttl_s of event time.
    State is kept for keys that failed within ttl_s. The batch twin is metrics.failures_with_ttl."""
    return _keyed(rows, "key", late, _FailureCount(ttl_s * 1000), "key bigint, event_id bigint, failures bigint")


class _Claims(_Timed):
    """Who holds a resource: the first claimant until a release or the end of the time to live."""

    columns, fields = ["resource", "event_id", "granted"], "owner string, until bigint"

    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def apply(self, state, row):
        (owner, until), granted = claim_step(state or (None, 0), _millis(row), row.op, row.owner, self.ttl_ms)
        return (owner, until) if owner is not None else None, (granted,)

    def ends(self, state):
        return state[1]


def audit_claims(rows: DataFrame, ttl_s: int = 600, late: str = "1 hour") -> DataFrame:
    """(resource, event_id, granted) for claim and release events (resource, event_id, ts, op, owner). State is kept for resources
    that are held. The batch twin is metrics.audit_claims."""
    return _keyed(rows, "resource", late, _Claims(ttl_s * 1000), "resource bigint, event_id bigint, granted boolean")


def watch_assets(assets: DataFrame, uploaded: DataFrame, hand_on: Callable[[DataFrame, int], None], checkpoint: str):
    """Start a query that hands on new asset versions, batch by batch, without those superseded by an uploaded one."""
    from ..operators.assets import fresh

    def batch(df: DataFrame, number: int) -> None:
        hand_on(fresh(df, uploaded), number)

    return assets.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def watch_uploads(
    assets: DataFrame, uploaded: DataFrame, prepare: Callable[[DataFrame], DataFrame], hand_on: Callable[[DataFrame, DataFrame, int], None], checkpoint: str,
    shards: int = 8, max_records: int = 1000, max_bytes: int = 200_000_000, every: str | None = None,
):
    """Start a query that prepares new asset versions for upload, batch by batch.

    prepare gets them with a column superseded and adds reason (records.skip_reason; null for what is to be sent) and line.
    hand_on gets the lines to send with shard and batch (records.pack_batches), the outcomes (reason, n) and the batch's number; a
    batch that failed comes again under its number. every: how often to look, or once for what is there."""
    from ..operators.assets import fresh
    from ..operators.records import outcome_counts, pack_batches

    def batch(df: DataFrame, number: int) -> None:
        new = fresh(df, uploaded).select("ident", "prefix_rank", "mtime", F.lit(False).alias("superseded")).distinct()
        flagged = df.join(new, ["ident", "prefix_rank", "mtime"], "left").withColumn("superseded", F.coalesce("superseded", F.lit(True)))
        ready = prepare(flagged)
        send = ready.filter("reason is null").select("ident", "mtime", "line").dropDuplicates(["ident"])
        packed = pack_batches(send, shards, max_records, max_bytes, "ident", "mtime", "line")
        hand_on(send.join(packed, "ident").select("ident", "shard", "batch", "line"), outcome_counts(ready, "reason"), number)

    writer = assets.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
