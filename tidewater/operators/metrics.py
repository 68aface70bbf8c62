"""Counters, histograms, streaks, gauges and alert conditions over event logs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .lineage import checkpointed

#: Upper bounds of the latency histogram, in seconds.
BUCKETS = (0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0)


def histogram(events: DataFrame, value: str, buckets: tuple[float, ...] = BUCKETS) -> DataFrame:
    """(le, n): cumulative counts by upper bound, all bounds in one pass."""
    counts = events.agg(*[F.count_if(F.col(value) <= b).alias(f"b{i}") for i, b in enumerate(buckets)])
    pairs = F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(buckets)])
    return counts.select(F.inline(pairs))


def labelled_counts(events: DataFrame, *labels: str) -> DataFrame:
    return events.cube(*labels).agg(F.count(F.lit(1)).alias("n"), *[F.grouping(c).cast("int").alias(f"all_{c}") for c in labels])


def failure_runs(events: DataFrame, ok: str = "ok", key: str = "key", order: tuple[str, ...] = ("ts", "event_id"), ignore: Column | None = None) -> DataFrame:
    """events with streak: failures in a row up to each event of its key, 0 at a success; ignored events repeat the streak before."""
    w = Window.partitionBy(key).orderBy(*order)
    bad = ~F.col(ok) if ignore is None else ~F.col(ok) & ~ignore
    island = events.withColumn("_i", F.sum(F.col(ok).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.withColumn("streak", F.sum(bad.cast("int")).over(Window.partitionBy(key, "_i").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).drop("_i")


def failures_with_ttl(events: DataFrame, ttl_s: int, key: str = "key", ts: str = "ts", tie: str = "event_id", ok: str = "ok") -> DataFrame:
    """events with failures: those of a key since its last success, forgotten when none came for ttl_s."""
    w = Window.partitionBy(key).orderBy(ts, tie)
    seconds = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    since = seconds - F.lag(seconds).over(w)
    island = events.withColumn("_i", F.sum((F.col(ok) | (F.coalesce(since, F.lit(0.0)) > ttl_s)).cast("int")).over(w))
    count = F.sum((~F.col(ok)).cast("bigint")).over(Window.partitionBy(key, "_i").orderBy(ts, tie))
    return island.withColumn("failures", count).drop("_i")


def breaker(streaks: DataFrame, threshold: int = 5, least: float = 60.0, most: float = 3600.0) -> DataFrame:
    """streaks with opens (times the breaker opened in the run so far) and cooldown seconds, doubled at each opening."""
    opens = F.floor(F.col("streak") / threshold).cast("int")
    return streaks.withColumn("opens", opens).withColumn("cooldown_s", F.when(opens > 0, F.least(F.lit(least) * F.pow(F.lit(2.0), opens - 1), F.lit(most))).otherwise(0.0))


def claim_step(holder: tuple[str | None, int], now: int, op: str, owner: str, ttl_ms: int) -> tuple[tuple[str | None, int], bool]:
    """(holder and end of the claim, granted) after an event: a claim is granted while nobody holds the resource, a release to its holder."""
    current, until = holder
    if op == "release":
        granted = current == owner and now < until
        return ((None, 0) if granted else holder), granted
    granted = current is None or now >= until
    return ((owner, now + ttl_ms) if granted else holder), granted


def audit_claims(events: DataFrame, ttl_s: int = 600) -> DataFrame:
    """(resource, event_id, granted) of claim and release events (resource, event_id, ts, op, owner), the batch twin of the stream's audit.
    Events are sorted by resource and time inside partitions and stream through their task, which keeps one holder."""
    slim = events.select("resource", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), "event_id", "op", "owner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, holder = object(), (None, 0)
        for batch in batches:
            granted = []
            for resource, ms, op, owner in zip(*(batch.column(n).to_pylist() for n in ("resource", "ms", "op", "owner"))):
                if resource != current:
                    current, holder = resource, (None, 0)
                holder, won = claim_step(holder, ms, op, owner, ttl_s * 1000)
                granted.append(won)
            yield pa.RecordBatch.from_arrays([batch.column("resource"), batch.column("event_id"), pa.array(granted, pa.bool_())], names=["resource", "event_id", "granted"])

    kind = events.schema["resource"].dataType.simpleString()
    return slim.repartition("resource").sortWithinPartitions("resource", "ms", "event_id").mapInArrow(run, f"resource {kind}, event_id bigint, granted boolean")


def backoff(streak: Column, first: float = 60.0, most: float = 300.0) -> Column:
    return F.when(streak > 0, F.least(F.lit(first) * F.pow(F.lit(2.0), streak - 1), F.lit(most))).otherwise(0.0)


def novelty_cut(pages: DataFrame, stop_after: int = 3, source: str = "source", page: str = "page", value: str = "value") -> DataFrame:
    """(source, page, new) of the pages that are read: up to the third page in a row without a value not seen before."""
    first = pages.groupBy(source, value).agg(F.min(page).alias(page)).groupBy(source, page).agg(F.count(F.lit(1)).alias("new"))
    per = pages.select(source, page).distinct().join(first, [source, page], "left").select(source, page, F.coalesce("new", F.lit(0)).alias("new"))
    w = Window.partitionBy(source).orderBy(page)
    island = per.withColumn("_i", F.sum((F.col("new") > 0).cast("int")).over(w))
    dry = island.withColumn("_d", F.sum((F.col("new") == 0).cast("int")).over(Window.partitionBy(source, "_i").orderBy(page)))
    stop = dry.withColumn("_s", F.min(F.when(F.col("_d") >= stop_after, F.col(page))).over(Window.partitionBy(source)))
    return stop.filter(F.col("_s").isNull() | (F.col(page) <= F.col("_s"))).select(source, page, "new")


def first_mentions(mentions: DataFrame, item: str, source: str, *order: str) -> DataFrame:
    """(item, source, depth, mentions, repeats): where each item was mentioned first, by order and then by source, at what depth (the first
    column of order), how often in all, and how often by a source that had mentioned it before."""
    out = mentions.groupBy(item, source).agg(F.min(F.struct(*order, source)).alias("_f"), F.count(F.lit(1)).alias("_n"))  # merged per pair first: an item can be in a third of all rows
    per = out.groupBy(item).agg(F.min("_f").alias("_f"), F.sum("_n").alias("mentions"), F.sum(F.col("_n") - 1).alias("repeats"))
    return per.select(item, F.col(f"_f.{source}").alias(source), F.col(f"_f.{order[0]}").alias("depth"), "mentions", "repeats")


def shard(df: DataFrame, n: int, *order: str) -> DataFrame:
    """Round-robin shards over a total order, without one task for the whole table: ranks start from counts of range partitions."""
    # the partition of a row is written down once: two reads of the plan could be coalesced differently
    ranged = checkpointed(df.repartitionByRange(df.sparkSession.sparkContext.defaultParallelism * 4, *order).withColumn("_p", F.spark_partition_id()))
    w = Window.partitionBy("_p").orderBy(*order)
    local = ranged.withColumn("_r", F.row_number().over(w))
    sizes = local.groupBy("_p").agg(F.max("_r").alias("_n"))
    before = sizes.withColumn("_b", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_b")
    return local.join(before, "_p").withColumn("shard", F.pmod(F.col("_r") + F.col("_b") - 1, F.lit(n)).cast("int")).drop("_p", "_r", "_b")


def gauges(df: DataFrame, key: str, ts: str) -> DataFrame:
    """Long form of every numeric *_count column: (key, ts, metric, value, delta, latest)."""
    names = gauge_names(df)
    long = df.unpivot([key, ts], names, "metric", "value").filter("value is not null")
    w = Window.partitionBy(key, "metric").orderBy(ts)
    return long.withColumn("delta", F.col("value") - F.lag("value").over(w)).withColumn("latest", F.row_number().over(Window.partitionBy(key, "metric").orderBy(F.desc(ts))) == 1)


def gauge_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if f.name.endswith("_count") and f.dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal")]


def ratio_windows(events: DataFrame, ok: str = "ok", ts: str = "ts", width: str = "15 minutes", every: str = "5 minutes") -> DataFrame:
    """(end, n, good, ratio) of sliding windows."""
    w = events.groupBy(F.window(ts, width, every).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(ok)).alias("good"))
    return w.select(F.col("w.end").alias("end"), "n", "good", (F.col("good") / F.col("n")).alias("ratio"))


def held(windows: DataFrame, condition: Column, steps: int, every_s: int, end: str = "end") -> DataFrame:
    """windows with firing: the condition held in this and the steps before, without a gap. The series of one rule is small:
    one row per evaluation step."""
    w = Window.orderBy(end)
    flagged = windows.withColumn("_c", condition).withColumn("_t", F.unix_seconds(F.col(end).cast("timestamp")))
    broken = F.when(F.col("_c") & (F.lag("_c").over(w)) & (F.col("_t") - F.lag("_t").over(w) == every_s), 0).otherwise(1)
    island = flagged.withColumn("_i", F.sum(broken).over(w))
    run = F.row_number().over(Window.partitionBy("_i").orderBy(end))
    return island.withColumn("firing", F.col("_c") & (run > steps)).drop("_c", "_t", "_i")


def absent(expected: DataFrame, events: DataFrame, series: str, ts: str = "ts", width: str = "1 hour") -> DataFrame:
    """(series, start) of the windows in which an expected series has no event; windows run over the log's whole span."""
    seconds = events.sparkSession.sql(f"SELECT CAST(unix_seconds(TIMESTAMP '1970-01-01' + INTERVAL {width}) AS BIGINT)").first()[0]
    span = events.agg(F.floor(F.unix_seconds(F.min(ts).cast("timestamp")) / seconds).alias("lo"), F.floor(F.unix_seconds(F.max(ts).cast("timestamp")) / seconds).alias("hi"))
    seen = events.select(series, F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / seconds).alias("slot")).distinct()
    # one row per expected series and window, made where the series lie: span is one row
    grid = expected.select(series).distinct().crossJoin(F.broadcast(span)).select(series, F.explode(F.sequence("lo", "hi")).alias("slot"))
    return grid.join(seen, [series, "slot"], "left_anti").select(series, F.timestamp_seconds(F.col("slot") * seconds).cast("timestamp_ntz").alias("start"))

