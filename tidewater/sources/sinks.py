"""Sinks: appends, exports, snapshots. All writes go through Spark's committers, so a retried task leaves no half file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.imports import completeness


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def export_map(creator_map: DataFrame, path: str) -> None:
    """'id,handle' lines, ordered by handle without regard to case."""
    creator_map.select("channel_id", "handle").orderBy(F.lower("handle"), "handle", "channel_id").write.mode("overwrite").csv(path)


def no_feed_snapshot(no_feeds: DataFrame, path: str) -> None:
    """Tab-separated, the most failures first."""
    no_feeds.select("creator_id", "url", "name", "count").orderBy(F.desc("count"), "creator_id").write.mode("overwrite").option("sep", "\t").csv(path)


def queue_snapshot(queue: DataFrame, rows_per_line: int = 10_000) -> DataFrame:
    """(tier, part, rows): JSON lists of [due, name, id]; a tier has as many parts as keep a line at about rows_per_line entries."""
    entry = F.array(F.col("due_ts").cast("string"), F.col("name"), F.col("creator_id"))
    parts = queue.groupBy("tier").agg(F.ceil(F.count(F.lit(1)) / rows_per_line).alias("_parts"))
    part = F.pmod(F.xxhash64("creator_id"), F.col("_parts"))
    return queue.join(parts, "tier").groupBy("tier", part.alias("part")).agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("rows")).select("tier", "part", "rows")


def import_videos(videos: DataFrame, path: str, formats: str | None = None) -> None:
    """Video records by completeness class; those below the bar go to below_bar."""
    label = F.coalesce(completeness(F.col(formats) if formats else None), F.lit("below_bar"))
    videos.withColumn("classification", label).write.mode("append").partitionBy("classification").parquet(path)


def rewrite_list(header: DataFrame, entries: DataFrame, n_before: int, path: str) -> bool:
    """Write header and entries as text, only when entries were dropped: ordered ranges, one part file each, in the order of their names."""
    if entries.count() >= n_before:
        return False
    ordered = header.select("pos", "value").withColumn("_part", F.lit(0)).unionByName(entries.select("pos", "value").withColumn("_part", F.lit(1)))
    ordered.orderBy("_part", "pos").select("value").write.mode("overwrite").text(path)
    return True


def append_dropped(dropped: DataFrame, path: str) -> None:
    dropped.select("value").write.mode("append").text(path)


def import_outcomes(info: DataFrame, existing: DataFrame, error: str = "error") -> DataFrame:
    """info with outcome: error, skipped (the id is there already) or written."""
    have = existing.select("video_id", F.lit(True).alias("_have")).distinct()
    joined = info.join(have, "video_id", "left")
    return joined.withColumn("outcome", F.when(F.col("video_id").isNull() | F.col(error).isNotNull(), "error").when(F.col("_have"), "skipped").otherwise("written")).drop("_have")
