"""Asset versions (name, directory, rank, time): what is superseded, redundant or still to be done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.kept import KeptTable

#: Suffixes of marker files.
MARKERS = ("failed", "not_found", "unresolved", "unavailable", "invalid")


def is_marker(name: Column) -> Column:
    return name.rlike(r"\.(" + "|".join(MARKERS) + ")$")


def name_parts(name: Column, prefixes: tuple[str, ...]) -> Column:
    """struct(prefix, ident) by the longest prefix that fits; both null where none does."""
    found = F.lit(None).cast("string")
    for p in sorted(prefixes, key=len):
        found = F.when(name.startswith(p), p).otherwise(found)
    ident = F.regexp_replace(F.substr(name, F.char_length(found) + 1), r"\.json\.br(\..*)?$", "")
    return F.struct(found.alias("prefix"), F.when(found.isNotNull(), ident).alias("ident"))


def work_entry(name: Column) -> Column:
    """struct(video_id, prefix, needs_scraping) of a record file name."""
    prefix = F.regexp_extract(name, r"^(video-min-|video-dlp-).*\.json\.br$", 1)
    ident = F.regexp_extract(name, r"^(?:video-min-|video-dlp-)(.*)\.json\.br$", 1)
    return F.when(prefix != "", F.struct(ident.alias("video_id"), prefix.alias("prefix"), (prefix == "video-min-").alias("needs_scraping")))


def is_bare_id(name: Column) -> Column:
    return name.rlike("^[A-Za-z0-9_-]{11}$")


def superseded(base: DataFrame, uploaded: DataFrame) -> DataFrame:
    """Base rows with an uploaded copy of equal or higher rank that is not older."""
    return base.join(*_covered(base, uploaded), "left_semi")


def _covered(base: DataFrame, uploaded: DataFrame) -> tuple[DataFrame, Column]:
    """The newest uploaded copy of every identifier and rank, one row each, and when it covers a base row."""
    u = uploaded.groupBy("ident", F.col("prefix_rank").alias("_r")).agg(F.max("mtime").alias("_m"))
    return u, (base["ident"] == u["ident"]) & (F.col("_r") >= base["prefix_rank"]) & (F.col("_m") >= base["mtime"])


def newer_uploaded(base: DataFrame, uploaded: DataFrame) -> DataFrame:
    """Base rows whose uploaded namesake is strictly newer: their base copy can go."""
    u = uploaded.groupBy("ident", "prefix_rank").agg(F.max("mtime").alias("_m"))
    return base.join(u, ["ident", "prefix_rank"]).filter("_m > mtime").select(*base.columns)


def without_higher(rows: DataFrame, all_rows: DataFrame, rank: int) -> DataFrame:
    """Rows whose identifier has no version of at least the rank, in any directory."""
    return rows.join(all_rows.filter(F.col("prefix_rank") >= rank).select("ident").distinct(), "ident", "left_anti")


def promote_bare(markers: DataFrame, records: DataFrame) -> DataFrame:
    """(ident, outcome): promoted when no record exists, else redundant."""
    have = records.select("ident", F.lit(True).alias("_have")).distinct()
    return markers.select("ident").distinct().join(have, "ident", "left").select("ident", F.when(F.col("_have"), "redundant").otherwise("promoted").alias("outcome"))


def existing_artefact(ids: DataFrame, names: DataFrame, key: str = "video_id") -> DataFrame:
    """(id, artefact) of ids with a record or a sentinel among the file names: video-min before video-dlp before the bare id."""
    rank = F.when(F.col("name").startswith("video-min-"), 0).when(F.col("name").startswith("video-dlp-"), 1).otherwise(2)
    ident = F.when(is_bare_id(F.col("name")), F.col("name")).otherwise(work_entry(F.col("name"))["video_id"])
    found = names.select(ident.alias(key), rank.alias("_rank"), "name").filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by("name", "_rank").alias("artefact"))
    return ids.select(key).join(found, key)


def fresh(assets: DataFrame, uploaded: DataFrame) -> DataFrame:
    """Asset versions that no uploaded copy supersedes."""
    return assets.join(*_covered(assets, uploaded), "left_anti")


def best_status(assets: DataFrame) -> DataFrame:
    """(ident, status, mtime): uploaded beats scraped, then the newest."""
    best = F.max(F.struct((F.col("dir") == "uploaded").alias("up"), "mtime")).alias("b")
    return assets.groupBy("ident").agg(best).select("ident", F.when(F.col("b.up"), "UPLOADED").otherwise("SCRAPED").alias("status"), F.col("b.mtime").alias("mtime"))


def stale_lower(assets: DataFrame, or_equal_rank: bool = False) -> DataFrame:
    """Versions to delete: of lower rank (or equal, after a write) than the best of their identifier, and strictly older."""
    best = assets.groupBy("ident").agg(F.max(F.struct("prefix_rank", "mtime")).alias("_b"))
    lower = (F.col("prefix_rank") <= F.col("_b.prefix_rank")) if or_equal_rank else (F.col("prefix_rank") < F.col("_b.prefix_rank"))
    return assets.join(best, "ident").filter(lower & (F.col("mtime") < F.col("_b.mtime"))).select(*assets.columns)


def current_status(events: DataFrame, key: str = "ident", order: str = "ts") -> DataFrame:
    """Current lifecycle status of every key of a status-event table."""
    return events.groupBy(key).agg(F.max_by("status", F.struct(order, "status")).alias("status"))


#: What a mark can say of an asset.
STATUSES = ("uploaded", "failed", "unavailable", "invalid", "not_found", "unresolved")
MARKS = "ident string, status string, reason string, at bigint"


def mark(table: KeptTable, marks: DataFrame) -> int:
    """Write marks (ident, status, reason, at) to a kept table of MARKS by ident: the newest of an asset stays, with equal times the
    greater status. Marks with another status are left out. Marks stand beside the assets' own rows and replace none of them."""
    by = F.struct("at", "status", "reason")

    def fold(old: DataFrame, delta: DataFrame) -> DataFrame:
        every = old.unionByName(delta.select(*old.columns))
        return every.groupBy("ident").agg(F.max(by).alias("_m")).select("ident", "_m.status", "_m.reason", "_m.at")

    return table.merge(marks.filter(F.col("status").isin(*STATUSES) & F.col("ident").isNotNull()), fold)


def failure_is_stale(marker: Column, uploaded: Column, base: Column) -> Column:
    """A failure marker counts no more once there is an uploaded copy or a base file that is newer."""
    return uploaded.isNotNull() | F.coalesce(base > marker, F.lit(False))


def skip_action(failed: Column, stale: Column, uploaded: Column, is_superseded: Column, reupload: Column) -> Column:
    return (
        F.when(failed & ~stale, "skip_failed").when(is_superseded & ~reupload, "skip_superseded").when(uploaded & ~reupload, "skip_uploaded")
        .when(uploaded & reupload, "reupload").otherwise("process")
    )


def retire_action(origin: Column) -> Column:
    """What becomes of a source file whose processing failed."""
    return F.when(origin == "priority", "keep").when(origin == "uploaded", "delete").otherwise("mark_failed")


def workload(base: DataFrame, uploaded: DataFrame, low: int = 0, high: int = 1) -> DataFrame:
    """Work rows with their origin: base rows of low rank, uploaded rows of low rank, base rows of high rank; low-ranked rows
    with a high-ranked version anywhere and superseded base rows are left out."""
    every = base.unionByName(uploaded)
    base_low = without_higher(base.filter(F.col("prefix_rank") == low), every, high).withColumn("origin", F.lit("base_low"))
    up_low = without_higher(uploaded.filter(F.col("prefix_rank") == low), every, high).withColumn("origin", F.lit("uploaded_low"))
    base_high = base.filter(F.col("prefix_rank") == high).withColumn("origin", F.lit("base_high"))
    live = base_low.unionByName(base_high)
    live = live.join(*_covered(live, uploaded), "left_anti")
    return live.unionByName(up_low)


def ordered_work(work: DataFrame, priority: Column, key: str, seed: int) -> DataFrame:
    """Priority items first, by name; the others in an order that the seed fixes."""
    return work.orderBy(F.desc(priority), F.when(priority, F.col(key)), F.xxhash64(F.lit(seed), F.col(key)), F.col(key))
