"""Channel lists: dedupe, clean-up, resolution against maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import channels as C

CLEANUP_CLASSES = (
    "kept_json", "kept_other", "spaces_resolved_handle", "spaces_resolved_channel_id", "spaces_dropped",
    "channel_id_resolved", "channel_id_kept", "url_resolved_handle", "url_kept_channel_id",
)


def latest(log: DataFrame, key: str, value: str, order: str = "seq") -> DataFrame:
    """Last write wins: one row per key of an ordered log."""
    return log.groupBy(key).agg(F.max_by(value, F.struct(order, value)).alias(value))


def dedupe_preserving_case(lines: DataFrame, pos: str = "pos", value: str = "value") -> DataFrame:
    """(pos, value): per dedupe key the best-ranked line, the first among equals, at the place where its key appears first."""
    keyed = lines.select(pos, value, C.dedupe_key(F.col(value)).alias("_key"), C.dedupe_rank(F.col(value)).alias("_rank"))
    best = keyed.groupBy("_key").agg(F.min(pos).alias("_first"), F.max_by(F.struct(pos, value), F.struct("_rank", (-F.col(pos)).alias("_p"))).alias("_best"))
    return best.select(F.col("_first").alias(pos), F.col(f"_best.{value}").alias(value))


def split_header(lines: DataFrame, pos: str = "pos", value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(header, entries): comments and blanks before the first data line are kept, later ones dropped."""
    data = ~C.strip(F.col(value)).startswith("#") & (C.strip(F.col(value)) != "")
    first = lines.filter(data).agg(F.min(pos).alias("_first"))
    header = lines.join(F.broadcast(first), F.col("_first").isNull() | (F.col(pos) < F.col("_first"))).select(*lines.columns)
    return header, lines.filter(data)


def classify_entries(entries: DataFrame, creator_map: DataFrame, name_map: DataFrame, value: str = "value") -> DataFrame:
    """entries with entry_class, class (one of the nine clean-up classes) and result (null when dropped)."""
    kind = C.entry_class(F.col(value))
    ids = entries.withColumn("entry_class", kind).withColumn(
        "_id", F.when(kind == "url", F.when(C.is_channel_id(C.url_canonical(F.col(value))), C.url_canonical(F.col(value)))).when(kind == "channel_id", F.col(value))
    )
    named = ids.join(name_map.select(F.col("title").alias(value), F.col("channel_id").alias("_named")), value, "left")
    named = named.withColumn("_id", F.when(F.col("entry_class") == "display_name", F.col("_named")).otherwise(F.col("_id")))
    joined = named.join(creator_map.select(F.col("channel_id").alias("_id"), F.col("handle").alias("_handle")), "_id", "left")
    e, handle, canonical = F.col("entry_class"), F.col("_handle"), C.url_canonical(F.col(value))
    result = (
        F.when(e == "url", F.coalesce(F.when(F.col("_id").isNull(), canonical), handle, F.col("_id")))
        .when(e == "display_name", F.coalesce(handle, F.col("_id"))).when(e == "channel_id", F.coalesce(handle, F.col(value))).otherwise(F.col(value))
    )
    label = (
        F.when(e == "json", "kept_json").when(e == "other", "kept_other")
        .when(e == "display_name", F.when(F.col("_id").isNull(), "spaces_dropped").when(handle.isNotNull(), "spaces_resolved_handle").otherwise("spaces_resolved_channel_id"))
        .when(e == "channel_id", F.when(handle.isNotNull(), "channel_id_resolved").otherwise("channel_id_kept"))
        .otherwise(F.when(F.col("_id").isNotNull() & handle.isNull(), "url_kept_channel_id").otherwise("url_resolved_handle"))
    )
    return joined.select(*entries.columns, "entry_class", label.alias("class"), result.alias("result"))


def class_counts(classified: DataFrame, classes: tuple[str, ...] = CLEANUP_CLASSES, col: str = "class") -> DataFrame:
    """(class, n) for every class, 0 where it does not occur."""
    base = classified.sparkSession.createDataFrame([(c,) for c in classes], f"{col} string")
    return F.broadcast(base).join(classified.groupBy(col).agg(F.count(F.lit(1)).alias("n")), col, "left").select(col, F.coalesce("n", F.lit(0)).alias("n"))


def clean_list(lines: DataFrame, creator_map: DataFrame, name_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept lines, dropped lines): dedupe, resolve, dedupe again, because resolution makes new duplicates."""
    _, entries = split_header(lines)
    classified = classify_entries(dedupe_preserving_case(entries), creator_map, name_map)
    kept = classified.filter("result is not null").select("pos", F.col("result").alias("value"))
    return dedupe_preserving_case(kept), classified.filter("result is null").select("pos", "value")


def resolve_handles(lines: DataFrame, creator_map: DataFrame) -> DataFrame:
    """(pos, handle, channel_id): parsed lines, ids replaced by known handles, unresolved ids left in channel_id."""
    parsed = lines.select("pos", C.parse_channel_line(F.col("value")).alias("p")).select("pos", F.col("p.handle").alias("_h"), "p.channel_id").filter("_h is not null or channel_id is not null")
    known = parsed.join(creator_map, "channel_id", "left")
    handle = F.coalesce("_h", "handle")
    return known.select("pos", handle.alias("handle"), F.when(handle.isNull(), F.col("channel_id")).alias("channel_id"))


def not_in(df: DataFrame, *others: tuple[DataFrame, str], on: str) -> DataFrame:
    """Rows of df whose key is in none of the other tables."""
    for other, key in others:
        df = df.join(other.select(F.col(key).alias(on)).distinct(), on, "left_anti")
    return df


def select_new(candidates: DataFrame, known: DataFrame, cap: int, budget: int, key: str = "handle", order: str = "pos") -> DataFrame:
    """At most budget (one at least) of the first cap candidates that are not known; the cap comes before the test."""
    taken = candidates.orderBy(order, key).limit(cap)
    return taken.join(known.select(key).distinct(), key, "left_anti").orderBy(order, key).limit(max(budget, 1))


def new_videos(entries: DataFrame, on_disk: DataFrame, on_server: DataFrame, key: str = "video_id") -> DataFrame:
    """Feed entries that are neither on disk nor known to be on the server (key, exists); what the server gave no answer for is new."""
    return not_in(entries, (on_disk, key), (on_server.filter("exists"), key), on=key)


def capped(ids: DataFrame, cap: int, seed: int, key: str) -> DataFrame:
    """At most cap rows, in an order that the seed fixes; the others are deferred to another run."""
    return ids.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(cap)


def read_channels(
    lines: DataFrame, creator_map: DataFrame, resolved: DataFrame, unresolvable: DataFrame, scraped: DataFrame, known: DataFrame,
    max_new: int, max_resolved: int, look_at: int, seed: int = 0,
) -> DataFrame:
    """(handle, pos) of the channels of a list to scrape: header off, one line per channel, lines parsed, ids replaced by known
    handles, at most max_resolved of the others looked up in resolved (channel_id, handle) unless they are marked unresolvable,
    handles scraped already taken out, and at most max_new of the first look_at that are not known."""
    parsed = resolve_handles(dedupe_preserving_case(split_header(lines)[1]), creator_map)
    ids = not_in(parsed.filter("channel_id is not null").groupBy("channel_id").agg(F.min("pos").alias("pos")), (unresolvable, "channel_id"), on="channel_id")
    found = capped(ids, max_resolved, seed, "channel_id").join(resolved.select("channel_id", "handle"), "channel_id").filter("handle <> '' and not contains(handle, ' ')")
    every = parsed.filter("handle is not null").select("handle", "pos").unionByName(found.select("handle", "pos"))
    first = every.groupBy("handle").agg(F.min("pos").alias("pos"))
    return select_new(not_in(first, (scraped, "handle"), on="handle"), known, look_at, max_new)


def resolution_outcome(ids: DataFrame, creator_map: DataFrame, markers: DataFrame, resolved: DataFrame) -> DataFrame:
    """(channel_id, outcome, handle): already_resolved, unresolvable (marked, empty or with a blank) or resolved."""
    joined = (
        ids.join(creator_map.select("channel_id", F.col("handle").alias("_known")), "channel_id", "left")
        .join(markers.select("channel_id", F.lit(True).alias("_marked")).distinct(), "channel_id", "left")
        .join(resolved.select("channel_id", F.col("handle").alias("_new")), "channel_id", "left")
    )
    good = (F.coalesce("_new", F.lit("")) != "") & ~F.col("_new").contains(" ")
    outcome = F.when(F.coalesce("_known", F.lit("")) != "", "already_resolved").when(F.col("_marked") | ~good, "unresolvable").otherwise("resolved")
    return joined.select("channel_id", outcome.alias("outcome"), F.when(outcome == "already_resolved", F.col("_known")).when(outcome == "resolved", F.col("_new")).alias("handle"))


def handle_set(creator_map: DataFrame, col: str = "handle") -> DataFrame:
    return creator_map.select(F.lower(F.regexp_replace(F.col(col), "^@+", "")).alias("handle")).distinct()


def map_rows(discovered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id -> handle rows, title -> id rows) of discovered records; only targets that are handles make the first."""
    is_handle = ~C.is_id_path(F.col("channel")) & ~C.is_channel_id(F.col("channel"))
    return (
        discovered.filter(is_handle & F.col("channel_id").isNotNull()).select("channel_id", F.col("channel").alias("handle")),
        discovered.filter("channel_title is not null and channel_id is not null").select(F.col("channel_title").alias("title"), "channel_id"),
    )


def upsert(snapshot: DataFrame, updates: DataFrame, key: str, order: str = "seq") -> DataFrame:
    """Snapshot with updates merged in: per key the row of the greatest order; updates win ties."""
    both = snapshot.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    w = Window.partitionBy(key).orderBy(F.desc("_new"), F.desc(order))
    return both.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_new")


def membership(keys: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """keys with a column member."""
    return keys.join(known.select(key, F.lit(True).alias("member")).distinct(), key, "left").withColumn("member", F.coalesce("member", F.lit(False)))


def label_lookup(df: DataFrame, dim: DataFrame, key: Column, dim_key: str) -> DataFrame:
    """Left join with a dimension table, whose size Spark checks before it broadcasts it."""
    return df.join(dim, F.lower(key) == F.lower(F.col(dim_key)), "left")
