"""Channel facts joined to videos under conflict rules."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.kept import KeptTable
from .lineage import stored
from .segments import fold_long

FACTS = ("channel_id", "channel_handle", "verified", "subscriber_count")


def only_known(links: DataFrame, videos: DataFrame, key: str = "video_id") -> DataFrame:
    """Links to videos that exist: reduces the links before anything is folded."""
    return links.join(videos.select(key).distinct(), key, "left_semi")


def channel_facts(channels: DataFrame) -> DataFrame:
    """Mapping rows of channel records: a handle is needed, negative counts become null, the URL is canonical."""
    subs = F.when(F.col("subscriber_count") >= 0, F.col("subscriber_count"))
    return channels.filter("channel_handle is not null").withColumn("subscriber_count", subs).withColumn("channel_url", F.concat(F.lit("https://www.youtube.com/@"), "channel_handle"))


#: A log of more than a thousandth of all links, and of more than so many, is folded in segments of about so many.
LONG = 100_000


def fold_mapping(links: DataFrame, key: str = "video_id", order: tuple[str, ...] = ("mtime", "seq"), long: int = LONG) -> DataFrame:
    """(key, facts, collisions): a video's channels in time order; the same channel refreshes its facts, another one wins when it is
    verified, else VEVO, else larger, where the present one is not. The fold depends on the order, so it is no argmax. Rows are
    sorted by video and time inside partitions and stream through their task, which keeps the present holder of one video only;
    a video's log is never collected. Long logs, of which there are a thousand at most, are cut into segments that are folded
    apart (segments.fold_long). Ties in the order are broken by the facts."""
    slim = links.select(key, *order, *FACTS)
    total = slim.count()
    if total > long:
        most = max(long, total // 1000)
        logs = slim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).collect()  # fewer than a thousand
        if logs:
            named = F.broadcast(slim.sparkSession.createDataFrame([(r[0],) for r in logs], slim.select(key).schema))
            folded = fold_long(slim.join(named, key, "left_semi"), key, order, FACTS, sum(r.n for r in logs) // most + 1)
            return _fold_short(slim.join(named, key, "left_anti"), key, order).unionByName(folded)
    return _fold_short(slim, key, order)


def _fold_short(slim: DataFrame, key: str, order: tuple[str, ...]) -> DataFrame:
    """fold_mapping for logs that one task each streams through."""
    names = [key, *FACTS]

    def rank(facts: tuple) -> tuple:
        return bool(facts[2]), (facts[1] or "").upper().endswith("VEVO"), facts[3] or 0

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, holder, best, collisions = None, None, None, 0  # current: (key,) of the video; best: the holder's rank, once it is asked for
        for batch in batches:
            done = []
            for k, *facts in zip(*(batch.column(n).to_pylist() for n in names)):
                if current != (k,):
                    if current is not None:
                        done.append((*current, *holder, collisions))
                    current, holder, best, collisions = (k,), facts, None, 0
                elif facts[0] == holder[0]:
                    holder, best = facts, None
                else:
                    collisions += 1
                    best, own = best or rank(holder), rank(facts)
                    if own > best:
                        holder, best = facts, own
            yield batch_of(done, batch.schema)
            schema = batch.schema
        if current is not None:
            yield batch_of([(*current, *holder, collisions)], schema)

    def batch_of(done: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * (len(names) + 1)
        kinds = [*(schema.field(n).type for n in names), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, kinds)], names=[*names, "collisions"])

    of = ", ".join(f"`{n}` {slim.schema[n].dataType.simpleString()}" for n in names)
    ordered = slim.repartition(key).sortWithinPartitions(key, *order, *FACTS)
    return ordered.select(*names).mapInArrow(fold, of + ", collisions bigint")


def newest(records: DataFrame, key: str, mtime: str) -> DataFrame:
    """One record per key, that of the newest file; ties by the other columns."""
    rest = [c for c in records.columns if c not in (key, mtime)]
    return records.groupBy(key).agg(F.max(F.struct(mtime, *rest)).alias("_r")).select(key, "_r.*")


def augment(videos: DataFrame, mapping: DataFrame, key: str = "video_id", error: str | None = None) -> DataFrame:
    """videos with empty or stale channel fields filled, and outcome: updated, noop, no_mapping or, where the column error
    says that a record could not be read, error; such a record stays as it is."""
    bad = F.lit(False) if error is None else F.col(error).isNotNull()
    m = mapping.select(F.col(key), *[F.col(c).alias(f"_{c}") for c in (*FACTS, "channel_url") if c in mapping.columns], F.lit(True).alias("_has"))
    out, changed = videos.join(m, key, "left"), F.lit(False)
    for c in [c for c in (*FACTS, "channel_url") if c in mapping.columns and c in videos.columns]:
        empty = F.col(c).isNull() | (F.col(c).cast("string") == "")
        if c == "channel_url":
            empty = empty | F.col(c).contains("/channel/")
        take = empty & F.col(f"_{c}").isNotNull() & ~bad
        out = out.withColumn(f"_t_{c}", take)
        changed = changed | F.col(f"_t_{c}")
    out = out.withColumn("outcome", F.when(bad, "error").when(F.col("_has").isNull(), "no_mapping").when(changed, "updated").otherwise("noop"))
    cols = [F.when(F.col(f"_t_{c}"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if f"_t_{c}" in out.columns else F.col(c) for c in videos.columns]
    return out.select(*cols, "outcome")


def merge_mapping(snapshot: DataFrame, delta: DataFrame, key: str = "video_id") -> DataFrame:
    """Incremental upkeep: the snapshot counts as older than every row of the delta."""
    old = snapshot.select(key, *FACTS).withColumn("_age", F.lit(0)).withColumn("mtime", F.lit(0).cast("bigint")).withColumn("seq", F.lit(0).cast("bigint"))
    new = delta.select(key, *FACTS, F.col("mtime").cast("bigint"), F.col("seq").cast("bigint")).withColumn("_age", F.lit(1))
    return fold_mapping(old.unionByName(new), key, ("_age", "mtime", "seq"))


#: Rows of a kept mapping, by video.
MAPPING = "video_id string, channel_id string, channel_handle string, verified boolean, subscriber_count bigint"


def refresh_mapping(table: KeptTable, links: DataFrame, videos: DataFrame | None = None) -> int:
    """Take in the links (video_id, facts, mtime, seq) that are newer than the table's mark, of known videos only where videos is
    given, and move the mark to the newest of all. Only buckets with a changed video are written; a second run over the same
    links changes nothing. Returns the version."""
    mark = table.mark()
    new = links if mark is None else links.filter(F.col("mtime") > mark)
    newest_time = new.agg(F.max("mtime")).first()[0]
    if newest_time is None:
        return table.merge(new, merge_mapping)
    known = new if videos is None else only_known(new, videos)
    # the merge asks for its buckets, its number of rows, its long logs and its rows; the joins behind them run once
    return table.merge(stored(known.select("video_id", *FACTS, "mtime", "seq"), "links"), merge_mapping, newest_time)


def import_legacy(table: KeptTable, lines: DataFrame) -> int | None:
    """Fill a table that was never written with the mapping of legacy lines (scans.mapping_table); what holds no handle is dropped. A
    table that was written before stays as it is: None. The mark stays unset, so the next refresh takes in all channel facts."""
    from ..sources.scans import mapping_table

    if table.mark() is not None or not table.rows().isEmpty():
        return None
    rows = mapping_table(lines).select("video_id", "channel_id", "channel_handle", F.lit(None).cast("boolean").alias("verified"), F.lit(None).cast("bigint").alias("subscriber_count"))
    return table.put_many(rows)
