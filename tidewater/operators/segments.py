"""The ordered fold of enrich.fold_mapping over logs that are too long for one task.

The holder of a log's key changes at an entry only if the entry is of the holder's channel or ranks above it. So every entry has
one successor: the first later entry of its own channel or of a higher rank, and the fold is the walk from the first entry along
the successors. A log is cut into segments of consecutive entries. Inside a segment, walks are followed in one task, backwards;
where a walk leaves it, it goes to the first place of a channel in a later segment, or to a place where a later segment's running
maximum rises above a rank. These few places are the nodes between segments; walks over them are doubled until the first entry's
has ended, so rounds grow with the logarithm of the number of segments.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .lineage import checkpointed


def _streamed(df: DataFrame, columns: list[str], groups: int, emit: Callable[[tuple, list[tuple]], Iterator[tuple]], schema: StructType) -> DataFrame:
    """What emit gives for each run of rows that agree in the first columns; a run is held by its task."""
    arrow = to_arrow_schema(schema)

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, rows = None, []
        for part in batches:
            found: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in part.columns)):
                if own is None or row[:groups] != own:
                    found.extend(emit(own, rows) if own is not None else ())
                    own, rows = row[:groups], []
                rows.append(row[groups:])
            if found:
                yield batch(found)
        if own is not None and (found := list(emit(own, rows))):
            yield batch(found)

    return df.select(*columns).mapInArrow(run, schema)


def _rank(r: dict) -> tuple:
    return r["v"], r["w"], r["s"]


def _places(own: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """(.., row, id, rank, whether first of its channel, whether a running maximum) of a segment's nodes."""
    seen, top = set(), None
    for row, channel, rank in rows:
        first, rises = channel not in seen, top is None or _rank(rank) > top
        if rises:
            top = _rank(rank)
        if first or rises:
            seen.add(channel)
            yield *own, row, channel, rank, first, rises


def _walks(own: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """(.., row, exit, refreshes, end) of a segment's nodes, from its successors by channel (kind 0) and by rank (kind 1), sorted, and
    its entries (kind 2): refreshes on the walk inside, and its last entry there."""
    by_channel, ranks, above, entries = {}, [], [], []
    for kind, row, channel, rank, target, copies in rows:
        if kind == 0:
            by_channel[channel] = target
        elif kind == 1:
            ranks.append(_rank(rank))
            above.append(target)
        else:
            entries.append((row, channel, _rank(rank), copies))
    later: dict = {}  # channel -> its next place inside
    higher: list[int] = []  # places inside with ranks that no place before them reaches, seen from here backwards
    walks: list[tuple] = [None] * len(entries)
    for k in reversed(range(len(entries))):
        row, channel, rank, copies = entries[k]
        while higher and entries[higher[-1]][2] <= rank:
            higher.pop()
        same, over = later.get(channel), higher[-1] if higher else None
        inside = min((p for p in (same, over) if p is not None), default=None)
        if inside is not None:
            exit_, refreshes, end = walks[inside]
            walks[k] = exit_, refreshes + copies - 1 + (inside == same), end
        else:
            next_same = by_channel.get(channel)
            at = bisect_right(ranks, rank) - 1  # looked up for each rank that is unresolved in here
            next_over = above[at] if at >= 0 and ranks[at] == rank else None
            exit_ = min((p for p in (next_same, next_over) if p is not None), default=None)
            walks[k] = exit_, copies - 1 + (exit_ is not None and exit_ == next_same), row
        later[channel] = k
        higher.append(k)
    seen, top = set(), None
    for (row, channel, rank, _), walk in zip(entries, walks):
        if channel not in seen or rank > top:
            yield *own, row, *walk
        seen.add(channel)
        top = rank if top is None else max(top, rank)


def _unresolved(own: tuple, rows: list[tuple]) -> Iterator[tuple]:
    """(.., rank): each rank that an entry has which nothing after it in the segment exceeds."""
    top, found = None, set()
    for _, _, rank in reversed(rows):
        r = _rank(rank)
        if top is None or r >= top:
            top = r
            if r not in found:
                found.add(r)
                yield *own, rank


def fold_long(links: DataFrame, key: str, order: tuple[str, ...], facts: tuple[str, ...], segments: int) -> DataFrame:
    """fold_mapping's (key, facts, collisions) for the keys of links, with logs cut into about so many segments in all. facts begin with
    channel id, handle, verified flag and size."""
    channel, handle, verified, size = facts[:4]
    # rows equal in everything follow each other: one entry with their number
    entries = links.groupBy(key, *order, *facts).agg(F.count(F.lit(1)).alias("_copies"))
    rank = F.struct(
        F.coalesce(F.col(verified), F.lit(False)).alias("v"), F.coalesce(F.endswith(F.upper(F.col(handle)), F.lit("VEVO")), F.lit(False)).alias("w"), F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("s")
    )
    sort = [key, *order, *facts]
    placed = entries.repartitionByRange(segments, *sort).sortWithinPartitions(*sort)
    placed = checkpointed(placed.withColumns({"_row": F.monotonically_increasing_id(), "_seg": F.spark_partition_id(), "_rank": rank}))
    fields = {f.name: f for f in placed.schema}
    base = StructType([fields[key], fields["_seg"]])

    ordered = placed.repartition(key, "_seg").sortWithinPartitions(key, "_seg", "_row")
    node = StructType([*base, fields["_row"], fields[channel], fields["_rank"]]).add("_first", "boolean").add("_rises", "boolean")
    nodes = checkpointed(_streamed(ordered, [key, "_seg", "_row", channel, "_rank"], 2, _places, node))
    # by channel: its first place in the next segment that has it
    w = Window.partitionBy(key, channel).orderBy("_seg")
    by_channel = nodes.filter("_first").withColumn("_target", F.lead("_row").over(w)).filter("_target is not null").select(key, "_seg", channel, "_target")
    # by rank: the first later segment that exceeds it, and there the least running maximum that does
    tops = nodes.filter("_rises").groupBy(key, "_seg").agg(F.max("_rank").alias("_top")).groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_seg", "_top"))).alias("_tops"))
    asked = _streamed(ordered, [key, "_seg", "_row", channel, "_rank"], 2, _unresolved, StructType([*base, fields["_rank"]]))
    later = F.filter("_tops", lambda t: (t["_seg"] > F.col("_seg")) & (t["_top"] > F.col("_rank")))
    asked = asked.join(tops, key).withColumn("_in", F.get(later, 0)["_seg"]).filter("_in is not null").select(key, "_seg", "_rank", "_in")
    steps = nodes.filter("_rises").select(key, F.col("_seg").alias("_in"), "_rank", F.lit(None).cast("int").alias("_seg"), F.col("_row").alias("_target"), F.lit(1).alias("_k"))
    both = steps.unionByName(asked.select(key, "_in", "_rank", "_seg", F.lit(None).cast("long").alias("_target"), F.lit(0).alias("_k")))
    down = Window.partitionBy(key, "_in").orderBy(F.desc("_rank"), "_k").rowsBetween(Window.unboundedPreceding, 0)
    by_rank = both.withColumn("_target", F.last("_target", ignorenulls=True).over(down)).filter("_k = 0").select(key, "_seg", "_rank", "_target")

    shape = {"_kind": "int", "_row": "bigint", channel: fields[channel].dataType, "_rank": fields["_rank"].dataType, "_target": "bigint", "_copies": "bigint"}
    told = [df.select(key, "_seg", *[(F.lit(k) if c == "_kind" else F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in shape.items()]) for k, df in enumerate((by_channel, by_rank, placed))]
    parts = told[0].unionByName(told[1]).unionByName(told[2])
    parts = parts.repartition(key, "_seg").sortWithinPartitions(key, "_seg", "_kind", F.when(F.col("_kind") == 1, F.col("_rank")), "_row")
    walk = StructType([*base, fields["_row"]]).add("_exit", "long").add("_refreshes", "long").add("_end", "long")
    walks = checkpointed(_streamed(parts, [key, "_seg", *shape], 2, _walks, walk).drop("_seg"))

    start = placed.groupBy(key).agg(F.min("_row").alias("_row"), F.sum("_copies").alias("_n"))
    while not walks.join(start.select(key, "_row"), [key, "_row"], "left_semi").filter("_exit is not null").isEmpty():
        on = walks.select(key, F.col("_row").alias("_exit"), F.col("_exit").alias("_then"), F.col("_refreshes").alias("_more"), F.col("_end").alias("_last"))
        doubled = walks.join(on, [key, "_exit"], "left")
        walks = checkpointed(doubled.select(key, "_row", F.col("_then").alias("_exit"), (F.col("_refreshes") + F.coalesce("_more", F.lit(0))).alias("_refreshes"), F.coalesce("_last", "_end").alias("_end")))
    done = start.join(walks, [key, "_row"]).select(key, F.col("_end").alias("_row"), (F.col("_n") - 1 - F.col("_refreshes")).alias("collisions"))
    return done.join(placed, [key, "_row"]).select(key, *facts, "collisions")
