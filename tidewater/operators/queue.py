"""Refresh queues: population, claims, states, repairs, on-time accounting."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numbers as N
from .graph import components
from .lineage import checkpointed

STATES = ("queued", "claimed", "no_feeds", "orphan")


#: Rounds in which rows without an earlier rival win before chains of rivals are folded in order.
ROUNDS = 3


def first_of_batch(batch: DataFrame, order: str, by: tuple[str, ...] = ("creator_id", "name")) -> DataFrame:
    """Rows that no earlier kept row blocks by one of the columns, compared without case; a null blocks nothing and is blocked
    by nothing. order is unique.

    With two columns the rule is sequential, as a row that is dropped blocks nothing. A few rounds decide the rows without an
    undecided earlier rival and what those block, which clears every value that many rows share. Chains of rivals are left;
    rows that are connected by shared values are folded in order, in one task per component, which keeps the values of the
    component's kept rows. Components are found in rounds that grow with the logarithm of the longest chain."""
    # a null becomes a key of its own; no other value begins like it
    keys = {f"_k{i}": F.coalesce(F.concat(F.lit(f"{i}:"), F.lower(F.col(c))), F.concat(F.lit("\0"), F.col(order).cast("string"))) for i, c in enumerate(by)}
    keyed = batch.withColumns(keys)
    first = lambda df: df.withColumns({f"_f{k}": F.min(order).over(Window.partitionBy(k)) for k in keys})
    heads = " and ".join(f"{order} = _f{k}" for k in keys)
    if len(by) == 1:
        return first(keyed).filter(heads).select(*batch.columns)
    pending, won = checkpointed(keyed.select(order, *keys)), []
    for _ in range(ROUNDS):
        if pending.isEmpty():
            break
        heads_of = checkpointed(first(pending).filter(heads).select(order, *keys))
        won.append(heads_of.select(order))
        for k in keys:
            pending = pending.join(heads_of.select(k).distinct(), k, "left_anti")
        pending = checkpointed(pending.select(order, *keys))
    if not pending.isEmpty():
        won.append(_folded(pending, order, list(keys)))
    kept = functools.reduce(DataFrame.unionByName, won) if won else pending.select(order)
    return batch.join(kept, order, "left_semi")


def _folded(pending: DataFrame, order: str, keys: list[str]) -> DataFrame:
    """order of the rows that a fold over each component keeps."""
    pairs = functools.reduce(DataFrame.unionByName, [pending.select(F.col(keys[0]).alias("a"), F.col(k).alias("b")) for k in keys[1:]])
    named = pending.join(components(pairs, "a", "b"), F.col(keys[0]) == F.col("node"))
    ordered = named.repartition("component").sortWithinPartitions("component", order)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, taken = None, set()
        for part in batches:
            keep = []
            for own, *values in zip(*(part.column(n).to_pylist() for n in ("component", *keys))):
                if own != current:
                    current, taken = own, set()
                keep.append(taken.isdisjoint(values))
                if keep[-1]:
                    taken.update(values)
            yield pa.RecordBatch.from_arrays([part.column(order).filter(pa.array(keep, pa.bool_()))], names=[order])

    return ordered.select("component", order, *keys).mapInArrow(fold, f"`{order}` {pending.schema[order].dataType.simpleString()}")


def populate(batch: DataFrame, known: DataFrame, markers: DataFrame, order: str, by: tuple[str, ...] = ("creator_id", "name")) -> DataFrame:
    """New queue rows: neither known nor marked nor repeated in the batch."""
    out = batch.join(markers.select("creator_id").distinct(), "creator_id", "left_anti")
    for c in by:
        out = out.withColumn("_k", F.lower(F.col(c))).join(known.select(F.lower(F.col(c)).alias("_k")).distinct(), "_k", "left_anti").drop("_k")
    return first_of_batch(out.select(*batch.columns), order, by)


def claim_batch(queue: DataFrame, cutoff: float, size: int) -> DataFrame:
    """The first due rows by tier, then due time; ties by name and id."""
    return queue.filter(F.col("due_ts") <= cutoff).orderBy("tier", "due_ts", "name", "creator_id").limit(size)


def claim_per_group(queue: DataFrame, group: str, cutoff: float, size: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy("due_ts", "name", "creator_id")
    return queue.filter(F.col("due_ts") <= cutoff).withColumn("place", F.row_number().over(w)).filter(F.col("place") <= size)


def creator_states(tiers: DataFrame, queue: DataFrame, claims: DataFrame, no_feeds: DataFrame) -> DataFrame:
    """(creator_id, tier, state): queued before claimed before no_feeds before orphan."""
    flag = lambda df, c: df.select("creator_id", F.lit(True).alias(c)).distinct()
    joined = tiers.join(flag(queue, "_q"), "creator_id", "left").join(flag(claims, "_c"), "creator_id", "left").join(flag(no_feeds, "_n"), "creator_id", "left")
    state = F.when(F.col("_q"), "queued").when(F.col("_c"), "claimed").when(F.col("_n"), "no_feeds").otherwise("orphan")
    return joined.select("creator_id", "tier", state.alias("state"))


def recover_orphans(states: DataFrame, queue: DataFrame, names: DataFrame, now: float) -> DataFrame:
    """The queue with every orphan put back, due now."""
    back = states.filter("state = 'orphan'").join(names.select("creator_id", "name"), "creator_id", "left")
    return queue.select("creator_id", "name", "tier", "due_ts").unionByName(back.select("creator_id", "name", "tier", F.lit(float(now)).alias("due_ts")))


def tier_state_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("tier").pivot("state", list(STATES)).agg(F.count(F.lit(1))).fillna(0)


def tier_repairs(queue: DataFrame, tiers: DataFrame, claims: DataFrame) -> DataFrame:
    """(creator_id, queue_tier, hash_tier, action) of queued creators whose stored tier is absent (write) or different (move); claimed ones are left alone."""
    q = queue.groupBy("creator_id").agg(F.min("tier").alias("queue_tier"))
    both = q.join(tiers.select("creator_id", F.col("tier").alias("hash_tier")), "creator_id", "left").join(claims.select("creator_id").distinct(), "creator_id", "left_anti")
    action = F.when(F.col("hash_tier").isNull(), "write").when(F.col("hash_tier") != F.col("queue_tier"), "move")
    return both.withColumn("action", action).filter("action is not null")


def hash_orphans(tiers: DataFrame, queue: DataFrame, claims: DataFrame) -> DataFrame:
    return tiers.join(queue.select("creator_id").distinct(), "creator_id", "left_anti").join(claims.select("creator_id").distinct(), "creator_id", "left_anti")


def enrich_counts(batch: DataFrame, known: DataFrame, counts: DataFrame, cap: int, order: str) -> DataFrame:
    """Subscriber counts for the first cap rows that are new and have none; only counts above 0 are taken."""
    missing = batch.filter("subs is null").join(known.select("creator_id").distinct(), "creator_id", "left_anti").orderBy(order).limit(cap)
    return missing.select("creator_id").join(counts.filter("subs > 0").select("creator_id", "subs"), "creator_id")


def tier_gap(tiers: DataFrame, queue: DataFrame) -> DataFrame:
    """(tier, in_hash, in_queue, gap)."""
    a = tiers.groupBy("tier").agg(F.count(F.lit(1)).alias("in_hash"))
    b = queue.groupBy("tier").agg(F.count(F.lit(1)).alias("in_queue"))
    z = lambda c: F.coalesce(c, F.lit(0))
    return a.join(b, "tier", "full_outer").select("tier", z("in_hash").alias("in_hash"), z("in_queue").alias("in_queue"), (z("in_hash") - z("in_queue")).alias("gap"))


def queue_size(queue: DataFrame) -> DataFrame:
    """(tier, n, next_due) by tier and, with a null tier, over all."""
    return queue.rollup("tier").agg(F.count(F.lit(1)).alias("n"), F.min("due_ts").alias("next_due"))


def on_time(now: Column, scheduled: Column, interval: Column, fraction: float) -> Column:
    """A row that is due again after fraction * interval is on time until a whole interval has passed."""
    return now <= scheduled + (1.0 - fraction) * interval


def next_due(released: Column, interval: Column, retry: Column, fraction: float) -> Column:
    return released + F.greatest(interval, F.coalesce(retry, F.lit(0.0))) * fraction


def queue_state(events: DataFrame, last_tier: int) -> DataFrame:
    """(key, tier, due_ts, claimed, removed) after an ordered log of populate, claim, release, update_tier and remove events
    (key, seq, op, tier, due_ts). Fields that an event leaves null keep their last value; a remove forgets what was before it."""
    gone = F.max(F.when(F.col("op") == "remove", F.col("seq"))).over(Window.partitionBy("key"))
    live = events.withColumn("_gone", gone)
    after = F.col("_gone").isNull() | (F.col("seq") > F.col("_gone"))
    last = lambda c, cond: F.max_by(F.when(cond, F.col(c)), F.when(cond, F.col("seq")))
    lifecycle = F.col("op").isin("populate", "claim", "release")
    agg = live.groupBy("key").agg(
        F.bool_or(after).alias("_some"), last("tier", after & F.col("tier").isNotNull()).alias("tier"),
        last("due_ts", after & F.col("due_ts").isNotNull()).alias("due_ts"), last("op", after & lifecycle).alias("_op"),
    )
    return agg.select("key", F.when(F.col("_some"), F.coalesce("tier", F.lit(last_tier))).alias("tier"), "due_ts", F.coalesce(F.col("_op") == "claim", F.lit(False)).alias("claimed"), (~F.col("_some")).alias("removed"))


def with_release_due(events: DataFrame, tiers: tuple, fraction: float, last_tier: int) -> DataFrame:
    """events (key, seq, ts, op, tier, retry, due_ts) in which a release without a due time gets one: a fraction of the interval of the
    tier that the creator has by then, or of the retry interval where that is longer, after its time. A creator without a tier
    has the last; a remove forgets the tier. ts and due_ts are seconds, tiers the table of functions.numbers."""
    ordered = Window.partitionBy("key").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    lives = events.withColumn("_life", F.sum((F.col("op") == "remove").cast("int")).over(ordered))
    within = Window.partitionBy("key", "_life").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    # the remove itself opens a life in which nothing is known yet
    tier = F.coalesce(F.last(F.when(F.col("op") != "remove", F.col("tier")), ignorenulls=True).over(within), F.lit(last_tier))
    due = next_due(F.col("ts"), N.interval_hours(tier, tiers) * 3600.0, F.col("retry"), fraction)
    return lives.withColumn("due_ts", F.when((F.col("op") == "release") & F.col("due_ts").isNull(), due).otherwise(F.col("due_ts"))).drop("_life")


def advance(state: DataFrame, events: DataFrame, last_tier: int) -> DataFrame:
    """State (key, tier, due_ts, claimed) after further events: what is known counts as older than every event. Removed creators
    are left out."""
    old = state.select("key", F.lit(-(1 << 62)).cast("bigint").alias("seq"), F.when(F.col("claimed"), "claim").otherwise("populate").alias("op"), "tier", "due_ts")
    after = queue_state(old.unionByName(events.select("key", F.col("seq").cast("bigint").alias("seq"), "op", "tier", "due_ts")), last_tier)
    return after.filter(~F.col("removed")).select("key", "tier", "due_ts", "claimed")


def population(state: DataFrame) -> DataFrame:
    """(tier, queued, claimed) of a queue's state."""
    return state.groupBy("tier").agg(F.count_if(~F.col("claimed")).alias("queued"), F.count_if("claimed").alias("claimed"))


def fetch_action(outcome: Column, failures: Column, had_feed: Column, low: int = 10, high: int = 50) -> Column:
    """remove, release or release_later, from a fetch outcome, the failures so far and whether the channel ever had a feed."""
    over = failures >= F.when(had_feed, high).otherwise(low)
    return F.when((outcome == "not_found") & over, "remove").when(outcome.isin("not_found", "server_error"), "release_later").otherwise("release")


def since_last(events: DataFrame, key: str = "key", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """events with seconds since the key's event before."""
    w = Window.partitionBy(key).orderBy(ts, tie)
    return events.withColumn("gap_s", (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(ts).over(w).cast("timestamp"))) / 1e6)
