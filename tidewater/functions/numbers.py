"""Lenient numbers, times and tiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .channels import non_empty, strip


def convert_count(text: Column) -> Column:
    """'1.2M views', '12,345', '3K' as an integer, cut like int(); null for anything else."""
    word = F.upper(strip(F.substring_index(strip(text), " ", 1)))
    number = F.regexp_extract(word, r"^([0-9]*\.?[0-9]+|[0-9]+\.)[KMB]$", 1).try_cast("double")
    scale = F.when(word.endswith("K"), 1e3).when(word.endswith("M"), 1e6).when(word.endswith("B"), 1e9)
    plain = F.when(word.rlike("^[0-9,]+$"), F.replace(word, F.lit(","), F.lit("")).try_cast("bigint"))
    return F.coalesce(plain, F.floor(number * scale).cast("bigint"))


def count_of(text: Column) -> Column:
    """The first word as a count: '1.2M', '42,069', or the digits it begins with."""
    word = F.replace(F.upper(F.substring_index(strip(text), " ", 1)), F.lit(","), F.lit(""))
    scale = F.when(word.endswith("K"), 1e3).when(word.endswith("M"), 1e6).when(word.endswith("B"), 1e9)
    number = F.substr(word, F.lit(1), F.length(word) - 1).try_cast("double")
    return F.when(scale.isNotNull(), (number * scale).cast("bigint")).otherwise(non_empty(F.regexp_extract(word, r"^(\d+)", 1)).try_cast("bigint"))


def leading_count(text: Column) -> Column:
    """Digits at the start, after commas are taken out."""
    return non_empty(F.regexp_extract(F.replace(strip(text), F.lit(","), F.lit("")), r"^(\d+)", 1)).try_cast("bigint")


def lenient_int(x: Column) -> Column:
    """An integer by way of a floating number, cut; null for text, NaN and infinities."""
    d = strip(x.cast("string")).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < 9.2e18), d.cast("bigint"))


def strict_int(x: Column) -> Column:
    return strip(x.cast("string")).try_cast("bigint")


def lenient_timestamp(x: Column) -> Column:
    """ISO 8601, YYYYMMDD, epoch seconds or 'Joined Mon D, YYYY' as a timestamp; null for anything else."""
    t = strip(x)
    day = F.when(t.rlike(r"^\d{8}$"), F.try_to_timestamp(t, F.lit("yyyyMMdd")))
    epoch = F.when(t.rlike(r"^\d{9,11}$"), F.timestamp_seconds(t.try_cast("bigint")))
    joined = F.when(t.rlike(r"^(Joined )?[A-Z][a-z]{2} \d{1,2}, \d{4}$"), F.try_to_timestamp(F.regexp_replace(t, "^Joined ", ""), F.lit("MMM d, yyyy")))
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), t.try_cast("timestamp"))
    return F.coalesce(day, epoch, joined, iso)


def parse_tiers(spec: str) -> list[tuple[int, int, float]]:
    """'hours:min_subscribers,...' as (tier, min_subscribers, interval_hours), best tier first."""
    pairs = [tuple(map(float, part.split(":"))) for part in spec.split(",") if part.strip()]
    ordered = sorted(pairs, key=lambda p: -p[1])
    if not ordered or ordered[-1][1] != 0:
        raise ValueError("the last tier must start at 0 subscribers")
    return [(k, int(least), hours) for k, (hours, least) in enumerate(ordered, 1)]


def tier_for(count: Column, tiers: list[tuple[int, int, float]], unknown: str = "first") -> Column:
    """Number of the first tier whose threshold the count meets; unknown counts go to the first, next_to_last or last tier."""
    place = {"first": tiers[0][0], "next_to_last": tiers[-2 if len(tiers) > 1 else -1][0], "last": tiers[-1][0]}[unknown]
    known = reduce(lambda c, t: c.when(count >= t[1], t[0]), tiers[1:-1], F.when(count >= tiers[0][1], tiers[0][0]))
    return F.when(count.isNull(), place).otherwise(known.otherwise(tiers[-1][0]))


def interval_hours(tier: Column, tiers: list[tuple[int, int, float]]) -> Column:
    """Hours between refreshes; an unknown tier counts as the last."""
    return reduce(lambda c, t: c.when(tier == t[0], t[2]), tiers[1:], F.when(tier == tiers[0][0], tiers[0][2])).otherwise(tiers[-1][2])
