"""Records on their way out and back: handles, envelopes, batches, results, filters."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.channels import let


def upload_handle(df: DataFrame, creator_map: DataFrame) -> DataFrame:
    """df with upload_handle and outcome: hit in the map, fallback to the own handle without an id, miss (unresolved) or error (neither)."""
    from ..functions.channels import fallback_handle

    joined = df.join(creator_map.select("channel_id", F.col("handle").alias("_m")), "channel_id", "left")
    own = fallback_handle(F.col("channel_handle"))
    outcome = F.when(F.col("_m").isNotNull(), "hit").when(F.col("channel_id").isNull() & own.isNotNull(), "fallback").when(F.col("channel_id").isNull(), "error").otherwise("miss")
    return joined.withColumn("outcome", outcome).withColumn("upload_handle", F.when(outcome == "hit", F.col("_m")).when(outcome == "fallback", own)).drop("_m")


def outcome_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def skip_reason(name_ok: Column, read_ok: Column, handle: Column, video_id: Column, error: Column, superseded: Column) -> Column:
    """Why a record is not sent; null when it is. The first reason in this order counts."""
    return (
        F.when(~name_ok, "unrecognised_filename").when(~read_ok, "read_failed").when(handle.isNull(), "no_handle").when(video_id.isNull(), "missing_video_id")
        .when(error.isNotNull(), "schema_invalid").when(superseded, "superseded")
    )


def channel_action(superseded: Column, read_ok: Column, channel_id: Column, error: Column) -> Column:
    """What becomes of a channel file before an upload: a superseded one is deleted, an unreadable one or one without id is left,
    one that breaks the schema is marked, the others are sent."""
    return (
        F.when(superseded, "delete_superseded").when(~read_ok, "skip_unreadable").when(F.coalesce(channel_id, F.lit("")) == "", "skip_no_channel_id")
        .when(error.isNotNull(), "mark_invalid").otherwise("send")
    )


def existing_records(ids: DataFrame, records: DataFrame, owner: str | None = None, key: str = "id") -> DataFrame:
    """Ids that records hold, of one uploader where one is given."""
    have = records if owner is None else records.filter(F.col("owner") == owner)
    return ids.join(have.select(key).distinct(), key, "left_semi")


def union_sets(df: DataFrame, key: str, *sets: str) -> DataFrame:
    """(key, values): the distinct values of all array columns and rows of a key, sorted. Values are made distinct before they are gathered."""
    every = F.flatten(F.array(*[F.coalesce(c, F.array().cast(df.schema[c].dataType)) for c in sets]))
    values = df.select(key, F.explode_outer(every).alias("_v")).distinct()
    return values.groupBy(key).agg(F.array_sort(F.collect_set("_v")).alias("values"))


def first_rows(df: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """The first rows in an order; all without a limit."""
    return df if limit is None else df.orderBy(*order).limit(limit)


def reconcile(batch: DataFrame, results: DataFrame) -> DataFrame:
    """(idx, content_id, file, status, reason): results matched by content id, else by record index; missing where none came."""
    by_id = results.filter("platform_content_id is not null").groupBy(F.col("platform_content_id").alias("content_id")).agg(F.min(F.struct("status", "reason")).alias("_a"))
    by_idx = results.filter("platform_content_id is null and record_index is not null").groupBy(F.col("record_index").alias("idx")).agg(F.min(F.struct("status", "reason")).alias("_b"))
    joined = batch.join(by_id, "content_id", "left").join(by_idx, "idx", "left").withColumn("_r", F.coalesce("_a", "_b"))
    return joined.select("idx", "content_id", "file", F.coalesce("_r.status", F.lit("missing")).alias("status"), F.col("_r.reason").alias("reason"))


def has_formats(payload: Column) -> Column:
    """A record whose formats hold something, as a list or as an object."""
    f = F.get_json_object(payload, "$.formats")
    return F.coalesce(f.isNotNull() & ~f.rlike(r"^\s*(\{\s*\}|\[\s*\]|null)\s*$"), F.lit(False))


def matching(df: DataFrame, filters: dict[str, object], cap: int | None = None) -> DataFrame:
    """Rows that meet all given filters (None: not asked); more than cap of them is an error, as a guard before deleting."""
    for c, want in filters.items():
        if want is not None:
            df = df.filter(F.col(c) == want)
    if cap is not None and df.limit(cap + 1).count() > cap:
        raise ValueError(f"more than {cap} rows match")
    return df


def delete_matching(df: DataFrame, filters: dict[str, object], key: str, cap: int | None = None) -> DataFrame:
    return df.join(matching(df, filters, cap).select(key), key, "left_anti")


def to_document(df: DataFrame, counts: tuple[str, ...] = (), optional: tuple[str, ...] = ()) -> Column:
    """JSON of a record: counts default to 0, optional fields are left out when null, others are written as null."""
    kept = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c in counts else F.col(c) for c in df.columns]
    full = F.to_json(F.struct(*[k for c, k in zip(df.columns, kept) if c not in optional]), {"ignoreNullFields": "false"})
    extra = F.to_json(F.struct(*[k for c, k in zip(df.columns, kept) if c in optional])) if optional else F.lit("{}")
    return F.when(extra == "{}", full).otherwise(F.concat(F.substring(full, 1, 1 << 30).substr(F.lit(1), F.length(full) - 1), F.lit(","), extra.substr(F.lit(2), F.length(extra))))


def annotated(df: DataFrame, schema_text: str, annotation: str) -> DataFrame:
    """Columns renamed by an annotation of a JSON Schema's properties; a target named twice is an error."""
    found = {}
    for prop, spec in json.loads(schema_text)["properties"].items():
        target = spec.get(annotation)
        if target is not None:
            if target in found:
                raise ValueError(f"two properties are annotated {target}")
            found[target] = prop
    return df.select(*[F.col(p).alias(t) for t, p in found.items()])


def envelope(df: DataFrame, owner: str, platform: str, entity: str, version: str, url: Column, error: Column) -> DataFrame:
    """Upload envelopes of the valid rows."""
    body = F.struct(*[F.col(c) for c in df.columns])
    return df.filter(error.isNull()).select(F.struct(F.lit(owner).alias("username"), F.lit(platform).alias("platform"), F.lit(entity).alias("entity"), F.lit(version).alias("version"), url.alias("source_url"), body.alias("data")).alias("envelope"))


def pack_batches(df: DataFrame, shards: int, max_records: int, max_bytes: int, key: str, order: str, line: str, shard: Column | None = None) -> DataFrame:
    """(key, shard, batch, bytes): lines packed in order, greedily; a batch ends before the record that breaks its count or byte limit.
    Lines above the limit are dropped. The fold is sequential, so it runs per shard, by a hash of the key or as given; each shard streams through its task in order."""
    sized = df.select(*dict.fromkeys((key, order)), (F.octet_length(line) + 1).cast("bigint").alias("bytes")).filter(F.col("bytes") <= max_bytes)
    dealt = sized.withColumn("shard", (F.pmod(F.xxhash64(key), F.lit(shards)) if shard is None else shard).cast("int")).repartition(shards, "shard").sortWithinPartitions("shard", order, key)
    key_type = df.schema[key].dataType.simpleString()

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, batch, records, size = None, 0, 0, 0
        for part in parts:
            numbers = []
            for s, b in zip(part["shard"], part["bytes"]):
                if s != shard:
                    shard, batch, records, size = s, 0, 0, 0
                elif records >= max_records or size + b > max_bytes:
                    batch, records, size = batch + 1, 0, 0
                records, size = records + 1, size + b
                numbers.append(batch)
            yield part.assign(batch=numbers)[[key, "shard", "batch", "bytes"]]

    return dealt.mapInPandas(fold, f"`{key}` {key_type}, shard int, batch int, bytes bigint")


def batch_outcomes(reconciled: DataFrame, batch: str = "batch") -> DataFrame:
    return reconciled.groupBy(batch).agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("success", "failed", "missing")])


#: A decimal octet without leading zeros, and the groups of a version 6 address.
_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_GROUPS = r"^[0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4})*$"


def address_bits(ip: Column) -> Column:
    """The bits of an address as text, 32 or 128 characters, most significant first; null for anything else. Version 6 with groups
    left out (::) and with its last 32 bits as octets."""
    octets = rf"{_OCTET}(\.{_OCTET}){{3}}"
    bits = lambda part, base, width: F.lpad(F.conv(part, base, 2), width, "0")
    four = lambda text: F.array_join(F.transform(F.split(text, "[.]"), lambda o: bits(o, 10, 8)), "")
    groups = lambda text: F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))

    def hexed(a: Column) -> Column:
        return let(F.regexp_extract(a, rf":({octets})$", 1), lambda last: F.when(last == "", a).otherwise(F.concat(F.regexp_replace(a, rf"{octets}$", ""), let(four(last), bits_hex))))

    def sides(halves: Column) -> Column:
        right = F.when(F.size(halves) == 2, F.get(halves, 1)).otherwise("")
        return F.struct(groups(halves[0]).alias("left"), groups(right).alias("right"), F.size(halves).alias("n"), F.forall(halves, lambda h: (h == "") | h.rlike(_GROUPS)).alias("plain"))

    def filled(s: Column) -> Column:
        gap = F.lit(8) - F.size(s["left"]) - F.size(s["right"])
        fits = s["plain"] & F.when(s["n"] == 1, gap == 0).otherwise((s["n"] == 2) & (gap >= 1))
        six = F.concat(s["left"], F.array_repeat(F.lit("0"), F.greatest(gap, F.lit(0))), s["right"])
        return F.when(fits, F.array_join(F.transform(six, lambda g: bits(g, 16, 16)), ""))

    six_bits = lambda a: let(F.split(hexed(a), "::", -1), lambda halves: let(sides(halves), filled))
    return let(ip, lambda a: F.when(a.rlike(f"^{octets}$"), four(a)).when(a.contains(":"), six_bits(a)))


def bits_hex(bits: Column) -> Column:
    """32 bits as two groups of hex digits."""
    half = lambda at: F.lower(F.conv(F.substring(bits, at, 16), 2, 16))
    return F.concat(half(1), F.lit(":"), half(17))


def ranges_of(networks: DataFrame, cidr: str = "cidr", order: str = "order") -> DataFrame:
    """(version, length, prefix, order, network) of configured ranges, in which bits behind the prefix may be set; a range
    without a length is one address; what is no range is skipped. network: the range's text, for version 4 with those bits cleared."""
    text = F.trim(F.col(cidr))
    parts = F.split(text, "/")
    # exploded, since no filter is pushed below that: the bits are worked out once a row
    both = F.struct(address_bits(parts[0]).alias("bits"), address_bits(F.get(parts, 1)).alias("mask"))
    full = networks.select(F.col(order).alias("order"), text.alias("text"), F.get(parts, 1).alias("given"), F.size(parts).alias("n"), F.explode(F.array(both)).alias("b")).select("*", "b.bits", "b.mask")
    size = F.char_length("bits")
    length = F.when(F.col("n") == 1, size).when(F.col("given").rlike(r"^\d{1,3}$"), F.col("given").cast("int")).when(F.col("mask").rlike("^1*0*$") & (F.char_length("mask") == size), F.char_length(F.rtrim(F.lit("0"), "mask")))
    good = full.withColumn("length", length).filter((F.col("n") <= 2) & F.col("bits").isNotNull() & (F.col("length") <= size))
    prefix = F.substring("bits", F.lit(1), F.col("length"))
    cleared = F.rpad(prefix, 32, "0")
    dotted = F.concat_ws(".", *[F.conv(F.substring(cleared, 8 * k + 1, 8), 2, 10) for k in range(4)])
    name = F.when(size == 32, F.concat(dotted, F.lit("/"), F.col("length").cast("string"))).otherwise(F.col("text"))
    return good.select(size.alias("version"), "length", prefix.alias("prefix"), "order", name.alias("network"))


#: Leading bits of an address that name its block, by version: a version 4 block holds at most 65,536 addresses.
BLOCK = {32: 16, 128: 48}


def networks_of(df: DataFrame, ip: str, networks: DataFrame, cidr: str = "cidr", order: str = "order") -> DataFrame:
    """df with network: the first configured range, by order, that holds the address; other where none does or it is no address;
    none where there is none (null or the word none). networks has any number of rows.

    Ranges are nested or apart. So addresses and ranges are sorted by their bits, block by block, and swept with a stack of the
    ranges that are open, at most one for each length, each with the first by order of itself and those below it. Ranges
    wider than a block are met by equality of prefixes, once for each distinct block, and enter the sweep as one range that fills
    the block. So a distinct address and a range are shuffled once each, however many lengths there are.
    """
    ranges = ranges_of(networks, cidr, order)
    ranges = ranges.groupBy("version", "length", "prefix").agg(F.min(F.struct("order", "network")).alias("range"))
    width = F.when(F.col("version") == 32, BLOCK[32]).otherwise(BLOCK[128])
    seen = df.select(F.col(ip).alias("_x_ip")).filter("_x_ip is not null").distinct().select("_x_ip", F.explode(F.array(address_bits(F.col("_x_ip")))).alias("bits"))
    seen = seen.filter("bits is not null").withColumn("version", F.char_length("bits")).withColumn("block", F.substring("bits", F.lit(1), width))

    wide, narrow = ranges.filter(F.col("length") < width), ranges.filter(F.col("length") >= width)
    lengths = wide.groupBy("version").agg(F.collect_set("length").alias("lengths"))  # two rows, 64 lengths at most
    cut = seen.select("version", "block").distinct().join(F.broadcast(lengths), "version").select("version", "block", F.explode("lengths").alias("length"))
    met = cut.withColumn("prefix", F.substring("block", F.lit(1), F.col("length"))).join(wide, ["version", "length", "prefix"])
    filled = met.groupBy("version", "block").agg(F.min("range").alias("range")).select("version", "block", F.col("block").alias("prefix"), "range")
    open_ = filled.unionByName(narrow.select("version", F.substring("prefix", F.lit(1), width).alias("block"), "prefix", "range"))

    # at one place, wider ranges come first and addresses last
    told = open_.select("version", "block", F.rpad("prefix", F.col("version"), F.lit("0")).alias("bits"), F.char_length("prefix").alias("length"), F.lit(None).cast(df.schema[ip].dataType).alias("_x_ip"), "range.*")
    asked = seen.select("version", "block", "bits", (F.col("version") + 1).alias("length"), "_x_ip", *[F.lit(None).cast(told.schema[c].dataType).alias(c) for c in ("order", "network")])
    swept = told.unionByName(asked).repartition("version", "block").sortWithinPartitions("version", "block", "bits", "length")
    first = swept.select("version", "bits", "length", "_x_ip", "order", "network").mapInArrow(_sweep, T.StructType([told.schema["_x_ip"], T.StructField("_x_network", T.StringType())]))
    named = df.join(first, F.col(ip) == F.col("_x_ip"), "left")
    none = F.col(ip).isNull() | (F.col(ip) == "none")
    return named.select(*(df[c] for c in df.columns), F.when(none, "none").otherwise(F.coalesce("_x_network", F.lit("other"))).alias("network"))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(address, network) of sorted rows (version, bits, length, address, order, network): ranges and, longer than any, addresses."""
    above: list[tuple] = []  # (version, prefix, (order given, order, network)), each prefix the start of the next
    for batch in batches:
        found: list[tuple] = []
        for version, bits, length, address, order, network in zip(*(c.to_pylist() for c in batch.columns)):
            while above and not (above[-1][0] == version and bits.startswith(above[-1][1])):
                above.pop()
            if length > version:
                if above:
                    found.append((address, above[-1][2][2]))
            else:
                first = (order is not None, order, network)  # as Spark's min has it, null comes first
                above.append((version, bits[:length], min(first, above[-1][2]) if above else first))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*found)], names=["_x_ip", "_x_network"])


def network_of(df: DataFrame, ip: str, networks: list[str]) -> DataFrame:
    """networks_of for a configured list."""
    listed = df.sparkSession.createDataFrame(list(enumerate(networks)), "order int, cidr string")
    return networks_of(df, ip, listed)
