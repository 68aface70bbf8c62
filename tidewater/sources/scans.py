"""Scans of text, JSON, CSV, Parquet, XML and log files into tables. Line scans take DataFrames (pos, value), so they run on
any source that Spark reads; the read_ functions open paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import channels as C
from ..operators.queue import first_of_batch


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(pos, value) of the lines of a list file, numbered from 0 in file order. A file of any size is read in its blocks: lines
    are numbered inside each block and start from the number of lines in the blocks before, one row per block."""
    block = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    lines = spark.read.option("lineSep", "\n").text(path).select("value", *block, F.monotonically_increasing_id().alias("_at"))
    blocks = lines.groupBy("_file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    start = blocks.select("_file", "_block", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    pos = (F.col("_at") - F.col("_first") + F.col("_before")).alias("pos")
    return lines.join(start, ["_file", "_block"]).select(pos, F.regexp_replace("value", "\r$", "").alias("value"))


def read_dataset(spark: SparkSession, root: str) -> DataFrame:
    """Every .csv, .jsonl, .ndjson and .parquet file under root as text columns; malformed JSON lines are skipped."""
    found = []
    for glob, how in (("*.csv", "csv"), ("*.{jsonl,ndjson}", "json"), ("*.parquet", "parquet")):
        files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        if files.format("binaryFile").load(root).select("path").isEmpty():
            continue
        reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
        if how == "csv":
            df = reader.option("header", True).option("inferSchema", False).csv(root)
        elif how == "json":
            df = reader.option("mode", "DROPMALFORMED").option("primitivesAsString", True).json(root)
        else:
            df = reader.parquet(root)
        if df.columns:
            found.append(df.select(*[F.col(f"`{f.name}`").cast("string").alias(f.name) if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else F.to_json(f"`{f.name}`").alias(f.name) for f in df.schema]))
    if not found:
        raise ValueError(f"no data files under {root}")
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def list_assets(spark: SparkSession, root: str, prefix: str = "", suffix: str = "") -> DataFrame:
    """(name, dir, mtime) of the files under root; their content is never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    where = F.when(F.element_at(F.split("path", "/"), -2) == "uploaded", "uploaded").otherwise("base")
    return files.select(name.alias("name"), where.alias("dir"), F.col("modificationTime").cast("double").alias("mtime")).filter(F.col("name").startswith(prefix) & F.col("name").endswith(suffix))


def read_documents(spark: SparkSession, root: str) -> DataFrame:
    """(path, text, error) of every file under root: plain and gzip JSON as whole texts, a file with another suffix as an error row."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    every = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", name.alias("_name"))
    other = every.filter(~F.col("_name").rlike(r"\.json(\.gz)?$")).select("path", F.lit(None).cast("string").alias("text"), F.lit("unsupported file extension").alias("error"))
    texts = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{json,json.gz}").text(root, wholetext=True)
    return texts.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"), F.lit(None).cast("string").alias("error")).unionByName(other)


def changed_since(files: DataFrame, cutoff: float, col: str = "mtime") -> DataFrame:
    """Incremental scan: strictly newer than the cutoff."""
    return files.filter(F.col(col) > cutoff)


def read_quality(df: DataFrame, text: str = "text", codec_state: str | None = None) -> DataFrame:
    """df with status: empty, decompress failed, json parse failed, not a JSON object, recovered or ok."""
    v = F.try_parse_json(F.col(text))
    codec = F.col(codec_state) if codec_state else F.lit("ok")
    status = (
        F.when(codec == "failed", "decompress failed").when(F.coalesce(F.length(text), F.lit(0)) == 0, "empty").when(v.isNull(), "json parse failed")
        .when(~F.schema_of_variant(v).startswith("OBJECT"), "not a JSON object").when(codec == "recovered", "recovered").otherwise("ok")
    )
    return df.withColumn("status", status)


def unwrap_envelope(df: DataFrame, payload: str = "payload") -> DataFrame:
    """df with channel_id, channel_handle and status from a payload that is enveloped under data or plain."""
    at = lambda *paths: C.non_empty(F.coalesce(*[F.get_json_object(F.col(payload), p) for p in paths]))
    content, creator = at("$.platform_content_id"), at("$.platform_creator_id")
    cid = F.coalesce(at("$.data.channel_id", "$.channel_id"), *[F.when(C.is_channel_id(x), x) for x in (content, creator)])
    handle = F.coalesce(at("$.data.channel_handle", "$.channel_handle"), *[F.when(~C.is_channel_id(x), x) for x in (creator, content)])
    handle = F.regexp_replace(handle, "^@+", "")
    status = F.when(F.try_parse_json(F.col(payload)).isNull(), "error").when(cid.isNull() | handle.isNull() | handle.contains(" "), "skipped").otherwise("ok")
    return df.select("*", cid.alias("channel_id"), handle.alias("channel_handle"), status.alias("status"))


def creator_map_lines(lines: DataFrame) -> DataFrame:
    """(channel_id, handle) of 'id,handle' lines; a line without comma maps to itself, the last line of an id wins."""
    t = C.strip(F.col("value"))
    data = lines.filter((t != "") & ~t.startswith("#")).select("pos", F.split(t, ",", 2).alias("p"))
    pair = data.select("pos", C.strip(F.col("p")[0]).alias("channel_id"), C.strip(F.coalesce(F.get("p", F.lit(1)), F.col("p")[0])).alias("handle"))
    return pair.groupBy("channel_id").agg(F.max_by("handle", "pos").alias("handle"))


def discovered_lines(lines: DataFrame) -> DataFrame:
    """(channel, subs, scraped) of JSON lines: the last count wins, scraped if any line came from a scrape."""
    j = lines.select("pos", F.from_json("value", "channel string, subs bigint, source string").alias("j")).filter("j.channel is not null")
    return j.groupBy("j.channel").agg(F.max_by("j.subs", "pos").alias("subs"), F.bool_or(F.col("j.source") == "scrape").alias("scraped"))


def failed_lines(lines: DataFrame) -> DataFrame:
    """(channel, reason, status_code): the last line of each channel."""
    j = lines.select("pos", F.from_json("value", "channel string, reason string, status_code int").alias("j")).filter("j.channel is not null")
    return j.groupBy("j.channel").agg(F.max_by("j", "pos").alias("j2")).select("channel", "j2.reason", "j2.status_code")


def known_channels(lines: DataFrame) -> DataFrame:
    """Lower-cased channel names of a list: the JSON channel, else the second tab column or the line, without @, site prefix and text from a comma on."""
    v = F.col("value")
    raw = F.coalesce(C.json_channel(v), F.get(F.split(v, "\t"), F.lit(1)), v)
    bare = F.regexp_replace(F.substring_index(C.strip(raw), ",", 1), r"^(https?://(www\.)?youtube\.com/)?@?", "")
    return lines.select(F.lower(bare).alias("channel")).filter("channel <> '' and not channel like '%@%' and not channel like '#%'").distinct()


def channel_ids(lst: DataFrame, jsonl: DataFrame) -> DataFrame:
    """Distinct channel ids of list lines and JSON lines."""
    a = lst.select(C.parse_channel_line(F.col("value"))["channel_id"].alias("channel_id"))
    b = jsonl.select(F.get_json_object("value", "$.channel_id").alias("channel_id")).filter(C.is_channel_id(F.col("channel_id")))
    return a.unionByName(b).filter("channel_id is not null").distinct()


def no_feed_lines(lines: DataFrame) -> DataFrame:
    """(creator_id, url, name, count): tab-separated, or white space where there is no tab; counts of one id add up, the latest url and name stay."""
    v = C.strip(F.col("value"))
    p = F.when(v.contains("\t"), F.split(v, "\t")).otherwise(F.split(v, r"\s+"))
    rows = lines.select("pos", p.alias("p")).filter(F.size("p") >= 3)
    count = F.coalesce(F.get("p", F.lit(3)).try_cast("bigint"), F.lit(1))
    return (
        rows.select("pos", F.col("p")[0].alias("creator_id"), F.col("p")[1].alias("url"), F.col("p")[2].alias("name"), count.alias("count"))
        .groupBy("creator_id").agg(F.max_by("url", "pos").alias("url"), F.max_by("name", "pos").alias("name"), F.sum("count").alias("count"))
    )


def id_lines(lines: DataFrame) -> DataFrame:
    return lines.select(C.strip(F.col("value")).alias("id")).filter("id <> ''").distinct()


def queue_snapshot(lines: DataFrame, last_tier: int = 1) -> DataFrame:
    """(pos, tier, at, due_ts, name, creator_id) of snapshot lines: tiers with their rows, {tier: [[due, name, id], ...]}, alone or under
    "queues", or a flat list, whose rows go to last_tier. Repeats stay; distinct_queue drops them."""
    text = C.strip(F.col("value"))
    wrapped = F.get_json_object("value", "$.queues")
    tiers = F.from_json(F.coalesce(wrapped, F.col("value")), "map<string,array<array<string>>>")
    tiered = lines.filter(text.startswith("{")).select("pos", F.posexplode(tiers).alias("tier_at", "tier", "rows"))
    flat = lines.filter(text.startswith("[")).select("pos", F.lit(0).alias("tier_at"), F.lit(str(last_tier)).alias("tier"), F.from_json("value", "array<array<string>>").alias("rows"))
    entry = tiered.unionByName(flat).select("pos", "tier_at", F.col("tier").try_cast("int").alias("tier"), F.posexplode("rows").alias("at", "r"))
    return entry.select("pos", "tier", "at", F.get("r", 0).try_cast("double").alias("due_ts"), F.get("r", 1).alias("name"), F.get("r", 2).alias("creator_id"), F.struct("pos", "tier_at", "at").alias("_place"))


def distinct_queue(lines: DataFrame, last_tier: int = 1) -> DataFrame:
    """queue_snapshot without repeats: in the order of the file, a row whose name or id, without case, a kept row before it has is
    dropped."""
    return first_of_batch(queue_snapshot(lines, last_tier), "_place", ("creator_id", "name")).drop("_place")


def page_values(pages: DataFrame) -> DataFrame:
    """Ordered-unique values of an export: (value, pos), without leading @ and empty values."""
    clean = pages.select(F.regexp_replace("value", "^@+", "").alias("value"), "pos").filter("value <> ''")
    return clean.groupBy("value").agg(F.min("pos").alias("pos"))


def mapping_table(lines: DataFrame) -> DataFrame:
    """(video_id, channel_id, channel_handle) of JSON objects id -> facts; rows without a handle are dropped."""
    m = lines.select(F.explode(F.from_json("value", "map<string,struct<channel_id:string,channel_handle:string>>")).alias("video_id", "f"))
    return m.filter("f.channel_handle is not null").select("video_id", "f.channel_id", "f.channel_handle")


def log_lines(lines: DataFrame) -> DataFrame:
    """(pos, rendered): JSON log lines as level:ts:file:func:line:message key=value..., other lines as they are."""
    fixed = ("level", "ts", "file", "func", "line", "msg")
    m = F.from_json(F.when(F.try_parse_json("value").isNotNull(), F.col("value")), "map<string,string>")
    extra = F.transform(F.array_sort(F.map_entries(F.map_filter(m, lambda k, v: ~k.isin(*fixed)))), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))))
    text = F.concat_ws(" ", F.concat_ws(":", *[F.coalesce(F.element_at(m, F.lit(k)), F.lit("")) for k in fixed]), F.nullif(F.array_join(extra, " "), F.lit("")))
    return lines.select("pos", F.when(m.isNotNull(), text).otherwise(F.col("value")).alias("rendered"))
