"""Third-party rows with other column names, normalised to one video record."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import channels as C
from ..functions import numbers as N
from ..functions import web as W
from . import extract as X
from . import validation as V

#: Column names of other datasets for each field, best first.
ALIASES = {
    "video_id": ("video_id", "videoId", "video_ID", "id", "youtube_id"),
    "title": ("title", "video_title", "name"),
    "description": ("description", "video_description", "desc"),
    "channel_id": ("channel_id", "channelId", "channel_ID"),
    "channel_handle": ("channel_handle", "channelHandle", "handle", "channel_username", "channel_user"),
    "channel_subs": ("channel_subs", "channel_subscribers", "subscriber_count", "subscriberCount", "subscribers", "subs"),
    "channel_name": ("channel_name", "channel_title", "channelTitle", "channel"),
    "view_count": ("view_count", "views", "viewCount"),
    "like_count": ("like_count", "likes", "likeCount"),
    "comment_count": ("comment_count", "comments_count", "comments", "commentCount"),
    "publish_date": ("publish_date", "published_at", "publishedAt", "publish_time", "publishedAtSQL"),
    "tags": ("video_tags", "tags"),
    "thumbnail_url": ("thumbnail_url", "thumbnail", "thumbnail_link"),
    "kind": ("kind", "media_type", "category"),
    "country": ("country", "region", "region_code"),
    "language": ("langauge", "language", "lang", "default_audio_language"),
}


def pick(df: DataFrame, field: str) -> Column:
    """First value with something in it among the field's columns that df has."""
    exact = set(df.columns)
    found = [C.non_empty(C.strip(F.col(f"`{a}`").cast("string"))) for a in ALIASES[field] if a in exact]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def to_videos(df: DataFrame, thumbnail_as_video_thumbnail: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One video record per row that has a video id."""
    vid, tags = pick(df, "video_id"), pick(df, "tags")
    words = F.array_distinct(F.filter(F.transform(F.split(F.when(tags != "[None]", tags), "[|]"), C.strip), lambda t: t != ""))
    none = F.array().cast("array<string>")
    out = df.select(
        vid.alias("video_id"), F.nullif(F.regexp_replace(pick(df, "channel_handle"), "^@+", ""), F.lit("")).alias("channel_handle"),
        pick(df, "title").alias("title"), pick(df, "description").alias("description"), pick(df, "channel_id").alias("channel_id"),
        *[N.lenient_int(pick(df, c)).alias(c) for c in ("view_count", "like_count", "comment_count")],
        pick(df, "country").alias("locale"), pick(df, "language").alias("default_audio_language"), W.watch_url(vid).alias("url"), W.embed_url(vid).alias("embed_url"),
        F.coalesce(words, none).alias("tags"), W.media_type(pick(df, "kind")).alias("media_type"), N.lenient_timestamp(pick(df, "publish_date")).alias("published"),
        pick(df, "thumbnail_url").alias("channel_thumbnail_url"), none.alias("keywords"), *keep,
    )
    thumbs = F.when(F.col("channel_thumbnail_url").isNotNull(), F.array("channel_thumbnail_url")).otherwise(none) if thumbnail_as_video_thumbnail else none
    return out.withColumn("thumbnails", thumbs).filter("video_id is not null")


def completeness(formats: Column | None = None) -> Column:
    """video-dlp, video-min or null over a video record's columns."""
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    text = lambda c: F.coalesce(F.length(c), F.lit(0)) > 0
    bar = (
        text("title") & some("thumbnails") & (text("channel_handle") | text("channel_id")) & F.col("view_count").isNotNull() & F.col("like_count").isNotNull()
        & text("url") & text("embed_url") & text("description") & some("keywords") & some("tags")
    )
    return F.when(bar & (F.coalesce(F.size(formats), F.lit(0)) > 0 if formats is not None else F.lit(False)), "video-dlp").when(bar, "video-min")


def to_channels(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Channel facts of every row with a key: the id, else the handle; a channel column that starts with @ counts as a handle."""
    name = pick(df, "channel_name")
    handle = F.nullif(F.regexp_replace(F.coalesce(pick(df, "channel_handle"), F.when(name.startswith("@"), name)), "^@+", ""), F.lit(""))
    cid = pick(df, "channel_id")
    return df.select(F.coalesce(cid, handle).alias("key"), cid.alias("channel_id"), handle.alias("channel_handle"), F.when(~name.startswith("@"), name).alias("channel_name"), N.lenient_int(pick(df, "channel_subs")).alias("subs"), *keep).filter("key is not null")


def first_seen(channels: DataFrame, *order: str) -> DataFrame:
    """One row per key: the first by the order of datasets, files and rows."""
    cols = [c for c in channels.columns if c != "key"]
    return channels.groupBy("key").agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("r")).select("key", "r.*")


def import_statistics(rows: DataFrame, dataset: str, outcome: str, outcomes: tuple[str, ...]) -> DataFrame:
    """(dataset, n, one count per outcome) by dataset and, with a null dataset, over all."""
    return rows.rollup(dataset).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(outcome) == o).alias(o) for o in outcomes])


#: Names that a record's columns have in its document.
DOCUMENT_NAMES = {"duration_s": "duration", "published": "published_timestamp", "uploaded": "uploaded_timestamp"}


def import_documents(docs: DataFrame, existing: DataFrame, schema_text: str, payload: str = "payload", overwrite: bool = False) -> DataFrame:
    """docs with video_id, outcome, reason and document: downloader info documents read, mapped, validated and decided in one job.

    In this order: error where there is no record (no JSON object, no id), skipped where the id exists already, unless overwrite,
    error where the mapped record breaks the schema, else written. reason says why not; document is the mapped record as JSON,
    with the properties that the schema has and without nulls, where it is to be written. A repeated id is decided each time."""
    tag = "_x_columns"
    rows = X.info_rows(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(tag), F.col(payload)), payload)
    captions = {c: F.transform_values(c, lambda k, v: F.struct(k.alias("language_code"), v.alias("url"))) for c in ("subtitles", "automatic_captions")}
    known, fields = json.loads(schema_text).get("properties", {}), []
    for c in rows.columns:
        if c not in (tag, "error") and (name := DOCUMENT_NAMES.get(c, c)) in known:
            fields.append(captions.get(c, F.col(c)).alias(name))
    document = F.to_json(F.struct(*fields), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'"}) if fields else F.lit("{}")
    valid = V.validate(rows.withColumn("document", document), schema_text, "document", "_invalid")
    have = existing.select("video_id", F.lit(True).alias("_have")).distinct()
    there = F.coalesce("_have", F.lit(False)) & F.lit(not overwrite)
    joined = valid.join(have, "video_id", "left")
    outcome = F.when(F.col("error").isNotNull(), "error").when(there, "skipped").when(F.col("_invalid").isNotNull(), "error").otherwise("written")
    reason = F.coalesce("error", F.when(~there, F.col("_invalid")))
    done = joined.withColumn("outcome", outcome).withColumn("reason", reason)
    return done.select(f"{tag}.*", "video_id", "outcome", "reason", F.when(F.col("outcome") == "written", F.col("document")).alias("document"))
