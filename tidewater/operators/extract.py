"""Nested JSON, XML and HTML payloads opened into typed rows."""

from __future__ import annotations

import functools
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import web as W

_TEXT = "struct<content:string,simpleText:string,runs:array<struct<text:string>>>"
_THUMB = "array<struct<url:string,width:int,height:int>>"


def typed_path(payload: Column, path: str, kind: str) -> Column:
    """Value at a path, null when it is not there or of another type."""
    v = F.try_variant_get(F.try_parse_json(payload), path, "variant")
    names = {"string": ("STRING",), "bigint": ("BIGINT",), "double": ("DOUBLE", "DECIMAL", "BIGINT"), "boolean": ("BOOLEAN",)}[kind]
    return F.when(F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1).isin(*names), F.try_variant_get(v, "$", kind))


def text_of(t: Column) -> Column:
    """Text of a text object: content, simpleText, or its runs in a row."""
    return F.coalesce(t["content"], t["simpleText"], F.array_join(F.transform(t["runs"], lambda r: r["text"]), ""))


def _find(node, key: str):
    todo = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if x.get(key):
                return x[key]
            todo.extend(reversed(list(x.values())))
        elif isinstance(x, list):
            todo.extend(reversed(x))
    return None


def _load(text):
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None


def json_find(key: str):
    """Arrow function: the first value that is not empty under a key, at any depth and in document order, as JSON text."""

    @F.pandas_udf("string")
    def find(texts: pd.Series) -> pd.Series:
        found = [_find(_load(t), key) if isinstance(t, str) and f'"{key}"' in t else None for t in texts]
        return pd.Series([None if x is None else json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in found], dtype=object)

    return find


#: Fields that name a video's author, in the order in which they are tried.
BYLINES = ("ownerText", "longBylineText", "shortBylineText")


def _author(renderer: dict):
    """(name, channel id) of the first run that leads to a channel: its handle, else channel/ and its id."""
    for field in BYLINES:
        runs = (renderer.get(field) or {}).get("runs")
        for run in runs if isinstance(runs, list) else []:
            end = ((run.get("navigationEndpoint") or {}).get("browseEndpoint") or {}) if isinstance(run, dict) else {}
            base, browse = end.get("canonicalBaseUrl"), end.get("browseId")
            known = browse if isinstance(browse, str) and browse.startswith("UC") else None
            name = base.lstrip("/@") if isinstance(base, str) and base else known and f"channel/{known}"
            if name:
                return {"name": name, "channel_id": browse if isinstance(browse, str) else None}
    return None


def _authors(text):
    out, todo = {}, [_load(text)] if isinstance(text, str) and "videoRenderer" in text else []
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            found = _author(x["videoRenderer"]) if isinstance(x.get("videoRenderer"), dict) else None
            if found:
                out.setdefault(found["name"], found)
            todo.extend(reversed(list(x.values())))
        elif isinstance(x, list):
            todo.extend(reversed(x))
    return list(out.values())


def collect_authors(payload: Column) -> Column:
    """Authors (name, channel_id) of the video renderers at any depth, each name once."""

    @F.pandas_udf("array<struct<name:string,channel_id:string>>")
    def collect(texts: pd.Series) -> pd.Series:
        return texts.map(_authors)

    return collect(payload)


def embedded_json(html: Column) -> Column:
    """JSON that a page assigns to its initial data, with or without var, or else to its player response; null when there is none that
    parses. An object ends at the first brace that a semicolon follows; escaped single quotes become plain ones."""
    found = [F.replace(F.regexp_extract(html, rf"(?s){name}\s*=\s*(\{{.*?\}});", 1), F.lit("\\'"), F.lit("'")) for name in ("ytInitialData", r'window\["ytInitialData"\]', "ytInitialPlayerResponse")]
    return F.coalesce(*[F.when(F.try_parse_json(f).isNotNull(), f) for f in found])


def last_wins(items: Column, key: str) -> Column:
    """Map by key of an array of structs; the last of a key stays."""
    keys = F.array_distinct(F.transform(items, lambda x: x[key]))
    return F.map_from_entries(F.transform(F.filter(keys, lambda k: k.isNotNull()), lambda k: F.struct(k.alias("key"), F.element_at(F.filter(items, lambda x: x[key] == k), -1).alias("value"))))


def thumbnail_map(thumbs: Column) -> Column:
    """Map label -> thumbnail: by preference, then width; repeated URLs are skipped; a label is the id or WxH, the first one stays."""
    ordered = F.transform(F.array_sort(F.transform(thumbs, lambda t: F.struct(F.coalesce(t["preference"], F.lit(0)).alias("p"), F.coalesce(t["width"], F.lit(0)).alias("w"), t.alias("t")))), lambda s: s["t"])
    label = lambda t: F.coalesce(t["id"], F.concat_ws("x", t["width"], t["height"]))
    start = F.slice(F.transform(ordered, lambda t: F.struct(label(t).alias("key"), t.alias("value"))), 1, 0)

    def step(acc, t):
        seen = F.exists(acc, lambda e: (e["key"] == label(t)) | (e["value"]["url"] == t["url"]))
        return F.when(seen, acc).otherwise(F.concat(acc, F.array(F.struct(label(t).alias("key"), t.alias("value")))))

    return F.map_from_entries(F.aggregate(ordered, start, step))


def default_thumbnail(thumbs: Column) -> Column:
    """URL of the smallest area."""
    return F.array_min(F.transform(thumbs, lambda t: F.struct((t["width"] * t["height"]).alias("a"), t["url"].alias("url"))))["url"]


def largest_thumbnail(thumbs: Column) -> Column:
    """URL of the largest width."""
    return F.array_max(F.transform(thumbs, lambda t: F.struct(t["width"].alias("w"), t["url"].alias("url"))))["url"]


_CHAPTERS = "array<struct<start_time:double,end_time:double,title:string,thumbnail_url:string>>"
_FORMATS = """array<struct<format_id:string,format_note:string,ext:string,audio_ext:string,video_ext:string,protocol:string,audio_codec:string,audiocodec:string,video_codec:string,videocodec:string,container:string,url:string,
    width:int,height:int,fps:double,quality:double,dynamic_range:string,has_drm:boolean,tbr:double,abr:double,asr:int,audio_channels:double,rows:int,cols:int,resolution:string,aspect_ratio:string,format:string,
    fragments:array<struct<url:string,path:string,duration:double>>>>"""
_PLAYER = f"""struct<videoDetails:struct<videoId:string,title:string,lengthSeconds:string,viewCount:string,shortDescription:string,channelId:string,author:string,keywords:array<string>,tags:array<string>,isLiveContent:boolean,isTvFilmVideo:boolean,
        thumbnail:struct<thumbnails:array<struct<id:string,url:string,width:int,height:int>>>,chapters:{_CHAPTERS},formats:{_FORMATS}>,
    microformat:struct<playerMicroformatRenderer:struct<canonicalUrl:string,embed:struct<iframeUrl:string>,ownerProfileUrl:string,isUnlisted:boolean,publishDate:string,uploadDate:string,category:string,likeCount:string,availableCountries:array<string>,isFamilySafe:boolean>>,
    captions:struct<playerCaptionsTracklistRenderer:struct<captionTracks:array<struct<baseUrl:string,languageCode:string,kind:string,vssId:string>>>>,playabilityStatus:struct<status:string,reason:string>>"""
#: Texts of which an empty one counts as nothing, and sets that are merged with what is there.
_TEXTS = {"video_id", "title", "description", "url", "embed_url", "channel_id", "channel_handle", "author_name", "channel_url", "category"}
_SETS = {"keywords", "tags", "countries"}


def _by_label(thumbs: Column) -> Column:
    """Map by id, or by width x height, of thumbnails in their order; the first one of a label stays."""
    label = lambda t: F.coalesce(F.nullif(t["id"], F.lit("")), F.concat_ws("x", t["width"], t["height"]))
    labels = F.array_distinct(F.filter(F.transform(thumbs, label), lambda x: x != ""))
    return F.map_from_entries(F.transform(labels, lambda k: F.struct(k.alias("key"), F.get(F.filter(thumbs, lambda t: label(t) == k), 0).alias("value"))))


def player_rows(df: DataFrame, payload: str = "payload", existing: tuple[str, ...] = ()) -> DataFrame:
    """Video columns of a player response. Columns named in existing are kept where the response has nothing or an empty text;
    their sets are merged with the response's, and an existing category stays in any case."""
    df = df.withColumn("_p", F.from_json(F.col(payload), _PLAYER))
    d, m = F.col("_p.videoDetails"), F.col("_p.microformat.playerMicroformatRenderer")
    tracks = F.col("_p.captions.playerCaptionsTracklistRenderer.captionTracks")
    auto = lambda t: F.coalesce(t["kind"] == "asr", F.lit(False))
    thumbs = d["thumbnail"]["thumbnails"]
    new = {
        "video_id": d["videoId"], "title": d["title"], "description": d["shortDescription"], "url": m["canonicalUrl"], "embed_url": m["embed"]["iframeUrl"],
        "channel_id": d["channelId"], "channel_handle": d["author"], "author_name": d["author"], "channel_url": m["ownerProfileUrl"],
        "duration_s": N.strict_int(d["lengthSeconds"]), "view_count": N.strict_int(d["viewCount"]), "like_count": N.strict_int(m["likeCount"]), "category": m["category"],
        "published": N.lenient_timestamp(m["publishDate"]), "uploaded": N.lenient_timestamp(m["uploadDate"]), "is_live": d["isLiveContent"], "was_live": d["isLiveContent"],
        "privacy_status": F.when(F.coalesce(m["isUnlisted"], F.lit(False)), "private").otherwise("public"), "is_family_safe": m["isFamilySafe"], "is_tv_film_video": d["isTvFilmVideo"],
        "keywords": F.array_sort(F.array_distinct(d["keywords"])), "tags": F.array_sort(F.array_distinct(d["tags"])), "countries": F.array_sort(F.array_distinct(m["availableCountries"])),
        "subtitles": last_wins(F.filter(tracks, lambda t: ~auto(t)), "languageCode"), "automatic_captions": last_wins(F.filter(tracks, auto), "languageCode"),
        "thumbnail_url": default_thumbnail(thumbs), "thumbnails": _by_label(thumbs), "chapters": d["chapters"], "formats": last_wins(known_formats(d["formats"]), "format_id"),
        "age_restricted": F.coalesce(F.col("_p.playabilityStatus.status") == "LOGIN_REQUIRED", F.lit(False)),
    }
    none = F.array().cast("array<string>")
    cols = []
    for name, value in new.items():
        value = F.nullif(value, F.lit("")) if name in _TEXTS else value
        if name in existing:
            if name in _SETS:
                value = F.array_sort(F.array_union(F.coalesce(F.col(name), none), F.coalesce(value, none)))
            elif name == "category":
                value = F.coalesce(F.nullif(F.col(name), F.lit("")), value)
            else:
                value = F.coalesce(value, F.col(name))
        cols.append(value.alias(name))
    return df.select(*[c for c in df.columns if c not in (*new, "_p", payload)], *cols)


def known_formats(formats: Column) -> Column:
    """Formats with one name per codec, and the channels' number."""
    same = ("format_id", "format_note", "ext", "audio_ext", "video_ext", "protocol", "container", "url", "width", "height", "fps", "quality", "dynamic_range", "has_drm", "tbr", "abr", "asr", "audio_channels", "rows", "cols", "resolution", "aspect_ratio", "format", "fragments")
    return F.transform(formats, lambda x: F.struct(*[x[n].alias(n) for n in same], F.coalesce(x["audio_codec"], x["audiocodec"]).alias("audio_codec"), F.coalesce(x["video_codec"], x["videocodec"]).alias("video_codec")))


_DLP = f"""struct<id:string,webpage_url:string,title:string,fulltitle:string,description:string,channel_id:string,channel_url:string,channel_is_verified:boolean,channel_follower_count:bigint,uploader_id:string,playable_in_embed:boolean,
    view_count:bigint,like_count:bigint,comment_count:bigint,is_live:boolean,was_live:boolean,availability:string,duration:double,upload_date:string,timestamp:double,media_type:string,tags:array<string>,categories:array<string>,language:string,age_limit:int,
    heatmap:array<map<string,double>>,aspect_ratio:double,chapters:{_CHAPTERS},thumbnails:array<struct<id:string,url:string,width:int,height:int,preference:int>>,formats:{_FORMATS},
    subtitles:map<string,array<struct<url:string,ext:string>>>,automatic_captions:map<string,array<struct<url:string,ext:string>>>>"""


def info_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Video records of downloader info documents, with error: null, or why there is no record: "not a JSON object" or
    "missing required 'id'". The day of upload comes before the exact time, and both published and uploaded are that time;
    of a language's captions the last stays; an unknown or absent media type is null."""
    rows = df.withColumn("_i", F.from_json(F.col(payload), _DLP)).withColumn("_v", F.try_parse_json(F.col(payload)))
    i, no = F.col("_i"), F.lit(False)
    has_id = F.coalesce(F.schema_of_variant(F.try_variant_get("_v", "$.id", "variant")) == "STRING", no) & (i["id"] != "")
    error = F.when(F.col("_v").isNull() | ~F.schema_of_variant("_v").startswith("OBJECT"), "not a JSON object").when(~has_id, "missing required 'id'")
    when = F.coalesce(N.lenient_timestamp(i["upload_date"]), F.timestamp_seconds(i["timestamp"]))
    caption = lambda c: F.transform_values(F.map_filter(c, lambda k, v: F.size(v) > 0), lambda k, v: F.element_at(v, -1)["url"])
    record = {
        "video_id": i["id"], "url": F.coalesce(F.nullif(i["webpage_url"], F.lit("")), W.watch_url(i["id"])), "embed_url": W.embed_url(i["id"]), "title": i["title"], "long_title": i["fulltitle"], "description": i["description"],
        "channel_id": i["channel_id"], "channel_handle": F.nullif(F.regexp_replace(i["uploader_id"], "^@+", ""), F.lit("")), "channel_url": i["channel_url"], "channel_is_verified": i["channel_is_verified"],
        "channel_follower_count": i["channel_follower_count"], "embedable": F.coalesce(i["playable_in_embed"], F.lit(True)), "view_count": i["view_count"], "like_count": i["like_count"], "comment_count": i["comment_count"],
        "is_live": F.coalesce(i["is_live"], no), "was_live": F.coalesce(i["was_live"], no), "availability": i["availability"], "duration_s": i["duration"], "published": when, "uploaded": when, "media_type": W.media_type(i["media_type"]),
        "tags": F.coalesce(F.array_sort(F.array_distinct(i["tags"])), F.array().cast("array<string>")), "category": F.get(i["categories"], 0), "default_audio_language": i["language"], "age_limit": F.coalesce(i["age_limit"], F.lit(0)),
        "heatmaps": F.coalesce(i["heatmap"], F.array().cast("array<map<string,double>>")), "aspect_ratio": F.coalesce(i["aspect_ratio"], F.lit(0.0)), "chapters": i["chapters"],
        "thumbnails": thumbnail_map(i["thumbnails"]), "formats": last_wins(known_formats(i["formats"]), "format_id"), "subtitles": caption(i["subtitles"]), "automatic_captions": caption(i["automatic_captions"]),
    }
    told = rows.withColumn("_error", error)
    others = [c for c in df.columns if c not in (payload, *record, "error")]
    return told.select(*others, *[F.when(F.col("_error").isNull(), v).alias(n) for n, v in record.items()], F.col("_error").alias("error"))


_FEED = """entry array<struct<`yt:videoId`:string,`yt:channelId`:string,title:string,author:struct<name:string,uri:string>,published:string,updated:string,`media:group`:struct<`media:description`:string,
    `media:thumbnail`:struct<_url:string,_width:int,_height:int>,`media:community`:struct<`media:statistics`:struct<_views:bigint>>>>>"""


def feed_rows(df: DataFrame, payload: str = "payload", handle: Column | None = None) -> DataFrame:
    """(other columns, video_id, title, url, embed_url, channel_id, channel_handle, channel_url, author_name, published, uploaded,
    description, view_count, thumbnail_url) of the entries of RSS feeds; entries without id or title are dropped, and so is a feed
    that is no XML. handle is the channel's, from a source that knows it: a feed only has a name for its author."""
    e = df.withColumn("_handle", F.lit(None).cast("string") if handle is None else handle).withColumn("_e", F.explode(F.from_xml(F.col(payload), _FEED, {"ignoreNamespace": "false"})["entry"]))
    part = lambda *path: functools.reduce(lambda c, n: c[n], path, F.col("_e"))
    text = lambda *path: F.nullif(F.trim(part(*path)), F.lit(""))
    own = text("yt:videoId")
    out = e.select(
        *[c for c in df.columns if c != payload], own.alias("video_id"), text("title").alias("title"), W.watch_url(own).alias("url"), W.embed_url(own).alias("embed_url"), text("yt:channelId").alias("channel_id"),
        F.col("_handle").alias("channel_handle"), F.coalesce(text("author", "uri"), W.handle_url(F.col("_handle"))).alias("channel_url"), text("author", "name").alias("author_name"),
        N.lenient_timestamp(text("published")).alias("published"), N.lenient_timestamp(text("updated")).alias("uploaded"), text("media:group", "media:description").alias("description"),
        part("media:group", "media:community", "media:statistics", "_views").alias("view_count"), text("media:group", "media:thumbnail", "_url").alias("thumbnail_url"),
    )
    return out.filter("video_id is not null and title is not null")


def no_content(*collections: str) -> Column:
    """A channel without videos, playlists, courses, podcasts and products."""
    return sum((F.coalesce(F.size(c), F.lit(0)) for c in collections[1:]), F.coalesce(F.size(collections[0]), F.lit(0))) <= 0


def normal_formats(formats: Column) -> Column:
    """Formats under alternative field names (audio_codec or audiocodec, thumb_url or thumbnail_url) as one shape."""
    return F.transform(formats, lambda x: F.struct(x["format_id"].alias("format_id"), F.coalesce(x["audio_codec"], x["audiocodec"]).alias("audio_codec"), F.coalesce(x["thumb_url"], x["thumbnail_url"]).alias("thumbnail_url"), F.coalesce(x["video_count"], F.lit(0)).alias("video_count")))
