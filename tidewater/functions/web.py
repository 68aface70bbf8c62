"""URLs, hosts, HTTP outcomes, error texts, media types."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .channels import non_empty, strip

#: Words of error messages and the reason each stands for; the first match in this order counts.
ERROR_REASONS = (
    ("rate_limit", ("rate-limited by youtube", "vpn/proxy detected", "youtube blocked", "captcha", "try again later", "the page needs to be reloaded",
                    " 429", "http 429", "429 too many", "expected string or bytes-like object")),
    ("missing_data", ("missing microformat data",)),
    ("unavailable", ("this video is private", "this video has been removed", "video is age restricted", "sign in to confirm your age",
                     "available to this channel's members on level", "members-only content", "this live event will begin in",
                     "this live event has ended", "live stream recording is not available", "music premium", "video unavailable",
                     "video is not available", "video available in your country", "not available in your country", "copyright",
                     "inappropriate", "uploader", "offline.")),
    ("premiere", ("premieres", "premiere")),
    ("transient", ("offline", "timed out", "sslerror", "ssl:", "unable to connect to proxy")),
)

#: Media types by lower-cased name.
MEDIA_TYPES = {"video": "video", "short": "short", "shorts": "short", "playlist": "playlist", "channel": "channel", "live": "live", "movie": "movie"}

#: Labels of social networks by name in a domain.
NETWORKS = {
    "facebook": "Facebook", "twitter": "Twitter", "x": "X", "instagram": "Instagram", "youtube": "YouTube", "linkedin": "LinkedIn",
    "pinterest": "Pinterest", "tumblr": "tumblr", "reddit": "reddit", "snapchat": "Snapchat", "flickr": "flickr", "tiktok": "TikTok",
    "whatsapp": "WhatsApp", "telegram": "Telegram", "signal": "Signal", "messenger": "messenger", "parler": "Parler", "gab": "Gab",
    "rumble": "Rumble", "patreon": "Patreon", "twitch": "twitch", "spotify": "Spotify", "discord": "Discord", "slack": "Slack",
    "nebula": "Nebula", "wechat": "WeChat", "douyin": "Douyin", "kuaishou": "Kuaishou", "weibo": "Weibo", "qq": "QQ", "qzone": "Qzone",
    "myjosh": "Josh", "microsoft": "Teams", "quora": "Quora", "skype": "Skype", "tieba": "Tieba", "baidu": "Baidu", "viber": "Viber",
    "line": "Line", "imo": "Imo", "xiaohongshu": "Xiaohongshu", "likee": "Likee", "picsart": "Picsart", "soundcloud": "SoundCloud",
    "onlyfans": "OnlyFans", "vevo": "Vevo", "vk": "VK", "threads": "Threads", "zoom": "Zoom", "meet": "Meet", "clubhouse": "Clubhouse",
    "imessage": "iMessage", "facetime": "FaceTime", "byo": "BYO.Tube", "steampowered": "Steam", "linktr.ee": "Linktree", "amzn": "Amazon",
    "amazon": "Amazon",
}

#: Last parts of domains whose name stands two parts before.
SECOND_LEVEL = ("tt", "uk", "au", "nz", "ng")


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for x in chain(*table.items())]), key)


def error_reason(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    pairs = [(reason, word) for reason, words in ERROR_REASONS for word in words]
    found = F.when(low.contains(pairs[0][1]), pairs[0][0])
    for reason, word in pairs[1:]:
        found = found.when(low.contains(word), reason)
    return found.otherwise("other")


def status_class(code: Column) -> Column:
    return F.when(code.isNull(), "error").when(code == 404, "not_found").otherwise(F.concat(F.floor(code / 100).cast("string"), F.lit("xx")))


def rejection(code: Column) -> Column:
    """struct(outcome, level) of a response that is no success."""
    outcome = F.when(code == 404, "not_found").otherwise("failure")
    level = F.when(code == 404, "info").when((code >= 500) & (code < 600), "error").otherwise("warning")
    return F.struct(outcome.alias("outcome"), level.alias("level"))


def retry_after(header: Column, default: float) -> Column:
    return F.greatest(F.lit(1.0), F.coalesce(strip(header).try_cast("double"), F.lit(float(default))))


def feed_failure(code: Column) -> Column:
    """struct(reason, trips): failure reason of a feed request and whether it counts for the breaker."""
    reason = F.when(code == 404, "not_found").when((code >= 500) & (code < 600), "server_error").when(code >= 400, "http_error")
    return F.struct(reason.alias("reason"), reason.isin("not_found", "server_error").alias("trips"))


def proxy_host(x: Column) -> Column:
    """Host of a proxy URL without credentials and port; null for IPv6 and malformed hosts."""
    host = F.regexp_extract(x, r"^(?:[^:]+://)?(?:[^@]*@)?([^:@/]*)", 1)
    good = host.rlike(r"^[A-Za-z0-9]([A-Za-z0-9.-]*[A-Za-z0-9])?$") & ~x.contains("[") & (F.length(x) - F.length(F.replace(x, F.lit(":"), F.lit(""))) <= 3)
    return F.when(good, host)


def link_label(url: Column) -> Column:
    """Label of an external link by its domain."""
    bare = F.regexp_replace(url, "^https?://", "")
    host = F.substring_index(bare, "/", 1)
    parts = F.split(host, "[.]")
    parts = F.when(parts[0] == "www", F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))).otherwise(parts)
    name = (
        F.when(F.size(parts) == 2, F.get(parts, F.lit(0)))
        .when(F.element_at(parts, -1).isin(*SECOND_LEVEL) & (F.size(parts) >= 3), F.get(parts, F.size(parts) - 3))
        .otherwise(bare)
    )
    return F.coalesce(lookup(NETWORKS, F.lower(name)), F.lit("www"))


def data_url(url: Column) -> Column:
    """struct(owner, platform, entity, version) of /api/v1/data/param/owner/platform/entity/version/..."""
    parts = F.split(F.regexp_extract(F.parse_url(url, F.lit("PATH")), "^/api/v1/data/param/(.+)$", 1), "/")
    names = ("owner", "platform", "entity", "version")
    return F.struct(*[non_empty(F.get(parts, F.lit(k))).alias(n) for k, n in enumerate(names)])


def media_type(kind: Column) -> Column:
    return lookup(MEDIA_TYPES, F.lower(strip(kind)))


def watch_url(video_id: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/watch?v="), video_id)


def embed_url(video_id: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/embed/"), video_id)


def handle_url(handle: Column) -> Column:
    return F.concat(F.lit("https://www.youtube.com/@"), handle)


def with_scheme(url: Column) -> Column:
    return F.when(url.startswith("//"), F.concat(F.lit("https:"), url)).otherwise(url)


def age_restricted(status: Column, reason: Column) -> Column:
    return F.coalesce(F.upper(status) == "AGE_VERIFICATION_REQUIRED", F.lit(False)) | F.coalesce(F.lower(reason).contains("age"), F.lit(False))


def split_quoted(text: Column) -> Column:
    """Distinct words of a text cut at commas and blanks; double quotes hold words together, a backslash makes a quote literal."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("word"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"))

    def step(acc, c):
        flush = ~acc["quoted"] & ~acc["escaped"] & c.isin(",", " ")
        quote = ~acc["escaped"] & (c == '"')
        escape = ~acc["escaped"] & (c == "\\")
        done = F.when(flush & (acc["word"] != ""), F.concat(acc["done"], F.array(acc["word"]))).otherwise(acc["done"])
        word = F.when(flush, "").when(quote | escape, acc["word"]).otherwise(F.concat(acc["word"], F.when(acc["escaped"] & (c != '"'), F.concat(F.lit("\\"), c)).otherwise(c)))
        return F.struct(done.alias("done"), word.alias("word"), F.when(quote, ~acc["quoted"]).otherwise(acc["quoted"]).alias("quoted"), escape.alias("escaped"))

    end = F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), start, step)
    return F.array_sort(F.array_distinct(F.when(end["word"] != "", F.concat(end["done"], F.array(end["word"]))).otherwise(end["done"])))


def validation_message(pointer: Column, message: Column) -> Column:
    return F.concat(F.when(pointer == "", "<root>").otherwise(pointer), F.lit(": "), message)
