"""Channel and watch pages, as the nested JSON that the service embeds in them or returns for browse and next requests.

Each operator reads only the fields it needs: a schema is made from their dotted paths ("[]" after a name stands for an array),
so Spark's JSON parser skips the rest of a page. What a page lacks, or holds in another type, is null.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import web as W
from .extract import collect_authors, text_of

#: Paths of the service's page layouts.
TABS = "contents.twoColumnBrowseResultsRenderer.tabs[].tabRenderer"
GRID = "content.richGridRenderer.contents[]"
ITEM = "richItemRenderer.content"
SECTIONS = "content.sectionListRenderer.contents[].itemSectionRenderer.contents[]"
META = "metadata.channelMetadataRenderer"
HEADER = "header.pageHeaderRenderer.content.pageHeaderViewModel"
OTHER_HEADER = "header.pageHeaderRenderer.metadata"
OLD_HEADER = "header.c4TabbedHeaderRenderer"
ROWS = "contentMetadataViewModel.metadataRows[].metadataParts[].text.content"
AVATAR = "image.decoratedAvatarViewModel.avatar.avatarViewModel.image.sources"
BANNERS = ("banner", "tvBanner", "mobileBanner")
BANNER = "imageBannerViewModel.image.sources"
LINKS = "headerLinks.channelHeaderLinksRenderer.primaryLinks[]"
ABOUT = (
    "onResponseReceivedEndpoints[].showEngagementPanelEndpoint.engagementPanel.engagementPanelSectionListRenderer.content.sectionListRenderer.contents[]"
    ".itemSectionRenderer.contents[].aboutChannelRenderer.metadata.aboutChannelViewModel"
)
MARKERS = "playerOverlays.playerOverlayRenderer.decoratedPlayerBarRenderer.decoratedPlayerBarRenderer.playerBar.multiMarkersPlayerBarRenderer.markersMap[].value.chapters[].chapterRenderer"
PANELS = "engagementPanels[].engagementPanelSectionListRenderer"
WATCH = "contents.twoColumnWatchNextResults.results.results.contents[]"
BUTTONS = "videoPrimaryInfoRenderer.videoActions.menuRenderer.topLevelButtons[]"
OLD_LIKE = "segmentedLikeDislikeButtonRenderer.likeButton.toggleButtonRenderer.defaultText"
NEW_LIKE = "segmentedLikeDislikeButtonViewModel.likeButtonViewModel.likeButtonViewModel.toggleButtonViewModel.toggleButtonViewModel.defaultButtonViewModel.buttonViewModel.accessibilityText"
NEW_LIKE_WORDS = "like this video along with "
CATEGORY = "videoSecondaryInfoRenderer.metadataRowContainer.metadataRowContainerRenderer.rows[].metadataRowRenderer"
CONTINUED = "onResponseReceivedActions[].appendContinuationItemsAction.continuationItems[]"
TOKEN = "continuationItemRenderer.continuationEndpoint.continuationCommand.token"
NO_VIDEO_TABS = ("home", "playlists", "courses", "posts", "store", "podcasts")

TEXT = "struct<content:string,simpleText:string,runs:array<struct<text:string>>>"
IMAGES = "array<struct<url:string,width:int,height:int>>"


def schema(fields: dict[str, str]) -> str:
    """DDL of the struct that holds the fields (path -> type); paths with a common beginning share it."""
    tree: dict = {}
    for path, kind in fields.items():
        node = tree
        *parents, leaf = path.split(".")
        for name in parents:
            node = node.setdefault(name, {})
        node[leaf] = kind

    def ddl(node) -> str:
        if isinstance(node, str):
            return node
        parts = []
        for name, below in node.items():
            inner = ddl(below)
            parts.append(f"`{name.removesuffix('[]')}`:" + (f"array<{inner}>" if name.endswith("[]") else inner))
        return f"struct<{','.join(parts)}>"

    return ddl(tree)


def page(payload: str, fields: dict[str, str]) -> Column:
    return F.from_json(F.col(payload), schema(fields))


def at(root: Column, path: str) -> Column:
    """The value at a path; every "[]" on the way flattens into one array, without nulls."""
    value, many = root, False
    for name in path.split("."):
        key = name.removesuffix("[]")
        if many:
            value = F.transform(value, _field(key))
            value = F.filter(F.flatten(F.filter(value, lambda x: x.isNotNull())) if name.endswith("[]") else value, lambda x: x.isNotNull())
        else:
            value = value[key]
            if name.endswith("[]"):
                many, value = True, F.filter(value, lambda x: x.isNotNull())
    return value


def _field(name: str):
    return lambda x: x[name]


def first(values: Column) -> Column:
    return F.get(F.filter(values, lambda x: x.isNotNull()), F.lit(0))


def flat(arrays: Column) -> Column:
    """The elements of all arrays in a row; a null array has none."""
    return F.flatten(F.filter(arrays, lambda x: x.isNotNull()))


def some(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _others(df: DataFrame, *taken: str) -> list[str]:
    return [c for c in df.columns if c not in taken]


def _path_name(url: Column) -> Column:
    """A channel's name from its path: leading slashes and at signs are taken off."""
    return F.regexp_replace(url, "^[/@]+", "")


def _part_texts(root: Column) -> Column:
    """Texts of the metadata parts of the first header layout that has rows."""
    new, other = at(root, f"{HEADER}.metadata.{ROWS}"), at(root, f"{OTHER_HEADER}.{ROWS}")
    return F.when(F.size(new) > 0, new).otherwise(other)


_CARDS = {f"{TABS}.{SECTIONS}.shelfRenderer.content.{where}.items[].gridChannelRenderer.{field}": "string"
          for where in ("horizontalListRenderer", "gridRenderer") for field in ("navigationEndpoint.commandMetadata.webCommandMetadata.url", "subscriberCountText.simpleText")}


def _cards(shelf: Column, where: str) -> Column:
    cards = at(shelf, f"content.{where}.items[].gridChannelRenderer")
    url = lambda c: c["navigationEndpoint"]["commandMetadata"]["webCommandMetadata"]["url"]
    named = F.filter(cards, lambda c: some(url(c)).isNotNull())
    return F.transform(named, lambda c: F.struct(_path_name(url(c)).alias("name"), some(c["subscriberCountText"]["simpleText"]).alias("subs")))


def channel_page(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, channel_id, title, description, subs, links) of a channel page; links (name, subs) are the channels on its
    shelves, in rows or grids, and the authors of its videos, whose subscribers are unknown."""
    fields = {f"{META}.externalId": "string", f"{META}.title": "string", "header.pageHeaderRenderer.pageTitle": "string", f"{OLD_HEADER}.title": "string",
              f"{HEADER}.description.descriptionPreviewViewModel.description.content": "string", f"{HEADER}.metadata.{ROWS}": "string", f"{OTHER_HEADER}.{ROWS}": "string"}
    p = F.col("_p")
    counts = F.transform(F.filter(_part_texts(p), lambda t: (t != "") & ~t.startswith("@")), N.convert_count)
    shelves = flat(F.transform(at(p, f"{TABS}.{SECTIONS}.shelfRenderer"), lambda s: F.when(F.coalesce(F.size(at(s, "content.horizontalListRenderer.items[]")), F.lit(0)) > 0, _cards(s, "horizontalListRenderer")).otherwise(_cards(s, "gridRenderer"))))
    link = "array<struct<name:string,subs:bigint>>"
    shown = F.transform(shelves, lambda c: F.struct(c["name"].alias("name"), N.convert_count(c["subs"]).alias("subs"))).cast(link)
    authors = F.transform("_a", lambda a: F.struct(a["name"].alias("name"), F.lit(None).cast("bigint").alias("subs"))).cast(link)
    none = F.array().cast(link)
    return df.withColumn("_p", page(payload, fields | _CARDS)).withColumn("_a", collect_authors(F.col(payload))).select(
        *_others(df, payload), at(p, f"{META}.externalId").alias("channel_id"), F.coalesce(some(at(p, f"{META}.title")), some(at(p, "header.pageHeaderRenderer.pageTitle")), some(at(p, f"{OLD_HEADER}.title"))).alias("title"),
        at(p, f"{HEADER}.description.descriptionPreviewViewModel.description.content").alias("description"), first(counts).alias("subs"),
        F.array_sort(F.array_union(F.coalesce(shown, none), F.coalesce(authors, none))).alias("links"),
    )


def featured_links(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, name, subs) of the channels on a page's rows of channels; those without a subscriber text are left out."""
    found = df.withColumn("_p", page(payload, _CARDS)).withColumn("_c", F.explode(flat(F.transform(at(F.col("_p"), f"{TABS}.{SECTIONS}.shelfRenderer"), lambda s: _cards(s, "horizontalListRenderer")))))
    return found.filter("_c.subs is not null").select(*_others(df, payload), "_c.name", N.convert_count(F.col("_c.subs")).alias("subs")).distinct()


def channel_counts(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, videos, subscribers, views): the first part of the header's rows that names them and holds a number, else the old header."""
    fields = {f"{HEADER}.metadata.{ROWS}": "string", f"{OLD_HEADER}.videosCountText.runs[].text": "string", f"{OLD_HEADER}.viewCountText.simpleText": "string"}
    p = F.col("_p")
    parts = at(p, f"{HEADER}.metadata.{ROWS}")
    named = lambda word: F.transform(F.filter(parts, lambda t: t.contains(word)), N.convert_count)
    return df.withColumn("_p", page(payload, fields)).select(
        *_others(df, payload), F.coalesce(first(named("video")), N.convert_count(F.get(at(p, f"{OLD_HEADER}.videosCountText.runs[].text"), F.lit(0)))).alias("videos"),
        F.get(named("subscribers"), F.lit(0)).alias("subscribers"), F.coalesce(first(named("view")), N.convert_count(at(p, f"{OLD_HEADER}.viewCountText.simpleText"))).alias("views"),
    )


def page_images(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, images): avatars and banners (url, width, height, hint), distinct by URL and size. Avatars come from the
    header and from the metadata or, without these, the old header; banners from the header's three kinds or the old header."""
    fields = {f"{HEADER}.{AVATAR}": IMAGES, f"{META}.avatar.thumbnails": IMAGES, f"{OLD_HEADER}.avatar.thumbnails": IMAGES, f"{OLD_HEADER}.banner.thumbnails": IMAGES}
    fields |= {f"{HEADER}.{kind}.{BANNER}": IMAGES for kind in BANNERS}
    p, of = F.col("_p"), "array<struct<url:string,width:int,height:int,hint:string>>"
    full = lambda u: F.when(u.startswith("https://"), u).otherwise(F.concat(F.lit("https:"), u))
    images = lambda c, hint, url=lambda u: u: F.coalesce(F.transform(c, lambda t: F.struct(url(t["url"]).alias("url"), t["width"].alias("width"), t["height"].alias("height"), F.lit(hint).cast("string").alias("hint"))).cast(of), F.array().cast(of))
    meta = at(p, f"{META}.avatar.thumbnails")
    avatars = F.concat(images(at(p, f"{HEADER}.{AVATAR}"), None, full), images(F.when(F.size(meta) > 0, meta).otherwise(at(p, f"{OLD_HEADER}.avatar.thumbnails")), None, full))
    shown = [at(p, f"{HEADER}.{kind}.{BANNER}") for kind in BANNERS]
    old = F.when(F.coalesce(F.size(shown[0]), F.lit(0)) <= 0, at(p, f"{OLD_HEADER}.banner.thumbnails"))
    every = F.concat(avatars, *[images(c, kind) for c, kind in zip(shown, BANNERS)], images(old, None))
    same = lambda a, b: a["url"].eqNullSafe(b["url"]) & a["width"].eqNullSafe(b["width"]) & a["height"].eqNullSafe(b["height"])
    distinct = F.aggregate(every, F.array().cast(of), lambda acc, t: F.when(F.exists(acc, lambda a: same(a, t)), acc).otherwise(F.concat(acc, F.array(t))))
    return df.withColumn("_p", page(payload, fields)).select(*_others(df, payload), distinct.alias("images"))


_ABOUT = {f"{META}.{name}": kind for name, kind in {"externalId": "string", "title": "string", "description": "string", "rssUrl": "string", "availableCountryCodes": "array<string>", "vanityChannelUrl": "string", "ownerUrls": "array<string>", "keywords": "string", "isFamilySafe": "boolean"}.items()} | {
    f"{ABOUT}.{name}": TEXT for name in ("joinedDateText",)} | {f"{ABOUT}.{name}": "string" for name in ("viewCountText", "videoCountText", "subscriberCountText", "description", "country")} | {f"{HEADER}.metadata.{ROWS}": "string", f"{OLD_HEADER}.viewCountText.simpleText": "string"}


def about_rows(df: DataFrame, payload: str = "payload", existing: tuple[str, ...] = ()) -> DataFrame:
    """Channel columns of an about page, from the channel's metadata and then the about panel. Of the columns named in existing, title
    and numbers stay where they are set, id, description and feed are replaced where the page has them, countries and keywords are united."""
    p = F.col("_p")
    m = lambda name: at(p, f"{META}.{name}")
    about = F.get(at(p, ABOUT), F.lit(0))
    # texts of the panel are plain strings or text objects; objects arrive as JSON text
    text = lambda name: F.coalesce(text_of(F.from_json(about[name], TEXT)), about[name])
    views = F.coalesce(first(F.transform(F.filter(at(p, f"{HEADER}.metadata.{ROWS}"), lambda t: t.contains("view")), N.convert_count)), N.convert_count(at(p, f"{OLD_HEADER}.viewCountText.simpleText")))
    vanity = F.coalesce(some(m("vanityChannelUrl")), F.get(m("ownerUrls"), F.lit(0)))
    words, none = "array<string>", F.array().cast("array<string>")
    new = {
        "channel_id": m("externalId"), "title": some(m("title")), "description": F.coalesce(m("description"), some(text("description"))), "rss_url": m("rssUrl"), "country": some(text("country")),
        "channel_handle": some(F.substring_index(F.regexp_extract(vanity, "/@(.*)$", 1), "/@", 1)), "joined": N.lenient_timestamp(text_of(about["joinedDateText"])), "view_count": F.coalesce(N.convert_count(text("viewCountText")), views),
        "video_count": N.convert_count(text("videoCountText")), "subscriber_count": N.convert_count(text("subscriberCountText")), "is_family_safe": F.coalesce(m("isFamilySafe"), F.lit(False)),
        "countries": F.coalesce(m("availableCountryCodes"), none), "keywords": F.coalesce(W.split_quoted(m("keywords")), none),
    }
    kept = {"title": lambda c: some(F.col(c)), **{c: lambda c: F.nullif(F.col(c), F.lit(0)) for c in ("view_count", "video_count", "subscriber_count")}, "joined": F.col}

    def value(name: str) -> Column:
        if name in ("countries", "keywords"):
            return F.array_sort(F.array_union(F.coalesce(F.col(name), none), new[name]) if name in existing else F.array_distinct(new[name])).cast(words)
        if name not in existing:
            return new[name]
        return F.coalesce(kept[name](name), new[name]) if name in kept else F.coalesce(new[name], F.col(name))

    return df.withColumn("_p", page(payload, _ABOUT)).select(*_others(df, *new, payload), *[value(n).alias(n) for n in new])


def external_links(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, url, label, priority) of the links in a page's header and about panel, each in order with priorities 10, 20, ...
    A link of the panel without a title is named by its domain; a text that only counts further links is left out but has its priority."""
    header = {f"{h}.{LINKS}.{f}": "string" for h in (OLD_HEADER, "header.pageHeaderRenderer") for f in ("navigationEndpoint.urlEndpoint.url", "title.simpleText")}
    model = f"{ABOUT}.links[].channelExternalLinkViewModel"
    p = F.col("_p")
    old, new = at(p, f"{OLD_HEADER}.{LINKS}"), at(p, f"header.pageHeaderRenderer.{LINKS}")
    address = lambda x: x["navigationEndpoint"]["urlEndpoint"]["url"]
    shown = F.filter(F.when(at(p, OLD_HEADER).isNotNull(), old).otherwise(new), lambda x: some(address(x)).isNotNull())
    shown = F.transform(shown, lambda x, i: F.struct(address(x).alias("url"), F.coalesce(x["title"]["simpleText"], F.lit("Link")).alias("label"), ((i + 1) * 10).alias("priority")))
    listed = at(F.get(at(p, ABOUT), F.lit(0)), "links[].channelExternalLinkViewModel")
    bare = lambda x: F.regexp_replace(x["link"]["content"], "^https?://", "")
    listed = F.transform(listed, lambda x, i: F.struct(F.concat(F.lit("https://"), bare(x)).alias("url"), F.coalesce(some(x["title"]["content"]), W.link_label(bare(x))).alias("label"), ((i + 1) * 10).alias("priority")))
    listed = F.filter(listed, lambda x: x["url"].isNotNull() & ~(x["url"].startswith("https://and ") & (x["label"] == "www")))
    of = "array<struct<url:string,label:string,priority:int>>"
    every = F.concat(*[F.coalesce(c.cast(of), F.array().cast(of)) for c in (shown, listed)])
    return df.withColumn("_p", page(payload, header | {f"{model}.title.content": "string", f"{model}.link.content": "string"})).select(*_others(df, payload), F.inline(every))


def chapters(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, title, time_text, start_s, url) of the chapters of a player's markers (without title or start they are
    dropped, the widest image is taken) and of a watch page's chapter panels."""
    panel = f"{PANELS}.content.sectionListRenderer.contents[].itemSectionRenderer.contents[].macroMarkersListItemRenderer"
    fields = {f"{MARKERS}.title.runs[].text": "string", f"{MARKERS}.timeRangeStartMillis": "bigint", f"{MARKERS}.thumbnail.thumbnails": IMAGES, f"{PANELS}.panelIdentifier": "string",
              f"{panel}.title": TEXT, f"{panel}.timeDescription": TEXT, f"{panel}.onTap.watchEndpoint.startTimeSeconds": "double"}
    p, of = F.col("_p"), "array<struct<title:string,time_text:string,start_s:double,url:string>>"
    widest = lambda t: F.array_max(F.transform(t, lambda x: F.struct(F.coalesce(x["width"], F.lit(0)).alias("w"), x["url"].alias("url"))))["url"]
    marks = F.filter(at(p, MARKERS), lambda c: some(F.get(c["title"]["runs"], F.lit(0))["text"]).isNotNull() & (c["timeRangeStartMillis"] != 0))
    marks = F.transform(marks, lambda c: F.struct(c["title"]["runs"][0]["text"], F.lit(None).cast("string"), c["timeRangeStartMillis"] / 1000, widest(c["thumbnail"]["thumbnails"])))
    panels = F.filter(at(p, PANELS), lambda x: x["panelIdentifier"].contains("chapters") | x["panelIdentifier"].contains("macro-markers"))
    items = flat(F.transform(panels, lambda x: at(x, "content.sectionListRenderer.contents[].itemSectionRenderer.contents[].macroMarkersListItemRenderer")))
    items = F.transform(items, lambda r: F.struct(text_of(r["title"]), text_of(r["timeDescription"]), F.coalesce(r["onTap"]["watchEndpoint"]["startTimeSeconds"], F.lit(0.0)), F.lit(None).cast("string")))
    every = F.concat(*[F.coalesce(c.cast(of), F.array().cast(of)) for c in (marks, items)])
    return df.withColumn("_p", page(payload, fields)).select(*_others(df, payload), F.inline(every))


def watch_page_counts(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, like_count, comment_count, category) of a watch page: likes from the first button of either layout that has
    them, comments from the header of their panel, category from the row of that name."""
    fields = {f"{WATCH}.{BUTTONS}.{OLD_LIKE}": TEXT, f"{WATCH}.{BUTTONS}.{NEW_LIKE}": "string", f"{WATCH}.{CATEGORY}.title": TEXT, f"{WATCH}.{CATEGORY}.contents[]": TEXT, f"{PANELS}.panelIdentifier": "string"}
    heads = ("engagementPanelTitleHeaderRenderer", "commentsEntryPointHeaderRenderer")
    fields |= {f"{PANELS}.header.{h}.contextualInfo": TEXT for h in heads}
    p = F.col("_p")
    results = at(p, WATCH)
    label = lambda b: at(b, NEW_LIKE)
    buttons = at(first(F.transform(results, lambda r: r["videoPrimaryInfoRenderer"])), BUTTONS.removeprefix("videoPrimaryInfoRenderer."))
    likes = F.transform(buttons, lambda b: F.coalesce(N.count_of(text_of(at(b, OLD_LIKE))), F.when(label(b).startswith(NEW_LIKE_WORDS), N.count_of(F.substr(label(b), F.lit(len(NEW_LIKE_WORDS) + 1))))))
    rows = at(first(F.transform(results, lambda r: r["videoSecondaryInfoRenderer"])), CATEGORY.removeprefix("videoSecondaryInfoRenderer."))
    named = F.filter(rows, lambda r: F.lower(text_of(r["title"])).contains("categor"))
    category = first(flat(F.transform(named, lambda r: F.transform(F.coalesce(r["contents"], F.array().cast(f"array<{TEXT}>")), lambda c: some(text_of(c))))))
    panels = F.filter(at(p, PANELS), lambda x: F.lower(x["panelIdentifier"]).contains("comments"))
    comments = first(flat(F.transform(panels, lambda x: F.array(*[some(text_of(x["header"][h]["contextualInfo"])) for h in heads]))))
    there = F.size(results) > 0
    return df.withColumn("_p", page(payload, fields)).select(*_others(df, payload), F.when(there, first(likes)).alias("like_count"), F.when(there, N.count_of(comments)).alias("comment_count"), F.when(there, category).alias("category"))


def _tab(df: DataFrame, payload: str, fields: dict[str, str]) -> DataFrame:
    """A row for each tab, _t its renderer and _title its lower-cased title."""
    tabs = page(payload, {f"{TABS}.title": "string"} | {f"{TABS}.{f}": kind for f, kind in fields.items()})
    return df.withColumn("_t", F.explode(at(tabs, TABS))).withColumn("_title", F.lower("_t.title"))


_SHORT = "shortsLockupViewModel.onTap.innertubeCommand.commandMetadata.webCommandMetadata.url"


def _video_id(item: Column, tab: Column) -> Column:
    url = at(item, _SHORT)
    return F.when(tab == "shorts", F.when(url.startswith("/shorts/"), some(F.element_at(F.split(url, "/"), -1)))).otherwise(item["videoRenderer"]["videoId"])


def tab_items(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, tab, video_id, podcast_id): ids in a page's tabs of videos, live streams, shorts and podcasts."""
    found = _tab(df, payload, {f"{GRID}.{ITEM}.videoRenderer.videoId": "string", f"{GRID}.{ITEM}.{_SHORT}": "string", f"{GRID}.{ITEM}.lockupViewModel.contentId": "string"})
    items = found.withColumn("_i", F.explode(at(F.col("_t"), f"{GRID}.{ITEM}")))
    video = F.when(~F.col("_title").isin(*NO_VIDEO_TABS), _video_id(F.col("_i"), F.col("_title")))
    podcast = F.when(F.col("_title") == "podcasts", some(F.col("_i.lockupViewModel.contentId")))
    out = items.select(*_others(df, payload), F.col("_title").alias("tab"), video.alias("video_id"), podcast.alias("podcast_id"))
    return out.filter("video_id is not null or podcast_id is not null").distinct()


def continued_items(df: DataFrame, tab: Column, payload: str = "payload") -> DataFrame:
    """(other columns, video_ids, token) of a further page of a tab; the token of the page after it is null on the last."""
    item = f"{CONTINUED}.{ITEM}"
    p = F.col("_p")
    got = df.withColumn("_p", page(payload, {f"{item}.videoRenderer.videoId": "string", f"{item}.{_SHORT}": "string", f"{CONTINUED}.{TOKEN}": "string"}))
    ids = F.array_distinct(F.filter(F.transform(at(p, item), lambda i: _video_id(i, tab)), lambda x: x.isNotNull()))
    return got.select(*_others(df, payload), ids.alias("video_ids"), some(at(F.element_at(at(p, CONTINUED), -1), TOKEN)).alias("token"))


def playlist_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, playlist_id, title, video_count, thumbnail_url) of the playlists tab; the last badge with a number of videos counts, none is 0."""
    lock = "gridRenderer.items[].lockupViewModel"
    thumb = f"{SECTIONS}.{lock}.contentImage.collectionThumbnailViewModel.primaryThumbnail.thumbnailViewModel"
    found = _tab(df, payload, {f"{SECTIONS}.{lock}.contentType": "string", f"{SECTIONS}.{lock}.contentId": "string", f"{SECTIONS}.{lock}.metadata.lockupMetadataViewModel.title.content": "string",
                               f"{thumb}.image.sources[].url": "string", f"{thumb}.overlays[].thumbnailOverlayBadgeViewModel.thumbnailBadges[].thumbnailBadgeViewModel.text": "string"})
    # the first entry of every section holds its grid
    grids = F.transform(at(F.col("_t"), "content.sectionListRenderer.contents[]"), lambda s: F.get(s["itemSectionRenderer"]["contents"], F.lit(0)))
    items = found.filter("_title = 'playlists'").withColumn("_l", F.explode(flat(F.transform(F.filter(grids, lambda g: g["gridRenderer"].isNotNull()), lambda g: at(g, lock)))))
    image = F.col("_l.contentImage.collectionThumbnailViewModel.primaryThumbnail.thumbnailViewModel")
    badges = F.filter(at(image, "overlays[].thumbnailOverlayBadgeViewModel.thumbnailBadges[].thumbnailBadgeViewModel.text"), lambda b: b.rlike(r"\d+\s+video"))
    count = F.regexp_extract(F.get(badges, F.size(badges) - 1), r"(\d+)\s+video", 1).try_cast("int")
    out = items.filter("_l.contentType = 'LOCKUP_CONTENT_TYPE_PLAYLIST' and _l.contentId <> ''")
    return out.select(*_others(df, payload), F.col("_l.contentId").alias("playlist_id"), F.col("_l.metadata.lockupMetadataViewModel.title.content").alias("title"), F.coalesce(count, F.lit(0)).alias("video_count"), F.get(at(image, "image.sources[].url"), F.lit(0)).alias("thumbnail_url")).distinct()


def course_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, playlist_id, title, video_count, thumbnail_url, videos) of the courses tab, with the videos it previews; no count is 0."""
    r = f"{GRID}.{ITEM}.playlistRenderer"
    child = f"{r}.videos[].childVideoRenderer"
    found = _tab(df, payload, {f"{r}.playlistId": "string", f"{r}.title.simpleText": "string", f"{r}.videoCount": "string", f"{r}.thumbnails[].thumbnails[].url": "string", f"{child}.navigationEndpoint.watchEndpoint.videoId": "string",
                               f"{child}.title.simpleText": "string", f"{child}.lengthText.accessibility.accessibilityData.label": "string"})
    rows = found.filter("_title = 'courses'").withColumn("_r", F.explode(at(F.col("_t"), r))).filter("_r.playlistId <> ''")
    c = F.col("_r")
    videos = F.transform(at(c, "videos[].childVideoRenderer"), lambda v: F.struct(v["navigationEndpoint"]["watchEndpoint"]["videoId"].alias("video_id"), v["title"]["simpleText"].alias("title"), v["lengthText"]["accessibility"]["accessibilityData"]["label"].alias("duration_label")))
    return rows.select(*_others(df, payload), c["playlistId"].alias("playlist_id"), c["title"]["simpleText"].alias("title"), F.coalesce(c["videoCount"].try_cast("int"), F.lit(0)).alias("video_count"),
        F.get(F.get(c["thumbnails"], F.lit(0))["thumbnails"], F.lit(0))["url"].alias("thumbnail_url"), videos.alias("videos"))


def post_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, post_id, text, published, votes, kind, images, video_id, choices) of the posts tab; kind is image, for one
    or several images, each at its largest, video, poll or null."""
    r = f"{SECTIONS}.backstagePostThreadRenderer.post.backstagePostRenderer"
    a = f"{r}.backstageAttachment"
    found = _tab(df, payload, {f"{r}.postId": "string", f"{r}.contentText.runs[].text": "string", f"{r}.publishedTimeText.runs[].text": "string", f"{r}.voteCount.simpleText": "string", f"{a}.backstageImageRenderer.image.thumbnails[].url": "string",
                               f"{a}.postMultiImageRenderer.images[].backstageImageRenderer.image.thumbnails[].url": "string", f"{a}.videoRenderer.videoId": "string", f"{a}.pollRenderer.choices[].text.runs[].text": "string"})
    rows = found.filter("_title = 'posts'").withColumn("_r", F.explode(at(F.col("_t"), r))).filter("_r.postId <> ''")
    b = F.col("_r.backstageAttachment")
    one, many, video, poll = b["backstageImageRenderer"], b["postMultiImageRenderer"], b["videoRenderer"], b["pollRenderer"]
    joined = lambda runs: F.when(F.size(runs) > 0, F.array_join(F.transform(runs, lambda x: x["text"]), ""))
    largest = lambda i: F.when(F.size(i["image"]["thumbnails"]) > 0, F.coalesce(F.element_at(i["image"]["thumbnails"], -1)["url"], F.lit("")))
    known = lambda c: F.coalesce(F.filter(c, lambda x: x.isNotNull()), F.array().cast("array<string>"))
    kind = F.when(one.isNotNull() | many.isNotNull(), "image").when(video.isNotNull(), "video").when(poll.isNotNull(), "poll")
    images = F.when(one.isNotNull(), known(F.array(largest(one)))).when(many.isNotNull(), known(F.transform(many["images"], lambda i: largest(i["backstageImageRenderer"])))).otherwise(F.array().cast("array<string>"))
    choices = F.when(kind == "poll", known(F.transform(poll["choices"], lambda c: joined(c["text"]["runs"])))).otherwise(F.array().cast("array<string>"))
    return rows.select(*_others(df, payload), F.col("_r.postId").alias("post_id"), joined(F.col("_r.contentText.runs")).alias("text"), F.get(F.col("_r.publishedTimeText.runs"), F.lit(0))["text"].alias("published"),
        F.col("_r.voteCount.simpleText").alias("votes"), kind.alias("kind"), images.alias("images"), F.when(kind == "video", video["videoId"]).alias("video_id"), choices.alias("choices"))


def product_rows(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(other columns, title, price, merchant, thumbnail_url, url) of the store tab; the URL is that of the first command with an address."""
    r = f"{SECTIONS}.shelfRenderer.content.gridRenderer.items[].verticalProductCardRenderer"
    command = f"{r}.navigationEndpoint.commandExecutorCommand.commands[].urlEndpoint.url"
    found = _tab(df, payload, {f"{r}.{f}": "string" for f in ("title", "price", "merchantName", "thumbnail.thumbnails[].url")} | {command: "string"})
    rows = found.filter("_title = 'store'").withColumn("_r", F.explode(at(F.col("_t"), r))).filter("_r.title <> ''")
    c = F.col("_r")
    return rows.select(*_others(df, payload), c["title"].alias("title"), c["price"].alias("price"), c["merchantName"].alias("merchant"), F.get(c["thumbnail"]["thumbnails"], F.lit(0))["url"].alias("thumbnail_url"),
        F.get(at(c, "navigationEndpoint.commandExecutorCommand.commands[].urlEndpoint"), F.lit(0))["url"].alias("url")).distinct()


_WATCH_HTML = "struct<videoDetails:struct<title:string,shortDescription:string,lengthSeconds:string,viewCount:string,category:string,isLive:boolean,isLiveContent:boolean,keywords:array<string>,thumbnail:struct<thumbnails:" + IMAGES + ">>,microformat:struct<playerMicroformatRenderer:struct<lengthSeconds:string,publishDate:string,uploadDate:string,isFamilySafe:boolean,embed:struct<iframeUrl:string>,hasYpcMetadata:boolean,thumbnail:struct<thumbnails:" + IMAGES + ">>>,playabilityStatus:struct<status:string,reason:string>>"


def html_player_rows(df: DataFrame, payload: str = "payload", existing: tuple[str, ...] = ()) -> DataFrame:
    """Video columns of the player response that a watch page embeds, and status: ok, blocked (a login is asked for) or missing (no
    details or no microformat); the columns are null unless ok. A category that is there already stays; keywords are united."""
    p = F.from_json(F.col(payload), _WATCH_HTML)
    d, m, s = F.col("_p.videoDetails"), F.col("_p.microformat.playerMicroformatRenderer"), F.col("_p.playabilityStatus")
    ok = d.isNotNull() & m.isNotNull()
    none = F.array().cast("array<string>")
    listed = F.get(F.from_json(d["category"], "array<string>"), F.lit(0))
    words = F.coalesce(d["keywords"], none)
    new = {
        "title": d["title"], "description": d["shortDescription"], "duration_s": N.strict_int(F.coalesce(m["lengthSeconds"], d["lengthSeconds"])), "view_count": N.convert_count(d["viewCount"]),
        "published": N.lenient_timestamp(m["publishDate"]), "uploaded": N.lenient_timestamp(m["uploadDate"]), "category": some(F.when(d["category"].startswith("["), listed).otherwise(d["category"])),
        "is_family_safe": F.coalesce(m["isFamilySafe"], F.lit(False)), "is_live": F.coalesce(d["isLive"], d["isLiveContent"], F.lit(False)), "keywords": F.array_sort(F.array_union(F.coalesce(F.col("keywords"), none), words) if "keywords" in existing else F.array_distinct(words)),
        "thumbnails": F.array_distinct(F.concat(*[F.coalesce(t["thumbnail"]["thumbnails"], F.array().cast(IMAGES)) for t in (d, m)])), "age_restricted": W.age_restricted(s["status"], s["reason"]),
        "embeddable": m["embed"]["iframeUrl"].isNotNull(), "license": F.when(m["hasYpcMetadata"], "youtube"),
    }
    if "category" in existing:
        new["category"] = F.coalesce(some(F.col("category")), new["category"])
    status = F.when(ok, "ok").when(s["status"] == "LOGIN_REQUIRED", "blocked").otherwise("missing")
    return df.withColumn("_p", p).select(*_others(df, *new, payload), status.alias("status"), *[F.when(ok, v).alias(n) for n, v in new.items()])
