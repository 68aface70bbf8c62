"""Page queries. Pages nest as the service's do, in several layouts, some without the parts an operator looks for; all values come from table columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import pages as P
from .binding import by_case, merged, nest, payloads, rows

QUERIES, SQL = {}, {}


def query(name: str, sql: str):
    def add(f):
        QUERIES[name], SQL[name] = f, sql
        return f

    return add


def tab(title: str, *contents: str) -> str:
    """A page with one tab, after a home tab and a tab without renderer."""
    inner = merged(f'{{"title":"{title}"}}', *contents)
    return nest("contents.twoColumnBrowseResultsRenderer", '{"tabs":[{"expandableTabRenderer":{}},{"tabRenderer":{"title":"Home"}},{"tabRenderer":' + inner + "}]}")


def grid(*items: str) -> str:
    return nest("content.richGridRenderer", '{"contents":[' + ",".join(items) + ',{"continuationItemRenderer":{}}]}')


def sections(*items: str) -> str:
    return nest("content.sectionListRenderer", '{"contents":[{"other":1},' + nest("itemSectionRenderer", '{"contents":[' + ",".join(items) + "]}") + "]}")


def header_rows(*texts: str, where: str = P.HEADER) -> str:
    """A header with rows of one part each, the first without a text."""
    parts = ",".join(nest("metadataParts[].text.content", f'"{t}"') for t in texts)
    return nest(f"{where}.metadata.contentMetadataViewModel" if where == P.HEADER else f"{where}.contentMetadataViewModel", '{"metadataRows":[{"metadataParts":[{"avatarStack":{}}]},' + parts + "]}")


def about(inner: str) -> str:
    return nest(P.ABOUT, inner)


def card(name: str, subs: str, grid_: bool = False) -> str:
    return nest("shelfRenderer.content." + ("gridRenderer" if grid_ else "horizontalListRenderer") + ".items[].gridChannelRenderer", merged(nest("navigationEndpoint.commandMetadata.webCommandMetadata.url", f'"{name}"'), subs))


def subs(text: str) -> str:
    return nest("subscriberCountText.simpleText", f'"{text}"')


def byline(field: str, browse: str, base: str = "") -> str:
    end = merged(f'{{"browseId":"{browse}"}}', f'{{"canonicalBaseUrl":"{base}"}}' if base else "")
    return nest(f"videoRenderer.{field}", '{"runs":[{"text":"and"},' + merged('{"text":"t"}', nest("navigationEndpoint.browseEndpoint", end)) + "]}")


@query("n3_n4_authors", """SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 2 THEN 'channel/UC' ELSE '' END || CAST(o_custkey AS VARCHAR) AS name, CASE WHEN o_orderkey % 3 = 1 THEN 'other' ELSE 'UC' || CAST(o_custkey AS VARCHAR) END AS channel_id FROM orders
    UNION ALL SELECT o_orderkey, 'second', 'UC2' FROM orders WHERE o_orderkey % 3 = 0""")
def n3(spark, sf):
    own = by_case("o_orderkey % 3", byline("ownerText", "UC<<o_custkey>>", "/@<<o_custkey>>") + ',{"deep":[' + byline("ownerText", "UC2", "/@second") + "," + byline("shortBylineText", "UC<<o_custkey>>", "/@<<o_custkey>>") + "]}",
        byline("longBylineText", "other", "/<<o_custkey>>"), byline("shortBylineText", "UC<<o_custkey>>") + "," + byline("ownerText", "nothing"))
    d = rows(spark, sf, payloads("o_orderkey", "orders", '{"x":[{"y":[' + own + "]}]}"))
    return d.select("k", F.inline(P.collect_authors(F.col("payload"))))


@query("n4_channel_page", """SELECT c_custkey AS k, CASE WHEN c_custkey % 3 <> 2 THEN 'UC' || CAST(c_custkey AS VARCHAR) END AS channel_id, c_name AS title, CASE WHEN c_custkey % 3 = 0 THEN 'about ' || c_name END AS description,
    CAST(CASE c_custkey % 3 WHEN 0 THEN c_custkey * 1000 WHEN 1 THEN c_custkey + 5 END AS BIGINT) AS subs,
    CASE c_custkey % 3 WHEN 0 THEN 'author=,h' || CAST(c_custkey AS VARCHAR) || '=' || CAST(c_custkey AS VARCHAR) WHEN 1 THEN 'g' || CAST(c_custkey AS VARCHAR) || '=' ELSE '' END AS links FROM customer""")
def n4(spark, sf):
    new = merged(nest(P.META, '{"externalId":"UC<<c_custkey>>","title":"<<c_name>>"}'), merged(nest("contents", nest("twoColumnBrowseResultsRenderer", nest("tabs[].tabRenderer", sections(card("/@h<<c_custkey>>", subs("<<c_custkey>> subscribers")), byline("ownerText", "UC1", "/@author")))))),
        '{"header":{"pageHeaderRenderer":{"pageTitle":"unused","content":{"pageHeaderViewModel":' + merged(nest("description.descriptionPreviewViewModel.description.content", '"about <<c_name>>"'), nest("metadata.contentMetadataViewModel", '{"metadataRows":[{"metadataParts":[{"text":{"content":"@h"}},{"text":{"content":"<<c_custkey>>K subscribers"}}]}]}')) + "}}}}")
    other = merged(nest(P.META, '{"externalId":"UC<<c_custkey>>","title":""}'), nest("contents", nest("twoColumnBrowseResultsRenderer", nest("tabs[].tabRenderer", sections(card("/g<<c_custkey>>", "", True), '{"shelfRenderer":{}}')))),
        '{"header":{"pageHeaderRenderer":{"pageTitle":"<<c_name>>","metadata":' + nest("contentMetadataViewModel", '{"metadataRows":[{"metadataParts":[{"text":{"content":"@h"}}]},{"metadataParts":[{"text":{"content":"<<c_custkey + 5>>"}}]}]}') + "}}}")
    old = nest(P.OLD_HEADER + ".title", '"<<c_name>>"')
    d = P.channel_page(rows(spark, sf, payloads("c_custkey", "customer", by_case("c_custkey % 3", new, other, old))))
    return d.withColumn("links", F.array_join(F.transform("links", lambda x: F.concat(x["name"], F.lit("="), F.coalesce(x["subs"].cast("string"), F.lit("")))), ","))


@query("n5_featured_links", """SELECT c_custkey AS k, 'h' || CAST(c_custkey AS VARCHAR) AS name, CAST(c_custkey * 1000 AS BIGINT) AS subs FROM customer WHERE c_custkey % 4 < 2
    UNION ALL SELECT c_custkey, 'channel/UC7', 12 FROM customer WHERE c_custkey % 4 = 1""")
def n5(spark, sf):
    one, two = card("/@h<<c_custkey>>", subs("<<c_custkey>>K subscribers")), card("/channel/UC7", subs("12 subscribers"))
    page = by_case("c_custkey % 4", tab("Channels", sections(one, one)), tab("Home", sections('{"shelfRenderer":{}}', one, card("/@x", ""), two)), tab("Channels", sections(card("/@h", ""))), tab("Videos", grid('{"richItemRenderer":{}}')))
    return P.featured_links(rows(spark, sf, payloads("c_custkey", "customer", page)))


@query("n6_channel_counts", """SELECT c_custkey AS k, CAST(CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_custkey END AS BIGINT) AS videos, CAST(CASE WHEN c_custkey % 3 = 0 THEN c_custkey % 90 * 1000000 + 500000 END AS BIGINT) AS subscribers,
    CAST(CASE c_custkey % 3 WHEN 0 THEN NULL ELSE c_custkey * 3 END AS BIGINT) AS views FROM customer""")
def n6(spark, sf):
    new = header_rows("@h", "<<c_custkey % 90>>.5M subscribers", "no videos", "<<c_custkey>> videos", "9 videos")
    old = nest(P.OLD_HEADER, merged(nest("videosCountText.runs[].text", '"<<c_custkey>>"'), nest("viewCountText.simpleText", '"<<c_custkey * 3>> views"')))
    return P.channel_counts(rows(spark, sf, payloads("c_custkey", "customer", by_case("c_custkey % 3", new, old, header_rows("@h", "<<c_custkey * 3>> views")))))


def images(*urls: str) -> str:
    return "[" + ",".join(f'{{"url":"{u}","width":{w},"height":{h}}}' for u, w, h in urls) + "]"


@query("n7_banners", """SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 'https://v/' || CAST(p_partkey AS VARCHAR) || ':1:,https://m:2:,https://b:9:banner,https://t:2:tvBanner' WHEN 1 THEN 'https://v:1:,https://o/' || CAST(p_partkey AS VARCHAR) || ':9:' ELSE 'https://m:2:' END AS images FROM part""")
def n7(spark, sf):
    kinds = merged(nest(P.AVATAR, images(("//v/<<p_partkey>>", 1, 1))), nest(f"banner.{P.BANNER}", images(("https://b", 9, 2), ("https://b", 9, 2))), nest(f"tvBanner.{P.BANNER}", images(("https://t", 2, 1))))
    new = merged(nest(P.HEADER, kinds), nest(f"{P.META}.avatar.thumbnails", images(("https://m", 2, 2))))
    old = nest(P.OLD_HEADER, merged(nest("avatar.thumbnails", images(("//v", 1, 1))), nest("banner.thumbnails", images(("https://o/<<p_partkey>>", 9, 2)))))
    d = P.page_images(rows(spark, sf, payloads("p_partkey", "part", by_case("p_partkey % 3", new, old, nest(f"{P.META}.avatar.thumbnails", images(("//m", 2, 2)))))))
    return d.withColumn("images", F.array_join(F.transform("images", lambda i: F.concat_ws(":", i["url"], i["width"], F.coalesce(i["hint"], F.lit("")))), ","))


@query("n8_about_rows", """SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'own' ELSE 'new ' || c_name END AS title, CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE 'UC' || CAST(c_custkey AS VARCHAR) END AS channel_id,
    CASE c_custkey % 3 WHEN 0 THEN 'from meta' WHEN 1 THEN 'from panel' ELSE 'mine' END AS description, CASE WHEN c_custkey % 3 = 2 THEN NULL ELSE c_name END AS channel_handle, CASE WHEN c_custkey % 3 < 2 THEN epoch(TIMESTAMP '2024-06-15')::BIGINT END AS joined,
    CAST(CASE c_custkey % 3 WHEN 0 THEN c_custkey WHEN 1 THEN 77 END AS BIGINT) AS view_count, CASE WHEN c_custkey % 3 = 0 THEN 5 WHEN c_custkey % 3 = 1 THEN 1200 END::BIGINT AS subscriber_count,
    CASE c_custkey % 3 WHEN 0 THEN 'DE,NL,US' WHEN 1 THEN 'DE' ELSE 'DE' END AS countries, CASE WHEN c_custkey % 3 = 0 THEN 'a b,c' ELSE '' END AS keywords, c_custkey % 3 = 0 AS is_family_safe FROM customer""".replace("CASE WHEN c_custkey % 2 = 0 THEN 'own' ELSE 'new ' || c_name END", "CASE WHEN c_custkey % 2 = 0 THEN 'own' WHEN c_custkey % 3 < 2 THEN 'new ' || c_name END"))
def n8(spark, sf):
    both = merged(nest(P.META, '{"externalId":"UC<<c_custkey>>","title":"new <<c_name>>","description":"from meta","availableCountryCodes":["US","NL"],"vanityChannelUrl":"http://x/@<<c_name>>","keywords":"\\\\"a b\\\\" c","isFamilySafe":true}'),
        about('{"joinedDateText":{"content":"Joined Jun 15, 2024"},"viewCountText":"<<c_custkey>> views","subscriberCountText":"1.2K subscribers","description":"from panel"}'))
    late = merged(nest(P.META, '{"externalId":"UC<<c_custkey>>","title":"new <<c_name>>","ownerUrls":["http://x/@<<c_name>>"]}'), about('{"joinedDateText":{"simpleText":"Joined Jun 15, 2024"},"subscriberCountText":{"simpleText":"1.2K subscribers"},"description":{"runs":[{"text":"from "},{"text":"panel"}]}}'), header_rows("@h", "77 views"))
    more = ", CASE WHEN c_custkey % 2 = 0 THEN 'own' END AS title, 'mine' AS description, array('DE') AS countries, CAST(CASE WHEN c_custkey % 3 = 0 THEN 5 END AS BIGINT) AS subscriber_count"
    d = P.about_rows(rows(spark, sf, payloads("c_custkey", "customer", by_case("c_custkey % 3", both, late, '{"metadata":{}}'), more)), existing=("title", "description", "countries", "subscriber_count"))
    text = F.coalesce("description", F.lit("mine"))
    return d.select("k", "title", "channel_id", text.alias("description"), "channel_handle", F.unix_seconds("joined").alias("joined"), "view_count", "subscriber_count", F.array_join("countries", ",").alias("countries"), F.array_join("keywords", ",").alias("keywords"), "is_family_safe")


@query("n9_f26_external_links", """SELECT c_custkey AS k, 'http://a.b/' || c_name AS url, 'Shop' AS label, 10 AS priority FROM customer WHERE c_custkey % 3 < 2 UNION ALL SELECT c_custkey, 'https://c.d', 'Link', 20 FROM customer WHERE c_custkey % 3 < 2
    UNION ALL SELECT c_custkey, 'https://www.twitter.com/' || c_name, 'Twitter', 10 FROM customer WHERE c_custkey % 3 > 0 UNION ALL SELECT c_custkey, 'https://e.f', 'Own title', 30 FROM customer WHERE c_custkey % 3 > 0""")
def n9(spark, sf):
    def link(url: str, title: str = "") -> str:
        return merged(nest("navigationEndpoint.urlEndpoint.url", f'"{url}"'), title and nest("title.simpleText", f'"{title}"'))

    def shown(header: str) -> str:
        return nest(f"{header}.headerLinks.channelHeaderLinksRenderer", '{"primaryLinks":[' + ",".join([link("http://a.b/<<c_name>>", "Shop"), '{"title":{"simpleText":"none"}}', link("https://c.d")]) + "]}")

    def listed(text: str, title: str = "") -> str:
        return nest("channelExternalLinkViewModel", merged(nest("link.content", f'"{text}"'), title and nest("title.content", f'"{title}"')))

    panel = about('{"links":[' + ",".join([listed("https://www.twitter.com/<<c_name>>"), '{"other":1}', listed("and 3 more links"), listed("e.f", "Own title")]) + "]}")
    return P.external_links(rows(spark, sf, payloads("c_custkey", "customer", by_case("c_custkey % 3", shown(P.OLD_HEADER), merged(shown("header.pageHeaderRenderer"), panel), panel))))


@query("n12_tk4_chapters", """SELECT p_partkey AS k, p_name AS title, NULL AS time_text, (p_size * 500) / 1000.0::DOUBLE AS start_s, 'big' AS url FROM part WHERE p_partkey % 3 < 2
    UNION ALL SELECT p_partkey, p_brand, '1:00', p_size::DOUBLE, NULL FROM part WHERE p_partkey % 3 > 0 UNION ALL SELECT p_partkey, 'Intro', NULL, 0.0, NULL FROM part WHERE p_partkey % 3 > 0""")
def n12(spark, sf):
    def mark(*inner: str) -> str:
        return nest("chapterRenderer", merged(*inner))

    title, start = nest("title.runs[].text", '"<<p_name>>"'), '{"timeRangeStartMillis":<<p_size * 500>>}'
    marks = nest(P.MARKERS.removesuffix(".value.chapters[].chapterRenderer").removesuffix("[]"), '[{"key":"HEATMAP"},' + nest("value", '{"chapters":[' + ",".join([mark(title, start, nest("thumbnail.thumbnails", images(("small", 2, 8), ("big", 9, 1)))), mark(start), mark(title)]) + "]}") + "]")
    item = lambda *inner: nest("macroMarkersListItemRenderer", merged(*inner))
    listed = nest("content.sectionListRenderer.contents[].itemSectionRenderer", '{"contents":[' + item('{"title":"x"}', nest("title.simpleText", '"Intro"')).replace('"title":"x",', "") + ',{"other":1},' + item(nest("title.runs[].text", '"<<p_brand>>"'), nest("timeDescription.simpleText", '"1:00"'), nest("onTap.watchEndpoint.startTimeSeconds", "<<p_size>>")) + "]}")
    panel = lambda name: nest("engagementPanelSectionListRenderer", merged(f'{{"panelIdentifier":"{name}"}}', listed))
    panels = '{"engagementPanels":[{"engagementPanelSectionListRenderer":{"panelIdentifier":"chapters-of-nothing"}},{"adsRenderer":{}},' + panel("engagement-panel-comments") + "," + by_case("p_partkey % 2", panel("engagement-panel-macro-markers-description-chapters"), panel("engagement-panel-macro-markers-auto")) + "]}"
    return P.chapters(rows(spark, sf, payloads("p_partkey", "part", by_case("p_partkey % 3", marks, merged(marks, panels), panels))))


@query("n13_watch_page_counts", """SELECT p_partkey AS k, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size * 1000 WHEN 1 THEN p_size * 1001 END AS BIGINT) AS like_count, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN p_size * 1000 WHEN 2 THEN NULL END AS BIGINT) AS comment_count,
    CASE WHEN p_partkey % 4 < 2 THEN p_brand END AS category FROM part""")
def n13(spark, sf):
    old = nest(P.OLD_LIKE, nest("simpleText", '"<<p_size>>K"'))
    new = nest(P.NEW_LIKE, '"like this video along with <<p_size * 1001>> other people"')
    primary = lambda *buttons: nest("videoPrimaryInfoRenderer.videoActions.menuRenderer", '{"topLevelButtons":[{"buttonRenderer":{}},' + ",".join(buttons) + "]}")
    row = lambda title, *texts: nest("metadataRowRenderer", merged(nest("title.simpleText", f'"{title}"'), '{"contents":[' + ",".join(texts) + "]}"))
    secondary = nest("videoSecondaryInfoRenderer.metadataRowContainer.metadataRowContainerRenderer", '{"rows":[' + row("Music", '{"simpleText":"no"}') + "," + row("Categories", '{"other":1}', nest("runs[].text", '"<<p_brand>>"')) + "]}")
    results = lambda *items: nest(P.WATCH.removesuffix("[]"), "[" + ",".join(items) + "]")
    panel = lambda head, text: '{"engagementPanels":[{"engagementPanelSectionListRenderer":{"panelIdentifier":"other"}},' + nest("engagementPanelSectionListRenderer", merged('{"panelIdentifier":"engagement-panel-Comments-section"}', nest(f"header.{head}.contextualInfo", text))) + "]}"
    title, entry = panel("engagementPanelTitleHeaderRenderer", '{"runs":[{"text":"<<p_size>>"}]}'), panel("commentsEntryPointHeaderRenderer", '{"simpleText":"<<p_size>>K"}')
    page = by_case("p_partkey % 4", merged(results('{"itemSectionRenderer":{}}', primary(old, new), secondary), title), merged(results(primary(new), secondary), entry), results(primary('{"likeButton":1}')), title)
    return P.watch_page_counts(rows(spark, sf, payloads("p_partkey", "part", page)))


def rich(kind: str, inner: str) -> str:
    return nest(f"{P.ITEM}.{kind}", inner)


def short(url: str) -> str:
    return nest(f"{P.ITEM}.{P._SHORT}", f'"{url}"')


@query("n14_n15_tab_items", """SELECT k, tab, video_id, podcast_id FROM (SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN 'videos' ELSE 'live' END AS tab, 'v' || CAST(p_partkey AS VARCHAR) AS video_id, NULL AS podcast_id FROM part WHERE p_partkey % 4 < 2
    UNION ALL SELECT p_partkey, 'shorts', 's' || CAST(p_partkey AS VARCHAR), NULL FROM part WHERE p_partkey % 4 = 2 UNION ALL SELECT p_partkey, 'podcasts', NULL, 'p' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_partkey % 4 = 3)""")
def n14(spark, sf):
    video = rich("videoRenderer", '{"videoId":"v<<p_partkey>>","title":{}}')
    page = by_case("p_partkey % 4", tab("Videos", grid(video, video, '{"richItemRenderer":{"content":{"adRenderer":{}}}}')), tab("LIVE", grid(video, short("/shorts/x"))), tab("Shorts", grid(short("/shorts/s<<p_partkey>>"), short("/watch?v=1"), video)),
        tab("Podcasts", grid(rich("lockupViewModel", '{"contentId":"p<<p_partkey>>"}'), video)))
    return P.tab_items(rows(spark, sf, payloads("p_partkey", "part", page)))


@query("n14_continued_items", """SELECT p_partkey AS k, CASE p_partkey % 3 WHEN 0 THEN 'v' || CAST(p_partkey AS VARCHAR) || ',w' WHEN 1 THEN 's' || CAST(p_partkey AS VARCHAR) ELSE '' END AS ids, CASE WHEN p_partkey % 3 = 0 THEN 't' || CAST(p_size AS VARCHAR) END AS token FROM part""")
def n14c(spark, sf):
    page = lambda *items: nest("onResponseReceivedActions[].appendContinuationItemsAction", '{"continuationItems":[' + ",".join(items) + "]}")
    video = lambda v: rich("videoRenderer", f'{{"videoId":"{v}"}}')
    d = rows(spark, sf, payloads("p_partkey", "part", by_case("p_partkey % 3", page(video("v<<p_partkey>>"), video("w"), video("w"), nest(P.TOKEN, '"t<<p_size>>"')), page(short("/shorts/s<<p_partkey>>"), video("v")), '{"other":[]}')))
    out = P.continued_items(d, F.when(F.col("k") % 3 == 1, "shorts").otherwise("videos"))
    return out.select("k", F.coalesce(F.array_join("video_ids", ","), F.lit("")).alias("ids"), "token")


@query("n15_playlists", """SELECT p_partkey AS k, 'p' || CAST(p_partkey AS VARCHAR) AS playlist_id, CASE WHEN p_partkey % 3 < 2 THEN p_name END AS title, CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS INT) ELSE 0 END AS video_count, CASE WHEN p_partkey % 3 = 0 THEN 'u1' END AS thumbnail_url FROM part WHERE p_partkey % 4 <> 3""")
def n15(spark, sf):
    def lockup(kind: str, *more: str) -> str:
        return nest("lockupViewModel", merged(f'{{"contentType":"{kind}","contentId":"p<<p_partkey>>"}}', *more))

    badge = lambda *texts: nest("thumbnailOverlayBadgeViewModel", '{"thumbnailBadges":[' + ",".join(nest("thumbnailBadgeViewModel.text", f'"{t}"') for t in texts) + "]}")
    image = nest("contentImage.collectionThumbnailViewModel.primaryThumbnail.thumbnailViewModel", merged('{"image":{"sources":[{"url":"u1"},{"url":"u2"}]}}', '{"overlays":[' + ",".join([badge("3 videos", "<<p_size>> videos"), '{"hover":1}', badge("new")]) + "]}"))
    title = nest("metadata.lockupMetadataViewModel.title.content", '"<<p_name>>"')
    kind = by_case("p_partkey % 4", *["LOCKUP_CONTENT_TYPE_PLAYLIST"] * 3, "LOCKUP_CONTENT_TYPE_PODCAST")
    item = by_case("p_partkey % 3", lockup("KIND", title, image), lockup("KIND", title), lockup("KIND"))
    item = item.replace("'{\"lockupViewModel\":{\"contentType\":\"KIND\"", "'{\"lockupViewModel\":{\"contentType\":\"', " + kind[2:-2] + ", '\"")
    return P.playlist_rows(rows(spark, sf, payloads("p_partkey", "part", tab("Playlists", sections('{"gridRenderer":{"items":[' + item + ',{"gridPlaylistRenderer":{}}]}}', '{"gridRenderer":{"items":[]}}')))))


@query("n16_n18_courses_products", """SELECT p_partkey AS k, 'c' || CAST(p_partkey AS VARCHAR) AS playlist_id, p_name AS title, CAST(CASE WHEN p_partkey % 3 = 0 THEN p_size ELSE 0 END AS INT) AS video_count, CASE WHEN p_partkey % 3 = 0 THEN 't1' END AS thumbnail_url,
    CASE p_partkey % 3 WHEN 0 THEN 'v' || CAST(p_partkey AS VARCHAR) || '=5 minutes,none=' ELSE '' END AS videos, p_brand AS product, CASE WHEN p_partkey % 2 = 0 THEN '$' || CAST(p_size AS VARCHAR) END AS price, CASE WHEN p_partkey % 2 = 0 THEN 'u2' END AS url FROM part WHERE p_partkey % 3 < 2""")
def n16(spark, sf):
    child = lambda *inner: nest("childVideoRenderer", merged(*inner))
    videos = '{"videos":[' + ",".join([child(nest("navigationEndpoint.watchEndpoint.videoId", '"v<<p_partkey>>"'), nest("lengthText.accessibility.accessibilityData.label", '"5 minutes"')), child(nest("title.simpleText", '"none"'))]) + "]}"
    own = '{"playlistId":"c<<p_partkey>>","title":{"simpleText":"<<p_name>>"}}'
    full = merged(own, '{"videoCount":"<<p_size>>","thumbnails":[{"thumbnails":[{"url":"t1"},{"url":"t2"}]},{"thumbnails":[{"url":"t3"}]}]}', videos)
    courses = P.course_rows(rows(spark, sf, payloads("p_partkey", "part", tab("Courses", grid(by_case("p_partkey % 3", rich("playlistRenderer", full), rich("playlistRenderer", own), rich("playlistRenderer", '{"title":{"simpleText":"no id"}}')))))))
    product = lambda *inner: nest("verticalProductCardRenderer", merged('{"title":"<<p_brand>>"}', *inner))
    priced = product('{"price":"$<<p_size>>","merchantName":"m"}', nest("navigationEndpoint.commandExecutorCommand", '{"commands":[{"other":1},{"urlEndpoint":{"url":"u2"}},{"urlEndpoint":{"url":"u3"}}]}'))
    shelf = nest("shelfRenderer.content.gridRenderer", '{"items":[' + by_case("p_partkey % 2", priced, product()) + ',{"verticalProductCardRenderer":{"price":"1"}}]}')
    products = P.product_rows(rows(spark, sf, payloads("p_partkey", "part", tab("Store", sections(shelf, '{"other":1}')))))
    listed = F.array_join(F.transform("videos", lambda v: F.concat(F.coalesce(v["video_id"], v["title"]), F.lit("="), F.coalesce(v["duration_label"], F.lit("")))), ",")
    return courses.withColumn("videos", F.coalesce(listed, F.lit(""))).join(products.select("k", F.col("title").alias("product"), "price", "url"), "k")


@query("n17_f25_posts", """SELECT p_partkey AS k, 'p' || CAST(p_partkey AS VARCHAR) AS post_id, CASE WHEN p_partkey % 5 < 4 THEN p_name END AS text, CASE WHEN p_partkey % 5 < 4 THEN '2 days ago' END AS published, CASE WHEN p_partkey % 5 < 4 THEN '1.2K' END AS votes,
    CASE p_partkey % 5 WHEN 0 THEN 'image' WHEN 1 THEN 'image' WHEN 2 THEN 'poll' WHEN 3 THEN 'video' END AS kind, CASE p_partkey % 5 WHEN 0 THEN 'b' WHEN 1 THEN 'b,d' ELSE '' END AS images, CASE WHEN p_partkey % 5 = 3 THEN 'v' || CAST(p_size AS VARCHAR) END AS video_id,
    CASE WHEN p_partkey % 5 = 2 THEN 'yes please,no' ELSE '' END AS choices FROM part""")
def n17(spark, sf):
    def post(*inner: str) -> str:
        return nest("backstagePostThreadRenderer.post.backstagePostRenderer", merged('{"postId":"p<<p_partkey>>"}', *inner))

    shared = ('{"contentText":{"runs":[{"text":"<<substr(p_name, 1, 3)>>"},{"text":"<<substr(p_name, 4)>>"}]},"publishedTimeText":{"runs":[{"text":"2 days ago"}]},"voteCount":{"simpleText":"1.2K"}}',)
    thumbs = lambda *urls: nest("image.thumbnails", "[" + ",".join(f'{{"url":"{u}"}}' for u in urls) + "]")
    attach = lambda inner: nest("backstageAttachment", inner)
    many = '{"postMultiImageRenderer":{"images":[' + ",".join(nest("backstageImageRenderer", t) for t in (thumbs("b"), thumbs(), thumbs("c", "d"))) + "]}}"
    poll = '{"pollRenderer":{"choices":[{"text":{"runs":[{"text":"yes "},{"text":"please"}]}},{"text":{}},{"text":{"runs":[{"text":"no"}]}}]}}'
    item = by_case("p_partkey % 5", post(*shared, attach(nest("backstageImageRenderer", thumbs("a", "b")))), post(*shared, attach(many)), post(*shared, attach(poll)), post(*shared, attach('{"videoRenderer":{"videoId":"v<<p_size>>"}}')), post())
    d = P.post_rows(rows(spark, sf, payloads("p_partkey", "part", tab("Posts", sections(item, '{"backstagePostThreadRenderer":{"post":{"sharedPostRenderer":{}}}}', nest("backstagePostThreadRenderer.post.backstagePostRenderer", '{"voteCount":{}}'))))))
    return d.withColumn("images", F.array_join("images", ",")).withColumn("choices", F.array_join("choices", ","))


@query("n22_html_player", """SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 2 THEN 'blocked' WHEN 3 THEN 'missing' ELSE 'ok' END AS status, CASE WHEN p_partkey % 4 < 2 THEN p_name END AS title, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size WHEN 1 THEN 61 END AS BIGINT) AS duration_s,
    CAST(CASE WHEN p_partkey % 4 < 2 THEN p_size * 10 END AS BIGINT) AS view_count, CASE p_partkey % 4 WHEN 0 THEN 'own' WHEN 1 THEN p_brand END AS category, CASE WHEN p_partkey % 4 < 2 THEN p_partkey % 4 = 0 END AS embeddable,
    CASE p_partkey % 4 WHEN 0 THEN 'a,b,mine' WHEN 1 THEN 'mine' END AS keywords, CAST(CASE p_partkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 0 END AS INT) AS thumbs, CASE WHEN p_partkey % 4 = 0 THEN 'youtube' END AS license, CASE WHEN p_partkey % 4 < 2 THEN p_partkey % 4 = 1 END AS age_restricted FROM part""")
def n22(spark, sf):
    details = lambda *inner: nest("videoDetails", merged('{"title":"<<p_name>>","lengthSeconds":"61","viewCount":"<<p_size * 10>>"}', *inner))
    micro = lambda inner: nest("microformat.playerMicroformatRenderer", inner)
    full = merged(details('{"keywords":["b","a"],"category":"unused"}', nest("thumbnail.thumbnails", images(("u", 1, 1)))), micro(merged('{"lengthSeconds":"<<p_size>>","publishDate":"2024-06-15","hasYpcMetadata":true,"embed":{"iframeUrl":"e"}}', nest("thumbnail.thumbnails", images(("u", 1, 1), ("w", 2, 2))))))
    plain = merged(details('{"category":["<<p_brand>>","second"]}'), micro('{"publishDate":"2024-06-15"}'), '{"playabilityStatus":{"status":"AGE_VERIFICATION_REQUIRED"}}')
    more = ", CASE WHEN p_partkey % 4 = 0 THEN 'own' ELSE '' END AS category, array('mine') AS keywords"
    d = P.html_player_rows(rows(spark, sf, payloads("p_partkey", "part", by_case("p_partkey % 4", full, plain, '{"playabilityStatus":{"status":"LOGIN_REQUIRED"}}', micro("{}")), more)), existing=("category", "keywords"))
    return d.select("k", "status", "title", "duration_s", "view_count", "category", "embeddable", F.array_join("keywords", ",").alias("keywords"), F.size("thumbnails").alias("thumbs"), "license", "age_restricted")
