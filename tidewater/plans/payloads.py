"""Graph, validation and payload queries. Payloads are built from table columns, so they grow with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import extract as X
from ..operators import graph as G
from ..operators import imports as I
from ..operators import lists as L
from ..operators import validation as V
from .binding import by_case, cte, payloads, rows

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


_E = cte("edges")


@query("g1_discover", _E.replace("WITH ", "WITH RECURSIVE ") + """, r AS (SELECT 's1' AS channel, 0 AS depth UNION SELECT dst, depth + 1 FROM r JOIN edges ON src = channel WHERE depth < 20 AND subs >= 2000 AND CAST(substr(dst, 2) AS INT) % 10 <> 3),
    m AS (SELECT channel, min(depth) AS depth FROM r GROUP BY 1) SELECT m.channel, depth, CASE WHEN depth > 0 THEN (SELECT max(subs) FROM edges JOIN m p ON p.channel = src AND p.depth = m.depth - 1 WHERE dst = m.channel) END AS subs FROM m""")
def g1(spark, sf):
    e = rows(spark, sf, "edges")
    seeds = e.select(F.lit("s1").alias("channel")).limit(1)
    return G.discover(e, seeds, rows(spark, sf, "SELECT 's' || CAST(s_suppkey AS STRING) AS channel FROM {supplier} WHERE s_suppkey % 10 = 3"), 2000)


@query("g2_rank_links", _E + "SELECT dst AS channel, count(DISTINCT src) AS in_degree, max(subs) AS max_subs FROM edges GROUP BY 1")
def g2(spark, sf):
    return G.rank_links(rows(spark, sf, "edges"))


@query("pf12_pf13_link_filter", _E + "SELECT src, dst AS channel, subs FROM edges WHERE subs >= 3000 AND CAST(substr(dst, 2) AS INT) % 7 <> 0 AND CAST(substr(dst, 2) AS INT) % 5 <> 0 AND CAST(substr(dst, 2) AS INT) % 11 <> 0")
def pf12(spark, sf):
    s = rows(spark, sf, "SELECT s_suppkey AS k, 'S' || CAST(s_suppkey AS STRING) AS channel FROM {supplier}")
    return G.link_filter(rows(spark, sf, "edges").withColumnRenamed("dst", "channel"), s.filter("k % 7 = 0"), s.filter("k % 5 = 0"), s.filter("k % 11 = 0"), 3000).select("src", "channel", "subs")


@query("so2_initial_queue", "SELECT DISTINCT 's' || CAST(s_suppkey AS VARCHAR) AS channel FROM supplier WHERE (s_suppkey % 2 <> 0 AND s_suppkey % 3 <> 0 AND s_suppkey % 5 <> 0) OR s_suppkey < 4")
def so2(spark, sf):
    s = rows(spark, sf, "SELECT s_suppkey AS k, 's' || CAST(s_suppkey AS STRING) AS channel FROM {supplier}")
    return G.initial_queue(s, s.filter("k % 2 = 0"), s.filter("k % 3 = 0"), s.filter("k % 5 = 0"), s.filter("k < 4"))


@query("j23_resolve_paths", cte("creator_map") + """, cm AS (SELECT channel_id, arg_max(handle, seq) AS handle FROM creator_map GROUP BY 1)
    SELECT DISTINCT coalesce(handle, 'channel/UC' || lpad(CAST(c_custkey % 90 AS VARCHAR), 22, '0')) AS channel, c_nationkey AS subs FROM customer LEFT JOIN cm ON channel_id = 'UC' || lpad(CAST(c_custkey % 90 AS VARCHAR), 22, '0')""")
def j23(spark, sf):
    links = rows(spark, sf, "SELECT 'channel/UC' || lpad(CAST(c_custkey % 90 AS STRING), 22, '0') AS channel, c_nationkey AS subs FROM {customer}")
    return G.resolve_paths(links, L.latest(rows(spark, sf, "creator_map"), "channel_id", "handle"))


_SCHEMA = """{"type":"object","properties":{"channel_id":{"type":"string"},"channel_handle":{"type":"string","pattern":"^[a-z]"},"url":{"type":"string","format":"uri"},
    "subscriber_count":{"$ref":"#/$defs/count"},"kind":{"enum":["a","b"]}},"required":["channel_id","channel_handle","url"],"additionalProperties":false,"$defs":{"count":{"type":["integer","null"],"minimum":0}}}"""
_DOCS = """SELECT c_custkey AS k, CASE c_custkey % 8 WHEN 0 THEN '{{"channel_id":"i","channel_handle":"h","url":"https://x.y"}}' WHEN 1 THEN '{{"channel_handle":"h","url":"https://x.y"}}'
    WHEN 2 THEN '{{"channel_id":"i","channel_handle":"h","url":"https://x.y","subscriber_count":"many"}}' WHEN 3 THEN '{{"channel_id":"i","channel_handle":"h","url":"https://x.y","more":1}}'
    WHEN 4 THEN '{{"channel_id":"i","channel_handle":"9","url":"https://x.y"}}' WHEN 5 THEN '{{"channel_id":"i","channel_handle":"h","url":"no"}}' WHEN 6 THEN '{{"channel_id":"i","channel_handle":"h","url":"https://x.y","subscriber_count":-1}}'
    ELSE '{{"channel_id":"i","channel_handle":"h","url":"https://x.y","kind":"c","subscriber_count":null}}' END AS text FROM {customer}"""


@query("vl1_validate", """SELECT c_custkey AS k, CASE c_custkey % 8 WHEN 1 THEN '<root>: ''channel_id'' is a required property' WHEN 2 THEN '/subscriber_count: is not of type integer or null' WHEN 3 THEN '<root>: has additional properties'
    WHEN 4 THEN '/channel_handle: does not match its pattern' WHEN 5 THEN '/url: is not a ''uri''' WHEN 6 THEN '/subscriber_count: is less than the minimum of 0' WHEN 7 THEN '/kind: is not one of the allowed values' END AS error FROM customer""")
def vl1(spark, sf):
    return V.validate(rows(spark, sf, _DOCS), _SCHEMA).select("k", "error")


@query("vl2_quarantine", """SELECT CASE c_custkey % 8 WHEN 2 THEN '_subscriber_count' WHEN 4 THEN '_channel_handle' WHEN 5 THEN '_url' WHEN 6 THEN '_subscriber_count' WHEN 7 THEN '_kind' ELSE '_root_' END AS reason, count(*) AS n FROM customer WHERE c_custkey % 8 <> 0 GROUP BY 1""")
def vl2(spark, sf):
    return V.quarantine(V.validate(rows(spark, sf, _DOCS), _SCHEMA))[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


_NESTED = """{"type":"object","properties":{
    "video_id":{"type":"string"},"duration":{"type":["integer","null"],"minimum":0},"kind":{"enum":["video",1,null]},"tags":{"type":"array","items":{"type":"string"}},
    "heatmaps":{"type":"array","items":{"type":"object","additionalProperties":{"type":"number"}}},"chapters":{"type":"array","items":{"$ref":"#/$defs/chapter"}},
    "thumbnails":{"type":"object","additionalProperties":{"$ref":"#/$defs/thumbnail"}},"formats":{"type":"object","additionalProperties":{"$ref":"#/$defs/format"}}},
    "required":["video_id"],"anyOf":[{"required":["channel_id"]},{"required":["channel_handle"]}],
    "$defs":{"thumbnail":{"type":"object","properties":{"url":{"type":"string","format":"uri"},"width":{"type":["integer","null"],"minimum":0}},"required":["url"],"additionalProperties":false},
    "chapter":{"type":"object","properties":{"start":{"type":"number","minimum":0},"title":{"type":["string","null"]}},"required":["start","title"],"additionalProperties":false},
    "format":{"type":"object","properties":{"fps":{"type":["number","null"]},"fragments":{"type":"array","items":{"type":"object","properties":{"duration":{"type":"number","minimum":0}},"additionalProperties":false}}}}}}"""
#: One member that breaks a rule, by p_partkey % 14; <<at>> good items come before it. The last one keeps to all rules.
_BREAKS = (
    ('"chapters":[<<at>>{"start":0}]', "/chapters/<<n>>: 'title' is a required property"),
    ('"chapters":[<<at>>{"start":-1,"title":null}]', "/chapters/<<n>>/start: is less than the minimum of 0"),
    ('"chapters":[<<at>>{"start":0,"title":"t","more":1}]', "/chapters/<<n>>: has additional properties"),
    ('"chapters":[<<at>>"text"]', "/chapters/<<n>>: is not of type object"),
    ('"thumbnails":{"a":{"url":"https://x.y"},"t<<n>>":{"width":5}}', "/thumbnails/t<<n>>: 'url' is a required property"),
    ('"thumbnails":{"a":{"url":"https://x.y","width":5.0},"t<<n>>":{"url":"https://x.y","width":5.5}}', "/thumbnails/t<<n>>/width: is not of type integer or null"),
    ('"thumbnails":{"t<<n>>":"https://x.y"}', "/thumbnails/t<<n>>: is not of type object"),
    ('"formats":{"18":{"fps":25},"f<<n>>":{"fps":"25"}}', "/formats/f<<n>>/fps: is not of type number or null"),
    ('"formats":{"f<<n>>":{"fragments":[{"duration":1},{"duration":-0.5}]}}', "/formats/f<<n>>/fragments/1/duration: is less than the minimum of 0"),
    ('"heatmaps":[{"v":1},{"v":0.5,"w<<n>>":"high"}]', "/heatmaps/1/w<<n>>: is not of type number"),
    ('"tags":["a",<<n>>]', "/tags/1: is not of type string"),
    ('"kind":"1"', "/kind: is not one of the allowed values"),
    ('"duration":<<n>>.0,"kind":1.0,"chapters":[<<at>>{"start":1.5,"title":null}],"thumbnails":{},"heatmaps":[{}]', ""),
    ('"kind":null,"chapters":{"start":-1},"thumbnails":[]', "/chapters: is not of type array"),
)


@query("vl1_nested_records", f"""SELECT p_partkey AS k, nullif(replace(CASE p_partkey % {len(_BREAKS) + 1} {" ".join(f"WHEN {k} THEN '" + m.replace("'", "''") + "'" for k, (_, m) in enumerate(_BREAKS))}
    ELSE '<root>: is not valid under any of the given schemas' END, '<<n>>', CAST(p_size % 4 AS VARCHAR)), '') AS error FROM part""")
def vl1_nested(spark, sf):
    good = "<<repeat('{\"start\":1,\"title\":\"t\"},', p_size % 4)>>"
    bodies = [b.replace("<<at>>", good).replace("<<n>>", "<<p_size % 4>>") for b, _ in _BREAKS]
    template = '{"video_id":"v<<p_partkey>>",<<CASE WHEN p_partkey % ' + str(len(_BREAKS) + 1) + " < " + str(len(_BREAKS)) + """ THEN '"channel_handle":"h",' ELSE '' END>>""" + by_case(f"p_partkey % {len(_BREAKS) + 1}", *bodies, '"tags":[]') + "}"
    return V.validate(rows(spark, sf, payloads("p_partkey", "part", template)), _NESTED, "payload").select("k", "error")


@query("vl5_latest_versions", "SELECT 'u' || CAST(c_nationkey AS VARCHAR) AS username, 'youtube' AS platform, c_mktsegment AS entity, '0.' || CAST(max(c_custkey) AS VARCHAR) || '.1' AS version FROM customer GROUP BY c_nationkey, c_mktsegment")
def vl5(spark, sf):
    return V.latest_versions(rows(spark, sf, "SELECT 'u' || CAST(c_nationkey AS STRING) AS username, 'youtube' AS platform, c_mktsegment AS entity, '0.' || CAST(c_custkey AS STRING) || '.1' AS version FROM {customer}"))


@query("n1_n2_json_paths", """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_type END AS kind, CASE WHEN event_id % 2 = 0 THEN NULL ELSE event_id END AS number, '"' || event_type || '"' AS deep FROM events""")
def n1(spark, sf):
    d = rows(spark, sf, """SELECT event_id, concat('{{"a":{{"k":', CASE WHEN event_id % 2 = 0 THEN concat('"', event_type, '"') ELSE CAST(event_id AS STRING) END, ',"l":[1,{{"deep":"', event_type, '"}}]}}}}') AS payload FROM {events}""")
    p = F.col("payload")
    return d.select("event_id", X.typed_path(p, "$.a.k", "string").alias("kind"), X.typed_path(p, "$.a.k", "bigint").alias("number"), X.json_find("deep")(p).alias("deep"))


_PLAY = """SELECT p_partkey AS k, 'old' AS title, 'kept' AS category, concat('{{"videoDetails":{{"videoId":"v', CAST(p_partkey AS STRING), '","title":"', CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_name END, '","lengthSeconds":"', CAST(p_size AS STRING), '","viewCount":"12","keywords":["b","a","b"],"channelId":"","thumbnail":{{"thumbnails":[{{"url":"u1","width":10,"height":10}},{{"url":"u2","width":5,"height":5}}]}}}},"playabilityStatus":{{"status":"', CASE p_partkey % 4 WHEN 0 THEN 'LOGIN_REQUIRED' ELSE 'OK' END, '","reason":"age"}},"microformat":{{"playerMicroformatRenderer":{{"publishDate":"20240615","likeCount":"x"}}}},"captions":{{"playerCaptionsTracklistRenderer":{{"captionTracks":[{{"baseUrl":"m","languageCode":"en"}},{{"baseUrl":"n","languageCode":"en"}},{{"baseUrl":"a","languageCode":"de","kind":"asr"}}]}}}}}}') AS payload FROM {part}"""


@query("n10_n11_n22_player", """SELECT p_partkey AS k, 'v' || CAST(p_partkey AS VARCHAR) AS video_id, CASE WHEN p_partkey % 3 = 0 THEN 'old' ELSE p_name END AS title, 'kept' AS category, CAST(p_size AS BIGINT) AS duration_s, CAST(12 AS BIGINT) AS view_count, CAST(NULL AS BIGINT) AS like_count,
    'a,b' AS keywords, 'n' AS sub_en, 'a' AS auto_de, 'u2' AS thumbnail_url, CAST(NULL AS VARCHAR) AS channel_id, p_partkey % 4 = 0 AS age_restricted FROM part""")
def n10(spark, sf):
    r = X.player_rows(rows(spark, sf, _PLAY), existing=("title", "category"))
    return r.select("k", "video_id", "title", "category", "duration_s", "view_count", "like_count", F.array_join("keywords", ",").alias("keywords"), F.element_at("subtitles", "en")["baseUrl"].alias("sub_en"),
        F.element_at("automatic_captions", "de")["baseUrl"].alias("auto_de"), "thumbnail_url", "channel_id", "age_restricted")


@query("n19_a13_a14_info_records", """SELECT p_partkey AS k, 'v' || CAST(p_partkey AS VARCHAR) AS video_id, 'h' AS channel_handle, epoch(TIMESTAMP '2024-06-15')::BIGINT AS published, 'x' AS fmt, 'a,10x5' AS labels, 'last' AS sub FROM part""")
def n19(spark, sf):
    d = rows(spark, sf, """SELECT p_partkey AS k, concat('{{"id":"v', CAST(p_partkey AS STRING), '","uploader_id":"@h","upload_date":"20240615","formats":[{{"format_id":"1","ext":"w"}},{{"format_id":"1","ext":"x"}}],"subtitles":{{"en":[{{"url":"first"}},{{"url":"last"}}]}},
        "thumbnails":[{{"url":"q","width":10,"height":5,"preference":2}},{{"url":"p","id":"a","preference":1}},{{"url":"p","id":"b","preference":3}}]}}') AS payload FROM {part}""")
    return X.info_rows(d).select("k", "video_id", "channel_handle", F.unix_seconds("published").alias("published"), F.element_at("formats", "1")["ext"].alias("fmt"), F.array_join(F.map_keys("thumbnails"), ",").alias("labels"), F.element_at("subtitles", "en").alias("sub"))


@query("n20_feed_entries", """SELECT c_custkey AS k, 'v' || CAST(c_custkey AS VARCHAR) AS video_id, CASE c_custkey % 3 WHEN 0 THEN 'A & B ''' || c_name || '''' WHEN 1 THEN '<' || c_name || '>' ELSE c_name END AS title, 'N <3' AS author_name,
    CAST(c_custkey AS BIGINT) AS view_count, 'https://i/t.jpg?a=1&b=2' AS thumbnail_url, epoch(TIMESTAMP '2024-06-15 10:30:00')::BIGINT AS published FROM customer WHERE c_custkey % 7 <> 0""")
def n20(spark, sf):
    d = rows(spark, sf, """SELECT c_custkey AS k, concat('<feed xmlns:yt="y" xmlns:media="m" xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><yt:videoId>v', CAST(c_custkey AS STRING), '</yt:videoId><title>', CASE c_custkey % 3 WHEN 0 THEN concat('A &amp; B &#39;', c_name, '&#39;') WHEN 1 THEN concat('<![CDATA[<', c_name, '>]]>') ELSE c_name END,
        '</title><author><name>N &lt;3</name></author><published>2024-06-15T10:30:00+00:00</published><media:group>', CASE WHEN c_custkey % 2 = 0 THEN '<media:thumbnail url="https://i/t.jpg?a=1&amp;b=2" width="480"/>' ELSE '<media:thumbnail height="360" width="480" url="https://i/t.jpg?a=1&amp;b=2"/>' END,
        '<media:community><media:starRating count="1"/><media:statistics rank="1" views="', CAST(c_custkey AS STRING), '"/></media:community></media:group></entry><entry><title>no id</title></entry>', CASE WHEN c_custkey % 7 = 0 THEN '<entry>' ELSE '' END, '</feed>') AS payload FROM {customer}""")
    return X.feed_rows(d).select("k", "video_id", "title", "author_name", "view_count", "thumbnail_url", F.unix_seconds("published").alias("published"))


@query("n21_embedded_json", """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '{"a":{"b":' || CAST(page_id AS VARCHAR) || '}}' END AS found FROM pages""")
def n21(spark, sf):
    d = rows(spark, sf, """SELECT page_id, concat(html, CASE WHEN page_id % 3 = 0 THEN concat('<script>var ytInitialData = {{"a":{{"b":', CAST(page_id AS STRING), '}}}};</script>') WHEN page_id % 3 = 1 THEN 'var ytInitialData = {{broken}};' ELSE '' END) AS html FROM {pages}""")
    return d.select("page_id", X.embedded_json(F.col("html")).alias("found"))


@query("n21_bare_assignments", """SELECT page_id, CASE page_id % 4 WHEN 0 THEN '{"a":"it''s ' || page_id || '"}' WHEN 1 THEN '{"w":' || page_id || '}' WHEN 2 THEN '{"p":' || page_id || '}' END AS found FROM pages""")
def n21_bare(spark, sf):
    template = by_case("page_id % 4", """ytInitialData={"a":"it<<chr(92)>>'s <<page_id>>"};""", 'ytInitialData = {broken}; window["ytInitialData"] = {"w":<<page_id>>};', 'ytInitialPlayerResponse =<<chr(10)>>{"p":<<page_id>>};', "ytInitialData = 5;")
    return rows(spark, sf, payloads("page_id", "pages", template)).select(F.col("k").alias("page_id"), X.embedded_json(F.col("payload")).alias("found"))


_INFO = by_case("p_partkey % 5", """{"id":"v<<p_partkey>>","webpage_url":"https://w/<<p_partkey>>","title":"t","fulltitle":"long <<p_size>>","description":"d","channel_id":"UC<<p_partkey>>","channel_url":"https://c/<<p_partkey>>","channel_is_verified":true,
    "channel_follower_count":<<p_partkey>>,"uploader_id":"@@h<<p_size>>","playable_in_embed":false,"view_count":5,"like_count":4,"comment_count":<<p_size>>,"is_live":true,"was_live":false,"availability":"public","duration":<<p_size>>.5,"upload_date":"20240615","timestamp":1,
    "media_type":"Short","tags":["b","a","b"],"categories":["Music","Film"],"language":"en","age_limit":18,"heatmap":[{"start_time":0.5,"value":0.25}],"aspect_ratio":1.78,"chapters":[{"start_time":0,"end_time":<<p_size>>,"title":"c"}],
    "thumbnails":[{"url":"https://i/1","width":10,"height":5}],"formats":[{"format_id":"18","audiocodec":"opus","has_drm":false,"fragments":[{"duration":2}]}],"subtitles":{"en":[{"url":"https://s/1"},{"url":"https://s/2"}],"de":[]},"automatic_captions":{"fr":[{"url":"https://a/<<p_partkey>>"}]}}""",
    '{"id":"v<<p_partkey>>","timestamp":<<p_size>>,"upload_date":"nonsense","media_type":"odd","uploader_id":"@","webpage_url":""}', '{"id":<<p_partkey>>,"title":"t"}', "[<<p_partkey>>]", '{"id":"v<<p_partkey>>","view_count":-<<p_partkey>>,"tags":null,"chapters":[{"start_time":1}]}')


@query("n19_full_records", """WITH p AS (SELECT p_partkey AS k, p_size AS z, p_partkey % 5 AS c FROM part)
    SELECT k, CASE WHEN c IN (0, 1, 4) THEN 'v' || k END AS video_id, CASE WHEN c = 0 THEN 'https://w/' || k WHEN c IN (1, 4) THEN 'https://www.youtube.com/watch?v=v' || k END AS url, CASE WHEN c IN (0, 1, 4) THEN 'https://www.youtube.com/embed/v' || k END AS embed_url,
        CASE WHEN c = 0 THEN 'long ' || z END AS long_title, CASE WHEN c = 0 THEN 'https://c/' || k END AS channel_url, CASE WHEN c = 0 THEN TRUE END AS channel_is_verified, CASE WHEN c = 0 THEN CAST(k AS BIGINT) END AS channel_follower_count,
        CASE WHEN c = 0 THEN 'h' || z END AS channel_handle, CASE WHEN c = 0 THEN FALSE WHEN c IN (1, 4) THEN TRUE END AS embedable, CASE WHEN c = 0 THEN CAST(z AS BIGINT) END AS comment_count, CASE WHEN c = 0 THEN TRUE WHEN c IN (1, 4) THEN FALSE END AS is_live,
        CASE WHEN c IN (0, 1, 4) THEN FALSE END AS was_live, CASE WHEN c = 0 THEN 'public' END AS availability, CASE WHEN c = 0 THEN z + 0.5::DOUBLE END AS duration_s, CASE WHEN c = 0 THEN 1718409600 WHEN c = 1 THEN CAST(z AS BIGINT) END AS published,
        CASE WHEN c = 0 THEN 1718409600 WHEN c = 1 THEN CAST(z AS BIGINT) END AS uploaded, CASE WHEN c = 0 THEN 'short' END AS media_type, CASE WHEN c = 0 THEN 'a,b' WHEN c IN (1, 4) THEN '' END AS tags, CASE WHEN c = 0 THEN 'Music' END AS category,
        CASE WHEN c = 0 THEN 'en' END AS default_audio_language, CASE WHEN c = 0 THEN 18 WHEN c IN (1, 4) THEN 0 END AS age_limit, CASE WHEN c = 0 THEN 0.25::DOUBLE END AS heat, CASE WHEN c = 0 THEN 1.78::DOUBLE WHEN c IN (1, 4) THEN 0.0::DOUBLE END AS aspect_ratio,
        CASE WHEN c = 0 THEN CAST(z AS DOUBLE) END AS chapter_end, CASE WHEN c = 0 THEN 'https://i/1' END AS thumbnail, CASE WHEN c = 0 THEN 'opus' END AS codec, CASE WHEN c = 0 THEN 2.0::DOUBLE END AS fragment, CASE WHEN c = 0 THEN 'en=https://s/2' END AS subtitles,
        CASE WHEN c = 0 THEN 'https://a/' || k END AS automatic, CASE c WHEN 2 THEN 'missing required ''id''' WHEN 3 THEN 'not a JSON object' END AS error FROM p""")
def n19_full(spark, sf):
    r = X.info_rows(rows(spark, sf, payloads("p_partkey", "part", _INFO)))
    plain = ("k", "video_id", "url", "embed_url", "long_title", "channel_url", "channel_is_verified", "channel_follower_count", "channel_handle", "embedable", "comment_count", "is_live", "was_live", "availability", "duration_s", "media_type", "category", "default_audio_language", "age_limit", "aspect_ratio", "error")
    return r.select(
        *plain, F.unix_seconds("published").alias("published"), F.unix_seconds("uploaded").alias("uploaded"), F.array_join("tags", ",").alias("tags"), F.get("heatmaps", 0)["value"].alias("heat"), F.get("chapters", 0)["end_time"].alias("chapter_end"),
        F.element_at("thumbnails", "10x5")["url"].alias("thumbnail"), F.element_at("formats", "18")["audio_codec"].alias("codec"), F.get(F.element_at("formats", "18")["fragments"], 0)["duration"].alias("fragment"),
        F.array_join(F.transform(F.map_entries("subtitles"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("subtitles"), F.element_at("automatic_captions", "fr").alias("automatic"),
    )


_IMPORT = """{"type":"object","properties":{"video_id":{"type":"string"},"url":{"type":"string","format":"uri"},"duration":{"type":"number"},"view_count":{"type":"integer","minimum":0},"published_timestamp":{"type":"string","format":"date-time"},
    "chapters":{"type":"array","items":{"type":"object","required":["title"]}},"subtitles":{"type":"object","additionalProperties":{"type":"object","required":["language_code","url"]}}},"required":["video_id","url"],"additionalProperties":false}"""


@query("sc15_import_chain", """SELECT p_partkey AS k, CASE WHEN p_partkey % 5 IN (2, 3) THEN 'error' WHEN p_partkey % 7 = 0 THEN 'skipped' WHEN p_partkey % 5 = 4 THEN 'error' ELSE 'written' END AS outcome,
    CASE p_partkey % 5 WHEN 2 THEN 'missing required ''id''' WHEN 3 THEN 'not a JSON object' WHEN 4 THEN CASE WHEN p_partkey % 7 <> 0 THEN '/view_count: is less than the minimum of 0' END END AS reason,
    CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN '{"video_id":"v' || p_partkey || '","url":"https://w/' || p_partkey || '","view_count":5,"duration":' || p_size || '.5,"published_timestamp":"2024-06-15T00:00:00Z","chapters":[{"start_time":0.0,"end_time":' || p_size || '.0,"title":"c"}],"subtitles":{"en":{"language_code":"en","url":"https://s/2"}}}'
        WHEN p_partkey % 5 = 1 THEN '{"video_id":"v' || p_partkey || '","url":"https://www.youtube.com/watch?v=v' || p_partkey || '","published_timestamp":"1970-01-01T00:00:' || lpad(CAST(p_size AS VARCHAR), 2, '0') || 'Z"}' END AS document FROM part""")
def sc15_chain(spark, sf):
    docs = rows(spark, sf, payloads("p_partkey", "part", _INFO))
    have = rows(spark, sf, "SELECT concat('v', CAST(p_partkey AS STRING)) AS video_id FROM {part} WHERE p_partkey % 7 = 0")
    return I.import_documents(docs, have, _IMPORT).select("k", "outcome", "reason", "document")


@query("n20_full_entries", """SELECT c_custkey AS k, 'v' || c_custkey AS video_id, 'https://www.youtube.com/watch?v=v' || c_custkey AS url, 'https://www.youtube.com/embed/v' || c_custkey AS embed_url, CASE WHEN c_custkey % 3 > 0 THEN 'UC' || c_custkey END AS channel_id, 'h' || c_custkey AS channel_handle,
    CASE WHEN c_custkey % 2 = 0 THEN 'https://www.youtube.com/channel/UC' || c_custkey ELSE 'https://www.youtube.com/@h' || c_custkey END AS channel_url, CASE WHEN c_custkey % 5 > 0 THEN CAST(1718447400 AS BIGINT) END AS uploaded, CASE WHEN c_custkey % 4 > 0 THEN c_name || ' & more' END AS description FROM customer""")
def n20_full(spark, sf):
    template = """<feed xmlns:yt="y" xmlns:media="m" xmlns="http://www.w3.org/2005/Atom"><entry><yt:videoId>v<<c_custkey>></yt:videoId><<CASE WHEN c_custkey % 3 != 0 THEN concat('<yt:channelId>UC', CAST(c_custkey AS STRING), '</yt:channelId>') ELSE '' END>><title>t</title><author><name>n</name>"""
    template += """<<CASE WHEN c_custkey % 2 = 0 THEN concat('<uri>https://www.youtube.com/channel/UC', CAST(c_custkey AS STRING), '</uri>') ELSE '' END>></author><<CASE WHEN c_custkey % 5 != 0 THEN '<updated>2024-06-15T10:30:00+00:00</updated>' ELSE '<updated>soon</updated>' END>>"""
    template += """<media:group><<CASE WHEN c_custkey % 4 != 0 THEN concat('<media:description>', c_name, ' &amp; more</media:description>') ELSE '' END>></media:group></entry></feed>"""
    d = rows(spark, sf, payloads("c_custkey", "customer", template))
    names = ("k", "video_id", "url", "embed_url", "channel_id", "channel_handle", "channel_url", "description")
    return X.feed_rows(d, handle=F.concat(F.lit("h"), F.col("k").cast("string"))).select(*names, F.unix_seconds("uploaded").alias("uploaded"))


_FULL_PLAYER = by_case("p_partkey % 3", """{"videoDetails":{"videoId":"v<<p_partkey>>","title":"t","author":"a<<p_size>>","isLiveContent":true,"isTvFilmVideo":false,"tags":["y","x"],"keywords":["k"],"thumbnail":{"thumbnails":[{"url":"u1","width":10,"height":5},{"url":"u2","width":10,"height":5},{"id":"big","url":"u3"}]},
    "chapters":[{"start_time":<<p_size>>,"title":"c"}],"formats":[{"format_id":"1","ext":"w"},{"format_id":"1","ext":"x","videocodec":"av1"}]},"microformat":{"playerMicroformatRenderer":{"canonicalUrl":"https://w/<<p_partkey>>","embed":{"iframeUrl":"https://e/<<p_partkey>>"},"ownerProfileUrl":"https://o/<<p_size>>",
    "isUnlisted":true,"uploadDate":"2024-06-15T10:30:00+00:00","category":"new","isFamilySafe":false}}}""", '{"videoDetails":{"author":"","tags":[]},"microformat":{"playerMicroformatRenderer":{"canonicalUrl":"","ownerProfileUrl":""}}}', "{}")


@query("n10_full_player", """WITH p AS (SELECT p_partkey AS k, p_size AS z, p_partkey % 3 = 0 AS f FROM part)
    SELECT k, CASE WHEN f THEN 'https://w/' || k ELSE 'old url' END AS url, CASE WHEN f THEN 'https://e/' || k ELSE 'old embed' END AS embed_url, CASE WHEN f THEN 'a' || z ELSE 'old handle' END AS channel_handle, CASE WHEN f THEN 'https://o/' || z ELSE 'old channel' END AS channel_url,
        CASE WHEN f THEN CAST(1718447400 AS BIGINT) END AS uploaded, coalesce(CASE WHEN f THEN TRUE END, k % 2 = 0) AS is_live, CASE WHEN f THEN TRUE END AS was_live, CASE WHEN f THEN 'private' ELSE 'public' END AS privacy_status, CASE WHEN f THEN FALSE END AS is_family_safe, CASE WHEN f THEN FALSE END AS is_tv_film_video,
        CASE WHEN f THEN 'old,x,y' ELSE 'old' END AS tags, 'old category' AS category, CASE WHEN f THEN '10x5=u1,big=u3' END AS thumbnails, CASE WHEN f THEN CAST(z AS DOUBLE) END AS chapter, CASE WHEN f THEN 'x/av1' END AS format FROM p""")
def n10_full(spark, sf):
    more = ", 'old url' AS url, 'old embed' AS embed_url, 'old handle' AS channel_handle, 'old channel' AS channel_url, 'old category' AS category, array('old') AS tags, p_partkey % 2 = 0 AS is_live"
    r = X.player_rows(rows(spark, sf, payloads("p_partkey", "part", _FULL_PLAYER, more)), existing=("url", "embed_url", "channel_handle", "channel_url", "category", "tags", "is_live"))
    one = F.element_at("formats", "1")
    return r.select(
        "k", "url", "embed_url", "channel_handle", "channel_url", F.unix_seconds("uploaded").alias("uploaded"), "is_live", "was_live", "privacy_status", "is_family_safe", "is_tv_film_video", F.array_join("tags", ",").alias("tags"), "category",
        F.array_join(F.transform(F.map_entries("thumbnails"), lambda e: F.concat(e["key"], F.lit("="), e["value"]["url"])), ",").alias("thumbnails"), F.get("chapters", 0)["start_time"].alias("chapter"), F.concat(one["ext"], F.lit("/"), one["video_codec"]).alias("format"),
    )


@query("pf8_no_content", "SELECT c_custkey AS k, c_custkey % 3 <> 0 AS empty FROM customer")
def pf8(spark, sf):
    d = rows(spark, sf, "SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN array('v') WHEN c_custkey % 3 = 1 THEN array() END AS videos, CAST(NULL AS ARRAY<STRING>) AS playlists FROM {customer}")
    return d.select("k", X.no_content("videos", "playlists").alias("empty"))


@query("pf27_normal_formats", "SELECT p_partkey AS k, '1' AS format_id, p_brand AS audio_codec, p_type AS thumbnail_url, 0 AS video_count FROM part")
def pf27(spark, sf):
    d = rows(spark, sf, "SELECT p_partkey AS k, array(named_struct('format_id', '1', 'audio_codec', CAST(NULL AS STRING), 'audiocodec', p_brand, 'thumb_url', p_type, 'thumbnail_url', 'x', 'video_count', CAST(NULL AS INT))) AS f FROM {part}")
    return d.select("k", F.inline(X.normal_formats(F.col("f"))))


@query("sc15_import_outcomes", "SELECT p_partkey AS k, CASE WHEN p_partkey % 5 = 0 THEN 'error' WHEN p_partkey % 3 = 0 THEN 'skipped' ELSE 'written' END AS outcome FROM part")
def sc15(spark, sf):
    from ..sources.sinks import import_outcomes

    d = rows(spark, sf, "SELECT p_partkey AS k, CAST(p_partkey AS STRING) AS video_id, CASE WHEN p_partkey % 5 = 0 THEN 'bad' END AS error FROM {part}")
    return import_outcomes(d, d.filter("k % 3 = 0")).select("k", "outcome")


@query("sk9_queue_snapshot_rows", cte("queue") + "SELECT tier, count(*) AS n, CAST(sum(due_ts) AS DOUBLE) AS due FROM queue GROUP BY 1")
def sk9(spark, sf):
    from ..sources.sinks import queue_snapshot as snapshot

    s = snapshot(rows(spark, sf, "queue"))
    return s.select("tier", F.explode(F.from_json("rows", "array<array<string>>")).alias("r")).groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("r")[0].cast("double")).alias("due"))
