"""Scalar functions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import channels as C
from ..functions import numbers as N
from ..functions import web as W
from .binding import cte, rows

TIERS = N.parse_tiers("4:6000000,12:1000000,24:100000,48:0")

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


_URL_RE = r"(?i)^https?://(?:www\.|m\.|music\.)?youtube\.com/(?:@([A-Za-z0-9._-]+)|c/([A-Za-z0-9._-]+)|user/([A-Za-z0-9._-]+)|channel/(UC[A-Za-z0-9_-]{22}))(?:[/?#].*)?$"
CANON = "coalesce(" + ", ".join(f"nullif(regexp_extract({{v}}, '{_URL_RE}', {g}), '')" for g in (4, 1, 2, 3)) + ")"
JSONCH = "CASE WHEN starts_with({v}, '{{') THEN nullif(json_extract_string({v}, '$.channel'), '') END"
HEAD = "CASE WHEN NOT starts_with({v}, '{{') AND contains({v}, ',') THEN nullif(trim(split_part({v}, ',', 1)), '') END"
IDT = "regexp_matches({v}, '^UC[A-Za-z0-9_-]{{22}}$')"
KEY = f"lower(coalesce({JSONCH}, {CANON.replace('{22}', '{{22}}')}, {HEAD}, {{v}}))".replace("{{22}}", "{{22}}")
RANK = f"CASE WHEN {JSONCH} IS NOT NULL THEN 2 WHEN {CANON.replace('{22}', '{{22}}')} IS NOT NULL THEN -1 WHEN coalesce({HEAD}, {{v}}) <> lower(coalesce({HEAD}, {{v}})) THEN 1 ELSE 0 END"


def on(text: str, v: str = "value") -> str:
    return text.replace("{{22}}", "\x00").replace("{v}", v).replace("{{", "{").replace("}}", "}").replace("\x00", "{22}")


@query("f1_f5_line_forms", cte("lines") + f"""SELECT pos, {on(IDT)} AS is_id, regexp_matches(value, '(?i)^UC[A-Za-z0-9_-]{{22}}$') AS is_id_any,
    regexp_matches(value, '^channel/UC[A-Za-z0-9_-]{{22}}$') AS is_path, 'https://www.youtube.com/' || value AS path_url, {on(CANON)} AS canonical,
    starts_with(value, '{{') AS is_json, {on(JSONCH)} AS json_channel FROM lines""")
def f1_f5(spark, sf):
    v = F.col("value")
    return rows(spark, sf, "lines").select("pos", C.is_channel_id(v).alias("is_id"), C.is_channel_id(v, True).alias("is_id_any"), C.is_id_path(v).alias("is_path"),
        C.id_path_to_url(v).alias("path_url"), C.url_canonical(v).alias("canonical"), C.is_json_entry(v).alias("is_json"), C.json_channel(v).alias("json_channel"))


@query("f6_f9_dedupe_key_rank", cte("lines") + f"""SELECT pos, {on(HEAD)} AS head, {on(KEY)} AS dedupe_key, {on(RANK)} AS dedupe_rank,
    regexp_matches(value, '\\s') OR contains(value, '....') AS display_name,
    CASE WHEN regexp_matches(value, '^(?i:uc)[A-Za-z0-9_-]{{22}}$') THEN 'UC' || substr(value, 3) END AS repaired FROM lines""")
def f6_f9(spark, sf):
    v = F.col("value")
    return rows(spark, sf, "lines").select("pos", C.handle_part(v).alias("head"), C.dedupe_key(v).alias("dedupe_key"), C.dedupe_rank(v).alias("dedupe_rank"),
        C.is_display_name(v).alias("display_name"), C.repaired_id(v).alias("repaired"))


@query("f10_parse_line", cte("lines") + """, t AS (SELECT pos, trim(value) AS x, CASE pos % 14 WHEN 0 THEN value WHEN 1 THEN value WHEN 2 THEN substr(value, 2)
    WHEN 3 THEN 'Chan' || CAST(pos % 97 AS VARCHAR) WHEN 4 THEN 'Chan' || CAST(pos % 97 AS VARCHAR) WHEN 5 THEN 'chan' || CAST(pos % 97 AS VARCHAR)
    WHEN 11 THEN 'Tab' || CAST(pos % 97 AS VARCHAR) END AS handle,
    CASE WHEN pos % 14 IN (6, 7, 10, 13) THEN 'UC' || lpad(CAST(pos % 97 AS VARCHAR), 22, '0') END AS channel_id FROM lines) SELECT pos, handle, channel_id FROM t""")
def f10(spark, sf):
    return rows(spark, sf, "lines").select("pos", C.parse_channel_line(F.col("value")).alias("p")).select("pos", "p.handle", "p.channel_id")


_COUNTS = """SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderkey % 900 AS STRING) || ',' || lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0')
    WHEN 1 THEN CAST(o_orderkey % 50 AS STRING) || '.5M subscribers' WHEN 2 THEN CAST(o_orderkey % 70 AS STRING) || 'K' WHEN 3 THEN 'none' ELSE CAST(o_orderkey AS STRING) || ' views' END AS t FROM {orders}"""


@query("f11_f13_numbers", "WITH i AS (" + _COUNTS.replace("{orders}", "orders") + """) SELECT k,
    CAST(CASE k % 5 WHEN 0 THEN (k % 900) * 1000 + k % 1000 WHEN 1 THEN (k % 50) * 1000000 + 500000 WHEN 2 THEN (k % 70) * 1000 WHEN 3 THEN NULL ELSE k END AS BIGINT) AS converted,
    CAST(CASE k % 5 WHEN 0 THEN (CASE WHEN k % 900 = 0 THEN k % 1000 ELSE (k % 900) * 1000 + k % 1000 END) WHEN 1 THEN k % 50 WHEN 2 THEN k % 70 WHEN 3 THEN NULL ELSE k END AS BIGINT) AS leading,
    CAST(TRY_CAST(CASE WHEN k % 5 = 4 THEN CAST(k AS VARCHAR) || 'e1' ELSE t END AS DOUBLE) AS BIGINT) AS lenient, TRY_CAST(t AS BIGINT) AS strict FROM i""")
def f11_f13(spark, sf):
    t = F.col("t")
    return rows(spark, sf, _COUNTS).select("k", N.convert_count(t).alias("converted"), N.leading_count(t).alias("leading"),
        N.lenient_int(F.when(F.col("k") % 5 == 4, F.concat(F.col("k").cast("string"), F.lit("e1"))).otherwise(t)).alias("lenient"), N.strict_int(t).alias("strict"))


_QUOTED = """SELECT p_partkey AS k, p_brand || ', "' || p_name || '" ' || p_type AS t, p_brand AS b, p_name AS n, p_type AS c FROM {part}"""


@query("f14_split_quoted", "WITH i AS (" + _QUOTED.replace("{part}", "part") + """) SELECT k, list_sort(list_distinct(list_filter(
    list_concat(list_concat(string_split(b, ' '), [n]), string_split(c, ' ')), lambda x: x <> ''))) AS words FROM i""")
def f14(spark, sf):
    return rows(spark, sf, _QUOTED).select("k", W.split_quoted(F.col("t")).alias("words"))


_NAMES = """SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN ' @' || c_name || ' ' WHEN 1 THEN 'https://www.youtube.com/@' || c_name || '/' WHEN 2 THEN c_name || '@example.org' ELSE '@@' END AS t FROM {customer}"""


@query("f15_f18_handles", "WITH i AS (" + _NAMES.replace("{customer}", "customer") + """) SELECT k,
    nullif(lower(trim(regexp_replace(trim(t), '^@+', ''))), '') AS fallback, nullif(regexp_extract(t, '/@([^/?]+)', 1), '') AS from_url,
    CASE k % 4 WHEN 0 THEN substr(trim(t), 2) WHEN 1 THEN regexp_extract(t, '@([^/]+)', 1) WHEN 2 THEN split_part(t, '@', 1) END AS typed,
    'channel-' || t || '.json.br' AS file_name, t AS back FROM i""")
def f15_f18(spark, sf):
    t = F.col("t")
    return rows(spark, sf, _NAMES).select("k", C.fallback_handle(t).alias("fallback"), C.handle_from_url(t).alias("from_url"), C.typed_name(t).alias("typed"),
        C.channel_file_name(t).alias("file_name"), C.handle_of_file_name(C.channel_file_name(t)).alias("back"))


_PROXIES = """SELECT event_id AS k, CASE event_id % 4 WHEN 0 THEN 'http://u:p@10.' || CAST(user_id % 250 AS STRING) || '.0.7:8080' WHEN 1 THEN 'socks5://proxy' || CAST(user_id AS STRING) || '.example:1080'
    WHEN 2 THEN 'http://[::1]:80' ELSE '10.0.0.' || CAST(user_id % 250 AS STRING) END AS proxy,
    CAST(CASE event_id % 6 WHEN 0 THEN 404 WHEN 1 THEN 503 WHEN 2 THEN 429 WHEN 3 THEN 200 WHEN 4 THEN 301 END AS INT) AS code,
    CASE event_id % 3 WHEN 0 THEN '0.2' WHEN 1 THEN '30' ELSE 'soon' END AS header,
    CASE event_id % 8 WHEN 0 THEN 'HTTP 429 Too Many Requests' WHEN 1 THEN 'Video unavailable' WHEN 2 THEN 'Channel is offline.' WHEN 3 THEN 'Channel is offline' WHEN 4 THEN 'Premieres in 2 hours'
      WHEN 5 THEN 'SSL: bad' WHEN 6 THEN 'Missing microformat data' ELSE event_type END AS message FROM {events}"""


@query("f19_f22_outcome_classes", "WITH i AS (" + _PROXIES.replace("{events}", "events") + """) SELECT k,
    CASE WHEN k % 4 = 2 THEN NULL ELSE regexp_extract(proxy, '^(?:[^:]+://)?(?:[^@]*@)?([^:]+)', 1) END AS host,
    CASE WHEN code IS NULL THEN 'error' WHEN code = 404 THEN 'not_found' ELSE CAST(code // 100 AS VARCHAR) || 'xx' END AS status_class,
    CASE WHEN code = 404 THEN 'not_found' ELSE 'failure' END AS rejected, CASE WHEN code = 404 THEN 'info' WHEN code BETWEEN 500 AND 599 THEN 'error' ELSE 'warning' END AS level,
    CASE header WHEN '0.2' THEN 1.0 WHEN '30' THEN 30.0 ELSE 5.0 END::DOUBLE AS retry,
    CASE k % 8 WHEN 0 THEN 'rate_limit' WHEN 1 THEN 'unavailable' WHEN 2 THEN 'unavailable' WHEN 3 THEN 'transient' WHEN 4 THEN 'premiere' WHEN 5 THEN 'transient' WHEN 6 THEN 'missing_data' ELSE 'other' END AS reason,
    CASE WHEN code = 404 THEN 'not_found' WHEN code BETWEEN 500 AND 599 THEN 'server_error' WHEN code >= 400 THEN 'http_error' END AS feed_reason FROM i""")
def f19_f22(spark, sf):
    c = F.col("code")
    return rows(spark, sf, _PROXIES).select("k", W.proxy_host(F.col("proxy")).alias("host"), W.status_class(c).alias("status_class"), W.rejection(c)["outcome"].alias("rejected"),
        W.rejection(c)["level"].alias("level"), W.retry_after(F.col("header"), 5.0).alias("retry"), W.error_reason(F.col("message")).alias("reason"), W.feed_failure(c)["reason"].alias("feed_reason"))


def tier_sql(count: str, unknown: int = 1) -> str:
    return f"CASE WHEN {count} IS NULL THEN {unknown} WHEN {count} >= 6000000 THEN 1 WHEN {count} >= 1000000 THEN 2 WHEN {count} >= 100000 THEN 3 ELSE 4 END"


INTERVAL_SQL = "CASE {t} WHEN 1 THEN 4.0 WHEN 2 THEN 12.0 WHEN 3 THEN 24.0 ELSE 48.0 END::DOUBLE"


@query("f23_f24_tiers", cte("creators") + f", t AS (SELECT creator_id, {tier_sql('subs')} AS tier, {tier_sql('subs', 3)} AS seeded FROM creators) SELECT *, {INTERVAL_SQL.replace('{t}', 'tier')} AS hours FROM t")
def f23_f24(spark, sf):
    t = rows(spark, sf, "creators").select("creator_id", N.tier_for(F.col("subs"), TIERS).alias("tier"), N.tier_for(F.col("subs"), TIERS, "next_to_last").alias("seeded"))
    return t.withColumn("hours", N.interval_hours(F.col("tier"), TIERS).cast("double"))


_LINKS = """SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN 'https://www.twitter.com/' || c_name WHEN 1 THEN 'http://x.com/a' WHEN 2 THEN 'https://shop.amazon.co.uk/b' WHEN 3 THEN 'https://linktr.ee'
    WHEN 4 THEN 'https://example.org/' || c_name ELSE '//cdn.example.org/p.jpg' END AS url, 'https://host/api/v1/data/param/own' || CAST(c_custkey % 7 AS STRING) || '/youtube/video/0.0.' || CAST(c_custkey % 3 AS STRING) || '/x?y=1' AS data_url FROM {customer}"""


@query("f26_f27_f31_urls", "WITH i AS (" + _LINKS.replace("{customer}", "customer") + """) SELECT k,
    CASE k % 6 WHEN 0 THEN 'Twitter' WHEN 1 THEN 'X' WHEN 2 THEN 'Amazon' ELSE 'www' END AS label,
    'own' || CAST(k % 7 AS VARCHAR) AS owner, 'youtube' AS platform, 'video' AS entity, '0.0.' || CAST(k % 3 AS VARCHAR) AS version,
    CASE WHEN starts_with(url, '//') THEN 'https:' || url ELSE url END AS full_url, 'https://www.youtube.com/watch?v=' || CAST(k AS VARCHAR) AS watch,
    'https://www.youtube.com/embed/' || CAST(k AS VARCHAR) AS embed, 'https://www.youtube.com/@' || CAST(k AS VARCHAR) AS page FROM i""")
def f26_f31(spark, sf):
    k, u = F.col("k").cast("string"), F.col("url")
    return rows(spark, sf, _LINKS).select("k", W.link_label(u).alias("label"), W.data_url(F.col("data_url")).alias("d"), W.with_scheme(u).alias("full_url"), W.watch_url(k).alias("watch"),
        W.embed_url(k).alias("embed"), W.handle_url(k).alias("page")).select("k", "label", "d.*", "full_url", "watch", "embed", "page")


_DATES = """SELECT o_orderkey AS k, CASE o_orderkey % 5 WHEN 0 THEN '2024-06-15T10:30:00Z' WHEN 1 THEN '20240615' WHEN 2 THEN '1718447400' WHEN 3 THEN 'Joined Jun 15, 2024' ELSE 'yesterday' END AS t,
    CASE o_orderkey % 4 WHEN 0 THEN 'Shorts' WHEN 1 THEN ' MOVIE' WHEN 2 THEN 'clip' END AS kind, CASE o_orderkey % 3 WHEN 0 THEN 'AGE_VERIFICATION_REQUIRED' WHEN 1 THEN 'OK' END AS status FROM {orders}"""


@query("f28_f30_types_times", "WITH i AS (" + _DATES.replace("{orders}", "orders") + """) SELECT k,
    CASE k % 5 WHEN 0 THEN epoch(TIMESTAMP '2024-06-15 10:30:00') WHEN 1 THEN epoch(TIMESTAMP '2024-06-15') WHEN 2 THEN 1718447400 WHEN 3 THEN epoch(TIMESTAMP '2024-06-15') END::BIGINT AS seconds,
    CASE k % 4 WHEN 0 THEN 'short' WHEN 1 THEN 'movie' END AS media, k % 3 = 0 AS restricted FROM i""")
def f28_f30(spark, sf):
    return rows(spark, sf, _DATES).select("k", F.unix_seconds(N.lenient_timestamp(F.col("t"))).alias("seconds"), W.media_type(F.col("kind")).alias("media"),
        W.age_restricted(F.col("status"), F.lit(None).cast("string")).alias("restricted"))


@query("f32_f33_page_marks", """SELECT page_id, CASE WHEN url = '' THEN '<root>' ELSE url END || ': bad' AS message, nullif(regexp_extract(html, '"externalId":"(UC[A-Za-z0-9_-]{22})"', 1), '') AS channel_id,
    coalesce(regexp_matches(html, '"BADGE_STYLE_TYPE_VERIFIED"|"tooltip":"Verified"'), FALSE) AS verified FROM pages""")
def f32_f33(spark, sf):
    return rows(spark, sf, "SELECT page_id, url, html FROM {pages}").select("page_id", W.validation_message(F.col("url"), F.lit("bad")).alias("message"), C.page_channel_id(F.col("html")).alias("channel_id"), C.page_verified(F.col("html")).alias("verified"))
