"""Enrichment queries: parts are videos, suppliers are channels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich as E
from ..sources.kept import KeptTable
from .binding import cte, rows, scratch

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


_VIDEOS = """SELECT CAST(p_partkey AS STRING) AS video_id, CASE WHEN p_partkey % 3 = 0 THEN 'UCx' END AS channel_id, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE 'own' END AS channel_handle,
    CASE WHEN p_partkey % 5 = 0 THEN 'https://www.youtube.com/channel/UCx' END AS channel_url, CASE WHEN p_partkey % 2 = 0 THEN CAST(7 AS BIGINT) END AS subscriber_count FROM {part} WHERE p_partkey % 6 <> 5"""
# the fold over one video's channels, as a recursion over its ordered log
FOLD = cte("channel_videos") + """, v AS (SELECT CAST(p_partkey AS VARCHAR) AS video_id FROM part WHERE p_partkey % 6 <> 5),
    l AS (SELECT c.*, row_number() OVER (PARTITION BY c.video_id ORDER BY mtime, seq, channel_id, channel_handle, verified, subscriber_count) AS n FROM channel_videos c JOIN v ON v.video_id = c.video_id),
    f AS (WITH RECURSIVE r AS (
        SELECT video_id, n, channel_id, channel_handle, verified, subscriber_count, CAST(0 AS BIGINT) AS collisions FROM l WHERE n = 1
        UNION ALL SELECT l.video_id, l.n, CASE WHEN w THEN l.channel_id ELSE p.channel_id END, CASE WHEN w THEN l.channel_handle ELSE p.channel_handle END, CASE WHEN w THEN l.verified ELSE p.verified END,
            CASE WHEN w THEN l.subscriber_count ELSE p.subscriber_count END, p.collisions + CASE WHEN l.channel_id = p.channel_id THEN 0 ELSE 1 END
        FROM r p JOIN l ON l.video_id = p.video_id AND l.n = p.n + 1,
            LATERAL (SELECT CASE WHEN l.channel_id = p.channel_id THEN TRUE WHEN l.verified <> p.verified THEN l.verified
                WHEN ends_with(upper(l.channel_handle), 'VEVO') <> ends_with(upper(p.channel_handle), 'VEVO') THEN ends_with(upper(l.channel_handle), 'VEVO') ELSE l.subscriber_count > p.subscriber_count END AS w))
        SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY n DESC) = 1) """


def _mapping(spark, sf):
    return E.fold_mapping(E.only_known(rows(spark, sf, "channel_videos"), rows(spark, sf, _VIDEOS)))


@query("j4_only_known", cte("channel_videos") + "SELECT c.* FROM channel_videos c WHERE CAST(video_id AS BIGINT) IN (SELECT p_partkey FROM part WHERE p_partkey % 6 <> 5)")
def j4(spark, sf):
    return E.only_known(rows(spark, sf, "channel_videos"), rows(spark, sf, _VIDEOS))


@query("a9_fold_mapping", FOLD + "SELECT video_id, channel_id, channel_handle, verified, subscriber_count, collisions FROM f")
def a9(spark, sf):
    return _mapping(spark, sf)


@query("j5_pf19_augment", FOLD.replace("f AS (WITH", f"vv AS ({_VIDEOS.replace('{part}', 'part')}), f AS (WITH") + """, a AS (SELECT vv.*, f.video_id IS NOT NULL AS has, f.channel_id AS ci, f.channel_handle AS ch, 'https://www.youtube.com/@' || f.channel_handle AS cu, CASE WHEN f.subscriber_count >= 0 THEN f.subscriber_count END AS sc
        FROM vv LEFT JOIN f ON f.video_id = vv.video_id),
    t AS (SELECT *, channel_id IS NULL AND ci IS NOT NULL AS t1, channel_handle = '' AND ch IS NOT NULL AS t2, (channel_url IS NULL OR contains(channel_url, '/channel/')) AND cu IS NOT NULL AS t3, subscriber_count IS NULL AND sc IS NOT NULL AS t4 FROM a)
    SELECT video_id, CASE WHEN t1 THEN ci ELSE channel_id END AS channel_id, CASE WHEN t2 THEN ch ELSE channel_handle END AS channel_handle, CASE WHEN t3 THEN cu ELSE channel_url END AS channel_url,
    CASE WHEN t4 THEN sc ELSE subscriber_count END AS subscriber_count, CASE WHEN NOT has THEN 'no_mapping' WHEN t1 OR t2 OR t3 OR t4 THEN 'updated' ELSE 'noop' END AS outcome FROM t""")
def j5(spark, sf):
    return E.augment(rows(spark, sf, _VIDEOS), E.channel_facts(_mapping(spark, sf)))


@query("pf23_channel_facts", """SELECT s_suppkey, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS channel_handle, CASE WHEN s_acctbal >= 0 THEN CAST(floor(s_acctbal) AS BIGINT) END AS subscriber_count,
    'https://www.youtube.com/@' || s_name AS channel_url FROM supplier WHERE s_suppkey % 4 <> 0""")
def pf23(spark, sf):
    return E.channel_facts(rows(spark, sf, "SELECT s_suppkey, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS channel_handle, CAST(floor(s_acctbal) AS BIGINT) AS subscriber_count FROM {supplier}"))


@query("sk8_incremental_mapping", FOLD + "SELECT video_id, channel_id, channel_handle, verified, subscriber_count FROM f")
def sk8(spark, sf):
    links = E.only_known(rows(spark, sf, "channel_videos"), rows(spark, sf, _VIDEOS))
    cut = 3000
    return E.merge_mapping(E.fold_mapping(links.filter(F.col("mtime") < cut)), links.filter(F.col("mtime") >= cut)).drop("collisions")


@query("j5_outcomes_with_errors", FOLD.replace("f AS (WITH", f"vv AS ({_VIDEOS.replace('{part}', 'part')}), f AS (WITH") + """SELECT vv.video_id, CASE WHEN CAST(vv.video_id AS BIGINT) % 7 = 3 THEN 'error' WHEN f.video_id IS NULL THEN 'no_mapping' ELSE 'other' END AS outcome,
    CASE WHEN CAST(vv.video_id AS BIGINT) % 7 = 3 THEN vv.channel_handle END AS untouched FROM vv LEFT JOIN f ON f.video_id = vv.video_id""")
def j5e(spark, sf):
    bad = F.when(F.col("video_id").cast("bigint") % 7 == 3, "unreadable").alias("bad")
    out = E.augment(rows(spark, sf, _VIDEOS).select("*", bad), E.channel_facts(_mapping(spark, sf)), error="bad")
    known = F.when(F.col("outcome").isin("updated", "noop"), "other").otherwise(F.col("outcome"))
    return out.select("video_id", known.alias("outcome"), F.when(F.col("outcome") == "error", F.col("channel_handle")).alias("untouched"))


@query("tk3_newest_channel_record", cte("channel_videos") + "SELECT channel_id, max(mtime) AS mtime FROM channel_videos GROUP BY 1")
def tk3(spark, sf):
    return E.newest(rows(spark, sf, "channel_videos"), "channel_id", "mtime").select("channel_id", "mtime")


@query("sk8_kept_mapping", FOLD + "SELECT video_id, channel_id, channel_handle, verified, subscriber_count FROM f")
def sk8_kept(spark, sf):
    table, links = KeptTable(spark, scratch(spark, "mapping"), E.MAPPING, "video_id", 16), rows(spark, sf, "channel_videos")
    middle = links.agg(F.floor((F.min("mtime") + F.max("mtime")) / 2)).first()[0]
    for seen in (links.filter(F.col("mtime") <= middle), links, links):  # the input grows; the third run finds nothing new
        E.refresh_mapping(table, seen, rows(spark, sf, _VIDEOS))
    return table.rows()
