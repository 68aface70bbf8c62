"""Channel-list queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import channels as C
from ..operators import lists as L
from ..sources.kept import KeptTable
from .binding import cte, rows, scratch
from .scalars import CANON, IDT, JSONCH, KEY, RANK, on

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def maps(spark, sf):
    return L.latest(rows(spark, sf, "creator_map"), "channel_id", "handle"), L.latest(rows(spark, sf, "name_map"), "title", "channel_id")


MAPS = """, cm AS (SELECT channel_id, arg_max(handle, seq) AS handle FROM creator_map GROUP BY 1), nm AS (SELECT title, arg_max(channel_id, seq) AS channel_id FROM name_map GROUP BY 1)"""
DEDUPED = f""", keyed AS (SELECT pos, value, {on(KEY)} AS dk, {on(RANK)} AS rk FROM entries),
    d1 AS (SELECT min(pos) OVER (PARTITION BY dk) AS pos, value, row_number() OVER (PARTITION BY dk ORDER BY rk DESC, pos) AS n FROM keyed)"""
ENTRIES = ", entries AS (SELECT * FROM lines WHERE NOT starts_with(trim(value), '#'))"
CLASSED = f""", deduped AS (SELECT pos, value FROM d1 WHERE n = 1),
    k AS (SELECT pos, value, CASE WHEN starts_with(value, '{{') THEN 'json' WHEN {on(CANON)} IS NOT NULL THEN 'url' WHEN regexp_matches(value, '\\s') THEN 'display_name' WHEN {on(IDT)} THEN 'channel_id' ELSE 'other' END AS e,
        {on(CANON)} AS canon FROM deduped),
    i AS (SELECT k.*, CASE WHEN e = 'url' AND regexp_matches(canon, '^UC[A-Za-z0-9_-]{{22}}$') THEN canon WHEN e = 'channel_id' THEN value WHEN e = 'display_name' THEN nm.channel_id END AS cid FROM k LEFT JOIN nm ON nm.title = value),
    c AS (SELECT i.pos, value, e, cm.handle, CASE e WHEN 'url' THEN CASE WHEN cid IS NULL THEN canon ELSE coalesce(cm.handle, cid) END WHEN 'display_name' THEN coalesce(cm.handle, cid)
        WHEN 'channel_id' THEN coalesce(cm.handle, value) ELSE value END AS result,
        CASE e WHEN 'json' THEN 'kept_json' WHEN 'other' THEN 'kept_other' WHEN 'display_name' THEN CASE WHEN cid IS NULL THEN 'spaces_dropped' WHEN cm.handle IS NOT NULL THEN 'spaces_resolved_handle' ELSE 'spaces_resolved_channel_id' END
        WHEN 'channel_id' THEN CASE WHEN cm.handle IS NOT NULL THEN 'channel_id_resolved' ELSE 'channel_id_kept' END
        ELSE CASE WHEN cid IS NOT NULL AND cm.handle IS NULL THEN 'url_kept_channel_id' ELSE 'url_resolved_handle' END END AS class FROM i LEFT JOIN cm ON cm.channel_id = cid)"""
BASE = cte("lines", "creator_map", "name_map") + MAPS + ENTRIES + DEDUPED + CLASSED


@query("a1_dedupe_preserving_case", cte("lines") + ENTRIES + DEDUPED + " SELECT pos, value FROM d1 WHERE n = 1")
def a1(spark, sf):
    return L.dedupe_preserving_case(L.split_header(rows(spark, sf, "lines"))[1])


@query("sc8_split_header", cte("lines") + """, f AS (SELECT min(pos) AS p FROM lines WHERE NOT starts_with(trim(value), '#'))
    SELECT pos, value, pos < p AS header FROM lines, f WHERE pos < p OR NOT starts_with(trim(value), '#')""")
def sc8(spark, sf):
    header, entries = L.split_header(rows(spark, sf, "lines"))
    return header.withColumn("header", F.lit(True)).unionByName(entries.withColumn("header", F.lit(False)))


@query("a2_cleanup_counts", BASE + ", all_c AS (SELECT unnest([" + ", ".join(f"'{c}'" for c in L.CLEANUP_CLASSES) + "]) AS class) SELECT a.class, count(c.pos) AS n FROM all_c a LEFT JOIN c ON c.class = a.class GROUP BY 1")
def a2(spark, sf):
    cm, nm = maps(spark, sf)
    return L.class_counts(L.classify_entries(L.dedupe_preserving_case(L.split_header(rows(spark, sf, "lines"))[1]), cm, nm))


@query("pf18_j1_j2_classify_resolve", BASE + " SELECT pos, value, e AS entry_class, class, result FROM c")
def pf18(spark, sf):
    cm, nm = maps(spark, sf)
    return L.classify_entries(L.dedupe_preserving_case(L.split_header(rows(spark, sf, "lines"))[1]), cm, nm)


@query("so3_clean_list", BASE + f""", kept AS (SELECT pos, result AS value FROM c WHERE result IS NOT NULL), k2 AS (SELECT pos, value, {on(KEY)} AS dk, {on(RANK)} AS rk FROM kept),
    d2 AS (SELECT min(pos) OVER (PARTITION BY dk) AS pos, value, row_number() OVER (PARTITION BY dk ORDER BY rk DESC, pos) AS n FROM k2)
    SELECT pos, value, TRUE AS kept FROM d2 WHERE n = 1 UNION ALL SELECT pos, value, FALSE FROM c WHERE result IS NULL""")
def so3(spark, sf):
    kept, dropped = L.clean_list(rows(spark, sf, "lines"), *maps(spark, sf))
    return kept.withColumn("kept", F.lit(True)).unionByName(dropped.withColumn("kept", F.lit(False)))


@query("sc7_a10_creator_map", cte("creator_map") + "SELECT channel_id, arg_max(handle, seq) AS handle FROM creator_map GROUP BY 1")
def sc7(spark, sf):
    return L.latest(rows(spark, sf, "creator_map"), "channel_id", "handle")


_P = """, p AS (SELECT pos, CASE pos % 14 WHEN 0 THEN value WHEN 1 THEN value WHEN 2 THEN substr(value, 2) WHEN 3 THEN 'Chan' || CAST(pos % 97 AS VARCHAR) WHEN 4 THEN 'Chan' || CAST(pos % 97 AS VARCHAR)
    WHEN 5 THEN 'chan' || CAST(pos % 97 AS VARCHAR) WHEN 11 THEN 'Tab' || CAST(pos % 97 AS VARCHAR) END AS h, CASE WHEN pos % 14 IN (6, 7, 10, 13) THEN 'UC' || lpad(CAST(pos % 97 AS VARCHAR), 22, '0') END AS cid FROM lines),
    r AS (SELECT pos, coalesce(h, cm.handle) AS handle, CASE WHEN coalesce(h, cm.handle) IS NULL THEN cid END AS channel_id FROM p LEFT JOIN cm ON cm.channel_id = cid WHERE h IS NOT NULL OR cid IS NOT NULL)"""
RESOLVED = cte("lines", "creator_map", "name_map") + MAPS + _P


@query("j25_read_channels", RESOLVED + " SELECT pos, handle, channel_id FROM r")
def j25(spark, sf):
    return L.resolve_handles(rows(spark, sf, "lines"), maps(spark, sf)[0])


@query("j6_unresolved_ids", RESOLVED + " SELECT DISTINCT cid AS channel_id FROM p WHERE cid IS NOT NULL AND cid NOT IN (SELECT channel_id FROM cm WHERE coalesce(handle, '') <> '')")
def j6(spark, sf):
    ids = rows(spark, sf, "lines").select(C.parse_channel_line(F.col("value"))["channel_id"].alias("channel_id")).filter("channel_id is not null").distinct()
    return L.not_in(ids, (maps(spark, sf)[0].filter("handle <> ''"), "channel_id"), on="channel_id")


@query("j7_unscraped_candidates", RESOLVED + """ SELECT DISTINCT handle FROM r WHERE handle IS NOT NULL AND handle NOT IN (SELECT 'Chan' || CAST(s_suppkey % 40 AS VARCHAR) FROM supplier) AND handle NOT IN (SELECT 'Tab' || CAST(s_suppkey % 30 AS VARCHAR) FROM supplier)""")
def j7(spark, sf):
    handles = L.resolve_handles(rows(spark, sf, "lines"), maps(spark, sf)[0]).filter("handle is not null").select("handle").distinct()
    marked = rows(spark, sf, "SELECT 'Chan' || CAST(s_suppkey % 40 AS STRING) AS h FROM {supplier}")
    have = rows(spark, sf, "SELECT 'Tab' || CAST(s_suppkey % 30 AS STRING) AS h FROM {supplier}")
    return L.not_in(handles, (marked, "h"), (have, "h"), on="handle")


@query("j24_select_new", RESOLVED + """, t AS (SELECT handle, min(pos) AS pos FROM r WHERE handle IS NOT NULL GROUP BY 1 ORDER BY 2, 1 LIMIT 60)
    SELECT handle, pos FROM t WHERE handle NOT IN (SELECT 'Chan' || CAST(s_suppkey % 40 AS VARCHAR) FROM supplier) ORDER BY pos, handle LIMIT 25""")
def j24(spark, sf):
    cand = L.resolve_handles(rows(spark, sf, "lines"), maps(spark, sf)[0]).filter("handle is not null").groupBy("handle").agg(F.min("pos").alias("pos"))
    return L.select_new(cand, rows(spark, sf, "SELECT 'Chan' || CAST(s_suppkey % 40 AS STRING) AS handle FROM {supplier}"), 60, 25)


@query("j28_a16_resolution_outcome", cte("creators", "creator_map") + """, cm AS (SELECT channel_id, arg_max(handle, seq) AS handle FROM creator_map GROUP BY 1)
    SELECT creator_id AS channel_id, CASE WHEN cm.handle IS NOT NULL THEN 'already_resolved' WHEN k % 10 = 3 OR k % 4 = 0 OR contains(name, ' ') THEN 'unresolvable' ELSE 'resolved' END AS outcome,
    CASE WHEN cm.handle IS NOT NULL THEN cm.handle WHEN NOT (k % 10 = 3 OR k % 4 = 0 OR contains(name, ' ')) THEN name END AS handle FROM creators LEFT JOIN cm ON cm.channel_id = creator_id""")
def j28(spark, sf):
    c = rows(spark, sf, "creators").withColumnRenamed("creator_id", "channel_id")
    return L.resolution_outcome(c.select("channel_id"), maps(spark, sf)[0], c.filter("k % 10 = 3"), c.select("channel_id", F.when(F.col("k") % 4 == 0, "").otherwise(F.col("name")).alias("handle")))


@query("so5_handle_set", cte("creator_map") + "SELECT DISTINCT lower(ltrim(handle, '@')) AS handle FROM creator_map")
def so5(spark, sf):
    return L.handle_set(rows(spark, sf, "creator_map"))


@query("pf24_map_rows", cte("lines") + f""", d AS (SELECT pos, 'Chan' || CAST(pos % 97 AS VARCHAR) AS h FROM lines) SELECT 'UC' || lpad(CAST(pos AS VARCHAR), 22, '0') AS channel_id, h AS value, 'handle' AS kind FROM d WHERE pos % 3 <> 0
    UNION ALL SELECT 'UC' || lpad(CAST(pos AS VARCHAR), 22, '0'), 'Title ' || CAST(pos AS VARCHAR), 'title' FROM d WHERE pos % 5 <> 0""")
def pf24(spark, sf):
    d = rows(spark, sf, """SELECT CASE WHEN c_custkey % 3 = 0 THEN 'channel/UC' || lpad(CAST(c_custkey AS STRING), 22, '0') ELSE 'Chan' || CAST(c_custkey % 97 AS STRING) END AS channel,
        'UC' || lpad(CAST(c_custkey AS STRING), 22, '0') AS channel_id, CASE WHEN c_custkey % 5 <> 0 THEN 'Title ' || CAST(c_custkey AS STRING) END AS channel_title FROM {customer}""")
    handles, titles = L.map_rows(d)
    return handles.select("channel_id", F.col("handle").alias("value"), F.lit("handle").alias("kind")).unionByName(titles.select("channel_id", F.col("title").alias("value"), F.lit("title").alias("kind")))


@query("sk2_sk3_map_upsert", cte("creator_map") + """, u AS (SELECT *, 1 AS nw FROM creator_map WHERE seq % 3 = 0 UNION ALL SELECT *, 0 FROM creator_map WHERE seq % 3 <> 0)
    SELECT channel_id, handle, seq FROM (SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY nw DESC, seq DESC) AS n FROM u) WHERE n = 1""")
def sk2(spark, sf):
    m = rows(spark, sf, "creator_map")
    return L.upsert(m.filter("seq % 3 <> 0"), m.filter("seq % 3 = 0"), "channel_id")


@query("sk2_sk3_kept_map", cte("creator_map") + """, l AS (SELECT channel_id, arg_max(handle, seq) AS handle, max(seq) AS seq FROM creator_map GROUP BY 1)
    SELECT channel_id, coalesce(l.handle, '') AS handle, coalesce(l.seq, 0) AS seq, l.seq IS NOT NULL AS member FROM (SELECT DISTINCT 'UC' || lpad(CAST(c_custkey % 90 AS VARCHAR), 22, '0') AS channel_id FROM customer) LEFT JOIN l USING (channel_id)""")
def sk2_kept(spark, sf):
    table, m = KeptTable(spark, scratch(spark, "creator-map"), "channel_id string, handle string, seq bigint", "channel_id", 8), rows(spark, sf, "creator_map")
    for part in range(2):  # batches in the order of the log
        table.put_many(m.filter(F.col("seq") % 2 == part) if part == 0 else m, "seq")
    asked = rows(spark, sf, "SELECT DISTINCT 'UC' || lpad(CAST(c_custkey % 90 AS STRING), 22, '0') AS channel_id FROM {customer}")
    known = table.rows()
    return table.contains(asked).join(known, "channel_id", "left").select("channel_id", F.coalesce("handle", F.lit("")).alias("handle"), F.coalesce("seq", F.lit(0)).alias("seq"), "member")


@query("sk4_membership", cte("creators", "creator_map") + "SELECT creator_id AS channel_id, creator_id IN (SELECT channel_id FROM creator_map) AS member FROM creators")
def sk4(spark, sf):
    return L.membership(rows(spark, sf, "creators").select(F.col("creator_id").alias("channel_id")), rows(spark, sf, "creator_map"), "channel_id")


@query("sc11_known_channels", cte("lines") + r""", r AS (SELECT CASE WHEN starts_with(value, '{') THEN json_extract_string(value, '$.channel') WHEN contains(value, chr(9)) THEN split_part(value, chr(9), 2) ELSE value END AS raw FROM lines),
    b AS (SELECT lower(regexp_replace(split_part(trim(raw), ',', 1), '^(https?://(www\.)?youtube\.com/)?@?', '')) AS channel FROM r)
    SELECT DISTINCT channel FROM b WHERE channel <> '' AND NOT contains(channel, '@') AND NOT contains(channel, '#')""")
def sc11(spark, sf):
    from ..sources.scans import known_channels

    return known_channels(rows(spark, sf, "lines"))


@query("sc17_mixed_ids", RESOLVED + " SELECT DISTINCT cid AS channel_id FROM p WHERE cid IS NOT NULL UNION SELECT 'UC' || lpad(CAST(c_custkey AS VARCHAR), 22, '0') FROM customer WHERE c_custkey % 4 = 0")
def sc17(spark, sf):
    from ..sources.scans import channel_ids

    jsonl = rows(spark, sf, "SELECT '{{\"channel_id\":\"UC' || lpad(CAST(c_custkey AS STRING), 22, '0') || '\"}}' AS value FROM {customer} WHERE c_custkey % 4 = 0")
    return channel_ids(rows(spark, sf, "lines"), jsonl)


@query("j26_country_lookup", """SELECT c_custkey, n_regionkey AS code FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""")
def j26(spark, sf):
    c = rows(spark, sf, "SELECT c_custkey, n_name AS country FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey")
    dim = rows(spark, sf, "SELECT upper(n_name) AS country_name, n_regionkey AS code FROM {nation}")
    return L.label_lookup(c, dim, F.col("country"), "country_name").select("c_custkey", "code")


@query("j25_read_channels_whole", BASE + """, p AS (SELECT pos, CASE pos % 14 WHEN 0 THEN value WHEN 1 THEN value WHEN 2 THEN substr(value, 2) WHEN 3 THEN 'Chan' || CAST(pos % 97 AS VARCHAR) WHEN 4 THEN 'Chan' || CAST(pos % 97 AS VARCHAR) WHEN 5 THEN 'chan' || CAST(pos % 97 AS VARCHAR)
        WHEN 11 THEN 'Tab' || CAST(pos % 97 AS VARCHAR) END AS h, CASE WHEN pos % 14 IN (6, 7, 10, 13) THEN 'UC' || lpad(CAST(pos % 97 AS VARCHAR), 22, '0') END AS cid FROM (SELECT b.pos AS first, l.pos, l.value FROM d1 b JOIN lines l ON l.value = b.value WHERE b.n = 1 QUALIFY row_number() OVER (PARTITION BY b.pos ORDER BY l.pos) = 1)),
    q AS (SELECT first, coalesce(h, cm.handle) AS handle, cid FROM (SELECT p.*, b.pos AS first FROM p JOIN lines l ON l.pos = p.pos JOIN d1 b ON b.n = 1 AND b.value = l.value) p LEFT JOIN cm ON cm.channel_id = cid WHERE h IS NOT NULL OR cid IS NOT NULL),
    e AS (SELECT handle, first FROM q WHERE handle IS NOT NULL UNION ALL SELECT 'New' || CAST(CAST(substr(cid, 3) AS INT) AS VARCHAR), first FROM q WHERE handle IS NULL AND CAST(substr(cid, 3) AS INT) % 5 <> 0 AND CAST(substr(cid, 3) AS INT) % 3 <> 0),
    f AS (SELECT handle, min(first) AS pos FROM e GROUP BY 1), s AS (SELECT * FROM f WHERE handle NOT IN (SELECT 'Tab' || CAST(s_suppkey % 30 AS VARCHAR) FROM supplier) ORDER BY pos, handle LIMIT 90)
    SELECT handle, pos FROM s WHERE handle NOT IN (SELECT 'Chan' || CAST(s_suppkey % 40 AS VARCHAR) FROM supplier) ORDER BY pos, handle LIMIT 60""")
def j25w(spark, sf):
    number = "CAST(n AS STRING)"
    ids = "(SELECT DISTINCT c_custkey % 97 AS n FROM {customer})"
    resolved = rows(spark, sf, f"SELECT 'UC' || lpad({number}, 22, '0') AS channel_id, CASE WHEN n % 3 = 0 THEN 'two words' ELSE 'New' || {number} END AS handle FROM {ids}")
    marked = rows(spark, sf, f"SELECT 'UC' || lpad({number}, 22, '0') AS channel_id FROM {ids} WHERE n % 5 = 0")
    scraped = rows(spark, sf, "SELECT DISTINCT 'Tab' || CAST(s_suppkey % 30 AS STRING) AS handle FROM {supplier}")
    known = rows(spark, sf, "SELECT DISTINCT 'Chan' || CAST(s_suppkey % 40 AS STRING) AS handle FROM {supplier}")
    return L.read_channels(rows(spark, sf, "lines"), maps(spark, sf)[0], resolved, marked, scraped, known, 60, 1_000_000, 90)


@query("j14_new_videos", """SELECT o_orderkey AS video_id FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 5) AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0)""")
def j14(spark, sf):
    entries = rows(spark, sf, "SELECT o_orderkey AS video_id FROM {orders}")
    server = rows(spark, sf, "SELECT o_orderkey AS video_id, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 3 = 0 END AS exists FROM {orders}")
    return L.new_videos(entries, rows(spark, sf, "SELECT l_orderkey AS video_id FROM {lineitem} WHERE l_linenumber = 5"), server)


@query("tk2_capped_resolution", "SELECT least(n, 40) AS taken, n - least(n, 40) AS deferred, least(n, 40) AS again FROM (SELECT count(DISTINCT c_name) AS n FROM customer)")
def tk2(spark, sf):
    ids = rows(spark, sf, "SELECT DISTINCT c_name AS id FROM {customer}")
    taken = L.capped(ids, 40, 7, "id")
    marked = ids.join(taken.withColumn("t", F.lit(1)), "id", "left").join(L.capped(ids, 40, 7, "id").withColumn("u", F.lit(1)), "id", "left")
    return marked.agg(F.count("t").alias("taken"), F.count_if(F.col("t").isNull()).alias("deferred"), F.count_if(F.col("t").isNotNull() & F.col("u").isNotNull()).alias("again"))


@query("sk5_map_export", cte("creator_map") + "SELECT channel_id, arg_max(handle, seq) AS handle FROM creator_map GROUP BY 1")
def sk5(spark, sf):
    from ..sources.scans import creator_map_lines, read_lines
    from ..sources.sinks import export_map

    path = scratch(spark, "map-export")
    export_map(maps(spark, sf)[0], path)
    return creator_map_lines(read_lines(spark, path))


@query("sk10_dropped_entries", BASE + "SELECT value, 2 AS n FROM c WHERE result IS NULL")
def sk10(spark, sf):
    from ..sources.sinks import append_dropped

    path = scratch(spark, "dropped")
    dropped = L.clean_list(rows(spark, sf, "lines"), *maps(spark, sf))[1]
    append_dropped(dropped, path)
    append_dropped(dropped, path)
    return spark.read.text(path).groupBy("value").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("sk13_rewritten_list", cte("lines") + ENTRIES + DEDUPED + """, f AS (SELECT min(pos) AS p FROM lines WHERE NOT starts_with(trim(value), '#')), o AS (SELECT 0 AS part, pos, value FROM lines, f WHERE pos < p UNION ALL SELECT 1, pos, value FROM d1 WHERE n = 1)
    SELECT CAST(row_number() OVER (ORDER BY part, pos) - 1 AS BIGINT) AS pos, value FROM o""")
def sk13(spark, sf):
    from ..sources.scans import read_lines
    from ..sources.sinks import rewrite_list

    path = scratch(spark, "list")
    header, entries = L.split_header(rows(spark, sf, "lines"))
    rewrite_list(header, L.dedupe_preserving_case(entries), entries.count(), path)
    return read_lines(spark, path)


@query("sc14_had_feed_ids", "SELECT DISTINCT 'UC' || CAST(c_nationkey AS VARCHAR) AS id FROM customer")
def sc14(spark, sf):
    from ..sources.scans import id_lines

    return id_lines(rows(spark, sf, "SELECT CASE WHEN c_custkey % 9 = 0 THEN '  ' ELSE concat('UC', CAST(c_nationkey AS STRING), CASE WHEN c_custkey % 2 = 0 THEN ' ' ELSE '' END) END AS value FROM {customer}"))
