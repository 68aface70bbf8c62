"""Asset queries: order lines play the versions of a file."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assets as A
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


def both(spark, sf):
    a = rows(spark, sf, "assets")
    return a.filter("dir = 'base'"), a.filter("dir = 'uploaded'")


BASE = cte("assets") + ", b AS (SELECT * FROM assets WHERE dir = 'base'), u AS (SELECT * FROM assets WHERE dir = 'uploaded') "
COLS = "ident, dir, prefix_rank, prefix, mtime, line"


@query("j8_superseded", BASE + f"SELECT {COLS} FROM b WHERE EXISTS (SELECT 1 FROM u WHERE u.ident = b.ident AND u.prefix_rank >= b.prefix_rank AND u.mtime >= b.mtime)")
def j8(spark, sf):
    return A.superseded(*both(spark, sf))


@query("j9_newer_uploaded", BASE + f"SELECT {COLS} FROM b WHERE EXISTS (SELECT 1 FROM u WHERE u.ident = b.ident AND u.prefix_rank = b.prefix_rank AND u.mtime > b.mtime)")
def j9(spark, sf):
    return A.newer_uploaded(*both(spark, sf))


@query("j10_min_without_full", BASE + f"SELECT {COLS} FROM b WHERE prefix_rank = 0 AND ident NOT IN (SELECT ident FROM assets WHERE prefix_rank = 1)")
def j10(spark, sf):
    base, up = both(spark, sf)
    return A.without_higher(base.filter("prefix_rank = 0"), base.unionByName(up), 1)


@query("j11_j15_promote_markers", cte("assets") + "SELECT CAST(o_orderkey + o_orderkey % 2 * 100000000 AS VARCHAR) AS ident, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 'redundant' ELSE 'promoted' END AS outcome FROM orders")
def j11(spark, sf):
    return A.promote_bare(rows(spark, sf, "SELECT CAST(o_orderkey + o_orderkey % 2 * 100000000 AS STRING) AS ident FROM {orders}"), rows(spark, sf, "assets"))


@query("a7_best_status", cte("assets") + """SELECT ident, CASE WHEN bool_or(dir = 'uploaded') THEN 'UPLOADED' ELSE 'SCRAPED' END AS status,
    coalesce(max(mtime) FILTER (dir = 'uploaded'), max(mtime)) AS mtime FROM assets GROUP BY 1""")
def a7(spark, sf):
    return A.best_status(rows(spark, sf, "assets"))


_STALE = BASE + ", best AS (SELECT ident, max(prefix_rank) AS r FROM assets GROUP BY 1), bm AS (SELECT a.ident, max(mtime) AS m, max(r) AS r FROM assets a JOIN best ON a.ident = best.ident AND prefix_rank = r GROUP BY 1) "


@query("a8_stale_lower_ranked", _STALE + f"SELECT a.ident, {COLS.replace('ident, ', '')} FROM assets a JOIN bm ON a.ident = bm.ident WHERE prefix_rank < r AND mtime < m")
def a8(spark, sf):
    return A.stale_lower(rows(spark, sf, "assets"))


@query("sk12_cleanup_after_write", _STALE + f"SELECT a.ident, {COLS.replace('ident, ', '')} FROM assets a JOIN bm ON a.ident = bm.ident WHERE prefix_rank <= r AND mtime < m")
def sk12(spark, sf):
    return A.stale_lower(rows(spark, sf, "assets"), or_equal_rank=True)


_WORK = BASE + """, hi AS (SELECT DISTINCT ident FROM assets WHERE prefix_rank = 1),
    w AS (SELECT *, 'base_low' AS origin FROM b WHERE prefix_rank = 0 AND ident NOT IN (SELECT ident FROM hi) UNION ALL SELECT *, 'base_high' FROM b WHERE prefix_rank = 1),
    work AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.ident = w.ident AND u.prefix_rank >= w.prefix_rank AND u.mtime >= w.mtime)
        UNION ALL SELECT *, 'uploaded_low' FROM u WHERE prefix_rank = 0 AND ident NOT IN (SELECT ident FROM hi)) """


@query("so1_workload", _WORK + f"SELECT {COLS}, origin FROM work")
def so1(spark, sf):
    return A.workload(*both(spark, sf))


@query("tk1_priority_first", _WORK + ", g AS (SELECT ident, bool_or(CAST(ident AS BIGINT) % 50 = 1) AS priority FROM work GROUP BY 1) SELECT ident, priority, CASE WHEN priority THEN row_number() OVER (PARTITION BY priority ORDER BY ident) END AS place FROM g")
def tk1(spark, sf):
    from pyspark.sql import Window

    ids = A.workload(*both(spark, sf)).select("ident").distinct().withColumn("priority", F.col("ident").cast("bigint") % 50 == 1)
    place = F.row_number().over(Window.partitionBy("priority").orderBy("ident"))
    front = ids.filter("priority").withColumn("place", place)
    return A.ordered_work(front.unionByName(ids.filter("not priority").withColumn("place", F.lit(None).cast("int"))), F.col("priority"), "ident", 7)


_NAMES = """SELECT l_orderkey AS k, l_linenumber AS n, CASE l_linenumber % 6 WHEN 0 THEN 'video-min-' || CAST(l_orderkey AS STRING) || '.json.br' WHEN 1 THEN 'video-dlp-' || CAST(l_orderkey AS STRING) || '.json.br'
    WHEN 2 THEN 'channel-' || CAST(l_orderkey AS STRING) || '.json.br.failed' WHEN 3 THEN lpad(CAST(l_orderkey AS STRING), 11, 'a') WHEN 4 THEN 'video-' || CAST(l_orderkey AS STRING) || '.json.br' ELSE 'x.not_found' END AS name FROM {lineitem}"""


@query("pf5_pf7_asset_names", "WITH i AS (" + _NAMES.replace("{lineitem}", "lineitem") + """) SELECT k, n, regexp_matches(name, '\\.(failed|not_found|unresolved|unavailable|invalid)$') AS marker,
    CASE n % 6 WHEN 0 THEN 'video-min-' WHEN 1 THEN 'video-dlp-' WHEN 2 THEN 'channel-' WHEN 4 THEN 'video-' END AS prefix, CASE WHEN n % 6 IN (0, 1, 2, 4) THEN CAST(k AS VARCHAR) END AS ident,
    CASE WHEN n % 6 < 2 THEN n % 6 = 0 END AS needs_scraping, n % 6 = 3 AS bare FROM i""")
def pf5(spark, sf):
    name = F.col("name")
    return rows(spark, sf, _NAMES).select("k", "n", A.is_marker(name).alias("marker"), A.name_parts(name, ("video-", "video-min-", "video-dlp-", "channel-")).alias("p"),
        A.work_entry(name)["needs_scraping"].alias("needs_scraping"), A.is_bare_id(name).alias("bare")).select("k", "n", "marker", "p.prefix", "p.ident", "needs_scraping", "bare")


_STATE = """SELECT o_orderkey AS k, o_orderkey % 3 = 0 AS failed, CASE WHEN o_orderkey % 4 = 0 THEN CAST(5 AS BIGINT) END AS up_mtime, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 10 END AS base_mtime, CAST(6 AS BIGINT) AS mark_mtime,
    o_orderkey % 7 = 0 AS superseded, o_orderkey % 2 = 0 AS reupload, CASE o_orderkey % 3 WHEN 0 THEN 'priority' WHEN 1 THEN 'uploaded' ELSE 'base' END AS origin FROM {orders}"""


@query("pf9_pf10_pf25_actions", "WITH i AS (" + _STATE.replace("{orders}", "orders") + """), s AS (SELECT *, up_mtime IS NOT NULL OR coalesce(base_mtime > mark_mtime, FALSE) AS stale FROM i)
    SELECT k, stale, CASE WHEN failed AND NOT stale THEN 'skip_failed' WHEN superseded AND NOT reupload THEN 'skip_superseded' WHEN up_mtime IS NOT NULL AND NOT reupload THEN 'skip_uploaded'
    WHEN up_mtime IS NOT NULL THEN 'reupload' ELSE 'process' END AS action, CASE origin WHEN 'priority' THEN 'keep' WHEN 'uploaded' THEN 'delete' ELSE 'mark_failed' END AS retire FROM s""")
def pf9(spark, sf):
    i = rows(spark, sf, _STATE).withColumn("stale", A.failure_is_stale(F.col("mark_mtime"), F.col("up_mtime"), F.col("base_mtime")))
    return i.select("k", "stale", A.skip_action(F.col("failed"), F.col("stale"), F.col("up_mtime").isNotNull(), F.col("superseded"), F.col("reupload")).alias("action"), A.retire_action(F.col("origin")).alias("retire"))


@query("sk7_current_status", "SELECT l_orderkey AS ident, arg_max(l_returnflag, struct_pack(a := l_shipdate, b := l_returnflag)) AS status FROM lineitem GROUP BY 1")
def sk7(spark, sf):
    return A.current_status(rows(spark, sf, "SELECT l_orderkey AS ident, l_shipdate AS ts, l_returnflag AS status FROM {lineitem}"))


_MARKS = """SELECT CAST(l_orderkey AS STRING) AS ident, CASE l_linenumber % 4 WHEN 0 THEN 'uploaded' WHEN 1 THEN 'failed' WHEN 2 THEN 'not_found' ELSE 'odd' END AS status, CASE WHEN l_linenumber % 2 = 1 THEN l_returnflag END AS reason, CAST(l_partkey % 50 AS BIGINT) AS `at`, l_linenumber AS line FROM {lineitem}"""


@query("sk7_marked_assets", f"""SELECT ident, status, reason, "at" FROM ({_MARKS.replace("{lineitem}", "lineitem").replace("`", '"')}) WHERE status <> 'odd' QUALIFY row_number() OVER (PARTITION BY ident ORDER BY "at" DESC, status DESC, reason DESC NULLS LAST) = 1""")
def sk7_marked(spark, sf):
    table, marks = KeptTable(spark, scratch(spark, "marks"), A.MARKS, "ident", 16), rows(spark, sf, _MARKS)
    for part in range(3):
        A.mark(table, marks.filter(F.col("line") % 3 == part))
    return table.rows()


@query("sc2_sc5_incremental_listing", cte("assets") + f"SELECT {COLS} FROM assets WHERE mtime > 60 AND starts_with(prefix, 'video-dlp')")
def sc2(spark, sf):
    from ..sources.scans import changed_since

    return changed_since(rows(spark, sf, "assets").filter(F.col("prefix").startswith("video-dlp")), 60)


@query("sc2_listing_by_executors", "SELECT 'brand=' || replace(p_brand, '#', '%23') || '/size=' || p_size AS folder, 1 AS files, TRUE AS new FROM part WHERE p_size % 5 = 2 GROUP BY p_brand, p_size")
def sc2_listing(spark, sf):
    from ..sources.listing import FileListing

    root = scratch(spark, "listed")
    parts = rows(spark, sf, "SELECT p_partkey, p_brand AS brand, p_size AS size FROM {part} WHERE p_size % 5 = 2")
    parts.repartition("brand", "size").write.partitionBy("brand", "size").parquet(root)
    spark.dataSource.register(FileListing)
    found = spark.read.format("file_listing").option("path", root).option("levels", 2).load().filter(F.col("name").startswith("part-"))
    folder = F.replace(F.regexp_extract("path", "(brand=[^/]+/size=[^/]+)/[^/]+$", 1), F.lit("#"), F.lit("%23"))
    return found.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).cast("int").alias("files"), F.bool_and(F.col("mtime") > 0).alias("new"))


@query("j15_existing_artefact", """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'video-min-' || id || '.json.br' WHEN 1 THEN 'video-dlp-' || id || '.json.br' ELSE id END AS artefact FROM (SELECT p_partkey, 'v' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS id FROM part) WHERE p_partkey % 4 < 3""")
def j15(spark, sf):
    ids = rows(spark, sf, "SELECT p_partkey, 'v' || lpad(CAST(p_partkey AS STRING), 10, '0') AS video_id FROM {part}")
    name = F.concat(F.lit("video-dlp-"), "video_id", F.lit(".json.br"))
    k = F.col("p_partkey") % 4
    files = ids.filter(k == 0).select(F.concat(F.lit("video-min-"), "video_id", F.lit(".json.br")).alias("name")).unionByName(ids.filter(k < 2).select(name.alias("name"))).unionByName(ids.filter(k < 3).select(F.col("video_id").alias("name")))
    return A.existing_artefact(ids, files.unionByName(ids.select(F.lit("notes.txt").alias("name")))).join(ids, "video_id").select("p_partkey", "artefact")


@query("st2_fresh_assets", cte("assets") + """SELECT ident, dir, prefix_rank, mtime, line FROM assets a WHERE dir = 'base' AND NOT EXISTS (SELECT 1 FROM assets u WHERE u.dir = 'uploaded' AND u.ident = a.ident AND u.prefix_rank >= a.prefix_rank AND u.mtime >= a.mtime)""")
def st2(spark, sf):
    a = rows(spark, sf, "assets")
    return A.fresh(a.filter("dir = 'base'"), a.filter("dir = 'uploaded'")).select("ident", "dir", "prefix_rank", "mtime", "line")
