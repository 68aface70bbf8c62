"""Import and record queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import imports as I
from ..operators import lists as L
from ..operators import records as R
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


_V = cte("third_party") + """, v AS (SELECT trim("videoId") AS video_id, nullif(trim(video_title), '') AS title, CAST(trunc(TRY_CAST(views AS DOUBLE)) AS BIGINT) AS view_count, CAST(likes AS BIGINT) AS like_count,
    list_distinct(list_filter(list_transform(string_split(CASE WHEN tags <> '[None]' THEN tags END, '|'), lambda x: trim(x)), lambda x: x <> '')) AS tags,
    CASE lower(kind) WHEN 'shorts' THEN 'short' WHEN 'video' THEN 'video' END AS media_type, epoch(TIMESTAMP '2024-06-15 10:30:00')::BIGINT AS published, description, slug, channel FROM third_party WHERE trim("videoId") <> '') """


@query("pf1_pf2_to_videos", _V + "SELECT video_id, title, view_count, like_count, coalesce(list_sort(tags), []) AS tags, media_type, published, 'https://www.youtube.com/watch?v=' || video_id AS url FROM v")
def pf2(spark, sf):
    v = I.to_videos(rows(spark, sf, "third_party"))
    return v.select("video_id", "title", "view_count", "like_count", F.array_sort("tags").alias("tags"), "media_type", F.unix_seconds("published").alias("published"), "url")


@query("pf3_a11_first_seen_channels", cte("third_party") + """, c AS (SELECT ltrim(channel, '@') AS key, slug, video_title FROM third_party)
    SELECT key, arg_min(video_title, struct_pack(a := slug, b := video_title)) AS title, arg_min(slug, struct_pack(a := slug, b := video_title)) AS slug FROM c GROUP BY 1""")
def pf3(spark, sf):
    c = I.to_channels(rows(spark, sf, "third_party"), ("slug", "video_title"))
    return I.first_seen(c, "slug", "video_title").select("key", F.col("video_title").alias("title"), "slug")


@query("pf4_sk11_completeness", """SELECT doc_id, CASE WHEN length(text) > 400 AND quality = 1 AND lang <> 'es' THEN CASE WHEN n_chars % 2 = 0 THEN 'video-dlp' ELSE 'video-min' END END AS class
    FROM documents LEFT JOIN labels USING (doc_id)""")
def pf4(spark, sf):
    d = rows(spark, sf, "SELECT d.*, l.quality FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id")
    some = lambda c: F.when(c, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    v = d.select("doc_id", F.when(F.length("text") > 400, "t").alias("title"), some(F.col("quality") == 1).alias("thumbnails"), F.when(F.col("lang") != "es", "h").alias("channel_handle"), F.lit(None).cast("string").alias("channel_id"),
        F.lit(1).alias("view_count"), F.lit(0).alias("like_count"), F.lit("u").alias("url"), F.lit("e").alias("embed_url"), F.lit("d").alias("description"), some(F.lit(True)).alias("keywords"), some(F.lit(True)).alias("tags"), some(F.col("n_chars") % 2 == 0).alias("formats"))
    return v.select("doc_id", I.completeness(F.col("formats")).alias("class"))


@query("a3_import_statistics", _V + """SELECT slug, count(*) AS n, count(*) FILTER (media_type = 'short') AS short, count(*) FILTER (media_type = 'video') AS video FROM v GROUP BY ROLLUP (slug)""")
def a3(spark, sf):
    return I.import_statistics(I.to_videos(rows(spark, sf, "third_party"), keep=("slug",)), "slug", "media_type", ("short", "video"))


_UP = """SELECT c_custkey AS k, CASE WHEN c_custkey % 3 <> 0 THEN 'UC' || lpad(CAST(c_custkey % 90 AS STRING), 22, '0') END AS channel_id, CASE WHEN c_custkey % 6 <> 0 THEN ' @' || c_name END AS channel_handle FROM {customer}"""
_UPS = cte("creator_map") + f""", cm AS (SELECT channel_id, arg_max(handle, seq) AS handle FROM creator_map GROUP BY 1), u AS ({_UP.replace('{customer}', 'customer')}),
    r AS (SELECT k, u.channel_id, CASE WHEN handle IS NOT NULL THEN 'hit' WHEN u.channel_id IS NULL AND channel_handle IS NOT NULL THEN 'fallback' WHEN u.channel_id IS NULL THEN 'error' ELSE 'miss' END AS outcome,
        coalesce(handle, CASE WHEN u.channel_id IS NULL THEN lower(ltrim(trim(channel_handle), '@')) END) AS upload_handle FROM u LEFT JOIN cm ON cm.channel_id = u.channel_id) """


def _handles(spark, sf):
    return R.upload_handle(rows(spark, sf, _UP), L.latest(rows(spark, sf, "creator_map"), "channel_id", "handle"))


@query("j3_upload_handle", _UPS + "SELECT k, outcome, upload_handle FROM r")
def j3(spark, sf):
    return _handles(spark, sf).select("k", "outcome", "upload_handle")


@query("a15_a21_outcome_counts", _UPS + "SELECT outcome, count(*) AS n FROM r GROUP BY 1")
def a21(spark, sf):
    return R.outcome_counts(_handles(spark, sf), "outcome")


_BATCH = """SELECT o_orderkey AS idx, 'v' || CAST(o_orderkey AS STRING) AS content_id, 'f' || CAST(o_orderkey AS STRING) AS file, CAST(o_orderkey % 9 AS INT) AS batch FROM {orders}"""
_RESULT = """SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'v' || CAST(o_orderkey AS STRING) END AS platform_content_id, CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey END AS record_index,
    CASE WHEN o_orderkey % 5 = 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN o_orderkey % 5 = 0 THEN 'bad' END AS reason FROM {orders} WHERE o_orderkey % 7 <> 0"""
_REC = f"""WITH b AS ({_BATCH.replace('{orders}', 'orders')}), r AS (SELECT idx, content_id, file, batch, CASE WHEN idx % 7 = 0 THEN 'missing' WHEN idx % 5 = 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN idx % 7 <> 0 AND idx % 5 = 0 THEN 'bad' END AS reason FROM b) """


@query("j13_reconcile", _REC + "SELECT idx, content_id, file, status, reason FROM r")
def j13(spark, sf):
    return R.reconcile(rows(spark, sf, _BATCH), rows(spark, sf, _RESULT))


@query("a17_batch_outcomes", _REC + "SELECT batch, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'missing') AS missing FROM r GROUP BY 1")
def a17(spark, sf):
    b = rows(spark, sf, _BATCH)
    return R.batch_outcomes(R.reconcile(b, rows(spark, sf, _RESULT)).join(b.select("idx", "batch"), "idx"))


@query("sk6_pack_batches", """WITH RECURSIVE s AS (SELECT doc_id, CAST(doc_id % 8 AS INT) AS shard, CAST(strlen(text) + 1 AS BIGINT) AS bytes, row_number() OVER (PARTITION BY doc_id % 8 ORDER BY doc_id) AS n FROM documents WHERE strlen(text) + 1 <= 200000),
    r AS (SELECT doc_id, shard, bytes, n, 0 AS batch, 1 AS records, bytes AS size FROM s WHERE n = 1 UNION ALL SELECT s.doc_id, s.shard, s.bytes, s.n, CASE WHEN ends THEN batch + 1 ELSE batch END, CASE WHEN ends THEN 1 ELSE records + 1 END, CASE WHEN ends THEN s.bytes ELSE size + s.bytes END
        FROM r JOIN s ON s.shard = r.shard AND s.n = r.n + 1, LATERAL (SELECT records >= 100 OR size + s.bytes > 200000 AS ends))
    SELECT doc_id, shard, batch, bytes FROM r""")
def sk6(spark, sf):
    return R.pack_batches(rows(spark, sf, "SELECT doc_id, text AS line FROM {documents}"), 8, 100, 200_000, "doc_id", "doc_id", "line", F.pmod("doc_id", F.lit(8)))


@query("pf11_delete_matching", "SELECT doc_id, lang, source FROM documents WHERE NOT (lang = 'fr' AND source = 'src3')")
def pf11(spark, sf):
    return R.delete_matching(rows(spark, sf, "SELECT doc_id, lang, source FROM {documents}"), {"lang": "fr", "source": "src3", "doc_id": None}, "doc_id", 100_000_000)


_SKIP = """SELECT l_orderkey AS k, l_linenumber AS n, l_partkey % 2 = 0 AS name_ok, l_partkey % 3 <> 0 AS read_ok, CASE WHEN l_partkey % 5 <> 0 THEN 'h' END AS handle, CASE WHEN l_partkey % 7 <> 0 THEN 'v' END AS vid,
    CASE WHEN l_partkey % 11 = 0 THEN 'e' END AS err, l_partkey % 13 = 0 AS sup FROM {lineitem}"""


@query("pf14_pf15_skip_reasons", f"""WITH i AS ({_SKIP.replace('{lineitem}', 'lineitem')}) SELECT CASE WHEN NOT name_ok THEN 'unrecognised_filename' WHEN NOT read_ok THEN 'read_failed' WHEN handle IS NULL THEN 'no_handle'
    WHEN vid IS NULL THEN 'missing_video_id' WHEN err IS NOT NULL THEN 'schema_invalid' WHEN sup THEN 'superseded' END AS reason, count(*) AS n FROM i GROUP BY 1""")
def pf14(spark, sf):
    c = F.col
    return R.outcome_counts(rows(spark, sf, _SKIP).select(R.skip_reason(c("name_ok"), c("read_ok"), c("handle"), c("vid"), c("err"), c("sup")).alias("reason")), "reason")


@query("j27_network_of", """SELECT k, CASE WHEN ip IS NULL THEN 'none' WHEN k % 250 < 64 THEN '10.0.0.0/26' WHEN k % 250 < 128 THEN '10.0.0.0/25' ELSE 'other' END AS network
    FROM (SELECT event_id AS k, CASE WHEN event_id % 9 <> 0 THEN '10.0.0.' || CAST(event_id % 250 AS VARCHAR) END AS ip FROM events)""")
def j27(spark, sf):
    return R.network_of(rows(spark, sf, "SELECT event_id AS k, CASE WHEN event_id % 9 <> 0 THEN '10.0.0.' || CAST(event_id % 250 AS STRING) END AS ip FROM {events}"), "ip", ["10.0.0.0/26", "10.0.0.0/25"]).select("k", "network")


_RANGES = """SELECT o_orderkey AS "order", concat(CAST(1 + o_orderkey * 7 % 223 AS STRING), '.', CAST(o_custkey % 256 AS STRING), '.', CAST(o_orderkey % 256 AS STRING), '.', CAST(o_orderkey % 200 AS STRING), '/', CAST(8 + o_orderkey % 25 AS STRING)) AS cidr FROM {orders}"""
_ADDRESSES = """SELECT event_id AS k, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'proxy.example' WHEN event_id % 3 = 0 THEN '15.22.2.2'
    ELSE concat(CAST(1 + user_id * 7 % 223 AS STRING), '.', CAST(event_id % 256 AS STRING), '.', CAST(user_id % 256 AS STRING), '.', CAST(event_id % 100 AS STRING)) END AS ip FROM {events}"""
_LONG = "(split_part({0}, '.', 1)::BIGINT * 16777216 + split_part({0}, '.', 2)::BIGINT * 65536 + split_part({0}, '.', 3)::BIGINT * 256 + split_part({0}, '.', 4)::BIGINT)"


@query("j27_many_ranges", f"""WITH r AS (SELECT "order" AS o, split_part(cidr, '/', 2)::INT AS len, {_LONG.format("split_part(cidr, '/', 1)")} AS a FROM ({_RANGES.replace("{orders}", "orders")})),
    n AS (SELECT o, len, a // (1::BIGINT << (32 - len)) * (1::BIGINT << (32 - len)) AS lo FROM r),
    e AS (SELECT *, CASE WHEN ip LIKE '%.%.%.%' THEN {_LONG.format("ip")} END AS a FROM ({_ADDRESSES.replace("{events}", "events")})),
    d AS (SELECT a, arg_min(n.lo, n.o) AS lo, arg_min(n.len, n.o) AS len FROM (SELECT DISTINCT a FROM e WHERE a IS NOT NULL) JOIN n ON a >= lo AND a < lo + (1::BIGINT << (32 - len)) GROUP BY a)
    SELECT k, CASE WHEN ip IS NULL THEN 'none' WHEN lo IS NULL THEN 'other' ELSE concat(lo // 16777216, '.', lo // 65536 % 256, '.', lo // 256 % 256, '.', lo % 256, '/', len) END AS network FROM e LEFT JOIN d ON e.a = d.a""")
def j27_many(spark, sf):
    return R.networks_of(rows(spark, sf, _ADDRESSES), "ip", rows(spark, sf, _RANGES.replace('"order"', "`order`"))).select("k", "network")


@query("j21_j22_existing_records", "SELECT doc_id, doc_id % 3 = 0 AS has_formats FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def j22(spark, sf):
    d = rows(spark, sf, """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '{{"formats":{{"18":1}}}}' WHEN 1 THEN '{{"formats":[]}}' ELSE '{{}}' END AS payload FROM {documents}""")
    return R.existing_records(d, rows(spark, sf, "SELECT doc_id FROM {labels}"), key="doc_id").select("doc_id", R.has_formats(F.col("payload")).alias("has_formats"))


@query("pf16_pf17_pf26_documents", """SELECT p_partkey AS k, '{"p_partkey":' || CAST(p_partkey AS VARCHAR) || ',"title":"' || p_name || '","view_count":' || CAST(CASE WHEN p_partkey % 2 = 0 THEN p_size ELSE 0 END AS VARCHAR) || CASE WHEN p_partkey % 3 = 0 THEN ',"locale":"x"}' ELSE '}' END AS doc FROM part""")
def pf16(spark, sf):
    d = rows(spark, sf, "SELECT p_partkey, p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN p_size END AS view_count, CASE WHEN p_partkey % 3 = 0 THEN 'x' END AS locale FROM {part}")
    return d.select(F.col("p_partkey").alias("k"), R.to_document(d, ("view_count",), ("locale",)).alias("doc"))


@query("sc6_unwrap_envelope", """SELECT k, CASE WHEN k % 4 = 3 THEN NULL ELSE 'UC' || lpad(CAST(k AS VARCHAR), 22, '0') END AS channel_id, CASE k % 4 WHEN 0 THEN 'h' WHEN 1 THEN 'p' WHEN 2 THEN NULL END AS channel_handle,
    CASE k % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'ok' WHEN 2 THEN 'skipped' ELSE 'error' END AS status FROM (SELECT c_custkey AS k FROM customer)""")
def sc6(spark, sf):
    from ..sources.scans import unwrap_envelope

    d = rows(spark, sf, """SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN concat('{{"data":{{"channel_id":"UC', lpad(CAST(c_custkey AS STRING), 22, '0'), '","channel_handle":"@h"}}}}')
        WHEN 1 THEN concat('{{"platform_content_id":"UC', lpad(CAST(c_custkey AS STRING), 22, '0'), '","platform_creator_id":"p"}}') WHEN 2 THEN concat('{{"channel_id":"UC', lpad(CAST(c_custkey AS STRING), 22, '0'), '"}}') ELSE '{{broken' END AS payload FROM {customer}""")
    return unwrap_envelope(d).drop("payload")


@query("sc4_pf22_read_quality", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'empty' WHEN event_id % 5 = 1 THEN 'not a JSON object' WHEN event_id % 5 = 2 THEN 'json parse failed' WHEN event_id % 5 = 3 THEN 'decompress failed' ELSE 'ok' END AS status FROM events")
def sc4(spark, sf):
    from ..sources.scans import read_quality

    d = rows(spark, sf, "SELECT event_id, CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN '[1]' WHEN 2 THEN '{{x' ELSE '{{\"a\":1}}' END AS text, CASE WHEN event_id % 5 = 3 THEN 'failed' ELSE 'ok' END AS codec FROM {events}")
    return read_quality(d, codec_state="codec").select("event_id", "status")


@query("sc9_sc10_discovered_failed", """SELECT 'c' || CAST(c_custkey % 200 AS VARCHAR) AS channel, arg_max(c_custkey, c_custkey) AS subs, bool_or(c_custkey % 3 = 0) AS scraped FROM customer GROUP BY 1""")
def sc9(spark, sf):
    from ..sources.scans import discovered_lines

    return discovered_lines(rows(spark, sf, """SELECT c_custkey AS pos, concat('{{"channel":"c', CAST(c_custkey % 200 AS STRING), '","subs":', CAST(c_custkey AS STRING), ',"source":"', CASE WHEN c_custkey % 3 = 0 THEN 'scrape' ELSE 'link' END, '"}}') AS value FROM {customer}"""))


@query("sc16_page_values", "SELECT 'v' || CAST(o_custkey AS VARCHAR) AS value, min(o_orderkey) AS pos FROM orders GROUP BY 1")
def sc16(spark, sf):
    from ..sources.scans import page_values

    return page_values(rows(spark, sf, "SELECT '@v' || CAST(o_custkey AS STRING) AS value, o_orderkey AS pos FROM {orders}"))


@query("sc19_log_lines", """SELECT event_id AS pos, CASE WHEN event_id % 3 = 0 THEN 'plain ' || event_type ELSE 'INFO:t::f:7:' || event_type || ' user=' || CAST(user_id AS VARCHAR) END AS rendered FROM events""")
def sc19(spark, sf):
    from ..sources.scans import log_lines

    return log_lines(rows(spark, sf, """SELECT event_id AS pos, CASE WHEN event_id % 3 = 0 THEN 'plain ' || event_type ELSE concat('{{"level":"INFO","ts":"t","func":"f","line":7,"msg":"', event_type, '","user":', CAST(user_id AS STRING), '}}') END AS value FROM {events}"""))


@query("sc18_mapping_table", "SELECT 'v' || CAST(s_suppkey AS VARCHAR) AS video_id, CASE WHEN s_suppkey % 2 = 0 THEN 'c' END AS channel_id, s_name AS channel_handle FROM supplier WHERE s_suppkey % 3 <> 0")
def sc18(spark, sf):
    from ..sources.scans import mapping_table

    return mapping_table(rows(spark, sf, """SELECT concat('{{"v', CAST(s_suppkey AS STRING), '":{{"channel_id":', CASE WHEN s_suppkey % 2 = 0 THEN '"c"' ELSE 'null' END, CASE WHEN s_suppkey % 3 <> 0 THEN concat(',"channel_handle":"', s_name, '"') ELSE '' END, '}}}}') AS value FROM {supplier}"""))


_LEGACY = """SELECT s_suppkey AS k, concat('{{"v', CAST(s_suppkey AS STRING), '":{{"channel_id":"c","channel_handle":', CASE WHEN s_suppkey % 3 <> 0 THEN concat('"', s_name, '"') ELSE 'null' END, '}}}}') AS value FROM {supplier}"""


@query("sc18_legacy_import", "SELECT 'v' || CAST(s_suppkey AS VARCHAR) AS video_id, s_name AS channel_handle FROM supplier WHERE s_suppkey % 3 <> 0 AND s_suppkey % 2 = 0")
def sc18_legacy(spark, sf):
    from ..operators import enrich as E

    table, lines = KeptTable(spark, scratch(spark, "legacy"), E.MAPPING, "video_id", 8), rows(spark, sf, _LEGACY)
    E.import_legacy(table, lines.filter("k % 2 = 0"))
    E.import_legacy(table, lines)  # the table holds rows by now
    return table.rows().select("video_id", "channel_handle")


@query("pf15_channel_actions", """WITH i AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 6 = 0 THEN 'delete_superseded' WHEN c_custkey % 6 = 1 THEN 'skip_unreadable' WHEN c_custkey % 6 IN (2, 3) THEN 'skip_no_channel_id' WHEN c_custkey % 6 = 4 THEN 'mark_invalid' ELSE 'send' END AS action FROM customer) SELECT k, action FROM i""")
def pf15(spark, sf):
    d = rows(spark, sf, """SELECT c_custkey AS k, c_custkey % 6 = 0 AS superseded, c_custkey % 6 > 1 AS read_ok, CASE WHEN c_custkey % 6 = 2 THEN '' WHEN c_custkey % 6 > 3 THEN 'UC' END AS id, CASE WHEN c_custkey % 6 < 5 THEN 'bad' END AS error FROM {customer}""")
    return d.select("k", R.channel_action(F.col("superseded"), F.col("read_ok"), F.col("id"), F.col("error")).alias("action"))


_ANNOTATED = """{"properties": {"p_partkey": {"x-scrape-field": "platform_content_id"}, "p_name": {"x-scrape-field": "platform_topic_id"}, "p_brand": {"type": "string"}, "p_type": {"x-scrape-field": "source_url"}}}"""


@query("pf17_annotated_fields", "SELECT p_partkey AS platform_content_id, p_name AS platform_topic_id, p_type AS source_url FROM part")
def pf17(spark, sf):
    return R.annotated(rows(spark, sf, "SELECT * FROM {part}"), _ANNOTATED, "x-scrape-field")


@query("pf26_upload_envelopes", """SELECT p_partkey AS k, 'me|youtube|video|0.0.1|https://x/' || CAST(p_partkey AS VARCHAR) AS head, '{"p_partkey":' || CAST(p_partkey AS VARCHAR) || ',"p_name":"' || p_name || '"}' AS data FROM part WHERE p_partkey % 3 <> 0""")
def pf26(spark, sf):
    d = rows(spark, sf, "SELECT p_partkey, p_name FROM {part}")
    e = R.envelope(d, "me", "youtube", "video", "0.0.1", F.concat(F.lit("https://x/"), "p_partkey"), F.when(F.col("p_partkey") % 3 == 0, "invalid")).select("envelope.*")
    return e.select(F.col("data.p_partkey").alias("k"), F.concat_ws("|", "username", "platform", "entity", "version", "source_url").alias("head"), F.to_json("data").alias("data"))


@query("a12_union_sets", "SELECT p_brand, list_sort(list_distinct(flatten(list([p_type, p_name, 'x'])))) AS values FROM part GROUP BY 1")
def a12(spark, sf):
    d = rows(spark, sf, "SELECT p_brand, array(p_type, p_name) AS keywords, CASE WHEN p_size % 2 = 0 THEN array(p_name, 'x', CAST(NULL AS STRING)) ELSE array('x') END AS tags, CAST(NULL AS ARRAY<STRING>) AS countries FROM {part}")
    return R.union_sets(d, "p_brand", "keywords", "tags", "countries")


@query("tk5_first_rows", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def tk5(spark, sf):
    return R.first_rows(rows(spark, sf, "SELECT o_orderkey, o_totalprice FROM {orders}"), 100, F.desc("o_totalprice"), "o_orderkey").select("o_orderkey")


@query("sc1_multi_format_scan", "SELECT CAST(c_custkey AS VARCHAR) AS k, c_name AS name, CASE c_custkey % 3 WHEN 1 THEN CAST(c_nationkey AS VARCHAR) END AS nation FROM customer")
def sc1(spark, sf):
    from ..sources.scans import read_dataset

    path = scratch(spark, "dataset")
    d = rows(spark, sf, "SELECT c_custkey AS k, c_name AS name, c_nationkey AS nation FROM {customer}")
    d.filter("k % 3 = 0").select("k", "name").write.option("header", True).csv(f"{path}/a/csv")
    d.filter("k % 3 = 1").selectExpr("to_json(struct(k, name, nation)) AS value").unionByName(rows(spark, sf, "SELECT '{{broken' AS value FROM {nation}")).write.text(f"{path}/b")
    _renamed(spark, f"{path}/b", ".txt", ".jsonl")
    d.filter("k % 3 = 2").select("k", "name").write.parquet(f"{path}/c")
    return read_dataset(spark, path).select("k", "name", "nation")


@query("sc3_documents_by_suffix", "SELECT 'ok' AS error, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders UNION ALL SELECT 'unsupported file extension', count(DISTINCT o_orderpriority), NULL FROM orders")
def sc3(spark, sf):
    from ..sources.scans import read_documents

    path = scratch(spark, "documents")
    d = rows(spark, sf, "SELECT o_orderkey, o_orderpriority FROM {orders}")
    lines = d.selectExpr("concat('{\"k\":', o_orderkey, '}') AS value", "o_orderkey % 20 AS part")
    lines.filter("part % 2 = 0").select("value").coalesce(4).write.option("compression", "gzip").mode("append").json(f"{path}/gz")
    lines.filter("part % 2 = 1").select("value").coalesce(4).write.mode("append").json(f"{path}/plain")
    d.selectExpr("o_orderpriority", "1 AS n").distinct().write.partitionBy("o_orderpriority").csv(f"{path}/other")
    found = read_documents(spark, path)
    kinds = found.filter("error is not null").groupBy(F.regexp_extract("path", "o_orderpriority=([^/]*)", 1).alias("p")).agg(F.first("error").alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("total"))
    lines = found.filter("error is null").select(F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    number = F.get_json_object(F.get_json_object("line", "$.value"), "$.k").cast("bigint")
    return lines.agg(F.lit("ok").alias("error"), F.count(F.lit(1)).alias("n"), F.sum(number).alias("total")).unionByName(kinds)


@query("sk1_appended_lines", "SELECT n_nationkey AS k, n_name AS name, 2 AS n FROM nation")
def sk1(spark, sf):
    from ..sources.sinks import append_jsonl

    path = scratch(spark, "appended")
    d = rows(spark, sf, "SELECT n_nationkey AS k, n_name AS name FROM {nation}")
    append_jsonl(d, path)
    append_jsonl(d, path)
    return spark.read.schema("k bigint, name string").json(path).groupBy("k", "name").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("vl3_inferred_schema", "SELECT name, kind FROM (VALUES ('ok', 'boolean,null'), ('k', 'integer,null'), ('rate', 'number,null'), ('tags', 'array,null of string,null'), ('name', 'string,null'), ('at', 'object')) v(name, kind)")
def vl3(spark, sf):
    from ..operators.validation import infer_schema

    d = rows(spark, sf, "SELECT to_json(named_struct('k', c_custkey, 'name', c_name, 'rate', c_acctbal / 3, 'ok', c_custkey % 2 = 0, 'tags', array(c_mktsegment), 'at', named_struct('n', c_nationkey))) AS value FROM {customer}")
    lines = spark.read.json(_written(spark, d))
    found = infer_schema(lines.schema)["properties"]
    kinds = [(n, ",".join(s["type"]) + (" of " + ",".join(s["items"]["type"]) if "items" in s else "") if isinstance(s["type"], list) else s["type"]) for n, s in found.items()]
    return spark.createDataFrame(kinds, "name string, kind string")


def _renamed(spark, folder: str, old: str, new: str) -> None:
    """Give the files of a folder another suffix."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for f in fs.listStatus(at):
        name = f.getPath().getName()
        if name.endswith(old):
            fs.rename(f.getPath(), spark._jvm.org.apache.hadoop.fs.Path(at, name[: -len(old)] + new))


def _written(spark, lines) -> str:
    path = scratch(spark, "lines")
    lines.write.text(path)
    return path
