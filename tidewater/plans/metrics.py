"""Metric queries over the event stream's table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from .binding import cte, rows

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


BASE = cte("outcomes")


@query("a19_latency_histogram", BASE + ", b AS (SELECT unnest([0.5, 1, 2.5, 5, 10, 30, 60, 120, 300])::DOUBLE AS le) SELECT le, (SELECT count(*) FROM outcomes WHERE value <= le) AS n FROM b")
def a19(spark, sf):
    return M.histogram(rows(spark, sf, "outcomes"), "value")


@query("a18_labelled_counters", BASE + ", i AS (SELECT event_type, CAST(key % 5 AS BIGINT) AS network FROM outcomes) SELECT event_type, network, count(*) AS n, CAST(grouping(event_type) AS INT) AS all_event_type, CAST(grouping(network) AS INT) AS all_network FROM i GROUP BY CUBE (event_type, network)")
def a18(spark, sf):
    return M.labelled_counts(rows(spark, sf, "outcomes").select("event_type", (F.col("key") % 5).alias("network")), "event_type", "network")


_RUNS = BASE + """, i AS (SELECT *, sum(CAST(ok AS INT)) OVER (PARTITION BY key ORDER BY ts, event_id) AS isl FROM outcomes),
    s AS (SELECT *, CAST(sum(CAST(NOT ok AS INT)) OVER (PARTITION BY key, isl ORDER BY ts, event_id) AS BIGINT) AS streak FROM i) """


@query("w4_failure_runs", _RUNS + "SELECT event_id, streak FROM s")
def w4(spark, sf):
    return M.failure_runs(rows(spark, sf, "outcomes")).select("event_id", "streak")


@query("w5_w6_cooldown_backoff", _RUNS + """SELECT event_id, CAST(streak // 2 AS INT) AS opens, CASE WHEN streak // 2 > 0 THEN least(60.0 * pow(2.0, streak // 2 - 1), 3600.0) ELSE 0.0 END::DOUBLE AS cooldown_s,
    CASE WHEN streak > 0 THEN least(60.0 * pow(2.0, streak - 1), 300.0) ELSE 0.0 END::DOUBLE AS sleep_s FROM s""")
def w5(spark, sf):
    return M.breaker(M.failure_runs(rows(spark, sf, "outcomes")), 2).select("event_id", "opens", "cooldown_s", M.backoff(F.col("streak")).alias("sleep_s"))


_PAGES = "SELECT DISTINCT CAST(user_id % 20 AS BIGINT) AS source, CAST(event_id % 200 AS BIGINT) AS page, CAST(floor(value) AS BIGINT) AS value FROM {events}"


@query("w3_so4_novelty_cut", f"""WITH p AS ({_PAGES.replace('{events}', 'events')}), f AS (SELECT source, value, min(page) AS page FROM p GROUP BY 1, 2), n AS (SELECT d.source, d.page, count(f.value) AS new FROM (SELECT DISTINCT source, page FROM p) d LEFT JOIN f ON f.source = d.source AND f.page = d.page GROUP BY 1, 2),
    i AS (SELECT *, sum(CAST(new > 0 AS INT)) OVER (PARTITION BY source ORDER BY page) AS isl FROM n), d AS (SELECT *, sum(CAST(new = 0 AS INT)) OVER (PARTITION BY source, isl ORDER BY page) AS dry FROM i),
    s AS (SELECT source, min(page) AS stop FROM d WHERE dry >= 3 GROUP BY 1) SELECT d.source, page, new FROM d LEFT JOIN s ON s.source = d.source WHERE stop IS NULL OR page <= stop""")
def w3(spark, sf):
    return M.novelty_cut(rows(spark, sf, _PAGES))


@query("w2_round_robin_shards", "SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) % 7 AS INT) AS shard FROM orders")
def w2(spark, sf):
    return M.shard(rows(spark, sf, "SELECT o_orderkey FROM {orders}"), 7, "o_orderkey")


_GAUGE = """SELECT user_id AS key, event_id AS ts, CAST(floor(value * 10) AS BIGINT) AS view_count, CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS like_count, event_type FROM {events}"""


@query("w8_vl4_gauges", f"""WITH i AS ({_GAUGE.replace('{events}', 'events')}), l AS (SELECT key, ts, 'view_count' AS metric, view_count AS value FROM i UNION ALL SELECT key, ts, 'like_count', like_count FROM i WHERE like_count IS NOT NULL)
    SELECT key, ts, metric, value, value - lag(value) OVER (PARTITION BY key, metric ORDER BY ts) AS delta, row_number() OVER (PARTITION BY key, metric ORDER BY ts DESC) = 1 AS latest FROM l WHERE value IS NOT NULL""")
def w8(spark, sf):
    return M.gauges(rows(spark, sf, _GAUGE), "key", "ts")


_SLIDE = BASE + """, w AS (SELECT to_timestamp(e * 300)::TIMESTAMP AS "end", ok FROM (SELECT ok, unnest(range(CAST(floor(epoch(ts) / 300) AS BIGINT) + 1, CAST(floor(epoch(ts) / 300) AS BIGINT) + 4)) AS e FROM outcomes)),
    r AS (SELECT "end", count(*) AS n, count(*) FILTER (ok) AS good, count(*) FILTER (ok) / count(*) AS ratio FROM w GROUP BY 1) """


@query("st6_ratio_alert_batch", _SLIDE + """, c AS (SELECT *, ratio < 0.85 AS c, epoch("end") AS t FROM r), b AS (SELECT *, CASE WHEN c AND lag(c) OVER (ORDER BY t) AND t - lag(t) OVER (ORDER BY t) = 300 THEN 0 ELSE 1 END AS brk FROM c),
    i AS (SELECT *, sum(brk) OVER (ORDER BY t) AS isl FROM b) SELECT "end", n, good, round(ratio, 6) AS ratio, c AND row_number() OVER (PARTITION BY isl ORDER BY t) > 3 AS firing FROM i""")
def st6(spark, sf):
    out = M.held(M.ratio_windows(rows(spark, sf, "outcomes")), F.col("ratio") < 0.85, 3, 300)
    return out.withColumn("ratio", F.round("ratio", 6))


@query("st7_absence_batch", BASE + """, s AS (SELECT DISTINCT CAST(key AS BIGINT) AS key FROM outcomes), h AS (SELECT unnest(range(CAST(floor((SELECT min(epoch(ts)) FROM outcomes)) AS BIGINT) // 3600, CAST(floor((SELECT max(epoch(ts)) FROM outcomes)) AS BIGINT) // 3600 + 1)) AS slot)
    SELECT key, to_timestamp(slot * 3600)::TIMESTAMP AS start FROM s, h WHERE (key, slot) NOT IN (SELECT (key, CAST(floor(epoch(ts)) AS BIGINT) // 3600) FROM outcomes) AND key % 100 = 7""".replace("key % 100 = 7", "TRUE"))
def st7(spark, sf):
    o = rows(spark, sf, "outcomes")
    return M.absent(o.select("key"), o, "key")


@query("w10_first_mention", "SELECT l_suppkey AS channel, min(l_orderkey) AS depth, arg_min(l_partkey, struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey)) AS source FROM lineitem GROUP BY 1")
def w10(spark, sf):
    i = rows(spark, sf, "SELECT l_suppkey AS channel, l_orderkey AS depth, l_linenumber AS n, l_partkey AS source FROM {lineitem}")
    return M.first_mentions(i, "channel", "source", "depth", "n").select("channel", "depth", "source")


@query("w10_duplicate_mentions", """SELECT channel, arg_min(source, struct_pack(a := depth, b := source)) AS source, min(depth) AS depth, CAST(sum(n) AS BIGINT) AS mentions, CAST(sum(n - 1) AS BIGINT) AS repeats
    FROM (SELECT l_suppkey AS channel, l_partkey % 20 AS source, min(l_orderkey) AS depth, count(*) AS n FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def w10_duplicates(spark, sf):
    return M.first_mentions(rows(spark, sf, "SELECT l_suppkey AS channel, l_partkey % 20 AS source, l_orderkey AS depth FROM {lineitem}"), "channel", "source", "depth")


@query("st10_sla_windows", cte("outcomes") + "SELECT date_trunc('hour', ts) AS start, CAST(key % 4 + 1 AS INT) AS tier, count(*) FILTER (value <= 50) AS on_time, count(*) FILTER (value > 50) AS overdue FROM outcomes GROUP BY 1, 2")
def st10(spark, sf):
    from ..streaming.jobs import sla_windows

    return sla_windows(rows(spark, sf, "outcomes").select("ts", (F.col("key") % 4 + 1).cast("int").alias("tier"), (F.col("value") <= 50).alias("ok")))


@query("st11_throughput_collapse", cte("outcomes") + """SELECT date_trunc('hour', ts) AS start, count(*) FILTER (ok) AS rate, max(key) AS backlog, count(*) FILTER (ok) < 40 AND max(key) > 10 AS firing FROM outcomes GROUP BY 1""")
def st11(spark, sf):
    o = rows(spark, sf, "outcomes").groupBy(F.date_trunc("hour", "ts").alias("start")).agg(F.count_if("ok").alias("rate"), F.max("key").alias("backlog"))
    return o.withColumn("firing", (F.col("rate") < 40) & (F.col("backlog") > 10))


@query("st11_backlog_windows", cte("outcomes") + """, d AS (SELECT floor(epoch(ts) / 3600) AS w, count(*) AS n FROM outcomes WHERE ok GROUP BY 1),
    g AS (SELECT floor(epoch(ts) / 3600) AS w, event_type AS source, arg_max(key, struct_pack(a := ts, b := key)) AS value FROM outcomes WHERE key % 3 <> 0 GROUP BY 1, 2)
    SELECT to_timestamp(g.w * 3600)::TIMESTAMP AS start, round(coalesce(any_value(n), 0) / 3600.0, 9) AS rate, CAST(sum(value) AS BIGINT) AS backlog, coalesce(any_value(n), 0) / 3600.0 < 0.012 AND sum(value) > 40 AS firing FROM g LEFT JOIN d ON d.w = g.w GROUP BY g.w""")
def st11_windows(spark, sf):
    from ..streaming.alerts import throughput_collapse

    o = rows(spark, sf, "outcomes")
    out = throughput_collapse(o.filter("ok").select("ts"), o.filter("key % 3 <> 0").select("ts", F.col("event_type").alias("source"), F.col("key").cast("bigint").alias("value")), 0.012, 40, "1 hour")
    return out.withColumn("rate", F.round("rate", 9))


_MESSAGES = """SELECT event_id, named_struct('platform', CASE WHEN event_id % 2 = 0 THEN 'youtube' ELSE 'other' END, 'entity', event_type, 'data_url', concat('https://x/api/v1/data/param/u', CAST(user_id % 3 AS STRING), '/youtube/', event_type, '/0.0.', CAST(event_id % 4 AS STRING), '/file')) AS data FROM {events}"""


@query("st1_filtered_messages", "SELECT event_id FROM events WHERE event_id % 2 = 0 AND event_type = 'click' AND user_id % 3 = 1 AND event_id % 4 = 2")
def st1(spark, sf):
    from ..streaming.jobs import filter_messages

    return filter_messages(rows(spark, sf, _MESSAGES), "youtube", "click", "u1", "0.0.2").select("event_id")


@query("st3_failures_with_ttl", BASE + """, g AS (SELECT *, CASE WHEN ok OR epoch_us(ts) - lag(epoch_us(ts)) OVER w > 7200 * 1000000::BIGINT THEN 1 ELSE 0 END AS b FROM outcomes WINDOW w AS (PARTITION BY key ORDER BY ts, event_id)),
    i AS (SELECT *, sum(b) OVER (PARTITION BY key ORDER BY ts, event_id) AS isl FROM g) SELECT event_id, CAST(sum(CAST(NOT ok AS INT)) OVER (PARTITION BY key, isl ORDER BY ts, event_id) AS BIGINT) AS failures FROM i""")
def st3(spark, sf):
    return M.failures_with_ttl(rows(spark, sf, "outcomes"), 7200).select("event_id", "failures")


@query("st4_ever_had_feed", BASE + "SELECT DISTINCT CAST(key AS BIGINT) AS key FROM outcomes WHERE ok")
def st4(spark, sf):
    from ..streaming.jobs import ever_had_feed

    return ever_had_feed(rows(spark, sf, "outcomes")).select(F.col("key").cast("bigint").alias("key"))


@query("st5_open_breakers", _RUNS + ", l AS (SELECT key, arg_max(streak, struct_pack(a := ts, b := event_id)) AS streak FROM s GROUP BY 1) SELECT CAST(key AS BIGINT) AS key, CAST(streak // 2 AS INT) AS opens FROM l WHERE streak // 2 > 0")
def st5(spark, sf):
    last = M.breaker(M.failure_runs(rows(spark, sf, "outcomes")), 2).groupBy("key").agg(F.max_by("opens", F.struct("ts", "event_id")).alias("opens"))
    return last.filter("opens > 0").select(F.col("key").cast("bigint").alias("key"), F.col("opens").cast("int").alias("opens"))


_CLAIMS = "SELECT CAST(user_id % 40 AS BIGINT) AS resource, event_id, ts, CASE WHEN value < 30 THEN 'release' ELSE 'claim' END AS op, event_type AS owner FROM {events}"


@query("st8_claim_audit", f"""WITH RECURSIVE c AS (SELECT *, CAST(epoch_ms(ts) AS BIGINT) AS ms, row_number() OVER (PARTITION BY resource ORDER BY epoch_ms(ts), event_id) AS n FROM ({_CLAIMS.replace('{events}', 'events')})),
    r AS (SELECT resource, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS holder, CAST(0 AS BIGINT) AS ends, FALSE AS granted FROM (SELECT DISTINCT resource FROM c)
        UNION ALL SELECT c.resource, c.n, c.event_id, CASE WHEN NOT g THEN holder WHEN op = 'release' THEN NULL ELSE owner END, CASE WHEN NOT g THEN ends WHEN op = 'release' THEN 0 ELSE ms + 3600000 END, g
        FROM r JOIN c ON c.resource = r.resource AND c.n = r.n + 1, LATERAL (SELECT CASE WHEN op = 'release' THEN coalesce(holder = owner AND ms < ends, FALSE) ELSE holder IS NULL OR ms >= ends END AS g))
    SELECT resource, event_id, granted FROM r WHERE n > 0""")
def st8(spark, sf):
    return M.audit_claims(rows(spark, sf, _CLAIMS), 3600)
