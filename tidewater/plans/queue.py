"""Queue queries: customers are channels, their balances are subscriber counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..operators import queue as O
from .binding import cte, rows, scratch
from .scalars import TIERS, tier_sql

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def tiers(spark, sf):
    return rows(spark, sf, "creators").filter("k % 10 <> 9").select("creator_id", "name", N.tier_for(F.col("subs"), TIERS).alias("tier"))


BASE = cte("creators", "queue", "claims", "no_feeds") + f", t AS (SELECT creator_id, name, {tier_sql('subs')} AS tier FROM creators WHERE k % 10 <> 9) "
STATES = BASE + """, s AS (SELECT creator_id, tier, CASE WHEN creator_id IN (SELECT creator_id FROM queue) THEN 'queued' WHEN creator_id IN (SELECT creator_id FROM claims) THEN 'claimed'
    WHEN creator_id IN (SELECT creator_id FROM no_feeds) THEN 'no_feeds' ELSE 'orphan' END AS state FROM t) """


def states(spark, sf):
    return O.creator_states(tiers(spark, sf), rows(spark, sf, "queue"), rows(spark, sf, "claims"), rows(spark, sf, "no_feeds"))


@query("w1_claim_batch", cte("queue") + "SELECT creator_id, name, tier, due_ts FROM queue WHERE due_ts <= 500 ORDER BY tier, due_ts, name, creator_id LIMIT 200")
def w1(spark, sf):
    return O.claim_batch(rows(spark, sf, "queue"), 500.0, 200)


@query("w1_claim_per_tier", cte("queue") + "SELECT * FROM (SELECT creator_id, name, tier, due_ts, CAST(row_number() OVER (PARTITION BY tier ORDER BY due_ts, name, creator_id) AS INT) AS place FROM queue WHERE due_ts <= 500) WHERE place <= 20")
def w1g(spark, sf):
    return O.claim_per_group(rows(spark, sf, "queue"), "tier", 500.0, 20)


@query("j16_creator_states", STATES + "SELECT creator_id, tier, state FROM s")
def j16(spark, sf):
    return states(spark, sf)


@query("j16_recover_orphans", STATES + "SELECT creator_id, name, tier, due_ts FROM queue UNION ALL SELECT s.creator_id, t.name, s.tier, 700.0 FROM s JOIN t ON t.creator_id = s.creator_id WHERE state = 'orphan'")
def j16r(spark, sf):
    return O.recover_orphans(states(spark, sf), rows(spark, sf, "queue"), tiers(spark, sf), 700.0)


@query("a6_st9_tier_by_state", STATES + "SELECT tier, " + ", ".join(f"count(*) FILTER (state = '{x}') AS {x}" for x in O.STATES) + " FROM s GROUP BY 1")
def a6(spark, sf):
    return O.tier_state_counts(states(spark, sf))


@query("j17_tier_repairs", BASE + """SELECT q.creator_id, q.tier AS queue_tier, t.tier AS hash_tier, CASE WHEN t.tier IS NULL THEN 'write' ELSE 'move' END AS action
    FROM queue q LEFT JOIN t ON t.creator_id = q.creator_id WHERE q.creator_id NOT IN (SELECT creator_id FROM claims) AND (t.tier IS NULL OR t.tier <> q.tier)""")
def j17(spark, sf):
    return O.tier_repairs(rows(spark, sf, "queue"), tiers(spark, sf), rows(spark, sf, "claims"))


@query("j18_hash_orphans", BASE + "SELECT creator_id, name, tier FROM t WHERE creator_id NOT IN (SELECT creator_id FROM queue) AND creator_id NOT IN (SELECT creator_id FROM claims)")
def j18(spark, sf):
    return O.hash_orphans(tiers(spark, sf), rows(spark, sf, "queue"), rows(spark, sf, "claims"))


@query("j19_enrich_counts", cte("creators", "queue") + """, m AS (SELECT creator_id FROM creators WHERE subs IS NULL AND creator_id NOT IN (SELECT creator_id FROM queue) ORDER BY creator_id LIMIT 100000)
    SELECT m.creator_id, c.k - 100 AS subs FROM m JOIN creators c ON c.creator_id = m.creator_id WHERE c.k - 100 > 0""")
def j19(spark, sf):
    c = rows(spark, sf, "creators")
    return O.enrich_counts(c, rows(spark, sf, "queue"), c.select("creator_id", (F.col("k") - 100).alias("subs")), 100_000, "creator_id")


@query("j20_seed_queue", cte("creators", "queue") + f"SELECT creator_id, name, {tier_sql('nullif(subs, 0)', 3)} AS tier FROM creators WHERE creator_id NOT IN (SELECT creator_id FROM queue)")
def j20(spark, sf):
    c = rows(spark, sf, "creators").join(rows(spark, sf, "queue").select("creator_id"), "creator_id", "left_anti")
    return c.select("creator_id", "name", N.tier_for(F.when(F.col("subs") != 0, F.col("subs")), TIERS, "next_to_last").alias("tier"))


_BATCH = """SELECT c_custkey AS pos, 'UC' || lpad(CAST(c_custkey % 700 AS STRING), 22, '0') AS creator_id, CASE WHEN c_custkey % 2 = 0 THEN 'NAME' ELSE 'name' END || CAST(c_custkey % 900 AS STRING) AS name FROM {customer}"""


@query("j12_populate_by_name", cte("queue") + f""", b AS ({_BATCH.replace('{customer}', 'customer')}), ok AS (SELECT * FROM b WHERE pos % 13 <> 0 AND lower(name) NOT IN (SELECT lower('name' || CAST(s_suppkey AS VARCHAR)) FROM supplier)
    AND creator_id NOT IN (SELECT creator_id FROM b WHERE pos % 13 = 0))
    SELECT pos, creator_id, name FROM (SELECT *, row_number() OVER (PARTITION BY lower(name) ORDER BY pos) AS n FROM ok) WHERE n = 1""")
def j12(spark, sf):
    b = rows(spark, sf, _BATCH)
    known = rows(spark, sf, "SELECT 'name' || CAST(s_suppkey AS STRING) AS name FROM {supplier}")
    return O.populate(b, known, b.filter("pos % 13 = 0"), "pos", ("name",))


_KNOWN_IDS = "SELECT 'UC' || lpad(CAST(s_suppkey AS VARCHAR), 22, '0') FROM supplier"


@query("j12_populate_by_id_and_name", f"""WITH RECURSIVE b AS ({_BATCH.replace('{customer}', 'customer')}), ok AS (SELECT *, row_number() OVER (ORDER BY pos) AS n FROM b WHERE pos % 13 <> 0 AND lower(name) NOT IN (SELECT 'name' || CAST(s_suppkey AS VARCHAR) FROM supplier)
        AND creator_id NOT IN ({_KNOWN_IDS}) AND creator_id NOT IN (SELECT creator_id FROM b WHERE pos % 13 = 0)),
    r AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS seen, FALSE AS good UNION ALL SELECT o.n, CASE WHEN g THEN list_concat(seen, [lower(creator_id), lower(name)]) ELSE seen END, g
        FROM r JOIN ok o ON o.n = r.n + 1, LATERAL (SELECT NOT list_contains(seen, lower(creator_id)) AND NOT list_contains(seen, lower(name)) AS g))
    SELECT pos, creator_id, name FROM ok JOIN r ON r.n = ok.n WHERE r.good""")
def j12b(spark, sf):
    b = rows(spark, sf, _BATCH)
    known = rows(spark, sf, "SELECT 'name' || CAST(s_suppkey AS STRING) AS name, 'UC' || lpad(CAST(s_suppkey AS STRING), 22, '0') AS creator_id FROM {supplier}")
    return O.populate(b, known, b.filter("pos % 13 = 0"), "pos")


@query("a4_tier_gap", BASE + """SELECT coalesce(a.tier, b.tier) AS tier, coalesce(x, 0) AS in_hash, coalesce(y, 0) AS in_queue, coalesce(x, 0) - coalesce(y, 0) AS gap
    FROM (SELECT tier, count(*) AS x FROM t GROUP BY 1) a FULL JOIN (SELECT tier, count(*) AS y FROM queue GROUP BY 1) b ON a.tier = b.tier""")
def a4(spark, sf):
    return O.tier_gap(tiers(spark, sf), rows(spark, sf, "queue"))


@query("a5_queue_size", cte("queue") + "SELECT tier, count(*) AS n, min(due_ts) AS next_due FROM queue GROUP BY ROLLUP (tier)")
def a5(spark, sf):
    return O.queue_size(rows(spark, sf, "queue"))


@query("a20_on_time_by_tier", cte("queue") + """, i AS (SELECT tier, 900.0 <= due_ts + 0.5 * (CASE tier WHEN 1 THEN 4 WHEN 2 THEN 12 WHEN 3 THEN 24 ELSE 48 END) * 20 AS ok FROM queue)
    SELECT tier, count(*) AS n, count(*) FILTER (ok) AS on_time, round(avg(CASE WHEN ok THEN 1.0 ELSE 0.0 END), 6) AS ratio FROM i GROUP BY 1""")
def a20(spark, sf):
    ok = O.on_time(F.lit(900.0), F.col("due_ts"), N.interval_hours(F.col("tier"), TIERS) * 20, 0.5)
    return rows(spark, sf, "queue").withColumn("ok", ok).groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("on_time"), F.round(F.avg(F.col("ok").cast("double")), 6).alias("ratio"))


_LOG = """SELECT o_custkey AS key, o_orderkey AS seq, CASE o_orderkey % 7 WHEN 0 THEN 'populate' WHEN 1 THEN 'claim' WHEN 2 THEN 'release' WHEN 3 THEN 'update_tier' WHEN 4 THEN 'populate' WHEN 5 THEN 'release'
    ELSE CASE WHEN o_orderkey % 5 = 0 THEN 'remove' ELSE 'claim' END END AS op, CASE WHEN o_orderkey % 7 IN (0, 3, 4) THEN CAST(o_orderkey % 4 + 1 AS INT) END AS tier,
    CASE WHEN o_orderkey % 7 IN (0, 2, 4, 5) THEN CAST(o_orderkey AS DOUBLE) END AS due_ts FROM {orders}"""


@query("w9_queue_state", f"""WITH e AS ({_LOG.replace('{orders}', 'orders')}), g AS (SELECT e.*, max(CASE WHEN op = 'remove' THEN seq END) OVER (PARTITION BY key) AS gone FROM e),
    a AS (SELECT * FROM g WHERE gone IS NULL OR seq > gone)
    SELECT k.key, CASE WHEN a1.some THEN coalesce(a1.tier, 4) END AS tier, a1.due_ts, coalesce(a1.op = 'claim', FALSE) AS claimed, a1.some IS NULL AS removed FROM (SELECT DISTINCT key FROM e) k LEFT JOIN
    (SELECT key, TRUE AS some, arg_max(tier, seq) FILTER (tier IS NOT NULL) AS tier, arg_max(due_ts, seq) FILTER (due_ts IS NOT NULL) AS due_ts, arg_max(op, seq) FILTER (op IN ('populate', 'claim', 'release')) AS op FROM a GROUP BY 1) a1 ON a1.key = k.key""")
def w9(spark, sf):
    return O.queue_state(rows(spark, sf, _LOG), 4)


_STATE = """SELECT key, coalesce(arg_max(tier, seq) FILTER (tier IS NOT NULL), 4) AS tier, arg_max(due_ts, seq) FILTER (due_ts IS NOT NULL) AS due_ts, coalesce(arg_max(op, seq) FILTER (op IN ('populate', 'claim', 'release')) = 'claim', FALSE) AS claimed
    FROM (SELECT *, max(CASE WHEN op = 'remove' THEN seq END) OVER (PARTITION BY key) AS gone FROM {0}) WHERE gone IS NULL OR seq > gone GROUP BY key"""


@query("st9_population_series", f"""WITH e AS ({_LOG.replace('{orders}', 'orders')}), c AS (SELECT CAST(b AS BIGINT) AS batch, b * (max(seq) + 3) // 3 AS past, (b + 1) * (max(seq) + 3) // 3 AS upto FROM e, (SELECT unnest(range(0, 3)) AS b) GROUP BY b),
    x AS (SELECT batch * 1000000000000 + key AS key, seq, op, tier, due_ts FROM c JOIN e ON seq < upto), s AS ({_STATE.format('x')})
    SELECT key // 1000000000000 AS batch, tier, count(*) FILTER (NOT claimed) AS queued, count(*) FILTER (claimed) AS claimed FROM s GROUP BY 1, 2""")
def st9(spark, sf):
    from ..streaming.population import PopulationSeries

    series, log = PopulationSeries(spark, scratch(spark, "population"), 4, 16), rows(spark, sf, _LOG)
    top = log.agg(F.max("seq")).first()[0] + 3
    for number in (0, 1, 1, 2, 2, 0):  # batches that come again change nothing
        series.take(log.filter((F.col("seq") >= number * top // 3) & (F.col("seq") < (number + 1) * top // 3)), number)
    return series.series()


_TIMED = _LOG.replace("SELECT o_custkey AS key,", "SELECT o_custkey AS key, CAST(o_orderkey * 10 AS DOUBLE) AS ts, CASE WHEN o_orderkey % 4 = 1 THEN CAST(100000 AS DOUBLE) END AS retry,").replace("IN (0, 2, 4, 5) THEN CAST(o_orderkey AS DOUBLE)", "IN (0, 4) THEN CAST(o_orderkey AS DOUBLE)")


@query("w9_release_due", f"""WITH e AS ({_TIMED.replace('{orders}', 'orders')}), l AS (SELECT *, sum(CASE WHEN op = 'remove' THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY seq) AS life FROM e),
    t AS (SELECT *, coalesce(last_value(CASE WHEN op <> 'remove' THEN tier END IGNORE NULLS) OVER (PARTITION BY key, life ORDER BY seq ROWS UNBOUNDED PRECEDING), 4) AS now FROM l),
    d AS (SELECT key, seq, op, tier, CASE WHEN op = 'release' THEN ts + greatest(CASE now WHEN 1 THEN 4 WHEN 2 THEN 12 WHEN 3 THEN 24 ELSE 48 END * 3600.0, coalesce(retry, 0)) * 0.5 ELSE due_ts END AS due_ts FROM t)
    SELECT key, tier, CAST(due_ts AS DOUBLE) AS due_ts, claimed FROM ({_STATE.format('d')})""")
def w9_due(spark, sf):
    timed = O.with_release_due(rows(spark, sf, _TIMED), TIERS, 0.5, 4)
    return O.queue_state(timed, 4).filter(~F.col("removed")).select("key", "tier", "due_ts", "claimed")


_FETCH = """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'not_found' WHEN 1 THEN 'server_error' ELSE 'ok' END AS outcome, user_id % 70 AS failures, user_id % 3 = 0 AS had_feed FROM {events}"""


@query("pf20_pf21_fetch_action", f"""WITH i AS ({_FETCH.replace('{events}', 'events')}) SELECT event_id, CASE WHEN outcome = 'not_found' AND failures >= CASE WHEN had_feed THEN 50 ELSE 10 END THEN 'remove'
    WHEN outcome IN ('not_found', 'server_error') THEN 'release_later' ELSE 'release' END AS action FROM i""")
def pf20(spark, sf):
    return rows(spark, sf, _FETCH).select("event_id", O.fetch_action(F.col("outcome"), F.col("failures"), F.col("had_feed")).alias("action"))


@query("w7_since_last", cte("outcomes") + "SELECT event_id, round((epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY key ORDER BY ts, event_id))) / 1e6, 3) AS gap_s FROM outcomes")
def w7(spark, sf):
    return O.since_last(rows(spark, sf, "outcomes")).select("event_id", F.round("gap_s", 3).alias("gap_s"))


@query("so6_known_index", cte("queue") + "SELECT DISTINCT creator_id, lower(name) AS name FROM queue")
def so6(spark, sf):
    return rows(spark, sf, "queue").select("creator_id", F.lower("name").alias("name")).distinct()


_FEED = """SELECT c_custkey AS pos, 'c' || CAST(c_custkey % 300 AS STRING) || chr(9) || 'https://example.org/' || CAST(c_custkey AS STRING) || chr(9) || c_name || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE chr(9) || CAST(c_custkey % 9 AS STRING) END AS value FROM {customer}"""


@query("sc13_sk9_no_feeds", """SELECT 'c' || CAST(c_custkey % 300 AS VARCHAR) AS creator_id, arg_max('https://example.org/' || CAST(c_custkey AS VARCHAR), c_custkey) AS url, arg_max(c_name, c_custkey) AS name,
    CAST(sum(CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE c_custkey % 9 END) AS BIGINT) AS count FROM customer GROUP BY 1""")
def sc13(spark, sf):
    from ..sources.scans import no_feed_lines

    return no_feed_lines(rows(spark, sf, _FEED)).orderBy(F.desc("count"), "creator_id")


@query("sc12_queue_snapshot", "SELECT c_custkey AS pos, CAST(CASE WHEN c_custkey % 2 = 0 THEN 3 ELSE 1 END AS INT) AS tier, 0 AS at, 5.0::DOUBLE AS due_ts, c_name AS name, 'c' || CAST(c_custkey AS VARCHAR) AS creator_id FROM customer")
def sc12(spark, sf):
    from ..sources.scans import queue_snapshot

    return queue_snapshot(rows(spark, sf, """SELECT c_custkey AS pos, CASE WHEN c_custkey % 2 = 0 THEN concat('{{"3":[[5,"', c_name, '","c', CAST(c_custkey AS STRING), '"]]}}') ELSE concat('[[5,"', c_name, '","c', CAST(c_custkey AS STRING), '"]]') END AS value FROM {customer}""")).drop("_place")


_REPEATS = """SELECT c_custkey AS pos, concat(CASE WHEN c_custkey % 3 = 0 THEN '[' ELSE '{{"queues":{{"4":[' END, '[', CAST(c_custkey AS STRING), ',"', CASE WHEN c_custkey % 2 = 0 THEN 'NAME' ELSE 'name' END, CAST(floor(c_custkey / 2) AS STRING), '","c', CAST(floor((c_custkey + 1) / 2) AS STRING), '"],[1,"n', CAST(c_custkey % 40 AS STRING),
    '","C', CAST(c_custkey AS STRING), '"]', CASE WHEN c_custkey % 3 = 0 THEN ']' ELSE ']}},"creator_tiers":{{}}}}' END) AS value FROM {customer}"""


@query("sc12_distinct_queue", """WITH RECURSIVE e AS (SELECT c_custkey AS pos, CAST(CASE WHEN c_custkey % 3 = 0 THEN 9 ELSE 4 END AS INT) AS tier, 0 AS at_, c_custkey::DOUBLE AS due_ts, CASE WHEN c_custkey % 2 = 0 THEN 'NAME' ELSE 'name' END || c_custkey // 2 AS name, 'c' || (c_custkey + 1) // 2 AS creator_id FROM customer
        UNION ALL SELECT c_custkey, CAST(CASE WHEN c_custkey % 3 = 0 THEN 9 ELSE 4 END AS INT), 1, 1.0::DOUBLE, 'n' || c_custkey % 40, 'C' || c_custkey FROM customer),
    o AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY pos, at_) AS n FROM e),
    r AS (SELECT n, pos, tier, at_, due_ts, name, creator_id, [lower(name)] AS names, [lower(creator_id)] AS ids, TRUE AS kept FROM o WHERE n = 1
        UNION ALL SELECT o.n, o.pos, o.tier, o.at_, o.due_ts, o.name, o.creator_id, CASE WHEN k THEN list_append(r.names, lower(o.name)) ELSE r.names END, CASE WHEN k THEN list_append(r.ids, lower(o.creator_id)) ELSE r.ids END, k
        FROM r JOIN o ON o.n = r.n + 1, LATERAL (SELECT NOT list_contains(r.names, lower(o.name)) AND NOT list_contains(r.ids, lower(o.creator_id)) AS k))
    SELECT pos, tier, at_ AS at, due_ts, name, creator_id FROM r WHERE kept""")
def sc12_distinct(spark, sf):
    from ..sources.scans import distinct_queue

    return distinct_queue(rows(spark, sf, _REPEATS), 9)
