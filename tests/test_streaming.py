"""Streams give what their batch twins give."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import metrics
from tidewater.streaming import alerts, jobs

SCHEMA = "event_id bigint, ts timestamp, key bigint, ok boolean, op string, owner string, resource bigint"


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events") / "json")
    df = spark.range(240).select(
        F.col("id").alias("event_id"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("ts"), (F.col("id") % 3).alias("key"), (F.col("id") * 7 % 11 > 8).alias("ok"),
        F.when(F.col("id") % 4 == 3, "release").otherwise("claim").alias("op"), F.concat(F.lit("w"), (F.col("id") % 5).cast("string")).alias("owner"), (F.col("id") % 2).alias("resource"),
    )
    df.repartitionByRange(3, "event_id").write.json(path)
    return path


def run(spark, stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_breaker(spark, events):
    got = run(spark, jobs.breaker_stream(jobs.read_events(spark, events, SCHEMA)), "breaker")
    want = metrics.breaker(metrics.failure_runs(spark.read.schema(SCHEMA).json(events))).select("key", "event_id", "streak", "opens", "cooldown_s")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_failure_counts_and_claims(spark, events):
    rows = sorted(spark.read.schema(SCHEMA).json(events).collect(), key=lambda r: r.event_id)
    got = {r.event_id: r.failures for r in run(spark, jobs.failure_counts(jobs.read_events(spark, events, SCHEMA), 150), "failures").collect()}
    claims = {r.event_id: r.granted for r in run(spark, jobs.audit_claims(jobs.read_events(spark, events, SCHEMA), 200), "claims").collect()}
    n, last, held = {}, {}, {}
    for r in rows:
        now = r.ts.timestamp()
        n[r.key] = 0 if r.ok else (n.get(r.key, 0) if now - last.get(r.key, 0) <= 150 else 0) + 1
        last[r.key] = now
        assert got[r.event_id] == n[r.key]
        owner, until = held.get(r.resource, (None, 0))
        if r.op == "release":
            granted = owner == r.owner and now < until
            held[r.resource] = (None, 0) if granted else (owner, until)
        else:
            granted = owner is None or now >= until
            held[r.resource] = (r.owner, now + 200) if granted else (owner, until)
        assert claims[r.event_id] == granted


def test_windows_and_messages(spark, events):
    stream = jobs.read_events(spark, events, SCHEMA).withColumn("tier", F.lit(1))
    got = run(spark, jobs.sla_windows(stream), "sla", "complete")
    want = jobs.sla_windows(spark.read.schema(SCHEMA).json(events).withColumn("tier", F.lit(1)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    m = spark.createDataFrame([(("youtube", "video", "https://h/api/v1/data/param/o/youtube/video/1.0.0/x"),)], "data struct<platform:string,entity:string,data_url:string>")
    assert jobs.filter_messages(m, "youtube", owner="o", version="1.0.0").count() == 1 and jobs.filter_messages(m, owner="p").count() == 0


def test_watch(spark, tmp_path):
    schema = "ident string, prefix_rank int, mtime bigint"
    spark.createDataFrame([("a", 0, 1), ("b", 0, 9)], schema).write.json(str(tmp_path / "in"))
    up, seen = spark.createDataFrame([("a", 1, 5)], schema), []
    q = jobs.watch_assets(spark.readStream.schema(schema).json(str(tmp_path / "in")), up, lambda df, n: seen.extend(df.collect()), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert {r.ident for r in seen} == {"b"}


def write_files(spark, rows, schema, path, order):
    """One JSON file per part of rows, in the order in which the stream takes them."""
    import os
    import time

    os.makedirs(path)
    for n, k in enumerate(order):
        spark.createDataFrame(rows[k], schema).coalesce(1).write.json(f"{path}/tmp{n}")
        part = next(f for f in os.listdir(f"{path}/tmp{n}") if f.endswith(".json"))
        os.rename(f"{path}/tmp{n}/{part}", f"{path}/{n}.json")
        os.utime(f"{path}/{n}.json", (time.time() - 100 + n, time.time() - 100 + n))


def at(minutes):
    import datetime

    return datetime.datetime(2024, 5, 1) + datetime.timedelta(minutes=minutes)


def state_rows(query):
    return [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]


def finish(stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(180)
    return q


@pytest.mark.parametrize("order", [[0, 1, 2, 3, 4], [2, 0, 1, 3, 4]])
def test_absence_by_timers(spark, tmp_path, order):
    # series 1 each half hour, 2 stops after the third hour, 3 begins in the fifth, 4 never sends, 9 is not expected
    sends = [(1, m) for m in range(0, 600, 30)] + [(2, m) for m in range(0, 180, 20)] + [(3, m) for m in range(300, 600, 25)] + [(9, 10)]
    parts = [[(k, at(m)) for k, m in sends if 200 * p <= m < 200 * p + 200] for p in range(3)] + [[(1, at(3000))], [(1, at(3001))]]
    write_files(spark, parts, "key int, ts timestamp", f"{tmp_path}/in", order)
    expected = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,)], "key int")
    events = spark.readStream.schema("key int, ts timestamp").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    name = "absence" + "".join(map(str, order))
    finish(alerts.absence(expected, events, "key", "2024-05-01 00:00:00", 3600, "8 hours"), name)
    got = {(r.key, r.start) for r in spark.table(name).collect()}
    assert spark.table(name).count() == len(got)
    every = spark.read.schema("key int, ts timestamp").json(f"{tmp_path}/in")
    over = at(3001 - 480 - 60)  # windows that the last watermark has closed
    want = {(r.key, r.start) for r in metrics.absent(expected, every, "key").collect() if r.start <= over}
    assert got == want and {k for k, _ in got} == {1, 2, 3, 4} and (4, at(0)) in got and (2, at(180)) in got


def test_hold_in_a_stream(spark, tmp_path):
    minutes = [m for m in range(0, 240) if not 150 <= m < 175]
    parts = [[(at(m), m % 10 < (9 if m < 60 or m > 200 else 5), m % 2) for m in minutes if 60 * p <= m < 60 * p + 60] for p in range(4)] + [[(at(1000), True, 0), (at(1000), True, 1)], [(at(1001), True, 0)]]
    schema = "ts timestamp, ok boolean, rule int"
    write_files(spark, parts, schema, f"{tmp_path}/in", range(6))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")
    windows = jobs.success_ratio(stream, "15 minutes", "5 minutes", "10 minutes")
    finish(alerts.held_stream(windows, F.col("good") / F.col("n") < 0.8, 3, 300), "held")
    batch = metrics.ratio_windows(spark.read.schema(schema).json(f"{tmp_path}/in"))
    want = {(r.end, r.n, r.good, r.firing) for r in metrics.held(batch, F.col("ratio") < 0.8, 3, 300).collect() if r.end <= at(980)}
    got = {tuple(r) for r in spark.table("held").collect()}
    assert got == want and 0 < sum(f for *_, f in got) < len(got)


def test_throughput_collapse_joins_two_streams(spark, tmp_path):
    done = [[(at(m),) for m in range(60 * p, 60 * p + 60) if not 70 <= m < 130] for p in range(3)] + [[(at(3),), (at(900),)], [(at(901),)]]
    gauges = [[(at(m), s, 10 * m + s) for m in range(60 * p, 60 * p + 60, 4) for s in (0, 1)] for p in range(3)] + [[(at(900), 0, 1)], [(at(901), 0, 1)]]
    write_files(spark, done, "ts timestamp", f"{tmp_path}/done", range(5))
    write_files(spark, gauges, "ts timestamp, source int, value long", f"{tmp_path}/gauges", range(5))
    streams = [spark.readStream.schema(s).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/{n}") for n, s in (("done", "ts timestamp"), ("gauges", "ts timestamp, source int, value long"))]
    finish(alerts.throughput_collapse(*streams, 0.01, 1000), "collapse")
    flat = [[r for part in parts for r in part if r != (at(3),)] for parts in (done, gauges)]  # the second row at minute 3 came too late
    flat[0].append((at(3),))
    tables = [spark.createDataFrame(flat[0], "ts timestamp"), spark.createDataFrame(flat[1], "ts timestamp, source int, value long")]
    want = {tuple(r) for r in alerts.throughput_collapse(*tables, 0.01, 1000).collect() if r.start < at(800)}
    got = [tuple(r) for r in spark.table("collapse").collect()]
    assert set(got) == want and len(got) == 12 and sum(f for *_, f in got) == 4


def test_state_ends(spark, tmp_path):
    rows = [(k, at(k), k % 40, False, "claim", "w", k % 40) for k in range(40)]
    parts = [rows, [(100, at(30), 41, False, "claim", "w", 41)], [(101, at(3000), 42, True, "release", "w", 42)], [(102, at(3001), 43, True, "release", "w", 43)]]
    write_files(spark, parts, SCHEMA, f"{tmp_path}/in", range(4))
    twin = spark.read.schema(SCHEMA).json(f"{tmp_path}/in")
    for n, (job, want) in enumerate({
        "counts": (lambda s: jobs.failure_counts(s, 600, "1 hour"), metrics.failures_with_ttl(twin, 600).select("key", "event_id", "failures")),
        "claims": (lambda s: jobs.audit_claims(s, 600, "1 hour"), metrics.audit_claims(twin, 600)),
        "breaker": (lambda s: jobs.breaker_stream(s, 1, forget_s=600, late="1 hour"), metrics.breaker(metrics.failures_with_ttl(twin, 600).withColumnRenamed("failures", "streak"), 1).select("key", "event_id", "streak", "opens", "cooldown_s")),
    }.values()):
        q = finish(job(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")), f"ends{n}")
        held = state_rows(q)
        assert max(held) >= 40 and held[-1] == 0, held
        assert sorted(map(tuple, spark.table(f"ends{n}").collect())) == sorted(map(tuple, want.collect()))


def test_population_series(spark, tmp_path):
    from tidewater.operators import queue
    from tidewater.streaming.population import PopulationSeries

    ops = ["populate", "claim", "release", "update_tier", "remove"]
    log = [(k % 17, k, ops[k * 7 % 5], k % 3 + 1 if k % 2 else None, float(k)) for k in range(120)]
    schema = "key bigint, seq bigint, op string, tier int, due_ts double"
    write_files(spark, [log[:50], log[50:90], log[90:]], schema, f"{tmp_path}/in", range(3))
    series = PopulationSeries(spark, f"{tmp_path}/out", 4, 4)
    q = series.start(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in"), f"{tmp_path}/ck", None)
    q.awaitTermination(180)
    q = series.start(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in"), f"{tmp_path}/ck", None)  # nothing new
    q.awaitTermination(180)
    want = set()
    for number, upto in enumerate((50, 90, 120)):
        state = queue.queue_state(spark.createDataFrame(log[:upto], schema), 4).filter("not removed")
        want |= {(number, *r) for r in queue.population(state).collect()}
    assert sorted(map(tuple, series.series().collect())) == sorted(want)
    series.take(spark.createDataFrame(log[90:], schema), 2)
    assert sorted(map(tuple, series.series().collect())) == sorted(want)


def test_uploads_in_batches(spark, tmp_path):
    from tidewater.operators import records

    schema = "ident string, prefix_rank int, mtime bigint, text string"
    write_files(spark, [[(f"a{k}", 0, k, "x" * k if k % 3 else None) for k in range(20)], [("b", 0, 1, "b" * 50), ("b", 0, 1, "b" * 50), ("c", 1, 9, "c")]], schema, f"{tmp_path}/in", range(2))
    uploaded = spark.createDataFrame([("a4", 1, 50), ("c", 0, 99)], "ident string, prefix_rank int, mtime bigint")
    sent, told = {}, {}

    def prepare(df):
        some = lambda c: F.when(F.col("text").isNotNull(), c)
        reason = records.skip_reason(F.lit(True), F.col("text").isNotNull(), F.lit("h"), F.col("ident"), some(F.when(F.length("text") < 3, "short")), F.col("superseded"))
        return df.withColumn("reason", reason).withColumn("line", F.col("text"))

    def hand_on(lines, outcomes, number):
        sent[number], told[number] = lines.collect(), {r.reason: r.n for r in outcomes.collect()}

    q = jobs.watch_uploads(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in"), uploaded, prepare, hand_on, f"{tmp_path}/ck", shards=2, max_records=3, max_bytes=60)
    q.awaitTermination(180)
    assert told == {0: {"read_failed": 7, "schema_invalid": 2, "superseded": 1, None: 10}, 1: {"schema_invalid": 1, None: 2}}
    assert {r.ident for r in sent[0]} == {f"a{k}" for k in range(5, 20) if k % 3} and [r.ident for r in sent[1]] == ["b"]
    sizes = {}
    for r in sent[0]:
        sizes.setdefault((r.shard, r.batch), []).append(len(r.line) + 1)
    assert all(len(s) <= 3 and sum(s) <= 60 for s in sizes.values())
