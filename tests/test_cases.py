"""Cases of single functions and operators as small tables."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tidewater.functions import channels as C
from tidewater.functions import numbers as N
from tidewater.functions import web as W
from tidewater.operators import assets, enrich, extract, graph, lists, metrics, queue, records, validation
from tidewater.sources import scans

UC = "UCabcdefghijklmnopqrst_-"


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", f(F.col("v"))).orderBy("i").collect()]


@pytest.mark.parametrize("lines, kept", [
    (["mychannel", "MyChannel"], ["MyChannel"]),
    (["MyChannel", '{"channel":"MyChannel","subs":1000}'], ['{"channel":"MyChannel","subs":1000}']),
    (["https://www.youtube.com/@MyChannel", "MyChannel"], ["MyChannel"]),
    (["https://www.youtube.com/@TideTables", "https://www.youtube.com/@TideTables/videos"], ["https://www.youtube.com/@TideTables"]),
    (["MyChannel,2026-04-01", "mychannel"], ["MyChannel,2026-04-01"]),
    (["A", "B", "a", "C", "b"], ["A", "B", "C"]),
    ([], []),
])
def test_dedupe(spark, lines, kept):
    df = spark.createDataFrame(list(enumerate(lines)), "pos int, value string")
    assert [r.value for r in lists.dedupe_preserving_case(df).orderBy("pos").collect()] == kept


def test_parse_line(spark):
    cases = {
        UC: (None, UC), UC.replace("UC", "uc", 1): (None, UC), "channel/" + UC: (None, UC), "https://m.youtube.com/channel/" + UC: (None, UC), "http://youtube.com/c/abc?x": ("abc", None),
        "https://www.youtube.com/user/u1/videos": ("u1", None), "@h": ("h", None), "h,extra": ("h", None), "id1\t@h2": ("h2", None), "# c": (None, None), "": (None, None), None: (None, None),
        "Display Name": (None, None), "https://example.org/x": (None, None), '{"channel":"j"}': ("j", None), '{"channel":5}': (None, None), "a....b": (None, None), "channel/name": ("name", None),
    }
    got = column(spark, list(cases), C.parse_channel_line)
    assert [(r.handle, r.channel_id) for r in got] == list(cases.values())


def test_numbers(spark):
    assert column(spark, ["1.2M subscribers", "12,345", "3K", "500", "x", None, "1.1M", "4.35M", ""], N.convert_count) == [1200000, 12345, 3000, 500, None, None, 1100000, 4350000, None]
    assert column(spark, ["1e3", "", "nan", "7.9", "inf", None], N.lenient_int) == [1000, None, None, 7, None, None]
    tiers = N.parse_tiers("4:1000000,12:100000,24:10000,48:0")
    assert column(spark, [5_000_000, 500_000, 50_000, 5_000, None, 0], lambda c: N.tier_for(c, tiers), "bigint") == [1, 2, 3, 4, 1, 4]
    with pytest.raises(ValueError):
        N.parse_tiers("1:10")


def test_errors_and_hosts(spark):
    assert column(spark, ["HTTP 429", "is offline.", "is offline", None, "PREMIERES soon"], W.error_reason) == ["rate_limit", "unavailable", "transient", "other", "premiere"]
    assert column(spark, ["http://u:p@127.0.0.1:8080", "socks5://proxy.example:1080", "http://[::1]:80", "", "127.0.0.1"], W.proxy_host) == ["127.0.0.1", "proxy.example", None, None, "127.0.0.1"]
    assert column(spark, ['a, "b c",d', 'x\\"y z', "", '"q'], W.split_quoted) == [["a", "b c", "d"], ['x"y', "z"], [], ["q"]]


def test_superseded(spark):
    base = spark.createDataFrame([("a", 0, 5), ("b", 0, 5), ("c", 1, 5), ("d", 0, 5), ("e", 0, 5)], "ident string, prefix_rank int, mtime long")
    up = spark.createDataFrame([("a", 0, 5), ("b", 0, 4), ("c", 0, 9), ("d", 1, 6)], "ident string, prefix_rank int, mtime long")
    assert {r.ident for r in assets.superseded(base, up).collect()} == {"a", "d"}
    assert {r.ident for r in assets.newer_uploaded(base, up).collect()} == set()


def test_fold_is_ordered(spark):
    def row(t, cid, subs, verified=False, handle="h"):
        return ("v", t, 0, cid, handle, verified, subs)

    schema = "video_id string, mtime long, seq long, channel_id string, channel_handle string, verified boolean, subscriber_count long"
    kept = lambda *rows: enrich.fold_mapping(spark.createDataFrame(list(rows), schema)).first()
    assert kept(row(1, "a", 100), row(2, "b", 50), row(3, "a", 10)).channel_id == "a"
    assert kept(row(1, "a", 100), row(2, "b", 5, True)).channel_id == "b"
    assert kept(row(1, "a", 100), row(2, "b", 5, handle="xVEVO")).channel_id == "b"
    assert kept(row(1, "a", 100), row(2, "b", 100)).channel_id == "a"
    assert kept(row(1, None, 100), row(2, None, 5)).subscriber_count == 5


def test_pack_batches_against_a_fold(spark):
    rng = random.Random(1)
    lines = [(i, "x" * rng.randint(0, 40)) for i in range(300)]
    got = records.pack_batches(spark.createDataFrame(lines, "id long, line string"), 3, 5, 90, "id", "id", "line").collect()
    sizes = dict(lines)
    for shard in range(3):
        batch = records_in = size = 0
        for r in sorted((r for r in got if r.shard == shard), key=lambda r: r.id):
            b = len(sizes[r.id]) + 1
            if records_in and (records_in >= 5 or size + b > 90):
                batch, records_in, size = batch + 1, 0, 0
            records_in, size = records_in + 1, size + b
            assert (r.batch, r.bytes) == (batch, b)
    assert len(got) == 300


def test_reconcile(spark):
    batch = spark.createDataFrame([(0, "a", "f0"), (1, "b", "f1"), (2, "c", "f2")], "idx int, content_id string, file string")
    res = spark.createDataFrame([("a", None, "success", None), (None, 1, "failed", "bad"), ("zz", None, "success", None)], "platform_content_id string, record_index int, status string, reason string")
    assert {(r.content_id, r.status) for r in records.reconcile(batch, res).collect()} == {("a", "success"), ("b", "failed"), ("c", "missing")}


def test_populate_is_sequential(spark):
    rows = [(0, "i1", "n1"), (1, "i1", "n2"), (2, "i2", "n2"), (3, "i3", "N1")]
    df = spark.createDataFrame(rows, "pos int, creator_id string, name string")
    none = df.limit(0)
    assert {r.pos for r in queue.populate(df, none, none, "pos").collect()} == {0, 2}
    assert {r.pos for r in queue.populate(df, none, none, "pos", ("name",)).collect()} == {0, 1}


def test_backoff_and_breaker(spark):
    df = spark.createDataFrame([(1, i, i, ok) for i, ok in enumerate([False] * 11 + [True, False])], "key int, event_id int, ts int, ok boolean")
    got = metrics.breaker(metrics.failure_runs(df)).orderBy("event_id").collect()
    assert [r.opens for r in got] == [0, 0, 0, 0, 1, 1, 1, 1, 1, 2, 2, 0, 0]
    assert [got[4].cooldown_s, got[9].cooldown_s] == [60.0, 120.0]
    assert column(spark, [1, 2, 3, 4, 9, 0], metrics.backoff, "int") == [60.0, 120.0, 240.0, 300.0, 300.0, 0.0]


def test_json_at_any_depth(spark):
    assert column(spark, ['{"a":[{"b":{"k":""}},{"k":[1]}]}', "broken", None], extract.json_find("k")) == ["[1]", None, None]


def test_schema_round_trip(spark):
    df = spark.createDataFrame([(1, "a", [1.5])], "n int, s string, f array<double>")
    schema = json.dumps(validation.infer_schema(df.schema) | {"required": ["n"]})
    docs = spark.createDataFrame([('{"n":1,"s":"a","f":[1.5]}',), ('{"s":"a"}',), ("[1]",), ('{"n":1,"f":["x"]}',)], "text string")
    assert [r.error for r in validation.validate(docs, schema).collect()] == [None, "<root>: 'n' is a required property", "<root>: is not of type object", "/f/0: is not of type number or null"]


def test_scan_of_mixed_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("videoId,title\nv1,t1\n")
    (tmp_path / "b.jsonl").write_text('{"video_id":"v2"}\n\nbroken\n')
    spark.createDataFrame([("v3",)], "id string").write.parquet(str(tmp_path / "c.parquet"))
    got = scans.read_dataset(spark, str(tmp_path))
    assert set(got.columns) == {"videoId", "title", "video_id", "id"} and got.filter("coalesce(videoId, video_id, id) is not null").count() == 3


def test_map_lines(spark):
    df = spark.createDataFrame([(0, "# c"), (1, "a,h1"), (2, "b"), (3, "a,h2,x")], "pos int, value string")
    assert {tuple(r) for r in scans.creator_map_lines(df).collect()} == {("a", "h2,x"), ("b", "b")}


def test_sinks(spark, tmp_path):
    from tidewater.sources import sinks

    m = spark.createDataFrame([("a", "Zed"), ("b", "abe")], "channel_id string, handle string")
    sinks.export_map(m, str(tmp_path / "map"))
    assert [r.value for r in spark.read.text(str(tmp_path / "map")).collect()] == ["b,abe", "a,Zed"]
    sinks.append_jsonl(m, str(tmp_path / "log"))
    sinks.append_jsonl(m, str(tmp_path / "log"))
    assert spark.read.json(str(tmp_path / "log")).count() == 4
    head = spark.createDataFrame([(0, "# h")], "pos int, value string")
    rows = spark.createDataFrame([(3, "b"), (2, "a")], "pos int, value string")
    assert not sinks.rewrite_list(head, rows, 2, str(tmp_path / "list")) and sinks.rewrite_list(head, rows, 3, str(tmp_path / "list"))
    assert [r.value for r in spark.read.text(str(tmp_path / "list")).collect()] == ["# h", "a", "b"]
    v = spark.createDataFrame([("v", "")], "video_id string, title string").withColumns({c: F.lit(None).cast("string") for c in ("channel_handle", "channel_id", "url", "embed_url", "description")})
    v = v.withColumns({c: F.lit(None).cast("int") for c in ("view_count", "like_count")}).withColumns({c: F.array().cast("array<string>") for c in ("thumbnails", "keywords", "tags")})
    sinks.import_videos(v.select("video_id", *[c for c in v.columns if c not in ("video_id", "keywords", "tags", "thumbnails")], "keywords", "tags", "thumbnails"), str(tmp_path / "videos"))
    assert spark.read.parquet(str(tmp_path / "videos")).first().classification == "below_bar"


def test_documents_and_filters(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 5, None)], "id int, view_count int, locale string")
    assert [r[0] for r in df.select(records.to_document(df, ("view_count",), ("locale",))).collect()] == ['{"id":1,"view_count":0,"locale":"x"}', '{"id":2,"view_count":5}']
    assert {r.id for r in records.delete_matching(df, {"id": 1, "locale": None}, "id").collect()} == {2}
    with pytest.raises(ValueError):
        records.matching(df, {}, cap=1)
    schema = '{"properties":{"id":{"note":"content"},"locale":{"note":"region"}}}'
    assert records.annotated(df, schema, "note").columns == ["content", "region"]
    with pytest.raises(ValueError):
        records.annotated(df, schema.replace("region", "content"), "note")


def test_absence_and_list_keep_many_tasks(spark, tmp_path):
    from tidewater.sources import sinks

    events = spark.createDataFrame([(k, f"2024-01-01 0{h}:10:00") for k in range(3) for h in (0, 2 + k)], "key long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the series may be many
    try:
        found = metrics.absent(events, events, "key")
        assert "_k#" not in found._jdf.queryExecution().toString()
        assert {(r.key, r.start.hour) for r in found.collect()} == {(k, h) for k in range(3) for h in range(5) if h not in (0, 2 + k)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    head = spark.createDataFrame([(0, "head")], "pos long, value string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sinks.rewrite_list(head, spark.range(1000).selectExpr("id pos", "'v' || id value"), 1001, str(tmp_path / "list"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "list").glob("part-*"))
    assert len(parts) > 1 and "".join(p.read_text() for p in parts).split() == ["head", *(f"v{k}" for k in range(1000))]


def test_batches_with_null_keys_are_decided(spark):
    rows = [(1, None, None), (2, None, None), (3, "a", None), (4, "a", "x"), (5, None, "X"), (6, "b", "x"), (7, "c", "y"), (8, "c", "z"), (9, None, "z"), (10, "B", None)]
    df = spark.createDataFrame(rows, "pos int, creator_id string, name string")
    seen, want = set(), []
    for pos, *keys in rows:
        own = {(k, v.lower()) for k, v in enumerate(keys) if v is not None}
        if not own & seen:
            seen |= own
            want.append(pos)
    assert sorted(r.pos for r in queue.first_of_batch(df, "pos").collect()) == want
    assert queue.first_of_batch(df.limit(0), "pos").count() == 0 and queue.first_of_batch(df, "pos", ("name",)).count() == 3 + 4


def test_fold_streams_one_hot_video(spark):
    n = 30_000
    links = spark.range(n).selectExpr("'v' AS video_id", "concat('c', CAST(id % 3 AS STRING)) AS channel_id", "'h' AS channel_handle", "false AS verified", "id AS subscriber_count", "id AS mtime", "0L AS seq")
    r = enrich.fold_mapping(links).collect()
    assert [(x.channel_id, x.subscriber_count, x.collisions) for x in r] == [(f"c{(n - 1) % 3}", n - 1, n - 1)]
    odd = spark.createDataFrame([("a", None, None, None, None, 1, 0), ("a", None, None, None, 5, 2, 0), ("a", "c", "xVevo", None, 1, 3, 0), (None, "c", "h", True, 1, 1, 0)], "video_id string, channel_id string, channel_handle string, verified boolean, subscriber_count long, mtime long, seq long")
    assert {(x.video_id, x.channel_id, x.subscriber_count, x.collisions) for x in enrich.fold_mapping(odd).collect()} == {("a", "c", 1, 1), (None, "c", 1, 0)}
    assert enrich.fold_mapping(odd.limit(0)).count() == 0


def test_discovery_has_no_depth_limit(spark):
    edges = spark.createDataFrame([(f"c{k}", f"c{k + 1}", None) for k in range(25)], "src string, dst string, subs long")
    start, none = spark.createDataFrame([("c0",)], "channel string"), spark.createDataFrame([], "channel string")
    assert graph.discover(edges, start, none).agg(F.max("depth")).first()[0] == 25
    assert graph.discover(edges, start, none, max_depth=3).count() == 4


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    lines = [f"line {k} " + "x" * (k % 50) for k in range(20_000)]
    (tmp_path / "list.txt").write_bytes(("\r\n".join(lines) + "\n").encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = scans.read_lines(spark, str(tmp_path / "list.txt")).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.value for r in got] == lines and [r.pos for r in got] == list(range(20_000))


def test_artefacts_and_documents(spark, tmp_path):
    ids = spark.createDataFrame([("aaaaaaaaaaa",), ("bbbbbbbbbbb",), ("ccccccccccc",)], "video_id string")
    names = spark.createDataFrame([("video-dlp-aaaaaaaaaaa.json.br",), ("video-min-aaaaaaaaaaa.json.br",), ("bbbbbbbbbbb",), ("video-min-x.txt",)], "name string")
    assert {(r.video_id, r.artefact) for r in assets.existing_artefact(ids, names).collect()} == {("aaaaaaaaaaa", "video-min-aaaaaaaaaaa.json.br"), ("bbbbbbbbbbb", "bbbbbbbbbbb")}
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.json").write_text('{"k":\n1}')
    (tmp_path / "deep/b.txt").write_text("no")
    got = {r.path.rsplit("/", 1)[1]: (r.text, r.error) for r in scans.read_documents(spark, str(tmp_path)).collect()}
    assert got == {"a.json": ('{"k":\n1}', None), "b.txt": (None, "unsupported file extension")}



def test_schema_order_types_and_refusals(spark):
    from tidewater.operators import validation as V

    def errors(schema, *texts, **more):
        df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string").withColumn("x", F.lit(1))
        return [r.error for r in V.validate(df, schema, **more).orderBy("k").collect()]

    # the first violation follows the schema's own order of keywords
    two = '{"properties":{"a":{"type":"string"}},"required":["b"]}'
    assert errors(two, '{"a":1}', '{"a":"x"}', '{"a":"x","b":1}', "[]", None, "{") == ["/a: is not of type string", "<root>: 'b' is a required property", None, None, "<root>: is not JSON", "<root>: is not JSON"]
    assert errors('{"required":["b"],"properties":{"a":{"type":"string"}}}', '{"a":1}') == ["<root>: 'b' is a required property"]
    assert errors('{"type":"integer"}', "5.0", "5.5", "true", "1e2", '"5"') == [None, "<root>: is not of type integer", "<root>: is not of type integer", None, "<root>: is not of type integer"]
    assert errors('{"enum":[1,"a",true,null,{"x":[1]}]}', "1.0", '"1"', '"a"', "true", "null", '{"x":[1]}', "false") == [None, "<root>: is not one of the allowed values", None, None, None, None, "<root>: is not one of the allowed values"]
    assert errors('{"minimum":3,"pattern":"^a"}', "2", '"b"', '"ab"', "{}") == ["<root>: is less than the minimum of 3", "<root>: does not match its pattern", None, None]
    deep = '{"items":{"items":{"properties":{"k":{"items":{"not":{"const":0}}}}}}}'
    assert errors(deep, '[[],[{"k":[1]},{"k":[2,0]}]]', "[[{}]]", "[]", "7") == ["/1/1/k/1: should not be valid under the given schema", None, None, None]
    assert errors('{"patternProperties":{"^n":{"type":"number"}},"additionalProperties":false}', '{"n1":1}', '{"n1":"x"}', '{"m":1}') == [None, "/n1: is not of type number", "<root>: has additional properties"]
    assert errors('{"oneOf":[{"minimum":1},{"maximum":5}]}', "3", "7") == ["<root>: is valid under several of the given schemas", None]
    assert errors('{"format":"uri"}', '"no"') == ["<root>: is not a 'uri'"] and errors('{"format":"uri"}', '"no"', formats=False) == [None]
    for bad in ('{"$ref":"#/$defs/a","$defs":{"a":{"items":{"$ref":"#/$defs/a"}}}}', '{"if":{}}'):
        with pytest.raises(ValueError):
            errors(bad, "1")


def test_networks_of_both_versions(spark):
    import ipaddress

    from tidewater.operators import records as R

    configured = ["not-a-cidr", " 65.181.160.0/21 ", "10.1.2.3/8", "95.99.200.234", "10.0.0.0/255.255.0.0", "2001:db8::/32", "2001:db8:1::/48", "::ffff:1.2.3.0/120", "1.2.3.4/40", "fe80::1/200", "1.2.3.4/8/9", "0.0.0.0/0", "300.1.1.1/8", "01.2.3.4/8"]
    asked = [None, "none", "65.181.160.5", "65.181.168.0", "10.255.0.1", "95.99.200.234", "95.99.200.235", "proxy.example", "2001:db8:1::7", "2001:0DB8:ffff:0:0:0:0:1", "2001:db9::", "::ffff:1.2.3.9", "::ffff:102:309", "::", "1::2::3", ":::", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "12345::", "256.1.1.1", "01.2.3.4", "", "1.2.3", "g::1"]
    nets = []
    for text in configured:
        try:
            nets.append(ipaddress.ip_network(text.strip(), strict=False))
        except ValueError:
            pass

    def plain(ip):
        if ip is None or ip == "none":
            return "none"
        try:
            a = ipaddress.ip_address(ip)
        except ValueError:
            return "other"
        return next((str(n) for n in nets if a.version == n.version and a in n), "other")

    df = spark.createDataFrame([(k, ip, "x") for k, ip in enumerate(asked)], "k int, ip string, network_name string")
    got = {r.k: r.network for r in R.network_of(df, "ip", configured).collect()}
    same = {"::ffff:1.2.3.0/120": "::ffff:102:300/120"}
    assert [same.get(got[k], got[k]) for k in range(len(asked))] == [same.get(plain(ip), plain(ip)) for ip in asked]
    assert R.network_of(df, "ip", []).filter("network = 'other'").count() == len(asked) - 2
    plan = R.networks_of(df, "ip", spark.range(10).select(F.col("id").alias("order"), F.lit("1.2.3.4/8").alias("cidr")))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_networks_are_swept_once(spark):
    """Nested ranges of every length against all pairs; what is shuffled does not grow with the number of lengths."""
    import ipaddress

    from tidewater.operators import records as R

    rng = random.Random(7)
    four = lambda: ".".join(str(rng.choice((10, 77, rng.randrange(256)))) for _ in range(4))
    six = lambda: "2001:db8:" + ":".join(f"{rng.choice((1, 2, rng.randrange(65536))):x}" for _ in range(6))
    configured = [f"10.77.10.77/{n}" for n in range(33)] + [f"2001:db8:1:2:1:2:1:2/{n}" for n in range(1, 129)] + [f"{four()}/{rng.randrange(6, 33)}" for _ in range(200)] + [f"{six()}/{rng.randrange(30, 129)}" for _ in range(200)]
    rng.shuffle(configured)
    nets = [ipaddress.ip_network(n, strict=False) for n in configured]
    asked = sorted({four() for _ in range(1500)} | {six() for _ in range(500)})

    def written():
        executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
        return sum(executors.apply(k).totalShuffleWrite() for k in range(executors.size()))

    df = spark.createDataFrame(list(enumerate(asked)), "k int, ip string")
    listed = spark.createDataFrame([(None if k == 0 else str(k).zfill(4), n) for k, n in enumerate(configured)], "order string, cidr string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = written()
        got = {r.ip: r.network for r in R.networks_of(df, "ip", listed).collect()}
        took = written() - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    for ip in asked:
        a = ipaddress.ip_address(ip)
        want = next((n for n in nets if a.version == n.version and a in n), None)
        assert want == (None if got[ip] == "other" else ipaddress.ip_network(got[ip], strict=False))
    assert 0 < took < 1_000_000


def test_chains_of_rivals(spark, monkeypatch):
    from tidewater.operators import graph as G

    def plain(rows):
        names, ids, kept = set(), set(), []
        for n, i, name in sorted(rows):
            mine = ({i.lower()} if i is not None else set(), {name.lower()} if name is not None else set())
            if not (mine[0] & ids or mine[1] & names):
                kept.append(n)
                ids |= mine[0]
                names |= mine[1]
        return kept

    chain = [(k, f"I{(k + 1) // 2}", f"n{k // 2}") for k in range(3000)]
    rng = random.Random(5)
    mixed = [(20_000 + k, rng.choice(["x", "Y", None]) if k % 3 == 0 else f"j{rng.randrange(200)}", rng.choice([None, "hot", f"m{rng.randrange(150)}"])) for k in range(600)]
    rows = chain + mixed
    seen = []
    real = G.checkpointed
    monkeypatch.setattr(G, "checkpointed", lambda df: seen.append(1) or real(df))
    df = spark.createDataFrame(rows, "n long, creator_id string, name string").repartition(4)
    assert sorted(r.n for r in queue.first_of_batch(df, "n").collect()) == plain(rows)
    assert len(seen) <= 1 + 2 * 16


@pytest.mark.parametrize("long", [40, 700])
def test_long_logs_fold_in_segments(spark, long):
    rng = random.Random(long)
    rows = []
    for k in range(3000):
        video = rng.choice(["hot", "hot", "warm", f"v{rng.randrange(60)}", None])
        channel = rng.choice([None, "A", "B", f"c{rng.randrange(40)}", f"c{k}"])
        rows.append((video, channel, rng.choice([None, "x", "yVEVO"]) if k % 50 == 0 else "x", rng.random() < 0.01, rng.choice([None, 5, rng.randrange(1000)]), rng.randrange(900), 0))
    rows += [("rise", f"r{k}", "x", False, k, k, 0) for k in range(800)] + [("flat", f"f{k % 90}", "x", False, 7, k, 0) for k in range(800)] + [("one", "A", "x", False, k % 7, k, 0) for k in range(800)]
    rows += [("same", "A", "x", False, 1, 5, 0)] * 300 + [("same", "B", "x", False, 9, 5, 0)] * 500 + [("fall", f"d{k % 3}", "x", k < 3, 1000 - k, k, 0) for k in range(800)]
    schema = "video_id string, channel_id string, channel_handle string, verified boolean, subscriber_count long, mtime long, seq long"
    df = spark.createDataFrame(rows, schema).repartition(5)
    want = sorted(map(repr, enrich.fold_mapping(df, long=10**6).collect()))
    assert sorted(map(repr, enrich.fold_mapping(df, long=long).collect())) == want and len(want) > 60


def test_channel_urls_by_their_parts(spark):
    uc = "UC" + "a1_-" * 5 + "zz"
    cases = {
        "https://www.youtube.com/@Chan.x": "Chan.x", "HTTP://M.YouTube.com/@a/videos?x=1#y": "a", "https://youtube.com/c/Name/": "Name", "https://music.youtube.com/User/me?x": "me", f"https://youtube.com/channel/{uc}": uc,
        f"https://youtube.com/Channel/{uc.lower()}/about": uc.lower(), "https://youtube.com/@a?next=/@b": "a", "https://youtube.com/@": None, "https://youtube.com/@a b": None, "https://youtube.com/c/": None, "https://youtube.com/c": None,
        "https://youtube.com/channel/UCshort": None, "https://youtube.com/watch?v=1": None, "https://youtube.com?x=/@a": None, "https://youtube.com.evil/@a": None, "https://evil/youtube.com/@a": None, "ftp://youtube.com/@a": None, "youtube.com/@a": None,
        "https://youtube.com:443/@a": None, "see https://youtube.com/@a": None, "": None, f"https://youtube.com/channel/{uc}x": None, "https://youtube.com/playlist/c/x": None, "https://youtube.com//@a": None,
    }
    df = spark.createDataFrame(list(cases.items()), "url string, want string")
    assert df.select("url", "want", C.url_canonical(F.col("url")).alias("got")).filter("not (want <=> got)").collect() == []
