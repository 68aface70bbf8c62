"""Kept tables and listings by executors."""

import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators import enrich
from tidewater.sources import listing, scans
from tidewater.sources.kept import KeptTable


def links(spark, rows):
    return spark.createDataFrame(rows, "video_id string, channel_id string, channel_handle string, verified boolean, subscriber_count long, mtime long, seq long")


def test_incremental_equals_full_and_leaves_other_buckets(spark, tmp_path):
    rows = [(f"v{k % 50}", f"c{k * 7 % 9}", "aVEVO" if k % 11 == 0 else "a", k % 13 == 0, k * 37 % 100, k, 0) for k in range(400)]
    one, many = (KeptTable(spark, f"{tmp_path}/{n}", enrich.MAPPING, "video_id", 8) for n in ("one", "many"))
    assert many.mark() is None and many.rows().count() == 0
    enrich.refresh_mapping(one, links(spark, rows))
    for upto in (100, 250, 400, 400):
        enrich.refresh_mapping(many, links(spark, rows[:upto]))
    assert one.rows().exceptAll(many.rows()).isEmpty() and many.rows().count() == 50 and many.mark() == 399
    before = many.files()
    enrich.refresh_mapping(many, links(spark, [*rows, ("v3", "c100", "b", True, 5, 500, 0)]))
    after = many.files()
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit("v3")), F.lit(8)).cast("int")).first()[0]
    assert {f.split("bucket=")[1][0] for f in before ^ after} == {str(bucket)} and len(before & after) >= 7
    assert many.rows().filter("video_id = 'v3'").first().channel_id == "c100" and many.mark() == 500


def test_a_refresh_works_its_links_out_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def named(video):
        made.add(1)
        return video

    table = KeptTable(spark, f"{tmp_path}/once", enrich.MAPPING, "video_id", 4)
    rows = [(f"v{k % 50}", f"c{k * 7 % 9}", "a", k % 13 == 0, k * 37 % 100, k, 0) for k in range(400)]
    enrich.refresh_mapping(table, links(spark, rows).withColumn("video_id", F.udf(named)("video_id")))
    assert made.value == 400 and table.rows().count() == 50 and table.mark() == 399


def test_a_failed_merge_changes_nothing_and_repeats(spark, tmp_path, monkeypatch):
    table = KeptTable(spark, f"{tmp_path}/t", "k string, v long", "k", 4)
    table.put_many(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long"))
    update = spark.createDataFrame([("a", 5, 1), ("a", 4, 2), ("c", 3, 1), (None, 9, 9)], "k string, v long, seq long")
    # the run dies after the rows are written and before the new version's own row is
    with monkeypatch.context() as m:
        real = type(spark).createDataFrame
        m.setattr(type(spark), "createDataFrame", lambda self, data, schema=None, *a: (_ for _ in ()).throw(OSError("lost")) if "places" in str(schema) else real(self, data, schema, *a))
        with pytest.raises(OSError):
            table.put_many(update, "seq")
    assert sorted(map(tuple, table.rows().collect())) == [("a", 1), ("b", 2)]
    assert table.put_many(update, "seq") == 2
    assert sorted(map(tuple, table.rows().collect())) == [("a", 4), ("b", 2), ("c", 3)]
    asked = spark.createDataFrame([("a",), ("x",)], "k string")
    assert {r.k: r.member for r in table.contains(asked).collect()} == {"a": True, "x": False}
    table.merge(update.limit(0).select("k", "v"), lambda old, delta: old, mark=7)
    table.merge(spark.createDataFrame([("a", 0)], "k string, v long"), lambda old, delta: old.join(delta, "k", "left_anti"))  # a fold can delete
    table.clean()
    assert sorted(map(tuple, table.rows().collect())) == [("b", 2), ("c", 3)] and table.mark() == 7
    with pytest.raises(ValueError):
        KeptTable(spark, f"{tmp_path}/t", "k string, v long", "k", 5).rows()


@pytest.mark.parametrize("levels", [0, 1, 3])
def test_listing_by_executors(spark, tmp_path, levels):
    for at in ("video-dlp-a.json", "uploaded/video-dlp-b.json", "x/y/video-dlp-c.json", "x/y/z/uploaded/video-min-d.json", "x/notes.txt"):
        os.makedirs(tmp_path / os.path.dirname(at), exist_ok=True)
        (tmp_path / at).write_text("{}")
        os.utime(tmp_path / at, (1000 + len(at), 1000 + len(at)))
    os.makedirs(tmp_path / "empty")
    want = sorted(map(tuple, scans.list_assets(spark, str(tmp_path), "video-", ".json").collect()))
    assert sorted(map(tuple, listing.list_files(spark, str(tmp_path), "video-", ".json", levels=levels).collect())) == want and len(want) == 4
    first, mark = listing.list_new(spark, str(tmp_path), 1020.0, levels=levels)
    assert mark == 1031.0 and {r.name for r in first.collect()} == {"video-dlp-b.json", "video-min-d.json"}
    again, mark = listing.list_new(spark, f"file://{tmp_path}", mark, levels=levels)
    assert again.count() == 0 and mark == 1031.0
