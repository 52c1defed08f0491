"""Readers, sinks and small functions on what the driver tables don't hold."""

import datetime

import pytest
from pyspark.sql import functions as F

from evalspark.functions import values as V
from evalspark.sources import readers, sinks


def test_broken_blank_and_null_lines_are_left_out(spark):
    lines = spark.createDataFrame([('{"metric_name": "m", "value": 1.5}',), ('{"metric_name": "m"}',), ("{no",), ("  ",), (None,), ("[1]",)], "value string")
    found = readers.metric_rows(lines).collect()
    assert [(r["metric_name"], r["value"], r["processor_version"], r["aggregation_mask"], r["timestamp"]) for r in found] == [("m", 1.5, "1.0.0", 1, None)]
    assert readers.event_log(lines.where("false")).count() == 0


def test_times_of_several_forms(spark):
    texts = ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05.000000+00:00", "2024-01-02 03:04:05", "2024-01-02 03:04:05,000", "1704164645", "soon", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.unix_timestamp(readers.when(F.col("t"))).alias("u"))
    assert [r["u"] for r in df.collect()] == [1704164645] * 5 + [None, None]


def test_directory_by_extension(spark, tmp_path):
    (tmp_path / "a").mkdir()
    for name in ("a/x.PNG", "y.png", "z.txt", "none"):
        (tmp_path / name).write_bytes(b"12345")
    found = readers.directory(spark, str(tmp_path), [".png"], content=True)
    assert sorted(r["path"].rsplit("/", 1)[1] for r in found.collect()) == ["x.PNG", "y.png"]
    assert {bytes(r["content"]) for r in found.collect()} == {b"12345"}


def test_changed_and_ready_files(spark):
    t = datetime.datetime(2024, 1, 1)
    now = spark.createDataFrame([("old", t, 1), ("new", t, 1), ("touched", t + datetime.timedelta(hours=1), 1)], "path string, mtime timestamp, length long")
    seen = spark.createDataFrame([("old", t), ("old", t), ("touched", t)], "path string, mtime timestamp")
    assert {r["path"] for r in readers.changed_files(now, seen).collect()} == {"new", "touched"}
    at = F.lit(t + datetime.timedelta(hours=1, seconds=10))
    assert {r["path"] for r in readers.ready_files(now, now, at, 60).collect()} == {"old", "new"}
    assert readers.ready_files(now.withColumn("length", F.lit(2).cast("long")), now, at, 0).count() == 0


def test_routes_need_their_keys(spark):
    r = readers.routes(spark, '[a]\npath = "/in/a"\nalgorithm = "x"\nversion = 2\n[a.settings]\nk = 3\n').first()
    assert (r["directory_key"], r["version"], r["settings"]) == ("a", "2", {"k": "3"})
    with pytest.raises(ValueError, match="algorithm, version"):
        readers.routes(spark, '[a]\npath = "/in/a"\n')


def test_audit_copy_names_its_topic_and_key(spark):
    df = spark.createDataFrame([(1, "k"), (2, None)], "a long, k string")
    rows = sinks.with_audit_copy(sinks.topic_records(df, "t", F.col("k"), ["a"]), "audit").collect()
    assert len(rows) == 4
    headers = [{h["key"]: bytes(h["value"]).decode() for h in r["headers"]} for r in rows if r["topic"] == "audit"]
    assert headers == [{"content-type": "application/json", "source-topic": "t", "source-key": k} for k in ("k", "")]


def test_correlation_id_and_signature(spark):
    df = spark.createDataFrame([([("X-CORRELATION-ID", bytearray(b"c"))],), ([],), (None,)], "h array<struct<key:string,value:binary>>")
    ids = [r["i"] for r in df.select(V.correlation_id(F.col("h")).alias("i")).collect()]
    assert ids[0] == "c" and all(len(i) == 36 for i in ids[1:])
    s = spark.range(1).select(V.signature(F.lit("a"), F.lit(None).cast("string"), "k").alias("s"), V.signature(F.lit("a"), F.lit("b"), "k").alias("t")).first()
    assert s["s"] != s["t"]
