"""User analyzers over batches of a group, directory streams and late rows, against plain Python."""

import collections
import json
import os
import random
import sys
import time

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from evalspark.operators import analyzers, dispatch
from evalspark.sources import readers
from evalspark.streaming import streams

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests


class Spread:
    """The span of a column and how many batches it came in."""

    columns, summary = ["num", "label"], "low double, high double, labels bigint"

    def start(self):
        return (None, None, frozenset())

    def add(self, state, rows):
        low, high, labels = state
        ends = pc.min_max(rows.column("num")).as_py()
        some = [v for v in (low, ends["min"]) if v is not None], [v for v in (high, ends["max"]) if v is not None]
        return (min(some[0], default=None), max(some[1], default=None), labels | set(rows.column("label").drop_null().to_pylist()))

    def result(self, state):
        return {"low": state[0], "high": state[1], "labels": len(state[2])}


class Merged(Spread):
    def merge(self, a, b):
        low, high = [v for v in (a[0], b[0]) if v is not None], [v for v in (a[1], b[1]) if v is not None]
        return (min(low, default=None), max(high, default=None), a[2] | b[2])


class Batches:
    columns, summary = ["num"], "batches bigint, rows bigint, most bigint"

    def start(self):
        return (0, 0, 0)

    def add(self, state, rows):
        return (state[0] + 1, state[1] + rows.num_rows, max(state[2], rows.num_rows))

    def result(self, state):
        return dict(zip(("batches", "rows", "most"), state, strict=True))


def rows_of(n):
    r = random.Random(4)
    return [(r.choice(["hot"] * 8 + ["a", None]), r.choice([None, r.gauss(0, 5)]), r.choice(["x", "y", "z", None])) for _ in range(n)] + [("none", None, None)]


@pytest.mark.parametrize("kind", [Spread, Merged])
def test_user_analyzer_by_plain_python(spark, kind):
    rows = rows_of(3000)
    df = spark.createDataFrame(rows, "k string, num double, label string").withColumn("v0", F.lit("clash")).repartition(5)
    want = {}
    for k in {r[0] for r in rows}:
        v, labels = [r[1] for r in rows if r[0] == k and r[1] is not None], {r[2] for r in rows if r[0] == k and r[2]}
        want[k] = (min(v, default=None), max(v, default=None), len(labels))
    got = {r.k: (r.low, r.high, r.labels) for r in analyzers.grouped(kind())(df, ["k"]).collect()}
    assert got == want
    assert analyzers.grouped(kind())(df.limit(0), ["k"]).count() == 0


def test_a_group_larger_than_a_batch_in_the_dispatch(spark):
    """Registered under a bit of its own, it gets its rows in several batches and stands beside the others."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    analyzers.register("BATCHES", analyzers.grouped(Batches()), bit=512)
    try:
        df = spark.createDataFrame(rows_of(1000), "k string, num double, label string").withColumns({"aggregation_mask": F.lit(512 + 1), "passed": F.lit("yes"), "x": F.col("num"), "y": F.col("num"), "meta": F.lit("m")})
        out = {(r.k, r.type): json.loads(r.summary) for r in dispatch.by_mask(df, ["k"]).collect()}
        n = collections.Counter(r[0] for r in rows_of(1000))
        assert {k: out[k, "BATCHES"]["rows"] for k in n} == dict(n) and out["hot", "BATCHES"]["batches"] >= 8 and out["hot", "BATCHES"]["most"] <= 100
        assert ("hot", "STATS") in out
    finally:
        analyzers.ANALYZERS.pop("BATCHES"), analyzers.BITS.pop("BATCHES")
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_directory_as_a_stream(spark, tmp_path):
    """New, modified and unchanged files over several scans and restarts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    root, listings = tmp_path / "in", str(tmp_path / "listings")
    (root / "deep").mkdir(parents=True)
    schema = "path string, mtime timestamp, length long"

    def put(name, text, age):
        (root / name).write_text(text)
        os.utime(root / name, (time.time() - age, time.time() - age))

    def scan():
        readers.record_listing(spark, str(root), [".txt"], listings)
        out = []
        made = streams.changed_files(spark.readStream.schema(schema).parquet(listings))
        q = made.writeStream.foreachBatch(lambda b, _: out.extend(b.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return sorted((os.path.basename(r.path), r.state, r.length) for r in out)

    put("a.txt", "one", 500)
    put("deep/b.TXT", "two", 500)
    put("c.bin", "no", 500)
    assert scan() == [("a.txt", "new", 3), ("b.TXT", "new", 3)]
    put("d.txt", "4", 400)
    put("e.txt", "", 400)  # Spark's scan leaves empty files out
    put("a.txt", "changed", 300)
    assert scan() == [("a.txt", "modified", 7), ("d.txt", "new", 1)]
    assert scan() == []
    put("deep/b.TXT", "again!", 100)
    assert scan() == [("b.TXT", "modified", 6)]


def test_late_rows_update_their_window_or_leave_by_the_side(spark, tmp_path):
    rng = random.Random(9)
    schema = "processor_name string, processor_version string, metric_name string, num double, ts timestamp"
    batches, base = [], 1_704_067_200
    for b in range(5):
        batches.append([("p", "1", rng.choice("mn"), float(rng.randrange(9)), base + b * 100 + rng.randrange(-260, 60)) for _ in range(60)])
    batches[2].append(("p", "1", "m", None, base + 1))
    want, late, mark = collections.defaultdict(list), [], None
    for rows in batches:
        for r in rows:
            if r[3] is None:
                continue
            start = r[4] // 60 * 60
            if mark is not None and start + 60 + 60 <= mark - 10:
                late.append((r[2], r[3], r[4]))
            else:
                want[r[2], start].append(r[3])
        mark = max(x for x in (mark, *(r[4] for r in rows if r[3] is not None)) if x is not None)
    path = str(tmp_path / "out")
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema.replace("ts timestamp", "at long")).select("*", F.timestamp_seconds("at").alias("ts")).drop("at")
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        streams.windows_with_late_rows(stream, path, str(tmp_path / "c")).awaitTermination(120)
    got = {(r.metric_name, r.window_start_unix): (r["count"], r["sum"], r["min"], r["max"]) for r in streams.open_windows(spark, path).collect()}
    assert got == {k: (len(v), sum(v), min(v), max(v)) for k, v in want.items()}
    side = spark.read.parquet(f"{path}/late").select("metric_name", "num", F.unix_timestamp("ts")).collect()
    assert sorted(tuple(r) for r in side) == sorted(late) and len(late) > 5
    assert any(r.updates > 1 for r in streams.open_windows(spark, path).collect())
