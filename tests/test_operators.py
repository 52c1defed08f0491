"""Rules that the driver tables don't reach: nulls, non-finite numbers, ties, small groups, streams."""

import datetime
import json

from pyspark.sql import functions as F

from evalspark.functions import values as V
from evalspark.operators import analyzers, audit, catalog, lifecycle, processors, windows
from evalspark.streaming import streams


def one(df):
    return df.collect()[0]


def numbers(spark, xs):
    return spark.createDataFrame([("g", x) for x in xs], "g string, num double")


def test_stats_counts_what_is_not_finite_as_missing(spark):
    r = one(analyzers.stats(numbers(spark, [None, 8.0, float("nan"), -4.0, float("-inf"), 5.0, float("inf"), 7.0]), ["g"]))
    assert (r["count"], r["missing"], r["mean"], r["median"]) == (4, 4, 4.0, 6.0)
    assert one(analyzers.stats(numbers(spark, [42.0]), ["g"]))["std"] == 0.0


def test_histogram_of_one_value_has_a_range(spark):
    h = analyzers.histogram(numbers(spark, [2.0, 2.0]), ["g"], 4).orderBy("bin").collect()
    assert [r["n"] for r in h] == [0, 0, 2, 0] and (h[0]["low"], h[-1]["high"]) == (1.5, 2.5)


def test_outliers_need_four_values(spark):
    assert one(analyzers.outliers(numbers(spark, [1.0, 2.0, 900.0]), ["g"]))["outlier_count"] == 0
    assert one(analyzers.outliers(numbers(spark, [1.0, 2.0, 3.0, 4.0, 900.0]), ["g"]))["outlier_count"] == 1


def test_rate_of_words(spark):
    df = spark.createDataFrame([("g", w) for w in ("\tOK\n", "fail", "T", "maybe", "pass ", "0", None, "1")], "g string, w string")
    r = one(analyzers.rate(df, ["g"], "w"))
    assert (r["yes"], r["no"], r["missing"]) == (4, 2, 2) and abs(r["rate"] - 4 / 6) < 1e-12


def test_full_summary_of_no_numbers(spark):
    t = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([("p", "1", "m", None, t, 1, 1)], "processor_name string, processor_version string, metric_name string, num double, ts timestamp, event_id long, aggregation_mask int")
    r = one(windows.full_summary(df, "60 seconds"))
    assert (r["count"], r["numeric_count"], r["sum"], r["mean"], r["std"], r["median"], r["p95"]) == (1, 0, 0.0, 0.0, 0.0, None, None)


def test_typed_values_keep_kinds_apart(spark):
    raws = ["true", '"true"', "1", "1.5", "null", "[1, 2]", '{"x": 1, "y": 2}', '{"a": 1}', "NaN", "{no", None]
    kinds = [r["kind"] for r in spark.createDataFrame([(r,) for r in raws], "raw string").select(V.typed(F.col("raw"))["kind"].alias("kind")).collect()]
    assert kinds == ["bool", "string", "number", "number", "null", "array", "point", "object", "string", None, None]


def test_processor_failures_stay_with_their_row(spark):
    class Sizes:
        name, version = "sizes", "1"

        def initialize(self, settings):
            self.unit = settings["unit"]

        def run(self, content, settings):
            return {"size": (len(content) / self.unit, 1)}

    df = spark.createDataFrame([(1, bytearray(b"abcd")), (2, None)], "task_id long, content binary")
    got = {r["task_id"]: r for r in processors.run_processor(df, Sizes, {"unit": 2}).collect()}
    assert got[1]["value"] == 2.0 and got[1]["error"] is None and got[2]["error"].startswith("TypeError")


def test_streamed_windows_match_the_batch(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    frame = spark.read.parquet(src).select(F.col("event_type").alias("processor_name"), F.lit("1").alias("processor_version"), F.lit("value").alias("metric_name"), F.col("value").alias("num"), F.col("ts").cast("timestamp").alias("ts"))
    frame.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "in"))
    q = streams.windowed_summary(stream, "1 day").writeStream.format("memory").queryName("streamed").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {(r["processor_name"], r["window_start_unix"]): r["count"] for r in spark.table("streamed").collect()}
    want = {(r["processor_name"], r["w"]): r["count"] for r in frame.groupBy("processor_name", F.unix_timestamp(F.window("ts", "1 day")["start"]).alias("w")).count().collect()}
    last = max(w for _, w in want)
    assert got == {k: n for k, n in want.items() if k[1] < last}


def test_chain_hashes_tell_fields_apart(spark):
    rows = [(1, 1, "z", 'x, "role": y'), (2, 1, 'y, "role": z', "x"), (3, 1, 'a"b', "line\n"), (4, 1, 'a', '"b')]
    built = audit.build(spark.createDataFrame(rows, "source_id long, seq long, role string, body string"))
    assert built.select("content_hash").distinct().count() == 4


def test_points_of_every_form(spark):
    forms = {"[1, 2.5]": (1.0, 2.5), '{"x": 1, "y": 2}': (1.0, 2.0), '{"xy": [3, 4]}': (3.0, 4.0), '{"x": 1}': None, "[1]": None, "[1, 2, 3]": None, '"a"': None, "junk": None}
    got = {r.raw: r.p and tuple(r.p) for r in spark.createDataFrame([(f,) for f in forms], "raw string").withColumn("p", V.point(F.col("raw"))).collect()}
    assert got == forms


def test_content_kinds_and_keys(spark):
    rows = [("image/png", "{", "image"), (None, '{"a": 1}', "json"), (None, "{broken", "binary"), ("text/plain", '{"a": 1}', "binary"), ("application/json", "oops", "binary"), (None, "", "binary")]
    df = spark.createDataFrame(rows, "mime string, content string, want string").withColumn("kind", V.content_kind(F.col("mime"), F.col("content")))
    assert [r.kind for r in df.collect()] == [r[2] for r in rows]
    key = lambda n: one(spark.range(1).select(V.shard_key(F.lit("abcdef0123"), n).alias("k"))).k
    assert key(1) == key(4) == key(99) == "ab/cd/abcdef0123" and key(3) == "ab/abcdef0123"


def test_text_behind_a_value_is_no_json(spark):
    whole = ["{}", " 1 ", "[1, 2]", '{"a": 1, "a": 2}', '"x"', "null", "NaN"]
    broken = ["4754 Ieein", "{} x", "[1] [2]", '"a" b', "1, 2", "{}, 0] x", "{},1] x", "null, 0", "],[0", "[1", "'a'", "", None]
    df = spark.createDataFrame([(t,) for t in whole + broken], "t string")
    r = df.select("t", V.whole_json(F.col("t")).alias("whole"), V.content_kind(F.lit("application/json"), F.col("t")).alias("kind"), V.document_facts(F.col("t"))["kind"].alias("facts"), V.typed(F.col("t"))["kind"].alias("typed")).collect()
    assert [x.whole for x in r] == [True] * len(whole) + [False] * len(broken)
    assert [x.kind for x in r] == ["json"] * len(whole) + ["binary"] * len(broken)
    assert [x.facts for x in r] == ["object", "scalar", "array", "object", "scalar", "scalar", "scalar", *["invalid"] * (len(broken) - 1), None]
    assert not [x.typed for x in r[len(whole) :] if x.typed]
    dead = lifecycle.dead_letters(df.withColumn("kind", F.lit("k")), "t", "kind", ["k"]).collect()
    assert sorted(map(str, (x.t for x in dead))) == sorted(map(str, broken))
    assert one(spark.range(1).select(V.point(F.lit("[1, 2] x")).alias("p"))).p is None


def test_outliers_deal_no_group_to_one_task(spark):
    """The rows meet their bounds where they lie, and those of a null key do so too."""
    rows = [(k, float(v)) for k in ("a", None) for v in [*range(20), 3, 3, 900, 900, -700]] + [("few", 1.0), ("few", 900.0), ("a", float("nan")), ("a", None)]
    out = analyzers.outliers(spark.createDataFrame(rows, "k string, num double"), ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    got = {r.k: (r["count"], r.outlier_count) for r in out.collect()}
    assert got == {"a": (25, 3), None: (25, 3), "few": (2, 0)}


def test_registries_refuse_duplicates():
    registry = processors.Registry()
    kind = type("P", (), {"name": "p", "version": "1"})
    assert registry.add(kind) is kind
    for again in (lambda: registry.add(type("Q", (), {"name": "p", "version": "1"})), lambda: analyzers.register("STATS", analyzers.stats)):
        try:
            again()
        except ValueError:
            continue
        raise AssertionError("a duplicate was taken")


def _streamed(spark, tmp_path, batches, schema, make, mode):
    """The rows that a stream gives, batch by batch; it is stopped and started again between files."""
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    got = []
    keep = lambda df, n: got.append([tuple(r) for r in df.collect()])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        make(source).writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination(120)
    return got


def test_late_rows_leave_at_the_watermark(spark, tmp_path):
    at = lambda m, s=0: datetime.datetime(2024, 1, 1, 0, m, s)
    schema = "processor_name string, processor_version string, metric_name string, num double, ts timestamp"
    row = lambda v, t: ("p", "1", "m", float(v), t)
    batches = [[row(1, at(0, 5)), row(2, at(0, 50))], [row(3, at(5))], [row(100, at(0, 30))], [row(4, at(10))]]
    got = [r for b in _streamed(spark, tmp_path, batches, schema, lambda s: streams.windowed_summary(s, "60 seconds", "10 seconds"), "append") for r in b]
    first = [r for r in got if r[3] == int(at(0).replace(tzinfo=datetime.UTC).timestamp())]
    assert [(r[4], r[5]) for r in first] == [(2, 3.0)]  # the row of 100 came after its window had closed


def test_payloads_meta_and_other_types(spark):
    rows = [("METRIC_EMITTED", "t1", {"k": "v"}), ("METRIC_EMITTED", "t2", None), ("ELSE", "t3", None), (None, "t4", None)]
    df = spark.createDataFrame(rows, "event_type string, task_id string, meta map<string,string>")
    got = {r.task_id: r.payload for r in lifecycle.with_payload(df).collect()}
    assert json.loads(got["t1"])["meta"] == {"k": "v"} and json.loads(got["t2"])["meta"] == {}
    assert json.loads(got["t1"])["metric_name"] is None and got["t3"] is None and got["t4"] is None


def test_dead_letters_of_nulls(spark):
    df = spark.createDataFrame([(1, "{}", "a"), (2, None, "a"), (3, "1", None), (4, "{", "b"), (5, "[]", "b")], "id int, raw string, kind string")
    got = {r.id: r.reason for r in lifecycle.dead_letters(df, "raw", "kind", ["a"]).collect()}
    assert got == {2: "unparseable", 3: "unknown_type", 4: "unparseable", 5: "unknown_type"}


def test_detail_of_an_empty_catalogue(spark):
    columns = "processor_name string, processor_version string, metric_name string, window_end_unix long, aggregation_mask int, count long, sum double, mean double, min double, max double, std double, median double, p95 double, p99 double"
    row = catalog.metric_detail(spark.createDataFrame([], columns), "m", "p").collect()
    assert len(row) == 1 and row[0]["no_data"] and row[0]["processor_name"] == "p" and row[0]["count"] == 0
