"""Stateful streams, stopped and started again between batches, against their batch twins and plain Python."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from evalspark.operators import audit, lifecycle
from evalspark.sources import sinks
from evalspark.streaming import streams

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
UNIX = int(T0.timestamp())
EVENTS = "task_id long, event_type string, ts timestamp, directory_key string, processor_name string, duration_ms double, error string"


@pytest.fixture(autouse=True)
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Streamed:
    """A stream over a folder: each call adds a file, starts the query anew from its checkpoint and gives what it wrote."""

    def __init__(self, spark, path, schema, make):
        self.spark, self.path, self.schema, self.make, self.n = spark, path, schema, make, 0
        self.checkpoint = str(path / "checkpoint")

    def __call__(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(str(self.path / "in"))
        out = []
        write = lambda batch, _: out.extend(batch.collect())
        q = self.make(self.spark.readStream.schema(self.schema).parquet(str(self.path / "in"))).writeStream.foreachBatch(write)
        q.outputMode("append").option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start().awaitTermination(180)
        return out


def event(task, kind, second, **more):
    return (task, kind, T0 + dt.timedelta(seconds=second), more.get("dir"), more.get("proc"), more.get("ms"), more.get("error"))


def test_task_states_over_restarts_with_history_and_expiry(spark, tmp_path):
    run = Streamed(spark, tmp_path, EVENTS, lambda s: streams.task_states(s, cap=3, ttl=1000))
    first = run([event(1, "JOB_CREATED", 0, dir="a"), event(1, "TASK_STARTED", 1, proc="p"), event(2, "TASK_STARTED", 2, proc="p"), event(3, "TASK_CREATED", 3, dir="b"), event(3, "METRIC_EMITTED", 4)])
    got = {(r.task_id, r.events): r for r in first}
    assert set(got) == {(1, 1), (1, 2), (3, 1)}  # an event before the creation, and one of another type, are ignored
    assert got[1, 2].status == "started" and got[1, 2].directory_key == "a" and got[1, 2].processor_name == "p"
    second = run([event(1, "TASK_COMPLETED", 5, ms=2.5), event(1, "TASK_STARTED", 6, proc="q"), event(3, "TASK_FAILED", 7, error="bad")])
    got = {(r.task_id, r.events): r for r in second}
    assert set(got) == {(1, 3), (1, 4), (3, 2)} and got[3, 2].error == "bad" and got[3, 2].completed_at == UNIX + 7
    assert json.loads(got[1, 4].history) == [["TASK_STARTED", UNIX + 1], ["TASK_COMPLETED", UNIX + 5], ["TASK_STARTED", UNIX + 6]]
    assert got[1, 4].duration_ms == 2.5 and got[1, 4].created_at == UNIX
    out = run([event(9, "TASK_CREATED", 5000, dir="c")])
    late = run([event(9, "TASK_STARTED", 5001, proc="p"), event(1, "TASK_STARTED", 5002, proc="p")])
    assert {r.task_id: r.events for r in out + late if r.status == "expired"} == {1: 4, 3: 2}
    assert not [r for r in late if r.task_id == 1 and r.status != "expired"]  # forgotten: an event without a creation


def test_expired_tasks_are_told_once(spark, tmp_path):
    run = Streamed(spark, tmp_path, EVENTS, lambda s: streams.task_states(s, ttl=100))
    out = run([event(t, "TASK_CREATED", t) for t in range(5)]) + run([event(2, "TASK_STARTED", 90)]) + run([event(7, "TASK_CREATED", 150)]) + run([event(8, "TASK_CREATED", 151)])
    expired = sorted(r.task_id for r in out if r.status == "expired")
    assert expired == [0, 1, 3, 4]  # task 2 was heard of later
    out = run([event(8, "TASK_CREATED", 900)]) + run([event(8, "TASK_CREATED", 901)])
    assert sorted(r.task_id for r in out if r.status == "expired") == [2, 7]


def test_states_are_those_of_the_batch(spark, tmp_path):
    rng = random.Random(6)
    rows, at = [], 0
    for _ in range(300):
        at += rng.randrange(3)
        rows.append(event(rng.randrange(12), rng.choice(["TASK_STARTED", "TASK_COMPLETED", "TASK_FAILED"]), at, proc=rng.choice("pq"), ms=rng.random(), error="e"))
    rows = [event(t, "TASK_CREATED", 0, dir=str(t)) for t in range(12)] + rows
    run = Streamed(spark, tmp_path, EVENTS, lambda s: streams.task_states(s, cap=100, ttl=10**6))
    out = [r for part in (rows[:50], rows[50:200], rows[200:]) for r in run(part)]
    assert len(out) == len(rows)
    last = {}
    for r in out:
        if r.task_id not in last or r.events > last[r.task_id].events:
            last[r.task_id] = r
    want = {r.task_id: (r.status, r.event_count, r.created_at) for r in lifecycle.current_state(spark.createDataFrame(rows, EVENTS)).collect()}
    assert {t: (r.status, r.events, r.created_at) for t, r in last.items()} == want
    assert all(len(json.loads(r.history)) == min(100, r.events) for r in last.values())


def test_chain_goes_on_from_saved_tails(spark, tmp_path):
    """Stopped, its tails read back as a table, and gone on with by a new query: the same breaks as without a stop."""
    events = spark.createDataFrame([(s, q, "user", f"text {s} {q}") for s in range(6) for q in range(8)], "source_id long, seq long, role string, body string")
    log = audit.build(events).withColumn("prev_hash", F.when((F.col("source_id") == 2) & F.col("seq").isin(3, 5), F.lit("broken")).when((F.col("source_id") == 4) & (F.col("seq") == 4), F.lit(None)).otherwise(F.col("prev_hash")))
    rows = [tuple(r) for r in log.select("source_id", "seq", "content_hash", "prev_hash").collect()]
    schema = "source_id long, seq long, content_hash string, prev_hash string"
    whole = Streamed(spark, tmp_path / "whole", schema, streams.chain_breaks)
    want = sorted(tuple(r) for r in whole(rows))
    assert want == [(2, 3), (2, 5), (4, 4)]
    head, tail = [r for r in rows if r[1] < 4], [r for r in rows if r[1] >= 4]
    first = Streamed(spark, tmp_path / "first", schema, streams.chain_breaks)
    early = [tuple(r) for r in first(head)]
    tails = streams.saved_tails(spark, first.checkpoint)
    assert {tuple(r) for r in tails.collect()} == {tuple(r) for r in audit.state(spark.createDataFrame(head, schema)).select("source_id", "last_hash", "event_count").collect()}
    tails.write.parquet(str(tmp_path / "tails"))
    again = Streamed(spark, tmp_path / "again", schema, lambda s: streams.chain_breaks(s, spark.read.parquet(str(tmp_path / "tails"))))
    assert sorted(early + [tuple(r) for r in again(tail)]) == want
    fresh = Streamed(spark, tmp_path / "fresh", schema, streams.chain_breaks)
    assert (4, 4) not in [tuple(r) for r in fresh(tail)]  # without its tail, a source may start anywhere


@pytest.mark.parametrize("ttl", [60, 700])
def test_accepted_rows_are_those_of_the_batch(spark, tmp_path, ttl):
    rng = random.Random(ttl)
    at, rows = 0, []
    for _ in range(400):
        at += rng.choice([0, 1, 20, 59, 61, 400])
        rows.append((rng.choice(["a", "b", None]), rng.randrange(2), T0 + dt.timedelta(seconds=at)))
    schema = "k string, j long, ts timestamp"
    run = Streamed(spark, tmp_path, schema, lambda s: streams.accepted_by_ttl(s, ["k", "j"], ttl))
    got = [tuple(r) for part in (rows[:100], rows[100:101], [*rows[101:], ("a", 0, None)]) for r in run(part)]
    want = [tuple(r)[:3] for r in lifecycle.deduplicate_ttl(spark.createDataFrame(rows, schema), ["k", "j"], ttl).select("k", "j", "accepted_us").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) > 20


def test_many_tasks_share_state_rows(spark, tmp_path):
    """One call and one state row a bucket, not several calls to the store a task; a bucket's tasks still expire one by one."""
    run = Streamed(spark, tmp_path, EVENTS, lambda s: streams.task_states(s, ttl=100, buckets=4))
    out = run([event(t, "TASK_CREATED", (t or 0) % 50, dir=str(t)) for t in [*range(400), None]] + [event(2**60 + 1, "TASK_CREATED", 49), (7, "TASK_STARTED", None, None, "p", None, None)])
    assert len(out) == 402 and {r.task_id for r in out} == {*range(400), None, 2**60 + 1}
    assert spark.read.format("statestore").load(run.checkpoint).count() <= 4
    out = run([event(1, "TASK_STARTED", 135, proc="p"), event(399, "TASK_STARTED", 136, proc="p")]) + run([event(399, "TASK_COMPLETED", 140, ms=1.0)])
    gone = [r.task_id for r in out if r.status == "expired"]
    assert len(gone) == len(set(gone)) and set(gone) >= {t for t in range(400) if t % 50 < 26} - {1} and not {1, 399, 2**60 + 1} & set(gone)
    assert [r.events for r in out if r.task_id == 399] == [2, 3]


def test_many_keys_share_state_rows(spark, tmp_path):
    at = lambda s: T0 + dt.timedelta(seconds=s)
    schema = "k double, j timestamp, ts timestamp"
    key = lambda i: (i / 3, T0 + dt.timedelta(microseconds=i))
    run = Streamed(spark, tmp_path, schema, lambda s: streams.accepted_by_ttl(s, ["k", "j"], 60, buckets=4))
    got = run([(*key(i), at(0)) for i in range(300)] + [(*key(i), at(59)) for i in range(300)] + [(None, None, at(5))])
    assert len(got) == 301 and {r.k for r in got} == {i / 3 for i in range(300)} | {None} and all(r.accepted_us in (UNIX * 10**6, (UNIX + 5) * 10**6) for r in got)
    assert len({r.j for r in got}) == 301
    assert spark.read.format("statestore").load(run.checkpoint).count() <= 4
    assert sorted((r.k, r.accepted_us) for r in run([(*key(3), at(59)), (*key(4), at(60)), (*key(4), at(61))])) == [(4 / 3, (UNIX + 60) * 10**6)]


RECORDS = "topic string, key string, value string, headers array<struct<key: string, value: binary>>"


def test_replayed_batches_change_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("p", "1", "m", 3600 * i, float(i)) for i in range(50)], "processor_name string, processor_version string, metric_name string, window_start_unix long, sum double")
    path = str(tmp_path / "days")
    day = F.date_format(F.timestamp_seconds("window_start_unix"), "yyyy-MM-dd")
    for n, part in enumerate([rows.where("sum < 20"), rows.where("sum >= 20")]):
        for _ in range(3):
            sinks.write_batch(part.withColumn("day", day), n, path, ["day"])
    sinks.write_batch(rows.where("sum >= 45").withColumn("day", day), 1, path, ["day"])  # replayed with fewer rows
    assert sorted(r["sum"] for r in spark.read.parquet(path).collect()) == [*map(float, range(20)), *map(float, range(45, 50))]
    values = str(tmp_path / "values")
    for n, add in enumerate((0, 100, 100)):
        sinks.put_values(rows.where("sum < 5").withColumn("sum", F.col("sum") + add), min(n, 1), values)
    got = sinks.newest(spark, values, ["key"])
    assert sorted(r["sum"] for r in got.collect()) == [100.0, 101.0, 102.0, 103.0, 104.0] and spark.read.parquet(values).count() == 10


def test_streams_to_days_and_to_audit(spark, tmp_path):
    """Files that arrive between two runs are written once, with one audit copy each, whatever is run again."""
    schema = "processor_name string, processor_version string, metric_name string, window_start_unix long, sum double"
    for i in range(3):
        spark.createDataFrame([("p", "1", "m", 86400 * (i + j), float(j)) for j in range(4)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        sinks.stream_by_day(source, str(tmp_path / "days"), str(tmp_path / "c1")).awaitTermination(120)
        records = sinks.topic_records(source, "aggregates", F.col("processor_name"), ["metric_name", "sum"])
        sinks.stream_with_audit(records, str(tmp_path / "topic"), str(tmp_path / "audit"), "audit", str(tmp_path / "c2")).awaitTermination(120)
    days = spark.read.parquet(str(tmp_path / "days"))
    assert days.count() == 12 and days.select("day").distinct().count() == 6
    one, copy = spark.read.parquet(str(tmp_path / "topic")), spark.read.parquet(str(tmp_path / "audit"))
    assert (one.count(), copy.count()) == (12, 12) and {r.topic for r in copy.collect()} == {"audit"}
    assert {(h.key, bytes(h.value)) for r in copy.collect() for h in r.headers} >= {("source-topic", b"aggregates"), ("source-key", b"p")}
