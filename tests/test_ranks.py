"""Ranks, rows before and accepted rows against plain Python, with a hot group, null keys, ties and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from evalspark.operators import lifecycle, ranks, timeseries


def wanted():
    n = F.col("n")
    return {"least": F.lit(0), "middle": F.floor(n / 2), "late": F.floor(n * 95 / 100), "last": n - 1, "beyond": n}


@pytest.mark.parametrize("small", [0, 50, 100_000])
def test_ranks_as_sorted(spark, small):
    r = random.Random(5)
    data = [("hot", "a", r.gauss(0, 1e3)) for _ in range(6000)] + [(None, "b", float(r.randrange(4))) for _ in range(700)]
    data += [(r.choice(["x", "y"]), None, r.choice([None, 1.5, float("nan"), float("inf"), r.random()])) for _ in range(120)] + [("none", "c", None)]
    df = spark.createDataFrame(data, "k string, j string, v double").repartition(7)
    want = {}
    for k, j, v in data:
        if v is not None:
            want.setdefault((k, j), []).append(v)
    got = {(x.k, x.j): x for x in ranks.at_ranks(df, ["k", "j"], "v", wanted(), small).collect()}
    assert set(got) == set(want)
    for key, values in want.items():
        values.sort(key=lambda v: (v != v, v))
        n, x = len(values), got[key]
        assert repr([x.least, x.middle, x.late, x.last, x.beyond]) == repr([values[0], values[n // 2], values[n * 95 // 100], values[-1], None])


def test_ranks_of_nothing(spark):
    assert ranks.at_ranks(spark.createDataFrame([], "k string, v double"), ["k"], "v", wanted()).count() == 0


def test_row_before(spark):
    r = random.Random(8)
    data = [(r.choice([None, "a"]), t, r.random()) for t in r.sample(range(5000), 400)]
    df = spark.createDataFrame(data, "k string, t long, v double").repartition(5)
    got = {(x.k, x.t): x["_before"] and x["_before"].v for x in ranks.row_before(df, ["k"], ["t"], ["v"], F.floor(F.col("t") / 100)).collect()}
    last = {}
    for k, t, v in sorted(data, key=lambda x: x[1]):
        assert got[k, t] == last.get(k)
        last[k] = v
    assert len(got) == len(data)


@pytest.mark.parametrize("ttl", [1, 60, 4000])
def test_accepted_rows(spark, ttl):
    r = random.Random(ttl)
    data = [(k, r.choice([r.randrange(30), r.randrange(20_000)])) for k in ["a", None, "b"] for _ in range(300)]
    df = spark.createDataFrame(data, "k string, s long").withColumn("ts", F.timestamp_seconds("s")).unionByName(spark.sql("select 'a' k, 0L s, cast(null as timestamp) ts"))
    want = set()
    for key in ["a", None, "b"]:
        times, last = sorted(s for k, s in data if k == key), None
        for t in times:
            if last is None or t - last >= ttl:
                last = t
                want.add((key, t * 1_000_000, len(times)))
    got = [tuple(x) for x in lifecycle.deduplicate_ttl(df, ["k"], ttl).collect()]
    assert len(got) == len(want) and set(got) == want
    assert lifecycle.deduplicate_ttl(df.limit(0), ["k"], ttl).count() == 0


def test_counter_over_windows(spark):
    """A series with empty windows, a restart and a null value; the first sample adds nothing."""
    data = [("c", 10, 1, 5.0), ("c", 70, 2, 8.0), ("c", 400, 3, 2.0), ("c", 401, 4, None), ("c", 410, 5, 9.0), ("c", 411, 6, 10.0)]
    df = spark.createDataFrame(data, "name string, s long, event_id long, value double").withColumn("ts", F.timestamp_seconds("s"))
    got = {x.window_start_unix: (x.increase, x.samples) for x in timeseries.increase(df, "60 seconds", ["name"]).collect()}
    assert got == {0: (0.0, 1), 60: (3.0, 1), 360: (3.0, 4)}
