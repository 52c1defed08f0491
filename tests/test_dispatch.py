"""One pass for all analyzers, artifact sets, stored arrays, places of outliers and processor jobs, against plain Python."""

import collections
import hashlib
import json
import math
import random
import statistics
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from evalspark.functions import values as V
from evalspark.operators import analyzers, dispatch, processors, ranks
from evalspark.sources import arrays

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests

ROWS = "k string, aggregation_mask int, num double, label string, passed string, x double, y double, meta string"
NAN = float("nan")


def made(seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        k = r.choice(["hot", "hot", "hot", "a", None])
        num = r.choice([r.gauss(5, 3), float(r.randrange(4)), None, NAN, math.inf])
        x, y = r.choice([(r.random(), r.gauss(0, 9)), (None, 1.0), (2.0, NAN), (1.0, 2.0)])
        rows.append((k, r.choice([0, None, 255, 1, 2, 4, 8, 16, 32, 64, 128, r.randrange(256)]), num, r.choice(["p", "q", "r", None]), r.choice(["Yes", "no", "?", None, "1"]), x, y, f"m{i % 3}"))
    return [*rows, ("flat", 255, 2.0, None, None, 3.0, 3.0, None), ("none", 255, None, None, None, None, None, None)]


def asked(rows, flag):
    out = collections.defaultdict(list)
    for r in rows:
        if (r[1] or 0) & V.FLAGS[flag]:
            out[r[0]].append(r)
    return out


def ok(v):
    return v is not None and math.isfinite(v)


def close(a, b):
    return a == b if a is None or b is None else a == pytest.approx(b, rel=1e-9, abs=1e-9)


@pytest.fixture(scope="module")
def both(spark):
    rows = made(3, 700)
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    return rows, {f: [r.asDict() for r in d.collect()] for f, d in dispatch.one_pass(df, ["k"]).items()}, df


def test_stats_and_outliers(both):
    rows, got, _ = both
    stats = {r["k"]: r for r in got["STATS"]}
    assert set(stats) == set(asked(rows, "STATS"))
    for k, some in asked(rows, "STATS").items():
        v, r = sorted(x[2] for x in some if ok(x[2])), stats[k]
        assert (r["count"], r["missing"]) == (len(v), len(some) - len(v))
        want = {"mean": statistics.fmean(v), "median": statistics.median(v), "min": v[0], "max": v[-1], "std": statistics.stdev(v) if len(v) > 1 else 0.0, "variance": statistics.variance(v) if len(v) > 1 else 0.0} if v else dict.fromkeys(("mean", "median", "min", "max", "std", "variance"))
        assert all(close(r[c], w) for c, w in want.items()), (k, r, want)
    out = {r["k"]: r for r in got["OUTLIERS"]}
    for k, some in asked(rows, "OUTLIERS").items():
        v = [x[2] for x in some if ok(x[2])]
        if not v:
            assert k not in out
            continue
        q1, q3 = np.percentile(v, [25, 75])
        n = sum(x < q1 - 1.5 * (q3 - q1) or x > q3 + 1.5 * (q3 - q1) for x in v) if len(v) >= 4 else 0
        assert close(out[k]["q1"], q1) and close(out[k]["q3"], q3) and out[k]["outlier_count"] == n


def test_histogram_tally_rate_and_meta(both):
    rows, got, _ = both
    for k, some in asked(rows, "HISTOGRAM").items():
        v = [x[2] for x in some if ok(x[2])]
        mine = sorted((r for r in got["HISTOGRAM"] if r["k"] == k), key=lambda r: r["bin"])
        assert len(mine) == (10 if v else 0)
        if v:
            counts, edges = np.histogram(v, 10)
            assert sum(r["n"] for r in mine) == len(v) and close(mine[0]["low"], edges[0]) and close(mine[-1]["high"], edges[-1])
            assert sum(abs(r["n"] - c) for r, c in zip(mine, counts, strict=True)) <= 4  # whole numbers on an edge may fall to either side
    for k, some in asked(rows, "TALLY").items():
        n = collections.Counter(x[3] for x in some if x[3] is not None)
        assert {r["label"]: (r["n"], r["rank"]) for r in got["TALLY"] if r["k"] == k} == {label: (c, i) for i, (label, c) in enumerate(sorted(n.items(), key=lambda p: (-p[1], p[0])), 1)}
    rates = {r["k"]: r for r in got["RATE"]}
    for k, some in asked(rows, "RATE").items():
        yes, no = sum(x[4] in ("Yes", "1") for x in some), sum(x[4] == "no" for x in some)
        assert (rates[k]["yes"], rates[k]["no"], rates[k]["missing"]) == (yes, no, len(some) - yes - no)
        assert close(rates[k]["rate"], yes / (yes + no) if yes + no else None)
    assert collections.Counter((r["k"], r["meta"]) for r in got["RAW"]) == collections.Counter((k, x[7]) for k, some in asked(rows, "RAW").items() for x in some)


def test_ellipse_and_density(both):
    rows, got, _ = both
    found = {r["k"]: r for r in got["SCATTER_ELLIPSE"]}
    for k, some in asked(rows, "SCATTER_ELLIPSE").items():
        p = np.array([(x[5], x[6]) for x in some if ok(x[5]) and ok(x[6])])
        if not len(p):
            assert k not in found
            continue
        big = sorted(np.linalg.eigvalsh(np.cov(p.T))) if len(p) > 1 else [0.0, 0.0]
        assert found[k]["count"] == len(p) and close(found[k]["cx"], p[:, 0].mean()) and close(found[k]["lambda1"], big[1])
    for k, some in asked(rows, "DENSITY_MAP").items():
        p = [(x[5], x[6]) for x in some if ok(x[5]) and ok(x[6])]
        cells = [r for r in got["DENSITY_MAP"] if r["k"] == k]
        assert sum(r["n"] for r in cells) == len(p) and len({(r["ix"], r["iy"]) for r in cells}) == len(cells)
        if k == "flat":
            assert cells[0]["degenerate"] and (cells[0]["x0"], cells[0]["x1"]) == (2.5, 3.5)


def test_dispatch_gives_what_single_analyzers_give(both):
    """The long form, against each analyzer alone; a further analyzer runs beside them under its own bit."""
    _, _, df = both
    analyzers.register("SEEN", lambda d, keys: d.groupBy(*keys).agg(F.count("*").alias("seen")), bit=256)
    try:
        for bad in (lambda: analyzers.register("OTHER", analyzers.stats, bit=256), lambda: analyzers.register("THIRD", analyzers.stats)):
            with pytest.raises(ValueError):
                bad()
        more = df.unionByName(df.where("k = 'a'").withColumn("aggregation_mask", F.lit(256)))
        got = collections.Counter((r.k, r.type) for r in dispatch.by_mask(more, ["k"]).collect())
        for flag, alone in analyzers.ANALYZERS.items():
            want = collections.Counter((r.k, flag) for r in alone(more.where(F.col("aggregation_mask").bitwiseAND(analyzers.BITS[flag]) != 0), ["k"]).collect() if flag not in ("TALLY",))
            if flag not in ("OUTLIERS", "SCATTER_ELLIPSE", "HISTOGRAM", "DENSITY_MAP", "TALLY"):  # these join on keys, so alone they lose the null key
                assert {p: n for p, n in got.items() if p[1] == flag} == dict(want)
        assert got["a", "SEEN"] == 1
    finally:
        analyzers.ANALYZERS.pop("SEEN"), analyzers.BITS.pop("SEEN")


def test_the_input_is_scanned_once(spark, tmp_path, both):
    both[2].write.parquet(str(tmp_path / "t"))
    items = dispatch.counted_items(spark.read.parquet(str(tmp_path / "t")), ["k"])
    plan = dispatch.by_mask(spark.read.parquet(str(tmp_path / "t")), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "t") not in plan and items.count() > 0


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([], ROWS).withColumn("n", F.lit(1)).withColumn("flag", F.lit("x")).withColumn("family", F.lit("x"))
    assert all(d.count() == 0 for d in dispatch.one_pass(df, ["k"]).values())
    assert dispatch.artifact_set(df, ["k"]).count() == 0
    one = spark.createDataFrame([("a", 255, 1.0, "l", "yes", 1.0, 1.0, "m")], ROWS).withColumn("n", F.lit(7)).withColumn("bits", F.lit(0))
    assert [(r.type, json.loads(r.summary)) for r in dispatch.by_mask(one, ["k"]).collect() if r.type == "TALLY"] == [("TALLY", {"label": "l", "n": 1, "rank": 1})]


def test_artifact_set_asks_the_mask(spark):
    raw = [("m", '{"x": 1, "y": 2}', 34), ("m", "1", 26), ("m", "true", 26), ("m", "2.5", 26), ("m", '"word"', 26), ("m", "7", 0), ("m", "null", 26), ("lone", "3", 2), ("other", '{"x": 1, "y": 2}', 32), (None, "0", 16)]
    df = spark.createDataFrame(raw, "k string, raw string, aggregation_mask int").withColumn("value", V.typed(F.col("raw")))
    got = {r.k: r for r in dispatch.artifact_set(dispatch.read_side(df), ["k"]).collect()}
    m = got["m"]
    assert sum(m.histogram.counts) == 2 and len(m.histogram.edges) == 31 and m.histogram.edges[0] == 1 and m.histogram.edges[-1] == 2.5
    assert dict(zip(m.categories.labels, m.categories.counts, strict=True)) == {"true": 2, "2.5": 1, "word": 1}
    assert (m.rate.yes, m.rate.no, m.rate.n) == (2, 0, 2) and m.ellipse is None and m.contour is None
    assert got[None].rate.no == 1 and "lone" not in got and "other" not in got  # one number, one point: too few


def test_arrays_make_the_round_trip(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [("h1", [0.0, 0.5, 1.0], [[1.0, 2.0], [3.0, 4.0]]), ("h2", [0.0, 0.5, 1.0], [[1.0, 2.0], [3.0, 4.0]]), ("e", [], []), ("n", None, None)]
    df = spark.createDataFrame(rows, "id string, v array<double>, g array<array<double>>")
    docs = arrays.documents(df, F.lit("b"), F.col("id"), {"v": arrays.vector(F.col("v")), "g": arrays.grid(F.col("g"))})
    arrays.write(docs, path)
    arrays.write(arrays.documents(df.where("id = 'n'"), F.lit("b"), F.col("id"), {"v": arrays.vector(F.array(F.lit(9.0)))}), path)
    stored = arrays.read(spark, path)
    back = {r.key: r for r in stored.select("key", "content_hash", "arrays", arrays.rows_of(F.col("arrays")["g"]).alias("rows")).collect()}
    assert back["h1"].rows == [[1.0, 2.0], [3.0, 4.0]] and back["h1"].arrays["v"]["values"] == [0.0, 0.5, 1.0]
    assert back["h1"].content_hash == back["h2"].content_hash != back["e"].content_hash
    assert back["e"].rows == [] and back["e"].arrays["g"]["shape"] == [0, 0] and back["n"].arrays["v"]["values"] == [9.0]  # the newest under its key
    wanted = spark.createDataFrame([("b", "h1"), ("b", "h1"), ("b", "gone"), ("x", "h1")], "bucket string, key string")
    assert sorted((r.bucket, r.key, r.found) for r in arrays.fetch(stored, wanted, "key").collect()) == [("b", "gone", False), ("b", "h1", True), ("x", "h1", False)]
    by = arrays.fetch(stored, stored.where("key = 'h2'"), "content_hash").collect()
    assert [(r.key, r.found) for r in by] == [("h1", True)]


@pytest.mark.parametrize("parts", [1, 13])
def test_positions_without_a_sorted_task(spark, parts):
    r = random.Random(parts)
    data = [(r.choice(["hot"] * 9 + [None, "b"]), r.randrange(10**6), r.choice([1.0, 2.0, None, 50.0, *[r.gauss(0, 1)] * 6]), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, at long, v double, id long").repartition(parts)
    want = collections.defaultdict(list)
    for k, at, v, i in sorted(data, key=lambda x: (x[1], x[3])):
        want[k].append((i, v))
    got = {(x.k, x.id): x.place for x in ranks.positions(df, ["k"], ["at", "id"], "place").collect()}
    assert got == {(k, i): n for k, rows in want.items() for n, (i, _) in enumerate(rows)}
    out = {(x.k, x["index"]): x.value for x in analyzers.outlier_rows(df, ["k"], ["at", "id"], "v").collect()}
    places = {}
    for k, rows in want.items():
        v = [x for _, x in rows if x is not None]
        q1, q3 = np.percentile(v, [25, 75])
        places |= {(k, n): x for n, (_, x) in enumerate(rows) if x is not None and (x < q1 - 1.5 * (q3 - q1) or x > q3 + 1.5 * (q3 - q1))}
    assert out == places and len(out) > 50


class Lines:
    name, version = "lines", "1"

    def initialize(self, settings):
        if settings.get("broken"):
            raise RuntimeError("no setup")
        self.mark = settings.get("mark", "-").encode()

    def run(self, content, settings):
        if b"!" in content:
            raise ValueError("a bang")
        n = content.count(b"\n")
        return processors.Result({"lines": processors.Measurement(n, 3, {"unit": 1}), "text": content[:3].decode(), "none": None}, (processors.Artifact("copy", "text/plain", self.mark + content), processors.Artifact("empty", "text/plain", b"")))


def test_job_by_a_plain_loop(spark, monkeypatch):
    """Measurements, artifacts and events of one pass agree with a loop over the tasks; a failing row fails alone and whole."""
    monkeypatch.setattr(processors, "HELD_ROWS", 5)
    registry = processors.Registry()
    registry.add(Lines)
    routes = spark.createDataFrame([("a", "lines", "1", {"mark": "+"}), ("b", "lines", "1", None), ("c", "lines", "2", {}), ("d", "lines", "1", {"broken": "y"})], "directory_key string, algorithm string, version string, settings map<string,string>")
    texts = [b"x\ny", b"", b"oops!", None, "é\n".encode(), b"z" * 1000]
    tasks = [(i * 10 + j, k, t) for i, k in enumerate(["a", "b", "c", "d", "nowhere", None]) for j, t in enumerate(texts)]
    df = spark.createDataFrame(tasks, "task_id long, directory_key string, content binary").withColumn("value", F.lit(1)).repartition(3)
    job = processors.run_job(df, routes, registry)
    events, measured, stored = (collections.defaultdict(list) for _ in range(3))
    for r in sorted(job.events.collect(), key=lambda r: r.seq):
        events[r.task_id].append(r)
    for r in job.measurements.collect():
        measured[r.task_id].append((r.metric_name, r.value, r.aggregation_mask, dict(r.meta)))
    for r in job.artifacts.collect():
        stored[r.task_id].append((r.name, bytes(r.data), r.size, r.content_hash))
    fails = {"c": "KeyError", "d": "RuntimeError", "nowhere": "KeyError", None: "KeyError"}
    for task, k, text in tasks:
        kinds = [e.event_type for e in events[task]]
        if k in fails:
            assert kinds == ["TASK_FAILED"] and events[task][0].error_type == fails[k] and not measured[task] and not stored[task]
        elif text is None or b"!" in text:
            assert kinds == ["TASK_STARTED", "TASK_FAILED"] and events[task][1].error == ("no content" if text is None else "a bang") and not measured[task] and not stored[task]
        else:
            data = (b"+" if k == "a" else b"-") + text
            assert kinds == ["TASK_STARTED", "ARTIFACT_STORED", "RESULT_PRODUCED", *["METRIC_EMITTED"] * 4, "TASK_COMPLETED"]
            assert stored[task] == [("copy", data, len(data), hashlib.sha256(data).hexdigest())] and events[task][2].artifact_refs == [stored[task][0][3]] and events[task][2].metric_count == 3
            values = {n: (v, m, o) for n, v, m, o in measured[task]}
            assert values["lines"] == (str(text.count(b"\n")), 3, {"unit": "1"}) and json.loads(values["text"][0]) == text[:3].decode() and values["none"][0] == "null"
            assert values["task_duration_ms"][1] == 3 and float(values["task_duration_ms"][0]) == events[task][-1].duration_ms
    assert processors.run_job(df.limit(0), routes.drop("settings"), registry).events.count() == 0
