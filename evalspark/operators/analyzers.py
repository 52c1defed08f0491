"""One analyzer for each aggregation flag, and the read side's variants. DataFrame in, rows per group out."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any, Protocol, Tuple  # noqa: UP035

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.values import FLAGS, Z_ANALYZER, Z_READ, finite, parse_bool, wilson, z_of
from ..sources.sinks import materialize
from .ranks import at_counted_ranks, at_ranks, between, join_groups, positions, quantile_ranks


def stats(df: DataFrame, keys: list[str], value: str = "num") -> DataFrame:
    """count, missing, mean, median, min, max, sample deviation and variance (0 for one value)."""
    v = F.when(finite(F.col(value)), F.col(value))
    one = lambda f: F.when(F.count(v) > 1, f(v)).when(F.count(v) == 1, F.lit(0.0))
    out = df.groupBy(*keys).agg(
        F.count(v).alias("count"), (F.count("*") - F.count(v)).alias("missing"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
        one(F.stddev_samp).alias("std"), one(F.var_samp).alias("variance"),
    )
    out = join_groups(out, at_ranks(df.where(finite(F.col(value))), keys, value, quantile_ranks("median", 0.5)), keys, "left")
    return out.select(*keys, "count", "missing", "mean", between("median", 0.5, F.col("count")).alias("median"), "min", "max", "std", "variance")


def histogram(df: DataFrame, keys: list[str], bins: int = 50, value: str = "num", least_values: int = 1) -> DataFrame:
    """(keys, bin, low, high, n): equal-width bins, the last closed; empty bins are there too.

    Counts are summed by bin before anything is gathered, so a hot group costs at most ``bins`` rows a task.
    """
    ok = df.where(finite(F.col(value)))
    ends = ok.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("total")).where(f"total >= {least_values}")
    ends = ends.select(*keys, F.expr("if(lo = hi, lo - 0.5, lo)").alias("lo"), F.expr("if(lo = hi, hi + 0.5, hi)").alias("hi"))
    bin_of = F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    counts = ok.join(ends, keys).groupBy(*keys, bin_of.alias("bin")).agg(F.count("*").alias("n"))
    grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    edge = lambda k: F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("bin") + k) / bins
    return grid.join(counts, [*keys, "bin"], "left").select(*keys, "bin", edge(0).alias("low"), edge(1).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def histogram_series(bins: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, centers, counts, total) of a histogram's rows: one array entry for each bin, in order."""
    g = bins.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("bin", "low", "high", "n"))).alias("_b"), F.sum("n").alias("total"))
    return g.select(*keys, F.transform("_b", lambda b: (b["low"] + b["high"]) / 2).alias("centers"), F.col("_b.n").alias("counts"), "total")


def outliers(df: DataFrame, keys: list[str], value: str = "num", factor: float = 1.5) -> DataFrame:
    """Quartiles, bounds and counts of what lies outside; groups of under four values have none.

    The input is read once, to count equal values. The bounds are stored, so that Spark sees how few they are and sends them to
    the counts: no task gets a whole group, as one would if the rows were dealt by group to meet them.
    """
    counted = df.where(finite(F.col(value))).groupBy(*keys, F.col(value).alias("_value")).agg(F.count("*").alias("_times"))
    counted = materialize(counted, "counted")
    quartiles = at_counted_ranks(counted, keys, "_value", "_times", quantile_ranks("q1", 0.25) | quantile_ranks("q3", 0.75))
    bounds = join_groups(counted.groupBy(*keys).agg(F.sum("_times").alias("count")), quartiles, keys)
    bounds = bounds.select(*keys, "count", between("q1", 0.25, F.col("count")).alias("q1"), between("q3", 0.75, F.col("count")).alias("q3"))
    bounds = bounds.withColumn("iqr", F.col("q3") - F.col("q1")).withColumns({"lower": F.col("q1") - F.lit(factor) * F.col("iqr"), "upper": F.col("q3") + F.lit(factor) * F.col("iqr")})
    bounds = materialize(bounds, "bounds")
    out = join_groups(counted, bounds.where("count >= 4").select(*keys, "lower", "upper"), keys).where((F.col("_value") < F.col("lower")) | (F.col("_value") > F.col("upper")))
    n = out.groupBy(*keys).agg(F.sum("_times").alias("outlier_count"))
    return join_groups(bounds, n, keys, "left").withColumn("outlier_count", F.coalesce("outlier_count", F.lit(0))).withColumn("fraction", F.col("outlier_count") / F.col("count"))


def outlier_rows(df: DataFrame, keys: list[str], order: list[str], value: str = "num", factor: float = 1.5) -> DataFrame:
    """(keys, index, value): the values outside their group's bounds, each with its place among all values of the group, missing
    ones included, in ``order``. Groups of under four finite values have none. Places of rows that are equal in ``order`` follow
    no rule, so ``order`` should tell all rows of a group apart."""
    placed = positions(df.select(*dict.fromkeys([*keys, *order, value])), keys, order, "index")
    bounds = outliers(df, keys, value, factor).where("count >= 4").select(*keys, "lower", "upper")
    rows = join_groups(placed, bounds, keys)
    return rows.where(finite(F.col(value)) & ((F.col(value) < F.col("lower")) | (F.col(value) > F.col("upper")))).select(*keys, "index", F.col(value).alias("value"))


def tally_facts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, count, missing, unique) of labels. Labels are counted first, so a hot label is a row a task."""
    n = df.groupBy(*keys, F.col(value).cast("string").alias("_label")).agg(F.count("*").alias("_n"))
    there = F.col("_label").isNotNull()
    return n.groupBy(*keys).agg(F.coalesce(F.sum(F.when(there, F.col("_n"))), F.lit(0)).alias("count"), F.coalesce(F.sum(F.when(~there, F.col("_n"))), F.lit(0)).alias("missing"), F.count(F.when(there, 1)).alias("unique"))


def tally_by_label(df: DataFrame, keys: list[str], value: str, top: int = 20) -> DataFrame:
    """(keys, label, n, rank): the first labels of a group in the order of the labels themselves."""
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("string").alias("label")).agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy("label"))).where(F.col("rank") <= top)


def tally(df: DataFrame, keys: list[str], value: str, top: int = 20) -> DataFrame:
    """The most frequent labels of a group, ties by label."""
    n = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("string").alias("label")).agg(F.count("*").alias("n"))
    order = W.partitionBy(*keys).orderBy(F.desc("n"), "label")
    return n.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def rate(df: DataFrame, keys: list[str], value: str, confidence: float = 0.95, read_side: bool = False) -> DataFrame:
    """yes, no, missing, rate and Wilson's bounds of values that read as booleans."""
    b = parse_bool(F.col(value))
    out = df.groupBy(*keys).agg(F.count(F.when(b, 1)).alias("yes"), F.count(F.when(~b, 1)).alias("no"), F.count(F.when(b.isNull(), 1)).alias("missing"))
    out = out.withColumn("n", F.col("yes") + F.col("no"))
    n = F.when(F.col("n") > 0, F.col("n").cast("double"))
    low, high = wilson(F.col("yes").cast("double"), n, z_of(confidence, Z_READ if read_side else Z_ANALYZER))
    some = F.col("n") > 0
    return out.withColumns({"rate": F.col("yes") / n, "low": F.when(some, low), "high": F.when(some, high)})


def ellipse(df: DataFrame, keys: list[str], population: bool = False) -> DataFrame:
    """Centre, principal variances and angle of the points of a group, in closed form."""
    ok = df.where(finite(F.col("x")) & finite(F.col("y")))
    var, cov = (F.var_pop, F.covar_pop) if population else (F.var_samp, F.covar_samp)
    m = ok.groupBy(*keys).agg(F.count("*").alias("count"), F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.coalesce(var("x"), F.lit(0.0)).alias("a"), F.coalesce(var("y"), F.lit(0.0)).alias("c"), F.coalesce(cov("x", "y"), F.lit(0.0)).alias("b"))
    half = (F.col("a") + F.col("c")) / 2
    root = F.sqrt(F.pow((F.col("a") - F.col("c")) / 2, 2) + F.col("b") * F.col("b"))
    return m.select(*keys, "count", "cx", "cy", (half + root).alias("lambda1"), (half - root).alias("lambda2"), (F.atan2(2 * F.col("b"), F.col("a") - F.col("c")) / 2).alias("angle"))


def outline(ellipses: DataFrame, sigma: float = 2.0, points: int = 64) -> DataFrame:
    """ellipses with the outline at so many deviations, as an array of points."""
    t = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: i * (2 * 3.141592653589793 / points))
    at = lambda a: F.struct(
        (F.col("cx") + sigma * (F.sqrt("lambda1") * F.cos(a) * F.cos("angle") - F.sqrt("lambda2") * F.sin(a) * F.sin("angle"))).alias("x"),
        (F.col("cy") + sigma * (F.sqrt("lambda1") * F.cos(a) * F.sin("angle") + F.sqrt("lambda2") * F.sin(a) * F.cos("angle"))).alias("y"),
    )
    return ellipses.withColumn("outline", F.transform(t, at))


def density_within(df: DataFrame, keys: list[str], grid: int, x: tuple[float, float], y: tuple[float, float]) -> DataFrame:
    """``density`` over given ranges instead of those of the data: points outside are not counted. Both ranges hold their ends."""
    if not (x[0] < x[1] and y[0] < y[1]):
        raise ValueError("a range needs two different ends, the lower first")
    grid = max(8, grid)
    ok = df.where(F.col("x").between(*x) & F.col("y").between(*y))
    at = lambda c, r: F.least(F.floor((F.col(c) - F.lit(r[0])) / F.lit(r[1] - r[0]) * grid), F.lit(grid - 1)).cast("int")
    cells = ok.groupBy(*keys, at("x", x).alias("ix"), at("y", y).alias("iy")).agg(F.count("*").alias("n"))
    totals = cells.groupBy(*keys).agg(F.sum("n").alias("_total"))
    area = (x[1] - x[0]) / grid * ((y[1] - y[0]) / grid)
    return join_groups(cells, totals, keys).select(*keys, "ix", "iy", "n", (F.col("n") / (F.col("_total") * F.lit(area))).alias("density"))


def density(df: DataFrame, keys: list[str], grid: int = 64, pad: float = 0.0) -> DataFrame:
    """(keys, ix, iy, n, density): the cells of a grid that hold points; a flat range is widened by one half (or ``pad``)."""
    grid = max(8, grid)
    ok = df.where(finite(F.col("x")) & finite(F.col("y")))
    ends = ok.groupBy(*keys).agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count("*").alias("total"))
    for c in ("x", "y"):
        wide = F.when(F.col(f"{c}1") > F.col(f"{c}0"), (F.col(f"{c}1") - F.col(f"{c}0")) * pad).otherwise(F.lit(1.0 if pad else 0.5))
        ends = ends.withColumn("_pad", wide).withColumns({f"{c}0": F.col(f"{c}0") - F.col("_pad"), f"{c}1": F.col(f"{c}1") + F.col("_pad")}).drop("_pad")
    at = lambda c: F.least(F.floor((F.col(c) - F.col(f"{c}0")) / (F.col(f"{c}1") - F.col(f"{c}0")) * grid), F.lit(grid - 1)).cast("int")
    cells = ok.join(ends, keys).groupBy(*keys, at("x").alias("ix"), at("y").alias("iy")).agg(F.count("*").alias("n"))
    area = (F.col("x1") - F.col("x0")) / grid * ((F.col("y1") - F.col("y0")) / grid)
    return cells.join(ends, keys).select(*keys, "ix", "iy", "n", (F.col("n") / (F.col("total") * area)).alias("density"))


class GroupAnalyzer(Protocol):
    """A user's analyzer of a group: its result's columns, and a state that takes the group's rows an Arrow batch at a time.

    ``merge`` joins the states of two parts of a group. Groups are then cut into parts, which are read side by side, so that
    a hot group is no longer one task's; without it a group's batches all pass through one task, in no certain order.
    """

    columns: list[str]  # of the input, that it reads
    summary: str  # of the result, as DDL

    def start(self) -> Any: ...

    def add(self, state: Any, rows: pa.RecordBatch) -> Any: ...

    def result(self, state: Any) -> dict[str, Any]: ...


PARTS = 32  # that a group of a user's analyzer is cut into, if its states can be merged


def grouped(analyzer: GroupAnalyzer) -> Callable[[DataFrame, list[str]], DataFrame]:
    """An analyzer for ``register`` from a user's class: one row a group, with the columns of its ``summary``. States travel
    pickled; memory is bounded by a batch and a state. Null keys make a group; an empty table gives no rows."""

    def run(df: DataFrame, keys: list[str]) -> DataFrame:
        columns = list(dict.fromkeys(analyzer.columns))
        types = {f.name: f for f in df.select(*keys).schema.fields}
        out_schema = T.StructType([*types.values(), *T.StructType.fromDDL(analyzer.summary).fields])
        arrow = to_arrow_schema(out_schema)
        taken = [f"v{i}" for i in range(len(columns))]
        renamed = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
        rows = df.select(*renamed, *[F.col(c).alias(v) for c, v in zip(columns, taken, strict=True)])
        names = [f"k{i}" for i in range(len(keys))]

        def state_of(batches: Iterator[pa.RecordBatch]) -> Any:
            state = analyzer.start()
            for batch in batches:
                state = analyzer.add(state, pa.RecordBatch.from_arrays([batch.column(v) for v in taken], columns))
            return state

        def told(key: tuple[pa.Scalar, ...], state: Any) -> pa.RecordBatch:
            row = [*(k.as_py() for k in key), *(analyzer.result(state).get(n) for n in arrow.names[len(key) :])]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, arrow.types, strict=True)], schema=arrow)

        def whole(key: Tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # noqa: UP006  (Spark reads this form)
            yield told(key, state_of(batches))

        def part(key: Tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # noqa: UP006
            state = pickle.dumps(state_of(batches))
            yield pa.RecordBatch.from_arrays([*(pa.array([k.as_py()], k.type) for k in key[:-1]), pa.array([state], pa.binary())], [*names, "state"])

        def merged(key: Tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # noqa: UP006
            state = None
            for batch in batches:
                for s in batch.column("state").to_pylist():
                    state = pickle.loads(s) if state is None else analyzer.merge(state, pickle.loads(s))  # states that this job's own tasks wrote
            yield told(key, state)

        if not hasattr(analyzer, "merge"):
            return rows.groupBy(*names).applyInArrow(whole, out_schema)
        parts = rows.withColumn("part", F.pmod(F.xxhash64(*taken, F.monotonically_increasing_id()), F.lit(PARTS))).groupBy(*names, "part")
        states = T.StructType([*(T.StructField(n, types[k].dataType) for n, k in zip(names, keys, strict=True)), T.StructField("state", T.BinaryType())])
        return parts.applyInArrow(part, states).groupBy(*names).applyInArrow(merged, out_schema)

    return run


ANALYZERS: dict[str, Callable[[DataFrame, list[str]], DataFrame]] = {}
BITS = dict(FLAGS)


def register(flag: str, analyzer: Callable[[DataFrame, list[str]], DataFrame], bit: int | None = None) -> None:
    """A further analyzer under its flag; one that isn't among the fixed flags needs a bit of the mask that no other has."""
    if flag in ANALYZERS:
        raise ValueError(f"an analyzer for {flag} is registered already")
    if flag not in BITS:
        if bit is None or bit <= 0 or bit & (bit - 1) or bit in BITS.values():
            raise ValueError(f"{flag} needs a free bit of its own, not {bit}")
        BITS[flag] = bit
    ANALYZERS[flag] = analyzer


register("STATS", stats)
register("HISTOGRAM", lambda df, keys: histogram(df, keys, 10))
register("OUTLIERS", outliers)
register("TALLY", lambda df, keys: tally(df, keys, "label"))
register("RATE", lambda df, keys: rate(df, keys, "passed"))
register("SCATTER_ELLIPSE", ellipse)
register("DENSITY_MAP", density)
register("RAW", lambda df, keys: df.select(*keys, "meta"))
