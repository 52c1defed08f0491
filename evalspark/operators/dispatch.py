"""All analyzers that a mask asks for, in one pass over the rows, and the set of artifacts of a metric.

Each row is expanded over its mask's families (numbers, labels, booleans, points, meta), and one partial aggregate counts
equal items of a group in each. That table is written once to the shared folder; the input is not read again. From it come

1. the ends: one row a group and flag, with counts, sums, least and greatest;
2. the cells: the items again, beside their group's ends, as bins, grid cells, labels and sums of squares;
3. the ranks that medians and quartiles need.

What was counted for many rows travels as one row, and no group is ever gathered: a hot group costs each task its different
items at most. Analyzers that a user registered run beside, each over the rows that ask for it.

Columns of the input: the keys, a mask, num, label, passed, x, y and meta. Null and non-finite numbers and points with such a
coordinate are missing; null keys make a group; an empty table gives empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import FLAGS, Z_ANALYZER, Z_READ, finite, parse_bool, wilson, z_of
from ..sources.sinks import materialize
from . import analyzers
from .ranks import at_counted_ranks, between, join_groups, quantile_ranks

STATS, HISTOGRAM, OUTLIERS, TALLY, RATE, ELLIPSE, DENSITY, RAW = FLAGS.values()
ITEMS = ["family", "bits", "num", "label", "x", "y", "meta"]


@dataclass(frozen=True)
class Rules:
    """The options of both sides: what the analyzers of a pipeline take, and what is computed on demand."""

    bins: int = 10
    least_values: int = 1
    grid: int = 64
    pad: float = 0.0
    least_points: int = 1
    top: int | None = 20
    factor: float = 1.5
    z: float = z_of(0.95, Z_ANALYZER)


ON_DEMAND = Rules(bins=30, least_values=2, grid=50, pad=0.1, least_points=3, top=None, z=z_of(0.95, Z_READ))


def counted_items(df: DataFrame, keys: list[str], mask: str = "aggregation_mask") -> DataFrame:
    """(keys, family, bits, num, label, x, y, meta, n): each item of a group once, with the flags that ask for it."""
    of = lambda *flags: F.col(mask).bitwiseAND(sum(flags)).cast("int")
    there = finite(F.col("x")) & finite(F.col("y"))
    passed = parse_bool(F.col("passed")).cast("string")
    meta = dict(df.dtypes)["meta"]
    empty = {"num": "double", "label": "string", "x": "double", "y": "double", "meta": meta}

    def item(family: str, bits: Column, **have: Column) -> Column:
        fields = [have.get(c, F.lit(None)).cast(t).alias(c) for c, t in empty.items()]
        return F.when(bits != 0, F.struct(F.lit(family).alias("family"), bits.alias("bits"), *fields))

    items = F.array_compact(
        F.array(
            item("number", of(STATS, HISTOGRAM, OUTLIERS), num=F.when(finite(F.col("num")), F.col("num"))),
            item("label", of(TALLY), label=F.col("label")),
            item("bool", of(RATE), label=passed),
            item("point", of(ELLIPSE, DENSITY), x=F.when(there, F.col("x")), y=F.when(there, F.col("y"))),
            item("meta", of(RAW), meta=F.col("meta")),
        )
    )
    rows = df.select(*keys, F.explode(items).alias("_i")).select(*keys, "_i.*")
    return materialize(rows.groupBy(*keys, *ITEMS).agg(F.count("*").alias("n")), "items")


def _by_flag(items: DataFrame) -> DataFrame:
    flags = F.filter(F.array(*[F.lit(b) for b in FLAGS.values()]), lambda b: F.col("bits").bitwiseAND(b) != 0)
    return items.withColumn("flag", F.explode(flags)).drop("bits")


def _ends(items: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    n, there = F.col("n"), F.coalesce(F.col("num"), F.col("x")).isNotNull()
    total = lambda c: F.sum(F.when(c, n)).alias
    ends = _by_flag(items).groupBy(*keys, "flag").agg(
        F.coalesce(F.sum(F.when(there, n)), F.lit(0)).alias("have"), F.sum(n).alias("all"), (F.sum(F.col("num") * n) / F.sum(F.when(there, n))).alias("mean"), F.min("num").alias("lo"), F.max("num").alias("hi"),
        F.coalesce(F.sum(F.when(F.col("label") == "true", n)), F.lit(0)).alias("yes"), F.coalesce(F.sum(F.when(F.col("label") == "false", n)), F.lit(0)).alias("no"), F.coalesce(F.sum(F.when(F.col("label").isNotNull(), n)), F.lit(0)).alias("labelled"),
        (F.sum(F.col("x") * n) / F.sum(F.when(there, n))).alias("cx"), (F.sum(F.col("y") * n) / F.sum(F.when(there, n))).alias("cy"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
    )
    wide = {"l": F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")), "h": F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi"))}
    ends = ends.withColumns({"degenerate": (F.col("x0") == F.col("x1")) | (F.col("y0") == F.col("y1")), **wide})
    for c in ("x", "y"):
        pad = F.when(F.col(f"{c}1") > F.col(f"{c}0"), (F.col(f"{c}1") - F.col(f"{c}0")) * rules.pad).otherwise(F.lit(1.0 if rules.pad else 0.5))
        ends = ends.withColumn("_pad", pad).withColumns({f"{c}0": F.col(f"{c}0") - F.col("_pad"), f"{c}1": F.col(f"{c}1") + F.col("_pad")}).drop("_pad")
    return materialize(ends, "ends")


def _cells(items: DataFrame, ends: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    """(keys, flag, a, b, label, n, sums): bins, grid cells and labels with their counts; sums of squares about the means."""
    place = lambda v, lo, hi, parts: F.least(F.floor((F.col(v) - F.col(lo)) / (F.col(hi) - F.col(lo)) * parts), F.lit(parts - 1)).cast("int")
    flag, n = F.col("flag"), F.col("n")
    rows = join_groups(_by_flag(items).where(flag.isin(STATS, HISTOGRAM, TALLY, ELLIPSE, DENSITY)), ends.select(*keys, "flag", "mean", "l", "h", "cx", "cy", "x0", "x1", "y0", "y1"), [*keys, "flag"])
    rows = rows.where(F.coalesce(F.col("num").cast("string"), F.col("x").cast("string"), F.col("label")).isNotNull())
    a = F.when(flag == HISTOGRAM, place("num", "l", "h", rules.bins)).when(flag == DENSITY, place("x", "x0", "x1", rules.grid))
    b = F.when(flag == DENSITY, place("y", "y0", "y1", rules.grid))
    square = lambda p, q: F.sum(n * p * q)
    dv, dx, dy = F.col("num") - F.col("mean"), F.col("x") - F.col("cx"), F.col("y") - F.col("cy")
    cells = rows.groupBy(*keys, "flag", a.alias("a"), b.alias("b"), F.when(flag == TALLY, F.col("label")).alias("label")).agg(
        F.sum(n).alias("n"), square(dv, dv).alias("vv"), square(dx, dx).alias("xx"), square(dy, dy).alias("yy"), square(dx, dy).alias("xy")
    )
    return materialize(cells, "cells")


def one_pass(df: DataFrame, keys: list[str], mask: str = "aggregation_mask", rules: Rules = Rules(), ranked: bool = True) -> dict[str, DataFrame]:  # noqa: B008
    """The result of each analyzer by its flag's name, with the columns that ``analyzers`` gives. df is read once.

    Without ``ranked`` medians, quartiles and outliers are left out.
    """
    items = counted_items(df, keys, mask)
    ends = _ends(items, keys, rules)
    cells = _cells(items, ends, keys, rules)
    of = lambda t, flag: t.where(F.col("flag") == flag).drop("flag")
    have = F.col("have")
    out = {}

    sample = lambda c: F.when(have > 1, F.col(c) / (have - 1)).when(have == 1, F.lit(0.0))
    stats = join_groups(of(ends, STATS), of(cells, STATS).select(*keys, "vv"), keys, "left")
    stats = stats.select(*keys, have.alias("count"), (F.col("all") - have).alias("missing"), "mean", F.col("lo").alias("min"), F.col("hi").alias("max"), F.sqrt(sample("vv")).alias("std"), sample("vv").alias("variance"))
    if ranked:
        numbers = _by_flag(items.where("family = 'number'")).where(F.col("flag").isin(STATS, OUTLIERS))
        ranks = at_counted_ranks(materialize(numbers.where("num is not null").groupBy(*keys, "flag", "num").agg(F.sum("n").alias("n")), "numbers"), [*keys, "flag"], "num", "n", quantile_ranks("median", 0.5) | quantile_ranks("q1", 0.25) | quantile_ranks("q3", 0.75))
        middle = of(ranks, STATS).select(*keys, "median_low", "median_high")
        stats = join_groups(stats, middle, keys, "left").select(*keys, "count", "missing", "mean", between("median", 0.5, F.col("count")).alias("median"), "min", "max", "std", "variance")
        out["OUTLIERS"] = _outliers(of(numbers, OUTLIERS), of(ends, OUTLIERS), of(ranks, OUTLIERS), keys, rules)
    out["STATS"] = stats

    grid = of(ends, HISTOGRAM).where(have >= max(1, rules.least_values)).select(*keys, "l", "h", F.explode(F.sequence(F.lit(0), F.lit(rules.bins - 1))).alias("bin"))
    edge = lambda k: F.col("l") + (F.col("h") - F.col("l")) * (F.col("bin") + k) / rules.bins
    bins = of(cells, HISTOGRAM).select(*keys, F.col("a").alias("bin"), "n")
    out["HISTOGRAM"] = join_groups(grid, bins, [*keys, "bin"], "left").select(*keys, "bin", edge(0).alias("low"), edge(1).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))

    labels = of(cells, TALLY).select(*keys, "label", "n")
    ranked_labels = labels.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("n"), "label")))
    out["TALLY"] = labels if rules.top is None else ranked_labels.where(F.col("rank") <= rules.top)

    rate = of(ends, RATE).select(*keys, "yes", "no", (F.col("all") - F.col("yes") - F.col("no")).alias("missing"), (F.col("yes") + F.col("no")).alias("n"))
    some = F.when(F.col("n") > 0, F.col("n").cast("double"))
    low, high = wilson(F.col("yes").cast("double"), some, rules.z)
    out["RATE"] = rate.withColumns({"rate": F.col("yes") / some, "low": F.when(F.col("n") > 0, low), "high": F.when(F.col("n") > 0, high)})

    m = join_groups(of(ends, ELLIPSE).where(have > 0), of(cells, ELLIPSE).select(*keys, "xx", "yy", "xy"), keys)
    m = m.withColumns({c: F.coalesce(sample(s), F.lit(0.0)) for c, s in (("_a", "xx"), ("_c", "yy"), ("_b", "xy"))})
    half, root = (F.col("_a") + F.col("_c")) / 2, F.sqrt(F.pow((F.col("_a") - F.col("_c")) / 2, 2) + F.col("_b") * F.col("_b"))
    out["SCATTER_ELLIPSE"] = m.select(*keys, have.alias("count"), "cx", "cy", (half + root).alias("lambda1"), (half - root).alias("lambda2"), (F.atan2(2 * F.col("_b"), F.col("_a") - F.col("_c")) / 2).alias("angle"))

    area = (F.col("x1") - F.col("x0")) / rules.grid * ((F.col("y1") - F.col("y0")) / rules.grid)
    spots = join_groups(of(cells, DENSITY).select(*keys, F.col("a").alias("ix"), F.col("b").alias("iy"), "n"), of(ends, DENSITY).where(have >= rules.least_points), keys)
    out["DENSITY_MAP"] = spots.select(*keys, "ix", "iy", "n", (F.col("n") / (have * area)).alias("density"), "x0", "x1", "y0", "y1", "degenerate")

    few = items.where("family = 'meta'").withColumn("_k", F.explode(F.expr("sequence(0, (n - 1) div 1024)")))
    out["RAW"] = few.withColumn("_k", F.explode(F.expr("sequence(1, least(1024, n - 1024 * _k))"))).select(*keys, "meta")
    return out


def _outliers(numbers: DataFrame, ends: DataFrame, ranks: DataFrame, keys: list[str], rules: Rules) -> DataFrame:
    b = join_groups(ends.where("have > 0").select(*keys, F.col("have").alias("count")), ranks, keys, "left")
    b = b.select(*keys, "count", between("q1", 0.25, F.col("count")).alias("q1"), between("q3", 0.75, F.col("count")).alias("q3")).withColumn("iqr", F.col("q3") - F.col("q1"))
    b = b.withColumns({"lower": F.col("q1") - F.lit(rules.factor) * F.col("iqr"), "upper": F.col("q3") + F.lit(rules.factor) * F.col("iqr")})
    wanted = join_groups(numbers, b.where("count >= 4").select(*keys, "lower", "upper"), keys).where("num < lower or num > upper")
    n = wanted.groupBy(*keys).agg(F.sum("n").alias("outlier_count"))
    return join_groups(b, n, keys, "left").withColumn("outlier_count", F.coalesce("outlier_count", F.lit(0))).withColumn("fraction", F.col("outlier_count") / F.col("count"))


def by_mask(df: DataFrame, keys: list[str], mask: str = "aggregation_mask") -> DataFrame:
    """(keys, type, summary): every analyzer on the rows whose mask asks for it, as JSON rows."""
    found = one_pass(df, keys, mask)
    for flag, analyzer in analyzers.ANALYZERS.items():
        if flag not in found:
            found[flag] = analyzer(df.where(F.col(mask).bitwiseAND(analyzers.BITS[flag]) != 0), keys)
    out = None
    found["DENSITY_MAP"] = found["DENSITY_MAP"].drop("x0", "x1", "y0", "y1", "degenerate")
    for flag, part in found.items():
        part = part.select(*keys, F.lit(flag).alias("type"), F.to_json(F.struct(*[c for c in part.columns if c not in keys])).alias("summary"))
        out = part if out is None else out.unionByName(part)
    return out


def read_side(typed: DataFrame, value: str = "value") -> DataFrame:
    """typed (a column of typed values) with the columns that artifacts on demand are computed from: numbers without booleans,
    booleans and 0 and 1 as true and false, other numbers and texts as labels, points. meta is null."""
    num, flag = F.col(f"{value}.num"), F.col(f"{value}.bool")
    passed = F.coalesce(flag, F.when(num == 1, True).when(num == 0, False))
    return typed.withColumns({"num": num, "passed": passed, "label": F.coalesce(passed.cast("string"), num.cast("string"), F.col(f"{value}.str")), "x": F.col(f"{value}.x"), "y": F.col(f"{value}.y"), "meta": F.lit(None).cast("string")})


def artifact_set(df: DataFrame, keys: list[str], mask: str = "aggregation_mask", rules: Rules = ON_DEMAND) -> DataFrame:
    """One row a group, with the artifacts that its rows' masks ask for; what isn't asked for, or has too few values, is null.

    histogram<edges, counts>, categories<labels, counts> (by label), rate<yes, no, n, rate, low, high>, ellipse<count, cx, cy,
    major, minor, angle> (two sigmas, degrees) and contour<x, y, counts> (cell centres, and a row of counts for each y).
    Arrays are as long as the rules say; categories have a row for each label of a group.
    """
    p = one_pass(df, keys, mask, rules, ranked=False)
    ordered = lambda *c: F.sort_array(F.collect_list(F.struct(*c)))
    h = p["HISTOGRAM"].groupBy(*keys).agg(ordered("bin", "low", "high", "n").alias("_r"))
    h = h.select(*keys, F.struct(F.concat(F.col("_r.low"), F.array(F.element_at(F.col("_r.high"), -1))).alias("edges"), F.col("_r.n").alias("counts")).alias("histogram"))
    c = p["TALLY"].groupBy(*keys).agg(ordered("label", "n").alias("_r")).select(*keys, F.struct(F.col("_r.label").alias("labels"), F.col("_r.n").alias("counts")).alias("categories"))
    r = p["RATE"].where("n > 0").select(*keys, F.struct("yes", "no", "n", "rate", "low", "high").alias("rate"))
    axis = lambda v: (2 * F.sqrt(F.greatest(F.col(v), F.lit(0.0))))
    e = p["SCATTER_ELLIPSE"].where("count >= 2").select(*keys, F.struct("count", "cx", "cy", axis("lambda1").alias("major"), axis("lambda2").alias("minor"), F.degrees("angle").alias("angle")).alias("ellipse"))
    d = density_series(p["DENSITY_MAP"], keys, rules.grid).select(*keys, F.struct("x", "y", "counts").alias("contour"))
    out = None
    for part in (h, c, r, e, d):
        out = part if out is None else _both(out, part, keys)
    return out


def density_series(cells: DataFrame, keys: list[str], grid: int) -> DataFrame:
    """(keys, x, y, counts, max_density, levels, degenerate) of a grid's cells: its axes (cell centres), a row of counts for each
    y, the levels at 0.5, 0.8 and 0.95 of the greatest density, and whether all points had one x or one y."""
    d = cells.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct((F.col("iy") * grid + F.col("ix")).alias("k"), "n"))).alias("_n"), F.max("density").alias("max_density"), *[F.first(x).alias(x) for x in ("x0", "x1", "y0", "y1", "degenerate")])
    across = F.sequence(F.lit(0), F.lit(grid - 1))
    centre = lambda a, b: F.transform(across, lambda i: F.col(a) + (F.col(b) - F.col(a)) * (i + 0.5) / grid)
    rows = F.transform(across, lambda y: F.transform(across, lambda x: F.coalesce(F.try_element_at(F.col("_n"), y * grid + x), F.lit(0))))
    levels = F.array(*[F.lit(f) * F.col("max_density") for f in (0.5, 0.8, 0.95)])
    return d.select(*keys, centre("x0", "x1").alias("x"), centre("y0", "y1").alias("y"), rows.alias("counts"), "max_density", levels.alias("levels"), "degenerate")


def _both(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """A full outer join on keys for which null equals null."""
    names = {k: f"_of_{k}" for k in keys}
    other = b.withColumnsRenamed(names)
    on = F.lit(True)
    for k, o in names.items():
        on = on & a[k].eqNullSafe(other[o])
    joined = a.join(other, on, "full_outer")
    return joined.select(*[F.coalesce(a[k], F.col(names[k])).alias(k) for k in keys], *[c for c in a.columns if c not in keys], *[c for c in b.columns if c not in keys])
