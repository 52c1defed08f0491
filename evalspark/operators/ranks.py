"""Exact values at given ranks of a group, and the row before, without a task that holds a whole group.

Equal values of a group are counted first, and the counts are written once to the shared folder; all else is read from
there. The values of a group of few are put in order by one window. Those of a larger group are cut into parts at a few
values that a hash picks; the same rows give the same cuts, whoever computes them and however often. Only the parts in which a
wanted rank lies are sorted, each in its own task. Whether there are larger groups at all is asked once, when the ranks are
called for; if there are none, nothing is planned for them. Both ways are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.sinks import materialize

SMALL = 1_000_000  # different values of a group that one window may put in order; its sort spills
PARTS = 256  # cuts of a larger group, about so many
STEP = 16


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys for which null equals null, as in groups; the keys of ``left`` stay."""
    other = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"`_of_{k}`"))
    return left.join(other, on, how).drop(*[f"_of_{k}" for k in keys])  # semi and anti joins have none to drop


def at_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Column], small: int = SMALL) -> DataFrame:
    """(keys, names): the value at each rank, counted from 0 in ascending order; null for a rank that isn't there.

    ``ranks`` gives every rank by name, from the column ``n``, the group's number of values. Null values don't count; groups
    without any are absent. NaN comes last. An empty table gives no rows.
    """
    rows = df.where(F.col(value).isNotNull())
    counted = rows.groupBy(*keys, F.col(value).alias("_value")).agg(F.count("*").alias("_times"))
    return at_counted_ranks(materialize(counted, "counted"), keys, "_value", "_times", ranks, small)


def at_counted_ranks(counted: DataFrame, keys: list[str], value: str, times: str, ranks: dict[str, Column], small: int = SMALL) -> DataFrame:
    """``at_ranks`` of values that are counted already, each once in its group. ``counted`` is read several times: a stored table."""
    rows = counted.where(F.col(value).isNotNull()).select(F.struct(*keys).alias("_g"), F.col(value).alias("_v"), F.col(times).alias("_m"))  # a struct is never null, so null keys meet
    large = rows.groupBy("_g").agg(F.count("*").alias("_values")).where(F.col("_values") > small).select("_g")
    if not large.take(1):
        return _at_ranks_of_few(rows, ranks).select("_g.*", *ranks)
    few = _at_ranks_of_few(rows.join(large, "_g", "left_anti"), ranks)
    return few.unionByName(_at_ranks_of_large(rows.join(large, "_g", "left_semi"), ranks)).select("_g.*", *ranks)


def _wants(ranks: dict[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank")) for name, rank in ranks.items()])


def _found(ends: DataFrame, ranks: dict[str, Column]) -> DataFrame:
    """(_g, names) from (_g, _v, _m, _end, _wants): the value whose occurrences end at _end holds the ranks before that."""
    inside = lambda w: (w["rank"] < F.col("_end")) & (w["rank"] >= F.col("_end") - F.col("_m"))
    found = ends.select("_g", "_v", F.explode_outer(F.filter("_wants", inside)).alias("_w"))
    return found.groupBy("_g").agg(*[F.max(F.when(F.col("_w.name") == name, F.col("_v"))).alias(name) for name in ranks])


def _at_ranks_of_few(rows: DataFrame, ranks: dict[str, Column]) -> DataFrame:
    group = W.partitionBy("_g")
    ends = rows.withColumns({"n": F.sum("_m").over(group), "_end": F.sum("_m").over(group.orderBy("_v").rowsBetween(W.unboundedPreceding, 0))})
    return _found(ends.withColumn("_wants", _wants(ranks)), ranks)


def _at_ranks_of_large(counted: DataFrame, ranks: dict[str, Column]) -> DataFrame:
    sizes = counted.groupBy("_g").agg(F.sum("_m").alias("n"), F.count("*").alias("_values"))
    picked = F.pmod(F.xxhash64("_v"), F.greatest(F.lit(1), F.floor(F.col("_values") / PARTS))) == 0
    cuts = counted.join(sizes, "_g").where(picked).groupBy("_g").agg(F.sort_array(F.collect_list("_v")).alias("_cuts"))
    cuts = cuts.withColumn("_each", F.filter("_cuts", lambda c, i: i % STEP == STEP - 1))
    below = lambda c: F.size(F.filter(c, lambda x: x < F.col("_v")))
    placed = counted.join(cuts, "_g", "left").withColumn("_part", F.when(F.col("_cuts").isNull(), 0).otherwise(below("_each") * STEP))
    placed = placed.withColumn("_part", F.when(F.col("_cuts").isNull(), 0).otherwise(F.col("_part") + below(F.slice("_cuts", F.col("_part") + 1, F.lit(STEP))))).drop("_cuts", "_each")

    sums = placed.groupBy("_g", "_part").agg(F.sum("_m").alias("_m"))
    sums = sums.withColumn("_before", F.sum("_m").over(W.partitionBy("_g").orderBy("_part")) - F.col("_m")).join(sizes, "_g")
    held = F.filter(_wants(ranks), lambda w: (w["rank"] >= F.col("_before")) & (w["rank"] < F.col("_before") + F.col("_m")))
    sums = sums.select("_g", "_part", "_before", held.alias("_wants")).where(F.size("_wants") > 0)

    part = W.partitionBy("_g", "_part").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    ends = placed.join(sums, ["_g", "_part"]).withColumn("_end", F.col("_before") + F.sum("_m").over(part))
    return _found(ends, ranks)


def quantile_ranks(name: str, p: float) -> dict[str, Column]:
    """The two ranks between which the quantile p lies by linear interpolation."""
    at = (F.col("n") - 1) * F.lit(p)
    return {f"{name}_low": F.floor(at), f"{name}_high": F.ceil(at)}


def between(name: str, p: float, n: Column) -> Column:
    """The quantile from the values at ``quantile_ranks``."""
    at = (n - 1) * F.lit(p)
    low, high = F.col(f"{name}_low"), F.col(f"{name}_high")
    return F.when(low == high, low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)


def row_before(df: DataFrame, keys: list[str], order: list[str], columns: list[str], block: Column) -> DataFrame:
    """df with ``_before``, a struct of ``columns`` in the row before it in its group; null in the first row.

    ``block`` must not fall while ``order`` grows. Rows meet within (keys, block) only; of every block its last row goes on to
    the next, so one task sees one block, or one row of each block of a group.
    """
    row = F.struct(*columns)
    df = df.withColumn("_block", block)
    last = df.groupBy(*keys, "_block").agg(F.max_by(row, F.struct(*order)).alias("_last"))
    last = last.select(*keys, "_block", F.lag("_last").over(W.partitionBy(*keys).orderBy("_block")).alias("_carried"))
    w = W.partitionBy(*keys, "_block").orderBy(*order)
    out = join_groups(df.withColumns({"_near": F.lag(row).over(w), "_first": F.row_number().over(w) == 1}), last, [*keys, "_block"])
    return out.withColumn("_before", F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_near"))).drop("_block", "_near", "_first", "_carried")


def positions(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """df with each row's place in its group, from 0, in ``order`` (nulls first). Rows that are equal there come in any order.

    Rows are dealt by range of (keys, order), which splits a hot group as any other, and sorted within each range; a group's
    place in a range follows from the counts of the ranges before, one row each. No task sorts a group. The ranges are written
    to the shared folder once, so that all that reads them sees the same.
    """
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn("_id", F.monotonically_increasing_id())
    rows = materialize(ranged, "ranged").withColumn("_range", F.shiftright("_id", 33))
    sizes = rows.groupBy(*keys, "_range").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select(*keys, "_range", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_offset"))
    return join_groups(rows, offsets, [*keys, "_range"]).withColumn(name, F.col("_id") + F.col("_offset")).drop("_id", "_range", "_offset")
