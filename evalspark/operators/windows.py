"""Aggregation of measurements per key and window: one shuffle, all statistics in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import at_ranks, join_groups

KEY = ["processor_name", "processor_version", "metric_name"]


def windowed(df: DataFrame, size: str, step: str | None = None, ts: str = "ts") -> DataFrame:
    """df with window_start_unix and window_end_unix of every epoch-aligned window that a row falls into."""
    w = F.window(ts, size, step) if step else F.window(ts, size)
    return df.withColumn("_w", w).withColumns({"window_start_unix": F.unix_timestamp("_w.start"), "window_end_unix": F.unix_timestamp("_w.end")}).drop("_w")


def rank_percentile(p: int) -> Column:
    """The rank of a percentile among ``n`` sorted values: floor(n * p / 100), the last at most."""
    return F.least(F.floor(F.col("n") * p / 100), F.col("n") - 1)


def brief_summary(df: DataFrame, size: str) -> DataFrame:
    """count, sum, avg, min, max and the greatest mask."""
    return windowed(df.where("num is not null"), size).groupBy(*KEY, "window_start_unix", "window_end_unix").agg(F.count("*").alias("count"), F.sum("num").alias("sum"), F.avg("num").alias("avg"), F.min("num").alias("min"), F.max("num").alias("max"), F.max("aggregation_mask").alias("aggregation_mask"))


def mergeable_summary(df: DataFrame, size: str) -> DataFrame:
    """What can be merged over windows, and the averages that follow from it: one aggregation, no ranks. count covers rows
    without a number too; a window without any has sum, mean and deviation 0 and no least and greatest. ``std`` is the
    population's."""
    return windowed(df, size).groupBy(*KEY, "window_start_unix", "window_end_unix").agg(
        F.count("*").alias("count"), F.count("num").alias("numeric_count"), F.coalesce(F.sum("num"), F.lit(0.0)).alias("sum"), F.coalesce(F.avg("num"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.stddev_pop("num"), F.lit(0.0)).alias("std"), F.min("num").alias("min"), F.max("num").alias("max"),
    )


def full_summary(df: DataFrame, size: str, upper_median: bool = False) -> DataFrame:
    """``mergeable_summary`` with median and rank percentiles, null in windows without a number.

    Median and percentiles come from counted ranks, so a window of any number of values is split over tasks. ``upper_median``
    takes the upper of two middle values.
    """
    keys = [*KEY, "window_start_unix", "window_end_unix"]
    n = F.col("n")
    ranks = {"_lower": F.floor((n - 1) / 2), "_upper": F.floor(n / 2), "p95": rank_percentile(95), "p99": rank_percentile(99)}
    out = join_groups(mergeable_summary(df, size), at_ranks(windowed(df, size), keys, "num", ranks), keys, "left")
    median = F.col("_upper") if upper_median else (F.col("_lower") + F.col("_upper")) / 2
    return out.select(*[c for c in out.columns if c not in ranks], median.alias("median"), "p95", "p99")


def point_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    ok = F.col("x").isNotNull() & F.col("y").isNotNull()
    cols = [f(F.when(ok, F.col(c))).alias(f"{c}_{n}") for c in ("x", "y") for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]
    return df.groupBy(*keys).agg(F.count(F.when(ok, 1)).alias("point_count"), *cols)


def collect_values(df: DataFrame, size: str) -> DataFrame:
    """The values of every window in order of time, with the first mask; one array a window, so windows bound the memory."""
    order = F.struct("ts", "event_id")
    g = windowed(df, size).groupBy(*KEY, "window_start_unix", "window_end_unix")
    out = g.agg(F.count("*").alias("count"), F.min_by("aggregation_mask", order).alias("aggregation_mask"), F.array_sort(F.collect_list(F.struct("ts", "event_id", "num"))).alias("_s"))
    return out.withColumn("values", F.expr("transform(_s, s -> s.num)")).drop("_s")


def combined(df: DataFrame, size: str) -> DataFrame:
    """One document for each key and window: the full summary, the summary of its points and its values in order of time.

    df has num, x and y; a row is a number, a point or neither. Windows without points count none.
    """
    keys = [*KEY, "window_start_unix", "window_end_unix"]
    out = join_groups(full_summary(df, size), point_summary(windowed(df, size), keys), keys)
    return join_groups(out, collect_values(df, size).drop("count"), keys)


def roll_up(aggregates: DataFrame, by: list[str]) -> DataFrame:
    """Windows merged: only what can be merged (counts, sums, least, greatest) and the averages that follow."""
    return aggregates.groupBy(*by).agg(
        F.count("*").alias("windows"), F.sum("count").alias("count"), F.sum("numeric_count").alias("numeric_count"), F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.max("window_end_unix").alias("last_window_end"),
    ).withColumns({"avg": F.when(F.col("count") > 0, F.col("sum") / F.col("count")), "numeric_avg": F.when(F.col("numeric_count") > 0, F.col("sum") / F.col("numeric_count"))})
