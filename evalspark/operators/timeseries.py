"""Counters, bucketed quantiles, instant and range queries, and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranks import join_groups, row_before


def increase(samples: DataFrame, size: str, keys: list[str]) -> DataFrame:
    """Increase of a counter in every window: a value below the one before means it started again from zero.

    A series is split by window; the last sample of each goes on to the next. Samples without a time take no part.
    """
    s = samples.where("ts is not null").withColumn("_w", F.window("ts", size))
    s = row_before(s, keys, ["ts", "event_id"], ["value"], F.col("_w.start"))
    before = F.col("_before.value")
    step = F.when(before.isNull(), F.lit(0.0)).when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    g = s.groupBy(*keys, "_w").agg(F.sum(step).alias("increase"), F.count("*").alias("samples"))
    return g.withColumns({"window_start_unix": F.unix_timestamp("_w.start"), "rate": F.col("increase") / (F.unix_timestamp("_w.end") - F.unix_timestamp("_w.start"))}).drop("_w")


def bucket_quantile(buckets: DataFrame, keys: list[str], q: float) -> DataFrame:
    """A quantile from cumulative counts (le, n), by a line within the bucket; the last finite bound for the open one."""
    w = W.partitionBy(*keys).orderBy("le")
    whole = W.partitionBy(*keys)
    b = buckets.withColumns({"low": F.coalesce(F.lag("le").over(w), F.lit(0.0)), "below": F.coalesce(F.lag("n").over(w), F.lit(0)), "total": F.max("n").over(whole)})
    hit = b.where((F.col("n") >= F.col("total") * q) & (F.col("total") > 0)).withColumn("k", F.row_number().over(w)).where("k = 1")
    inside = F.col("low") + (F.col("le") - F.col("low")) * ((F.col("total") * q - F.col("below")) / (F.col("n") - F.col("below")))
    return hit.select(*keys, F.when(F.col("le") == float("inf"), F.col("low")).otherwise(inside).alias("value"))


def instant(samples: DataFrame, keys: list[str]) -> DataFrame:
    return samples.groupBy(*keys).agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"), F.max(F.unix_micros("ts")).alias("ts_us"))


def total(samples: DataFrame, keys: list[str]) -> DataFrame:
    """(total): the sum of the last samples of all series, in one row; 0 if there are none."""
    return instant(samples, keys).agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"))


def pipeline_status(gauges: DataFrame, keys: list[str]) -> DataFrame:
    """healthy or stopped, by the last sample of the gauge ``up`` alone, and how many workers of the pool are at work."""
    last = instant(gauges, [*keys, "name"])
    of = lambda n: F.coalesce(F.max(F.when(F.col("name") == n, F.col("value"))), F.lit(0.0))
    g = last.groupBy(*keys).agg((of("up") == 1.0).alias("running"), of("workers_active").cast("int").alias("active"), of("worker_pool_size").cast("int").alias("pool"))
    detail = F.when(~F.col("running"), "not running").when(F.col("active") > 0, F.concat_ws("/", "active", F.concat("pool", F.lit(" processing")))).otherwise(F.concat("pool", F.lit(" workers idle")))
    return g.withColumns({"status": F.when(F.col("running"), "healthy").otherwise("stopped"), "detail": detail})


def on_grid(samples: DataFrame, keys: list[str], start: int, end: int, step: int, stale: int) -> DataFrame:
    """The last sample at or before every step, no older than ``stale`` seconds.

    Of the samples between two steps the last one is found before anything is shuffled; what is then put in order is one row
    for each step of a series. Samples without a time or after the last step take no part.
    """
    t = F.unix_timestamp("ts")
    steps = F.greatest(F.lit(0), F.ceil((t - start) / step)).cast("long")
    rows = samples.where((t <= end) & (steps <= (end - start) // step))
    last = rows.groupBy(*keys, (steps * step + start).alias("t")).agg(F.max_by(F.struct(t.alias("at"), "value"), F.struct(t, "event_id")).alias("s"))
    grid = last.select(*keys).distinct().withColumn("t", F.explode(F.sequence(F.lit(start).cast("long"), F.lit(end).cast("long"), F.lit(step).cast("long"))))
    w = W.partitionBy(*keys).orderBy("t").rowsBetween(W.unboundedPreceding, 0)
    seen = join_groups(grid, last, [*keys, "t"], "left").withColumn("s", F.last("s", ignorenulls=True).over(w))
    return seen.where(F.col("t") - F.col("s.at") <= stale).select(*keys, F.col("t").alias("step_unix"), F.col("s.value").alias("value"))


def log_counts(logs: DataFrame, size: str) -> DataFrame:
    g = logs.groupBy(F.window("ts", size).alias("_w"), "level").agg(F.count("*").alias("n"))
    return g.select(F.unix_timestamp("_w.start").alias("window_start_unix"), "level", "n")


def log_search(logs: DataFrame, text: str, level: str | None = None, pattern: str | None = None) -> DataFrame:
    out = logs.where(F.contains(F.col("message"), F.lit(text)))
    out = out.where(F.col("level") == level) if level else out
    return out.where(F.col("message").rlike(pattern)) if pattern else out
