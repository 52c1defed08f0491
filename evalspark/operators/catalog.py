"""Stored artifacts, the metric catalogue, and deduplicated content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import type_names
from .windows import KEY, roll_up


def metric_catalog(aggregates: DataFrame, mask: int) -> DataFrame:
    return roll_up(aggregates, KEY).withColumn("types", F.concat_ws(",", type_names(F.lit(mask))))


def metric_detail(aggregates: DataFrame, metric: str, processor: str | None = None, version: str | None = None) -> DataFrame:
    """One row: the newest stored summary of a metric, of its first processor and version unless they are named.

    Without a match the row has no_data, a count and sum of 0 and nulls. aggregates has an aggregation_mask.
    """
    match = F.col("metric_name") == metric
    for column, wanted in (("processor_name", processor), ("processor_version", version)):
        match = match & (F.col(column) == wanted) if wanted else match
    kept = ["count", "sum", "mean", "min", "max", "std", "median", "p95", "p99"]
    found = F.min_by(F.struct(*KEY, "aggregation_mask", *kept), F.struct("processor_name", "processor_version", -F.col("window_end_unix")))
    row = aggregates.where(match).agg(found.alias("f"))  # one row, whatever matches
    told = {"metric_name": metric, "processor_name": processor or "", "processor_version": version or "", "aggregation_mask": 0, "count": 0, "sum": 0.0}
    row = row.select(*[F.coalesce(f"f.{c}", F.lit(told[c])).alias(c) if c in told else F.col(f"f.{c}").alias("avg" if c == "mean" else c) for c in [*KEY, "aggregation_mask", *kept]], F.col("f").isNull().alias("no_data"))
    return row.withColumn("types", F.concat_ws(",", type_names(F.col("aggregation_mask"))))


def metric_data(details: DataFrame, values: DataFrame, artifacts: DataFrame, key: str = "processor_name") -> DataFrame:
    """Rows of ``metric_detail`` with the values and artifacts of their metric; an absent metric keeps its empty row, with nulls.
    values and artifacts have one row a key."""
    return details.join(values, key, "left").join(artifacts, key, "left")


def bucket_stats(artifacts: DataFrame) -> DataFrame:
    g = artifacts.groupBy("bucket").agg(F.count("*").alias("objects"), F.sum("size").alias("bytes"))
    return g.withColumn("mb", F.round(F.col("bytes") / (1024 * 1024), 2))


def store(artifacts: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """What a content-addressed store adds: the first object of each bucket and hash that isn't there yet."""
    g = artifacts.groupBy("bucket", "content_hash").agg(F.min("doc_id").alias("doc_id"), F.min("size").alias("size"), F.count("*").alias("copies"))
    return g.join(existing.select("bucket", "content_hash"), ["bucket", "content_hash"], "left_anti") if existing is not None else g


def dedup_stats(artifacts: DataFrame) -> DataFrame:
    s = store(artifacts)
    return s.groupBy("bucket").agg(F.sum("copies").alias("objects"), F.count("*").alias("stored"), F.sum(F.col("copies") - 1).alias("hits"), F.sum((F.col("copies") - 1) * F.col("size")).alias("bytes_saved"))


def recent_tasks(artifacts: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """Tasks by their newest artifact, with counts and the first processor."""
    g = artifacts.groupBy("task_id").agg(F.count("*").alias("artifacts"), F.max("doc_id").alias("newest"), F.min_by("processor_name", F.when(F.col("processor_name") != "", F.col("doc_id"))).alias("processor_name"))
    return g.orderBy(F.desc("newest"), "task_id").offset(offset).limit(max(1, min(200, limit)))


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key."""
    w = W.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def retention(objects: DataFrame, days: dict[str, int], as_of_us: str) -> DataFrame:
    """Objects that stay: younger than their bucket's limit, or in a bucket without one (0)."""
    limit = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in days.items() for x in p]), F.col("bucket")), F.lit(0)) if days else F.lit(0)
    return objects.where((limit == 0) | (F.col("stored_us") >= F.col(as_of_us) - limit.cast("long") * 86_400_000_000))


def lookup(artifacts: DataFrame, wanted: DataFrame, key: str = "content_hash") -> DataFrame:
    """(key, found, objects, size): every wanted key once, also those that no artifact has. A null key is never found."""
    have = artifacts.groupBy(key).agg(F.count("*").alias("objects"), F.max("size").alias("size"))
    told = wanted.select(key).distinct().join(have, key, "left")
    return told.select(key, F.col("objects").isNotNull().alias("found"), F.coalesce("objects", F.lit(0)).alias("objects"), "size")


def delete(artifacts: DataFrame, wanted: DataFrame, key: str = "content_hash") -> tuple[DataFrame, DataFrame]:
    """What stays when all objects under the wanted keys go, and for each key whether it was there (``lookup``)."""
    return artifacts.join(wanted.select(key).distinct(), key, "left_anti"), lookup(artifacts, wanted, key)
