"""Event logs, metric records, stored documents, log lines, directories and route files as DataFrames."""

from __future__ import annotations

import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENVELOPE = "event_id long, event_type string, source_id long, timestamp string, payload string"
METRIC = "processor_name string, processor_version string, metric_name string, value double, aggregation_mask int, timestamp string"


def parsed(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """JSON text in the columns of ``schema``; lines that are null, blank or no JSON objects are left out."""
    fields = F.from_json(F.col(column), f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    return lines.where(F.length(F.trim(F.col(column))) > 0).withColumn("_j", fields).where("_j is not null and _j._broken is null").select(*[c for c in lines.columns if c != column], "_j.*").drop("_broken")


def when(text: F.Column) -> F.Column:
    """A timestamp from any of the forms that writers use; null if none fits."""
    forms = ["yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]", "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd HH:mm:ss,SSS"]
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in forms], F.timestamp_seconds(text.try_cast("double")))


def event_log(lines: DataFrame) -> DataFrame:
    return parsed(lines, ENVELOPE).withColumn("timestamp", when(F.col("timestamp")))


def metric_rows(lines: DataFrame) -> DataFrame:
    """Measurements with a value; version and mask have defaults."""
    m = parsed(lines, METRIC).where("value is not null and metric_name is not null")
    return m.withColumns({"processor_version": F.coalesce("processor_version", F.lit("1.0.0")), "aggregation_mask": F.coalesce("aggregation_mask", F.lit(1)), "timestamp": when(F.col("timestamp"))})


def log_lines(lines: DataFrame) -> DataFrame:
    """(level, logger, message, ts) of structured log lines; without a readable time ts is null, without a level it is INFO."""
    r = parsed(lines, "timestamp string, level string, logger string, message string")
    return r.select(*[c for c in lines.columns if c != "value"], F.upper(F.coalesce("level", F.lit("INFO"))).alias("level"), "logger", "message", when(F.col("timestamp")).alias("ts"))


def directory(spark: SparkSession, path: str, extensions: list[str], content: bool = False) -> DataFrame:
    """Files below ``path`` by extension, whatever its case; Spark leaves empty files out. Content is read only if asked for."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return allowed(files, extensions).select("path", F.col("modificationTime").alias("mtime"), "length", *["content"] * content)


def record_listing(spark: SparkSession, path: str, extensions: list[str], listings: str) -> None:
    """Appends a listing of ``path`` (path, mtime, length) to the folder ``listings``, for ``streams.changed_files`` to read."""
    directory(spark, path, extensions).write.mode("append").parquet(listings)


def allowed(listing: DataFrame, extensions: list[str]) -> DataFrame:
    """The rows of a listing whose path has one of the extensions, in any case."""
    return listing.where(F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1)).isin([e.lower() for e in extensions]))


def changed_files(listing: DataFrame, seen: DataFrame) -> DataFrame:
    """Files that are new or younger than when they were last seen."""
    last = seen.groupBy("path").agg(F.max("mtime").alias("_seen"))
    return listing.join(last, "path", "left").where("_seen is null or mtime > _seen").drop("_seen")


def ready_files(before: DataFrame, now: DataFrame, as_of: F.Column, stable_seconds: int) -> DataFrame:
    """Files of the same size and time in two listings, untouched for so many seconds."""
    return now.join(before.select("path", "length", "mtime"), ["path", "length", "mtime"], "left_semi").where(F.unix_timestamp(as_of) - F.unix_timestamp("mtime") >= stable_seconds)


def routes(spark: SparkSession, text: str) -> DataFrame:
    """A route table from TOML, one table for each directory; each needs path, algorithm and version."""
    rows = []
    for key, route in tomllib.loads(text).items():
        if missing := {"path", "algorithm", "version"} - route.keys():
            raise ValueError(f"route {key}: no {', '.join(sorted(missing))}")
        rows.append((key, route["path"], route["algorithm"], str(route["version"]), {k: str(v) for k, v in route.get("settings", {}).items()}))
    return spark.createDataFrame(rows, "directory_key string, path string, algorithm string, version string, settings map<string,string>")
