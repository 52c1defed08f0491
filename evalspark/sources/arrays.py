"""Stored documents of named arrays: histograms, grids and outlines as typed columns, found again by key or by content.

A document has a bucket, a key, a hash of its content and a map from names to arrays of numbers, each with its shape and its values
in row order. Documents with equal arrays have equal hashes. A null array is left out; a document without arrays is stored
all the same, with an empty map. An empty table gives no documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARRAY = "struct<shape: array<int>, values: array<double>>"
SCHEMA = f"bucket string, key string, content_hash string, arrays map<string, {ARRAY}>"


def vector(values: Column) -> Column:
    """An array of numbers as a stored array."""
    values = values.cast("array<double>")
    return F.when(values.isNotNull(), F.struct(F.array(F.size(values)).alias("shape"), values.alias("values")).cast(ARRAY))


def grid(rows: Column) -> Column:
    """An array of equally long rows as a stored array."""
    rows = rows.cast("array<array<double>>")
    across = F.coalesce(F.size(F.get(rows, 0)), F.lit(0))
    return F.when(rows.isNotNull(), F.struct(F.array(F.size(rows), across).alias("shape"), F.flatten(rows).alias("values")).cast(ARRAY))


def rows_of(array: Column) -> Column:
    """The rows of a stored grid."""
    many, across = array["shape"][0], array["shape"][1]
    return F.when(many == 0, F.array().cast("array<array<double>>")).otherwise(F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.slice(array["values"], i * across + 1, across)))


def documents(df: DataFrame, bucket: Column, key: Column, arrays: dict[str, Column]) -> DataFrame:
    """(bucket, key, content_hash, arrays) of each row of ``df``; ``arrays`` are made with ``vector`` or ``grid``."""
    entries = F.array_compact(F.array(*[F.when(a.isNotNull(), F.struct(F.lit(n).alias("key"), a.alias("value"))) for n, a in sorted(arrays.items())]))
    made = df.select(bucket.cast("string").alias("bucket"), key.cast("string").alias("key"), entries.alias("_e"))
    return made.select("bucket", "key", F.sha2(F.to_json("_e"), 256).alias("content_hash"), F.map_from_entries("_e").alias("arrays"))


def write(docs: DataFrame, path: str) -> None:
    """Adds documents to a store, by bucket. Of documents with equal keys in a bucket ``read`` gives the newest."""
    docs.withColumn("stored_at", F.current_timestamp()).write.mode("append").partitionBy("bucket").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a store, the last one written under each key."""
    stored = spark.read.schema(f"{SCHEMA}, stored_at timestamp").parquet(path)
    last = F.max_by(F.struct("content_hash", "arrays"), F.struct("stored_at", "content_hash")).alias("_d")
    return stored.groupBy("bucket", "key").agg(last).select("bucket", "key", "_d.*")


def fetch(stored: DataFrame, wanted: DataFrame, by: str) -> DataFrame:
    """Each row of ``wanted`` (bucket and ``by``: key or content_hash) once, with the arrays found there, and whether there are any.

    Equal contents under several keys are one content: the least key is told.
    """
    if by == "content_hash":
        stored = stored.groupBy("bucket", "content_hash").agg(F.min_by(F.struct("key", "arrays"), "key").alias("_d")).select("bucket", "content_hash", "_d.*")
    asked = wanted.select("bucket", by).distinct()
    other = "key" if by == "content_hash" else "content_hash"
    return asked.join(stored.select("bucket", by, other, "arrays"), ["bucket", by], "left").withColumn("found", F.col("arrays").isNotNull())
