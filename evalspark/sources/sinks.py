"""Summaries by day of their window, records for a topic, and their audit copies."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; a local one only where the session names none, as in tests."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    where = where or tempfile.mkdtemp(prefix="spark-")
    return f"{where}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends there, and whoever reads it twice computes it once."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by_day(summaries: DataFrame, path: str) -> None:
    """Parquet by day of the window; days that are written again replace what was there, others stay. A large day is dealt to several tasks."""
    day = F.date_format(F.timestamp_seconds("window_start_unix"), "yyyy-MM-dd")
    summaries.withColumn("day", day).hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def write_batch(batch: DataFrame, batch_id: int, path: str, by: list[str] | None = None) -> None:
    """One micro-batch into its own folder ``batch=<id>`` below ``path``: a batch that is replayed replaces all that it wrote
    before, so that every row is there once, whenever a stream is started again. Within the folder, partitions are those of ``by``."""
    out = batch.hint("rebalance", *by) if by else batch
    out.write.mode("overwrite").partitionBy(*(by or [])).parquet(f"{path}/batch={batch_id}")


def stream_by_day(summaries: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """A stream of summaries to Parquet by batch and day of the window (``write_by_day`` for batches)."""
    day = F.date_format(F.timestamp_seconds("window_start_unix"), "yyyy-MM-dd")
    write = lambda batch, n: write_batch(batch.withColumn("day", day), n, path, ["day"])
    return summaries.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def put_values(batch: DataFrame, batch_id: int, path: str) -> None:
    """Values of windows under their own keys (a hash of processor, version, metric and window), one file set a batch."""
    key = F.sha2(F.concat_ws("|", "processor_name", "processor_version", "metric_name", F.col("window_start_unix").cast("string")), 256)
    write_batch(batch.withColumn("key", key), batch_id, path)


def newest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """What ``write_batch`` wrote, the last batch of each key only: the view in which a key's later document replaces the earlier."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def stream_with_audit(records: DataFrame, path: str, audit_path: str, audit_topic: str, checkpoint: str) -> StreamingQuery:
    """A stream of records, written to ``path``, and their audit copies to ``audit_path``: two writes from one cached micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(batch, batch_id, path)
            write_batch(with_audit_copy(batch, audit_topic).where(F.col("topic") == audit_topic), batch_id, audit_path)
        finally:
            batch.unpersist()

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def topic_records(df: DataFrame, topic: str, key: F.Column, fields: list[str]) -> DataFrame:
    """(topic, key, value, headers) as a message sink takes them: the value is a JSON object of ``fields``."""
    headers = F.array(F.struct(F.lit("content-type").alias("key"), F.encode(F.lit("application/json"), "utf-8").alias("value")))
    return df.select(F.lit(topic).alias("topic"), key.cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"), headers.alias("headers"))


def with_audit_copy(records: DataFrame, audit_topic: str) -> DataFrame:
    """Every record and its audit copy, whose headers name the topic and key it came from. The input is read once."""
    header = lambda k, v: F.struct(F.lit(k).alias("key"), F.encode(F.coalesce(v, F.lit("")), "utf-8").alias("value"))
    copy = F.struct(F.lit(audit_topic).alias("topic"), "key", "value", F.concat("headers", F.array(header("source-topic", F.col("topic")), header("source-key", F.col("key")))).alias("headers"))
    return records.select(F.explode(F.array(F.struct("topic", "key", "value", "headers"), copy)).alias("r")).select("r.*")


def publish(records: DataFrame, servers: str, checkpoint: str | None = None):
    """To a message broker: a batch write, or a stream if ``records`` is one. The connector must be on the class path."""
    out = records.select("topic", "key", "value", "headers")
    if records.isStreaming:
        return out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("includeHeaders", "true").option("checkpointLocation", checkpoint).start()
    return out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("includeHeaders", "true").save()
