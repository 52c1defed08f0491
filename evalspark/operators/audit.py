"""Hash chains per source: building, verifying, and their state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import canonical


def content_hash() -> F.Column:
    return F.sha2(canonical(role=F.col("role"), body=F.col("body")), 256)


def build(events: DataFrame) -> DataFrame:
    """events (source_id, seq, role, body) with content_hash and prev_hash."""
    w = W.partitionBy("source_id").orderBy("seq", "content_hash")
    return events.withColumn("content_hash", content_hash()).withColumn("prev_hash", F.lag("content_hash").over(w))


def tamper(log: DataFrame) -> DataFrame:
    """A log with known faults, for tests and benchmarks: a changed body, a broken link."""
    first = F.col("seq") == 1
    return log.withColumns({"body": F.when((F.col("source_id") % 10 == 3) & first, F.concat("body", F.lit("!"))).otherwise(F.col("body")), "prev_hash": F.when((F.col("source_id") % 10 == 7) & first, F.lit("broken")).otherwise(F.col("prev_hash"))})


def checked(log: DataFrame) -> DataFrame:
    """log with content_ok and link_ok; the first event of a source may have a previous hash (a log may start late)."""
    w = W.partitionBy("source_id").orderBy("seq", "content_hash")
    before = F.lag("content_hash").over(w)
    return log.withColumns({"position": F.row_number().over(w), "content_ok": content_hash() == F.col("content_hash"), "link_ok": before.isNull() | before.eqNullSafe(F.col("prev_hash"))})


def verify(log: DataFrame) -> DataFrame:
    c = checked(log)
    g = c.groupBy("source_id").agg(F.count("*").alias("event_count"), F.count(F.when(~F.col("content_ok"), 1)).alias("content_errors"), F.count(F.when(~F.col("link_ok"), 1)).alias("link_errors"))
    return g.withColumn("valid", (F.col("content_errors") + F.col("link_errors")) == 0)


def errors(log: DataFrame) -> DataFrame:
    kinds = F.array_compact(F.array(F.when(~F.col("content_ok"), "content_mismatch"), F.when(~F.col("link_ok"), "link_mismatch")))
    return checked(log).select("source_id", "seq", "position", F.explode(kinds).alias("error"))


def state(log: DataFrame) -> DataFrame:
    return log.groupBy("source_id").agg(F.max_by("content_hash", F.struct("seq", "content_hash")).alias("last_hash"), F.count("*").alias("event_count"))


def state_after_resets(log: DataFrame, resets: DataFrame | None = None) -> DataFrame:
    """``state`` where the chains of some sources began anew: what came up to a source's last reset (source_id, seq) is
    forgotten. A reset whose source_id is null is one of all sources. A source with nothing after its reset has no state."""
    if resets is None:
        return state(log)
    own = resets.where("source_id is not null").groupBy("source_id").agg(F.max("seq").alias("_own"))
    every = resets.where("source_id is null").agg(F.max("seq")).first()[0]  # one number
    last = F.greatest("_own", F.lit(every).cast("long"))
    return state(log.join(own, "source_id", "left").where(last.isNull() | (F.col("seq") > last)).drop("_own"))


def chain_status(sources: DataFrame, log: DataFrame, copies: DataFrame) -> DataFrame:
    """(source_id, status, event_count, message) of every source: valid or invalid by its stored events; kafka_only where only
    ``copies`` (source_id) of its events wait in the topic; no_events else. Sources are told once; null ids are left out."""
    v = verify(log).withColumn("_bad", F.col("content_errors") + F.col("link_errors")).select("source_id", F.col("event_count").alias("_n"), "_bad")
    waiting = copies.groupBy("source_id").agg(F.count("*").alias("_waiting"))
    s = sources.where("source_id is not null").select("source_id").distinct().join(v, "source_id", "left").join(waiting, "source_id", "left")
    told = F.when(F.col("_n") > 0, F.when(F.col("_bad") == 0, "valid").otherwise("invalid")).when(F.col("_waiting") > 0, "kafka_only").otherwise("no_events")
    s = s.withColumn("status", told)
    message = (
        F.when(told == "valid", "chain verified")
        .when(told == "invalid", F.concat(F.lit("chain check failed: "), F.col("_bad").cast("string"), F.lit(" errors")))
        .when(told == "kafka_only", F.concat(F.col("_waiting").cast("string"), F.lit(" events wait in the topic")))
        .otherwise("no events")
    )
    return s.select("source_id", "status", F.coalesce("_n", "_waiting", F.lit(0)).alias("event_count"), message.alias("message"))


def topic_statistics(records: DataFrame) -> DataFrame:
    """(partition, objects, low, high, span, last_time) of records (partition, offset, ts), high being one past the last offset,
    and a last row of all partitions (partition null) with the sum of spans. A topic without records has that row alone, of zeros."""
    one = records.groupBy("partition").agg(F.count("*").alias("objects"), F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"), F.max("ts").alias("last_time"))
    one = one.withColumn("span", F.col("high") - F.col("low"))
    every = one.agg(F.coalesce(F.sum("objects"), F.lit(0)).alias("objects"), F.coalesce(F.sum("span"), F.lit(0)).alias("span"), F.max("last_time").alias("last_time"), F.count("*").alias("partitions"))
    return one.withColumn("partitions", F.lit(1).cast("long")).unionByName(every, allowMissingColumns=True)


def status(log: DataFrame) -> DataFrame:
    v = verify(log)
    return v.select("source_id", F.when(F.col("event_count") == 0, "no_events").when(F.col("valid"), "valid").otherwise("invalid").alias("status"), "event_count")


def reconcile(operational: DataFrame, audit: DataFrame) -> DataFrame:
    """Which events lack a copy, or have another one."""
    a = operational.select("source_id", "seq", F.col("content_hash").alias("h1"))
    b = audit.select("source_id", "seq", F.col("content_hash").alias("h2"))
    s = F.when(F.col("h2").isNull(), "missing_in_audit").when(F.col("h1").isNull(), "only_in_audit").when(F.col("h1") != F.col("h2"), "altered").otherwise("same")
    return a.join(b, ["source_id", "seq"], "full_outer").select("source_id", "seq", s.alias("state"))
