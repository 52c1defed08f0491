"""Registered queries that run as streams: over what is there, to its end, with their output in the shared folder.

Each gives what its batch twin gives, and the SQL says the same. A stream's checkpoint and output lie under a new path for each
call; it is stopped when it has read all.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit
from ..sources import adapters as A
from ..sources import sinks
from ..streaming import streams
from .registered import KEYS, OK, ORACLE_SQL, M, ctes, query

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocks(spark: SparkSession):
    """The state store that stateful processors need; what the session had comes back afterwards."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(STORE, before) if before else spark.conf.unset(STORE)


def stored_stream(df: DataFrame, name: str) -> DataFrame:
    """``df``, stored in the shared folder and read as a stream."""
    path = sinks.shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def run_out(stream: DataFrame, name: str) -> DataFrame:
    """All that a stream gives, once it has read what there is."""
    spark = stream.sparkSession
    path = sinks.shared_path(spark, name)
    stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


@query(f"""{ctes(M)}, w AS (SELECT *, (epoch_us(ts) // 3600000000) * 3600 AS s FROM m), last AS (SELECT max(ts) AS t FROM m)
SELECT {KEYS}, s AS window_start_unix, count(*) AS count, sum(num) AS sum, avg(num) AS avg, min(num) AS min, max(num) AS max FROM w, last WHERE num IS NOT NULL GROUP BY {KEYS}, s, t HAVING (s + 3600) * 1000000 <= epoch_us(t) - 10000000""", "sum avg")
def str01_stream_windows(spark, d):
    """Hourly windows as a stream closes them: those that end behind the watermark, ten seconds before the latest event."""
    return run_out(streams.windowed_summary(stored_stream(A.metrics(spark, d), "metrics"), "1 hour", "10 seconds"), "windows")


@query(f"{ctes(A.CHAIN_SQL, OK)} SELECT source_id, seq FROM ck WHERE NOT link_ok")
def str06_chain_breaks(spark, d):
    """Breaks of every chain as they arrive, in two streams: the second goes on from the tails that the first one's checkpoint holds."""
    log = audit.tamper(audit.build(A.chain(spark, d))).select("source_id", "seq", "content_hash", "prev_hash")
    log = sinks.materialize(log, "log")
    with rocks(spark):
        path = sinks.shared_path(spark, "head")
        head = streams.chain_breaks(stored_stream(log.where("seq < 2"), "head"))
        head.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
        tails = sinks.materialize(streams.saved_tails(spark, f"{path}/checkpoint"), "tails")
        rest = run_out(streams.chain_breaks(stored_stream(log.where("seq >= 2"), "rest"), tails), "rest")
    return spark.read.schema(head.schema).parquet(f"{path}/out").unionByName(rest)


@query("""WITH e AS (SELECT event_id, user_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS value FROM events)
SELECT 'events' AS topic, user_id::VARCHAR AS key, value, NULL AS source FROM e UNION ALL SELECT 'audit', user_id::VARCHAR, value, 'events/' || user_id FROM e""")
def snk07_stream_with_audit(spark, d):
    """Every record and its audit copy, written from one cached micro-batch, each batch in a folder of its own."""
    records = sinks.topic_records(stored_stream(A.table(spark, d, "events").select("event_id", "event_type", "user_id"), "events"), "events", F.col("user_id"), ["event_id", "event_type"])
    path = sinks.shared_path(spark, "topics")
    sinks.stream_with_audit(records, f"{path}/events", f"{path}/audit", "audit", f"{path}/checkpoint").awaitTermination()
    one, copy = (spark.read.schema(records.schema).parquet(f"{path}/{t}") for t in ("events", "audit"))
    header = lambda name: F.element_at(F.filter("headers", lambda h: h["key"] == name), 1)["value"].cast("string")
    told = one.withColumn("source", F.lit(None).cast("string")).unionByName(copy.withColumn("source", F.concat_ws("/", header("source-topic"), header("source-key"))))
    return told.select("topic", "key", "value", "source")


@query("SELECT floor(epoch(ts) / 86400)::BIGINT AS day, count(*) AS n, sum(value) AS sum FROM events GROUP BY 1", "sum")
def snk01_stream_by_day(spark, d):
    """Summaries of hours, as a stream writes them by batch and day, read back by day."""
    hours = A.table(spark, d, "events").groupBy((F.floor(F.unix_timestamp(A.utc("ts")) / 3600) * 3600).alias("window_start_unix")).agg(F.count("*").alias("n"), F.sum("value").alias("sum"))
    path = sinks.shared_path(spark, "days")
    sinks.stream_by_day(stored_stream(hours, "hours"), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    back = spark.read.schema("window_start_unix long, n long, sum double").parquet(f"{path}/out")
    return back.groupBy(F.floor(F.col("window_start_unix") / 86400).alias("day")).agg(F.sum("n").alias("n"), F.sum("sum").alias("sum"))


@query(f"SELECT user_id, event_type, accepted_us FROM ({ORACLE_SQL['str04_dedup_ttl']})")
def str04_stream_ttl(spark, d):
    """The exact rule of the batch, with one accepted time for each key as state."""
    events = A.table(spark, d, "events").select("user_id", "event_type", A.utc("ts").alias("ts"))
    with rocks(spark):
        return run_out(streams.accepted_by_ttl(stored_stream(events, "events"), ["user_id", "event_type"], 86_400), "accepted")


@query(f"""{ctes(A.LIFECYCLE_SQL)} SELECT task_id, (count(*) OVER w)::BIGINT AS events, lower(substr(event_type, 6)) AS status, array_to_string(list(event_type || '@' || epoch(ts)::BIGINT) OVER (PARTITION BY task_id ORDER BY ts, event_type ROWS BETWEEN 1 PRECEDING AND CURRENT ROW), ',') AS history
FROM life WINDOW w AS (PARTITION BY task_id ORDER BY ts, event_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def str05_task_states(spark, d):
    """The state of every task after each of its events, with its last two events. No task expires while the stream runs."""
    events = A.lifecycle(spark, d).select("task_id", "event_type", "ts", "directory_key", "processor_name", "duration_ms", "error")
    with rocks(spark):
        told = run_out(streams.task_states(stored_stream(events, "events"), cap=2, ttl=10**9), "states")
    history = F.from_json("history", "array<array<string>>")
    return told.select("task_id", "events", "status", F.array_join(F.transform(history, lambda e: F.concat_ws("@", e[0], e[1])), ",").alias("history"))


ARRIVALS = "arr AS (SELECT *, least(4, greatest(0, date_diff('day', DATE '2024-01-01', ts::DATE) // 7)) + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS b FROM events)"


@query(f"""WITH {ARRIVALS}, marks AS (SELECT b, max(floor(epoch(ts))::BIGINT) AS last FROM arr GROUP BY 1), k AS (SELECT b, max(last) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 10 AS mark FROM marks),
r AS (SELECT event_type, value, b, (epoch_us(ts) // 3600000000) * 3600 AS s, mark FROM arr JOIN k USING (b)), t AS (SELECT *, coalesce(s + 3600 + 86400 <= mark, false) AS late FROM r)
SELECT event_type AS processor_name, s AS window_start_unix, late, count(*) AS count, sum(value) AS sum, count(DISTINCT b) AS updates FROM t GROUP BY ALL""", "sum")
def str02_late_output(spark, d):
    """Events arrive week by week, every tenth a week late: what is at most a day behind the watermark still updates its window,
    the rest leaves by the side. The stream is started again for each arrival."""
    week = F.least(F.lit(4), F.greatest(F.lit(0), F.floor(F.date_diff(F.to_date("ts"), F.to_date(F.lit("2024-01-01"))) / 7)))
    events = A.metrics(spark, d).withColumn("b", (week + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)).cast("int")).drop("aggregation_mask")
    path = sinks.shared_path(spark, "late")
    schema = events.drop("b").schema
    for b in range(6):
        events.where(F.col("b") == b).drop("b").write.mode("append").parquet(f"{path}/in")
        streams.windows_with_late_rows(spark.readStream.schema(schema).parquet(f"{path}/in"), f"{path}/out", f"{path}/checkpoint", "1 hour", 10, 86_400).awaitTermination()
    kept = streams.open_windows(spark, f"{path}/out").select("processor_name", "window_start_unix", F.lit(False).alias("late"), "count", "sum", "updates")
    side = spark.read.parquet(f"{path}/out/late").groupBy("processor_name", "window_start_unix").agg(F.count("*").alias("count"), F.sum("num").alias("sum"), F.count_distinct("batch").alias("updates"))
    return kept.unionByName(side.withColumn("late", F.lit(True)))
