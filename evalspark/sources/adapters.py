"""The driver tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utc(column: str) -> F.Column:
    """A timestamp whether the file holds one or a timestamp without zone, which watermarks refuse."""
    return F.col(column).cast("timestamp")


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as numeric measurements: one metric, ``value``, for each event type."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("processor_name"), F.lit("1.0.0").alias("processor_version"), F.lit("value").alias("metric_name"),
        F.col("value").alias("num"), utc("ts").alias("ts"), "event_id", F.lit(7).alias("aggregation_mask"),
    )


def mixed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metrics in which every seventh measurement is a point (value, user) and no number."""
    point = F.col("event_id") % 7 == 3
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("processor_name"), F.lit("1.0.0").alias("processor_version"), F.lit("value").alias("metric_name"), utc("ts").alias("ts"), "event_id",
        F.when(~point, F.col("value")).alias("num"), F.when(point, F.col("value")).alias("x"), F.when(point, F.col("user_id").cast("double")).alias("y"), F.lit(7).alias("aggregation_mask"),
    )


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with a column for each analyzer and a mask that asks for every set of them in turn."""
    return table(spark, sf_dir, "events").select(
        "event_type", F.col("value").alias("num"), (F.col("user_id") % 10).cast("string").alias("label"), (F.col("value") > 50).alias("passed"),
        F.col("value").alias("x"), F.col("user_id").cast("double").alias("y"), F.col("event_id").alias("meta"), (F.col("event_id") % 256).alias("aggregation_mask"),
    )


MEASUREMENTS_SQL = "ms AS (SELECT event_type, value AS num, (user_id % 10)::VARCHAR AS label, value > 50 AS passed, value AS x, user_id::DOUBLE AS y, event_id AS meta, (event_id % 256)::BIGINT AS mask FROM events)"


def raw_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as JSON text of every kind of value, dealt by event_id."""
    v = F.round("value", 2).cast("string")
    kind = F.col("event_id") % 7
    raw = (
        F.when(kind == 0, v)
        .when(kind == 1, F.when(F.col("value") > 50, "true").otherwise("false"))
        .when(kind == 2, F.when(F.col("value") > 50, '"yes"').otherwise('"no"'))
        .when(kind == 3, F.concat(F.lit('{"x":'), v, F.lit(',"y":'), F.col("user_id").cast("string"), F.lit("}")))
        .when(kind == 4, F.concat(F.lit("["), v, F.lit(",1.5]")))
        .when(kind == 5, "null")
        .otherwise("{broken")
    )
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("metric_name"), utc("ts").alias("ts"), raw.alias("raw"))


RAW_SQL = """
raw AS (SELECT event_id, event_type AS metric_name, ts, value, user_id,
  CASE event_id % 7 WHEN 0 THEN 'number' WHEN 1 THEN 'bool' WHEN 2 THEN 'string' WHEN 3 THEN 'point' WHEN 4 THEN 'array' WHEN 5 THEN 'null' END AS kind,
  CASE WHEN event_id % 7 = 0 THEN round(value, 2) END AS num, CASE WHEN event_id % 7 = 1 THEN value > 50 END AS bool,
  CASE WHEN event_id % 7 = 2 THEN CASE WHEN value > 50 THEN 'yes' ELSE 'no' END END AS str,
  CASE WHEN event_id % 7 = 3 THEN round(value, 2) END AS x, CASE WHEN event_id % 7 = 3 THEN user_id::DOUBLE END AS y
  FROM events)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as points (quantity, extended price) for each return flag."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("metric_name"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))


def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as task events: created, then for status P started, for status F started and completed, or failed for every tenth."""
    o = table(spark, sf_dir, "orders").withColumn("t", utc("o_orderdate"))
    hour = lambda n: F.col("t") + F.expr(f"interval {n} hours")
    created = F.struct(F.lit("TASK_CREATED").alias("event_type"), hour(0).alias("ts"))
    started = F.struct(F.lit("TASK_STARTED").alias("event_type"), hour(1).alias("ts"))
    done = F.struct(F.when(F.col("o_orderkey") % 10 == 0, "TASK_FAILED").otherwise("TASK_COMPLETED").alias("event_type"), hour(2).alias("ts"))
    steps = F.when(F.col("o_orderstatus") == "F", F.array(created, started, done)).when(F.col("o_orderstatus") == "P", F.array(created, started)).otherwise(F.array(created))
    rows = o.select(F.col("o_orderkey").alias("task_id"), F.concat(F.lit("dir"), (F.col("o_custkey") % 25).cast("string")).alias("directory_key"), F.col("o_orderpriority").alias("processor_name"), (F.col("o_totalprice") / 100).alias("price"), F.explode(steps).alias("e"))
    ended = F.col("e.event_type")
    return rows.select(
        "task_id", ended.alias("event_type"), "e.ts",
        F.when(ended == "TASK_CREATED", F.col("directory_key")).alias("directory_key"),
        F.when(ended != "TASK_CREATED", F.col("processor_name")).alias("processor_name"),
        F.when(ended == "TASK_COMPLETED", F.col("price")).alias("duration_ms"),
        F.when(ended == "TASK_FAILED", F.concat(F.lit("error "), (F.col("task_id") % 3).cast("string"))).alias("error"),
    )


LIFECYCLE_SQL = """
steps AS (SELECT o_orderkey AS task_id, o_orderdate AS t, 'dir' || (o_custkey % 25) AS dk, o_orderpriority AS pn, o_totalprice / 100 AS price,
  unnest(CASE o_orderstatus WHEN 'F' THEN [0, 1, 2] WHEN 'P' THEN [0, 1] ELSE [0] END) AS k FROM orders),
life AS (SELECT task_id, CASE k WHEN 0 THEN 'TASK_CREATED' WHEN 1 THEN 'TASK_STARTED' ELSE CASE WHEN task_id % 10 = 0 THEN 'TASK_FAILED' ELSE 'TASK_COMPLETED' END END AS event_type,
  t + to_hours(k) AS ts, CASE WHEN k = 0 THEN dk END AS directory_key, CASE WHEN k > 0 THEN pn END AS processor_name,
  CASE WHEN k = 2 AND task_id % 10 <> 0 THEN price END AS duration_ms, CASE WHEN k = 2 AND task_id % 10 = 0 THEN 'error ' || (task_id % 3) END AS error FROM steps)"""


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation and region as a route table; directories 20 to 24 have none."""
    n = table(spark, sf_dir, "nation").where("n_nationkey < 20")
    return n.join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat(F.lit("dir"), F.col("n_nationkey").cast("string")).alias("directory_key"), F.concat(F.lit("model_"), F.lower("r_name")).alias("algorithm"), F.lit("1.0.0").alias("version"))


ROUTES_SQL = "routes AS (SELECT 'dir' || n_nationkey AS directory_key, 'model_' || lower(r_name) AS algorithm, '1.0.0' AS version FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20)"


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as stored objects: bucket by language, task by doc_id % 97."""
    return table(spark, sf_dir, "documents").where("text is not null").select(
        F.coalesce("lang", F.lit("none")).alias("bucket"), F.sha2("text", 256).alias("content_hash"), F.octet_length("text").cast("long").alias("size"),
        "doc_id", (F.col("doc_id") % 97).alias("task_id"), F.col("source").alias("processor_name"), F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 3 == 0, ".json").when(F.col("doc_id") % 3 == 1, ".PNG").otherwise(".xyz")).alias("name"),
        "text",
    )


ARTIFACTS_SQL = """art AS (SELECT coalesce(lang, 'none') AS bucket, sha256(text) AS content_hash, strlen(text)::BIGINT AS size, doc_id, doc_id % 97 AS task_id, source AS processor_name,
  'doc' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.json' WHEN 1 THEN '.PNG' ELSE '.xyz' END AS name, text FROM documents WHERE text IS NOT NULL)"""


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as one event chain for each conversation; every tenth conversation is tampered with at turn 1."""
    c = table(spark, sf_dir, "conversations").where("conv_id is not null and turn is not null")
    return c.select(F.col("conv_id").alias("source_id"), F.col("turn").alias("seq"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("body"))


CHAIN_SQL = """c0 AS (SELECT conv_id AS source_id, turn AS seq, coalesce(role, '') AS role, coalesce(text, '') AS body FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
c1 AS (SELECT *, sha256('{"body": ' || to_json(body)::VARCHAR || ', "role": ' || to_json(role)::VARCHAR || '}') AS content_hash FROM c0),
chained AS (SELECT *, lag(content_hash) OVER (PARTITION BY source_id ORDER BY seq, content_hash) AS prev_hash FROM c1),
log AS (SELECT source_id, seq, role, CASE WHEN source_id % 10 = 3 AND seq = 1 THEN body || '!' ELSE body END AS body, content_hash,
  CASE WHEN source_id % 10 = 7 AND seq = 1 THEN 'broken' ELSE prev_hash END AS prev_hash FROM chained)"""


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as samples of one counter a type, which starts again each day."""
    from pyspark.sql import Window as W

    e = table(spark, sf_dir, "events").withColumn("t", utc("ts"))
    day = W.partitionBy("event_type", F.to_date("t")).orderBy("t", "event_id").rowsBetween(W.unboundedPreceding, 0)
    return e.select(F.col("event_type").alias("name"), (F.col("user_id") % 2).alias("instance"), F.col("t").alias("ts"), "event_id", F.count("*").over(day).cast("double").alias("value"))


COUNTERS_SQL = "samples AS (SELECT event_type AS name, user_id % 2 AS instance, ts, event_id, (count(*) OVER (PARTITION BY event_type, ts::DATE ORDER BY ts, event_id))::DOUBLE AS value FROM events)"
