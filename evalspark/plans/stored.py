"""Queries over logs, listings, messages, stores and sets; registered beside those of ``registered``."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import analyzers, audit, catalog, lifecycle, timeseries, windows
from ..sources import adapters as A
from ..sources import readers, sinks
from .registered import FULL, KEYS, MW, OK, M, ctes, query


# --- sources: events as lines of JSON, every 50th broken ---
def _lines(spark, d, **fields):
    e = A.table(spark, d, "events").withColumn("at", F.date_format(A.utc("ts"), "yyyy-MM-dd HH:mm:ss"))
    line = F.to_json(F.struct(*[F.expr(v).alias(k) for k, v in fields.items()]))
    return e.select(F.col("event_id").alias("offset"), F.when(F.col("event_id") % 50 == 0, F.substring(line, 1, 20)).when(F.col("event_id") % 50 == 1, "  ").otherwise(line).alias("value"))


@query("SELECT event_id AS \"offset\", event_id, event_type, user_id AS source_id, floor(epoch(ts))::BIGINT AS at, props AS payload FROM events WHERE event_id % 50 > 1")
def src01_event_log(spark, d):
    lines = _lines(spark, d, event_id="event_id", event_type="event_type", source_id="user_id", timestamp="at", payload="props")
    return readers.event_log(lines).select("offset", "event_id", "event_type", "source_id", F.unix_timestamp("timestamp").alias("at"), "payload")


@query("SELECT event_type AS processor_name, '1.0.0' AS processor_version, 'value' AS metric_name, count(*) AS n, min(value) AS low, max(value) AS high, sum(CASE WHEN event_id % 4 = 0 THEN 1 ELSE 7 END)::BIGINT AS masks FROM events WHERE event_id % 50 > 1 AND event_id % 3 > 0 GROUP BY 1")
def src03_metric_records(spark, d):
    lines = _lines(spark, d, processor_name="event_type", metric_name="'value'", value="if(event_id % 3 > 0, value, null)", aggregation_mask="if(event_id % 4 = 0, null, 7)", timestamp="at")
    return readers.metric_rows(lines).groupBy("processor_name", "processor_version", "metric_name").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"), F.sum("aggregation_mask").alias("masks"))


@query(f"{ctes(A.LIFECYCLE_SQL)}, few AS (SELECT * FROM life ORDER BY ts, task_id, event_type LIMIT 5000) SELECT task_id, lower(substr(arg_max(event_type, (ts, event_type)), 6)) AS status, count(*) AS event_count FROM few GROUP BY 1 HAVING count(*) FILTER (event_type = 'TASK_CREATED') > 0")
def src04_replay(spark, d):
    """State as of the first 5,000 events: the limit is the reader's ``max_events``."""
    few = A.lifecycle(spark, d).orderBy("ts", "task_id", "event_type").limit(5000)
    return lifecycle.current_state(few).select("task_id", "status", "event_count")


@query(f"{ctes(A.ARTIFACTS_SQL)} SELECT doc_id, bucket || '/' || name AS path, size FROM art WHERE doc_id % 3 < 2")
def src05_directory(spark, d):
    """A listing of stored objects, by extensions whatever their case."""
    listing = A.artifacts(spark, d).select("doc_id", F.concat_ws("/", "bucket", "name").alias("path"), "size")
    return readers.allowed(listing, [".json", ".png"])


@query(f"{ctes(MW, FULL)} SELECT {KEYS}, window_start_unix, count, CASE WHEN count % 2 = 0 THEN 0 ELSE sum END AS sum, CASE WHEN count % 2 = 0 THEN 1 ELSE 7 END AS aggregation_mask FROM full_agg", "sum")
def src07_aggregate_records(spark, d):
    """Summaries as flat JSON, of which some lack fields, read with defaults."""
    s = windows.full_summary(A.metrics(spark, d), "1 hour")
    odd = F.col("count") % 2 == 1
    lines = s.select(F.to_json(F.struct(*windows.KEY, "window_start_unix", "count", F.when(odd, F.col("sum")).alias("sum"), F.when(odd, 7).alias("aggregation_mask"))).alias("value"))
    r = readers.parsed(lines, "processor_name string, processor_version string, metric_name string, window_start_unix long, count long, sum double, aggregation_mask int")
    return r.withColumns({"sum": F.coalesce("sum", F.lit(0.0)), "aggregation_mask": F.coalesce("aggregation_mask", F.lit(1))})


@query("SELECT event_id AS \"offset\", CASE event_type WHEN 'error' THEN 'ERROR' ELSE 'INFO' END AS level, 'app.' || event_type AS logger, CASE WHEN event_id % 7 < 6 THEN floor(epoch(ts))::BIGINT END AS at FROM events WHERE event_id % 50 > 1")
def src10_log_lines(spark, d):
    at = "case event_id % 7 when 0 then replace(at, ' ', 'T') when 1 then concat(at, ',000') when 2 then concat(replace(at, ' ', 'T'), 'Z') when 6 then 'yesterday' else at end"
    lines = _lines(spark, d, timestamp=at, level="case when event_type = 'error' then 'error' when event_id % 2 = 0 then 'info' end", logger="concat('app.', event_type)", message="props")
    return readers.log_lines(lines).select("offset", "level", "logger", F.unix_timestamp("ts").alias("at"))


@query(f"{ctes(A.COUNTERS_SQL)} SELECT name, instance, count(*) AS samples, min(value) AS low, max(value) AS high FROM samples GROUP BY ALL")
def src11_counter_samples(spark, d):
    return A.counters(spark, d).groupBy("name", "instance").agg(F.count("*").alias("samples"), F.min("value").alias("low"), F.max("value").alias("high"))


# --- sinks ---
@query(f"{ctes(MW, FULL)} SELECT {KEYS}, window_start_unix, count, mean, strftime(to_timestamp(window_start_unix) AT TIME ZONE 'UTC', '%Y-%m-%d') AS day FROM full_agg", "mean")
def snk01_summaries_by_day(spark, d):
    """What the store holds after a full write and a second one of even days alone."""
    s = windows.full_summary(A.metrics(spark, d), "1 hour")
    path = sinks.shared_path(spark, "summaries")
    sinks.write_by_day(s, path)
    sinks.write_by_day(s.where("floor(window_start_unix / 86400) % 2 = 0"), path)
    return spark.read.parquet(path).select(*windows.KEY, "window_start_unix", "count", "mean", F.col("day").cast("string").alias("day"))


@query(f"{ctes(MW)} SELECT 'aggregates' AS topic, processor_name || '.' || metric_name AS key, '{{\"window_start_unix\":' || window_start_unix || ',\"count\":' || count(*) || '}}' AS value FROM mw GROUP BY {KEYS}, window_start_unix")
def snk02_summaries_to_topic(spark, d):
    s = windows.brief_summary(A.metrics(spark, d), "1 hour")
    return sinks.topic_records(s, "aggregates", F.concat_ws(".", "processor_name", "metric_name"), ["window_start_unix", "count"]).drop("headers")


@query("SELECT topic, CASE topic WHEN 'audit' THEN 'content-type,source-topic,source-key' ELSE 'content-type' END AS headers, key, count(*) AS n FROM (SELECT user_id::VARCHAR AS key, unnest(['events', 'audit']) AS topic FROM events) GROUP BY ALL")
def snk07_audit_copy(spark, d):
    r = sinks.with_audit_copy(sinks.topic_records(A.table(spark, d, "events"), "events", F.col("user_id"), ["event_id", "event_type"]), "audit")
    return r.groupBy("topic", F.array_join("headers.key", ",").alias("headers"), "key").agg(F.count("*").alias("n"))


@query("SELECT 'events' AS topic, user_id::VARCHAR AS key, '{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\"}' AS value FROM events")
def snk08_event_publish(spark, d):
    return sinks.topic_records(A.table(spark, d, "events"), "events", F.col("user_id"), ["event_id", "event_type"]).drop("headers")


# --- projections and predicates ---
@query("SELECT event_id, coalesce(CASE WHEN event_id % 3 > 0 THEN event_type END, 'unknown') AS processor_name, value FROM events")
def prj01_flatten_payload(spark, d):
    e = A.table(spark, d, "events").withColumn("payload", F.struct(F.when(F.col("event_id") % 3 > 0, F.col("event_type")).alias("processor_name"), "value"))
    return e.select("event_id", F.coalesce("payload.processor_name", F.lit("unknown")).alias("processor_name"), "payload.value")


@query(f"{ctes(MW)} SELECT {KEYS}, window_start_unix, CASE WHEN window_start_unix % 36000 = 0 THEN 0 ELSE avg(num) END AS mean FROM mw GROUP BY {KEYS}, window_start_unix", "mean")
def prj08_mean_of_either_path(spark, d):
    """One name for the average of both writers: one writes ``mean``, sometimes 0 beside a stale ``avg``, the other ``avg`` alone.
    A zero is a value, not a gap."""
    a = windows.brief_summary(A.metrics(spark, d), "1 hour")
    start = F.col("window_start_unix")
    zero, own = start % 36000 == 0, start % 7200 == 0
    a = a.withColumns({"mean": F.when(zero, F.lit(0.0)).when(own, F.col("avg")), "avg": F.when(zero, F.lit(99.0)).when(~own, F.col("avg"))})
    return a.select(*windows.KEY, "window_start_unix", F.coalesce("mean", "avg").alias("mean"))


@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT task_id, duration_ms FROM life WHERE event_type = 'TASK_COMPLETED' AND duration_ms IS NOT NULL")
def fil01_event_type(spark, d):
    return A.lifecycle(spark, d).where("event_type = 'TASK_COMPLETED' and duration_ms is not null").select("task_id", "duration_ms")


@query(f"{ctes(A.RAW_SQL)} SELECT event_id, kind FROM raw WHERE kind IN ('number', 'bool')")
def fil02_numeric_only(spark, d):
    return A.raw_values(spark, d).select("event_id", V.typed(F.col("raw"))["kind"].alias("kind")).where(F.col("kind").isin("number", "bool"))


@query(f"{ctes(A.LIFECYCLE_SQL)}, s AS (SELECT task_id, lower(substr(arg_max(event_type, (ts, event_type)), 6)) AS status FROM life GROUP BY 1) SELECT * FROM s WHERE status = 'started'")
def fil05_status(spark, d):
    return lifecycle.current_state(A.lifecycle(spark, d)).where("status = 'started'").select("task_id", "status")


@query("SELECT doc_id FROM documents WHERE strlen(text) > 0")
def fil10_with_data(spark, d):
    return A.table(spark, d, "documents").where(F.octet_length("text") > 0).select("doc_id")


# --- joins ---
@query(f"{ctes(A.ROUTES_SQL)} SELECT algorithm, count(*) AS files FROM (SELECT 'dir' || (o_custkey % 25) AS directory_key FROM orders) JOIN routes USING (directory_key) GROUP BY 1")
def join04_listing_with_algorithm(spark, d):
    listing = A.table(spark, d, "orders").select(F.concat(F.lit("dir"), (F.col("o_custkey") % 25).cast("string")).alias("directory_key"))
    return lifecycle.dispatch(listing, A.routes(spark, d))[0].groupBy("algorithm").agg(F.count("*").alias("files"))


def _listing(spark, d):
    return A.table(spark, d, "orders").select(F.concat(F.lit("/in/"), F.col("o_orderkey").cast("string")).alias("path"), A.utc("o_orderdate").alias("mtime"), F.col("o_custkey").alias("length"), F.col("o_orderkey").alias("k"))


@query("SELECT '/in/' || o_orderkey AS path, o_custkey AS length FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0")
def join06_changed_files(spark, d):
    """Orders as files: of those not seen before (every third) or seen older (every fifth)."""
    seen = _listing(spark, d).where("k % 3 <> 0").withColumn("mtime", F.when(F.col("k") % 5 == 0, F.col("mtime") - F.expr("interval 1 hour")).otherwise(F.col("mtime")))
    return readers.changed_files(_listing(spark, d), seen.select("path", "mtime")).select("path", "length")


@query("SELECT '/in/' || o_orderkey AS path FROM orders, (SELECT max(o_orderdate) AS t FROM orders) WHERE o_orderkey % 4 <> 0 AND epoch(t) - epoch(o_orderdate) >= 864000")
def str08_ready_files(spark, d):
    now = _listing(spark, d)
    before = now.withColumn("length", F.when(F.col("k") % 4 == 0, F.col("length") - 1).otherwise(F.col("length")))
    return readers.ready_files(before, now.join(F.broadcast(now.agg(F.max("mtime").alias("as_of")))), F.col("as_of"), 864000).select("path")


@query(f"{ctes(MW, FULL)} SELECT {KEYS}, max(window_start_unix) AS window_start_unix, arg_max(count, window_start_unix) AS count, sum(count)::BIGINT AS total FROM full_agg GROUP BY {KEYS}")
def join09_catalog_with_latest(spark, d):
    s = windows.mergeable_summary(A.metrics(spark, d), "1 hour")
    last = catalog.latest(s, windows.KEY, ["window_start_unix"]).select(*windows.KEY, "window_start_unix", "count")
    return s.groupBy(*windows.KEY).agg(F.sum("count").alias("total")).join(last, windows.KEY)


@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT a.task_id, epoch_ms(b.ts) - epoch_ms(a.ts) AS latency_ms FROM life a JOIN life b ON a.task_id = b.task_id AND a.event_type = 'TASK_CREATED' AND b.event_type = 'TASK_STARTED'")
def join10_message_latency(spark, d):
    e = A.lifecycle(spark, d)
    sent, got = (e.where(F.col("event_type") == t).select("task_id", F.unix_millis("ts").alias(n)) for t, n in (("TASK_CREATED", "sent"), ("TASK_STARTED", "got")))
    return sent.join(got, "task_id").select("task_id", (F.col("got") - F.col("sent")).alias("latency_ms"))


# --- aggregates, analyzers, on-demand artifacts ---
@query(f"{ctes(M)} SELECT event_id, (epoch_us(ts) // 60000000) * 60 AS window_start_unix FROM m")
def agg01_tumbling_window(spark, d):
    return windows.windowed(A.metrics(spark, d), "60 seconds").select("event_id", "window_start_unix")


@query("SELECT event_id, props AS meta FROM events WHERE (event_id % 256)::BIGINT & 128 <> 0")
def anl08_raw(spark, d):
    e = A.table(spark, d, "events")
    return e.where(V.has_flag(F.col("event_id") % 256, "RAW")).select("event_id", F.col("props").alias("meta"))


ELLIPSE = """m AS (SELECT l_returnflag AS metric_name, count(*) AS count, avg(l_quantity) AS cx, avg(l_extendedprice) AS cy, var_samp(l_quantity) AS a, var_samp(l_extendedprice) AS c, covar_samp(l_quantity, l_extendedprice) AS b FROM lineitem GROUP BY 1),
e AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b) AS lambda1, degrees(atan2(2 * b, a - c) / 2) AS angle FROM m WHERE count >= 2)"""


@query(f"WITH {ELLIPSE} SELECT metric_name, count, cx, cy, round(2 * sqrt(lambda1), 3) AS major, angle FROM e", "cx cy angle")
def art04_ellipse_on_demand(spark, d):
    e = analyzers.ellipse(A.points(spark, d), ["metric_name"]).where("count >= 2")
    return e.select("metric_name", "count", "cx", "cy", F.round(2 * F.sqrt("lambda1"), 3).alias("major"), F.degrees("angle").alias("angle"))


@query(f"{ctes(MW)}, v AS (SELECT {KEYS}, list(num) AS v FROM mw GROUP BY {KEYS}) SELECT {KEYS}, len(v) AS count, list_avg(v) AS mean, list_median(v) AS median, list_min(v) AS min, list_max(v) AS max, list_stddev_samp(v) AS std FROM v", "mean median std")
def art07_stats_of_stored(spark, d):
    """Statistics over stored arrays of values: exploded again, so no group is held whole."""
    v = windows.collect_values(A.metrics(spark, d), "1 hour").select(*windows.KEY, F.explode("values").alias("num"))
    return analyzers.stats(v, windows.KEY).select(*windows.KEY, "count", "mean", "median", "min", "max", "std")


# --- state, stores ---
@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT task_id, lower(substr(arg_max(event_type, (ts, event_type)), 6)) AS status FROM life WHERE task_id = (SELECT max(o_orderkey) FROM orders) GROUP BY 1")
def life03_task_by_id(spark, d):
    """One task: the predicate goes below the aggregation to the scan."""
    key = A.table(spark, d, "orders").agg(F.max("o_orderkey")).first()[0]
    return lifecycle.current_state(A.lifecycle(spark, d).where(F.col("task_id") == F.lit(key))).select("task_id", "status")


def _asked(spark, d):
    return A.table(spark, d, "documents").where("text is not null and doc_id % 9 = 0").select(F.sha2("text", 256).alias("content_hash")).distinct()


ASKED = "asked AS (SELECT DISTINCT sha256(text) AS content_hash FROM documents WHERE text IS NOT NULL AND doc_id % 9 = 0)"


@query(f"{ctes(A.ARTIFACTS_SQL, ASKED)} SELECT content_hash, count(*) AS objects, max(size) AS size FROM art JOIN asked USING (content_hash) GROUP BY 1")
def cat10_info_by_hash(spark, d):
    return A.artifacts(spark, d).join(_asked(spark, d), "content_hash").groupBy("content_hash").agg(F.count("*").alias("objects"), F.max("size").alias("size"))


@query(f"{ctes(A.ARTIFACTS_SQL, ASKED)} SELECT bucket, count(*) AS kept FROM art WHERE content_hash NOT IN (SELECT content_hash FROM asked) GROUP BY 1")
def cat11_delete_by_hash(spark, d):
    return A.artifacts(spark, d).join(_asked(spark, d), "content_hash", "left_anti").groupBy("bucket").agg(F.count("*").alias("kept"))


@query(f"{ctes(A.ARTIFACTS_SQL, ASKED)} SELECT doc_id, text FROM art WHERE content_hash IN (SELECT content_hash FROM asked)")
def cat13_retrieve(spark, d):
    return A.artifacts(spark, d).join(_asked(spark, d), "content_hash", "left_semi").select("doc_id", "text")


# --- audit ---
@query(f"{ctes(A.CHAIN_SQL)} SELECT source_id, seq, content_hash FROM c1")
def aud01_content_hash(spark, d):
    return A.chain(spark, d).select("source_id", "seq", audit.content_hash().alias("content_hash"))


@query(f"{ctes(A.CHAIN_SQL, OK)} SELECT source_id, seq, content_hash, content_ok, link_ok FROM ck")
def aud05_verify_events(spark, d):
    """Every event alone, against its content and against the hash that its predecessor has."""
    log = audit.tamper(audit.build(A.chain(spark, d)))
    return audit.checked(log).select("source_id", "seq", "content_hash", "content_ok", "link_ok")


@query(f"{ctes(A.CHAIN_SQL)} SELECT source_id % 16 AS partition, count(*) AS objects, max(seq) AS high, count(DISTINCT source_id) AS sources FROM log GROUP BY 1")
def aud10_statistics(spark, d):
    return A.chain(spark, d).groupBy((F.col("source_id") % 16).alias("partition")).agg(F.count("*").alias("objects"), F.max("seq").alias("high"), F.count_distinct("source_id").alias("sources"))


@query(f"{ctes(A.CHAIN_SQL)} SELECT source_id, count(*) FILTER (sha256('k1' || content_hash || coalesce(prev_hash, '')) = CASE WHEN seq = 2 THEN 'forged' ELSE sha256('k1' || content_hash || coalesce(prev_hash, '')) END) AS signed, count(*) AS n FROM chained GROUP BY 1")
def aud11_signatures(spark, d):
    log = audit.build(A.chain(spark, d)).withColumn("signed", V.signature(F.col("content_hash"), F.col("prev_hash"), "k1"))
    log = log.withColumn("signed", F.when(F.col("seq") == 2, "forged").otherwise(F.col("signed")))
    good = V.signature(F.col("content_hash"), F.col("prev_hash"), "k1") == F.col("signed")
    return log.groupBy("source_id").agg(F.count(F.when(good, 1)).alias("signed"), F.count("*").alias("n"))


# --- sets, windows ---
@query(f"{ctes(MW)} SELECT {KEYS}, window_start_unix, count(*) AS count FROM mw GROUP BY {KEYS}, window_start_unix")
def set01_union_of_stores(spark, d):
    """Two stores that hold the same windows: each window once."""
    s = windows.brief_summary(A.metrics(spark, d), "1 hour").select(*windows.KEY, "window_start_unix", "count")
    return s.unionByName(s.where("count > 1")).dropDuplicates([*windows.KEY, "window_start_unix"])


@query("SELECT DISTINCT event_type, user_id FROM events")
def set02_distinct(spark, d):
    return A.table(spark, d, "events").select("event_type", "user_id").distinct()


@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT topic, count(*) AS n FROM (SELECT 'tasks' AS topic FROM life UNION ALL SELECT 'metrics' FROM events) GROUP BY 1")
def set03_topics_as_one(spark, d):
    a = A.lifecycle(spark, d).select(F.lit("tasks").alias("topic"), "ts")
    return a.unionByName(A.metrics(spark, d).select(F.lit("metrics").alias("topic"), "ts")).groupBy("topic").agg(F.count("*").alias("n"))


@query("SELECT event_id, lag(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events")
def win01_previous_of_source(spark, d):
    w = W.partitionBy("user_id").orderBy("ts", "event_id")
    return A.table(spark, d, "events").select("event_id", F.lag("event_id").over(w).alias("before"))


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def win02_latest_by_key(spark, d):
    """By max_by, which combines before the shuffle, so that no key is sorted whole."""
    last = lambda c: F.max_by(c, F.struct("ts", "event_id")).alias(c)
    return A.table(spark, d, "events").groupBy("user_id").agg(last("event_id"), last("event_type"))


# --- operations ---
@query("""WITH g AS (SELECT user_id % 20 AS instance, CASE event_id % 3 WHEN 0 THEN 'up' WHEN 1 THEN 'workers_active' ELSE 'worker_pool_size' END AS name, CASE event_id % 3 WHEN 0 THEN (event_id % 4 > 0)::INT WHEN 1 THEN event_id % 5 ELSE 8 END AS value, ts, event_id FROM events),
l AS (SELECT instance, name, arg_max(value, (ts, event_id)) AS v FROM g GROUP BY ALL),
s AS (SELECT instance, coalesce(max(v) FILTER (name = 'up'), 0) = 1 AS running, coalesce(max(v) FILTER (name = 'workers_active'), 0)::INT AS active, coalesce(max(v) FILTER (name = 'worker_pool_size'), 0)::INT AS pool FROM l GROUP BY 1)
SELECT *, CASE WHEN running THEN 'healthy' ELSE 'stopped' END AS status, CASE WHEN NOT running THEN 'not running' WHEN active > 0 THEN active || '/' || pool || ' processing' ELSE pool || ' workers idle' END AS detail FROM s""")
def ts08_status(spark, d):
    """events as samples of three gauges for each of twenty pipelines."""
    k = F.col("event_id") % 3
    name = F.when(k == 0, "up").when(k == 1, "workers_active").otherwise("worker_pool_size")
    value = F.when(k == 0, (F.col("event_id") % 4 > 0).cast("double")).when(k == 1, (F.col("event_id") % 5).cast("double")).otherwise(8.0)
    gauges = A.table(spark, d, "events").select((F.col("user_id") % 20).alias("instance"), name.alias("name"), value.alias("value"), A.utc("ts").alias("ts"), "event_id")
    return timeseries.pipeline_status(gauges, ["instance"])


@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT (epoch_us(ts) // 86400000000) * 86400 AS window_start_unix, count(*) / 86400 AS rate FROM life WHERE event_type = 'TASK_COMPLETED' GROUP BY 1", "rate")
def ts09_completions(spark, d):
    done = A.lifecycle(spark, d).where("event_type = 'TASK_COMPLETED'")
    return windows.windowed(done, "1 day").groupBy("window_start_unix").agg((F.count("*") / 86400).alias("rate"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE floor(epoch(o_orderdate))::BIGINT END AS at FROM orders")
def fn10_unix_or_zero(spark, d):
    t = F.when(F.col("o_orderkey") % 4 == 0, "soon").otherwise(F.date_format(A.utc("o_orderdate"), "yyyy-MM-dd HH:mm:ss"))
    return A.table(spark, d, "orders").select("o_orderkey", V.unix_or_zero(t).alias("at"))


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'c' || event_id ELSE 'new' END AS id FROM events")
def fn12_correlation_id(spark, d):
    e = A.table(spark, d, "events")
    key = F.when(F.col("event_id") % 2 == 0, "X-Correlation-ID").otherwise("other")
    headers = F.array(F.struct(key.alias("key"), F.encode(F.concat(F.lit("c"), F.col("event_id").cast("string")), "utf-8").alias("value")))
    found = e.select("event_id", V.correlation_id(headers).alias("id"))
    return found.withColumn("id", F.when(F.length("id") == 36, "new").otherwise(F.col("id")))


@query("SELECT event_id, CASE WHEN event_id % 6 IN (0, 1, 2) THEN value END AS x, CASE WHEN event_id % 6 IN (0, 1, 2) THEN user_id::DOUBLE END AS y FROM events", "x")
def fn03_points(spark, d):
    """Points as lists, as objects, nested, with a missing half, of three numbers, and as words."""
    v, u, k = F.col("value").cast("string"), F.col("user_id").cast("string"), F.col("event_id") % 6
    forms = ["[{v}, {u}]", '{"x": {v}, "y": {u}}', '{"xy": [{v}, {u}]}', '{"x": {v}}', "[{v}, {u}, 1]", '"{v}"']
    raw = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        raw = F.when(k == i, F.replace(F.replace(F.lit(form), F.lit("{v}"), v), F.lit("{u}"), u)).otherwise(raw)
    p = A.table(spark, d, "events").select("event_id", V.point(raw).alias("p"))
    return p.select("event_id", "p.x", "p.y")


@query(f"{ctes(MW)} SELECT DISTINCT sha256(processor_name || '|' || processor_version || '|' || metric_name || '|HISTOGRAM|' || window_start_unix || '.0|' || (window_start_unix + 3600) || '.0|hist.json') AS hash, processor_name, window_start_unix FROM mw")
def fn08_aggregate_hash(spark, d):
    w = windows.windowed(A.metrics(spark, d), "1 hour").select(*windows.KEY, "window_start_unix", "window_end_unix").distinct()
    ends = [F.concat(F.col(c).cast("string"), F.lit(".0")) for c in ("window_start_unix", "window_end_unix")]
    return w.select(V.aggregate_hash(*map(F.col, windows.KEY), F.lit("HISTOGRAM"), *ends, F.lit("hist.json")).alias("hash"), "processor_name", "window_start_unix")
