"""Every registered query: a function of (spark, sf_dir), and DuckDB SQL that says the same on the same tables.

Measures in double precision are rounded to six digits on both sides, since sums may run in any order; a billionth is
added first, so that no average of cents lies on a border of rounding.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import analyzers, audit, catalog, dispatch, lifecycle, processors, timeseries, windows
from ..sources import adapters as A
from ..sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
KEYS = "processor_name, processor_version, metric_name"


def query(sql: str, floats: str = "") -> Callable:
    names = floats.split()

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(spark, sf_dir).withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in names})

        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        if not sql:  # no SQL says the same
            return f
        ORACLE_SQL[f.__name__] = f"SELECT * REPLACE ({', '.join(f'round({c} + 1e-9, 6) AS {c}' for c in names)}) FROM ({sql})" if names else sql
        return f

    return add


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)


M = f"m AS (SELECT event_type AS processor_name, '1.0.0' AS processor_version, 'value' AS metric_name, value AS num, ts, event_id, 7 AS aggregation_mask FROM events)"
MW = M + ",\nmw AS (SELECT *, (epoch_us(ts) // 3600000000) * 3600 AS window_start_unix FROM m)"
FULL = f"""full_agg AS (SELECT {KEYS}, window_start_unix, window_start_unix + 3600 AS window_end_unix, count(*) AS count, count(num) AS numeric_count, sum(num) AS sum, avg(num) AS mean, stddev_pop(num) AS std,
  min(num) AS min, max(num) AS max, median(num) AS median, list_sort(list(num))[least(floor(count(num) * 95 / 100)::BIGINT, count(num) - 1) + 1] AS p95,
  list_sort(list(num))[least(floor(count(num) * 99 / 100)::BIGINT, count(num) - 1) + 1] AS p99 FROM mw GROUP BY {KEYS}, window_start_unix)"""


# --- windows ---
@query(f"{ctes(MW)} SELECT {KEYS}, window_start_unix, window_start_unix + 3600 AS window_end_unix, count(*) AS count, sum(num) AS sum, avg(num) AS avg, min(num) AS min, max(num) AS max, max(aggregation_mask) AS aggregation_mask FROM mw GROUP BY {KEYS}, window_start_unix", "sum avg")
def agg02_window_summary_sql(spark, d):
    return windows.brief_summary(A.metrics(spark, d), "1 hour")


@query(f"{ctes(MW, FULL)} SELECT * FROM full_agg", "sum mean std median")
def agg03_window_summary_full(spark, d):
    return windows.full_summary(A.metrics(spark, d), "1 hour")


@query(f"{ctes(M)} SELECT {KEYS}, epoch(date_trunc('day', ts))::BIGINT AS window_start_unix, epoch(date_trunc('day', ts))::BIGINT + 86400 AS window_end_unix, count(*) AS count, list_sort(list(num))[count(*) // 2 + 1] AS median FROM m GROUP BY ALL")
def agg05_window_upper_median(spark, d):
    return windows.full_summary(A.metrics(spark, d), "1 day", upper_median=True).select(*windows.KEY, "window_start_unix", "window_end_unix", "count", "median")


@query("SELECT l_returnflag AS metric_name, count(*) AS point_count, avg(l_quantity) AS x_mean, min(l_quantity) AS x_min, max(l_quantity) AS x_max, avg(l_extendedprice) AS y_mean, min(l_extendedprice) AS y_min, max(l_extendedprice) AS y_max FROM lineitem GROUP BY 1", "x_mean y_mean")
def agg04_point_summary(spark, d):
    return windows.point_summary(A.points(spark, d), ["metric_name"])


@query(f"{ctes(MW)} SELECT {KEYS}, window_start_unix, count(*) AS count, arg_min(aggregation_mask, event_id) AS aggregation_mask, string_agg(num::VARCHAR, ',' ORDER BY ts, event_id) AS vals FROM mw GROUP BY {KEYS}, window_start_unix")
def agg06_collect_values(spark, d):
    out = windows.collect_values(A.metrics(spark, d), "1 hour")
    return out.select(*windows.KEY, "window_start_unix", "count", "aggregation_mask", F.expr("array_join(transform(values, v -> cast(v as string)), ',')").alias("vals"))


COMBINED_SQL = f"""WITH mx AS (SELECT event_type AS processor_name, '1.0.0' AS processor_version, 'value' AS metric_name, (epoch_us(ts) // 3600000000) * 3600 AS window_start_unix, ts, event_id,
  CASE WHEN event_id % 7 <> 3 THEN value END AS num, CASE WHEN event_id % 7 = 3 THEN value END AS x, CASE WHEN event_id % 7 = 3 THEN user_id::DOUBLE END AS y FROM events),
g AS (SELECT {KEYS}, window_start_unix, count(*) AS count, count(num) AS numeric_count, coalesce(sum(num), 0) AS sum, coalesce(avg(num), 0) AS mean, coalesce(stddev_pop(num), 0) AS std, min(num) AS min, max(num) AS max, median(num) AS median,
  list_sort(list(num) FILTER (num IS NOT NULL)) AS v, count(x) AS point_count, avg(x) AS x_mean, min(x) AS x_min, max(x) AS x_max, avg(y) AS y_mean, min(y) AS y_min, max(y) AS y_max, string_agg(num::VARCHAR, ',' ORDER BY ts, event_id) AS vals FROM mx GROUP BY {KEYS}, window_start_unix)
SELECT * EXCLUDE (v, vals), window_start_unix + 3600 AS window_end_unix, v[least(floor(numeric_count * 95 / 100)::BIGINT, numeric_count - 1) + 1] AS p95, v[least(floor(numeric_count * 99 / 100)::BIGINT, numeric_count - 1) + 1] AS p99,
  coalesce(vals, '') AS vals, 7 AS aggregation_mask FROM g"""


@query(COMBINED_SQL, "sum mean std median x_mean y_mean")
def agg07_combined_document(spark, d):
    out = windows.combined(A.mixed_metrics(spark, d), "1 hour")
    return out.withColumn("vals", F.expr("array_join(transform(values, v -> cast(v as string)), ',')")).drop("values")


@query(f"{ctes(M)} SELECT {KEYS}, w AS window_start_unix, w + 7200 AS window_end_unix, count(*) AS count, sum(num) AS sum, avg(num) AS mean FROM (SELECT *, unnest([(epoch_us(ts) // 3600000000) * 3600, (epoch_us(ts) // 3600000000) * 3600 - 3600]) AS w FROM m) GROUP BY ALL", "sum mean")
def agg08_sliding_window(spark, d):
    w = windows.windowed(A.metrics(spark, d), "2 hours", "1 hour")
    return w.groupBy(*windows.KEY, "window_start_unix", "window_end_unix").agg(F.count("*").alias("count"), F.sum("num").alias("sum"), F.avg("num").alias("mean"))


ROLL = "count(*) AS windows, sum(count)::BIGINT AS count, sum(numeric_count)::BIGINT AS numeric_count, sum(sum) AS sum, min(min) AS min, max(max) AS max, max(window_end_unix) AS last_window_end, sum(sum) / sum(count) AS avg, sum(sum) / sum(numeric_count) AS numeric_avg"


@query(f"{ctes(MW, FULL)} SELECT {KEYS}, {ROLL} FROM full_agg GROUP BY {KEYS}", "sum avg numeric_avg")
def agg09_roll_up(spark, d):
    return windows.roll_up(windows.mergeable_summary(A.metrics(spark, d), "1 hour"), windows.KEY)


@query(f"{ctes(MW, FULL)} SELECT {KEYS}, window_start_unix // 86400 AS day, {ROLL} FROM full_agg GROUP BY {KEYS}, window_start_unix // 86400", "sum avg numeric_avg")
def agg10_roll_up_by_day(spark, d):
    full = windows.mergeable_summary(A.metrics(spark, d), "1 hour").withColumn("day", F.floor(F.col("window_start_unix") / 86400))
    return windows.roll_up(full, [*windows.KEY, "day"])


# --- typed values and filters ---
@query(f"{ctes(A.RAW_SQL)} SELECT event_id, kind, num, bool, str, x, y FROM raw")
def prj02_typed_value(spark, d):
    v = A.raw_values(spark, d).withColumn("v", V.typed(F.col("raw")))
    return v.select("event_id", "v.kind", "v.num", "v.bool", "v.str", "v.x", "v.y")


@query(f"{ctes(A.RAW_SQL)} SELECT metric_name, count(*) FILTER (kind IS NULL) AS dead, count(*) FILTER (kind IN ('number', 'bool')) AS numeric_rows, count(*) AS n FROM raw GROUP BY 1")
def fil11_dead_letter(spark, d):
    v = A.raw_values(spark, d).withColumn("kind", V.typed(F.col("raw"))["kind"])
    return v.groupBy("metric_name").agg(F.count(F.when(F.col("kind").isNull(), 1)).alias("dead"), F.count(F.when(F.col("kind").isin("number", "bool"), 1)).alias("numeric_rows"), F.count("*").alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 7 = 6 THEN 'unparseable' ELSE 'unknown_type' END AS reason FROM events WHERE event_id % 7 = 6 OR event_type NOT IN ('click', 'purchase')")
def fil11_dead_letter_reasons(spark, d):
    return lifecycle.dead_letters(A.raw_values(spark, d), "raw", "metric_name", ["click", "purchase"]).select("event_id", "reason")


@query("SELECT event_id, epoch(date_trunc('second', ts))::BIGINT AS event_time FROM events")
def prj03_event_time(spark, d):
    iso = A.table(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("t"))
    return iso.select("event_id", F.unix_timestamp(F.try_to_timestamp(F.substring("t", 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))).alias("event_time"))


@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT event_type, count(*) AS n FROM life GROUP BY 1")
def prj04_event_names(spark, d):
    old = A.lifecycle(spark, d).withColumn("event_type", F.when(F.col("task_id") % 2 == 0, F.regexp_replace("event_type", "^TASK_", "JOB_")).otherwise(F.col("event_type")))
    return lifecycle.normal_names(old).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS task_id, '{\"task_id\":' || o_orderkey || ',\"directory_key\":\"dir' || (o_custkey % 25) || '\",\"path\":\"/in/' || o_orderkey || '\"}' AS payload FROM orders")
def prj05_task_created_payload(spark, d):
    o = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("task_id"), F.concat(F.lit("dir"), (F.col("o_custkey") % 25).cast("string")).alias("directory_key"), F.concat(F.lit("/in/"), F.col("o_orderkey").cast("string")).alias("path"))
    return o.select("task_id", F.to_json(F.struct("task_id", "directory_key", "path")).alias("payload"))


@query(f"""{ctes(A.LIFECYCLE_SQL)} SELECT task_id, event_type, '{{"task_id":' || task_id || CASE event_type
WHEN 'TASK_CREATED' THEN ',"directory_key":"' || directory_key || '","path":null,"fingerprint":null,"file_hash":null}}'
WHEN 'TASK_STARTED' THEN ',"processor_name":"' || processor_name || '","processor_version":"1.0.0"}}'
WHEN 'TASK_COMPLETED' THEN ',"processor_name":"' || processor_name || '","processor_version":"1.0.0","duration_ms":' || duration_ms || '}}'
ELSE ',"processor_name":"' || processor_name || '","processor_version":"1.0.0","error":"' || error || '","error_type":null}}' END AS payload FROM life""")
def prj05_task_payloads(spark, d):
    return lifecycle.with_payload(A.lifecycle(spark, d).withColumn("processor_version", F.lit("1.0.0"))).select("task_id", "event_type", "payload")


@query(f"""{ctes(A.ARTIFACTS_SQL)} SELECT doc_id, '{{"content_hash":"' || content_hash || '","bucket":"' || bucket || '","key":"' || name || '","size":' || size || ',"mime":null,"source_task_id":' || coalesce(task_id::VARCHAR, 'null') || '}}' AS payload FROM art""")
def prj05_artifact_payloads(spark, d):
    a = A.artifacts(spark, d).withColumns({"event_type": F.lit("ARTIFACT_STORED"), "key": F.col("name"), "source_task_id": F.col("task_id")})
    return lifecycle.with_payload(a).select("doc_id", "payload")


@query(f"""WITH mx AS (SELECT event_id, event_type, value, event_id % 7 = 3 AS p FROM events)
SELECT event_id, '{{"task_id":' || event_id || ',"processor_name":"' || event_type || '","processor_version":"1.0.0","metric_name":"value","value":' || if(p, 'null', value::VARCHAR) || ',"aggregation_mask":7,"meta":{{}}}}' AS payload FROM mx""")
def prj05_metric_payloads(spark, d):
    m = A.mixed_metrics(spark, d).withColumns({"event_type": F.lit("METRIC_EMITTED"), "task_id": F.col("event_id"), "value": F.col("num")})
    return lifecycle.with_payload(m).select("event_id", "payload")


@query("SELECT l_orderkey, l_linenumber, unnest(['discount', 'extendedprice', 'quantity']) AS metric_name, unnest([l_discount, l_extendedprice, l_quantity]) AS value FROM lineitem")
def prj06_measurements_to_rows(spark, d):
    m = F.create_map(*[x for n in ("discount", "extendedprice", "quantity") for x in (F.lit(n), F.col(f"l_{n}"))])
    return A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.explode(m).alias("metric_name", "value"))


@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT task_id, 'task_duration_ms' AS metric_name, duration_ms AS value, 3 AS aggregation_mask FROM life WHERE event_type = 'TASK_COMPLETED'")
def prj07_duration_measurement(spark, d):
    return A.lifecycle(spark, d).where("event_type = 'TASK_COMPLETED'").select("task_id", F.lit("task_duration_ms").alias("metric_name"), F.col("duration_ms").alias("value"), F.lit(3).alias("aggregation_mask"))


@query(f"{ctes(MW, FULL)}, c AS (SELECT max(window_end_unix) AS t FROM full_agg) SELECT {KEYS}, window_start_unix, count FROM full_agg, c WHERE window_end_unix >= t - 1440 * 60")
def fil03_time_cutoff(spark, d):
    full = windows.mergeable_summary(A.metrics(spark, d), "1 hour")
    last = full.agg(F.max("window_end_unix").alias("t"))
    return full.join(F.broadcast(last), F.col("window_end_unix") >= F.col("t") - 1440 * 60).select(*windows.KEY, "window_start_unix", "count")


@query(f"{ctes(M)} SELECT event_id, num FROM m WHERE processor_name = 'click' AND metric_name = 'value'")
def fil04_metric_identity(spark, d):
    return A.metrics(spark, d).where("processor_name = 'click' and metric_name = 'value'").select("event_id", "num")


@query("SELECT event_id % 256 AS mask, count(*) AS n FROM events WHERE (event_id % 256)::BIGINT & 16 <> 0 GROUP BY 1")
def fil06_mask_filter(spark, d):
    e = A.table(spark, d, "events").withColumn("mask", F.col("event_id") % 256)
    return e.where(V.has_flag(F.col("mask"), "RATE")).groupBy("mask").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, regexp_matches(p_name, '^[A-Za-z0-9_.-]{1,128}$') AS valid FROM part")
def fil08_identifier_check(spark, d):
    return A.table(spark, d, "part").select("p_partkey", F.col("p_name").rlike("^[A-Za-z0-9_.-]{1,128}$").alias("valid"))


# --- joins ---
TASKS = "tasks AS (SELECT o_orderkey AS task_id, 'dir' || (o_custkey % 25) AS directory_key FROM orders)"


def _tasks(spark, d):
    return A.table(spark, d, "orders").select(F.col("o_orderkey").alias("task_id"), F.concat(F.lit("dir"), (F.col("o_custkey") % 25).cast("string")).alias("directory_key"))


@query(f"{ctes(TASKS, A.ROUTES_SQL)} SELECT directory_key, task_id, algorithm, version, starts_with(algorithm, 'model_') AS slow FROM tasks JOIN routes USING (directory_key)")
def join01_dispatch(spark, d):
    return lifecycle.dispatch(_tasks(spark, d), A.routes(spark, d))[0].withColumn("slow", F.col("algorithm").startswith("model_"))


@query(f"{ctes(TASKS, A.ROUTES_SQL)} SELECT directory_key, task_id, 'TASK_FAILED' AS event_type FROM tasks WHERE directory_key NOT IN (SELECT directory_key FROM routes)")
def join02_unroutable(spark, d):
    return lifecycle.dispatch(_tasks(spark, d), A.routes(spark, d))[1].withColumn("event_type", F.lit("TASK_FAILED"))


@query(f"{ctes(A.ROUTES_SQL)} SELECT algorithm, version, count(*) AS directories FROM routes WHERE algorithm NOT IN ('model_asia') GROUP BY 1, 2")
def join03_unregistered_processors(spark, d):
    known = A.table(spark, d, "region").where("r_name = 'ASIA'").select(F.concat(F.lit("model_"), F.lower("r_name")).alias("algorithm"), F.lit("1.0.0").alias("version"))
    return A.routes(spark, d).join(known, ["algorithm", "version"], "left_anti").groupBy("algorithm", "version").agg(F.count("*").alias("directories"))


@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT task_id, event_type FROM life WHERE event_type <> 'TASK_CREATED' AND task_id IN (SELECT task_id FROM life WHERE event_type = 'TASK_CREATED' AND task_id % 5 <> 0)")
def join05_known_tasks_only(spark, d):
    e = A.lifecycle(spark, d)
    return e.where("event_type <> 'TASK_CREATED'").join(e.where("event_type = 'TASK_CREATED' and task_id % 5 <> 0"), "task_id", "left_semi").select("task_id", "event_type")


@query(f"{ctes(A.ARTIFACTS_SQL, A.LIFECYCLE_SQL)} SELECT a.doc_id, a.task_id, l.event_type FROM art a JOIN life l ON a.task_id = l.task_id AND l.event_type = 'TASK_CREATED'")
def join07_artifacts_to_tasks(spark, d):
    t = A.lifecycle(spark, d).where("event_type = 'TASK_CREATED'").select("task_id", "event_type")
    return A.artifacts(spark, d).join(t, "task_id").select("doc_id", "task_id", "event_type")


@query(f"""{ctes(A.CHAIN_SQL)}, a AS (SELECT source_id, seq, CASE WHEN seq = 2 AND source_id % 5 = 0 THEN 'x' ELSE content_hash END AS h FROM log WHERE NOT (source_id % 4 = 0 AND seq = 1))
SELECT coalesce(l.source_id, a.source_id) AS source_id, coalesce(l.seq, a.seq) AS seq, CASE WHEN a.h IS NULL THEN 'missing_in_audit' WHEN l.content_hash <> a.h THEN 'altered' ELSE 'same' END AS state FROM log l FULL JOIN a ON l.source_id = a.source_id AND l.seq = a.seq""")
def join08_audit_reconciliation(spark, d):
    log = audit.build(A.chain(spark, d))
    copy = log.where("not (source_id % 4 = 0 and seq = 1)").withColumn("content_hash", F.when((F.col("seq") == 2) & (F.col("source_id") % 5 == 0), "x").otherwise(F.col("content_hash")))
    return audit.reconcile(log, copy)


# --- analyzers ---
@query("SELECT event_type, count(*) AS count, 0::BIGINT AS missing, avg(value) AS mean, median(value) AS median, min(value) AS min, max(value) AS max, stddev_samp(value) AS std, var_samp(value) AS variance FROM events GROUP BY 1", "mean median std variance")
def anl01_stats(spark, d):
    return analyzers.stats(A.table(spark, d, "events"), ["event_type"], "value")


def _hist_sql(bins: int) -> str:
    return f"""WITH e AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
c AS (SELECT v.event_type, least(floor((v.value - e.lo) / (e.hi - e.lo) * {bins}), {bins - 1})::INT AS bin, count(*) AS n FROM events v JOIN e USING (event_type) GROUP BY 1, 2)
SELECT e.event_type, g.bin::INT AS bin, e.lo + (e.hi - e.lo) * g.bin / {bins} AS low, e.lo + (e.hi - e.lo) * (g.bin + 1) / {bins} AS high, coalesce(c.n, 0) AS n FROM e CROSS JOIN range({bins}) g(bin) LEFT JOIN c ON c.event_type = e.event_type AND c.bin = g.bin"""


@query(_hist_sql(50), "low high")
def anl02_histogram(spark, d):
    return analyzers.histogram(A.table(spark, d, "events"), ["event_type"], 50, "value")


@query(_hist_sql(30), "low high")
def art01_histogram_on_demand(spark, d):
    return analyzers.histogram(A.table(spark, d, "events"), ["event_type"], 30, "value", least_values=2)


@query("""WITH q AS (SELECT l_returnflag, count(*) AS count, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
b AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM q),
o AS (SELECT l_returnflag, count(*) AS n FROM lineitem JOIN b USING (l_returnflag) WHERE l_extendedprice < lower OR l_extendedprice > upper GROUP BY 1)
SELECT b.*, coalesce(o.n, 0) AS outlier_count, coalesce(o.n, 0) / count AS fraction FROM b LEFT JOIN o USING (l_returnflag)""", "q1 q3 iqr lower upper fraction")
def anl03_outliers(spark, d):
    return analyzers.outliers(A.table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice")


@query("SELECT * FROM (SELECT o_orderstatus, o_orderpriority AS label, count(*) AS n, (row_number() OVER (PARTITION BY o_orderstatus ORDER BY count(*) DESC, o_orderpriority))::INT AS rank FROM orders GROUP BY 1, 2) WHERE rank <= 3")
def anl04_tally(spark, d):
    return analyzers.tally(A.table(spark, d, "orders"), ["o_orderstatus"], "o_orderpriority", 3)


def _rate_sql(z: float) -> str:
    return f"""SELECT event_type, yes, no, 0::BIGINT AS missing, yes + no AS n, yes / (yes + no) AS rate,
greatest(0, ((p + {z * z / 2} / n1) / (1 + {z * z} / n1)) - {z} / (1 + {z * z} / n1) * sqrt(p * (1 - p) / n1 + {z * z / 4} / (n1 * n1))) AS low,
least(1, ((p + {z * z / 2} / n1) / (1 + {z * z} / n1)) + {z} / (1 + {z * z} / n1) * sqrt(p * (1 - p) / n1 + {z * z / 4} / (n1 * n1))) AS high
FROM (SELECT event_type, count(*) FILTER (value > 50) AS yes, count(*) FILTER (value <= 50) AS no, count(*)::DOUBLE AS n1, count(*) FILTER (value > 50) / count(*)::DOUBLE AS p FROM events GROUP BY 1)"""


@query(_rate_sql(1.959964), "rate low high")
def anl05_rate(spark, d):
    return analyzers.rate(A.table(spark, d, "events").withColumn("passed", F.col("value") > 50), ["event_type"], "passed")


@query(_rate_sql(1.96), "rate low high")
def art03_rate_on_demand(spark, d):
    return analyzers.rate(A.table(spark, d, "events").withColumn("passed", F.col("value") > 50), ["event_type"], "passed", read_side=True)


@query("""WITH m AS (SELECT l_returnflag AS metric_name, count(*) AS count, avg(l_quantity) AS cx, avg(l_extendedprice) AS cy, var_samp(l_quantity) AS a, var_samp(l_extendedprice) AS c, covar_samp(l_quantity, l_extendedprice) AS b FROM lineitem GROUP BY 1)
SELECT metric_name, count, cx, cy, round((a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b), 1) AS lambda1, round((a + c) / 2 - sqrt(pow((a - c) / 2, 2) + b * b), 3) AS lambda2, atan2(2 * b, a - c) / 2 AS angle FROM m""", "cx cy angle")
def anl06_ellipse(spark, d):
    return analyzers.ellipse(A.points(spark, d), ["metric_name"]).withColumns({"lambda1": F.round("lambda1", 1), "lambda2": F.round("lambda2", 3)})


def _density_sql(grid: int, pad: float) -> str:
    return f"""WITH e AS (SELECT l_returnflag AS metric_name, min(l_quantity) AS a0, max(l_quantity) AS a1, min(l_extendedprice) AS b0, max(l_extendedprice) AS b1, count(*) AS total FROM lineitem GROUP BY 1),
f AS (SELECT metric_name, total, a0 - (a1 - a0) * {pad} AS x0, a1 + (a1 - a0) * {pad} AS x1, b0 - (b1 - b0) * {pad} AS y0, b1 + (b1 - b0) * {pad} AS y1 FROM e),
c AS (SELECT f.metric_name, least(floor((l_quantity - x0) / (x1 - x0) * {grid}), {grid - 1})::INT AS ix, least(floor((l_extendedprice - y0) / (y1 - y0) * {grid}), {grid - 1})::INT AS iy, count(*) AS n FROM lineitem JOIN f ON l_returnflag = f.metric_name GROUP BY ALL)
SELECT c.metric_name, ix, iy, n, n / (total * ((x1 - x0) / {grid} * ((y1 - y0) / {grid}))) * 1e6 AS density FROM c JOIN f USING (metric_name)"""


@query(_density_sql(16, 0.0), "density")
def anl07_density(spark, d):
    return analyzers.density(A.points(spark, d), ["metric_name"], 16).withColumn("density", F.col("density") * 1e6)


@query(_density_sql(50, 0.1), "density")
def art05_density_on_demand(spark, d):
    return analyzers.density(A.points(spark, d), ["metric_name"], 50, pad=0.1).withColumn("density", F.col("density") * 1e6)


@query("SELECT event_type, CASE WHEN value > 50 THEN 'true' ELSE 'false' END AS label, count(*) AS n FROM events GROUP BY ALL")
def art02_categories(spark, d):
    e = A.table(spark, d, "events").withColumn("label", F.when(F.col("value") > 50, "true").otherwise("false"))
    return e.groupBy("event_type", "label").agg(F.count("*").alias("n"))


def _asked(flag: str) -> str:
    return f"(SELECT * FROM ms WHERE mask & {V.FLAGS[flag]} <> 0)"


# What is compared of the summaries of each type: two sums over a group's rows, in Spark and in DuckDB.
COMPARED = {
    "STATS": ("mean", "std"), "HISTOGRAM": ("n", "n * bin"), "OUTLIERS": ("upper", "outlier_count"), "TALLY": ("n", "n * rank"),
    "RATE": ("rate", "low"), "SCATTER_ELLIPSE": ("lambda1 / 1000", "angle"), "DENSITY_MAP": ("n", "n * (ix * 64 + iy)"), "RAW": ("meta", "1"),
}

DISPATCH_SQL = f"""{ctes(A.MEASUREMENTS_SQL)},
st AS (SELECT event_type, avg(num) AS mean, stddev_samp(num) AS std FROM {_asked("STATS")} GROUP BY 1),
he AS (SELECT event_type, min(num) AS lo, max(num) AS hi FROM {_asked("HISTOGRAM")} GROUP BY 1),
hc AS (SELECT event_type, least(floor((num - lo) / (hi - lo) * 10), 9)::INT AS bin, count(*) AS n FROM {_asked("HISTOGRAM")} JOIN he USING (event_type) GROUP BY 1, 2),
hi AS (SELECT event_type, g.bin, coalesce(n, 0) AS n FROM he CROSS JOIN range(10) g(bin) LEFT JOIN hc USING (event_type, bin)),
oq AS (SELECT event_type, quantile_cont(num, 0.25) AS q1, quantile_cont(num, 0.75) AS q3 FROM {_asked("OUTLIERS")} GROUP BY 1),
ou AS (SELECT event_type, q3 + 1.5 * (q3 - q1) AS upper, count(*) FILTER (num < q1 - 1.5 * (q3 - q1) OR num > q3 + 1.5 * (q3 - q1)) AS outlier_count FROM {_asked("OUTLIERS")} JOIN oq USING (event_type) GROUP BY event_type, q1, q3),
ta AS (SELECT event_type, count(*) AS n, row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, label) AS rank FROM {_asked("TALLY")} GROUP BY event_type, label),
rc AS (SELECT event_type, count(*)::DOUBLE AS k, count(*) FILTER (passed) / count(*)::DOUBLE AS rate FROM {_asked("RATE")} GROUP BY 1),
ra AS (SELECT event_type, rate, greatest(0, (rate + 1.959964 ^ 2 / 2 / k) / (1 + 1.959964 ^ 2 / k) - 1.959964 / (1 + 1.959964 ^ 2 / k) * sqrt(rate * (1 - rate) / k + 1.959964 ^ 2 / 4 / (k * k))) AS low FROM rc),
em AS (SELECT event_type, var_samp(x) AS a, var_samp(y) AS c, covar_samp(x, y) AS b FROM {_asked("SCATTER_ELLIPSE")} GROUP BY 1),
el AS (SELECT event_type, (a + c) / 2 + sqrt(pow((a - c) / 2, 2) + b * b) AS lambda1, atan2(2 * b, a - c) / 2 AS angle FROM em),
de AS (SELECT event_type, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM {_asked("DENSITY_MAP")} GROUP BY 1),
dm AS (SELECT event_type, least(floor((x - x0) / (x1 - x0) * 64), 63)::INT AS ix, least(floor((y - y0) / (y1 - y0) * 64), 63)::INT AS iy, count(*) AS n FROM {_asked("DENSITY_MAP")} JOIN de USING (event_type) GROUP BY 1, 2, 3),
rw AS (SELECT event_type, meta FROM {_asked("RAW")})
""" + " UNION ALL ".join(f"SELECT event_type, '{t}' AS type, count(*) AS n, sum({a})::DOUBLE AS a, sum({b})::DOUBLE AS b FROM {c} GROUP BY 1" for c, (t, (a, b)) in zip(("st", "hi", "ou", "ta", "ra", "el", "dm", "rw"), COMPARED.items()))


@query(DISPATCH_SQL, "a b")
def anl09_dispatch_by_mask(spark, d):
    out = dispatch.by_mask(A.measurements(spark, d), ["event_type"])
    fields = sorted({w for pair in COMPARED.values() for e in pair for w in re.findall("[a-z_]+[0-9]?", e)})
    s = out.withColumn("_s", F.from_json("summary", ", ".join(f"{f} double" for f in fields))).select("event_type", "type", "_s.*")
    of = lambda i: F.coalesce(*[F.when(F.col("type") == t, F.expr(pair[i]).cast("double")) for t, pair in COMPARED.items()])
    return s.groupBy("event_type", "type").agg(F.count("*").alias("n"), F.sum(of(0)).alias("a"), F.sum(of(1)).alias("b"))


# --- life cycle ---
STATE = """st AS (SELECT task_id, lower(substr(arg_max(event_type, ts), 6)) AS status, max(directory_key) AS directory_key, max(processor_name) AS processor_name, max(duration_ms) AS duration_ms, max(error) AS error,
  epoch(max(ts) FILTER (event_type = 'TASK_CREATED'))::BIGINT AS created_at, epoch(max(ts) FILTER (event_type = 'TASK_STARTED'))::BIGINT AS started_at, epoch(max(ts) FILTER (event_type = 'TASK_COMPLETED'))::BIGINT AS completed_at, count(*) AS event_count FROM life GROUP BY 1)"""


@query(f"{ctes(A.LIFECYCLE_SQL, STATE)} SELECT * FROM st")
def life01_current_state(spark, d):
    return lifecycle.current_state(A.lifecycle(spark, d))


@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT task_id, event_type, epoch(ts)::BIGINT AS at, lower(substr(event_type, 6)) AS status, (row_number() OVER w)::INT AS event_no, (row_number() OVER w)::INT AS held, lag(event_type) OVER w AS before FROM life WINDOW w AS (PARTITION BY task_id ORDER BY ts, event_type)")
def life02_change_log(spark, d):
    return lifecycle.change_log(A.lifecycle(spark, d))


@query(f"{ctes(A.LIFECYCLE_SQL, STATE)} SELECT task_id, status, created_at FROM st WHERE status = 'failed' ORDER BY created_at DESC NULLS LAST, task_id LIMIT 50")
def life04_task_list(spark, d):
    return lifecycle.task_list(lifecycle.current_state(A.lifecycle(spark, d)), "failed", 50).select("task_id", "status", "created_at")


@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT event_type, processor_name, error, count(*) AS n FROM life GROUP BY ALL")
def life05_throughput(spark, d):
    return lifecycle.throughput(A.lifecycle(spark, d))


BOUNDS = [500.0, 1000.0, 2500.0, 4000.0]


@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT b AS le, count(*) FILTER (duration_ms <= b) AS n FROM (SELECT * FROM life WHERE duration_ms IS NOT NULL), unnest([{', '.join(map(str, BOUNDS))}, 'inf'::DOUBLE]) t(b) GROUP BY 1")
def life06_duration_buckets(spark, d):
    return lifecycle.duration_buckets(A.lifecycle(spark, d), BOUNDS)


def _exclusive(p: float) -> str:
    j = f"greatest(1, least(len(v) - 1, floor({p} * (len(v) + 1))))::BIGINT"
    return f"v[{j}] + ({p} * (len(v) + 1) - {j}) * (v[{j} + 1] - v[{j}])"


@query(f"{ctes(A.LIFECYCLE_SQL)} SELECT processor_name, len(v) AS n, list_avg(v) AS avg, {_exclusive(0.5)} AS p50, {_exclusive(0.95)} AS p95, {_exclusive(0.99)} AS p99 FROM (SELECT processor_name, list_sort(list(duration_ms / 1000)) AS v FROM life WHERE event_type = 'TASK_COMPLETED' GROUP BY 1)", "avg p50 p95 p99")
def life07_latency(spark, d):
    return lifecycle.latency(A.lifecycle(spark, d), "processor_name")


@query("""WITH RECURSIVE e AS (SELECT user_id, event_type, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts) AS k, count(*) OVER (PARTITION BY user_id, event_type) AS seen FROM events),
f AS (SELECT user_id, event_type, t, k, t AS last, true AS ok, seen FROM e WHERE k = 1 UNION ALL
  SELECT e.user_id, e.event_type, e.t, e.k, CASE WHEN e.t - f.last >= 86400000000 THEN e.t ELSE f.last END, e.t - f.last >= 86400000000, e.seen FROM f JOIN e ON e.user_id = f.user_id AND e.event_type = f.event_type AND e.k = f.k + 1)
SELECT user_id, event_type, t AS accepted_us, seen::INT AS seen FROM f WHERE ok""")
def str04_dedup_ttl(spark, d):
    return lifecycle.deduplicate_ttl(A.table(spark, d, "events").withColumn("ts", A.utc("ts")), ["user_id", "event_type"], 86_400)


@query("""SELECT event_type, count(*) FILTER (late) AS late, count(*) AS n FROM (SELECT event_type, ts < max(ts) OVER (ORDER BY event_id * 7919 % 10007, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 DAY AS late FROM events) GROUP BY 1""")
def str02_late_rows(spark, d):
    """Which rows a watermark of ten days would drop, if they arrived in a stated order.

    The greatest time so far is kept for blocks of the arrival order first, and within a block second.
    """
    e = A.table(spark, d, "events").select("event_type", A.utc("ts").alias("ts"), "event_id", (F.col("event_id") * 7919 % 10007).alias("at"))
    blocks = e.groupBy((F.col("at") % 10007).alias("at")).agg(F.max("ts").alias("m"))
    before = blocks.select("at", F.max("m").over(W.orderBy("at").rowsBetween(W.unboundedPreceding, -1)).alias("earlier"))
    inside = F.max("ts").over(W.partitionBy("at").orderBy("event_id").rowsBetween(W.unboundedPreceding, -1))
    late = e.withColumn("inside", inside).join(before, "at").withColumn("late", F.coalesce(F.col("ts") < F.greatest("earlier", "inside") - F.expr("interval 10 days"), F.lit(False)))
    return late.groupBy("event_type").agg(F.count(F.when(F.col("late"), 1)).alias("late"), F.count("*").alias("n"))


# --- catalogue and storage ---
@query(f"{ctes(MW, FULL)} SELECT {KEYS}, 'STATS,HISTOGRAM,OUTLIERS' AS types, {ROLL} FROM full_agg GROUP BY {KEYS}", "sum avg numeric_avg")
def cat01_metric_catalog(spark, d):
    return catalog.metric_catalog(windows.mergeable_summary(A.metrics(spark, d), "1 hour"), 7)


@query(f"""{ctes(MW, FULL)}, d AS (SELECT *, row_number() OVER (PARTITION BY processor_name ORDER BY window_end_unix DESC) AS k FROM full_agg)
SELECT 'value' AS metric_name, w AS processor_name, coalesce(processor_version, '') AS processor_version, if(k IS NULL, 0, 7) AS aggregation_mask, coalesce(count, 0) AS count, coalesce(sum, 0) AS sum, mean AS avg, min, max, std, median, p95, p99,
  k IS NULL AS no_data, if(k IS NULL, '', 'STATS,HISTOGRAM,OUTLIERS') AS types FROM (SELECT unnest(['click', 'purchase', 'absent']) AS w) LEFT JOIN d ON processor_name = w AND k = 1""", "sum avg std median")
def cat02_metric_detail(spark, d):
    stored = sinks.materialize(windows.full_summary(A.metrics(spark, d), "1 hour").withColumn("aggregation_mask", F.lit(7)), "aggregates")
    one, other, absent = (catalog.metric_detail(stored, "value", name) for name in ("click", "purchase", "absent"))
    return one.unionByName(other).unionByName(absent)


@query(f"{ctes(A.ARTIFACTS_SQL)} SELECT content_hash, max(doc_id) AS doc_id, arg_max(bucket, doc_id) AS bucket FROM art GROUP BY 1")
def cat03_artifact_index(spark, d):
    return catalog.latest(A.artifacts(spark, d), ["content_hash"], ["doc_id"]).select("content_hash", "doc_id", "bucket")


@query(f"{ctes(A.ARTIFACTS_SQL)} SELECT doc_id, bucket, size FROM art ORDER BY doc_id DESC LIMIT 100")
def cat04_artifact_list(spark, d):
    return A.artifacts(spark, d).orderBy(F.desc("doc_id")).limit(100).select("doc_id", "bucket", "size")


@query(f"{ctes(A.ARTIFACTS_SQL)} SELECT task_id, count(*) AS artifacts, max(doc_id) AS newest, arg_min(processor_name, doc_id) FILTER (processor_name <> '') AS processor_name FROM art GROUP BY 1 ORDER BY newest DESC, task_id LIMIT 50 OFFSET 10")
def cat05_recent_tasks(spark, d):
    return catalog.recent_tasks(A.artifacts(spark, d), 50, 10)


@query(f"{ctes(A.ARTIFACTS_SQL)} SELECT processor_name, count(DISTINCT task_id) AS tasks, count(*) AS artifacts FROM art GROUP BY 1")
def cat06_processors(spark, d):
    return A.artifacts(spark, d).groupBy("processor_name").agg(F.countDistinct("task_id").alias("tasks"), F.count("*").alias("artifacts"))


@query(f"{ctes(A.ROUTES_SQL)} SELECT algorithm, version, min(directory_key) AS first_directory FROM routes GROUP BY 1, 2")
def cat07_distinct_algorithms(spark, d):
    return A.routes(spark, d).groupBy("algorithm", "version").agg(F.min("directory_key").alias("first_directory"))


@query(f"{ctes(A.ARTIFACTS_SQL)} SELECT bucket, count(*) AS objects, sum(size)::BIGINT AS bytes, round(sum(size)::BIGINT / (1024 * 1024), 2) AS mb FROM art GROUP BY 1")
def cat08_bucket_stats(spark, d):
    return catalog.bucket_stats(A.artifacts(spark, d))


@query(f"{ctes(A.ARTIFACTS_SQL)} SELECT substr(content_hash, 1, 2) || '/' || substr(content_hash, 3, 2) || '/' || content_hash AS key, min(doc_id) AS doc_id FROM art WHERE content_hash LIKE '0%' GROUP BY 1 ORDER BY key LIMIT 40")
def cat09_listing_by_prefix(spark, d):
    k = A.artifacts(spark, d).withColumn("key", V.shard_key(F.col("content_hash"))).where(F.col("key").startswith("0"))
    return k.groupBy("key").agg(F.min("doc_id").alias("doc_id")).orderBy("key").limit(40)


@query(f"{ctes(A.ARTIFACTS_SQL)} SELECT bucket, sum(c)::BIGINT AS objects, count(*) AS stored, sum(c - 1)::BIGINT AS hits, sum((c - 1) * size)::BIGINT AS bytes_saved FROM (SELECT bucket, content_hash, count(*) AS c, min(size) AS size FROM art GROUP BY 1, 2) GROUP BY 1")
def cat15_dedup_stats(spark, d):
    return catalog.dedup_stats(A.artifacts(spark, d))


@query("SELECT event_type, count(*) AS kept FROM events, (SELECT max(ts) AS t FROM events) WHERE event_type NOT IN ('click', 'error') OR ts >= t - CASE event_type WHEN 'click' THEN INTERVAL 5 DAY ELSE INTERVAL 10 DAY END GROUP BY 1")
def cat12_retention(spark, d):
    e = A.table(spark, d, "events").select(F.col("event_type").alias("bucket"), F.unix_micros(A.utc("ts")).alias("stored_us"))
    e = e.join(F.broadcast(e.agg(F.max("stored_us").alias("as_of"))))
    return catalog.retention(e, {"click": 5, "error": 10}, "as_of").groupBy(F.col("bucket").alias("event_type")).agg(F.count("*").alias("kept"))


@query("SELECT doc_id, strlen(text)::BIGINT AS size FROM documents WHERE strlen(text) > 10000")
def cat14_size_guard(spark, d):
    return A.table(spark, d, "documents").select("doc_id", F.octet_length("text").cast("long").alias("size")).where("size > 10000")


@query(f"{ctes(A.ARTIFACTS_SQL)} SELECT bucket, content_hash, min(doc_id) AS doc_id, min(size) AS size, count(*) AS copies FROM art GROUP BY 1, 2")
def snk04_content_addressed_store(spark, d):
    return catalog.store(A.artifacts(spark, d))


@query(f"{ctes(A.ARTIFACTS_SQL)} SELECT doc_id, content_hash = CASE WHEN doc_id % 11 = 0 THEN 'other' ELSE content_hash END AS accepted FROM art")
def snk05_expected_hash(spark, d):
    a = A.artifacts(spark, d).withColumn("expected", F.when(F.col("doc_id") % 11 == 0, "other").otherwise(F.col("content_hash")))
    return a.select("doc_id", (F.sha2("text", 256) == F.col("expected")).alias("accepted"))


@query(f"{ctes(A.ARTIFACTS_SQL)} SELECT task_id AS key, max(doc_id) AS doc_id FROM art GROUP BY 1")
def snk06_last_write_wins(spark, d):
    return catalog.latest(A.artifacts(spark, d), ["task_id"], ["doc_id"]).select(F.col("task_id").alias("key"), "doc_id")


@query(f"{ctes(MW)} SELECT DISTINCT sha256(processor_name || '|' || processor_version || '|' || metric_name || '|' || window_start_unix) AS key, window_start_unix FROM mw")
def snk03_value_keys(spark, d):
    w = windows.windowed(A.metrics(spark, d), "1 hour").select(*windows.KEY, "window_start_unix").distinct()
    return w.select(V.joined_hash(*map(F.col, windows.KEY), F.col("window_start_unix")).alias("key"), "window_start_unix")


# --- audit ---
OK = """ck AS (SELECT *, row_number() OVER w AS position, sha256('{"body": ' || to_json(body)::VARCHAR || ', "role": ' || to_json(role)::VARCHAR || '}') = content_hash AS content_ok,
  lag(content_hash) OVER w IS NULL OR lag(content_hash) OVER w IS NOT DISTINCT FROM prev_hash AS link_ok FROM log WINDOW w AS (PARTITION BY source_id ORDER BY seq, content_hash))"""


def _log(spark, d):
    return audit.tamper(audit.build(A.chain(spark, d)))


@query(f"{ctes(A.CHAIN_SQL)} SELECT source_id, seq, content_hash, prev_hash, sha256(content_hash || coalesce(prev_hash, '')) AS chain_hash FROM chained")
def aud03_chain_build(spark, d):
    return audit.build(A.chain(spark, d)).select("source_id", "seq", "content_hash", "prev_hash", F.sha2(F.concat("content_hash", F.coalesce("prev_hash", F.lit(""))), 256).alias("chain_hash"))


@query(f"{ctes(A.CHAIN_SQL, OK)} SELECT source_id, count(*) AS event_count, count(*) FILTER (NOT content_ok) AS content_errors, count(*) FILTER (NOT link_ok) AS link_errors, bool_and(content_ok AND link_ok) AS valid FROM ck GROUP BY 1")
def aud04_chain_verify(spark, d):
    return audit.verify(_log(spark, d))


@query(f"{ctes(A.CHAIN_SQL, OK)} SELECT source_id, seq, position::INT AS position, error FROM (SELECT *, unnest(list_filter([CASE WHEN NOT content_ok THEN 'content_mismatch' END, CASE WHEN NOT link_ok THEN 'link_mismatch' END], lambda x: x IS NOT NULL)) AS error FROM ck)")
def aud06_chain_errors(spark, d):
    return audit.errors(_log(spark, d))


@query(f"{ctes(A.CHAIN_SQL)} SELECT source_id, arg_max(content_hash, seq) AS last_hash, count(*) AS event_count FROM log GROUP BY 1")
def aud07_chain_state(spark, d):
    return audit.state(_log(spark, d))


@query(f"{ctes(A.CHAIN_SQL, OK)} SELECT source_id, CASE WHEN bool_and(content_ok AND link_ok) THEN 'valid' ELSE 'invalid' END AS status, count(*) AS event_count FROM ck GROUP BY 1")
def aud09_chain_status(spark, d):
    return audit.status(_log(spark, d))


# --- sorts and windows ---
@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100 OFFSET 20")
def srt01_sort_limit_offset(spark, d):
    return A.table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc_nulls_last(), "o_orderkey").offset(20).limit(100)


@query(f"{ctes(A.COUNTERS_SQL)} SELECT name, arg_max(value, ts) AS value, epoch_us(max(ts)) AS ts_us FROM samples GROUP BY 1")
def ts04_instant(spark, d):
    return timeseries.instant(A.counters(spark, d), ["name"])


# --- time series and logs ---
@query(f"""{ctes(A.COUNTERS_SQL)}, s AS (SELECT *, lag(value) OVER (PARTITION BY name ORDER BY ts, event_id) AS before FROM samples),
i AS (SELECT name, (epoch_us(ts) // 21600000000) * 21600 AS window_start_unix, CASE WHEN before IS NULL THEN 0 WHEN value < before THEN value ELSE value - before END AS step FROM s)
SELECT name, window_start_unix, sum(step) AS increase, count(*) AS samples, sum(step) / 21600 AS rate FROM i GROUP BY 1, 2""", "rate")
def ts01_counter_increase(spark, d):
    return timeseries.increase(A.counters(spark, d), "6 hours", ["name"])


@query("""WITH b AS (SELECT event_type, le, count(*) FILTER (value <= le) AS n FROM events, unnest([25.0, 50.0, 100.0, 250.0, 'inf'::DOUBLE]) t(le) GROUP BY ALL),
w AS (SELECT *, coalesce(lag(le) OVER (PARTITION BY event_type ORDER BY le), 0) AS low, coalesce(lag(n) OVER (PARTITION BY event_type ORDER BY le), 0) AS below, max(n) OVER (PARTITION BY event_type) AS total FROM b),
h AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY le) AS k FROM w WHERE n >= total * 0.9)
SELECT event_type, round(CASE WHEN isinf(le) THEN low ELSE low + (le - low) * ((total * 0.9 - below) / (n - below)) END, 3) AS value FROM h WHERE k = 1""")
def ts02_bucket_quantile(spark, d):
    e = A.table(spark, d, "events")
    bounds = [25.0, 50.0, 100.0, 250.0, float("inf")]
    one = e.groupBy("event_type").agg(*[F.count(F.when(F.col("value") <= b, 1)).alias(f"b{i}") for i, b in enumerate(bounds)])
    rows = F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"b{i}").alias("n")) for i, b in enumerate(bounds)])
    out = timeseries.bucket_quantile(one.select("event_type", F.explode(rows).alias("r")).select("event_type", "r.le", "r.n"), ["event_type"], 0.9)
    return out.withColumn("value", F.round("value", 3))


@query(f"{ctes(A.COUNTERS_SQL)}, l AS (SELECT name, instance, arg_max(value, ts) AS v FROM samples GROUP BY ALL) SELECT name, coalesce(sum(v), 0) AS total FROM l GROUP BY 1")
def ts03_sum_across_series(spark, d):
    return timeseries.instant(A.counters(spark, d), ["name", "instance"]).groupBy("name").agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("total"))


START, END, STEP, STALE = 1704067200, 1706659200, 21600, 7200


@query(f"""{ctes(A.COUNTERS_SQL)}, g AS (SELECT name, t AS step_unix FROM (SELECT DISTINCT name FROM samples), range({START}, {END} + 1, {STEP}) r(t))
SELECT name, step_unix, value FROM (SELECT name, step_unix, value, floor(epoch(ts2))::BIGINT AS seen_at FROM (SELECT g.name, step_unix, arg_max(s.value, (s.ts, s.event_id)) AS value, max(s.ts) AS ts2 FROM g JOIN samples s ON s.name = g.name AND floor(epoch(s.ts)) <= step_unix AND epoch(s.ts) > step_unix - {STALE} - 2 GROUP BY ALL)) WHERE step_unix - seen_at <= {STALE}""")
def ts05_range_query(spark, d):
    return timeseries.on_grid(A.counters(spark, d), ["name"], START, END, STEP, STALE)


LOGS = "logs AS (SELECT event_id, ts, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'click' THEN 'INFO' ELSE 'DEBUG' END AS level, props AS message FROM events)"


def _logs(spark, d):
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "click", "INFO").otherwise("DEBUG")
    return A.table(spark, d, "events").select("event_id", A.utc("ts").alias("ts"), level.alias("level"), F.col("props").alias("message"))


@query(f"{ctes(LOGS)} SELECT (epoch_us(ts) // 3600000000) * 3600 AS window_start_unix, level, count(*) AS n FROM logs GROUP BY ALL")
def ts06_log_counts(spark, d):
    return timeseries.log_counts(_logs(spark, d), "1 hour")


@query(f"{ctes(LOGS)} SELECT event_id, level, message FROM logs WHERE contains(message, ': 9') AND level = 'ERROR' AND regexp_matches(message, '9[0-4]')")
def ts07_log_search(spark, d):
    return timeseries.log_search(_logs(spark, d), ": 9", "ERROR", "9[0-4]").select("event_id", "level", "message")


# --- processors and functions ---
@query("SELECT doc_id, (strlen(text) % 1000) / 1000 AS score, (strlen(text) % 1000) / 1000 > 0.5 AS passed, 1 AS event_count, (strlen(text) % 256)::BIGINT AS intensity, 10 * sin(strlen(text)) AS center_x, 10 * cos(strlen(text)) AS center_y FROM documents WHERE text IS NOT NULL", "score center_x center_y")
def prc01_probe(spark, d):
    t = A.table(spark, d, "documents").where("text is not null").select("doc_id", F.octet_length("text").cast("long").alias("n"))
    return processors.probe(t, "n").drop("n")


@query("SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE ('0x' || substr(sha1(encode(text)[1:64]), 1, 2))::INT / 255 END AS score FROM documents WHERE text IS NOT NULL", "score")
def prc02_hash_score(spark, d):
    return A.table(spark, d, "documents").where("text is not null").select("doc_id", processors.hash_score(F.col("text")).alias("score"))


@query(f"""{ctes(A.ARTIFACTS_SQL)} SELECT doc_id, substr(content_hash, 1, 2) || '/' || substr(content_hash, 3, 2) || '/' || content_hash AS key, content_hash AS back,
CASE doc_id % 3 WHEN 0 THEN 'application/json' WHEN 1 THEN 'image/png' ELSE 'application/octet-stream' END AS mime,
CASE doc_id % 3 WHEN 0 THEN CASE WHEN json_valid(text) THEN 'json' ELSE 'binary' END WHEN 1 THEN 'image' ELSE 'binary' END AS kind,
CASE WHEN text[1] IN ('{{', '[') AND json_valid(text) THEN 'json' ELSE 'binary' END AS kind_untold FROM art""")
def fn01_keys_and_media(spark, d):
    a = A.artifacts(spark, d).withColumn("key", V.shard_key(F.col("content_hash"))).withColumn("mime", V.media_type(F.col("name")))
    return a.select("doc_id", "key", V.hash_of_key(F.col("key")).alias("back"), "mime", V.content_kind(F.col("mime"), F.col("text")).alias("kind"), V.content_kind(F.lit(None).cast("string"), F.col("text")).alias("kind_untold"))


@query("SELECT o_orderkey, o_orderkey % 256 AS mask, array_to_string(list_filter([CASE WHEN o_orderkey % 256 & 1 <> 0 THEN 'STATS' END, CASE WHEN o_orderkey % 256 & 2 <> 0 THEN 'HISTOGRAM' END, CASE WHEN o_orderkey % 256 & 4 <> 0 THEN 'OUTLIERS' END, CASE WHEN o_orderkey % 256 & 8 <> 0 THEN 'TALLY' END, CASE WHEN o_orderkey % 256 & 16 <> 0 THEN 'RATE' END, CASE WHEN o_orderkey % 256 & 32 <> 0 THEN 'SCATTER_ELLIPSE' END, CASE WHEN o_orderkey % 256 & 64 <> 0 THEN 'DENSITY_MAP' END, CASE WHEN o_orderkey % 256 & 128 <> 0 THEN 'RAW' END], lambda x: x IS NOT NULL), ',') AS types FROM orders")
def fn02_mask_names(spark, d):
    o = A.table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 256).alias("mask"))
    return o.withColumn("types", F.array_join(V.type_names(F.col("mask")), ","))


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false END AS b FROM orders")
def fn04_parse_bool(spark, d):
    k = F.col("o_orderkey") % 5
    w = F.when(k == 0, " Yes ").when(k == 1, "N").when(k == 2, "1").when(k == 3, "FAIL").otherwise("maybe")
    return A.table(spark, d, "orders").select("o_orderkey", V.parse_bool(w).alias("b"))


@query("SELECT o_orderkey, sha256('/in/' || o_orderkey || '|' || o_custkey || '|' || epoch(o_orderdate)::BIGINT) AS fingerprint FROM orders")
def fn06_fingerprint(spark, d):
    o = A.table(spark, d, "orders")
    return o.select("o_orderkey", V.joined_hash(F.concat(F.lit("/in/"), F.col("o_orderkey").cast("string")), F.col("o_custkey"), F.unix_timestamp(A.utc("o_orderdate"))).alias("fingerprint"))


@query("SELECT doc_id, 'data:text/plain;base64,' || to_base64(encode(text)) AS uri FROM documents WHERE text IS NOT NULL")
def fn13_data_uri(spark, d):
    return A.table(spark, d, "documents").where("text is not null").select("doc_id", V.data_uri(F.lit("text/plain"), F.col("text")).alias("uri"))


from . import artifacts, detail, stored, streamed  # noqa: E402, F401  (they register their queries)
