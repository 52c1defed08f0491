"""Registered queries over artifacts: sets by mask and stored arrays. Arrays are compared as text, numbers in them rounded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import analyzers, dispatch, processors
from ..sources import adapters as A
from ..sources import arrays, sinks
from . import examples
from .registered import ctes, query


def text(values: Column, digits: int | None = None) -> Column:
    """An array as text, joined by commas; with ``digits`` its numbers are whole numbers of that many digits' units."""
    if digits is None:
        return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")
    return F.array_join(F.transform(values, lambda v: F.floor(v * 10**digits + 0.5).cast("string")), ",")


def listed(expr: str, digits: int | None = None) -> str:
    return f"array_to_string(list_transform({expr}, lambda v: {'v' if digits is None else f'floor(v * {10**digits} + 0.5)::BIGINT'}::VARCHAR), ',')"


MASKED = "CASE WHEN len(metric_name) % 2 = 0 THEN 122 ELSE 26 END"
SET_SQL = f"""{ctes(A.RAW_SQL)},
v AS (SELECT metric_name, {MASKED} AS mask, num, coalesce(bool, CASE num WHEN 1 THEN true WHEN 0 THEN false END) AS passed, x, y, coalesce(passed::VARCHAR, num::VARCHAR, str) AS label FROM raw),
he AS (SELECT metric_name, min(num) AS lo, max(num) AS hi FROM v WHERE num IS NOT NULL GROUP BY 1 HAVING count(*) >= 2),
hc AS (SELECT metric_name, least(floor((num - lo) / (hi - lo) * 30), 29)::INT AS bin, count(*) AS n FROM v JOIN he USING (metric_name) WHERE num IS NOT NULL GROUP BY 1, 2),
h AS (SELECT metric_name, {listed("list(lo + (hi - lo) * g.bin / 30 ORDER BY g.bin)", 3)} AS edges, {listed("list(coalesce(n, 0) ORDER BY g.bin) FILTER (g.bin < 30)")} AS bins
  FROM he CROSS JOIN range(31) g(bin) LEFT JOIN hc USING (metric_name, bin) GROUP BY 1),
c AS (SELECT metric_name, {listed("list(label ORDER BY label)")} AS labels, {listed("list(n ORDER BY label)")} AS tally FROM (SELECT metric_name, label, count(*) AS n FROM v WHERE label IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
r0 AS (SELECT metric_name, count(*) FILTER (passed) AS yes, count(*) FILTER (NOT passed) AS no, (yes + no)::DOUBLE AS k, yes / k AS p FROM v GROUP BY 1),
r AS (SELECT metric_name, yes, no, p AS rate, greatest(0, (p + 1.96 ^ 2 / 2 / k) / (1 + 1.96 ^ 2 / k) - 1.96 / (1 + 1.96 ^ 2 / k) * sqrt(p * (1 - p) / k + 1.96 ^ 2 / 4 / (k * k))) AS low,
  least(1, (p + 1.96 ^ 2 / 2 / k) / (1 + 1.96 ^ 2 / k) + 1.96 / (1 + 1.96 ^ 2 / k) * sqrt(p * (1 - p) / k + 1.96 ^ 2 / 4 / (k * k))) AS high FROM r0 WHERE k > 0),
m AS (SELECT metric_name, count(*) AS points, avg(x) AS cx, avg(y) AS cy, var_samp(x) AS a, var_samp(y) AS c, covar_samp(x, y) AS b, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM v WHERE x IS NOT NULL AND mask = 122 GROUP BY 1),
e AS (SELECT metric_name, points, cx, cy, 2 * sqrt((a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b)) AS major, 2 * sqrt(greatest(0, (a + c) / 2 - sqrt(((a - c) / 2) ** 2 + b * b))) AS minor, degrees(atan2(2 * b, a - c) / 2) AS angle FROM m WHERE points >= 2),
d0 AS (SELECT metric_name, x0 - (x1 - x0) * 0.1 AS x0, x1 + (x1 - x0) * 0.1 AS x1, y0 - (y1 - y0) * 0.1 AS y0, y1 + (y1 - y0) * 0.1 AS y1 FROM m WHERE points >= 3),
d1 AS (SELECT metric_name, least(floor((x - x0) / (x1 - x0) * 50), 49)::INT AS ix, least(floor((y - y0) / (y1 - y0) * 50), 49)::INT AS iy, count(*) AS n FROM (SELECT metric_name, x, y FROM v WHERE x IS NOT NULL) JOIN d0 USING (metric_name) GROUP BY 1, 2, 3),
d AS (SELECT metric_name, {listed("list(coalesce(n, 0) ORDER BY g.iy, f.ix)")} AS cells, {listed("list(x0 + (x1 - x0) * (f.ix + 0.5) / 50 ORDER BY f.ix) FILTER (g.iy = 0)", 3)} AS across
  FROM d0 CROSS JOIN range(50) f(ix) CROSS JOIN range(50) g(iy) LEFT JOIN d1 USING (metric_name, ix, iy) GROUP BY 1)
SELECT metric_name, edges, bins, labels, tally, yes, no, rate, low, high, points, cx, cy, major, minor, angle, cells, across FROM h JOIN c USING (metric_name) JOIN r USING (metric_name) LEFT JOIN e USING (metric_name) LEFT JOIN d USING (metric_name)"""


def _artifact_sets(spark, d):
    """The artifacts of every metric: all five for some, three for the rest."""
    raw = A.raw_values(spark, d)
    mask = F.when(F.length("metric_name") % 2 == 0, 122).otherwise(26)
    typed = dispatch.read_side(raw.select("metric_name", V.typed(F.col("raw")).alias("value"), mask.alias("aggregation_mask")))
    return dispatch.artifact_set(typed, ["metric_name"])


@query(SET_SQL, "rate low high cx cy major minor angle")
def art06_artifact_set(spark, d):
    s = _artifact_sets(spark, d)
    return s.select(
        "metric_name", text(F.col("histogram.edges"), 3).alias("edges"), text(F.col("histogram.counts")).alias("bins"), text(F.col("categories.labels")).alias("labels"), text(F.col("categories.counts")).alias("tally"),
        "rate.yes", "rate.no", "rate.rate", "rate.low", "rate.high", F.col("ellipse.count").alias("points"), "ellipse.cx", "ellipse.cy", "ellipse.major", "ellipse.minor", "ellipse.angle",
        text(F.flatten("contour.counts")).alias("cells"), text(F.col("contour.x"), 3).alias("across"),
    )


STORED_SQL = f"""{SET_SQL.rpartition("SELECT metric_name, edges")[0]}
, held AS (SELECT 'histogram/' || metric_name AS key, 'counts' AS name, 30 || '' AS shape, bins AS val FROM h UNION ALL SELECT 'histogram/' || metric_name, 'edges', '31', edges FROM h
  UNION ALL SELECT 'contour/' || metric_name, 'counts', '50,50', cells FROM d UNION ALL SELECT 'contour/' || metric_name, 'x', '50', across FROM d)
SELECT key, name, shape, val, true AS found FROM held UNION ALL SELECT 'histogram/absent', NULL, NULL, NULL, false"""


@query(STORED_SQL)
def src09_array_documents(spark, d):
    """Histograms and density grids are written as array documents; histograms are found again by key, one asked for in vain,
    and grids by the hash of their content."""
    s = _artifact_sets(spark, d)
    h = arrays.documents(s.where("histogram is not null"), F.lit("artifacts"), F.concat(F.lit("histogram/"), "metric_name"), {"edges": arrays.vector(F.col("histogram.edges")), "counts": arrays.vector(F.col("histogram.counts"))})
    c = arrays.documents(s.where("contour is not null"), F.lit("artifacts"), F.concat(F.lit("contour/"), "metric_name"), {"x": arrays.vector(F.col("contour.x")), "counts": arrays.grid(F.col("contour.counts"))})
    path = sinks.shared_path(spark, "arrays")
    arrays.write(h.unionByName(c), path)
    stored = arrays.read(spark, path)
    absent = stored.select("bucket").distinct().withColumn("key", F.lit("histogram/absent"))
    keys = stored.where("startswith(key, 'histogram/')").select("bucket", "key").unionByName(absent)
    found = arrays.fetch(stored, keys, "key").select("key", "arrays", "found")
    found = found.unionByName(arrays.fetch(stored, stored.where("startswith(key, 'contour/')"), "content_hash").select("key", "arrays", "found"))
    rows = found.select("key", "found", F.explode_outer("arrays").alias("name", "array"))
    return rows.select("key", "name", F.array_join(F.transform("array.shape", lambda v: v.cast("string")), ",").alias("shape"), F.when(F.col("name") == "counts", text(F.col("array.values"), 0)).otherwise(text(F.col("array.values"), 3)).alias("val"), "found")


HIST = """e AS (SELECT event_type, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
c AS (SELECT v.event_type, least(floor((v.value - e.lo) / (e.hi - e.lo) * 30), 29)::INT AS bin, count(*) AS n FROM events v JOIN e USING (event_type) GROUP BY 1, 2)"""


@query(f"""WITH {HIST} SELECT event_type, {listed("list(lo + (hi - lo) * (g.bin + 0.5) / 30 ORDER BY g.bin)", 4)} AS centers, {listed("list(coalesce(n, 0) ORDER BY g.bin)")} AS counts, sum(n)::BIGINT AS total
FROM e CROSS JOIN range(30) g(bin) LEFT JOIN c USING (event_type, bin) GROUP BY 1""")
def art08_histogram_series(spark, d):
    """Bin centres and counts as arrays in order, and the total."""
    h = analyzers.histogram_series(analyzers.histogram(A.table(spark, d, "events"), ["event_type"], 30, "value"), ["event_type"])
    return h.select("event_type", text(F.col("centers"), 4).alias("centers"), text(F.col("counts")).alias("counts"), "total")


def _axis(c: str) -> str:
    return listed(f"list_transform(range(50), lambda i: {c}0 + ({c}1 - {c}0) * (i + 0.5) / 50)", 2)


GRID = """e AS (SELECT l_returnflag AS metric_name, min(l_quantity) AS a0, max(l_quantity) AS a1, min(l_extendedprice) AS b0, max(l_extendedprice) AS b1, count(*) AS total FROM lineitem GROUP BY 1),
f AS (SELECT metric_name, total, a0 - (a1 - a0) * 0.1 AS x0, a1 + (a1 - a0) * 0.1 AS x1, b0 - (b1 - b0) * 0.1 AS y0, b1 + (b1 - b0) * 0.1 AS y1 FROM e),
c AS (SELECT f.metric_name, least(floor((l_quantity - x0) / (x1 - x0) * 50), 49)::INT AS ix, least(floor((l_extendedprice - y0) / (y1 - y0) * 50), 49)::INT AS iy, count(*) AS n FROM lineitem JOIN f ON l_returnflag = f.metric_name GROUP BY ALL),
g AS (SELECT metric_name, list(coalesce(n, 0) ORDER BY iy, ix) AS cells, max(n) AS most FROM f CROSS JOIN range(50) p(ix) CROSS JOIN range(50) q(iy) LEFT JOIN c USING (metric_name, ix, iy) GROUP BY 1)"""


@query(f"""WITH {GRID} SELECT metric_name, {_axis("x")} AS x, {_axis("y")} AS y, '50,50' AS shape, {listed("cells")} AS cells, most / (total * ((x1 - x0) / 50 * ((y1 - y0) / 50))) * 1e6 AS max_density FROM f JOIN g USING (metric_name)""", "max_density")
def art09_density_series(spark, d):
    """Axis values, the grid's shape and its cells row by row, and the greatest density."""
    points = A.points(spark, d).withColumns({"aggregation_mask": F.lit(64), "num": F.lit(None).cast("double"), "label": F.lit(None).cast("string"), "passed": F.lit(None).cast("boolean"), "meta": F.lit(None).cast("string")})
    s = dispatch.density_series(dispatch.one_pass(points, ["metric_name"], rules=dispatch.ON_DEMAND, ranked=False)["DENSITY_MAP"], ["metric_name"], 50)
    return s.select("metric_name", text(F.col("x"), 2).alias("x"), text(F.col("y"), 2).alias("y"), text(F.array(F.size("counts"), F.size(F.col("counts")[0]))).alias("shape"), text(F.flatten("counts")).alias("cells"), (F.col("max_density") * 1e6).alias("max_density"))


@query(r"""WITH t AS (SELECT event_id, '{"event": ' || event_id || ', "props": ' || props || ', "tags": [' || CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '1' ELSE '1, 2' END || ']}' AS doc FROM events)
SELECT event_id, CASE event_id % 4 WHEN 0 THEN strlen('[' || doc || ', 1]') WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE strlen(doc) END::BIGINT AS size, CASE event_id % 4 WHEN 0 THEN 'array' WHEN 1 THEN 'scalar' WHEN 2 THEN 'invalid' ELSE 'object' END AS kind,
  CASE event_id % 4 WHEN 3 THEN 'event,props,tags' END AS keys, CASE event_id % 4 WHEN 3 THEN 3 WHEN 0 THEN 2 END::INT AS items FROM t""")
def art10_document_facts(spark, d):
    """Size, kind, keys in order and number of items of JSON documents made of events: objects, arrays, scalars and broken ones."""
    k = F.col("event_id") % 3
    doc = F.concat(F.lit('{"event": '), F.col("event_id").cast("string"), F.lit(', "props": '), F.col("props"), F.lit(', "tags": ['), F.when(k == 0, "").when(k == 1, "1").otherwise("1, 2"), F.lit("]}"))
    of = F.col("event_id") % 4
    made = F.when(of == 0, F.concat(F.lit("["), doc, F.lit(", 1]"))).when(of == 1, "12.5").when(of == 2, "{x").otherwise(doc)
    return A.table(spark, d, "events").select("event_id", V.document_facts(made).alias("f")).select("event_id", "f.size", "f.kind", text(F.col("f.keys")).alias("keys"), "f.items")


OUTLINE = """m AS (SELECT l_returnflag AS metric_name, count(*) AS points, avg(l_quantity) AS cx, avg(l_extendedprice) AS cy, var_samp(l_quantity) AS a, var_samp(l_extendedprice) AS c, covar_samp(l_quantity, l_extendedprice) AS b FROM lineitem GROUP BY 1),
e AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b) AS l1, (a + c) / 2 - sqrt(((a - c) / 2) ** 2 + b * b) AS l2, atan2(2 * b, a - c) / 2 AS w FROM m),
o AS (SELECT *, list_transform(range(64), lambda i: cx + 2 * (sqrt(l1) * cos(i * 2 * pi() / 64) * cos(w) - sqrt(l2) * sin(i * 2 * pi() / 64) * sin(w))) AS ox, list_transform(range(64), lambda i: cy + 2 * (sqrt(l1) * cos(i * 2 * pi() / 64) * sin(w) + sqrt(l2) * sin(i * 2 * pi() / 64) * cos(w))) AS oy FROM e)"""


@query(f"""WITH {OUTLINE} SELECT metric_name, points, cx, cy, {listed("ox", 3)} AS x, {listed("oy", 1)} AS y FROM o""", "cx cy")
def art12_scatter_series(spark, d):
    """The centre and the points of the outline at two deviations."""
    o = analyzers.outline(analyzers.ellipse(A.points(spark, d), ["metric_name"]))
    return o.select("metric_name", F.col("count").alias("points"), "cx", "cy", text(F.col("outline.x"), 3).alias("x"), text(F.col("outline.y"), 1).alias("y"))


@query("""WITH p AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS index FROM events),
q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
SELECT event_type, index, value FROM p JOIN q USING (event_type) WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""", "value")
def anl03_outlier_places(spark, d):
    """Place and value of every outlier, in order of time within its group."""
    return analyzers.outlier_rows(A.table(spark, d, "events"), ["event_type"], ["ts", "event_id"], "value")


JOB_SQL = f"""WITH {A.ROUTES_SQL},
t AS (SELECT doc_id AS task_id, 'dir' || (doc_id % 25) AS directory_key, text, strlen(text)::BIGINT AS n, (length(text) - length(replace(text, chr(10), '')))::BIGINT AS k FROM documents),
r AS (SELECT t.*, algorithm, CASE WHEN algorithm IS NULL THEN 'KeyError' WHEN algorithm = 'model_asia' THEN 'KeyError' WHEN text IS NULL THEN 'FileNotFoundError' WHEN n % 7 = 3 THEN 'ValueError' END AS bad,
  CASE WHEN algorithm IS NULL THEN 'no route for ' || directory_key WHEN algorithm = 'model_asia' THEN 'processor model_asia 1.0.0 is not registered' WHEN text IS NULL THEN 'no content' WHEN n % 7 = 3 THEN 'cannot read ' || n || ' bytes' END AS error FROM t LEFT JOIN routes USING (directory_key)),
h AS (SELECT *, CASE WHEN k > 0 THEN sha256(n || ' bytes, ' || k || ' lines') END AS hash FROM r)
SELECT task_id, 'TASK_STARTED' AS event_type, algorithm AS processor_name, NULL AS metric_name, NULL AS value, NULL::INT AS mask, NULL AS unit, NULL AS content_hash, NULL::INT AS metrics, NULL AS refs, NULL AS error, NULL AS error_type FROM h WHERE algorithm <> 'model_asia'
UNION ALL SELECT task_id, 'TASK_FAILED', algorithm, NULL, NULL, NULL, NULL, NULL, NULL, NULL, error, bad FROM h WHERE bad IS NOT NULL
UNION ALL SELECT task_id, 'ARTIFACT_STORED', algorithm, NULL, NULL, NULL, NULL, hash, NULL, NULL, NULL, NULL FROM h WHERE bad IS NULL AND hash IS NOT NULL
UNION ALL SELECT task_id, 'RESULT_PRODUCED', algorithm, NULL, NULL, NULL, NULL, NULL, 3, coalesce(hash, ''), NULL, NULL FROM h WHERE bad IS NULL
UNION ALL SELECT task_id, 'METRIC_EMITTED', algorithm, m.name, CASE m.name WHEN 'n_bytes' THEN n::VARCHAR WHEN 'even' THEN (n % 2 = 0)::VARCHAR WHEN 'lines' THEN k::VARCHAR END, m.mask, m.unit, NULL, NULL, NULL, NULL, NULL
  FROM h, (VALUES ('n_bytes', 3, 'bytes'), ('even', 16, NULL), ('lines', 0, NULL), ('task_duration_ms', 3, 'milliseconds')) AS m(name, mask, unit) WHERE bad IS NULL
UNION ALL SELECT task_id, 'TASK_COMPLETED', algorithm, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM h WHERE bad IS NULL"""


@query(JOB_SQL)
def udf02_processor_job(spark, d):
    """All documents as tasks through the processors of their routes: every event of the job, read from its three outputs.
    Measured durations are left out, as no two runs agree on them."""
    registry = processors.Registry()
    for region in ("africa", "america", "europe", "middle east"):
        registry.add(type("TextSizeOfRegion", (examples.TextSize,), {"name": f"model_{region}"}))
    tasks = A.table(spark, d, "documents").select(F.col("doc_id").alias("task_id"), F.concat(F.lit("dir"), (F.col("doc_id") % 25).cast("string")).alias("directory_key"), F.col("text").cast("binary").alias("content"))
    job = processors.run_job(tasks, A.routes(spark, d), registry)
    told = job.events.where("event_type not in ('METRIC_EMITTED', 'ARTIFACT_STORED')").drop("metric_name", "value", "aggregation_mask", "meta", "content_hash", "name", "mime")
    measured = job.measurements.withColumn("event_type", F.lit("METRIC_EMITTED")).withColumn("value", F.when(F.col("metric_name") != "task_duration_ms", F.col("value")))
    stored = job.artifacts.withColumn("event_type", F.lit("ARTIFACT_STORED")).join(job.events.where("event_type = 'TASK_STARTED'").select("task_id", "processor_name"), "task_id")
    every = told.unionByName(measured, allowMissingColumns=True).unionByName(stored.drop("data"), allowMissingColumns=True)
    return every.select(
        "task_id", "event_type", "processor_name", "metric_name", "value", F.col("aggregation_mask").alias("mask"), F.col("meta")["unit"].alias("unit"), "content_hash", F.col("metric_count").alias("metrics"),
        F.array_join("artifact_refs", ",").alias("refs"), "error", "error_type",
    )
