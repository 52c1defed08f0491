"""Registered queries for what the first ones leave out: what isn't found, histories, further options, both sides of a check."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values as V
from ..operators import analyzers, audit, catalog, dispatch, lifecycle, timeseries, windows
from ..sources import adapters as A
from ..sources import readers, sinks
from . import examples
from .artifacts import listed, text
from .registered import OK, ctes, query


# --- sources, predicates, payloads ---
@query("SELECT coalesce(lang, 'none') AS lang, count(*) AS documents, sum(strlen(text))::BIGINT AS bytes, count(*) FILTER (starts_with(text, 'T')) AS first_t FROM documents WHERE text IS NOT NULL AND coalesce(lang, 'none') <> 'de' GROUP BY 1")
def src05_directory_scan(spark, d):
    """All documents as lines of files of bounded size, in a directory for each language, those of one language under another
    extension. The tree is scanned by extension, in whatever case; the content of the files that were found is read."""
    path = sinks.shared_path(spark, "files")
    docs = A.table(spark, d, "documents").where("text is not null").select(F.coalesce("lang", F.lit("none")).alias("lang"), F.base64(F.encode("text", "utf-8")).alias("value"))
    docs.where("lang <> 'de'").withColumn("value", F.translate("value", "\r\n", "")).write.option("maxRecordsPerFile", 2000).partitionBy("lang").text(f"{path}/text")
    docs.where("lang = 'de'").write.option("maxRecordsPerFile", 2000).partitionBy("lang").json(f"{path}/json")
    found = readers.directory(spark, path, [".TXT"], content=True)
    lines = found.select(F.regexp_extract("path", "lang=([^/]+)/[^/]+$", 1).alias("lang"), F.explode(F.expr(r"split(substring(decode(content, 'utf-8'), 1, length(decode(content, 'utf-8')) - 1), '\n')")).alias("line"))  # a line end closes every line
    text = lines.select("lang", F.decode(F.unbase64("line"), "utf-8").alias("text"))
    return text.groupBy("lang").agg(F.count("*").alias("documents"), F.sum(F.octet_length("text")).alias("bytes"), F.count(F.when(F.startswith("text", F.lit("T")), 1)).alias("first_t"))


@query("""SELECT event_id, true AS metric, event_id % 4 <> 0 AS processor, event_id % 5 <> 0 AS version, event_id % 6 > 1 AS task FROM events""")
def fil08_identifier_kinds(spark, d):
    """Identifiers of all four kinds, some of which break their rules by a space, a slash, their length or by being null."""
    e, k = A.table(spark, d, "events"), F.col("event_id")
    made = e.select(
        "event_id", F.concat(F.col("event_type"), F.lit("_9")).alias("metric"), F.concat(F.when(k % 4 == 0, "9-").otherwise("p-"), F.col("event_type")).alias("processor"),
        F.concat(F.lit("1."), k.cast("string"), F.when(k % 5 == 0, "/x").otherwise("-rc.1")).alias("version"), F.when(k % 6 == 0, F.repeat(F.lit("a"), 65)).when(k % 6 > 1, F.concat(F.lit("t_"), k.cast("string"))).alias("task"),
    )
    return made.select("event_id", *[V.valid_identifier(F.col(c), c).alias(c) for c in V.IDENTIFIERS])


@query(f"""{ctes(A.ARTIFACTS_SQL)}, g AS (SELECT task_id, count(*) AS n, array_to_string(list('"' || content_hash || '"' ORDER BY content_hash), ',') AS refs FROM art WHERE task_id IS NOT NULL GROUP BY 1)
SELECT task_id, '{{"task_id":' || task_id || ',"processor_name":"p","processor_version":"1.0.0","metric_count":' || n || ',"artifact_refs":[' || refs || ']}}' AS payload FROM g""")
def prj05_result_payloads(spark, d):
    """RESULT_PRODUCED of every task, with references to all its artifacts in order."""
    g = A.artifacts(spark, d).where("task_id is not null").groupBy("task_id").agg(F.count("*").alias("metric_count"), F.sort_array(F.collect_list("content_hash")).alias("artifact_refs"))
    g = g.withColumns({"event_type": F.lit("RESULT_PRODUCED"), "processor_name": F.lit("p"), "processor_version": F.lit("1.0.0")})
    return lifecycle.with_payload(g).select("task_id", "payload")


@query("""WITH g AS (SELECT event_type, (epoch_us(ts) // 86400000000) * 86400 AS w, count(*) AS n, min(event_id) AS a, max(event_id) AS b FROM events GROUP BY ALL)
SELECT event_type, w AS window_start_unix, '{"processor_name":"' || event_type || '","processor_version":"1.0.0","metric_name":"value","aggregation_type":"STATS","window_start_unix":' || w || ',"window_end_unix":' || (w + 86400) || ',"summary":{"count":' || n || ',"first":' || a || ',"last":' || b || '},"artifact_ref":null}' AS payload FROM g""")
def prj05_aggregate_payloads(spark, d):
    """AGGREGATE_COMPUTED of every day and event type."""
    day = (F.floor(F.unix_micros(A.utc("ts")) / F.lit(86_400_000_000)) * 86400).alias("window_start_unix")
    g = A.table(spark, d, "events").groupBy("event_type", day).agg(F.struct(F.count("*").alias("count"), F.min("event_id").alias("first"), F.max("event_id").alias("last")).alias("summary"))
    named = g.select("window_start_unix", (F.col("window_start_unix") + 86400).alias("window_end_unix"), "summary", F.lit("AGGREGATE_COMPUTED").alias("event_type"), F.col("event_type").alias("processor_name"), F.lit("1.0.0").alias("processor_version"), F.lit("value").alias("metric_name"), F.lit("STATS").alias("aggregation_type"))
    return lifecycle.with_payload(named).select(F.col("processor_name").alias("event_type"), "window_start_unix", "payload")


# --- routing, states ---
@query(f"""WITH {A.ROUTES_SQL}, reg AS (SELECT 'model_' || lower(r_name) AS algorithm, '1.0.0' AS version FROM region, range(2) t(i) WHERE r_name IN ('ASIA', 'AFRICA', 'EUROPE') AND (i = 0 OR r_name = 'ASIA'))
SELECT DISTINCT algorithm, version, 'unregistered' AS fault FROM routes WHERE algorithm NOT IN (SELECT algorithm FROM reg) UNION ALL SELECT algorithm, version, 'duplicate' FROM reg GROUP BY ALL HAVING count(*) > 1""")
def join03_registry_faults(spark, d):
    """Routes to processors that nobody registered, and processors that were registered twice."""
    r = A.table(spark, d, "region").where("r_name in ('ASIA', 'AFRICA', 'EUROPE')")
    reg = r.unionByName(r.where("r_name = 'ASIA'")).select(F.concat(F.lit("model_"), F.lower("r_name")).alias("algorithm"), F.lit("1.0.0").alias("version"))
    return lifecycle.route_faults(A.routes(spark, d), reg)


@query(f"""{ctes(A.LIFECYCLE_SQL)}, n AS (SELECT task_id, event_type, ts, count(*) OVER w AS event_count, list(event_type || '@' || epoch(ts)::BIGINT) OVER (PARTITION BY task_id ORDER BY ts, event_type ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS h FROM life WINDOW w AS (PARTITION BY task_id ORDER BY ts, event_type ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT task_id, event_type, event_count::INT AS event_count, array_to_string(h, ',') AS history FROM n""")
def life02_last_events(spark, d):
    """Each event with the last two of its task and the number of all so far."""
    h = lifecycle.event_history(A.lifecycle(spark, d), keep=2)
    return h.select("task_id", "event_type", "event_count", text(F.transform("history", lambda e: F.concat_ws("@", e["type"], e["at"].cast("string")))).alias("history"))


# --- stores ---
ASKED = """ARTS, asked AS (SELECT DISTINCT sha256(CASE WHEN doc_id % 18 = 0 THEN text || '?' ELSE text END) AS content_hash FROM documents WHERE text IS NOT NULL AND doc_id % 9 = 0),
have AS (SELECT content_hash, count(*) AS objects, max(size) AS size FROM art GROUP BY 1)""".replace("ARTS", A.ARTIFACTS_SQL)


def _asked(spark, d):
    """Hashes to ask for; half of them are of texts that no document has."""
    other = F.when(F.col("doc_id") % 18 == 0, F.concat("text", F.lit("?"))).otherwise(F.col("text"))
    return A.table(spark, d, "documents").where("text is not null and doc_id % 9 = 0").select(F.sha2(other, 256).alias("content_hash"))


@query(f"WITH {ASKED} SELECT content_hash, objects IS NOT NULL AS found, coalesce(objects, 0) AS objects, size FROM asked LEFT JOIN have USING (content_hash)")
def cat10_lookup(spark, d):
    """Every hash that was asked for, found or not."""
    return catalog.lookup(A.artifacts(spark, d), _asked(spark, d))


@query(f"WITH {ASKED} SELECT 'deleted' AS what, objects IS NOT NULL AS found, count(*) AS n FROM asked LEFT JOIN have USING (content_hash) GROUP BY ALL UNION ALL SELECT 'kept', true, count(*) FROM art WHERE content_hash NOT IN (SELECT content_hash FROM asked)")
def cat11_delete_report(spark, d):
    """What a deletion found and didn't, and what it leaves."""
    kept, report = catalog.delete(A.artifacts(spark, d), _asked(spark, d))
    return report.groupBy(F.lit("deleted").alias("what"), "found").agg(F.count("*").alias("n")).unionByName(kept.agg(F.lit("kept").alias("what"), F.lit(True).alias("found"), F.count("*").alias("n")))


# --- audit ---
@query(f"{ctes(A.CHAIN_SQL)} SELECT source_id, arg_max(content_hash, (seq, content_hash)) AS last_hash, count(*) AS event_count FROM log WHERE NOT (source_id % 4 = 0 AND seq <= 1) AND seq > 0 GROUP BY 1")
def aud07_chain_reset(spark, d):
    """The state after all chains were reset at event 0, and every fourth one again at event 1."""
    log = audit.tamper(audit.build(A.chain(spark, d)))
    own = log.where("source_id % 4 = 0").select("source_id", F.lit(1).cast("long").alias("seq")).distinct()
    every = spark.range(1).select(F.lit(None).cast("long").alias("source_id"), F.lit(0).cast("long").alias("seq"))
    return audit.state_after_resets(log, own.unionByName(every))


@query(f"""{ctes(A.CHAIN_SQL, OK)}, v AS (SELECT source_id, count(*) AS n, (count(*) FILTER (NOT content_ok) + count(*) FILTER (NOT link_ok)) AS bad FROM ck WHERE source_id % 3 > 0 GROUP BY 1),
k AS (SELECT source_id, count(*) AS waiting FROM log WHERE source_id % 6 <> 0 GROUP BY 1)
SELECT s.source_id, CASE WHEN n > 0 THEN CASE WHEN bad = 0 THEN 'valid' ELSE 'invalid' END WHEN waiting > 0 THEN 'kafka_only' ELSE 'no_events' END AS status, coalesce(n, waiting, 0) AS event_count,
  CASE WHEN n > 0 THEN CASE WHEN bad = 0 THEN 'chain verified' ELSE 'chain check failed: ' || bad || ' errors' END WHEN waiting > 0 THEN waiting || ' events wait in the topic' ELSE 'no events' END AS message
FROM (SELECT DISTINCT source_id FROM log) s LEFT JOIN v USING (source_id) LEFT JOIN k USING (source_id)""")
def aud09_chain_message(spark, d):
    """All four states: two thirds of the sources are stored, some of the rest wait in the topic only."""
    log = audit.tamper(audit.build(A.chain(spark, d)))
    return audit.chain_status(log.select("source_id"), log.where("source_id % 3 > 0"), log.where("source_id % 6 <> 0"))


@query("""WITH p AS (SELECT user_id % 16 AS "partition", count(*) AS objects, min(event_id) AS low, max(event_id) + 1 AS high, max(ts) AS t FROM events GROUP BY 1)
SELECT "partition", objects, low, high, high - low AS span, floor(epoch(t))::BIGINT AS last_time, 1 AS partitions FROM p UNION ALL SELECT NULL, sum(objects)::BIGINT, NULL, NULL, sum(high - low)::BIGINT, floor(epoch(max(t)))::BIGINT, count(*) FROM p""")
def aud10_topic_statistics(spark, d):
    """events as a topic of 16 partitions: how many records lie between the first and last offset of each, and of all."""
    r = A.table(spark, d, "events").select((F.col("user_id") % 16).alias("partition"), F.col("event_id").alias("offset"), A.utc("ts").alias("ts"))
    return audit.topic_statistics(r).withColumn("last_time", F.unix_timestamp("last_time"))


# --- analyzers and series ---
@query("SELECT o_orderstatus, count(label) AS count, count(*) FILTER (label IS NULL) AS missing, count(DISTINCT label) AS \"unique\" FROM (SELECT o_orderstatus, CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority END AS label FROM orders) GROUP BY 1")
def anl04_tally_facts(spark, d):
    return analyzers.tally_facts(A.table(spark, d, "orders").withColumn("label", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderpriority"))), ["o_orderstatus"], "label")


@query("SELECT * FROM (SELECT o_orderstatus, o_orderpriority AS label, count(*) AS n, (row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority))::INT AS rank FROM orders GROUP BY 1, 2) WHERE rank <= 3")
def anl04_tally_by_label(spark, d):
    return analyzers.tally_by_label(A.table(spark, d, "orders"), ["o_orderstatus"], "o_orderpriority", 3)


def _outline(sigma: int) -> str:
    xs = f"list_transform(range(200), lambda i: cx + {sigma} * (sqrt(l1) * cos(i * 2 * pi() / 200) * cos(w) - sqrt(l2) * sin(i * 2 * pi() / 200) * sin(w)))"
    return f"SELECT metric_name, {sigma} AS sigma, {listed(xs, 3)} AS x FROM e"


@query(f"""WITH m AS (SELECT l_returnflag AS metric_name, avg(l_quantity) AS cx, var_samp(l_quantity) AS a, var_samp(l_extendedprice) AS c, covar_samp(l_quantity, l_extendedprice) AS b FROM lineitem GROUP BY 1),
e AS (SELECT *, (a + c) / 2 + sqrt(((a - c) / 2) ** 2 + b * b) AS l1, (a + c) / 2 - sqrt(((a - c) / 2) ** 2 + b * b) AS l2, atan2(2 * b, a - c) / 2 AS w FROM m) {_outline(1)} UNION ALL {_outline(2)}""")
def anl06_outlines(spark, d):
    """The outline at one and at two deviations, 200 points each."""
    e = analyzers.ellipse(A.points(spark, d), ["metric_name"])
    both = [analyzers.outline(e, float(s), 200).select("metric_name", F.lit(s).alias("sigma"), text(F.col("outline.x"), 3).alias("x")) for s in (1, 2)]
    return both[0].unionByName(both[1])


@query("""WITH p AS (SELECT l_returnflag AS metric_name, least(floor((l_quantity - 5) / 35 * 16), 15)::INT AS ix, least(floor((l_extendedprice - 2000) / 58000 * 16), 15)::INT AS iy FROM lineitem WHERE l_quantity BETWEEN 5 AND 40 AND l_extendedprice BETWEEN 2000 AND 60000),
c AS (SELECT metric_name, ix, iy, count(*) AS n FROM p GROUP BY ALL), t AS (SELECT metric_name, sum(n) AS total, max(n) AS most FROM c GROUP BY 1)
SELECT metric_name, ix, iy, n, n / (total * (35.0 / 16 * (58000.0 / 16))) * 1e6 AS density, CASE WHEN n >= 0.95 * most THEN 3 WHEN n >= 0.8 * most THEN 2 WHEN n >= 0.5 * most THEN 1 ELSE 0 END AS level FROM c JOIN t USING (metric_name)""", "density")
def anl07_density_within(spark, d):
    """A grid over given ranges, and for each cell how many of the levels 0.5, 0.8 and 0.95 of the greatest it reaches."""
    c = analyzers.density_within(A.points(spark, d), ["metric_name"], 16, (5.0, 40.0), (2000.0, 60000.0))
    most = c.groupBy("metric_name").agg(F.max("n").alias("most"))
    level = sum(F.when(F.col("n") >= f * F.col("most"), 1).otherwise(0) for f in (0.5, 0.8, 0.95))
    return c.join(most, "metric_name").select("metric_name", "ix", "iy", "n", (F.col("density") * 1e6).alias("density"), level.alias("level"))


@query(f"""{ctes(A.COUNTERS_SQL)}, l AS (SELECT name, instance, arg_max(value, (ts, event_id)) AS v FROM samples GROUP BY ALL)
SELECT 'click' AS name, coalesce(sum(v), 0) AS total FROM l WHERE name = 'click' UNION ALL SELECT 'absent', coalesce(sum(v), 0) FROM l WHERE name = 'absent'""")
def ts03_total_or_zero(spark, d):
    """The total over all series of a name; a name without any has 0."""
    c = A.counters(spark, d)
    one = [timeseries.total(c.where(F.col("name") == n), ["name", "instance"]).withColumn("name", F.lit(n)) for n in ("click", "absent")]
    return one[0].unionByName(one[1])


@query("""WITH s AS (SELECT event_type, user_id, count(*) AS n, min(event_id) AS low FROM events GROUP BY ALL)
SELECT event_type, user_id, n, low FROM s WHERE low % 7 > 1""")
def src08_stored_documents(spark, d):
    """Stored JSON documents, one a line, of which some are cut off and some are blank: those are skipped."""
    g = A.table(spark, d, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.min("event_id").alias("low"))
    doc = F.to_json(F.struct("event_type", "user_id", "n", "low"))
    path = sinks.shared_path(spark, "documents")
    g.select(F.when(F.col("low") % 7 == 0, F.substring(doc, 1, 15)).when(F.col("low") % 7 == 1, " ").otherwise(doc).alias("value")).write.text(path)
    return readers.parsed(spark.read.text(path), "event_type string, user_id long, n long, low long")


@query(f"WITH {A.ROUTES_SQL} SELECT directory_key, '/in/' || directory_key AS path, algorithm, version, CASE WHEN directory_key LIKE '%1' THEN 'fast' END AS mode FROM routes")
def src12_route_table(spark, d):
    """The route table by way of its file format: TOML that names a path, an algorithm, a version and, for some, settings. A route
    file is read by the driver; it has a table for each directory that is watched."""
    tables = [f'["{r.directory_key}"]\npath = "/in/{r.directory_key}"\nalgorithm = "{r.algorithm}"\nversion = "{r.version}"\n' + (f'["{r.directory_key}".settings]\nmode = "fast"\n' if r.directory_key.endswith("1") else "") for r in A.routes(spark, d).toLocalIterator()]
    return readers.routes(spark, "\n".join(tables)).select("directory_key", "path", "algorithm", "version", F.try_element_at("settings", F.lit("mode")).alias("mode"))


@query("SELECT event_type, min(value) AS low, max(value) AS high, count(DISTINCT user_id % 10) AS labels FROM events GROUP BY 1")
def udf04_user_analyzer(spark, d):
    """A user's analyzer over all events: parts of each group side by side, a batch at a time, and their states merged."""
    return analyzers.grouped(examples.Range())(A.measurements(spark, d), ["event_type"])


@query(f"""WITH v AS (SELECT event_type, value, ts, event_id FROM events), s AS (SELECT event_type, count(*) AS count, avg(value) AS avg, {listed("list(value ORDER BY ts, event_id)", 2)} AS vals, min(value) AS lo, max(value) AS hi FROM v GROUP BY 1),
c AS (SELECT v.event_type, least(floor((value - lo) / (hi - lo) * 30), 29)::INT AS bin, count(*) AS n FROM v JOIN s USING (event_type) GROUP BY 1, 2), h AS (SELECT event_type, {listed("list(coalesce(n, 0) ORDER BY g.bin)")} AS bins FROM s CROSS JOIN range(30) g(bin) LEFT JOIN c USING (event_type, bin) GROUP BY 1)
SELECT w AS processor_name, coalesce(count, 0) AS count, avg, vals, bins, count IS NULL AS no_data FROM (SELECT unnest(['click', 'absent']) AS w) LEFT JOIN s ON w = s.event_type LEFT JOIN h ON w = h.event_type""", "avg")
def cat02_metric_data(spark, d):
    """Two metrics, one of which is absent, each in one row with its summary, its values in order of time and its artifacts."""
    m = A.metrics(spark, d).withColumn("aggregation_mask", F.lit(2))
    stored = sinks.materialize(windows.full_summary(m, "3650 days").withColumn("aggregation_mask", F.lit(2)), "aggregates")
    names = [("click", "click"), ("absent", "absent")]
    detail = [catalog.metric_detail(stored, "value", name) for name, _ in names]
    kept = m.where(F.col("processor_name").isin([n for n, _ in names]))
    values = windows.collect_values(kept, "3650 days").select("processor_name", "values")
    typed = kept.withColumns({"label": F.lit(None).cast("string"), "passed": F.lit(None).cast("boolean"), "x": F.lit(None).cast("double"), "y": F.lit(None).cast("double"), "meta": F.lit(None).cast("string")})
    artifacts = dispatch.artifact_set(typed, ["processor_name"]).select("processor_name", "histogram")
    return catalog.metric_data(detail[0].unionByName(detail[1]), values, artifacts).select("processor_name", "count", "avg", text(F.col("values"), 2).alias("vals"), text(F.col("histogram.counts")).alias("bins"), "no_data")
