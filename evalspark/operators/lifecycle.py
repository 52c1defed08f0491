"""Task state from lifecycle events, routing, and latency."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.values import whole_json
from .ranks import at_ranks, join_groups

STATUS = {"TASK_CREATED": "created", "TASK_STARTED": "started", "TASK_COMPLETED": "completed", "TASK_FAILED": "failed"}


def normal_names(df: DataFrame, column: str = "event_type") -> DataFrame:
    """Older JOB_* names as TASK_*."""
    return df.withColumn(column, F.regexp_replace(column, "^JOB_", "TASK_"))


def status_of(column: str = "event_type") -> F.Column:
    return F.element_at(F.create_map(*[F.lit(x) for p in STATUS.items() for x in p]), F.col(column))


def current_state(events: DataFrame, need_created: bool = True) -> DataFrame:
    """One row a task: the last status and the last value of every field that some event set."""
    last = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct("ts", "event_type"))).alias(c)
    at = lambda e, n: F.max(F.when(F.col("event_type") == e, F.unix_timestamp("ts"))).alias(n)
    g = events.groupBy("task_id").agg(
        F.max_by(status_of(), F.struct("ts", "event_type")).alias("status"), last("directory_key"), last("processor_name"), last("duration_ms"), last("error"),
        at("TASK_CREATED", "created_at"), at("TASK_STARTED", "started_at"), at("TASK_COMPLETED", "completed_at"), F.count("*").alias("event_count"),
    )
    return g.where("created_at is not null") if need_created else g


def change_log(events: DataFrame, keep: int = 100) -> DataFrame:
    """A row for each event with its status, its number within the task and how many of the last ``keep`` are held."""
    w = W.partitionBy("task_id").orderBy("ts", "event_type")
    return events.select("task_id", "event_type", F.unix_timestamp("ts").alias("at"), status_of().alias("status"), F.row_number().over(w).alias("event_no"), F.size(F.collect_list("event_type").over(w.rowsBetween(1 - keep, 0))).alias("held"), F.lag("event_type").over(w).alias("before"))


def event_history(events: DataFrame, keep: int = 100) -> DataFrame:
    """A row for each event with the last ``keep`` events of its task, that one included, and the true number of all so far.
    An array is as long as ``keep`` says; ties in time are ordered by type. Null task ids make one task."""
    w = W.partitionBy("task_id").orderBy("ts", "event_type")
    held = F.collect_list(F.struct(F.col("event_type").alias("type"), F.unix_timestamp("ts").alias("at"))).over(w.rowsBetween(1 - keep, 0))
    return events.select("task_id", "event_type", "ts", F.row_number().over(w).alias("event_count"), held.alias("history"))


def route_faults(routes: DataFrame, registered: DataFrame) -> DataFrame:
    """(algorithm, version, fault): ``unregistered`` for what routes name and the registry lacks, ``duplicate`` for what the
    registry has more than once. Nulls are names like others; each fault is told once."""
    names = ["algorithm", "version"]
    missing = join_groups(routes.select(*names).distinct(), registered.select(*names).distinct(), names, "left_anti").withColumn("fault", F.lit("unregistered"))
    twice = registered.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").select(*names, F.lit("duplicate").alias("fault"))
    return missing.unionByName(twice)


def task_list(state: DataFrame, status: str | None, limit: int) -> DataFrame:
    """Newest first, tasks without a creation time last."""
    some = state.where(F.col("status") == status) if status else state
    return some.orderBy(F.col("created_at").desc_nulls_last(), "task_id").limit(max(1, min(200, limit)))


def throughput(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type", "processor_name", "error").agg(F.count("*").alias("n"))


# The fields of each event type's payload, in order.
PAYLOADS = {
    "TASK_CREATED": "task_id directory_key path fingerprint file_hash",
    "TASK_STARTED": "task_id processor_name processor_version",
    "TASK_COMPLETED": "task_id processor_name processor_version duration_ms",
    "TASK_FAILED": "task_id processor_name processor_version error error_type",
    "RESULT_PRODUCED": "task_id processor_name processor_version metric_count artifact_refs",
    "METRIC_EMITTED": "task_id processor_name processor_version metric_name value aggregation_mask meta",
    "AGGREGATE_COMPUTED": "processor_name processor_version metric_name aggregation_type window_start_unix window_end_unix summary artifact_ref",
    "ARTIFACT_STORED": "content_hash bucket key size mime source_task_id",
}


def with_payload(events: DataFrame) -> DataFrame:
    """events with the JSON payload of their type, built from the columns of its fields.

    A field without a column is null, and nulls are written; meta is a map of texts, empty where absent or null. A row of another type,
    or of none, has a null payload.
    """
    have = set(events.columns)
    empty = F.from_json(F.lit("{}"), "map<string,string>")

    def of(c: str) -> Column:
        if c == "meta":
            return F.coalesce(F.col("meta"), empty) if c in have else empty
        return F.col(f"`{c}`") if c in have else F.lit(None).cast("string")

    built = [F.when(F.col("event_type") == t, F.to_json(F.struct(*[of(c).alias(c) for c in fields.split()]), {"ignoreNullFields": "false"})) for t, fields in PAYLOADS.items()]
    return events.withColumn("payload", F.coalesce(*built))


def dead_letters(records: DataFrame, raw: str, kind: str, known: list[str]) -> DataFrame:
    """The records that can't be taken, each with its reason: unparseable JSON in ``raw``, or a type ``kind`` that isn't known.

    A null text is unparseable, a null type unknown; the first reason that holds is told.
    """
    reason = F.when(~whole_json(F.col(raw)), "unparseable").when(~F.coalesce(F.col(kind).isin(known), F.lit(False)), "unknown_type")
    return records.withColumn("reason", reason).where("reason is not null")


def duration_buckets(events: DataFrame, bounds: list[float]) -> DataFrame:
    """Cumulative counts for each upper bound, with one for infinity at the end."""
    done = events.where("duration_ms is not null")
    n = [F.count(F.when(F.col("duration_ms") <= b, 1)).alias(str(i)) for i, b in enumerate(bounds)]
    one = done.agg(*n, F.count("*").alias(str(len(bounds))))
    rows = F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(str(i)).alias("n")) for i, b in enumerate([*bounds, float("inf")])])
    return one.select(F.explode(rows).alias("r")).select("r.le", "r.n")


def exclusive_place(p: float, n: F.Column) -> tuple[F.Column, F.Column]:
    """The quantile's position p * (n + 1), counted from 1, and the whole number below that has a neighbour above."""
    at = F.lit(p) * (n + 1)
    return at, F.greatest(F.lit(1), F.least(n - 1, F.floor(at)))


def latency(events: DataFrame, key: str) -> DataFrame:
    """Seconds from creation to the end of a task: count, average, median, p95, p99 by the exclusive rule: at position
    p * (n + 1) between neighbours; the value itself where there is one only."""
    s = current_state(events).where("completed_at is not null").withColumn("s", F.col("duration_ms") / 1000)
    wanted, ranks = {"p50": 0.5, "p95": 0.95, "p99": 0.99}, {}
    for name, p in wanted.items():
        _, low = exclusive_place(p, F.col("n"))
        ranks |= {f"{name}_low": low - 1, f"{name}_high": low}
    g = s.groupBy(key).agg(F.count("*").alias("n"), F.count("s").alias("m"), F.avg("s").alias("avg"))
    g = join_groups(g, at_ranks(s, [key], "s", ranks), [key], "left")
    out = []
    for name, p in wanted.items():
        at, low = exclusive_place(p, F.col("m"))
        line = F.col(f"{name}_low") + (at - low) * (F.col(f"{name}_high") - F.col(f"{name}_low"))
        out.append(F.when(F.col("m") > 1, line).otherwise(F.col(f"{name}_low")).alias(name))
    return g.select(key, "n", "avg", *out)


def dispatch(tasks: DataFrame, routes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tasks with their route, and tasks without one. Spark sends the routes to all tasks if they are as few as they should be."""
    return tasks.join(routes, "directory_key"), tasks.join(routes.select("directory_key"), "directory_key", "left_anti")


def deduplicate_ttl(df: DataFrame, keys: list[str], ttl: int) -> DataFrame:
    """Rows accepted when no accepted row of their key lies within ``ttl`` seconds before; repeats don't extend it.

    Equal times of a key are counted first. Where a block of ``ttl`` seconds is empty, what follows stands alone, whatever came
    before; such runs are dealt over tasks, and each is walked in order with nothing but the last accepted time at hand. Rows
    without a time take no part; ``ttl`` is one second at least.
    """
    if ttl < 1:
        raise ValueError("ttl must be one second at least")
    us = ttl * 1_000_000
    times = df.where("ts is not null").groupBy(*keys, F.unix_micros("ts").alias("_t")).agg(F.count("*").alias("_m"))
    times = times.withColumn("_block", F.floor(F.col("_t") / F.lit(us)))
    group = W.partitionBy(*keys)
    blocks = times.groupBy(*keys, "_block").agg(F.sum("_m").alias("_m"))
    runs = blocks.select(*keys, "_block", (F.col("_block") - F.row_number().over(group.orderBy("_block"))).alias("_run"), F.sum("_m").over(group).alias("seen"))
    rows = join_groups(times, runs, [*keys, "_block"]).select(*keys, "_run", "_t", "seen")
    rows = rows.repartition(*keys, "_run").sortWithinPartitions(*keys, "_run", "_t")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, last = None, 0
        for b in batches:
            at = b.column("_t").to_numpy()
            keep = []
            for i, run in enumerate(zip(*[b.column(c).to_pylist() for c in [*keys, "_run"]], strict=True)):
                if run != now or at[i] - last >= us:
                    now, last = run, at[i]
                    keep.append(i)
            yield b.take(pa.array(keep, pa.int64()))

    kept = rows.mapInArrow(walk, rows.schema)
    return kept.select(*keys, F.col("_t").alias("accepted_us"), F.col("seen").cast("int").alias("seen"))
