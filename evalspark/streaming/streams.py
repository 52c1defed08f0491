"""Structured Streaming forms: windowed summaries, deduplication, task state and chain tails.

State that lives as long as the stream is bounded by timers, or by one small row a key. Task states and the TTL rule pass their
state along with the rows, since every call to the store from Python is a round trip. Stateful processors need the RocksDB
state store (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.lifecycle import STATUS, normal_names
from ..operators.windows import KEY, windowed
from ..sources.sinks import write_batch


def windowed_summary(stream: DataFrame, size: str = "60 seconds", delay: str = "10 seconds", step: str | None = None) -> DataFrame:
    """count, sum, avg, min, max per key and event-time window; rows later than ``delay`` are dropped."""
    w = F.window("ts", size, step) if step else F.window("ts", size)
    g = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).where("num is not null").groupBy(w.alias("w"), *KEY)
    return g.agg(F.count("*").alias("count"), F.sum("num").alias("sum"), F.avg("num").alias("avg"), F.min("num").alias("min"), F.max("num").alias("max")).select(*KEY, F.unix_timestamp("w.start").alias("window_start_unix"), "count", "sum", "avg", "min", "max")


def deduplicated(stream: DataFrame, keys: list[str], ttl: str) -> DataFrame:
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", ttl).dropDuplicatesWithinWatermark(keys)


def _ordered(frames: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    """The rows of one key in one micro-batch, in order. A trigger bounds how many there are."""
    return pd.concat(list(frames)).sort_values(by, kind="stable")


STATE = "status string, directory_key string, processor_name string, created_at long, started_at long, completed_at long, duration_ms double, error string, events long, at long"
FIELDS = [f.split()[0] for f in STATE.split(", ")]
STATES = f"task_id long, {STATE}, history string"
BUCKETS = 1 << 13  # of tasks or keys; calls and state rows are a bucket's, as one for each task costs far more than its events


def _steps(now: dict[str, Any] | None, held: list, rows: list[tuple], cap: int) -> Iterator[tuple[dict[str, Any] | None, list]]:
    """A task's state and history after each of its events that count, given in order."""
    for at, kind, directory, processor, duration, error in rows:
        if kind == "TASK_CREATED":
            now, held = dict.fromkeys(FIELDS) | {"directory_key": directory, "created_at": at, "events": 0, "at": at}, []
        if now is None:
            continue
        now = dict(now)
        if at >= now["at"] or now["status"] is None:
            now |= {"status": STATUS[kind], "at": at}
        if kind == "TASK_STARTED":
            now |= {"started_at": at, "processor_name": processor}
        elif kind == "TASK_COMPLETED":
            now |= {"completed_at": at, "duration_ms": duration}
        elif kind == "TASK_FAILED":
            now |= {"completed_at": at, "error": error}
        now["events"] += 1
        held = [*held, (kind, at)][-cap:]
        yield now, held


def _task_states(cap: int, ttl: int) -> Callable:
    """The update of one bucket of tasks. Its state is a JSON object: each task's fields and history by its id.

    The bucket's timer is that of its task quiet for longest. Tasks whose time has come leave before new rows are taken.
    """

    def update(key: Any, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = json.loads(state.get[0]) if state.exists else {}
        mark, out = state.getCurrentWatermarkMs(), []
        tell = lambda task, now, history: out.append((json.loads(task), *now, json.dumps(history)))
        for task in [t for t, (now, _) in held.items() if (now[-1] + ttl) * 1000 < mark]:
            now, history = held.pop(task)
            tell(task, ["expired", *now[1:]], history)
        arrived: dict[str, list[tuple]] = {}
        for frame in [] if state.hasTimedOut else frames:
            columns = [frame[c].tolist() for c in ("task", "at", "event_type", "directory_key", "processor_name", "duration_ms", "error")]
            for task, *row in zip(*columns, strict=True):
                arrived.setdefault(task or "null", []).append((*row[:4], None if pd.isna(row[4]) else row[4], row[5]))
        for task, rows in arrived.items():
            now, history = held.get(task, (None, []))
            now = dict(zip(FIELDS, now, strict=True)) if now else None
            for now, history in _steps(now, history, sorted(rows, key=lambda r: r[:2]), cap):  # noqa: B007
                tell(task, now.values(), history)
            if now is not None:
                held[task] = (list(now.values()), history)
        if held:
            state.update((json.dumps(held),))
            state.setTimeoutTimestamp(max((min(now[-1] for now, _ in held.values()) + ttl) * 1000, mark + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=["task_id", *FIELDS, "history"], dtype=object)

    return update


class ChainTails(StatefulProcessor):
    """Breaks of a source's chain as they arrive; the tail is kept between batches, events of a batch are taken by seq.

    A new query may begin with the tails that an earlier one held (``saved_tails``), as its initial state.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.tail = handle.getValueState("tail", "hash string, events long")

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        row = initialState.iloc[0]
        self.tail.update((row["last_hash"], int(row["event_count"])))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        tail, events = self.tail.get() if self.tail.exists() else (None, 0)
        broken = []
        for row in _ordered(rows, ["seq", "content_hash"]).itertuples():
            if events and row.prev_hash != tail:
                broken.append((key[0], row.seq))
            tail, events = row.content_hash, events + 1
        self.tail.update((tail, events))
        yield pd.DataFrame(broken, columns=["source_id", "seq"])

    def close(self) -> None:
        pass


def _first_of_ttl(ttl: int) -> Callable:
    """The update of one bucket of keys. Its state is a JSON object: each key's last accepted time, for as long as it can matter."""
    micros = ttl * 1_000_000

    def update(key: Any, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        mark, kept = state.getCurrentWatermarkMs(), []
        held: dict[str, int] = json.loads(state.get[0]) if state.exists else {}
        held = {k: last for k, last in held.items() if last + micros > mark * 1000}
        if not state.hasTimedOut:
            rows = pd.concat(list(frames))
            codes, names = pd.factorize(rows["name"])
            order = np.lexsort((rows["micros"].to_numpy(), codes))
            codes, all_times = codes[order], rows["micros"].to_numpy()[order]
            for name, times in zip(names, np.split(all_times, np.flatnonzero(np.diff(codes)) + 1), strict=True):
                last, at = held.get(name), 0
                while at < len(times):
                    if last is not None and times[at] < last + micros:
                        at += int(np.searchsorted(times[at:], last + micros))  # jumps over all that is held back
                        continue
                    last = int(times[at])
                    kept.append((name, last))
                    at += 1
                held[name] = last
        if held:
            state.update((json.dumps(held),))
            state.setTimeoutTimestamp(max(min(held.values()) // 1000 + ttl * 1000, mark + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"name": pd.Series([k for k, _ in kept], dtype=object), "accepted_us": pd.Series([t for _, t in kept], dtype="int64")})

    return update


class LastTimes(StatefulProcessor):
    """Files that are new, or younger than when they were last listed; the state is one time a path."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "micros long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        last = self.seen.get()[0] if self.seen.exists() else None
        told = []
        for row in _ordered(rows, ["micros", "length"]).itertuples():
            if last is None or row.micros > last:
                told.append((key[0], int(row.micros), int(row.length), "new" if last is None else "modified"))
                last = int(row.micros)
        if told:
            self.seen.update((last,))
        yield pd.DataFrame(told, columns=["path", "micros", "length", "state"])

    def close(self) -> None:
        pass


def changed_files(listings: DataFrame) -> DataFrame:
    """(path, mtime, length, state) of a stream of listings (path, mtime, length), as ``readers.record_listing`` appends them:
    each file when it is first listed (new) and whenever it is listed with a later time (modified). A file that is modified
    several times between two batches is told once for each listing that shows a later time. Rows without a path or time are
    left out."""
    rows = listings.where("path is not null and mtime is not null").select("path", F.unix_micros("mtime").alias("micros"), F.coalesce("length", F.lit(0)).alias("length"))
    made = rows.groupBy("path").transformWithStateInPandas(LastTimes(), "path string, micros long, length long, state string", "Append", "None")
    return made.select("path", F.timestamp_micros("micros").alias("mtime"), "length", "state")


def windows_with_late_rows(stream: DataFrame, path: str, checkpoint: str, size: str = "60 seconds", delay: int = 10, lateness: int = 60) -> StreamingQuery:
    """Event-time windows that late rows still update, and a side output of those that come too late.

    The watermark is the latest time of all earlier micro-batches less ``delay`` seconds. A row whose window ended ``lateness``
    seconds before it, or earlier, goes to ``path``/late; all others are added up by key and window, and each micro-batch leaves
    its own partial summaries in ``path``/windows, so an update is one more small row and no state is held. ``open_windows`` merges
    them. What a batch writes depends on its rows and on earlier batches only; if it is replayed, it replaces what it wrote.
    Rows without a time or a number take no part.
    """

    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        rows = windowed(batch.withColumn("ts", F.col("ts").cast("timestamp")).where("ts is not null and num is not null"), size)
        rows.persist()
        try:
            marks = spark.read.schema("last long").parquet(f"{path}/marks").where(F.col("batch") < n) if n else None
            known = marks.agg(F.max("last")).first()[0] if marks is not None else None
            late = F.col("window_end_unix") + lateness <= F.lit(known - delay) if known is not None else F.lit(False)
            write_batch(rows.where(late), n, f"{path}/late")
            sums = rows.where(~late).groupBy(*KEY, "window_start_unix").agg(F.count("*").alias("count"), F.sum("num").alias("sum"), F.min("num").alias("min"), F.max("num").alias("max"))
            write_batch(sums, n, f"{path}/windows")
            write_batch(rows.agg(F.max(F.unix_timestamp("ts")).alias("last")), n, f"{path}/marks")
        finally:
            rows.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def open_windows(spark: SparkSession, path: str) -> DataFrame:
    """The windows of ``windows_with_late_rows`` as they stand: the partial summaries of all batches merged."""
    g = spark.read.parquet(f"{path}/windows").groupBy(*KEY, "window_start_unix")
    out = g.agg(F.sum("count").alias("count"), F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max"), F.count("*").alias("updates"))
    return out.withColumn("avg", F.col("sum") / F.col("count"))


def task_states(stream: DataFrame, cap: int = 100, ttl: int = 86_400, delay: str = "10 seconds", buckets: int = BUCKETS) -> DataFrame:
    """``STATES`` for each event of a stream of (task_id, event_type, ts, directory_key, processor_name, duration_ms, error): a
    task's state after that event, with the last ``cap`` events and the true number of all.

    Older JOB_* names are read as TASK_*. Times are seconds; history is a JSON list of [type, at]. Rows behind the watermark or
    without a time are dropped, null task ids make one task, and rows of other types are ignored, as are events before a creation;
    a second creation starts anew. Once the watermark is more than ``ttl`` behind a task's latest event, the task ends: a last row of
    status ``expired``, and nothing is held any more.

    Tasks are dealt by hash into ``buckets``, whose live tasks are read and written as one state row. What a call holds is one
    bucket's share of the live tasks and of a micro-batch.
    """
    rows = normal_names(stream).withColumn("ts", F.col("ts").cast("timestamp")).where("ts is not null").withWatermark("ts", delay).where(F.col("event_type").isin(list(STATUS)))
    task = F.col("task_id").cast("string").alias("task")  # a null among whole numbers would make them floats in pandas
    rows = rows.select(F.pmod(F.xxhash64("task_id"), F.lit(buckets)).alias("bucket"), task, "event_type", "ts", F.unix_timestamp("ts").alias("at"), "directory_key", "processor_name", "duration_ms", "error")
    return rows.groupBy("bucket").applyInPandasWithState(_task_states(cap, ttl), STATES, "tasks string", "append", GroupStateTimeout.EventTimeTimeout)


def chain_breaks(stream: DataFrame, tails: DataFrame | None = None) -> DataFrame:
    """(source_id, seq) of events whose previous hash isn't the one before them. ``tails`` (source_id, last_hash, event_count)
    is what is known already: from ``saved_tails``, or from a batch's ``audit.state``. A source without a tail may start anywhere."""
    initial = tails.select("source_id", "last_hash", "event_count").groupBy("source_id") if tails is not None else None
    return stream.groupBy("source_id").transformWithStateInPandas(ChainTails(), "source_id long, seq long", "Append", "None", initialState=initial)


def saved_tails(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(source_id, last_hash, event_count): the tails that a stream of ``chain_breaks`` held when it stopped, read from its checkpoint."""
    rows = spark.read.format("statestore").option("stateVarName", "tail").load(checkpoint)
    return rows.select(F.col("key.source_id").alias("source_id"), F.col("value.hash").alias("last_hash"), F.col("value.events").alias("event_count"))


def accepted_by_ttl(stream: DataFrame, keys: list[str], ttl: int, delay: str = "10 seconds", buckets: int = BUCKETS) -> DataFrame:
    """(keys, accepted_us) by the exact rule of ``lifecycle.deduplicate_ttl``, for rows that come in order of time from batch to
    batch (rows of one batch may come in any). Rows without a time are left out. Keys are dealt by hash into ``buckets``, whose
    live keys are read and written as one state row; keys travel as JSON."""
    if ttl < 1:
        raise ValueError("ttl must be one second at least")
    rows = stream.withColumn("ts", F.col("ts").cast("timestamp")).where("ts is not null").withWatermark("ts", delay)
    exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    name = F.to_json(F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]), exact).alias("name")
    rows = rows.select(name, "ts", F.unix_micros("ts").alias("micros")).withColumn("bucket", F.pmod(F.xxhash64("name"), F.lit(buckets)))
    made = rows.groupBy("bucket").applyInPandasWithState(_first_of_ttl(ttl), "name string, accepted_us long", "keys string", "append", GroupStateTimeout.EventTimeTimeout)
    types = dict(stream.dtypes)
    read = F.from_json("name", ", ".join(f"k{i} {types[k]}" for i, k in enumerate(keys)), exact).alias("k")
    return made.select(read, "accepted_us").select(*[F.col(f"k.k{i}").alias(k) for i, k in enumerate(keys)], "accepted_us")
