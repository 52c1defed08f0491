"""User processors over bytes, as Spark jobs: measurements alone, or whole jobs with artifacts and life-cycle events."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.values import FLAGS
from ..sources.sinks import materialize


class Processor(Protocol):
    name: str
    version: str

    def initialize(self, settings: dict[str, Any]) -> None: ...

    def run(self, content: bytes, settings: dict[str, Any]) -> dict[str, tuple[float, int]]: ...


@dataclass(frozen=True)
class Measurement:
    """A value (anything that JSON can say), the mask of what is to be aggregated, and options as texts."""

    value: Any
    mask: int = 0
    meta: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Artifact:
    name: str
    mime: str
    data: bytes


@dataclass(frozen=True)
class Result:
    """What a processor of a job returns. Plain values instead of measurements have mask 0; artifacts without data are dropped."""

    metrics: dict[str, Any] = field(default_factory=dict)
    artifacts: tuple[Artifact, ...] = ()


class Registry:
    def __init__(self) -> None:
        self.classes: dict[tuple[str, str], type] = {}

    def add(self, cls: type) -> type:
        key = (cls.name, cls.version)
        if key in self.classes:
            raise ValueError(f"processor {key} is registered already")
        self.classes[key] = cls
        return cls


def run_processor(tasks: DataFrame, cls: type, settings: dict[str, Any]) -> DataFrame:
    """(task_id, metric_name, value, mask, error): a row for each measurement, or one with the error of a failed task.

    The processor is set up once for each Python worker's partition; a failing row fails alone.
    """

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = cls()
        p.initialize(settings)
        for frame in frames:
            out = []
            for task, content in zip(frame["task_id"], frame["content"], strict=True):
                try:
                    out += [(task, k, float(v), m, None) for k, (v, m) in p.run(bytes(content), settings).items()]
                except Exception as e:  # the contract: any failure of user code becomes a failed task
                    out.append((task, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["task_id", "metric_name", "value", "mask", "error"])

    return tasks.select("task_id", "content").mapInPandas(work, "task_id long, metric_name string, value double, mask int, error string")


TAGGED = pa.schema([
    ("task_id", pa.int64()), ("seq", pa.int32()), ("event_type", pa.string()), ("processor_name", pa.string()), ("processor_version", pa.string()),
    ("metric_name", pa.string()), ("value", pa.string()), ("aggregation_mask", pa.int32()), ("meta", pa.map_(pa.string(), pa.string())),
    ("content_hash", pa.string()), ("name", pa.string()), ("mime", pa.string()), ("data", pa.binary()),
    ("metric_count", pa.int32()), ("artifact_refs", pa.list_(pa.string())), ("duration_ms", pa.float64()), ("error", pa.string()), ("error_type", pa.string()),
])
TAGGED_DDL = "task_id long, seq int, event_type string, processor_name string, processor_version string, metric_name string, value string, aggregation_mask int, meta map<string,string>, content_hash string, name string, mime string, data binary, metric_count int, artifact_refs array<string>, duration_ms double, error string, error_type string"
HELD_BYTES, HELD_ROWS = 8 << 20, 2_000


@dataclass(frozen=True)
class Job:
    """The three outputs of one pass, all read from one stored table."""

    tagged: DataFrame

    @property
    def measurements(self) -> DataFrame:
        return self.tagged.where("event_type = 'METRIC_EMITTED'").select("task_id", "seq", "processor_name", "processor_version", "metric_name", "value", "aggregation_mask", "meta")

    @property
    def artifacts(self) -> DataFrame:
        return self.tagged.where("event_type = 'ARTIFACT_STORED'").select("task_id", "seq", "content_hash", "name", "mime", F.octet_length("data").cast("long").alias("size"), "data")

    @property
    def events(self) -> DataFrame:
        """Every event in order of ``seq`` within its task, without the artifacts' bytes."""
        return self.tagged.drop("data")


def _task(task: dict, p: Any, settings: dict, name: str, version: str) -> list[dict]:
    """The events of one task that has a processor. It fails alone and whole: after an error nothing of its result is told."""
    base = {"task_id": task["task_id"], "processor_name": name, "processor_version": version}
    began = time.perf_counter()
    out = [base | {"event_type": "TASK_STARTED"}]
    try:
        if task["content"] is None:
            raise FileNotFoundError("no content")
        result = p.run(bytes(task["content"]), settings)
        stored = [a for a in result.artifacts if a.data]
        hashes = [hashlib.sha256(a.data).hexdigest() for a in stored]
        made = [base | {"event_type": "ARTIFACT_STORED", "content_hash": h, "name": a.name, "mime": a.mime, "data": a.data} for h, a in zip(hashes, stored, strict=True)]
        made.append(base | {"event_type": "RESULT_PRODUCED", "metric_count": len(result.metrics), "artifact_refs": hashes})
        took = (time.perf_counter() - began) * 1000
        told = {k: m if isinstance(m, Measurement) else Measurement(m) for k, m in result.metrics.items()}
        told["task_duration_ms"] = Measurement(took, FLAGS["STATS"] | FLAGS["HISTOGRAM"], {"unit": "milliseconds"})
        for k, m in told.items():
            made.append(base | {"event_type": "METRIC_EMITTED", "metric_name": k, "value": json.dumps(m.value), "aggregation_mask": m.mask, "meta": [(a, str(b)) for a, b in m.meta.items()]})
        return [*out, *made, base | {"event_type": "TASK_COMPLETED", "duration_ms": took}]
    except Exception as e:  # the contract: any failure of user code becomes a failed task
        return [*out, base | {"event_type": "TASK_FAILED", "error": str(e), "error_type": type(e).__name__}]


def run_job(tasks: DataFrame, routes: DataFrame, registry: Registry) -> Job:
    """Every task through the processor that its directory is routed to, in one pass, written once and split afterwards.

    tasks: task_id, directory_key, content. routes: directory_key, algorithm, version and, if there are any, settings. Spark
    sends the routes to all tasks as long as they are few. A processor is set up once for each worker's partition and settings.
    A task without a route, or whose processor isn't registered or can't be set up, or whose content is null, fails; so does
    one whose run raises, with nothing but a TASK_STARTED and a TASK_FAILED. Every attempt at a task gives the same events,
    durations apart; a lost executor's attempt leaves nothing behind, as only whole partitions are written.
    """
    if "settings" not in routes.columns:
        routes = routes.withColumn("settings", F.lit(None).cast("map<string,string>"))
    routed = tasks.select("task_id", "directory_key", "content").join(routes.select("directory_key", "algorithm", "version", "settings"), "directory_key", "left")
    classes = dict(registry.classes)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[tuple, Any] = {}

        def of(name: str, version: str, settings: dict) -> Any:
            key = (name, version, tuple(sorted(settings.items())))
            if key not in ready:
                if (name, version) not in classes:
                    raise KeyError(f"processor {name} {version} is not registered")
                made = classes[name, version]()
                made.initialize(settings)
                ready[key] = made
            return ready[key]

        out, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                task = batch.slice(i, 1).to_pylist()[0]
                name, version, settings = task["algorithm"], task["version"], dict(task["settings"] or {})
                try:
                    if name is None:
                        raise KeyError(f"no route for {task['directory_key']}")
                    p = of(name, version, settings)
                except Exception as e:  # no processor for this task; others go on
                    rows = [{"task_id": task["task_id"], "processor_name": name, "processor_version": version, "event_type": "TASK_FAILED", "error": str(e.args[0]) if e.args else "", "error_type": type(e).__name__}]
                else:
                    rows = _task(task, p, settings, name, version)
                out += [dict.fromkeys(TAGGED.names) | r | {"seq": n} for n, r in enumerate(rows)]
                size += sum(len(r.get("data") or b"") for r in rows)
                if len(out) >= HELD_ROWS or size >= HELD_BYTES:
                    yield pa.RecordBatch.from_pylist(out, TAGGED)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, TAGGED)

    return Job(materialize(routed.mapInArrow(work, TAGGED_DDL), "job"))


def probe(df: DataFrame, size: str, event_count: int = 1, pass_threshold: float = 0.5) -> DataFrame:
    """The probe processor as expressions on a content's size; the count of events and the threshold are settings."""
    s = F.col(size)
    score = (s % 1000) / 1000
    return df.withColumns({"score": score, "passed": score > pass_threshold, "event_count": F.lit(event_count), "intensity": s % 256, "center_x": F.sin(s) * 10, "center_y": F.cos(s) * 10})


def hash_score(content: F.Column) -> F.Column:
    """The first byte of the SHA-1 of the first 64 bytes, over 255; 0 for no content."""
    head = F.conv(F.substring(F.sha1(F.substring(content.cast("binary"), 1, 64)), 1, 2), 16, 10).cast("int") / 255
    return F.when(F.octet_length(content) == 0, F.lit(0.0)).otherwise(head)
