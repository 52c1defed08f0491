"""A user's processor and a user's analyzer, for the queries that run them. Workers import this module and no other of this folder."""

from __future__ import annotations

import pyarrow.compute as pc

from ..operators import processors


class TextSize:
    """A processor of texts, for the query: their size in bytes and lines. It refuses texts of some lengths, as faulty files are."""

    name, version = "text_size", "1.0.0"

    def initialize(self, settings):
        self.modulus = int(settings.get("modulus", 7))

    def run(self, content, settings):
        if len(content) % self.modulus == 3:
            raise ValueError(f"cannot read {len(content)} bytes")
        lines = content.count(b"\n")
        note = processors.Artifact("size.txt", "text/plain", f"{len(content)} bytes, {lines} lines".encode() if lines else b"")
        return processors.Result({"n_bytes": processors.Measurement(len(content), 3, {"unit": "bytes"}), "even": processors.Measurement(len(content) % 2 == 0, 16), "lines": lines}, (note,))


class Range:
    """A user's analyzer, for the query: the ends of the values and how many labels there are. Its states can be merged."""

    columns, summary = ["num", "label"], "low double, high double, labels bigint"

    def start(self):
        return (None, None, frozenset())

    def add(self, state, rows):
        ends = pc.min_max(rows.column("num")).as_py()
        return self.merge(state, (ends["min"], ends["max"], frozenset(pc.unique(rows.column("label")).drop_null().to_pylist())))

    def merge(self, a, b):
        low, high = ([v for v in pair if v is not None] for pair in zip(a[:2], b[:2], strict=True))
        return (min(low, default=None), max(high, default=None), a[2] | b[2])

    def result(self, state):
        return {"low": state[0], "high": state[1], "labels": len(state[2])}
