"""Benchmark decontamination by the q-gram lemma.

Texts are normalised (A-Z lower-cased, every run of other bytes than letters, digits and non-ASCII to one space). A match
is a region of a document within ``budget(n)`` edits (6 % of n bytes, fewer for short ones) of any n bytes of an item that
follow each other, where n is ``PASSAGE``, or the whole item if it is shorter. By the q-gram lemma such a region shares at
least n - q + 1 - q * e q-grams with them, all on neighbouring diagonals. Shared q-grams are counted in overlapping
bands of diagonals; bands that reach the bound are kept and verified by banded alignment, which gives the true
distance and the span. Items below ``SHORT`` bytes must occur without edits, as whole words.

The items are the small side and come in chunks of at most ``CHUNK_BYTES`` of UTF-8, about 20 times that as an index. One
chunk is held by the driver and by a task at a time: with one chunk rows keep their partition, with more each chunk is
a pass of its own over the documents whose finds are written, and these are joined to the documents at the end.

Edge cases: null or empty texts match nothing, nor do items without a letter or digit; equal items each match under their
own item_id, which may be null. Repeated rows come back as often as they came; a null doc_id is kept. Ties between places go
to the smaller distance, then the earlier one. Other columns pass through whatever their names; ``find`` replaces an older
``leaks``, ``clean`` keeps it. An empty benchmark leaves all documents as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops
from .shared import helper, materialize, table

Q = 10
EDITS = 0.06
SHORT = 24
PASSAGE, STEP = 128, 64
CHUNK_BYTES = 2 << 20
SLOTS = 1 << 20  # a bit for each hash slot of the items' q-grams, so that most positions are settled by one lookup

_KEEP = np.zeros(256, bool)
_KEEP[48:58] = _KEEP[65:91] = _KEEP[97:123] = True
_KEEP[128:] = True


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, place of each byte in the input); rows are kept apart."""
    kept = _KEEP[data]
    gap = ~kept
    gap[1:] &= kept[:-1]  # the first byte of a gap stands for it
    gap[:1] = False
    begin = offsets[:-1][offsets[:-1] < len(data)]
    gap[begin] = False
    at = np.flatnonzero(kept | gap)
    out = textops.LOWER[data[at]]
    out[~kept[at]] = 32
    return out, np.searchsorted(at, offsets), at


def budget(m: np.ndarray) -> np.ndarray:
    """Edits for items of m bytes: a share of m, and few enough that the lemma still asks for one q-gram."""
    m = np.asarray(m)
    return np.minimum((EDITS * m).astype(np.int64), (m - Q) // Q)


def best_alignment(item: np.ndarray, text: np.ndarray, low: int, high: int, limit: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the least edit distance of the whole item to a region of text, on diagonals low to high.

    A diagonal is text position less item position. The band is walked item byte by item byte; a row of the table is an
    array over the band, insertions along it are resolved by a running minimum.
    """
    width = high - low + 1
    diagonals = np.arange(low, high + 1)
    far = np.int64(1 << 40)
    inside = (diagonals >= 0) & (diagonals <= len(text))
    cost = np.where(inside, 0, far)
    start = diagonals.copy()
    for i in range(len(item)):
        t = diagonals + i  # text position of item byte i on each diagonal
        can = (t >= 0) & (t < len(text))
        step = np.where(can, cost + (text[np.clip(t, 0, len(text) - 1)] != item[i]), far)
        begun = start
        drop = np.append(cost[1:] + 1, far)  # an item byte without a text byte comes from the next diagonal
        less = drop < step
        new, begun = np.where(less, drop, step), np.where(less, np.append(start[1:], 0), begun)
        lead = new - np.arange(width)  # a text byte without an item byte: one more for each diagonal gone up
        run = np.minimum.accumulate(lead)
        source = np.maximum.accumulate(np.where(lead == run, np.arange(width), 0))
        # the first place where the running minimum was reached
        better = run + np.arange(width) < new
        cost = np.where(better, run + np.arange(width), new)
        start = np.where(better, begun[source], begun)
        if cost.min() > limit:
            return None
    ends = diagonals + len(item)
    cost = np.where((ends >= 0) & (ends <= len(text)), cost, far)
    k = int(np.argmin(cost))
    return (int(cost[k]), int(start[k]), int(ends[k])) if cost[k] <= limit else None


class Items:
    """The q-grams of one chunk of items, sorted by hash, with item and place; short items by length and hash."""

    def __init__(self, ids: list[int | None], texts: list[str]):
        (_, _, data, offsets), = textops.pieces(pa.array(texts, pa.string()), 1 << 40)
        data, offsets, _ = normalise(data, offsets)
        self.ids, self.data, self.offsets = ids, data, offsets
        rolling = textops.Rolling(data)
        h = rolling.grams(Q)
        size = np.diff(offsets)
        item = np.searchsorted(offsets, np.arange(len(h)), "right") - 1
        ok = (np.arange(len(h)) + Q <= offsets[item + 1]) & (size[item] >= SHORT)
        place = (np.arange(len(h)) - offsets[item])[ok]
        h, item = h[ok], item[ok]
        order = np.argsort(h, kind="stable")
        self.h, self.item, self.place = h[order], item[order].astype(np.int32), place[order].astype(np.int32)
        self.slots = np.zeros(SLOTS, bool)
        self.slots[(self.h >> np.uint64(44)).astype(np.int64)] = True
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in np.unique(size[(size > 0) & (size < SHORT)]).tolist():
            which = np.flatnonzero(size == n)
            hashes = rolling.grams(n)[offsets[which]]
            order = np.argsort(hashes, kind="stable")
            self.short[n] = hashes[order], which[order]

    def whole_words(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(row, item, 0, start, end) of short items between spaces or ends."""
        rolling = textops.Rolling(data) if self.short and len(data) else None
        for n, (hashes, which) in self.short.items():
            if len(data) < n:
                continue
            h = rolling.grams(n)
            left = np.searchsorted(hashes, h)
            for at in np.flatnonzero(hashes[np.minimum(left, len(hashes) - 1)] == h).tolist():
                r = int(np.searchsorted(offsets, at, "right")) - 1
                end = at + n
                if end > offsets[r + 1] or (at > offsets[r] and data[at - 1] != 32) or (end < offsets[r + 1] and data[end] != 32):
                    continue
                for k in range(int(left[at]), int(np.searchsorted(hashes, h[at], "right"))):
                    i = int(which[k])
                    if np.array_equal(data[at:end], self.data[self.offsets[i] : self.offsets[i + 1]]):
                        yield r, i, 0, at - int(offsets[r]), end - int(offsets[r])

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, edits, start, end) of the regions of every item that a row contains, by row, item and start."""
        out: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for r, i, *one in self.whole_words(data, offsets):
            out.setdefault((r, i), []).append(tuple(one))
        self._long(data, offsets, out)
        return [(r, i, *f) for (r, i), found in sorted(out.items()) for f in sorted(found, key=lambda f: (f[1], f[2], f[0]))]

    def _long(self, data: np.ndarray, offsets: np.ndarray, out: dict) -> None:
        if len(data) < Q or not len(self.h):
            return
        h = textops.Rolling(data).grams(Q)
        at = np.flatnonzero(self.slots[(h >> np.uint64(44)).astype(np.int64)])
        row = np.searchsorted(offsets, at, "right") - 1
        ok = at + Q <= offsets[row + 1]
        at, row = at[ok], row[ok]
        lo, hi = np.searchsorted(self.h, h[at]), np.searchsorted(self.h, h[at], "right")
        many = hi - lo
        at, row = np.repeat(at, many), np.repeat(row, many)
        if not len(at):
            return
        which = np.repeat(lo, many) + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        item, place = self.item[which].astype(np.int64), self.place[which].astype(np.int64)
        diagonal = at - offsets[row] - place
        size = np.minimum(np.diff(self.offsets)[item], PASSAGE)
        need = size - Q + 1 - Q * budget(size)
        # first without diagonals: a row and an item that share too few q-grams in all can't reach the bound in a band
        _, each, total = np.unique(row * len(self.ids) + item, return_inverse=True, return_counts=True)
        ok = total[each] >= need
        if ok.any():
            self._bands(data, offsets, *(x[ok] for x in (row, item, diagonal, place, need, budget(size) + 1, size)), out)

    def _bands(self, data, offsets, row, item, diagonal, place, need, span, size, out: dict) -> None:
        # bands are 2(e + 1) wide and start every e + 1, so that any e + 1 neighbouring diagonals lie within one
        band = np.floor_divide(diagonal, span)
        row, item, need, span, size, diagonal, place = (np.concatenate([x, x]) for x in (row, item, need, span, size, diagonal, place))
        band = np.concatenate([band, band - 1])
        order = np.lexsort((place, band, item, row))
        row, item, band, need, span, size, diagonal, place = (x[order] for x in (row, item, band, need, span, size, diagonal, place))
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (band[1:] != band[:-1])])
        counts = np.diff(np.r_[first, len(row)])
        good = counts >= need[first]
        for k, n in zip(first[good], counts[good], strict=True):
            r, i, b, w, least = int(row[k]), int(item[k]), int(band[k]), int(span[k]), int(need[k])
            text, ref = data[offsets[r] : offsets[r + 1]], self.data[self.offsets[i] : self.offsets[i + 1]]
            low, high = b * w, b * w + 2 * w - 1
            most = int(np.bincount(diagonal[k : k + n] - low).argmax()) + low
            found = out.setdefault((r, i), [])
            self._passages(text, ref, int(size[k]), place[k : k + n], least, low, high, w, most, found)
            if not found:
                del out[r, i]

    @staticmethod
    def _passages(text, ref, length: int, place, least: int, low: int, high: int, w: int, most: int, found: list) -> None:
        """Adds the regions of text that ``length`` bytes of ref match, wherever these start."""
        # equal runs along the commonest diagonal need no alignment
        a, b = max(0, -most), min(len(ref), len(text) - most)
        if b - a >= length:
            edge = np.flatnonzero(np.diff(np.r_[0, (ref[a:b] == text[a + most : b + most]).astype(np.int8), 0])) + a
            for s, e in zip(edge[::2], edge[1::2], strict=True):
                if e - s >= length:
                    found[:] = [f for f in found if not (s + most <= f[1] and f[2] <= e + most)]
                    found.append((0, int(s) + most, int(e) + most))
        # starts of passages that hold enough of the q-grams
        ends = place[least - 1 :]
        begins = place[: len(ends)]
        near = ends - begins <= length - Q
        from_, to = np.maximum(0, ends[near] - (length - Q)), np.minimum(begins[near], len(ref) - length)
        mark = np.zeros(len(ref) + 2, np.int64)
        np.add.at(mark, from_[from_ <= to], 1)
        np.add.at(mark, to[from_ <= to] + 1, -1)
        may = np.cumsum(mark) > 0
        limit, s = w - 1, 0
        while True:
            left = np.flatnonzero(may[s:])
            if not len(left):
                return
            s += int(left[0])
            if any(f[1] <= s + d and s + d + length <= f[2] for f in found for d in (low, most, high)):  # known already
                s += 1
                continue
            # a start k bytes further on saves k edits at most, so what is far above the limit lets starts be left out
            one = best_alignment(ref[s : s + length], text, s + low - w, s + high + w, limit + w)
            if one is None or one[0] > limit:
                s += w if one is None else min(w, one[0] - limit)
                continue
            if not any(f[1] <= one[1] and one[2] <= f[2] for f in found):
                found.append(one)
            stop = s + int(np.argmin(may[s:]))  # past the last start of this run
            s = s + STEP if s + STEP < stop else max(s + 1, stop - 1)


def _chunks(benchmark: DataFrame) -> Iterator[Items]:
    """The items in order, a chunk at a time; no more than one chunk is at the driver."""
    ids, texts, size = [], [], 0
    for item_id, text in benchmark.select("item_id", "text").where("text is not null").orderBy("item_id", "text").toLocalIterator():
        n = len(text.encode())
        if ids and size + n > CHUNK_BYTES:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(item_id)
        texts.append(text)
        size += n
    if ids:
        yield Items(ids, texts)


LEAKS = "array<struct<item_id: bigint, edits: int, start: bigint, end: bigint>>"


def _searched(docs: DataFrame, items: Items, only: bool) -> DataFrame:
    """docs with the leaks of one chunk of items; ``only`` the rows that have some, without their text."""
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    own = [(c, t) for c, t in docs.dtypes if not (only and c == "text")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textops.pieces(batch.column("text")):
                plain, bounds, places = normalise(data, offsets)
                found, last_of = [[] for _ in range(b - a)], {}
                for r, i, edits, start, end in items.matches(plain, bounds):
                    begin, stop = bounds[r] + start, bounds[r] + max(end, start + 1) - 1
                    leak = {"item_id": items.ids[i], "edits": edits, "start": int(places[begin] - offsets[r]), "end": int(places[stop] - offsets[r] + 1)}
                    last = last_of.get((r, i))
                    if last and last["start"] <= leak["start"] <= last["end"]:  # the next passage of one leak
                        last["edits"], last["end"] = min(last["edits"], edits), max(last["end"], leak["end"])
                    else:
                        found[r].append(leak)
                        last_of[r, i] = leak
                cols = [batch.column(c).slice(a, b - a) for c, _ in own]
                out = pa.RecordBatch.from_arrays([*cols, pa.array(found, kind)], [*(c for c, _ in own), "leaks"])
                yield out.filter(pa.array([bool(f) for f in found], pa.bool_())) if only else out

    return docs.mapInArrow(work, ", ".join([*(f"`{c}` {t}" for c, t in own), f"leaks {LEAKS}"]))


def find(docs: DataFrame, benchmark: DataFrame, keep_text: bool = False) -> DataFrame:
    """docs without text, with leaks: array<struct<item_id, edits, start, end>>; spans are UTF-8 bytes of the input.

    Regions of one item that overlap make one leak, with the edits of its best region. Leaks come by item, then start.
    """
    docs = docs.drop("leaks")
    own = [F.col(f"`{c}`") for c in docs.columns if keep_text or c != "text"]
    chunks = _chunks(benchmark)
    first, second = next(chunks, None), next(chunks, None)
    if first is None:
        return docs.select(*own, F.expr(f"cast(array() as {LEAKS})").alias("leaks"))
    if second is None:
        return _searched(docs, first, False).select(*own, "leaks")
    key = docs.select("doc_id", F.xxhash64("text").alias("th"), F.length("text").alias("size"), "text")
    parts = None
    for k, items in enumerate(chain([first, second], chunks)):
        part = materialize(_searched(key, items, True), "leaks").withColumn("k", F.lit(k))
        parts = part if parts is None else parts.union(part)
    th, size, k0, k1, k2 = (helper(docs, x) for x in ("th", "size", "k0", "k1", "k2"))
    # equal rows find the same, so one of each chunk speaks for all
    told = parts.groupBy("doc_id", "th", "size", "k").agg(F.first("leaks").alias("leaks")).groupBy("doc_id", "th", "size").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "leaks"))), lambda x: x["leaks"])).alias("leaks"))
    told = told.withColumnsRenamed({"doc_id": k0, "th": k1, "size": k2})
    keyed = docs.withColumns({th: F.xxhash64("text"), size: F.length("text")})
    same = F.col("doc_id").eqNullSafe(F.col(k0)) & (F.col(th) == F.col(k1)) & (F.col(size) == F.col(k2))
    return keyed.join(told, same, "left").select(*own, F.coalesce("leaks", F.expr(f"cast(array() as {LEAKS})")).alias("leaks"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that contain a benchmark item; all columns and the text stay."""
    held = {"leaks": helper(docs, "held_leaks")} if "leaks" in docs.columns else {}
    found = find(docs.withColumnsRenamed(held), benchmark, keep_text=True)
    return found.where("size(leaks) = 0").select(*(F.col(f"`{held.get(c, c)}`").alias(c) for c in docs.columns))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    least = F.expr("cast(array_min(transform(leaks, x -> x.edits)) as long)")
    return found.select("doc_id", F.expr("cast(size(leaks) > 0 as int)").alias("contaminated"), F.expr("array_sort(array_distinct(transform(leaks, x -> x.item_id)))").alias("items"), least.alias("least_edits"), "leaks")
