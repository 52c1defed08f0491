"""Exact removal of repeated byte strings: blockwise suffix sorting with ranks of a cover sample.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else goes. Sorting all suffixes of all texts
would move many times the input. As in blockwise construction with a difference cover, only a sample of positions is
ranked, suffixes are sorted one bucket at a time, and what lies beyond a sample position is settled by its rank.

A difference cover has a sample position at the same distance in any two suffixes. Here that position is chosen by
content (a synchronising set): the ``GRAM`` bytes of least hash within a ``LENGTH``-byte string, the leftmost of equals.
Equal strings choose alike, so two suffixes that agree for ``LENGTH`` bytes meet in the bucket of one sample string, at the
same distance from it, with about one position in ninety sampled instead of one in eleven. A *run* is the stretch of
suffixes that share a sample position; its name is a hash of all its bytes.

Runs whose name occurs twice are repeated whole. Only a name that occurs once, in a bucket with other names, needs bytes:
the bucket's sample suffixes are sorted forwards and the bytes before them backwards, which gives every run two ranks and
the lengths that neighbours in rank share. At distance d two suffixes are equal if their ranks fall into one interval of
backward prefixes of d bytes and into one of forward prefixes of LENGTH - d bytes; no byte is compared twice. Buckets
of more than ``HOT`` names are dealt out by suffix instead, with counts combined before the shuffle.

Within a bucket bytes decide. Names stand for 64-bit hashes beside the sample string's 64 bits; buckets above ``HOT``
compare such hashes too.

Edge cases: a null text is empty; a text shorter than ``LENGTH`` bytes loses nothing. Matches never cross documents.
Repeated rows repeat each other's strings, so all of them lose those. Rows are told apart by doc_id (null included), a
64-bit hash of the text and its length; equal rows come back as often as they came. Extra columns pass through, whatever
their names, but for ``kept`` and ``spans``, which are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops
from .shared import bitmap, bits_for, helper, in_bitmap, materialize, table

LENGTH, GRAM = 200, 24
HOT = 8_192


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(sample string's hash, run's name, first start, last start, sample position) of every run of a piece."""
    n = len(data) - length + 1
    if n < 1:
        return None
    rolling = textops.Rolling(data)
    grams = rolling.grams(gram)
    w = length - gram + 1
    # the least of w neighbours by prefix minima within blocks of w and suffix minima; 32 bits of hash, then the place
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    blocks = np.full(-(-len(key) // w) * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[: len(key)] = key
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(back[:n], ahead[w - 1 : w - 1 + n])
    outside = np.zeros(len(data) + 1, np.int64)
    np.add.at(outside, np.maximum(offsets[:-1], offsets[1:] - length + 1), 1)
    np.add.at(outside, offsets[1:], -1)
    s = np.flatnonzero(np.cumsum(outside[:-1])[:n] == 0)
    if not len(s):
        return None
    x = (least[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (s[1:] != s[:-1] + 1)])
    lo, x = s[first], x[first]
    hi = s[np.r_[first[1:], len(s)] - 1]
    name = textops.mix(rolling.of(lo, hi + length) + (x - lo).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return grams[x].view(np.int64), name.view(np.int64), lo, hi, x


def _ranked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each row of bytes in lexicographic order, bytes that each rank shares with the one before)."""
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").reshape(-1), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    told = rows[order]
    other = told[1:] != told[:-1]
    shared = np.where(other.any(1), other.argmax(1), rows.shape[1])
    return rank, np.r_[0, shared]


def repeated_places(bucket: np.ndarray, bodies: list[bytes], rel: np.ndarray, length: int, gram: int) -> np.ndarray:
    """(runs, distances) booleans: which suffix, at which distance before its run's sample position, occurs in another run.

    bucket: each run's bucket; rel: its sample position in its body; all runs of a bucket are given and differ.
    """
    far = length - gram
    n = len(bodies)
    ahead, before = np.zeros((n, 8 + length), np.uint8), np.zeros((n, 8 + far), np.uint8)
    ahead[:, :8] = before[:, :8] = bucket.astype(">i8").view(np.uint8).reshape(n, 8)
    size = np.array([len(b) for b in bodies], np.int64)
    offsets = np.r_[0, np.cumsum(size)]
    data = np.frombuffer(b"".join(bodies), np.uint8)
    cols = np.arange(length)
    at = (offsets[:-1] + rel)[:, None] + cols
    ok = cols < (size - rel)[:, None]
    ahead[:, 8:][ok] = data[at[ok]]
    cols = np.arange(far)
    at = (offsets[:-1] + rel - 1)[:, None] - cols
    ok = cols < rel[:, None]
    before[:, 8:][ok] = data[at[ok]]
    (f_rank, f_shared), (b_rank, b_shared) = _ranked(ahead), _ranked(before)
    nearest, furthest = rel - (size - length), rel  # distances of the last and the first suffix of a run
    out = np.zeros((n, far + 1), bool)
    for d in range(far + 1):
        here = np.flatnonzero((nearest <= d) & (d <= furthest))
        if len(here) < 2:
            continue
        # intervals of ranks that share the bucket and what this distance asks for
        f = np.cumsum(f_shared < 8 + length - d)[f_rank[here]]
        b = np.cumsum(b_shared < 8 + d)[b_rank[here]]
        key = f * (n + 1) + b
        order = np.argsort(key)
        same = np.diff(key[order]) == 0
        out[here[order], d] = np.r_[same, False] | np.r_[False, same]
    return out


def repeated_starts(docs: DataFrame, key: list[str], length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(key columns, starts: array<struct<first, last>>): where strings of ``length`` bytes start that also start elsewhere.

    docs: the key columns, which tell different texts apart, and text.
    """
    kinds = dict(docs.dtypes)
    keyed = ", ".join(f"`{c}` {kinds[c]}" for c in key)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in textops.pieces(batch.column("text")):
                found = runs(data, offsets, length, gram)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["a", "u"])

    names = materialize(docs.select("text").mapInArrow(named, "a long, u long").groupBy("a", "u").agg(F.count("*").alias("c")), "names")
    buckets = materialize(names.groupBy("a").agg(F.count("*").alias("names"), F.min("c").alias("least"), F.sum("c").alias("rows")).where("rows > 1").select("a", "names", "least"), "buckets")
    opened = buckets.where("names > 1 and least = 1").select("a", "names")
    n_buckets, n_open, n_hot = buckets.select(F.count("*"), F.count(F.expr("if(names > 1 and least = 1, 1, null)")), F.count(F.expr(f"if(names > {hot} and least = 1, 1, null)"))).first()
    seen, wanted = bitmap(buckets, "a", bits_for(n_buckets)), bitmap(opened, "a", bits_for(n_open))  # they thin what exact joins then settle

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, data, offsets in textops.pieces(batch.column("text")):
                found = runs(data, offsets, length, gram)
                if found:
                    some = in_bitmap(seen, found[0])
                    a, u, lo, hi, _ = (x[some] for x in found)
                    row = np.searchsorted(offsets, lo, "right") - 1
                    take = pa.array(at + row)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(u), *(batch.column(c).take(take) for c in key), pa.array(lo - offsets[row], pa.int32()), pa.array(hi - lo + 1, pa.int32())], ["a", "u", *key, "lo", "n"])

    every = docs.mapInArrow(occurrences, f"a long, u long, {keyed}, lo int, n int")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in textops.pieces(batch.column("text")):
                found = runs(data, offsets, length, gram)
                if not found:
                    continue
                a, u, lo, hi, x = found
                some = np.flatnonzero(in_bitmap(wanted, a))
                _, first, many = np.unique(np.stack([a[some], u[some]], 1), axis=0, return_index=True, return_counts=True)
                some = some[first]
                body = pa.array([data[p:q].tobytes() for p, q in zip(lo[some], hi[some] + length, strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(a[some]), pa.array(u[some]), pa.array(many, pa.int64()), pa.array(x[some] - lo[some], pa.int32()), body], ["a", "u", "c", "rel", "body"])

    bodies = docs.select("text").mapInArrow(contexts, "a long, u long, c long, rel int, body binary").join(opened, "a").select("a", "u", "c", "rel", "body", "names")
    found_type = "a long, u long, ranges array<struct<first: int, last: int>>"

    def settle(t: pa.Table) -> Iterator[pa.RecordBatch]:
        """The repeated suffixes of the names that occur once, of whole buckets."""
        a, u, c = (t.column(k).to_numpy() for k in ("a", "u", "c"))
        _, first, each = np.unique(np.stack([a, u], 1), axis=0, return_index=True, return_inverse=True)
        once = np.bincount(each.reshape(-1), c) == 1
        a, u, rel = a[first], u[first], t.column("rel").to_numpy()[first].astype(np.int64)
        bodies = t.column("body").take(pa.array(first)).to_pylist()
        again = repeated_places(a, bodies, rel, length, gram) & once[:, None]
        # distances fall as places rise
        edge = np.diff(np.pad(again[:, ::-1].astype(np.int8), ((0, 0), (1, 1))), axis=1)
        far = again.shape[1] - 1
        row, begin = np.nonzero(edge == 1)
        _, end = np.nonzero(edge == -1)
        if len(row):
            lo, hi = rel[row] - (far - begin), rel[row] - (far - end + 1)
            uniq, at = np.unique(row, return_index=True)
            ranges = pa.StructArray.from_arrays([pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], ["first", "last"])
            yield pa.RecordBatch.from_arrays([pa.array(a[uniq]), pa.array(u[uniq]), pa.ListArray.from_arrays(pa.array(np.r_[at, len(row)], pa.int32()), ranges)], ["a", "u", "ranges"])

    def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                held.append(part)
                size += part.nbytes
                if size < 1 << 20:
                    continue
                t = pa.Table.from_batches(held).combine_chunks()
                a = t.column("a").to_numpy()
                cut = int(np.searchsorted(a, a[-1]))  # the last bucket may go on in the next batch
                if cut:
                    yield from settle(t.slice(0, cut))
                held = t.slice(cut).to_batches()
                size = sum(b.nbytes for b in held) if cut else 0
        if held:
            yield from settle(pa.Table.from_batches(held).combine_chunks())

    cool = bodies.where(f"names <= {hot}").repartition("a").sortWithinPartitions("a").mapInArrow(by_bucket, found_type)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every suffix of the rows' runs with a hash of its bucket, distance and bytes."""
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                text = part.column("body").cast(pa.large_binary())
                offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
                data = np.frombuffer(text.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
                offsets = offsets - offsets[0]
                many = np.diff(offsets) - length + 1
                row = np.repeat(np.arange(len(text)), many)
                place = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                start = offsets[row] + place
                h = textops.Rolling(data).of(start, start + length)
                distance = part.column("rel").to_numpy()[row] - place
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([part.column("a").take(take), part.column("u").take(take), pa.array(place, pa.int32()), pa.array(distance, pa.int32()), pa.array(h.view(np.int64))], ["a", "u", "place", "d", "h"])

    apart = bodies.where(f"names > {hot}").mapInArrow(dealt, "a long, u long, place int, d int, h long")
    counted = apart.groupBy("a", "d", "h").agg(F.min("u").alias("u1"), F.max("u").alias("u2")).where("u1 <> u2").select("a", "d", "h")
    single = names.where("c = 1").join(opened.where(f"names > {hot}").select("a"), "a").select("a", "u")
    # at most LENGTH places of one run, merged into ranges
    places = apart.join(single, ["a", "u"]).join(counted, ["a", "d", "h"]).groupBy("a", "u").agg(F.array_sort(F.collect_set("place")).alias("p"))
    ends = places.selectExpr("a", "u", "filter(p, x -> not array_contains(p, x - 1)) as first", "filter(p, x -> not array_contains(p, x + 1)) as last")
    warm = ends.select("a", "u", F.arrays_zip("first", "last").alias("ranges"))

    whole = names.where("c > 1").select("a", "u", F.expr("cast(null as array<struct<first: int, last: int>>)").alias("ranges"))
    told = every.join(whole.union(cool).union(warm) if n_hot else whole.union(cool), ["a", "u"])
    ranges = F.coalesce("ranges", F.array(F.struct(F.lit(0).alias("first"), (F.col("n") - 1).alias("last"))))
    parts = told.select(*key, "lo", F.explode(ranges).alias("r")).select(*key, (F.col("lo") + F.col("r.first")).alias("first"), (F.col("lo") + F.col("r.last")).alias("last"))
    return parts.groupBy(*key).agg(F.collect_list(F.struct("first", "last")).alias("starts"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """docs (any columns) with kept (binary: the bytes that stay) and spans (array<struct<start, end>>: the bytes removed)."""
    own = [c for c in docs.columns if c not in ("text", "kept", "spans")]
    th, size, starts_of = helper(docs, "th"), helper(docs, "size"), helper(docs, "starts")
    keyed = docs.drop("kept", "spans").withColumn("text", F.coalesce("text", F.lit(""))).withColumns({th: F.xxhash64("text"), size: F.octet_length("text")})
    starts = repeated_starts(keyed.select(F.col("doc_id").alias("k0"), F.col(th).alias("k1"), F.col(size).alias("k2"), "text"), ["k0", "k1", "k2"], length, gram, hot)
    starts = starts.select(*(F.col(f"k{i}").alias(helper(docs, f"k{i}")) for i in range(3)), F.col("starts").alias(starts_of))
    same = [F.col(th) == F.col(helper(docs, "k1")), F.col(size) == F.col(helper(docs, "k2")), F.col("doc_id").eqNullSafe(F.col(helper(docs, "k0")))]
    joined = keyed.join(starts, same, "left")
    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in own), "text string, kept binary, spans array<struct<start: int, end: int>>"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, spans = [], []
            for text, starts in zip(batch.column("text"), batch.column(starts_of), strict=True):
                data = text.as_buffer().to_pybytes()
                if not starts.is_valid:
                    kept.append(data)
                    spans.append([])
                    continue
                first = np.sort(starts.values.field("first").to_numpy())
                last = np.sort(starts.values.field("last").to_numpy()) + length
                # sorted apart, starts and ends still bound the same union
                new = np.r_[True, first[1:] > last[:-1]]
                begin, end = first[new], last[np.r_[np.flatnonzero(new)[1:] - 1, len(last) - 1]]
                raw, at, left = memoryview(data), 0, []
                for b, e in zip(begin.tolist(), end.tolist(), strict=True):
                    left.append(raw[at:b])
                    at = e
                left.append(raw[at:])
                kept.append(b"".join(left))
                spans.append([{"start": b, "end": e} for b, e in zip(begin.tolist(), end.tolist(), strict=True)])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            cols = [batch.column(c) for c in own]
            yield pa.RecordBatch.from_arrays([*cols, batch.column("text"), pa.array(kept, pa.binary()), pa.array(spans, kind)], [*own, "text", "kept", "spans"])

    return joined.select(*(F.col(f"`{c}`") for c in own), "text", starts_of).mapInArrow(cut, schema)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    size = F.octet_length("text").cast("long")
    return done.select("doc_id", size.alias("n_bytes"), (size - F.octet_length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
