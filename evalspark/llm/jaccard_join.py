"""N-gram Jaccard join: grouped prefix join over whole texts, with connected components as the result.

Documents with the same shingle set are one class; classes with the same size and the same prefix are one group.
Group pairs that share a prefix shingle pass the size and position filters, then their members are verified on whole sets.

Shingles are ordered by how many sets have them, counted exactly over all documents, so prefixes hold the rarest. A shingle
that no other set has leads nowhere; it takes its place in the prefix and goes no further. Most documents have enough
of these to fill their prefix, and meet nothing at all. For counting, the shingles of a chunk of documents travel as sorted
blocks, in a few bytes each, to the range of hashes that they fall into.

A third of all rows may be near copies of each other: so each group first meets only one leader for each of its shingles,
and a second, exact round compares only what is not yet connected. Pairs are verified in blocks of at most
``BLOCK_PAIRS`` that share one document, whose text travels once for each block; the other text travels once for each pair.

Edge cases: a null or empty text, or one of white space, has no shingles, links with nothing and keeps its own doc_id
as component. Fewer words than ``n`` make one shingle. Repeated rows come back as often as they came. A null doc_id
takes part; it never becomes a component_id unless its whole component has none. Ties go to the smaller doc_id. Other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textops
from .graph import components
from .shared import bitmap, bits_for, helper, in_bitmap, materialize, table

BLOCK_PAIRS = 512
CODE_BITS = 40  # of a shingle's hash in counting and in prefixes; what shares a code by chance only makes a candidate more
CHUNK_TOKENS, CHUNK_DOCS = 1_000_000, 50_000  # of a chunk of documents whose shingles are sorted together
SEVERAL = 1 << 40  # in place of a document, for a code that several of a chunk have


def _packed(*arrays: np.ndarray) -> bytes:
    """Whole numbers below 2**48 as planes of bytes, so that planes of zeros compress away."""
    head = np.array([len(arrays), *map(len, arrays)], np.int64).tobytes()
    return head + b"".join(np.ascontiguousarray(a.astype(np.uint64).view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes() for a in arrays)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    many = int(np.frombuffer(blob, np.int64, 1)[0])
    out, at = [], 8 * (many + 1)
    for n in np.frombuffer(blob, np.int64, many, 8).tolist():
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = np.frombuffer(blob, np.uint8, 6 * n, at).reshape(6, n).T
        out.append(wide.view(np.uint64).reshape(-1).astype(np.int64))
        at += 6 * n
    return out


def _chunks(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[int, list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """(chunk, digests, sizes, codes in order, document of each code): the different shingle sets of stretches of a partition."""
    number, docs, size, sets, cls, seen = TaskContext.get().partitionId() << 32, 0, 0, [], [], set()

    def done():
        sizes = np.array([len(s) for s in sets], np.int64)
        codes = np.concatenate([np.zeros(0, np.uint64), *sets]) >> np.uint64(64 - CODE_BITS)
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(codes, kind="stable")
        return number, cls, sizes, codes[order].astype(np.int64), owner[order]

    for batch in batches:
        for _, _, data, offsets in textops.pieces(batch.column(0)):
            for s in textops.shingle_sets(data, offsets, n):
                key = textops.digest(s)
                if len(s) and key not in seen:
                    seen.add(key)
                    sets.append(s)
                    cls.append(key)
                    docs, size = docs + 1, size + len(s)
            if size >= CHUNK_TOKENS or docs >= CHUNK_DOCS:
                yield done()
                number, docs, size, sets, cls, seen = number + 1, 0, 0, [], [], set()
    if sets:
        yield done()


def _repeats(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, how often) of each code of a sorted array."""
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][: len(codes)])
    return first, np.diff(np.r_[first, len(codes)])


def prefixes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(cls, size, alone, tokens): of every set the shingles of its prefix that others have too, rarest first.

    ``alone`` shingles of the prefix come before them, that no other set has. Sets whose prefix holds no others are left out.

    A chunk of documents sends each range of codes its sorted codes, with the document for one that it has once and with a
    count for one that it has more often, so a shingle of a third of all documents is one entry a chunk. The range counts
    and tells every chunk which of its codes occur elsewhere, and how often; there the prefixes are cut.
    """
    spark = docs.sparkSession
    ranges = 1 << max(8, min(16, (8 * int(spark.conf.get("spark.sql.shuffle.partitions"))).bit_length()))
    width = (1 << CODE_BITS) // ranges

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _, _, codes, owner in _chunks(batches, n):
            first, many = _repeats(codes)
            codes, owner = codes[first], np.where(many == 1, owner[first], SEVERAL)
            parts = codes // width
            cut = np.searchsorted(parts, np.arange(ranges + 1))
            some = np.flatnonzero(np.diff(cut))
            blobs = [_packed(np.diff(codes[a:b], prepend=codes[a]), codes[a : a + 1], owner[a:b], many[a:b] - 1) for a, b in zip(cut[some], cut[some + 1], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), chunk)), pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], ["chunk", "part", "blob"])

    def count(t: pa.Table) -> pa.Table:
        """For each chunk, its codes of one range that occur more than once, the document (or none) and how often they occur in all."""
        chunks = t.column("chunk").to_numpy()
        got = [_unpacked(b.as_py()) for b in t.column("blob")]
        codes = np.concatenate([np.cumsum(d) + base[0] for d, base, _, _ in got])
        sent = np.repeat(np.arange(len(got)), [len(d) for d, _, _, _ in got])
        owner, many = np.concatenate([x[2] for x in got]), np.concatenate([x[3] for x in got]) + 1
        order = np.argsort(codes, kind="stable")
        first, _ = _repeats(codes[order])
        total = np.add.reduceat(many[order], first) if len(first) else first
        each = np.empty(len(codes), np.int64)
        each[order] = np.repeat(total, np.diff(np.r_[first, len(codes)]))
        again = each > 1
        out = [np.flatnonzero(again & (sent == k)) for k in range(len(got))] if len(got) < 8 else np.split(np.flatnonzero(again), np.searchsorted(sent[again], np.arange(1, len(got))))
        blobs = [_packed(np.diff(codes[x], prepend=codes[x[0]]), codes[x[:1]], owner[x], each[x]) for x in out if len(x)]
        return pa.table({"chunk": pa.array([c for c, x in zip(chunks.tolist(), out, strict=True) if len(x)], pa.int64()), "blob": pa.array(blobs, pa.binary())})

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, cls, sizes, codes, owner in _chunks(batches, n):
            first, many = _repeats(codes)
            more = np.repeat(many > 1, many)
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([_packed(sizes, codes[more], owner[more])], pa.binary()), pa.array([b"".join(cls)], pa.binary())], ["chunk", "blob", "names"])

    def cut(answers: pa.Table, mine: pa.Table) -> pa.Table:
        names = mine.column("names")[0].as_py()
        sizes, many_codes, many_owner = _unpacked(mine.column("blob")[0].as_py())
        got = [_unpacked(b.as_py()) for b in answers.column("blob")]
        codes = np.concatenate([np.zeros(0, np.int64), *(np.cumsum(d) + base[0] for d, base, _, _ in got)])
        owner, total = (np.concatenate([np.zeros(0, np.int64), *(x[k] for x in got)]) for k in (2, 3))
        # codes that several documents of the chunk have: the total of each goes to all of them
        shared = owner == SEVERAL
        order = np.argsort(codes[shared])
        known, known_total = codes[shared][order], total[shared][order]
        codes = np.concatenate([codes[~shared], many_codes])
        owner = np.concatenate([owner[~shared], many_owner])
        total = np.concatenate([total[~shared], known_total[np.searchsorted(known, many_codes)] if len(known) else many_codes])
        order = np.lexsort((codes, total, owner))
        codes, owner = codes[order], owner[order]
        first, held = _repeats(owner)
        docs = owner[first]
        alone, length = sizes[docs] - held, sizes[docs] - -(-percent * sizes[docs] // 100) + 1
        take = np.minimum(np.maximum(length - alone, 0), held)
        at = np.flatnonzero(take)
        tokens = np.concatenate([np.zeros(0, np.int64), *(codes[a : a + k] for a, k in zip(first[at], take[at], strict=True))])
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(take[at])], pa.int32()), pa.array(tokens))
        cls = pa.array([names[16 * d : 16 * d + 16] for d in docs[at].tolist()], pa.binary())
        return pa.table({"cls": cls, "size": pa.array(sizes[docs[at]], pa.int32()), "alone": pa.array(alone[at], pa.int32()), "tokens": lists})

    text = docs.select("text")
    answers = text.mapInArrow(ask, "chunk long, part int, blob binary").groupBy("part").applyInArrow(count, "chunk long, blob binary")
    mine = text.mapInArrow(own, "chunk long, blob binary, names binary")
    found = answers.groupBy("chunk").cogroup(mine.groupBy("chunk")).applyInArrow(cut, "cls binary, size int, alone int, tokens array<long>")
    return found.dropDuplicates(["cls"])


def _signatures(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, th, size, cls): the size and digest of every row's set."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in textops.pieces(batch.column("text")):
                sets = textops.shingle_sets(data, offsets, n)
                made = [pa.array([len(s) for s in sets], pa.int32()), pa.array([textops.digest(s) for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), batch.column("th").slice(a, b - a), *made], ["doc_id", "th", "size", "cls"])

    return docs.mapInArrow(sign, "doc_id long, th long, size int, cls binary")


def _verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of class ids whose whole shingle sets are similar enough.

    One text of each class travels, and its shingles are made again where pairs meet: a set is larger than its text.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    need = materialize(classes.join(ids, "id").select("id", "cls", "th"), "need")
    wanted = bitmap(need, "th", bits_for(need.count()))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(wanted, batch.column("th").to_numpy(zero_copy_only=False))))
            seen = set()
            for a, b, data, offsets in textops.pieces(batch.column("text")):
                cls, take = [], []
                for i, s in enumerate(textops.shingle_sets(data, offsets, n)):
                    key = textops.digest(s)
                    if len(s) and key not in seen:
                        seen.add(key)
                        cls.append(key)
                        take.append(a + i)
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.binary()), batch.column("text").take(pa.array(take, pa.int64()))], ["cls", "text"])

    fetched = docs.select("th", "text").mapInArrow(fetch, "cls binary, text string").dropDuplicates(["cls"])
    texts = materialize(need.select("id", "cls").join(fetched, "cls").select("id", "text"), "texts")
    # b with many partners is dealt into blocks; each block gets its text once, before its partners
    blocks = pairs.groupBy("b").agg(F.ceil(F.count("*") / BLOCK_PAIRS).cast("int").alias("blocks"))
    dealt = pairs.join(blocks, "b").select("a", "b", F.pmod(F.xxhash64("a"), "blocks").cast("int").alias("block"))
    first = blocks.select("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")).join(texts.withColumnRenamed("id", "b"), "b").select("b", "block", F.lit(None).cast("long").alias("a"), "text")
    rest = dealt.join(texts.withColumnRenamed("id", "a"), "a").select("b", "block", "a", "text")
    rows = first.union(rest).repartition("b", "block").sortWithinPartitions("b", "block", F.col("a").asc_nulls_first())

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with_set = np.zeros(0, np.uint64)
        for batch in batches:
            a, b = batch.column("a"), batch.column("b").to_numpy(zero_copy_only=False)
            leads, ids = a.is_null().to_numpy(zero_copy_only=False), a.fill_null(0).to_numpy(zero_copy_only=False)
            good = []
            for at, _, data, offsets in textops.pieces(batch.column("text")):
                for i, s in enumerate(textops.shingle_sets(data, offsets, n), at):
                    if leads[i]:
                        with_set = s
                        continue
                    joint = np.sort(np.concatenate([s, with_set]), kind="stable")
                    same = int((joint[1:] == joint[:-1]).sum())
                    if 100 * same >= percent * (len(s) + len(with_set) - same):
                        good.append(i)
            good = np.array(good, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids[good]), pa.array(b[good])], ["a", "b"])

    return rows.mapInArrow(check, "a long, b long")


def _fits(a_size: str, a_pos: str, b_size: str, b_pos: str, percent: int) -> str:
    """Size and position filters: what both sets still have from their first shared prefix shingle on can suffice."""
    return (
        f"100 * least({a_size}, {b_size}) >= {percent} * greatest({a_size}, {b_size}) and "
        f"(100 + {percent}) * least({a_size} - {a_pos}, {b_size} - {b_pos}) >= {percent} * ({a_size} + {b_size})"
    )


def _signed(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Each row's size and class digest, and the classes with their component: (cls, id, low, comp)."""
    signed = materialize(_signatures(docs, n), "signed")
    rows = signed.where("size > 0")
    classes = materialize(rows.groupBy("cls", "size").agg(F.min("th").alias("th"), F.min("doc_id").alias("low")).withColumn("id", F.monotonically_increasing_id()), "classes")
    # a class with a shingle of its own in its prefix shares that prefix with no other
    grp = F.when(F.col("alone") > 0, F.col("id").cast("string")).otherwise(F.md5(F.to_json(F.struct("size", "tokens")).cast("binary")))
    cuts = materialize(prefixes(docs, n, percent).drop("size").join(classes.select("cls", "id", "size"), "cls").select("id", "size", "alone", "tokens", grp.alias("grp")), "prefixes")
    groups = cuts.groupBy("grp").agg(F.min("id").alias("gid"), F.count("*").alias("members"))
    members = materialize(cuts.select("id", "size", "grp").join(groups, "grp").select("id", "gid", "size"), "members")
    # a step of this width in size always covers the sizes that can still be similar, so two steps meet every partner
    step = F.floor(F.log(F.col("size").cast("double")) / F.lit(math.log(100 / percent) if percent < 100 else 1.0)).cast("int")
    leads = cuts.join(groups.select(F.col("gid").alias("id"), "members"), "id")
    tokens = leads.select(F.col("id").alias("gid"), "size", "members", step.alias("step"), "alone", F.posexplode("tokens").alias("at", "token")).withColumn("pos", F.col("alone") + F.col("at")).drop("alone", "at")
    # members of one group share the whole prefix, so its first shingle is enough for them to meet each other in round 2
    often = tokens.groupBy("token").agg(F.count("*").alias("n"), F.bool_or(F.expr("pos = 0 and members > 1")).alias("own")).where("n > 1 or own").select("token")
    shared = materialize(tokens.drop("members").join(often, "token"), "shared")

    # round 1: one leader a shingle and size step, the group that has fewest rarer shingles: among near copies the one
    # closest to their original. Every group meets, in its own and the next step, the two leaders it shares most with
    leaders = shared.groupBy("token", "step").agg(F.min(F.struct("pos", "gid", "size")).alias("lead"))
    met = (
        shared.withColumn("at", F.explode(F.array("step", F.col("step") + 1)))
        .join(leaders.withColumnRenamed("step", "at"), ["token", "at"])
        .where("gid <> lead.gid and " + _fits("size", "pos", "lead.size", "lead.pos", percent))
        .groupBy(F.col("gid").alias("a"), (F.col("at") - F.col("step")).alias("up"), F.col("lead.gid").alias("b"))
        .agg(F.count("*").alias("n"))
        .groupBy("a", "up")  # a prefix has no more leaders than shingles
        .agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "b"))), 1, 2).alias("best"))
        .select("a", F.explode("best.b").alias("b"))
    )
    pairs = materialize(met.union(members.where("id <> gid").select("id", "gid")).distinct(), "pairs")
    links = materialize(_verified(docs, pairs, classes, n, percent), "links")
    found = materialize(components(links, "a", "b"), "comp")

    # round 2, exact: whatever shares a prefix shingle and is not connected yet, first by component, then by member
    # the smaller set of a similar pair has its first shared shingle even earlier, within its index prefix
    index = F.expr(f"pos <= size - ceil(2 * {percent} * size / (100 + {percent}))")
    parts = materialize(
        shared.select("token", "gid", "pos").join(members.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("comp", "id")), "gid").withColumn("early", index),
        "parts",
    )
    ends = [F.min("size").alias("least"), F.max("size").alias("most"), F.max(F.col("size") - F.col("pos")).alias("room")]
    small = parts.where("early").groupBy("token", "comp").agg(*ends)
    large = parts.groupBy("token", F.col("comp").alias("comp2")).agg(*ends).withColumnsRenamed({"least": "least2", "most": "most2", "room": "room2"})
    meet = small.join(large, "token").where(f"comp <> comp2 and least <= most2 and 100 * most >= {percent} * least2 and (100 + {percent}) * least(room, room2) >= {percent} * (least + least2)").select("token", "comp", "comp2")
    left = parts.where("early").select("token", "comp", F.col("id").alias("a"), F.col("size").alias("size_a"), F.col("pos").alias("pos_a"))
    right = parts.select("token", F.col("comp").alias("comp2"), F.col("id").alias("b"), F.col("size").alias("size_b"), F.col("pos").alias("pos_b"))
    more = (
        meet.join(left, ["token", "comp"])
        .join(right, ["token", "comp2"])
        .where("size_a <= size_b and " + _fits("size_a", "pos_a", "size_b", "pos_b", percent))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    links = links.union(_verified(docs, materialize(more, "pairs"), classes, n, percent))
    found = components(links, "a", "b")
    part = classes.select("cls", "id", "low").join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    return signed.select("doc_id", "th", "size", "cls"), materialize(part, "part")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``; similar means 100 * |A & B| >= percent * |A | B|."""
    signed, part = _signed(docs.select("doc_id", "text", F.xxhash64("text").alias("th")), n, percent)
    named = part.join(part.groupBy("comp").agg(F.min("low").alias("component_id")), "comp").select("cls", "component_id")
    return (
        signed.where("size > 0").select("doc_id", F.col("size").cast("long").alias("n_shingles"), "cls")
        .join(named, "cls", "left")
        .select("doc_id", "n_shingles", "component_id")
        .union(signed.where("size = 0").select("doc_id", F.lit(0).cast("long"), "doc_id"))
    )


def deduplicate(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs (any columns) with one row of each component: the one of least doc_id (null last), then of least text hash.

    Rows without words all stay. Of equal rows one stays; rows that share a doc_id but have different texts are told apart.
    """
    th, is_null, by_id, verdict = (helper(docs, x) for x in ("th", "null", "id", "verdict"))
    signed, part = _signed(docs.select("doc_id", "text", F.xxhash64("text").alias("th")), n, percent)
    rows = signed.where("size > 0").groupBy("doc_id", "th", "cls").agg(F.count("*").alias("rows")).join(part.select("cls", "comp"), "cls")
    rows = materialize(rows.select("comp", F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "th").alias("key"), "rows"), "rows")
    first = rows.groupBy("comp").agg(F.min("key").alias("stays"))
    found = rows.join(first, "comp").select("key.*", F.when(F.col("key") != F.col("stays"), "goes").when(F.col("rows") > 1, "once").alias("verdict")).where("verdict is not null")
    found = materialize(found, "found")
    told = found.select(F.col("n").alias(is_null), F.coalesce("doc_id", F.lit(0)).alias(by_id), F.col("th").alias(helper(docs, "th2")), F.col("verdict").alias(verdict))
    keyed = docs.withColumns({th: F.xxhash64("text")})
    same = (F.col(th) == F.col(helper(docs, "th2"))) & (F.col("doc_id").isNull() == F.col(is_null)) & (F.coalesce("doc_id", F.lit(0)) == F.col(by_id))
    own = [F.col(f"`{c}`") for c in docs.columns]
    stays = keyed.join(told, same, "left").where(F.col(verdict).isNull()).select(*own)
    once = found.where("verdict = 'once'").limit(1).count()
    if not once:
        return stays
    again = keyed.join(told.where(F.col(verdict) == "once"), same).dropDuplicates(["doc_id", th]).select(*own)
    return stays.union(again)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)
