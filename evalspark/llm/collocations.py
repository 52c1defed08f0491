"""Phrase collocation mining: exact counts of all frequent phrases, with bounded memory in every task.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words at spaces and tabs. Everything
is per language. The frequent phrases of up to ``longest`` words are found in passes over all texts:

1. Misra-Gries. Every n-gram has a 48-bit code; codes are dealt by range to hash partitions. A task adds up what it reads and
   sends a sorted block of codes and counts to each partition; a code that a task alone has seen often enough is sure, and
   leaves the mass. Each partition adds its blocks to one summary of fewer counters than n-grams. With N for the partition's
   mass, it holds floor(N / threshold) + 1 counters: what all counters lose together is then less than the threshold, so every
   n-gram with at least ``threshold`` occurrences keeps a counter above zero. Summaries are mergeable: should Spark split a
   partition in two, no frequent n-gram loses its counter in both. This runs for words, then for pairs of words that may be
   frequent, then for longer n-grams made of such pairs only.
2. Exact counts. What survives goes into a bitmap of fixed size; the blocks are read again, thinned by it and added up exactly
   by code in each partition. Codes below the threshold go; the rest make the bitmaps by which the next rounds and the last
   pass choose. Codes that fall together, or a bitmap that fills up, let more through and lose nothing. In the last pass the
   n-grams that are let through are counted by their texts, added up in tasks, sent as blocks to hash partitions and added up
   there, and those below go.

Edge cases: a null or empty text has no words; a null language is ``und``. Repeated rows count as often as they come. Equal
scores are ordered by count, then by the phrase's bytes. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import collections
import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textops
from .jaccard_join import _packed, _unpacked
from .shared import bitmap, bits_for, in_bitmap, materialize, table

CODE_BITS = 48
PART_MASS = 1 << 24  # occurrences in a hash partition, as the size of the texts foretells them
FLUSH = 1 << 21  # codes that a task gathers before it adds them up and sends them
HELD = 400_000  # phrases that a task counts before it sends them
BREAKS, GAPS = np.zeros(256, bool), np.zeros(256, bool)
BREAKS[list(b".,;:!?\n\x0b\x0c\r")] = True
GAPS[list(b" \t")] = True
GAPS |= BREAKS


class Words:
    """The words of a stretch of texts: where they lie, how many of a piece follow, and hashes of n-grams."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        self.data = textops.LOWER[data]
        self.start, self.end, row = textops.spans(~GAPS[self.data], offsets)
        n = len(self.start)
        piece = np.cumsum(BREAKS[self.data])[self.start] if n else self.start
        last = np.flatnonzero(np.append((row[1:] != row[:-1]) | (piece[1:] != piece[:-1]), True)) if n else row
        self.reach = last[np.searchsorted(last, np.arange(n))] - np.arange(n) + 1 if n else row
        self.row, self.lang = row, langs[row]
        self.hash = textops.Rolling(self.data).of(self.start, self.end)

    def grams(self, k: int, at: np.ndarray, seed: int = 0) -> np.ndarray:
        """64-bit hashes of the k words from each place in ``at``, in their language."""
        made = self.lang[at] * np.uint64(2 * seed + 1) + np.uint64(k)
        for j in range(k):
            made = made + self.hash[at + j] * textops._STEP[5 * seed + j]
        return textops.mix(textops.mix(made))

    def codes(self, k: int, at: np.ndarray) -> np.ndarray:
        return (self.grams(k, at) >> np.uint64(64 - CODE_BITS)).astype(np.int64)

    def places(self, k: int) -> np.ndarray:
        return np.flatnonzero(self.reach >= k)

    def made_of(self, k: int, n: int, known: np.ndarray) -> np.ndarray:
        """Places of k words of one piece of which all runs of n are ``known`` (by place)."""
        at = self.places(k)
        for j in range(k - n + 1):
            at = at[known[at + j]]
        return at


def _known(words: Words, n: int, at: np.ndarray, bits: np.ndarray) -> np.ndarray:
    out = np.zeros(len(words.start), bool)
    out[at[in_bitmap(bits, words.codes(n, at))]] = True
    return out


def _places(words: Words, ks: range, maps: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(k, places) of the n-grams of each length in ``ks`` whose parts passed the earlier rounds."""
    if not maps:
        yield 1, words.places(1)
        return
    known = _known(words, 1, words.places(1), maps[0])
    pairs = words.made_of(2, 1, known)
    if len(maps) > 1:
        known = _known(words, 2, pairs, maps[1])
    for k in ks:
        yield k, pairs if len(maps) == 1 else words.made_of(k, 2, known)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Words, list[str]]]:
    """Words of pieces of (lang, text) batches. The languages of a batch come as hashes by row, and as a list by place."""
    for batch in batches:
        names = batch.column(0).to_pylist()
        hashes = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in set(names)}
        for a, b, data, offsets in textops.pieces(batch.column(1)):
            yield Words(data, offsets, np.array([hashes[x] for x in names[a:b]], np.uint64)), names[a:b]


def _added(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(codes, return_inverse=True)
    return found, np.bincount(where, counts, len(found)).astype(np.int64)


BLOCKS = "part int, sure boolean, mass long, block binary"


def _blocks(ks: range, maps: list, parts: int, threshold: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [m.value for m in maps]
        held, size = [], 0

        def send() -> pa.RecordBatch:
            codes, counts = np.unique(np.concatenate(held), return_counts=True)
            rows = []
            for sure in (False, True):
                mine = (counts >= threshold) == sure
                c, n = codes[mine], counts[mine]
                part = (c * parts) >> CODE_BITS if parts < 1 << 15 else np.array([int(x) * parts >> CODE_BITS for x in c.tolist()], np.int64)
                first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(c) else part
                for a, b in zip(first, np.append(first, len(c))[1:], strict=True):
                    rows.append((int(part[a]), sure, int(n[a:b].sum()), _packed(np.diff(c[a:b], prepend=0), n[a:b])))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int32(), pa.bool_(), pa.int64(), pa.binary()), strict=True)], ["part", "sure", "mass", "block"])

        for words, _ in _read(batches):
            for k, at in _places(words, ks, bits):
                held.append(words.codes(k, at))
                size += len(at)
            if size >= FLUSH:
                yield send()
                size = 0
        if size:
            yield send()

    return run


def reduced(codes: np.ndarray, counts: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """A summary of ``room`` counters at most: all lose what the first that has no room holds."""
    if len(codes) <= room:
        return codes, counts
    most = np.partition(counts, len(counts) - room - 1)[len(counts) - room - 1]
    stay = counts > most
    return codes[stay], counts[stay] - most


def _summaries(threshold: int) -> Callable:
    """Misra-Gries over the blocks of each partition, which come one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, room = None, 0
        codes = counts = np.zeros(0, np.int64)
        waiting, size, sure = [], 0, []

        def settle() -> None:
            nonlocal codes, counts, size
            codes, counts = reduced(*_added(np.concatenate([codes, *(c for c, _ in waiting)]), np.concatenate([counts, *(n for _, n in waiting)])), room)
            waiting.clear()
            size = 0

        def out() -> pa.RecordBatch:
            settle()
            found = np.unique(np.concatenate([codes, *sure]))
            sure.clear()
            return pa.RecordBatch.from_arrays([pa.array(found)], ["code"])

        for batch in batches:
            for part, is_sure, total, block in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if part != now:
                    if now is not None:
                        yield out()
                    now, room = part, (total or 0) // threshold + 1
                    codes = counts = np.zeros(0, np.int64)
                deltas, n = _unpacked(block)
                if is_sure:
                    sure.append(np.cumsum(deltas))
                    if len(sure) > 64:
                        sure[:] = [np.unique(np.concatenate(sure))]
                else:
                    waiting.append((np.cumsum(deltas), n))
                    size += len(n)
                    if size > max(room, 1 << 16):
                        settle()
        if now is not None:
            yield out()

    return run


def _thinned(survivors: Broadcast) -> Callable:
    """Blocks without the codes that did not survive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = survivors.value
        for batch in batches:
            parts, blocks = [], []
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                deltas, n = _unpacked(block)
                codes = np.cumsum(deltas)
                stay = in_bitmap(bits, codes)
                if stay.any():
                    parts.append(part)
                    blocks.append(_packed(np.diff(codes[stay], prepend=0), n[stay]))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blocks, pa.binary())], ["part", "block"])

    return run


def _totals(threshold: int) -> Callable:
    """The codes of each partition whose counts add up to the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, size = None, [], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            return _added(np.concatenate([c for c, _ in waiting]), np.concatenate([n for _, n in waiting]))

        def out() -> pa.RecordBatch:
            codes, counts = added()
            return pa.RecordBatch.from_arrays([pa.array(codes[counts >= threshold])], ["code"])

        for batch in batches:
            for part, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part != now:
                    if waiting:
                        yield out()
                    now, waiting, size = part, [], 0
                deltas, n = _unpacked(block)
                waiting.append((np.cumsum(deltas), n))
                size += len(n)
                if size > 1 << 20 and size > 2 * len(waiting[0][0]):
                    waiting = [added()]
                    size = len(waiting[0][0])
        if waiting:
            yield out()

    return run


def _survivors(blocks: DataFrame, threshold: int) -> DataFrame:
    """(code): the codes of all n-grams of ``blocks`` that may have ``threshold`` occurrences, and of some others."""
    mass = blocks.where(~F.col("sure")).groupBy("part").agg(F.sum("mass").alias("total"))
    dealt = blocks.repartition("part").join(mass, "part", "left").select("part", "sure", "total", "block").sortWithinPartitions("part")
    return materialize(dealt.mapInArrow(_summaries(threshold), "code long"), "survivors")


def _bits(codes: DataFrame) -> Broadcast:
    return codes.sparkSession.sparkContext.broadcast(bitmap(codes, "code", bits_for(4 * codes.count())))


def _frequent(texts: DataFrame, ks: range, maps: list, parts: int, threshold: int) -> DataFrame:
    """(code): a table of the codes of these lengths with ``threshold`` occurrences or more."""
    blocks = materialize(texts.mapInArrow(_blocks(ks, maps, parts, threshold), BLOCKS), "blocks")
    thin = blocks.select("part", "block").mapInArrow(_thinned(_bits(_survivors(blocks, threshold))), "part int, block binary")
    return materialize(thin.repartition("part").sortWithinPartitions("part").mapInArrow(_totals(threshold), "code long"), "frequent")


COUNTS = "lang string, words int, phrase string, n long"
SENT = "part int, lang array<string>, words array<int>, phrase array<string>, n array<long>"


def _counts(longest: int, maps: list, parts: int) -> Callable:
    """Exact counts of the phrases that the bitmaps let through, as a block for each hash partition; under no words, how many
    words there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [m.value for m in maps]
        held: dict[tuple[str, int, bytes], int] = {}

        def send() -> pa.RecordBatch:
            rows: dict[int, list] = {}
            for (lang, k, phrase), n in held.items():
                rows.setdefault(zlib.crc32(phrase) * parts >> 32, []).append((lang, k, phrase.decode(), n))
            held.clear()
            blocks = [(part, *map(list, zip(*some, strict=True))) for part, some in rows.items()]
            types = (pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*blocks, strict=True), types, strict=True)], ["part", "lang", "words", "phrase", "n"])

        for words, names in _read(batches):
            if not len(words.start):
                continue
            raw, start, end = words.data.tobytes(), words.start.tolist(), words.end.tolist()
            hashes, first, n = np.unique(words.lang, return_index=True, return_counts=True)
            name = {h: names[words.row[i]] for h, i in zip(hashes.tolist(), first.tolist(), strict=True)}
            for h, c in zip(hashes.tolist(), n.tolist(), strict=True):
                held[name[h], 0, b""] = held.get((name[h], 0, b""), 0) + c
            plain = np.append((words.start[1:] - words.end[:-1] == 1) & (words.data[words.end[:-1]] == 32), False)
            for k, at in _all_places(words, longest, bits):
                a, b = words.grams(k, at), words.grams(k, at, 1)
                _, first, where, n = np.unique(a, return_index=True, return_inverse=True, return_counts=True)
                if (b != b[first][where]).any():  # two phrases share 64 bits: tell them apart by 128
                    _, first, n = np.unique(np.stack([a, b], 1), axis=0, return_index=True, return_counts=True)
                lang = words.lang[at[first]].tolist()
                for h, i, c in zip(lang, at[first].tolist(), n.tolist(), strict=True):
                    phrase = raw[start[i] : end[i + k - 1]] if plain[i : i + k - 1].all() else b" ".join(raw[start[j] : end[j]] for j in range(i, i + k))
                    key = name[h], k, phrase
                    held[key] = held.get(key, 0) + c
            if len(held) > HELD:
                yield send()
        if held:
            yield send()

    return run


def _merged(threshold: int) -> Callable:
    """The phrases of each partition whose counts add up to the threshold, and all counts of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: int | None = None
        held: collections.Counter = collections.Counter()

        def out() -> pa.RecordBatch:
            rows = [(*key, n) for key, n in held.items() if n >= threshold or key[1] == 0]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string(), pa.int64()))], ["lang", "words", "phrase", "n"])

        for batch in batches:
            for i, part in enumerate(batch.column(0).to_pylist()):
                if part != now:
                    if held:
                        yield out()
                    now = part
                for *key, n in zip(*(batch.column(c)[i].as_py() for c in range(1, 5)), strict=True):
                    held[tuple(key)] += n
        if held:
            yield out()

    return run


def _all_places(words: Words, longest: int, bits: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    one = _known(words, 1, words.places(1), bits[0])
    yield 1, np.flatnonzero(one)
    two = _known(words, 2, words.made_of(2, 1, one), bits[1])
    yield 2, np.flatnonzero(two)
    for k in range(3, longest + 1):
        at = words.made_of(k, 2, two)
        yield k, at[in_bitmap(bits[2], words.codes(k, at))]


def frequent_phrases(docs: DataFrame, threshold: int = 100, longest: int = 5) -> DataFrame:
    """(lang, words, phrase, n): every phrase of one to ``longest`` words with ``threshold`` occurrences or more, counted
    exactly; and for each language a row of no words that has the number of all its words."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")).cast("long")).first()[0] or 0
    parts = max(16, size // (5 * PART_MASS))
    maps: list = []
    for ks in (range(1, 2), range(2, 3), range(3, longest + 1)):
        maps.append(_bits(_frequent(texts, ks, maps, parts, threshold)))
    counted = texts.mapInArrow(_counts(longest, maps, parts), SENT).repartition("part").sortWithinPartitions("part")
    return materialize(counted.mapInArrow(_merged(threshold), COUNTS), "phrases")


def collocations(docs: DataFrame, threshold: int = 100, longest: int = 5, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by their weakest cut into two parts.

    The score of a cut is floor(1000 * a * n / (l * r)), in decimals of 38 digits; the first of the lowest cuts counts. A
    phrase that stands in a longer candidate as often as anywhere is dropped (one word longer is enough to look at, as what
    lies between the two is as frequent).
    """
    found = frequent_phrases(docs, threshold, longest)
    phrases = found.where("words > 0").select("lang", "words", "phrase", F.col("n").alias("a"))
    totals = found.where("words = 0").select("lang", "n")
    long = phrases.where("words > 1")
    shorter = F.explode(F.array(F.expr("substring(phrase, locate(' ', phrase) + 1)"), F.expr("substring_index(phrase, ' ', words - 1)")))
    inside = long.where("words > 2").select("lang", shorter.alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("within"))
    kept = long.join(inside, ["lang", "phrase"], "left").where("within is null or 100 * within < 100 * a").drop("within")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    parts = cuts.select("lang", "phrase", "words", "a", "k", F.explode(F.map_from_arrays(F.array(F.lit("l"), F.lit("r")), F.array(F.expr("substring_index(phrase, ' ', k)"), F.expr("substring_index(phrase, ' ', k - words)")))).alias("side", "part"))
    sizes = parts.join(phrases.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f")), ["lang", "part"])
    # a language may hold most phrases: its total goes to each of several shares of them
    salts = max(8, found.count() // 200_000)
    salt = F.pmod(F.xxhash64("phrase"), F.lit(salts)).cast("int").alias("salt")
    totals = totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    cut = sizes.groupBy("lang", "phrase", "words", "a", "k").agg(*(F.max(F.when(F.col("side") == s, F.col("f"))).alias(s) for s in ("l", "r"))).select("*", salt).join(totals, ["lang", "salt"])
    exact = F.expr("(cast(1000 as decimal(38, 0)) * cast(a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    scored = cut.groupBy("lang", "phrase", "a", "n", "salt").agg(F.min(F.struct(exact.cast("long").alias("score"), "k", "l", "r")).alias("low"))
    rows = scored.select("lang", "salt", "phrase", "a", "low.l", "low.r", "n", "low.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of a large language are among the first of its shares, which no single task has to sort whole
    share = Window.partitionBy("lang", "salt").orderBy(*order)
    first = rows.withColumn("near", F.row_number().over(share)).where(F.col("near") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
words as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
totals as (select lang, sum(len(ws))::bigint as n from words group by lang),
grams as (
  select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) as phrase
  from words, range(1, 6) as t(k) where len(ws) >= k),
frequent as (select lang, k, phrase, count(*) as f from grams group by all having count(*) >= 100),
cuts as (
  select lang, k, phrase, f as a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') as one, array_to_string(string_split(phrase, ' ')[j + 1:], ' ') as two
  from frequent, range(1, 5) as t(j) where j < k),
scored as (
  select c.lang, c.k, c.phrase, c.a, x.f as l, y.f as r, n, j, ((1000::hugeint * a * n) // (x.f::hugeint * y.f))::bigint as score
  from cuts c join frequent x on x.lang = c.lang and x.phrase = c.one join frequent y on y.lang = c.lang and y.phrase = c.two join totals t on t.lang = c.lang),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, j) = 1),
kept as (
  select * from lowest c where not exists (
    select 1 from frequent x where x.lang = c.lang and x.k > c.k and 100 * x.f >= 100 * c.a and contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' ')))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept qualify rank <= 2000
"""
