"""Conversation repair against a plain search over edit strings, on odd rows and on the query's own table."""

import collections
import functools
import hashlib
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from evalspark.llm import conversation_repair
from evalspark.llm.conversation_repair import Costs

SF = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string"


def plain(rows, costs=Costs()):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines) of [(turn, role, text)]: all edit strings in order of (cost, letters)."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, r, x in rows:
        rest = x.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not rest else "duplicate" if (r, x) in seen else "truncated" if rest[-1] not in ".!?" else "")
        seen.add((r, x))
    turns = {t for t, _, _ in rows if t is not None}

    @functools.cache
    def best(i, tail, inserts):
        """Least (cost, letters, lines) from row i on; tail: the initials so far, as far as they matter."""
        found = []
        good = lambda roles: roles in ("s", "u", "su", "ua", "au")
        if i == len(rows) and (tail == "" or tail[-1] == "a"):
            found.append((0, "", ()))
        if inserts < 2:
            for role in ("user", "assistant"):
                if good(tail + role[0]):
                    c, a, lines = best(i, (tail + role[0])[-1], inserts + 1)
                    found.append((c + costs.insert, "I" + a, (role + ":", *lines)))
        if i < len(rows):
            _, r, x = rows[i]
            c, a, lines = best(i + 1, tail, 0)
            found.append((c + costs.delete, "D" + a, lines))
            if faults[i] not in ("blank", "duplicate"):
                for letter, role, extra in (("K", r, 0), ("R", "user", costs.rerole), ("R", "assistant", costs.rerole)):
                    if role and role[0] in "sua" and good(tail + role[0]):
                        c, a, lines = best(i + 1, (tail + role[0])[-1], 0)
                        found.append((c + extra + costs.truncated * (faults[i] == "truncated"), letter + a, (f"{role}:{x}", *lines)))
        return min(found, default=(1 << 50, "", ()))

    cost, audit, lines = best(0, "", 0)
    n = collections.Counter(faults)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, lines)


def digest(lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def check(df, given, costs=Costs()):
    by = collections.defaultdict(list)
    for c, *rest in given:
        by[c].append(tuple(rest))
    want = {c: (*(p := plain(r, costs))[:7], digest(p[7])) for c, r in by.items()}
    got = {r.conv_id: tuple(r)[1:] for r in conversation_repair.report(df, costs=costs).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()}
    assert got == want
    lines = collections.defaultdict(list)
    for r in sorted(conversation_repair.repair(df, costs=costs).collect(), key=lambda r: r.place):
        lines[r.conv_id].append(f"{r.role}:{r.text}")
        assert (r.edit == "I") <= (r.turn is None and r.text == "")
    assert dict(lines) == {c: list(p) for c, r in by.items() if (p := plain(r, costs)[7])}


def made(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Why? ", "cut", "cut,\n", "", " \t", None, "é…", "Long. " * 50, "z?"]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "uncle", "User"]
    out = []
    for c in range(convs):
        n = rng.randrange(longest + 1)
        turns = [rng.choice([None, *range(6)]) for _ in range(n)] if c % 3 == 0 else range(0, 2 * n, 1 + c % 2)
        out += [(c if c else None, t, rng.choice(roles), rng.choice(texts)) for t in turns]
    return out


@pytest.mark.parametrize("costs", [Costs(), Costs(rerole=4, delete=9, insert=2, truncated=1), Costs(rerole=2, delete=2, insert=1, truncated=2)])
def test_least_edits_by_brute_force(spark, costs):
    rows = made(1, 60, 9)
    check(spark.createDataFrame(rows, ROWS), rows, costs)


def test_state_goes_on_over_batches(spark):
    """Conversations longer than an Arrow batch, and many in one."""
    rows = [(7, t, "user" if t % 3 else "assistant", f"{t % 41}.") for t in range(120)] + made(2, 30, 6)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        check(spark.createDataFrame(rows, ROWS), rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_one_conversation_of_many_rows(spark):
    n = 200_000
    df = spark.range(n).select(F.lit(3).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"))
    df = df.withColumn("role", F.when(F.col("turn") == n // 2, F.lit("assistant")).otherwise(F.col("role")))
    got = conversation_repair.report(df).first()
    assert (got.gaps, got.illegal, got.cost) == (0, 2, 1)
    assert got.audit == "K" * (n // 2) + "R" + "K" * (n - n // 2 - 1)
    assert got.repaired_sha256 == digest([f"{'assistant' if i % 2 else 'user'}:{i}." for i in range(n)])


def test_empty_table_and_clashing_columns(spark):
    assert conversation_repair.report(spark.createDataFrame([], ROWS)).count() == 0
    rows = [(1, 0, "user", "a."), (1, 1, "assistant", "b.")]
    df = spark.createDataFrame(rows, ROWS)
    for c in ("conv", "t", "alive", "copy", "fault", "letters", "cost", "kind", "n", "TURNS"):
        df = df.withColumn(c, F.lit(None).cast("int"))
    check(df, rows)
    assert [r.audit for r in conversation_repair.report(conversation_repair.damage(df), alive=F.col("alive")).collect()]


def test_query_by_brute_force(spark):
    """The query itself: the same damage and the same repair, in plain Python, over all conversations of the smallest table."""
    by, all_ids = collections.defaultdict(list), set()
    for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist():
        c, t, role, text = r["conv_id"], r["turn"], r["role"] or " ", " " if r["text"] is None else r["text"]
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        all_ids.add(c)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[c] += [(t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    want = {c: (*(p := plain(by[c]))[:7], digest(p[7])) for c in all_ids}
    got = {r.conv_id: tuple(r)[1:] for r in conversation_repair.op11_conversation_repair(spark, SF).collect()}
    assert got == want and {w[6] for w in want.values()} - {"", "KK"}


def test_lost_conversations_are_reported(spark):
    df = spark.createDataFrame([(1, 0, "user", "a."), (2, 5, None, None), (2, 9, "user", None)], ROWS)
    got = {r.conv_id: tuple(r)[1:] for r in conversation_repair.report(df, alive=F.col("conv_id") == 1).collect()}
    assert got == {1: (0, 0, 0, 0, 0, 2, "D", digest([])), 2: (0, 0, 0, 0, 0, 0, "", digest([]))}
