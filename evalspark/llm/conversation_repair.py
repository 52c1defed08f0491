"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate, row by row in order.

Rows are dealt out by conversation once. Within a partition they are sorted by turn, last first, and a pass over the Arrow
batches carries one small state: what it costs to finish from here, for each of the four places in ``s?(ua)+`` where one can
stand. It leaves one byte a row behind, the best edit for each place (two bits each). These bytes and the rows go through
Spark's own sort, which spills to disk, into the order of the turns; a second pass follows the bytes from the start, edits the
rows and adds up the report. Memory is bounded by a batch and, for the report, one letter a row of one conversation, whatever
a conversation's length; a lost executor's partition is computed again.

Going backwards makes ties easy: from a place, a letter leads to one next place only, so the least letter among the cheapest
at each step spells the least string of all.

Edits of a row: Keep, Rerole (to the role due: user or assistant), Delete; between rows: Insert a row of the role due, with an
empty text. Costs are parameters. A row's first fault counts: blank (no character but white space), duplicate (role and text
seen earlier in the conversation), truncated (the last such character is none of ``.!?``). Blank and duplicate rows are
deleted; a truncated row that stays adds a cost.

Edge cases: null turns come first; rows with the same turn are ordered by role, then text, by their bytes. A null role or text
is one space. Null conversation ids make one conversation. Repeated rows are duplicates. A conversation without rows (see
``alive``), or whose rows are all deleted, has an empty repair. Other columns are not read, whatever their names. An empty
table gives an empty result. All rows of one conversation pass through one task, in order, as the method says.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import table

SPACE = " \t\n\x0b\x0c\r"
LETTERS = "DIKR"  # in ASCII order; a letter is stored as its place here
D, I, K, R = range(4)
FINE, BLANK, DUPLICATE, TRUNCATED, ABSENT = range(5)
START, SYSTEM, USER, ASSISTANT = range(4)  # where one stands: nothing yet, or after a row of that role
OWN = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
DUE = (USER, USER, ASSISTANT, USER)  # the role that an inserted or renamed row gets, which is also the next place
NAMES = {USER: "user", ASSISTANT: "assistant"}
MAY_END = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}


@dataclass(frozen=True)
class Costs:
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5

    def __post_init__(self):
        if min(self.rerole, self.delete, self.insert) <= 0 or self.truncated < 0:
            raise ValueError("edits cost more than nothing")


class Backward:
    """Costs to finish and best letters, by place. Only differences matter from row to row, and there are few of them."""

    def __init__(self, costs: Costs):
        self.costs = costs
        self.end = self._with_inserts([(0, -1) if s in MAY_END else (1 << 40, -1) for s in range(4)])
        self.known: dict[tuple, tuple] = {}

    def _with_inserts(self, best: list[tuple[int, int]]) -> list[tuple[int, int]]:
        for _ in range(4):
            best = [min(b, (self.costs.insert + best[DUE[s]][0], I)) for s, b in enumerate(best)]
        return best

    def step(self, ahead: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
        """(costs to finish before this row, letters of the four places in one byte) from the costs to finish after it."""
        low = min(ahead)
        key = (tuple(a - low for a in ahead), initial if initial in OWN else "", fault)
        if key not in self.known:
            c, after, best = self.costs, key[0], []
            own = OWN.get(initial, {})
            for s in range(4):
                may = [(c.delete + after[s], D)]
                if fault not in (BLANK, DUPLICATE):
                    stays = c.truncated * (fault == TRUNCATED)
                    if s in own:
                        may.append((stays + after[own[s]], K))
                    may.append((c.rerole + stays + after[DUE[s]], R))
                best.append(min(may))
            best = self._with_inserts(best)
            self.known[key] = tuple(b[0] for b in best), sum(b[1] << 2 * s for s, b in enumerate(best))
        before, letters = self.known[key]
        return tuple(b + low for b in before), letters


def _choose(costs: Costs) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The pass from the last row to the first: adds the byte of letters and the cost of the whole from here."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = Backward(costs)
        end = tuple(b[0] for b in machine.end)
        conv, ahead = object(), end  # no conversation is equal to this one
        for batch in batches:
            letters, cost = [], []
            for c, initial, fault in zip(batch["conv"], batch["role"].str[:1], batch["fault"], strict=True):
                if c != conv:
                    conv, ahead = c, end
                byte = 0
                if fault != ABSENT:
                    ahead, byte = machine.step(ahead, initial, fault)
                letters.append(byte)
                cost.append(ahead[START])
            yield batch.assign(letters=pd.Series(letters, batch.index, "int32"), cost=pd.Series(cost, batch.index, "int64"))

    return run


class Report:
    """What is counted along one conversation."""

    def __init__(self, conv, cost: int):
        self.conv, self.cost = conv, cost
        self.first = self.last = None
        self.turns = self.illegal = 0
        self.faults = [0] * 5
        self.audit, self.sha, self.lines, self.before = bytearray(), hashlib.sha256(), 0, None

    def met(self, has_turn: bool, turn: int, initial: str, fault: int) -> None:
        self.faults[fault] += 1
        if has_turn:
            self.first = turn if self.first is None else self.first
            self.turns += turn != self.last
            self.last = turn
        if self.before is not None:
            self.illegal += self.before + initial not in LEGAL
        self.before = initial

    def wrote(self, letter: int, role: str | None, text: str) -> None:
        self.audit += LETTERS[letter].encode()
        if role is not None:
            self.sha.update(("\n" if self.lines else "").encode() + role.encode() + b":" + text.encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return self.conv, gaps, *self.faults[BLANK:ABSENT], self.illegal, self.cost, self.audit.decode(), self.sha.hexdigest()


def _walk(rows: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The pass from the first row to the last: gives the repaired rows, or a report on each conversation."""
    names = ["conv", "place", "has_turn", "turn", "role", "text", "edit"] if rows else ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, at, place, out = None, START, 0, []

        def put(letter: int, role: str | None, text: str, has_turn: bool = False, turn: int = 0) -> None:
            nonlocal place
            if rows:
                if role is not None:
                    out.append((now.conv, place, has_turn, turn, role, text, LETTERS[letter]))
                    place += 1
            else:
                now.wrote(letter, role, text)

        def finish() -> None:
            nonlocal at
            while at not in MAY_END:
                at = DUE[at]
                put(I, NAMES[at], "")
            if not rows:
                out.append(now.row())

        for batch in batches:
            for c, has_turn, turn, role, text, fault, letters, cost in batch[["conv", "has_turn", "turn", "role", "text", "fault", "letters", "cost"]].itertuples(index=False, name=None):
                if now is None or c != now.conv:
                    if now is not None:
                        finish()
                    now, at, place = Report(c, cost), START, 0
                if fault == ABSENT:
                    continue
                now.met(has_turn, turn, role[:1], fault)
                while (letter := letters >> 2 * at & 3) == I:
                    at = DUE[at]
                    put(I, NAMES[at], "")
                if letter == D:
                    put(D, None, "")
                elif letter == K:
                    at = OWN[role[0]][at]
                    put(K, role, text, has_turn, turn)
                else:
                    at = DUE[at]
                    put(R, NAMES[at], text, has_turn, turn)
            if out:
                yield pd.DataFrame(out, columns=names)
                out.clear()
        if now is not None:
            finish()
        if out:
            yield pd.DataFrame(out, columns=names)

    return run


def _faulted(rows: DataFrame, conv: str, turn: str, role: str, text: str, alive: Column | None) -> DataFrame:
    """One row for each of ``rows``, dealt out by conversation, with its first fault and its number among equal rows."""
    given = rows.select(
        F.col(f"`{conv}`").cast("string").alias("conv"),
        F.col(f"`{turn}`").cast("long").alias("t"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
        F.coalesce(F.lit(True) if alive is None else alive, F.lit(False)).alias("alive"),
    )
    gone = ~F.col("alive")
    given = given.withColumns({c: F.when(gone, F.lit("")).otherwise(F.col(c)) for c in ("role", "text")}).repartition("conv")
    # the rows of a conversation are together already: this window sorts and moves nothing
    copy = F.row_number().over(Window.partitionBy("conv", "alive", "role", "text").orderBy(F.asc_nulls_first("t")))
    rest = F.rtrim("text", F.lit(SPACE))
    fault = F.when(gone, ABSENT).when(rest == "", BLANK).when(F.col("copy") > 1, DUPLICATE).when(~F.right(rest, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    return given.withColumn("copy", copy).select("conv", F.col("t").isNotNull().alias("has_turn"), F.coalesce("t", F.lit(0)).alias("turn"), "role", "text", "copy", fault.alias("fault"))


IN_ORDER = ["conv", "has_turn", "turn", "role", "text", "copy"]
CHOSEN = "conv string, has_turn boolean, turn long, role string, text string, copy int, fault int, letters int, cost long"


def _chosen(rows: DataFrame, names: tuple[str, str, str, str], alive: Column | None, costs: Costs) -> DataFrame:
    back = _faulted(rows, *names, alive).sortWithinPartitions(*IN_ORDER, ascending=[True, *[False] * 5])
    return back.mapInPandas(_choose(costs), CHOSEN).sortWithinPartitions(*IN_ORDER)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", costs: Costs = Costs()) -> DataFrame:  # noqa: B008
    """The repaired rows: conversation, place (from 0), turn (null if inserted), role, text and the edit (I, K or R) behind each."""
    made = _chosen(rows, (conv, turn, role, text), None, costs).mapInPandas(_walk(True), "conv string, place long, has_turn boolean, turn long, role string, text string, edit string")
    return made.select(F.col("conv").cast(rows.schema[conv].dataType).alias(conv), "place", F.when(F.col("has_turn"), F.col("turn")).alias(turn), F.col("role").alias(role), F.col("text").alias(text), "edit")


def report(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", alive: Column | None = None, costs: Costs = Costs()) -> DataFrame:  # noqa: B008
    """One row for each conversation: gaps between turns, rows by first fault, pairs of neighbours whose role initials do not
    follow each other, the least cost, its edits as letters and a hash of the repaired rows (``role:text``, one a line).

    Rows for which ``alive`` is not true are taken as lost, but their conversation is reported all the same.
    """
    made = _chosen(rows, (conv, turn, role, text), alive, costs).mapInPandas(
        _walk(False), "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )
    return made.select(F.col("conv").cast(rows.schema[conv].dataType).alias(conv), *made.columns[1:])


def damage(rows: DataFrame) -> DataFrame:
    """Conversations with the faults that the query repairs, chosen by a checksum of ``conv_id:turn`` (null: one space) modulo
    20: 0 loses the row (``alive`` is false), 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes it the user's."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    given = rows.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind"))
    return given.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("alive"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("n"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(damage(table(spark, sf_dir, "conversations")), alive=F.col("alive"))


OP11_SQL = r"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
summed AS (SELECT keyed.*, xor(list_reduce(list_transform(string_split(k, ''), lambda c: unicode(c)::BIGINT), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS d FROM keyed, crc),
damaged AS (
  SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role, CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM summed, range(2) c(i) WHERE d <> 0 AND (i = 0 OR d = 3)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM damaged),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) AS copy,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS rest FROM numbered),
faulted AS (SELECT *, left(role, 1) AS r, CASE WHEN rest = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate' WHEN right(rest, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM ordered),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (n > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS rows FROM faulted GROUP BY conv_id),
-- places: nothing yet, after s, after u, after a; the least (cost, edits) of each. With these costs no cheapest repair inserts:
-- deleting the row beside an inserted one costs 2 instead of 5.
walk AS (
  SELECT conv_id, 0::BIGINT AS n, [{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}] || list_transform(range(3), lambda i: {'c': 1000000000::BIGINT, 'a': '', 't': []::VARCHAR[]}) AS s FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT w.conv_id, f.n, list_transform(range(4), lambda p: list_min(
    [{'c': s[p + 1].c + 2, 'a': s[p + 1].a || 'D', 't': s[p + 1].t}] || list_transform(
      list_filter([
        {'o': 1, 'p': 1, 'l': 'K', 'r': 's'}, {'o': 1, 'p': 2, 'l': 'K', 'r': 'u'}, {'o': 2, 'p': 2, 'l': 'K', 'r': 'u'}, {'o': 4, 'p': 2, 'l': 'K', 'r': 'u'}, {'o': 3, 'p': 3, 'l': 'K', 'r': 'a'},
        {'o': 1, 'p': 2, 'l': 'R', 'r': 'user'}, {'o': 2, 'p': 2, 'l': 'R', 'r': 'user'}, {'o': 4, 'p': 2, 'l': 'R', 'r': 'user'}, {'o': 3, 'p': 3, 'l': 'R', 'r': 'assistant'}],
        lambda e: e.p = p AND f.fault NOT IN ('blank', 'duplicate') AND (e.l = 'R' OR e.r = f.r)),
      lambda e: {'c': s[e.o].c + (e.l = 'R')::BIGINT + CASE f.fault WHEN 'truncated' THEN 5 ELSE 0 END, 'a': s[e.o].a || e.l, 't': s[e.o].t || [CASE e.l WHEN 'R' THEN e.r ELSE f.role END || ':' || f.text]})))
  FROM walk w JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n + 1),
best AS (SELECT w.conv_id, list_min([s[1], s[4]]) AS b FROM walk w LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id WHERE w.n = coalesce(c.rows, 0))
SELECT best.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  b.c AS cost, b.a AS audit, sha256(array_to_string(b.t, chr(10))) AS repaired_sha256
FROM best LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM best.conv_id
"""
