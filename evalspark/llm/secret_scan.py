"""Secret scan over a trigram inverted index, in DataFrame expressions only.

From each rule's regular expression a Boolean query of mandatory trigrams is derived: an OR over its possible literals,
each an AND of that literal's trigrams. The inverted index holds, for every trigram that some query asks for, the documents
that contain it; postings are intersected, and only candidates are verified with the regular expression. A rule without
mandatory trigrams scans every text. Texts whose own trigrams meet no query never leave their partition.

Spans are in code points, end exclusive, leftmost and non-overlapping for each rule; matches that are too short are
dropped after matching, so they still use up their text.

Edge cases: a null text is empty and has no spans. Repeated rows come back as often as they came; a null doc_id is kept
(postings are keyed by doc_id, a 64-bit hash of the text and its length). Other columns pass through whatever their names,
but for an older ``found``. An empty table gives an empty result. U+0001 and U+0002 in a text mark matches while spans are
counted and are first turned into U+0003, which no rule matches either.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import helper, table


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # the group whose length counts
    least: int = 1


# The three base kinds in their order.
BASE = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
]
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20),
]

MAX_LITERALS = 64
SPANS = "array<struct<start: int, rule: int, end: int>>"


def _literals(parsed, case: bool) -> list[str] | None:
    """All texts that a parsed expression matches, if they are few; else None."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            some = [chr(arg)]
        elif name == "BRANCH":
            some = [_literals(x, case) for x in arg[1]]
            some = None if None in some else [y for x in some for y in x]
        elif name == "SUBPATTERN":
            some = _literals(arg[3], case)
        elif name == "IN" and all(str(x) == "LITERAL" for x, _ in arg):
            some = [chr(y) for _, y in arg]
        elif name == "MAX_REPEAT" and arg[1] <= 2:
            one = _literals(arg[2], case)
            some = None if one is None else sorted({x for n in range(arg[0], arg[1] + 1) for x in _times(one, n)})
        else:
            some = None
        if some is None or len(out) * len(some) > MAX_LITERALS:
            return None
        out = [a + b for a in out for b in some]
    return out


def _times(some: list[str], n: int) -> list[str]:
    return [""] if n == 0 else [a + b for a in _times(some, n - 1) for b in some]


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """An OR of ANDs of lower-case trigrams that every match contains; None if there is none."""
    parts = list(regex_parser.parse(pattern))
    best: list[str] | None = None
    for i in range(len(parts)):
        for j in range(i + 1, len(parts) + 1):
            some = _literals(parts[i:j], True)
            if some is None:
                break
            if min(map(len, some)) >= 3 and (best is None or min(map(len, some)) > min(map(len, best))):
                best = some
    return None if best is None else [frozenset(x.lower()[k : k + 3] for k in range(len(x) - 2)) for x in best]


KEY = ["doc_id", "th", "size"]


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("th"), F.length("text").alias("size"), "text")


def grams_of(rules: list[Rule]) -> list[str]:
    return sorted({g for r in rules for q in trigram_query(r.pattern) or [] for g in q})


def index(docs: DataFrame, grams: list[str]) -> DataFrame:
    """The inverted index of ``grams``: a row (gram, doc_id, th, size) for every document and each of its distinct trigrams among them.

    It can be written once and asked with any rules whose trigrams it covers.
    """
    held = lambda x: F.array_compact(F.array(*[F.when(F.contains(x, F.lit(g)), F.lit(g)) for g in grams])) if grams else F.expr("cast(array() as array<string>)")
    # a list of one, so that a text is lower-cased once
    return _keyed(docs).where("text is not null").select(F.explode(F.flatten(F.transform(F.array(F.lower("text")), held))).alias("gram"), *KEY)


def candidates(postings: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, th, size, cand): the documents in all postings of some literal of a rule; bit i of cand stands for rule i."""
    queries = [(i, a, sorted(grams)) for i, r in enumerate(rules) for a, grams in enumerate(trigram_query(r.pattern) or [])]
    asked = postings.sparkSession.createDataFrame([(g, i, a, k, (1 << len(gs)) - 1) for i, a, gs in queries for k, g in enumerate(gs)], "gram string, rule int, alt int, k int, all long")
    met = postings.join(F.broadcast(asked), "gram").groupBy(*KEY, "rule", "alt", "all").agg(F.bit_or(F.expr("shiftleft(1L, k)")).alias("have"))
    return met.where("have = all").groupBy(*KEY).agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("cand"))


def _may_hold(rules: list[Rule]) -> Column:
    """Whether a text's own trigrams meet the query of any rule: others need not travel to meet their postings."""
    queries = [sorted(grams) for r in rules for grams in trigram_query(r.pattern) or []]
    holds = lambda x: reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.contains(x, F.lit(g)) for g in grams]) for grams in queries])
    return F.exists(F.array(F.lower("text")), holds)


def _spans(text: Column, rule: Rule, index: int) -> Column:
    """array<struct<start, rule, end>> of one rule in one text."""
    mark = F.regexp_replace(text, rule.pattern, f"\x01$0\x02${rule.group}\x02")
    parts = F.split(mark, "\x01")
    first = F.struct(F.length(F.element_at(parts, 1)).alias("at"), F.expr(f"cast(array() as {SPANS})").alias("out"))

    def step(acc: Column, part: Column) -> Column:
        piece = F.split(part, "\x02", 3)
        n, inner = F.length(piece[0]), F.length(piece[1])
        span = F.struct(acc["at"].alias("start"), F.lit(index).alias("rule"), (acc["at"] + n).alias("end"))
        return F.struct((acc["at"] + n + F.length(piece[2])).alias("at"), F.when(inner >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), first, step, lambda acc: acc["out"])


def _found(text: Column, rules: list[Rule], which: list[int], may: Callable[[int], Column]) -> Column:
    """The spans of some of the rules."""
    clean = F.translate(F.coalesce(text, F.lit("")), "\x01\x02", "\x03\x03")
    found = []
    for i in which:
        r = rules[i]
        # a run of one class of characters: the length can be part of the expression, which then marks only what counts
        run = re.fullmatch(r"\[[^\]]+\]\+", r.pattern)
        quick = Rule(r.kind, f"{r.pattern[:-1]}{{{r.least},}}", r.group, r.least) if run else r
        found.append(F.when(may(i) if trigram_query(r.pattern) else F.rlike(text, F.lit(quick.pattern)), _spans(clean, quick, i)))
    return F.flatten(F.array_compact(F.array(*found)))


def scan(docs: DataFrame, rules: list[Rule] | None = None, postings: DataFrame | None = None) -> DataFrame:
    """docs without text, with found: array<struct<start, rule, end>> in order of start, then rule.

    postings: an ``index`` of docs, if there is one already. Only candidates' texts travel, to be verified; rules without
    mandatory trigrams scan every text where it lies.
    """
    rules = rules or BASE + MORE
    asked = [i for i, r in enumerate(rules) if trigram_query(r.pattern)]
    rest = [i for i in range(len(rules)) if i not in asked]
    th, size, mine, theirs = (helper(docs, x) for x in ("th", "size", "mine", "theirs"))
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "found")]
    empty = F.expr(f"cast(array() as {SPANS})")
    here = docs.withColumns({th: F.xxhash64("text"), size: F.length("text"), mine: F.coalesce(_found(F.col("text"), rules, rest, lambda i: F.lit(True)), empty) if rest else empty})
    if not asked:
        return here.select(*own, F.array_sort(mine).alias("found"))
    cand = candidates(index(docs, grams_of(rules)) if postings is None else postings, rules)
    # equal rows have equal spans, so one of them is verified for all
    texts = _keyed(docs).where("text is not null").where(_may_hold(rules)).alias("t")
    met = texts.join(cand.alias("c"), F.col("t.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("t.th") == F.col("c.th")) & (F.col("t.size") == F.col("c.size")))
    spans = met.select(*(F.col(f"t.{c}").alias(f"{theirs}_{c}") for c in KEY), _found(F.col("t.text"), rules, asked, lambda i: F.col("c.cand").bitwiseAND(1 << i) != 0).alias(theirs))
    spans = spans.where(F.size(theirs) > 0).groupBy(*(f"{theirs}_{c}" for c in KEY)).agg(F.first(theirs).alias(theirs))
    same = F.col("doc_id").eqNullSafe(F.col(f"{theirs}_doc_id")) & (F.col(th) == F.col(f"{theirs}_th")) & (F.col(size) == F.col(f"{theirs}_size"))
    kept = here.select(*own, th, size, mine)
    return kept.join(spans, same, "left").select(*own, F.array_sort(F.concat(mine, F.coalesce(theirs, empty))).alias("found"))


def _joined(found: str, rules: list[Rule]) -> Column:
    names = ", ".join(f"'{r.kind}'" for r in rules)
    return F.expr(f"array_join(transform({found}, s -> concat(element_at(array({names}), s.rule + 1), ':', s.start, ':', s.end)), ',')")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = BASE + MORE
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), rules)
    count = lambda i: F.expr(f"cast(size(filter(found, s -> s.rule = {i})) as long)")
    base = found.withColumn("base", F.expr("filter(found, s -> s.rule < 3)"))
    return base.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_joined("base", rules), 256).alias("base_sha256"), _joined("found", rules).alias("spans"))


def _sql() -> str:
    ctes, unions = [], []
    for i, r in enumerate(BASE + MORE):
        pattern = r.pattern.replace("'", "''")
        ctes.append(
            f"m{i} AS (SELECT rn, string_split(regexp_replace(t, '{pattern}', chr(1) || '\\0' || chr(2) || '\\{r.group}' || chr(2), 'g'), chr(1)) AS parts FROM d),\n"
            f"e{i} AS (SELECT rn, generate_subscripts(parts, 1) AS i, unnest(parts) AS part FROM m{i}),\n"
            f"p{i} AS (SELECT rn, i, CASE WHEN i > 1 THEN length(string_split(part, chr(2))[1]) END AS n, CASE WHEN i > 1 THEN length(string_split(part, chr(2))[2]) END AS inner_n, length(CASE WHEN i = 1 THEN part ELSE string_split(part, chr(2))[3] END) AS tail FROM e{i}),\n"
            f"s{i} AS (SELECT rn, n, inner_n, i, sum(coalesce(n, 0) + tail) OVER (PARTITION BY rn ORDER BY i) - tail - coalesce(n, 0) AS start FROM p{i})"
        )
        unions.append(f"SELECT rn, {i} AS rule, '{r.kind}' AS kind, start::BIGINT AS start, (start + n)::BIGINT AS stop FROM s{i} WHERE i > 1 AND inner_n >= {r.least}")
    join = lambda where: f"coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rule) FILTER ({where}), '')"
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rn, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS t FROM documents),
{", ".join(ctes)},
u AS ({" UNION ALL ".join(unions)})
SELECT d.doc_id, count(*) FILTER (rule = 0) AS n_assign, count(*) FILTER (rule = 1) AS n_access, count(*) FILTER (rule = 2) AS n_hex,
  sha256({join("rule < 3")}) AS base_sha256, {join("rule >= 0")} AS spans
FROM d LEFT JOIN u USING (rn) GROUP BY d.rn, d.doc_id
"""


OP9_SQL = _sql()
