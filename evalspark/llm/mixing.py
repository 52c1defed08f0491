"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent, which is bisected to meet a target entropy of the weights or a
limit on how often a source may repeat. The budget is such that the largest need is one epoch, so every document stays
and smaller sources repeat. Weights are realised as block permutations: a source's documents fall into blocks by hash;
whole epochs repeat all blocks, the rest of the budget takes blocks in a permuted order and, in the one block where it
ends, documents in hash order while they fit.

A source may hold a third of all rows: cumulative sums run over blocks (about ``BLOCK_ROWS`` documents each), and over
documents only inside the block where a budget ends. Counts and shares cover all documents.

Edge cases: a null source is a source of its own; a source without tokens stays for one epoch; a null or empty text has
no tokens. Repeated rows are drawn alike. An empty table gives an empty result. Ties go by hash, then doc_id. Other
columns pass through whatever their names, but for older ones of the four that are added, which are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import helper, materialize, table

BLOCK_ROWS = 256
MAX_REPEATS = 2.0
STEPS = 50
MAX_SOURCES = 100_000  # source totals up to this many come to the driver (a few MB); above it each step of the bisection is a Spark job


def n_tokens(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")).cast("long")


def _key(*parts: Column) -> Column:
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def exponent(totals: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None) -> float:
    """The least exponent in [0, 1] that keeps repeats within the limit, or the one whose weights have the target entropy (in nats).

    totals: (tokens) for each source. Least means flattest: 0 gives every source the same weight, 1 its own share.
    """
    totals = totals.where("tokens > 0")
    rows = [r[0] for r in totals.select("tokens").limit(MAX_SOURCES + 1).collect()]
    if not rows:
        return 1.0
    if len(rows) <= MAX_SOURCES:
        top, low, whole = max(rows), min(rows), sum(rows)
    else:
        top, low, whole = totals.agg(F.max("tokens"), F.min("tokens"), F.sum("tokens")).first()

    def shape(a: float) -> float:
        if entropy is None:
            # epochs of a source: tokens ** (a - 1), scaled so that the least is one
            return (low / whole) ** (a - 1) / (top / whole) ** (a - 1)
        if len(rows) <= MAX_SOURCES:
            powers = sorted((t / whole) ** a for t in rows)
            z, wl = math.fsum(powers), math.fsum(p * math.log(p) for p in powers)
        else:
            p = F.pow(F.col("tokens") / whole, F.lit(a))
            z, wl = totals.agg(F.sum(p), F.sum(p * F.log(p))).first()
        return math.log(z) - wl / z

    limit = max_repeats if entropy is None else entropy
    if shape(0.0) <= limit:
        return 0.0
    lo, hi = 0.0, 1.0  # shape falls as the exponent grows
    for _ in range(STEPS):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if shape(mid) <= limit else (mid, hi)
    return hi


def mix(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, seed: int = 1) -> DataFrame:
    """Every row of docs once for each epoch it is drawn in, with n_tokens, epoch, block and order_key.

    Sorted by order_key, the rows of an epoch come in the order of that epoch's block permutation.
    """
    own = [c for c in docs.columns if c not in ("n_tokens", "epoch", "block", "order_key")]
    source, tokens, key, block, whole, rest, blocks_of, state_of, last = (helper(docs, x) for x in ("source", "tokens", "key", "block", "whole", "rest", "blocks", "state", "last"))
    rid = F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))
    keyed = docs.withColumns({source: F.coalesce(F.concat(F.lit("s:"), F.col("source")), F.lit("null")), key: _key(F.lit(f"doc{seed}"), rid), tokens: n_tokens(F.col("text"))})
    # rows of equal key stand or fall together, however many; texts are not read again until the end
    small = materialize(keyed.groupBy(F.col(source).alias("source"), F.col(key).alias("key")).agg(F.sum(tokens).alias("tokens"), F.count("*").alias("docs")), "keys")
    totals = materialize(small.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")), "totals")
    a = exponent(totals, max_repeats, entropy)
    top = totals.agg(F.max("tokens")).first()[0] or 1
    epochs = F.when(F.col("tokens") > 0, F.pow(F.lit(float(top)) / F.col("tokens"), F.lit(1.0 - a))).otherwise(F.lit(1.0))
    plan = totals.select("source", F.ceil(F.col("docs") / BLOCK_ROWS).alias("blocks"), F.floor(epochs).cast("int").alias("whole"), F.floor((epochs - F.floor(epochs)) * F.col("tokens")).cast("long").alias("rest"))
    sent = F.broadcast(plan) if totals.count() <= MAX_SOURCES else plan
    dealt = small.join(sent, "source").withColumn("block", F.pmod("key", "blocks").cast("int"))
    turn = lambda e, s, b: _key(F.lit(f"block{seed}"), e.cast("string"), s, b.cast("string"))
    order = W.partitionBy("source").orderBy("turn", "block").rowsBetween(W.unboundedPreceding, -1)
    blocks = dealt.groupBy("source", "block", "whole", "rest").agg(F.sum("tokens").alias("t"))
    blocks = blocks.withColumn("turn", turn(F.col("whole"), F.col("source"), F.col("block"))).withColumn("before", F.coalesce(F.sum("t").over(order), F.lit(0)))
    state = F.when(F.col("before") + F.col("t") <= F.col("rest"), 1).when(F.col("before") < F.col("rest"), 0).otherwise(-1)
    blocks = materialize(blocks.select("source", "block", "before", state.alias("state")), "blocks")
    # the one block of a source where its budget ends: documents in hash order while they fit
    ends = dealt.join(blocks.where("state = 0"), ["source", "block"])
    inside = W.partitionBy("source", "block").orderBy("key").rowsBetween(W.unboundedPreceding, 0)
    cut = ends.withColumn("sum", F.col("before") + F.sum("tokens").over(inside)).where("sum <= rest").groupBy("source", "block").agg(F.max("key").alias("last"))
    state = blocks.join(cut, ["source", "block"], "left").select(F.col("source").alias(f"{source}2"), F.col("block").alias(f"{block}2"), F.col("state").alias(state_of), F.col("last").alias(last))
    named = sent.select(F.col("source").alias(f"{source}1"), F.col("blocks").alias(blocks_of), F.col("whole").alias(whole), F.col("rest").alias(rest))
    named = F.broadcast(named) if totals.count() <= MAX_SOURCES else named
    drawn = keyed.join(named, F.col(source) == F.col(f"{source}1")).withColumn(block, F.pmod(key, blocks_of).cast("int"))
    drawn = drawn.join(state, (F.col(source) == F.col(f"{source}2")) & (F.col(block) == F.col(f"{block}2")))
    more = F.expr(f"if(`{state_of}` = 1 or (`{state_of}` = 0 and `{key}` <= `{last}`), 1, 0)")
    columns = [F.col(f"`{c}`") for c in own]
    out = drawn.select(*columns, F.col(tokens).alias("n_tokens"), F.explode(F.sequence(F.lit(0), F.col(whole) + F.coalesce(more, F.lit(0)) - 1)).alias("epoch"), F.col(block).alias("block"), F.col(source))
    return out.select(*columns, "n_tokens", "epoch", "block", turn(F.col("epoch"), F.col(source), F.col("block")).alias("order_key"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")


OP10_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce('s:' || source, 'null') AS src,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) AS n_tokens,
    ('0x' || substr(md5('doc1|' || coalesce(doc_id::VARCHAR, text, '')), 1, 15))::BIGINT AS k
  FROM documents),
t AS (SELECT src, sum(n_tokens)::BIGINT AS tokens, count(*) AS docs FROM d GROUP BY src),
m AS (SELECT max(tokens)::DOUBLE AS hi, min(tokens)::DOUBLE AS lo, sum(tokens)::DOUBLE AS whole FROM t WHERE tokens > 0),
b(n, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL
  SELECT n + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END FROM (
    SELECT b.n, b.lo, b.hi, (b.lo + b.hi) / 2 AS mid,
      pow(m.lo / m.whole, (b.lo + b.hi) / 2 - 1) / pow(m.hi / m.whole, (b.lo + b.hi) / 2 - 1) <= {MAX_REPEATS} AS ok
    FROM b, m WHERE b.n < {STEPS})),
a AS (SELECT CASE WHEN (m.hi / m.lo) <= {MAX_REPEATS} THEN 0.0 ELSE b.hi END AS a FROM b, m WHERE n = {STEPS}),
p AS (
  SELECT src, ceil(docs / {BLOCK_ROWS}.0)::BIGINT AS blocks, floor(e)::INT AS whole, floor((e - floor(e)) * tokens)::BIGINT AS rest
  FROM (SELECT t.*, CASE WHEN tokens > 0 THEN pow(m.hi / tokens, 1.0 - a.a) ELSE 1.0 END AS e FROM t, m, a)),
l AS (SELECT d.*, p.whole, p.rest, (d.k % p.blocks)::INT AS block FROM d JOIN p USING (src)),
g AS (SELECT src, block, whole, rest, sum(n_tokens) AS tk, ('0x' || substr(md5('block1|' || whole || '|' || src || '|' || block), 1, 15))::BIGINT AS turn FROM l GROUP BY ALL),
c AS (SELECT *, coalesce(sum(tk) OVER (PARTITION BY src ORDER BY turn, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g),
w AS (
  SELECT l.*, CASE WHEN c.before + c.tk <= c.rest THEN 1 WHEN c.before < c.rest AND
      c.before + sum(l.n_tokens) OVER (PARTITION BY l.src, l.block ORDER BY l.k) <= c.rest THEN 1 ELSE 0 END AS more
  FROM l JOIN c USING (src, block))
SELECT doc_id, source, n_tokens, e.epoch::INT AS epoch, block, ('0x' || substr(md5('block1|' || e.epoch || '|' || src || '|' || block), 1, 15))::BIGINT AS order_key
FROM w, LATERAL (SELECT unnest(range(whole + more)) AS epoch) e
"""
