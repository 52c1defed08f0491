"""URL filter: a blocked Bloom filter of listed canonical URLs lets possible hits through to an exact hash join.

A rule is a host with a path (``example.net/en/``). It fits its host and all subdomains where the url's path starts with
the rule's. Every url yields its possible keys (host suffixes at label borders, path beginnings of the lengths that
occur in the list). Keys that the Bloom filter knows not to be listed leave in an inner join with its blocks; possible hits
go on to an inner join on the key itself, and only what that finds goes back to its row.
The longest rule wins (then the longer host, then the greater rule string); without one the verdict is ``default``.

Edge cases: a null url or one without ``://`` has empty host and path and fits nothing. Repeated rows come back as often
as they came; a null page_id is kept. A rule listed twice with both verdicts blocks. An empty list fits nothing. Other
columns pass through whatever their names, but for older ones of the four that are added. Rows are numbered while they are
read and met again by number, so ``pages`` must give the same rows in the same partitions each time, as files do.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import helper, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_A_KEY, BLOCK_WORDS = 12, 4  # a block is 4 words of 64 bits; every key sets two bits in each word of one block
BROADCAST_ROWS = 200_000  # blocks and rules up to this many are sent to all tasks (about 20 MB); above it Spark shuffles both sides

# The rules of the registered query.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def url_parts(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER), F.regexp_extract(url, pattern, 2)


def listing(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, verdict, host, path) from rule strings."""
    rows = spark.createDataFrame(rules, "rule string, verdict string")
    host = F.substring_index("rule", "/", 1)
    return rows.select("rule", "verdict", F.translate(host, UPPER, LOWER).alias("host"), F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("path"))


def _masks(key: str) -> list[Column]:
    """The two bits that a key sets in each word of its block."""
    one = lambda i: F.expr(f"shiftleft(1L, cast(pmod(shiftright({key}, {6 * i + 12}), 64) as int))")
    return [one(2 * i).bitwiseOR(one(2 * i + 1)) for i in range(BLOCK_WORDS)]


def bloom(listed: DataFrame, n_blocks: int) -> DataFrame:
    """(block, w0..w3): the blocks that hold a key; both the build and the test are plain joins and aggregates."""
    keys = listed.select(F.xxhash64("host", "path").alias("h"))
    marked = keys.select(F.pmod("h", F.lit(n_blocks)).alias("block"), *(m.alias(f"w{i}") for i, m in enumerate(_masks("h"))))
    return marked.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(BLOCK_WORDS)))


def judge(pages: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """pages with a url column, plus host, path, rule and verdict."""
    host, path = url_parts(F.col("url"))
    listed = listed.where("host is not null and path is not null").groupBy("host", "path").agg(F.min("rule").alias("rule"), F.max("verdict").alias("verdict"))
    n = listed.count()
    n_blocks = max(1, 1 << math.ceil(math.log2(max(1, n * BITS_A_KEY / (64 * BLOCK_WORDS)))))
    small = (lambda d: F.broadcast(d)) if max(n, n_blocks) <= BROADCAST_ROWS else (lambda d: d)
    # distinct lengths of listed paths: at most a few hundred small numbers; and the most labels that a listed host has
    lengths = [r[0] for r in listed.select(F.length("path")).distinct().collect()]
    labels = listed.agg(F.max(F.size(F.split("host", "[.]")))).first()[0] or 1
    row, host_of, path_of, best_of = (helper(pages, x) for x in ("row", "host", "path", "best"))
    rows = pages.withColumns({row: F.monotonically_increasing_id(), host_of: host, path_of: path})
    keys = rows.select(F.col(row).alias("row"), F.col(host_of).alias("host"), F.col(path_of).alias("path"))
    # a host's suffixes of no more labels than listed hosts have: a longer one can't be listed
    suffixes = F.array_distinct(F.expr(f"transform(sequence(1, {labels}), k -> substring_index(host, '.', -k))"))
    starts = F.array_distinct(F.expr(f"transform(filter(array({', '.join(map(str, lengths)) or '-1'}), n -> n between 0 and length(path)), n -> substring(path, 1, n))"))
    keys = keys.select("row", F.explode(suffixes).alias("suffix"), "path").select("row", "suffix", F.explode(starts).alias("start"))
    keys = keys.withColumn("h", F.xxhash64("suffix", "start")).withColumn("block", F.pmod("h", F.lit(n_blocks)))
    hit = F.lit(True)
    for i, m in enumerate(_masks("h")):
        hit = hit & (F.col(f"w{i}").bitwiseAND(m) == m)
    maybe = keys.join(small(bloom(listed, n_blocks)), "block").where(hit).select("row", "suffix", "start")
    rules = listed.select(F.col("host").alias("suffix"), F.col("path").alias("start"), "rule", "verdict")
    found = maybe.join(small(rules), ["suffix", "start"])
    best = found.groupBy("row").agg(F.max(F.struct(F.length("rule").alias("n"), F.length("suffix").alias("k"), "rule", "verdict")).alias(best_of)).withColumnRenamed("row", f"{row}2")
    out = rows.join(best, F.col(row) == F.col(f"{row}2"), "left")
    taken = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    return out.select(*(F.col(f"`{c}`") for c in taken), F.col(host_of).alias("host"), F.col(path_of).alias("path"), F.col(f"{best_of}.rule").alias("rule"), F.coalesce(F.col(f"{best_of}.verdict"), F.lit(default)).alias("verdict"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"), listing(spark, RULES)).drop("url")


OP1_SQL = f"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path, row_number() OVER () AS rn
  FROM pages),
r(rule, verdict, rhost, rpath) AS (VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
  ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')),
j AS (
  SELECT p.rn, r.rule, r.verdict, row_number() OVER (PARTITION BY p.rn ORDER BY length(r.rule) DESC, length(r.rhost) DESC, r.rule DESC) AS k
  FROM p JOIN r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT p.page_id, p.host, p.path, j.rule, coalesce(j.verdict, 'allow') AS verdict
FROM p LEFT JOIN j ON p.rn = j.rn AND j.k = 1
"""
