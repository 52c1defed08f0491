"""Column expressions: typed values, points, booleans, masks, intervals, keys and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The aggregation flags, in order of their bits.
FLAGS = {"STATS": 1, "HISTOGRAM": 2, "OUTLIERS": 4, "TALLY": 8, "RATE": 16, "SCATTER_ELLIPSE": 32, "DENSITY_MAP": 64, "RAW": 128}

# What identifiers of each kind look like.
IDENTIFIERS = {
    "metric": "^[a-zA-Z][a-zA-Z0-9_]{0,63}$",
    "processor": "^[a-zA-Z][a-zA-Z0-9_-]{0,63}$",
    "version": "^[a-zA-Z0-9][a-zA-Z0-9._-]{0,31}$",
    "task": "^[a-zA-Z0-9_-]{1,64}$",
}

# Words read as true and as false.
TRUE_WORDS = ["true", "t", "yes", "y", "1", "ok", "pass"]
FALSE_WORDS = ["false", "f", "no", "n", "0", "fail"]

# Normal quantiles by confidence, for analyzers and for the read side.
Z_ANALYZER = [(0.99, 2.575829), (0.95, 1.959964), (0.90, 1.644854), (0.0, 1.281552)]
Z_READ = [(0.99, 2.576), (0.95, 1.96), (0.90, 1.645), (0.0, 1.28)]

# Media types by file extension.
MEDIA = {".png": "image/png", ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".gif": "image/gif", ".json": "application/json", ".npz": "application/x-npz", ".csv": "text/csv", ".txt": "text/plain", ".html": "text/html"}


def whole_json(text: Column) -> Column:
    """Whether a text is one JSON value and nothing more; null is none. Spark's parsers stop after the first value and take no
    notice of what follows, so the text is read as the first of two items: only a whole value leaves either second item as it is.
    Names may repeat, and NaN and Infinity are numbers, as in SQL's ``json_valid``."""
    items = lambda end: F.from_json(F.concat(F.lit("["), text, F.lit(f",{end}]")), "array<string>", {"allowSingleQuotes": "false"})
    ends = lambda end: (F.size(items(end)) == 2) & (F.get(items(end), 1) == str(end))
    return F.coalesce(ends(0) & ends(1), F.lit(False))


def typed(raw: Column) -> Column:
    """struct<kind, num, bool, str, x, y, items, raw> from JSON text; the kind is settled before anything is cast."""
    fixed = F.regexp_replace(raw, r"^\s*-?(NaN|Infinity)\s*$", '"non-finite"')
    v = F.when(whole_json(fixed), F.try_parse_json(fixed))
    shape = F.schema_of_variant(v)
    x, y = F.try_variant_get(v, "$.x", "double"), F.try_variant_get(v, "$.y", "double")
    kind = (
        F.when(v.isNull(), F.lit(None))
        .when(shape == "VOID", "null")
        .when(shape == "BOOLEAN", "bool")
        .when(shape == "STRING", "string")
        .when(shape.startswith("ARRAY"), "array")
        .when(shape.startswith("OBJECT") & x.isNotNull() & y.isNotNull(), "point")
        .when(shape.startswith("OBJECT"), "object")
        .otherwise("number")
    )
    pick = lambda k, c: F.when(kind == k, c)
    return F.struct(
        kind.alias("kind"), pick("number", F.try_variant_get(v, "$", "double")).alias("num"), pick("bool", F.try_variant_get(v, "$", "boolean")).alias("bool"),
        pick("string", F.try_variant_get(v, "$", "string")).alias("str"), pick("point", x).alias("x"), pick("point", y).alias("y"),
        pick("array", F.try_variant_get(v, "$", "array<double>")).alias("items"), raw.alias("raw"),
    )


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def valid_identifier(c: Column, kind: str) -> Column:
    """Whether a text is an identifier of a kind; null is none."""
    return F.coalesce(c.rlike(IDENTIFIERS[kind]), F.lit(False))


def has_flag(mask: Column, flag: str) -> Column:
    return mask.bitwiseAND(FLAGS[flag]) != 0


def type_names(mask: Column) -> Column:
    return F.array_compact(F.array(*[F.when(mask.bitwiseAND(b) != 0, F.lit(n)) for n, b in FLAGS.items()]))


def parse_bool(c: Column) -> Column:
    """True, false or null from words, trimmed and in any case."""
    w = F.lower(F.regexp_replace(c.cast("string"), r"^\s+|\s+$", ""))
    return F.when(w.isin(TRUE_WORDS), True).when(w.isin(FALSE_WORDS), False)


def z_of(confidence: float, table: list[tuple[float, float]]) -> float:
    return next(z for least, z in table if confidence >= least)


def wilson(yes: Column, n: Column, z: float) -> tuple[Column, Column]:
    """The bounds of Wilson's interval, within [0, 1]; null without rows."""
    p = yes / n
    d = F.lit(1.0) + F.lit(z * z) / n
    mid = (p + F.lit(z * z / 2) / n) / d
    half = F.lit(z) / d * F.sqrt(p * (F.lit(1.0) - p) / n + F.lit(z * z / 4) / (n * n))
    return F.greatest(F.lit(0.0), mid - half), F.least(F.lit(1.0), mid + half)


def shard_key(content_hash: Column, prefix: int = 4) -> Column:
    """ab/cd/<hash>: two-letter folders; a prefix that is odd goes down to even, one below 2 or above the hash's length is 4."""
    prefix = prefix if 2 <= prefix <= 64 else 4
    parts = [F.substring(content_hash, i + 1, 2) for i in range(0, prefix - prefix % 2, 2)]
    return F.concat_ws("/", *parts, content_hash)


def hash_of_key(key: Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def joined_hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def media_type(name: Column) -> Column:
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in MEDIA.items() for x in p]), ext), F.lit("application/octet-stream"))


def content_kind(mime: Column, content: Column) -> Column:
    """image, json or binary: by media type, and by the first byte where there is none; what doesn't parse is no JSON."""
    told = (mime == "application/json") | (mime.isNull() & F.substring(content, 1, 1).isin("{", "["))
    return F.when(mime.startswith("image/"), "image").when(told & whole_json(content), "json").otherwise("binary")


def data_uri(mime: Column, content: Column) -> Column:
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.translate(F.base64(content), "\r\n", ""))  # Spark wraps lines


def json_text(c: Column) -> Column:
    """A text as a JSON string, quoted and escaped."""
    one = F.to_json(F.struct(c.alias("x")))
    return F.substring(one, 6, F.length(one) - 6)


def canonical(**fields: Column) -> Column:
    """Texts by name as a JSON object, ``{"name": "value", ...}``; names in order, so equal fields give equal bytes and others don't."""
    parts = [F.concat(F.lit(f'"{k}": '), json_text(v)) for k, v in sorted(fields.items())]
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def unix_or_zero(text: Column) -> Column:
    """Seconds since 1970 of a timestamp in SQL's form; 0 if it can't be read."""
    return F.coalesce(F.unix_timestamp(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))), F.lit(0))


def correlation_id(headers: Column) -> Column:
    """The correlation id among headers (array of key and value), whatever the case of its key; a new one if there is none."""
    found = F.filter(headers, lambda h: F.lower(h["key"]) == "x-correlation-id")
    return F.coalesce(F.get(found, 0)["value"].cast("string"), F.uuid())


def signature(content_hash: Column, prev_hash: Column, secret: str) -> Column:
    """A keyed hash over a chain's two hashes; the default of the pluggable check."""
    return F.sha2(F.concat(F.lit(secret), content_hash, F.coalesce(prev_hash, F.lit(""))), 256)


def aggregate_hash(processor: Column, version: Column, metric: Column, kind: Column, start: Column, end: Column, name: Column) -> Column:
    """The hash that names an aggregate's artifact: its seven fields, joined by bars."""
    return joined_hash(processor, version, metric, kind, start, end, name)


def point(raw: Column) -> Column:
    """struct<x, y> from JSON text of a list of two, of an object with x and y, or of one whose xy is a list of two; null unless both are finite."""
    v = F.when(whole_json(raw), F.try_parse_json(raw))
    get = lambda path: F.try_variant_get(v, path, "double")
    pair = lambda path: F.size(F.try_variant_get(v, path, "array<variant>")) == 2
    named = get("$.x").isNotNull() & get("$.y").isNotNull()
    x = F.when(pair("$"), get("$[0]")).when(named, get("$.x")).when(pair("$.xy"), get("$.xy[0]"))
    y = F.when(pair("$"), get("$[1]")).when(named, get("$.y")).when(pair("$.xy"), get("$.xy[1]"))
    return F.when(finite(x) & finite(y), F.struct(x.alias("x"), y.alias("y")))


def document_facts(text: Column) -> Column:
    """struct<size, kind, keys, items> of a JSON document: bytes; object, array, scalar or invalid; an object's keys in order;
    the number of an object's keys or an array's items. A null text has a null kind and size."""
    first = F.substring(F.ltrim(text, F.lit(" \t\n\r")), 1, 1)
    kind = F.when(text.isNull(), None).when(~whole_json(text), "invalid").when(first == "{", "object").when(first == "[", "array").otherwise("scalar")
    keys = F.when(kind == "object", F.array_sort(F.json_object_keys(text)))
    items = F.when(kind == "object", F.size(keys)).when(kind == "array", F.json_array_length(text))
    return F.struct(F.octet_length(text).cast("long").alias("size"), kind.alias("kind"), keys.alias("keys"), items.alias("items"))
