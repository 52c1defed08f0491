"""Reading tables, cutting lineage in the shared folder, and fixed-size bitmaps."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the session names none, a local one will do in local mode, as in tests; elsewhere that is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def helper(docs: DataFrame, name: str) -> str:
    """A name for a column of our own that no column of ``docs`` has, whatever its case."""
    taken = {c.lower() for c in docs.columns}
    name = f"_{name}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends there and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bitmap(df: DataFrame, key: str, bits: int = 1 << 24) -> np.ndarray:
    """A bitmap of ``bits`` bits (2 MB by default, whatever the input) with the bit of every value of the long column ``key`` set.

    It only thins what the next step reads; a join on the key itself follows, so false hits cost time and never change a result.
    """
    slot = F.pmod(F.col(key), F.lit(bits))
    rows = (
        df.select(slot.alias("s"))
        .groupBy(F.bitmap_bucket_number("s").alias("b"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m"))
        .collect()
    )
    out = np.zeros(bits // 8, np.uint8)
    for b, m in rows:
        # value v is bit (v - 1) % 32768 of bucket (v - 1) // 32768 + 1; slot 0 lies in bucket 0
        part = np.frombuffer(bytes(m), np.uint8)
        at = ((b - 1) * 32768) // 8
        if at < 0:
            out[0:1] |= 0  # slot 0 is kept in every test below
        else:
            out[at : at + len(part)] |= part[: len(out) - at]
    return out


def bits_for(n: int, most: int = 28) -> int:
    """Bits of a bitmap for n keys: 16 to 32 for each, from 8 KB to 32 MB in all. A fuller one lets more through, no less."""
    return 1 << min(most, max(16, (16 * n).bit_length()))


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    n = np.uint64(len(bits) * 8)
    slot = np.mod(keys.astype(np.int64), np.int64(n)).astype(np.int64)
    v = slot - 1
    hit = (bits[np.maximum(v, 0) >> 3] >> (np.maximum(v, 0) & 7).astype(np.uint8)) & 1
    return (hit == 1) | (slot == 0)
