"""Small column helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def text_of(c: str | Column) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


ARROW_ROWS = 1_000       # rows that reach a Python worker at a time


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ARROW_ROWS: a row here holds a whole text or
    set, so the default of 10,000 rows would fill a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def fold(id_col: str, k: int) -> Column:
    """crc32 of the id written as text, modulo k."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(k)


def buckets_for(rows: int, per_bucket: int) -> int:
    """How many groups of about ``per_bucket`` rows hold ``rows`` rows."""
    return max(1, math.ceil(rows / per_bucket))


BLOCK_BITS = 1 << 15     # bits of one bitmap row (fixed by Spark's bitmap functions)


def key_bitmap(keys: DataFrame, key: Column, bits: int) -> DataFrame:
    """(block, bitmap) rows with one bit for each key (a long) modulo ``bits``.  At most
    ``bits`` / 8 bytes whatever the number of keys, so it may be broadcast."""
    at = F.pmod(key, F.lit(bits))
    return (keys.select(F.floor(at / BLOCK_BITS).alias("block__"), (at % BLOCK_BITS).alias("bit__"))
            .groupBy("block__").agg(F.bitmap_construct_agg("bit__").alias("bitmap__")))


def maybe_in(rows: DataFrame, key: Column, bitmap: DataFrame, bits: int) -> DataFrame:
    """Rows whose key may be among the bitmap's: all that are, and few others while the
    keys are few against ``bits``.  Keeps texts of the other rows out of a later shuffle."""
    at = F.pmod(key, F.lit(bits))
    cols = rows.columns
    marked = rows.withColumn("block__", F.floor(at / BLOCK_BITS)).withColumn("bit__", (at % BLOCK_BITS).cast("int"))
    return marked.join(F.broadcast(bitmap), "block__").filter(_bit_set()).select(*cols)


def _bit_set() -> Column:
    """Whether bit ``bit__`` of ``bitmap__`` is set; null where there is no bitmap."""
    byte = F.conv(F.hex(F.expr("substring(bitmap__, bit__ div 8 + 1, 1)")), 16, 10).cast("int")
    power = F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), F.col("bit__") % 8 + 1)
    return byte.bitwiseAND(power) != 0


FILTER_BITS = 1 << 23    # 1 MB: size of the bitmaps that keep rows out of a shuffle


def packed(rows: DataFrame, key: Column) -> DataFrame:
    """(row, key): all columns of ``rows`` as one struct, so that no name can clash."""
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), key.alias("key"))


def without(rows: DataFrame, key: Column, dropped: DataFrame) -> DataFrame:
    """Rows whose ``key`` (null never matches) is not in the one column of ``dropped``.  Rows
    the bitmap clears pass where they are; only the few it cannot clear are joined."""
    keys = dropped.toDF("key")
    pairs, hashed = packed(rows, key), F.xxhash64("key")
    bitmap = key_bitmap(keys, hashed, FILTER_BITS)
    at = F.pmod(hashed, F.lit(FILTER_BITS))
    marked = (pairs.withColumn("block__", F.floor(at / BLOCK_BITS)).withColumn("bit__", (at % BLOCK_BITS).cast("int"))
              .join(F.broadcast(bitmap), "block__", "left"))
    clear = marked.filter(~_bit_set().eqNullSafe(F.lit(True))).select("row.*")
    rest = maybe_in(pairs, hashed, bitmap, FILTER_BITS).join(keys, "key", "left_anti")
    return clear.unionByName(rest.select("row.*"))


def row_identity(df: DataFrame, id_col: str) -> Column:
    """Text naming a row by its id and all its values; equal only for rows that repeat."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")),
                       F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])))
