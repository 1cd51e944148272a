"""Exact duplicates through an extendible-hash index on shared files.

* Every text gets a 64-bit directory key, a digest and its length.
* The directory starts with one bucket; while a bucket holds more than ``capacity``
  keys it is split by its next key bit (the directory doubles when the split bucket
  already uses all its bits).  It is worked out from a histogram of the leading
  ``max_depth`` key bits, which has at most 2**max_depth entries whatever the input.
* Every row is routed to its bucket.  Equal (key, digest, length) rows of a bucket are
  combined to one chain record, inside the map tasks first; owner tasks take contiguous
  key ranges, sort their chain records and write them to the bucket's files in the shared
  folder; records of one key lie side by side there.
* The index as read back says which keys of a bucket are chains, that is, have more than
  one row.  Rows of chained keys go to their bucket again, with their text, and their bytes
  are compared there (the aggregate groups on the text itself).  Rows whose key is
  alone never move their text; they are kept out by a bitmap of fixed size.

Only built-in DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.config import materialize, parallelism, scratch_dir
from cinerank.llm.common import FILTER_BITS, key_bitmap, maybe_in, packed, row_identity, text_of, without

CAPACITY = 65_536        # keys a bucket may hold before it is split
MAX_DEPTH = 16           # most key bits the directory uses: 65,536 slots at most


def key_of(text: Column) -> Column:
    return F.xxhash64(text)


def leading_bits(key: Column, n: int) -> Column:
    """The first ``n`` bits of a key as a number."""
    return F.shiftrightunsigned(key, 64 - n) if n else F.lit(0).cast("long")


def grow_directory(histogram: dict[int, int], depth_of_histogram: int, capacity: int) -> list[tuple[int, int, int]]:
    """Buckets (prefix, local depth, keys) after splitting every overfull bucket, from the
    number of keys per leading-bits value.  A bucket at the histogram's depth stays as it
    is: its keys share all directory bits and chain."""
    buckets, done = [(0, 0, sorted(histogram.items()))], []
    while buckets:
        prefix, depth, slots = buckets.pop()
        keys = sum(n for _, n in slots)
        if keys <= capacity or depth == depth_of_histogram:
            done.append((prefix, depth, keys))
            continue
        bit = depth_of_histogram - depth - 1
        halves = [[s for s in slots if (s[0] >> bit) & 1 == b] for b in (0, 1)]
        buckets += [(2 * prefix + b, depth + 1, halves[b]) for b in (0, 1)]
    return sorted(done, key=lambda b: b[0] << (depth_of_histogram - b[1]))


def directory(entries: DataFrame, capacity: int, max_depth: int) -> tuple[DataFrame, int]:
    """(slot, bucket, local_depth) rows and the global depth, from about how many keys have
    each leading-bits value (a sketch: what lies in a bucket is decided by the key alone)."""
    rows = (entries.groupBy(leading_bits(F.col("key"), max_depth).alias("slot"))
            .agg(F.approx_count_distinct("key", 0.03).alias("n")).collect())       # at most 2**max_depth rows
    buckets = grow_directory({r["slot"]: r["n"] for r in rows}, max_depth, capacity)
    depth = max(b[1] for b in buckets)
    slots = [((prefix << (depth - d)) + i, no, d) for no, (prefix, d, _) in enumerate(buckets) for i in range(1 << (depth - d))]
    return entries.sparkSession.createDataFrame(slots, "slot long, bucket int, local_depth int"), depth


def routed(rows: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """``rows`` (with ``key``) and the bucket that the directory gives them."""
    return rows.withColumn("slot", leading_bits(F.col("key"), depth)).join(F.broadcast(slots), "slot").drop("slot")


def build_index(entries: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """Write the index of ``entries`` (id, key, digest, n_bytes) and return it as read
    back from the shared files: bucket, local_depth, key, digest, n_bytes, rows."""
    spark = entries.sparkSession
    records = routed(entries, slots, depth).groupBy("bucket", "local_depth", "key", "digest", "n_bytes").agg(F.count(F.lit(1)).alias("rows"))
    path = scratch_dir(spark, "hash-index")
    (records.repartitionByRange(parallelism(spark), "key").sortWithinPartitions("bucket", "key")
     .write.partitionBy("bucket").parquet(path))
    return spark.read.schema(records.schema).parquet(path)


def chained(index: DataFrame) -> DataFrame:
    """(bucket, key) of the keys that more than one row of their bucket has."""
    return index.groupBy("bucket", "key").agg(F.sum("rows").alias("total")).filter("total > 1").select("bucket", "key")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256.

    * Texts are equal when their bytes are; null counts as empty.  Of equal texts the row
      with the largest id stays.
    * Null ids sort below all others: such a row stays only where its whole group has
      none.  Rows that repeat both id and text cannot be told apart by id and share
      the decision.
    * A group with a third of all rows is combined inside the map tasks, by digest and
      again by text; only the join back sees its rows, as a plain equi-join that adaptive
      execution may split.
    * An empty table gives an empty result; other columns are ignored."""
    text = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    entries = materialize(text.select("id", key_of(F.col("text")).alias("key"), F.sha2("text", 256).alias("digest"),
                                      F.octet_length("text").alias("n_bytes")), "hash-entries")
    slots, depth = directory(entries, capacity, max_depth)
    bitmap = key_bitmap(chained(build_index(entries, slots, depth)), F.col("key"), FILTER_BITS)
    compared = routed(maybe_in(text.withColumn("key", key_of(F.col("text"))), F.col("key"), bitmap, FILTER_BITS), slots, depth)
    groups = (compared.groupBy("bucket", "key", "text").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n"))
              .select("key", F.sha2("text", 256).alias("digest"), "keep", "n"))
    joined = entries.join(groups, ["key", "digest"], "left")
    keep = F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep"))
    return joined.select(F.col("id").alias(id_col), keep.alias("keep_id"),
                         F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                         keep.eqNullSafe(F.col("id")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts: the largest id, then the largest
    row identity; rows that repeat in every column leave one.  Columns are unchanged.

    Texts of rows that simply stay are not shuffled."""
    order = F.struct(F.col(id_col).alias("id"), row_identity(docs, id_col).alias("row"))
    rows = docs.select(order.alias("rid"), F.col(text_col).alias("text"))
    groups = exact_groups(rows, "rid", "text")
    judged = groups.groupBy("rid").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).select(
        F.col("rid.row").alias("row"), "kept", "n")
    special = materialize(judged.filter("not kept or n > 1"), "dropped-rows")
    stays = without(docs, row_identity(docs, id_col), special.select("row"))
    repeated = special.filter("kept").select(F.col("row").alias("key"))
    again = maybe_in(packed(docs, row_identity(docs, id_col)), F.xxhash64("key"),
                     key_bitmap(repeated, F.xxhash64("key"), FILTER_BITS), FILTER_BITS)
    one = again.join(repeated, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
    return stays.unionByName(one)
