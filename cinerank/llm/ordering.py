"""Positions in a global order and look-ups by skewed keys, without a hot task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cinerank.config import materialize, parallelism

HOT_PARTS = 1_000    # a key with more than 1/HOT_PARTS of the rows counts as hot


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``at``, the position (from 0) in its group under ``order``, nulls first.

    Rows are dealt by ranges of (group, order), so a group of any size is spread over many
    tasks: a row's position is its number within its range plus the group's rows in earlier
    ranges.  Group columns hold no nulls.  Rows equal in group and order take their places
    in any order, within one range.  ``rows`` should be cheap to read twice, since the ranges
    are found from a sample first."""
    dealt = materialize(rows.repartitionByRange(*group, *order).withColumn("part__", F.spark_partition_id()), "ordered")
    near = F.row_number().over(Window.partitionBy("part__", *group).orderBy(*order))
    earlier = Window.partitionBy(*group).orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)
    before = (dealt.groupBy("part__", *group).agg(F.count(F.lit(1)).alias("rows__"))
              .select("part__", *group, F.coalesce(F.sum("rows__").over(earlier), F.lit(0)).alias("before__")))
    return (dealt.withColumn("near__", near).join(before, ["part__", *group])
            .select(*rows.columns, (F.col("before__") + F.col("near__") - 1).cast("long").alias("at")))


def slots(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), parallelism(spark))


def dealt_by(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` by hash of ``keys`` over every task slot: groups that are few and costly are
    not merged into fewer tasks at run time."""
    return rows.repartition(slots(rows.sparkSession), *keys)


def look_up(rows: DataFrame, values: DataFrame, key: str, copies: Column, total: int) -> DataFrame:
    """``rows`` left-joined with ``values`` (one row for each ``key``), where ``copies`` says how
    many of the ``total`` rows have the key.  Fewer than HOT_PARTS keys can hold more than
    1/HOT_PARTS of all rows: those are broadcast, so their rows stay where they are; of
    the others no key can fill a task."""
    hot = copies * F.lit(HOT_PARTS) > F.lit(total)
    few = F.broadcast(values.filter(hot))
    rest = rows.join(F.broadcast(values.filter(hot).select(key)), key, "left_anti")
    return rows.join(few, key).unionByName(rest.join(values.filter(~hot), key, "left"))
