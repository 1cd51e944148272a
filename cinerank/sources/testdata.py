"""Stand-in inputs derived from the generated test tables.

These functions only shape rows into the schemas the jobs expect (ratings,
movies, tags, rating events, raw log lines, item vectors); they do none of the
jobs' work.  Each one reads whole tables and prunes to the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank import config
from cinerank.functions.columns import column_type, epoch_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``uid, mid, score, timestamp``: one rating per order line."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    ship = epoch_seconds("l_shipdate", column_type(li, "l_shipdate"))
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .select(F.col("o_custkey").cast("int").alias("uid"),
                    F.col("l_partkey").cast("int").alias("mid"),
                    (F.ceil(F.col("l_quantity") / F.lit(5)) / F.lit(2)).cast("double").alias("score"),
                    ship.cast("int").alias("timestamp")))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 movie columns; ``genres`` is ``|``-separated words of name and type."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    year = (F.lit(1960) + F.col("p_partkey") % 60).cast("string")
    return p.select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat(F.col("p_name"), F.lit(" by "), F.col("p_brand")).alias("descri"),
        F.concat(F.col("p_size").cast("string"), F.lit(" minutes")).alias("timelong"),
        F.concat(F.lit("January 1, "), year).alias("shoot"),
        year.alias("issue"),
        F.lit("English").alias("language"),
        F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("|")), F.lit("|"), F.col("p_type")).alias("genres"),
        F.col("p_brand").alias("director"),
        F.concat(F.lit("Actor "), (F.col("p_partkey") % 37).cast("string")).alias("actors"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``uid, mid, tag, timestamp``: one tag per event (the event type)."""
    ev = _events(spark, sf_dir)
    return ev.select(
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        F.col("event_type").alias("tag"),
        epoch_seconds("ts", column_type(ev, "ts")).cast("int").alias("timestamp"),
    )


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rating stream: ``event_id, ts, uid, mid, score, timestamp``."""
    ev = _events(spark, sf_dir)
    return ev.select(
        "event_id", "ts",
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        ((F.col("event_id") % 10 + 1) / F.lit(2.0)).cast("double").alias("score"),
        epoch_seconds("ts", column_type(ev, "ts")).cast("int").alias("timestamp"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw log line per event: good, noise, marker-only and malformed lines."""
    r = rating_events(spark, sf_dir)
    m = config.RATING_MARKER
    msg = F.concat_ws("|", F.col("uid").cast("string"), F.col("mid").cast("string"),
                      F.col("score").cast("string"), F.col("timestamp").cast("string"))
    bad = F.concat_ws("|", F.col("uid").cast("string"), F.col("mid").cast("string"),
                      F.lit("bad"), F.col("timestamp").cast("string"))
    value = (F.when(F.col("event_id") % 50 == 1, F.lit(f"INFO app {m}"))
             .when(F.col("event_id") % 50 == 2, F.concat(F.lit(f"INFO app {m}"), bad))
             .when(F.col("event_id") % 3 == 0, F.concat(F.lit("INFO app heartbeat "), F.col("event_id").cast("string")))
             .otherwise(F.concat(F.lit(f"INFO app {m}"), msg, F.lit(" "))))
    return r.select("event_id", value.alias("value"))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``mid, features array<double>`` from the embeddings table."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return e.select(F.col("vec_id").cast("int").alias("mid"),
                    F.col("embedding").cast("array<double>").alias("features"))
