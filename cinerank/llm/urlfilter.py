"""URL rule matching by hashed host-suffix / path-prefix expressions.

Every URL is expanded into the expressions a rule could be written as
(host suffix x path prefix), each expression is hashed, and the expressions meet
the rules in an equi-join on a short hash prefix.  A hit is confirmed on the
full digest; the longest confirmed rule decides.

Only built-in DataFrame functions run here.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank.llm.common import ascii_lower

PREFIX_HEX = 8            # characters of the hex digest that key the join (32 bits)
DEFAULT_VERDICT = "allow"
RULE_SCHEMA = "verdict string, host string, path string"


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) tuples as a rule table."""
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def url_host(url: Column) -> Column:
    """Host between the first ``://`` and ``/ ? #`` or the end, A-Z lower-cased.
    Null URLs and URLs without ``://`` have the empty host."""
    return F.when(_has_scheme(url), ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))).otherwise("")


def url_path(url: Column) -> Column:
    """Path after the host up to ``? #`` or the end; empty where the host is undefined."""
    return F.when(_has_scheme(url), F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _has_scheme(url: Column) -> Column:
    return F.coalesce(F.instr(url, "://") > 0, F.lit(False))


def _after_scheme(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def hashed_rules(rules: DataFrame) -> DataFrame:
    """Rules with their join key and full digest.  Rules with a null field are
    ignored; equal (host, path) with different verdicts count as ``block``."""
    one = (rules.select("verdict", ascii_lower(F.col("host")).alias("host"), "path").dropna()
           .groupBy("host", "path").agg(F.max("verdict").alias("verdict")))
    d = _digest(F.col("host"), F.col("path"))
    return one.select(F.substring(d, 1, PREFIX_HEX).alias("short"), d.alias("digest"),
                      F.concat("host", "path").alias("rule"), "verdict")


def expressions(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """All (host, path) -> expression rows a rule can equal.

    A host gives one suffix for each number of labels that occurs in the rules and
    a path one prefix for each length that occurs in them, so a URL's expressions
    are bounded by the rules' shapes, not by the URL's length.  The shapes are two
    aggregates over the rules (distinct small integers)."""
    shape = rules.dropna().agg(
        F.array_sort(F.collect_set(F.size(F.split("host", r"\.", -1)))).alias("labels"),
        F.array_sort(F.collect_set(F.length("path"))).alias("lengths")).first()
    ints = lambda xs: F.array(*[F.lit(int(x)) for x in xs]).cast("array<int>")
    labels = F.split("host", r"\.", -1)
    by_suffix = hosts.select("host", "path", labels.alias("parts")).select(
        "host", "path", "parts",
        F.explode(F.filter(ints(shape["labels"]), lambda n: n <= F.size("parts"))).alias("n"))
    suffixes = by_suffix.select(
        "host", "path", F.array_join(F.slice("parts", F.size("parts") - F.col("n") + 1, F.col("n")), ".").alias("suffix"))
    return suffixes.select(
        "host", "path", "suffix",
        F.explode(F.filter(ints(shape["lengths"]), lambda n: n <= F.length("path"))).alias("m")).select(
        "host", "path", _digest(F.col("suffix"), F.substring(F.col("path"), F.lit(1), F.col("m"))).alias("digest"))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", id_cols: tuple[str, ...] = ("page_id",),
               default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per row of ``pages``: ``id_cols``, host, path, rule, verdict.

    * Verdicts are worked out once per distinct (host, path), so repeated URLs and a
      host with a third of the pages meet the rules once; the join back is a plain
      equi-join that adaptive execution may split.
    * The rule with the longest text (host + path) wins; equal lengths fall to the
      smaller rule text, which cannot happen for two rules that fit the same URL
      unless they spell the same text with another host/path border.
    * Null URL, no ``://`` or an empty host: host and path empty, no rule, ``default``.
    * An empty table gives an empty result; other columns of ``pages`` are ignored."""
    parsed = pages.select(*id_cols, url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    hosts = parsed.select("host", "path").filter(F.col("host") != "").distinct()
    keyed = expressions(hosts, rules).withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    known = hashed_rules(rules)
    hits = (keyed.join(known.withColumnRenamed("digest", "rule_digest"), "short")
            .filter(F.col("digest") == F.col("rule_digest")))
    best = (hits.groupBy("host", "path")
            .agg(F.min(F.struct((-F.length("rule")).alias("neg"), "rule", "verdict")).alias("b"))
            .select("host", "path", F.col("b.rule").alias("rule"), F.col("b.verdict").alias("hit")))
    return (parsed.join(best, ["host", "path"], "left")
            .select(*id_cols, "host", "path", "rule", F.coalesce("hit", F.lit(default)).alias("verdict")))
