"""Column expressions used across jobs.

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinerank.config import SCORE_DIGITS

# Characters a JVM String.trim() strips: every code point <= U+0020.
_JVM_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_literal(value, sep: str) -> Column:
    """Split on a literal separator, keeping trailing empty fields."""
    return F.split(col(value), re.escape(sep), -1)


def jvm_trim(value) -> Column:
    """Trim like the JVM: strips control characters and spaces, not only ' '."""
    return F.regexp_replace(col(value), _JVM_TRIM, "")


def yyyymm_of_epoch(seconds) -> Column:
    """Epoch seconds -> int ``yyyyMM`` in UTC, independent of the session zone."""
    day = F.date_from_unix_date(F.floor(col(seconds) / F.lit(86400)).cast("int"))
    return (F.year(day) * 100 + F.month(day)).cast("int")


CHANGE_DATE_SQL = (
    "CREATE OR REPLACE TEMPORARY FUNCTION change_date(ts INT) RETURNS INT RETURN "
    "CAST(year(date_from_unix_date(CAST(floor(ts / 86400) AS INT))) * 100 + "
    "month(date_from_unix_date(CAST(floor(ts / 86400) AS INT))) AS INT)"
)


def register_change_date(spark) -> None:
    """Offer the month conversion to SQL as ``change_date(ts)`` (a SQL function,
    not a Python UDF, so it is inlined into the plan)."""
    spark.sql(CHANGE_DATE_SQL)


def epoch_seconds(ts, dtype: T.DataType | None = None) -> Column:
    """Seconds since the epoch of a timestamp column.

    A ``TIMESTAMP_NTZ`` is read as UTC wall time from its fields, so the result
    does not depend on the session time zone.
    """
    c = col(ts)
    if isinstance(dtype, T.TimestampNTZType):
        return (F.unix_date(c.cast("date")).cast("long") * 86400
                + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c))
    return F.unix_seconds(c)


def epoch_micros(ts, dtype: T.DataType | None = None) -> Column:
    """Microseconds since the epoch (NTZ read as UTC wall time)."""
    c = col(ts)
    if isinstance(dtype, T.TimestampNTZType):
        frac = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
        return (F.unix_date(c.cast("date")).cast("long") * 86_400_000_000
                + F.hour(c).cast("long") * 3_600_000_000 + F.minute(c).cast("long") * 60_000_000 + frac)
    return F.unix_micros(c)


def column_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def round_score(c, digits: int = SCORE_DIGITS) -> Column:
    """Round a double score to ``digits`` places, half away from zero.

    The value is first fixed to 12 decimals, which absorbs binary noise, so a
    score that is mathematically ``x.xxxxxx5`` rounds the same way whatever
    the summation order or engine produced it."""
    return F.round(col(c).cast("decimal(30,12)"), digits).cast("double")


def sum_array(arr) -> Column:
    return F.aggregate(col(arr), F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    """Dot product of two equal-length numeric arrays."""
    return sum_array(F.zip_with(col(a), col(b), lambda x, y: x * y))


def l1_norm(v) -> Column:
    return sum_array(F.transform(col(v), lambda x: F.abs(x)))


def l2_norm(v) -> Column:
    return F.sqrt(sum_array(F.transform(col(v), lambda x: x * x)))


def scale_array(v, factor) -> Column:
    return F.transform(col(v), lambda x: x * factor)


def safe_ratio(num, den) -> Column:
    """``num / den`` with a zero (or null) denominator giving 0.0 instead of NaN."""
    return F.when(col(den) > 0, col(num) / col(den)).otherwise(F.lit(0.0))


def cosine(a, b) -> Column:
    """Cosine of two arrays; a zero vector scores 0.0."""
    return safe_ratio(dot(a, b), l2_norm(a) * l2_norm(b))


def l1l2(a, b) -> Column:
    """The asymmetric variant ``dot / (|a|_1 * |b|_2)``; zero vector -> 0.0."""
    return safe_ratio(dot(a, b), l1_norm(a) * l2_norm(b))


def priority(mean_weighted, n_strong, n_weak) -> Column:
    """Recommendation priority: mean(sim * rating) + log10(max(inc,1)) - log10(max(dec,1))."""
    return (col(mean_weighted)
            + F.log10(F.greatest(col(n_strong), F.lit(1)))
            - F.log10(F.greatest(col(n_weak), F.lit(1))))


def recommendation(mid="mid", score="score") -> Column:
    return F.struct(col(mid).cast("int").alias("mid"), col(score).cast("double").alias("score"))
