"""Per-group top-k and ranked lists.

``row_number() <= k`` over a window is planned by Spark as a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so at most
k rows per group and map task cross the network, and a hot group never lands
whole in one task.  Nested ``recs`` arrays are built from the ranked rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cinerank.functions.columns import recommendation


def rank_within(df: DataFrame, group_cols, order_cols, k: int | None = None,
                rank_col: str = "rank") -> DataFrame:
    """Add ``rank`` (1-based, no ties) inside each group; keep ``rank <= k``."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    out = df.withColumn(rank_col, F.row_number().over(w))
    if k is not None:
        out = out.filter(F.col(rank_col) <= k)
    return out


def by_score(score: str = "score", item: str = "mid") -> list[Column]:
    """The deterministic order of every ranking: score desc, then item id asc."""
    return [F.col(score).desc(), F.col(item).asc()]


def nest_ranked(df: DataFrame, key: str, rank_col: str = "rank", mid: str = "mid",
                score: str = "score") -> DataFrame:
    """Ranked long rows -> ``(key, recs array<struct<mid,score>>)`` in rank order.

    The list is ordered by sorting on the rank field, so no comparator lambda
    is needed; an empty group produces no row.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col(rank_col).alias("r"), recommendation(mid, score).alias("rec"))))
    return df.groupBy(key).agg(F.transform(entries, lambda e: e["rec"]).alias("recs"))
