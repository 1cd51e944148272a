"""Popularity and quality statistics (the statistics job), plus the search
document built by the loader.

Every aggregation is a hash aggregate with a map-side partial step, so a hot
``mid`` is pre-combined in each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank import config
from cinerank.functions.columns import round_score, yyyymm_of_epoch
from cinerank.operators.topk import by_score, nest_ranked, rank_within


def rating_counts(ratings: DataFrame) -> DataFrame:
    """``mid, count``: ratings per movie (NULL mids are not counted)."""
    return ratings.groupBy("mid").agg(F.count("mid").alias("count"))


def most_rated(ratings: DataFrame, as_written: bool = False) -> DataFrame:
    """Most-rated movies, most first (ties by mid); ``as_written`` keeps the
    reference's ascending order by count."""
    count = F.col("count").asc() if as_written else F.col("count").desc()
    return rating_counts(ratings).orderBy(count, F.col("mid").asc())


def with_month(ratings: DataFrame) -> DataFrame:
    """``mid, score, yyyymm`` (uid dropped); month in UTC."""
    return ratings.select("mid", "score", yyyymm_of_epoch("timestamp").alias("yyyymm"))


def monthly_counts(ratings: DataFrame) -> DataFrame:
    """``yyyymm, mid, count`` ordered by month desc, count desc, mid."""
    return (with_month(ratings).groupBy("yyyymm", "mid").agg(F.count("mid").alias("count"))
            .orderBy(F.col("yyyymm").desc(), F.col("count").desc(), F.col("mid").asc()))


MONTHLY_SQL = """
SELECT change_date(timestamp) AS yyyymm, mid, count(mid) AS count
FROM {ratings}
GROUP BY change_date(timestamp), mid
ORDER BY yyyymm DESC, count DESC, mid ASC
"""


def monthly_counts_sql(spark: SparkSession, ratings: DataFrame) -> DataFrame:
    """The same ranking through SQL and the ``change_date`` SQL function."""
    from cinerank.functions.columns import register_change_date
    register_change_date(spark)
    return spark.sql(MONTHLY_SQL, ratings=ratings)


def monthly_counts_as_written(ratings: DataFrame) -> DataFrame:
    """The reference's projection: ``mid, count`` per (month, mid), month not
    selected but still the primary sort key."""
    return (with_month(ratings).groupBy("yyyymm", "mid").agg(F.count("mid").alias("count"))
            .orderBy(F.col("yyyymm").desc(), F.col("count").desc(), F.col("mid").asc())
            .select("mid", "count"))


def average_scores(ratings: DataFrame) -> DataFrame:
    """``mid, avg``: mean score per movie."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg"))


def best_rated(ratings: DataFrame) -> DataFrame:
    return average_scores(ratings).orderBy(F.col("avg").desc(), F.col("mid").asc())


def genre_matches(movies: DataFrame, genres: list[str] | tuple, match: str = "substring") -> DataFrame:
    """``genre, mid`` for every movie whose genres match a keyword.

    ``substring`` (default) is the reference's case-insensitive containment
    over the whole string; ``token`` matches whole ``|``-separated genres.
    The keyword list is a parameter, so it is inlined as one predicate per
    keyword and the matches are exploded: a single linear pass over the
    movies, with no join.
    """
    lg = F.col("lg")
    tokens = F.col("tokens")
    hits = []
    for g in genres:
        kw = F.lit(g.lower())
        cond = F.array_contains(tokens, kw) if match == "token" else lg.contains(kw)
        hits.append(F.when(cond, F.lit(g)))
    found = F.filter(F.array(*hits), lambda x: x.isNotNull())
    lowered = movies.select("mid", F.lower(F.col("genres")).alias("lg"))
    if match == "token":
        lowered = lowered.withColumn("tokens", F.split("lg", r"\|"))
    return lowered.select("mid", F.explode(found).alias("genre")).select("genre", "mid")


def genre_top(movies: DataFrame, ratings: DataFrame, genres=config.DEFAULT_GENRES,
              k: int = config.GENRE_TOP_K, match: str = "substring") -> DataFrame:
    """Top-k movies per genre keyword by average score: ``genres, rank, mid, score``.

    Matched movies are joined to their averages (inner: unrated movies drop
    out), then a per-genre ``row_number`` keeps k rows, trimmed before the
    shuffle.
    """
    avg = average_scores(ratings)
    scored = genre_matches(movies, genres, match).join(avg, "mid").select(
        F.col("genre").alias("genres"), "mid", round_score("avg").alias("score"))
    return rank_within(scored, ["genres"], by_score(), k).select("genres", "rank", "mid", "score")


def genre_top_nested(movies: DataFrame, ratings: DataFrame, genres=config.DEFAULT_GENRES,
                     k: int = config.GENRE_TOP_K, match: str = "substring") -> DataFrame:
    """Sink form: ``genres, recs array<struct<mid,score>>``."""
    return nest_ranked(genre_top(movies, ratings, genres, k, match), "genres")


def movie_tags(tags: DataFrame) -> DataFrame:
    """``mid, tags``: distinct tags of a movie, sorted, joined by ``|``.

    ``collect_set`` aggregates partially in each task, so only per-task sets
    of distinct tags are shuffled, one exchange keyed by ``mid``."""
    return tags.groupBy("mid").agg(
        F.concat_ws("|", F.array_sort(F.collect_set("tag"))).alias("tags"))


def search_documents(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Movie columns plus nullable ``tags`` (left join: untagged movies keep NULL)."""
    return movies.join(movie_tags(tags), ["mid"], "left")


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("uid").distinct()


def distinct_items(ratings: DataFrame) -> DataFrame:
    return ratings.select("mid").distinct()


def unrated_grid_size(ratings: DataFrame) -> DataFrame:
    """Per user: items rated and the size of the user's row of the
    user x item prediction grid without them -- from counts, never by
    materialising the grid.  The item total is a scalar subquery."""
    n_items = ratings.select(F.count_distinct("mid")).scalar()
    per_user = ratings.groupBy("uid").agg(F.count_distinct("mid").alias("n_rated"))
    return per_user.select("uid", "n_rated", (n_items - F.col("n_rated")).alias("n_unrated"))
