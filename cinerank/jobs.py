"""The jobs of the system, each reading and writing named tables.

    loader      text files -> Movie, Rating, Tag (+ rejects), MovieWithTags
    statistics  RateMoreMovies, RateMoreRecentMovies, AverageMovies, GenresTopMovies
    offline     ALS -> MovieRecs (similar items > 0.6, long ranked form), UserRecs (top 20)
    content     ContentMovieRecs (TF-IDF cosine, long ranked form)
    logfilter   raw log stream -> rating-message stream (key, value)
    streaming   rating-message stream -> StreamRecs (per user, per micro-batch)
    compact     merges the streaming tables' batches while no query writes them

Run one with ``python -m cinerank.jobs <job> --root <table root> [...]``;
cluster settings come from spark-submit, not from code.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank import config, schemas
from cinerank.config import TableStore
from cinerank.operators import collab, content, realtime, similarity, stats
from cinerank.operators.topk import by_score, nest_ranked, rank_within
from cinerank.sources import delimited, tables
from cinerank.streaming import logs, recommender, sources

MOVIE, RATING, TAG = "Movie", "Rating", "Tag"
RATING_BY_USER = "RatingByUser"       # what the streaming job reads
# Secondary access paths: a copy of a table laid out for reads by one key.
ACCESS_PATHS = {"MovieByMid": (MOVIE, schemas.MOVIE, "mid"), RATING_BY_USER: (RATING, schemas.RATING, "uid"),
                "RatingByMid": (RATING, schemas.RATING, "mid"), "TagByUser": (TAG, schemas.TAG, "uid"),
                "TagByMid": (TAG, schemas.TAG, "mid")}
MOVIE_WITH_TAGS = "MovieWithTags"
RATE_MORE, RATE_MORE_RECENT, AVERAGE, GENRES_TOP = (
    "RateMoreMovies", "RateMoreRecentMovies", "AverageMovies", "GenresTopMovies")
MOVIE_RECS, USER_RECS, CONTENT_RECS = "MovieRecs", "UserRecs", "ContentMovieRecs"
ITEM_FACTORS = "ItemFactors"           # mid, features: scores a user's pairs while streaming
STREAM_RECS, RATING_LOG, STREAM_REJECTS, STREAM_PROGRESS = "StreamRecs", "RatingLog", "StreamRejects", "StreamProgress"


def loader(spark: SparkSession, movies_path: str, ratings_path: str, tags_path: str, store: TableStore,
           strict: bool = False) -> None:
    """Parse the three text inputs, write the typed tables and the rejected
    lines, then build the search documents from the written tables."""
    for name, path, layout in ((MOVIE, movies_path, delimited.MOVIES), (RATING, ratings_path, delimited.RATINGS),
                               (TAG, tags_path, delimited.TAGS)):
        good, rejected = delimited.read_delimited(spark, path, layout, strict=strict)
        tables.write_table(good, name, store)
        if not strict:
            tables.write_table(rejected, f"{name}Rejects", store)
    write_access_paths(spark, store)
    movies = tables.read_table(spark, MOVIE, store, schemas.MOVIE)
    tags = tables.read_table(spark, TAG, store, schemas.TAG)
    tables.upsert_documents(stats.search_documents(movies, tags), "mid", MOVIE_WITH_TAGS, store)


def write_access_paths(spark: SparkSession, store: TableStore, names=tuple(ACCESS_PATHS)) -> None:
    for name in names:
        table, schema, key = ACCESS_PATHS[name]
        tables.write_by_key(tables.read_table(spark, table, store, schema), name, store, key)


def statistics(spark: SparkSession, store: TableStore, genres=config.DEFAULT_GENRES,
               k: int = config.GENRE_TOP_K, match: str = "substring") -> None:
    movies = tables.read_table(spark, MOVIE, store, schemas.MOVIE)
    ratings = tables.read_table(spark, RATING, store, schemas.RATING)
    tables.write_table(stats.most_rated(ratings), RATE_MORE, store)
    tables.write_table(stats.monthly_counts(ratings), RATE_MORE_RECENT, store)
    tables.write_table(stats.best_rated(ratings), AVERAGE, store)
    tables.write_table(stats.genre_top_nested(movies, ratings, genres, k, match), GENRES_TOP, store)


LIST_K, LIST_MIN_SCORE = "list_k", "list_min_score"
DEFAULT_K = 200          # entries of a similarity list unless asked otherwise; None keeps whole lists


def write_similarity(ranked: DataFrame, name: str, store: TableStore, k: int | None,
                     min_score: float | None = None, run: str | None = None) -> None:
    """Similarity lists are stored long and ranked (``mid, rank, rec_mid,
    score``), which any list length fits; the nested one-row-per-movie form
    is written as ``<name>Nested`` only when lists are bounded by ``k``.
    Every row also says how its table was cut: ``list_k`` (null: not at all)
    and, for lists made from ItemFactors, their threshold ``list_min_score``.
    ``run`` names what the lists were made in, with the factors they belong to."""
    if k is not None and k < 1:
        raise ValueError("a list length k must be at least 1")

    def marked(df: DataFrame) -> DataFrame:
        return df.select("*", F.lit(k).cast("int").alias(LIST_K), F.lit(min_score).cast("double").alias(LIST_MIN_SCORE))
    # the nested form first: who follows the long one finds both
    if k is not None:
        tables.write_table(marked(similarity.nest_similarity(ranked)), f"{name}Nested", store, properties={"run": run})
    tables.write_table(marked(ranked.select("mid", F.col("rank").cast("int"), "rec_mid", "score")), name, store,
                       properties={"run": run})


def list_cut(spark: SparkSession, store: TableStore, name: str) -> tuple[int, float | None] | None:
    """(k, threshold) of a similarity table cut to k entries a list; None where it is
    whole.  A table that does not say is an error: its lists may be cut."""
    df = tables.read_table(spark, name, store)
    if LIST_K not in df.columns:
        raise ValueError(f"{name} does not say whether its lists are cut ({LIST_K}): write it with write_similarity")
    row = df.select(LIST_K, LIST_MIN_SCORE).first()
    if row is None or row[0] is None:
        return None
    return int(row[0]), None if row[1] is None else float(row[1])


def offline(spark: SparkSession, store: TableStore, min_score: float = config.SIM_LIST_THRESHOLD,
            user_k: int = config.USER_RECS_K, item_k: int | None = DEFAULT_K, blocks: int | None = None,
            by_length: bool = False) -> None:
    """ALS: ItemFactors, MovieRecs (the top ``item_k`` above ``min_score``; None: every pair, a
    table that grows with the square of the catalogue) and UserRecs (top ``user_k`` per user,
    nested; ``by_length``: found by :func:`collab.recs_by_length`)."""
    ratings = tables.read_table(spark, RATING, store, schemas.RATING)
    model = collab.train(ratings, blocks=blocks)
    run = uuid.uuid4().hex
    tables.write_table(collab.item_factors(model), ITEM_FACTORS, store, properties={"run": run})
    write_similarity(collab.item_similarity(model, min_score, item_k), MOVIE_RECS, store, item_k, min_score, run)
    tables.write_table(collab.user_recs(model, user_k, by_length).transform(_nest_users), USER_RECS, store)


def _nest_users(df: DataFrame) -> DataFrame:
    return nest_ranked(df, "uid")


def content_job(spark: SparkSession, store: TableStore, k: int | None = DEFAULT_K, hashed: bool = False,
                include_zero: bool = False) -> None:
    """Content similarity lists; exact vocabulary by default (``k`` = list
    length, ``None`` keeps every positive pair), or the hashed 50-bucket path.
    ``include_zero`` (bounded ``k`` only) completes short lists with
    zero-score movies."""
    if include_zero and k is None:
        raise ValueError("include_zero needs a list length k")
    movies = tables.read_table(spark, MOVIE, store, schemas.MOVIE)
    if hashed and k is None:
        ranked = similarity.dense_similarity(content.hashed_tfidf(movies), min_score=0.0)
    elif hashed:
        ranked = content.hashed_content_similarity(movies, k=k, include_zero=include_zero)
    elif k is None:
        weights = content.tfidf_terms(movies).select("mid", "term", F.col("tfidf").alias("w"))
        pairs = similarity.sparse_pairs(weights)
        ranked = rank_within(pairs, ["mid"], by_score("score", "rec_mid"))
    else:
        ranked = content.content_similarity(movies, k=k, include_zero=include_zero)
    write_similarity(ranked, CONTENT_RECS, store, k)


def similarity_long(spark: SparkSession, store: TableStore, name: str = MOVIE_RECS) -> DataFrame:
    """A similarity table as ``mid, rank, rec_mid, score`` (S6): the stored
    long form as is, or a nested table exploded (lists are in rank order)."""
    df = tables.read_table(spark, name, store)
    if "recs" not in df.columns:
        return tables.conform(df, schemas.RANKED_SIMILARITY)
    return df.select(F.col("mid").alias("src"), F.posexplode("recs").alias("pos", "r")).select(
        F.col("src").alias("mid"), (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("r.mid").alias("rec_mid"), F.col("r.score").alias("score"))


def logfilter(spark: SparkSession, source_format: str, source_path: str | None, sink_format: str,
              sink_path: str | None, checkpoint: str, source_options: dict | None = None,
              sink_options: dict | None = None, available_now: bool = False):
    return logs.start_republisher(spark, source_format, source_path, sink_format, sink_path, checkpoint,
                                  source_options, sink_options, available_now)


class Followed:
    """The static sides of the streaming job as the tables have them now.  Called before every
    micro-batch: a newer snapshot of the lists, the factors or the base ratings is taken over
    from the next batch on, lists and factors together (both of one offline run)."""

    def __init__(self, spark: SparkSession, store: TableStore, sim_table: str, factors_table: str | None, with_base: bool):
        self.spark, self.store, self.with_base = spark, store, with_base
        self.sim_table, self.factors_table = sim_table, factors_table
        self.versions: tuple | None = None
        self.sides: recommender.Sides | None = None
        self.cached: list[DataFrame] = []

    def _versions(self) -> tuple:
        asked = [self.sim_table, self.factors_table or ITEM_FACTORS, *([RATING_BY_USER] if self.with_base else [])]
        return tuple(tables.version_of(self.spark, name, self.store) for name in asked)

    def __call__(self) -> recommender.Sides:
        now = self._versions()
        if self.sides is None or now != self.versions and self._of_one_run():
            old, self.cached = self.cached, []
            self.sides, self.versions = self._load(), now
            for df in old:
                df.unpersist()
        return self.sides

    def _of_one_run(self) -> bool:
        """Whether lists and factors belong together: an offline run writes one after the other."""
        runs = [tables.properties_of(self.spark, name, self.store).get("run") for name in (self.sim_table, self.factors_table or ITEM_FACTORS)]
        return None in runs or runs[0] == runs[1]

    def _load(self) -> recommender.Sides:
        factors, cut = self.factors_table, list_cut(self.spark, self.store, self.sim_table)
        if cut is not None:
            if cut[1] is None:
                raise ValueError(f"{self.sim_table} is cut to {cut[0]} entries a list and was not made from {ITEM_FACTORS}: "
                                 "write it without a list length")
            factors = factors or ITEM_FACTORS
        # read once for all micro-batches until they change (MEMORY_AND_DISK; a lost block is
        # re-read from the snapshot)
        vectors = self._kept(tables.read_table(self.spark, factors, self.store)) if factors else None
        sim = self._kept(similarity_long(self.spark, self.store, self.sim_table))
        if cut is not None:
            cut = realtime.list_cut(sim, *cut, vectors, self._kept(similarity.item_blocks(vectors)), self._kept)
        base = None
        if self.with_base:
            r = tables.read_table(self.spark, RATING_BY_USER, self.store)
            base_id = -F.abs(F.xxhash64("uid", "mid", "score", "timestamp") % F.lit(1 << 62)) - 1
            base = r.select(base_id.alias("event_id"), F.timestamp_seconds("timestamp").alias("ts"), "uid", "mid", "score", "timestamp")
        return recommender.Sides(sim, vectors, cut, base)

    def _kept(self, df: DataFrame) -> DataFrame:
        self.cached.append(df.persist())
        return self.cached[-1]


def stream_tables(store: TableStore, **how) -> recommender.StreamTables:
    return recommender.StreamTables(store.path(RATING_LOG), store.path(STREAM_RECS), store.path(STREAM_REJECTS),
                                    store.path(STREAM_PROGRESS), **how)


def streaming(spark: SparkSession, store: TableStore, source_format: str, source_path: str | None,
              checkpoint: str, source_options: dict | None = None, available_now: bool = False,
              threshold: float = config.SIM_SCORE_THRESHOLD, sim_table: str = MOVIE_RECS,
              with_base_ratings: bool = True, factors_table: str | None = None, fanout: int = recommender.FANOUT):
    """Start the streaming recommender; returns the query handle (the caller
    awaits it).  The base Rating table, laid out by user, is part of every user's
    history (a negative, content-derived ``event_id`` that orders below every
    stream id; event time from its epoch seconds).

    Candidates come from ``sim_table``.  With ``factors_table`` (``ItemFactors`` of the
    offline job) similarities of a user's pairs are computed from the factors, so no pair
    is missing; without it they are looked up in ``sim_table``.  Where the offline job cut
    the table to k entries a list (``--k``), the factors are always used, also to complete
    the candidates of users whose list ran out; a cut table of other lists, or one that does
    not say, is an error.  The tables may be refreshed while the query runs (:class:`Followed`)."""
    sides = Followed(spark, store, sim_table, factors_table, with_base_ratings)
    sides()                                  # errors of the tables show at the start
    src = sources.message_stream(spark, source_format, source_path, source_options)
    return recommender.start_recommender(spark, src, sides, stream_tables(store, fanout=fanout), checkpoint,
                                         available_now=available_now, threshold=threshold)


def compact(spark: SparkSession, store: TableStore, fanout: int = recommender.FANOUT) -> int:
    """Merge what is due of the streaming tables while no query writes them.  (A running query
    merges its tables itself.)"""
    return sum(t.compact(spark) for t in stream_tables(store, fanout=fanout).all())


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="cinerank.jobs")
    p.add_argument("job", choices=["loader", "statistics", "offline", "content", "logfilter", "streaming", "compact"])
    p.add_argument("--root", required=True, help="table root (any Hadoop-compatible path)")
    p.add_argument("--format", default="parquet")
    p.add_argument("--movies")
    p.add_argument("--ratings")
    p.add_argument("--tags")
    p.add_argument("--strict", action="store_true")
    p.add_argument("--source-format", default="kafka")
    p.add_argument("--source-path")
    p.add_argument("--sink-format", default="kafka")
    p.add_argument("--sink-path")
    p.add_argument("--checkpoint", help="default: <root>/_checkpoints/<job>")
    p.add_argument("--factors", default=ITEM_FACTORS, help="streaming: table of item vectors ('' = look pairs up, unless lists are cut)")
    p.add_argument("--option", action="append", default=[], help="source option key=value")
    p.add_argument("--sink-option", action="append", default=[], help="sink option key=value")
    p.add_argument("--k", type=int, default=DEFAULT_K, help="similarity list length (offline/content); 0: whole lists")
    p.add_argument("--min-score", type=float, default=config.SIM_LIST_THRESHOLD,
                   help="offline similarity threshold (strict)")
    p.add_argument("--hashed", action="store_true", help="content: hashed 50-bucket features")
    p.add_argument("--include-zero", action="store_true", help="content: fill short lists with zero scores")
    p.add_argument("--score-threshold", type=float, default=config.SIM_SCORE_THRESHOLD,
                   help="streaming: similarity threshold of the priority formula (strict)")
    p.add_argument("--blocks", type=int, default=None, help="offline: ALS blocks (part of the model's definition); 10, or more with very many ratings")
    p.add_argument("--by-length", action="store_true", help="offline: recommendations from the longest item factors on, until none can be higher")
    p.add_argument("--fanout", type=int, default=recommender.FANOUT, help="streaming, compact: batches or segments merged at a time")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"cinerank-{a.job}").getOrCreate()
    store = TableStore(a.root, a.format)
    opts = dict(o.split("=", 1) for o in a.option)
    sink_opts = dict(o.split("=", 1) for o in a.sink_option)
    if a.job == "loader":
        loader(spark, a.movies, a.ratings, a.tags, store, strict=a.strict)
    elif a.job == "statistics":
        statistics(spark, store)
    elif a.job == "offline":
        offline(spark, store, min_score=a.min_score, item_k=a.k or None, blocks=a.blocks, by_length=a.by_length)
    elif a.job == "content":
        content_job(spark, store, k=a.k or None, hashed=a.hashed, include_zero=a.include_zero)
    elif a.job == "logfilter":
        logfilter(spark, a.source_format, a.source_path, a.sink_format, a.sink_path,
                  a.checkpoint or store.path("_checkpoints/logfilter"), opts, sink_opts).awaitTermination()
    elif a.job == "compact":
        compact(spark, store, a.fanout)
    else:
        streaming(spark, store, a.source_format, a.source_path,
                  a.checkpoint or store.path("_checkpoints/streaming"), opts,
                  threshold=a.score_threshold, factors_table=a.factors or None, fanout=a.fanout).awaitTermination()


if __name__ == "__main__":
    main()
