"""Registered queries: name -> ``fn(spark, sf_dir) -> DataFrame``.

Each query reads the whole test tables (through :mod:`cinerank.sources.testdata`)
and runs the library's own operators on them.  Result columns are flat and
named to match the SQL oracle in :mod:`cinerank.plans.oracle`; nested sink
forms are available from the operator modules.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cinerank import config, jobs, schemas
from cinerank.config import TableStore, materialize, parallelism, scratch_dir
from cinerank.functions.columns import cosine, round_score
from cinerank.operators import collab, content, realtime, similarity, stats
from cinerank.operators.blocktop import near_cells
from cinerank.sources import delimited, tables
from cinerank.sources import testdata as td
from cinerank.streaming import logs, recommender, sources, state

# Parameters of the test vocabulary (the defaults stay the reference's).
FIXTURE_GENRES = ("ECONOMY", "Promo", "standard", "gear", "ring", "rod", "widget", "gizmo", "old", "small", "War")
DENSE_LIST_THRESHOLD = 0.25     # embeddings never reach 0.6
L1L2_THRESHOLD = 0.03
REALTIME_MATRIX_THRESHOLD = 0.10
REALTIME_LIST_K = 100
REALTIME_SCORE_THRESHOLD = 0.15
CONTENT_K = 10
ALS_SIM_K = 20


# ---------------------------------------------------------------- ingest
def load_movies(spark: SparkSession, d: str) -> DataFrame:
    lines = delimited.render(td.movies(spark, d), delimited.MOVIES)
    good, _ = delimited.parse_lines(lines, delimited.MOVIES)
    return good


def load_ratings(spark: SparkSession, d: str) -> DataFrame:
    lines = delimited.render(td.ratings(spark, d), delimited.RATINGS)
    good, _ = delimited.parse_lines(lines, delimited.RATINGS)
    return good


def load_tags(spark: SparkSession, d: str) -> DataFrame:
    lines = delimited.render(td.tags(spark, d), delimited.TAGS)
    good, _ = delimited.parse_lines(lines, delimited.TAGS)
    return good


def damaged_rating_lines(spark: SparkSession, d: str) -> DataFrame:
    """Rating lines from the events, some damaged by a fixed rule (input only)."""
    r = td.rating_events(spark, d)
    u, m, s, t = (F.col(c).cast("string") for c in ("uid", "mid", "score", "timestamp"))
    sel = F.col("event_id") % 11
    value = (F.when(sel == 1, F.concat_ws(",", F.concat(F.lit("u"), u), m, s, t))
             .when(sel == 2, F.concat_ws(",", u, m, s))
             .when(sel == 3, F.concat_ws(",", u, m, F.lit("bad"), t))
             .when(sel == 4, F.concat_ws(",", u, m, s, F.lit("")))
             .when(sel == 5, F.concat_ws(",", u, m, s, t, F.lit("extra")))
             .when(sel == 6, F.concat_ws(",", u, F.lit(""), s, t))
             .otherwise(F.concat_ws(",", u, m, s, t)))
    return r.select(value.alias("value"))


def ingest_rejects(spark: SparkSession, d: str) -> DataFrame:
    parsed = delimited.classify(damaged_rating_lines(spark, d), delimited.RATINGS)
    return parsed.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- statistics
def movie_search_docs(spark, d):
    return stats.search_documents(td.movies(spark, d), td.tags(spark, d))


def most_rated(spark, d):
    return stats.most_rated(td.ratings(spark, d))


def most_rated_by_month(spark, d):
    return stats.monthly_counts_sql(spark, td.ratings(spark, d))


def recent_popular_as_written(spark, d):
    return stats.monthly_counts_as_written(td.ratings(spark, d))


def avg_score(spark, d):
    return stats.best_rated(td.ratings(spark, d))


def genre_top10(spark, d):
    return stats.genre_top(td.movies(spark, d), td.ratings(spark, d), FIXTURE_GENRES, config.GENRE_TOP_K)


def distinct_users(spark, d):
    return stats.distinct_users(td.ratings(spark, d))


def distinct_items(spark, d):
    return stats.distinct_items(td.ratings(spark, d))


def user_item_grid_count(spark, d):
    return stats.unrated_grid_size(td.ratings(spark, d))


# ---------------------------------------------------------------- similarity
def item_similarity_dense(spark, d):
    return similarity.dense_similarity(td.item_vectors(spark, d), metric="cosine", min_score=DENSE_LIST_THRESHOLD)


def item_similarity_l1l2(spark, d):
    return similarity.dense_similarity(td.item_vectors(spark, d), metric="l1l2", min_score=L1L2_THRESHOLD)


_MODELS: dict[tuple[str, str], ALSModel] = {}


def _model(spark, d) -> ALSModel:
    """The ALS model of the ratings in ``d``, trained once a session: the queries below look at
    the same one."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _MODELS:
        _MODELS[key] = collab.train(td.ratings(spark, d))
    return _MODELS[key]


def als_item_similarity(spark, d):
    model = _model(spark, d)
    return collab.item_similarity(model, min_score=config.SIM_LIST_THRESHOLD, k=ALS_SIM_K)


def als_user_recs(spark, d):
    return collab.user_recs(_model(spark, d), config.USER_RECS_K)


def als_predict(spark, d):
    r = td.ratings(spark, d)
    return collab.predict(_model(spark, d), r)


def tfidf_terms(spark, d):
    t = content.tfidf_terms(td.movies(spark, d))
    return t.select("mid", "term", "tf", "df", round_score("idf").alias("idf"), round_score("tfidf").alias("tfidf"))


def content_similarity(spark, d):
    return content.content_similarity(td.movies(spark, d), k=CONTENT_K)


def content_similarity_with_zeros(spark, d):
    """Top-10 content neighbours as the reference's full lists rank them:
    pairs sharing no term score 0 and still fill a short list."""
    return content.content_similarity(td.movies(spark, d), k=CONTENT_K, include_zero=True)


def content_similarity_hashed(spark, d):
    return content.hashed_content_similarity(td.movies(spark, d), k=CONTENT_K)


def hashed_tfidf_checks(spark, d):
    """Per movie: tokens hashed, and whether its vector is bucket counts times the idf that the
    numbers of movies in each bucket give (M6, X14)."""
    movies = td.movies(spark, d)
    counts, vectors = content.hashed_counts(movies), content.hashed_tfidf(movies)
    n_movies = movies.select(F.count(F.lit(1))).scalar()
    df = counts.select(F.posexplode(vector_to_array("raw")).alias("bucket", "tf")).groupBy("bucket").agg(
        F.count_if(F.col("tf") > 0).alias("df"))
    idf = df.select("bucket", F.log((n_movies + 1) / (F.col("df") + 1)).alias("idf"))
    idf = idf.agg(F.sort_array(F.collect_list(F.struct("bucket", "idf")))["idf"].alias("idf"))       # one row: an entry a bucket
    # movie by movie, not cell by cell: cells are many times larger than Spark takes them for, and
    # were broadcast
    met = counts.select("mid", vector_to_array("raw").alias("tf")).join(vectors.hint("merge"), "mid").crossJoin(F.broadcast(idf))
    right = F.forall(F.arrays_zip("tf", "idf", F.col("features").alias("w")), lambda x: F.abs(x["tf"] * x["idf"] - x["w"]) < 1e-9)
    per = met.select("mid", F.aggregate("tf", F.lit(0.0), lambda s, x: s + x).alias("n_tokens"), F.size("tf").alias("n_buckets"), right.alias("ok"))
    return per.groupBy("mid").agg(F.sum("n_tokens").cast("long").alias("n_tokens"), F.sum("n_buckets").cast("long").alias("n_buckets"),
                                  F.every("ok").alias("ok"))


# ---------------------------------------------------------------- real time (batch form)
def _ranked_lists(spark, d) -> tuple[DataFrame, realtime.ListCut]:
    """The ranked item-similarity lists the real-time path reads (``mid, rank, rec_mid,
    score``), cut to REALTIME_LIST_K entries, and what longer lists are completed from.  Only
    items that someone rated can trigger, so only they have lists."""
    vectors = td.item_vectors(spark, d)
    blocks = materialize(similarity.item_blocks(vectors), "item-blocks")
    rated = td.rating_events(spark, d).select("mid").distinct().withColumn("bound", F.lit(REALTIME_LIST_K))
    lists = materialize(similarity.lists_of(rated, vectors, blocks, REALTIME_MATRIX_THRESHOLD), "item-lists")
    return lists, realtime.list_cut(lists, REALTIME_LIST_K, REALTIME_MATRIX_THRESHOLD, vectors, blocks, materialize)


def recent_ratings(spark, d):
    return realtime.recent_ratings(td.rating_events(spark, d), config.RECENT_RATINGS_K)


def candidate_items(spark, d):
    ev = td.rating_events(spark, d)
    triggers = realtime.latest_per_user(ev).select("uid", "mid")
    lists, cut = _ranked_lists(spark, d)
    cands = realtime.candidate_items(triggers, lists, ev, config.CANDIDATES_K)
    return realtime.completed_candidates(cands, triggers, ev, cut, config.CANDIDATES_K)


def realtime_scores(spark, d):
    ev = td.rating_events(spark, d)
    triggers = realtime.latest_per_user(ev).select("uid", "mid")
    lists, cut = _ranked_lists(spark, d)
    # every user triggers here, so the history needs no restriction; the lists give
    # the candidates only, pair similarities come from the vectors
    return realtime.score_batch(triggers, ev, lists, config.RECENT_RATINGS_K,
                                config.CANDIDATES_K, REALTIME_SCORE_THRESHOLD, restrict=False,
                                vectors=cut.vectors, cut=cut)


# ---------------------------------------------------------------- streaming
def log_filter(spark, d):
    return logs.extract_messages(td.log_lines(spark, d), keep=("event_id",))


MESSAGES_A_FILE = 1_000_000


def _stream_input(spark, d, root: str, from_logs: bool) -> str:
    """Write rating messages as files of at most about MESSAGES_A_FILE, at least three, one
    per event-time range, in one job (stand-in for the rating topic); the queries read one file
    per trigger, so the stream arrives in several bounded micro-batches.  Their order is
    not relied on: the streaming job's result does not depend on it.
    ``from_logs`` takes the messages the log filter publishes (malformed ones
    included), otherwise every rating event is rendered as a message."""
    ev = td.rating_events(spark, d)
    if from_logs:
        msgs = logs.extract_messages(td.log_lines(spark, d), keep=("event_id",)).join(
            ev.select("event_id", "ts"), "event_id")
    else:
        msgs = ev.select("event_id", "ts", delimited.render_column(delimited.MESSAGES).alias("message"))
    chunks = max(3, math.ceil(ev.count() / MESSAGES_A_FILE))
    (msgs.select("event_id", "ts", F.col("message").alias("value"))
         .repartitionByRange(chunks, "ts", "event_id").write.mode("overwrite").parquet(f"{root}/in/all"))
    return f"{root}/in/*/*.parquet"


def rating_stream_parse(spark, d):
    root = scratch_dir(spark, "parse")
    pattern = _stream_input(spark, d, root, from_logs=True)
    src = sources.message_stream(spark, "parquet", pattern, {"maxFilesPerTrigger": "1"})
    good, _ = recommender.parse_stream(src, keep=("event_id",))
    q = (good.writeStream.format("parquet").option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).start(f"{root}/out"))
    q.awaitTermination()
    return spark.read.schema("event_id long, uid int, mid int, score double, `timestamp` int").parquet(f"{root}/out")


def _run_stream(spark, d, kind: str, from_logs: bool) -> recommender.StreamTables:
    """The streaming recommender over all messages, as a query that ends."""
    root = scratch_dir(spark, kind)
    pattern = _stream_input(spark, d, root, from_logs)
    lists, cut = _ranked_lists(spark, d)
    src = sources.message_stream(spark, "parquet", pattern, {"maxFilesPerTrigger": "1"})
    t = recommender.StreamTables(f"{root}/RatingLog", f"{root}/StreamRecs", f"{root}/Rejects", f"{root}/Progress", fanout=2)
    q = recommender.start_recommender(spark, src, lists, t, f"{root}/ckpt", available_now=True,
                                      threshold=REALTIME_SCORE_THRESHOLD, vectors=cut.vectors, cut=cut)
    q.awaitTermination()
    return t


def stream_recs(spark, d):
    return tables.explode_recs(recommender.current_recs(spark, _run_stream(spark, d, "stream", from_logs=False).recs), "uid")


def stream_progress(spark, d):
    """What the recorded progress of all micro-batches says was read, rejected and scored (G8)."""
    t = _run_stream(spark, d, "progress", from_logs=True)
    p = t.progress.read(spark).agg(F.sum("n_messages").alias("n_messages"), F.sum("n_rejected").alias("n_rejected"),
                                   F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    users = recommender.current_recs(spark, t.recs).select(F.count(F.lit(1))).scalar()
    return p.select("n_messages", "n_rejected", F.unix_seconds("first_ts").alias("first_second"),
                    F.unix_seconds("last_ts").alias("last_second"), users.alias("n_users"))


def recent_ratings_stream(spark, d):
    """Last-20 lists kept in keyed streaming state, fed by the rating stream."""
    root = scratch_dir(spark, "state")
    pattern = _stream_input(spark, d, root, from_logs=False)
    src = sources.message_stream(spark, "parquet", pattern, {"maxFilesPerTrigger": "1"})
    good, _ = recommender.parse_stream(src)
    out = f"{root}/lists"

    def write(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out)

    q = (state.recent_ratings_state(good, config.RECENT_RATINGS_K).writeStream.outputMode("update")
         .foreachBatch(write).option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return state.current_lists(spark, out)


def table_roundtrip(spark, d):
    store = TableStore(scratch_dir(spark, "tables"))
    movies, ratings, tags_df = td.movies(spark, d), td.ratings(spark, d), td.tags(spark, d)
    tables.write_table(movies, "Movie", store)
    tables.write_table(ratings, "Rating", store)
    tables.write_table(tags_df, "Tag", store)
    m = tables.read_table(spark, "Movie", store, schemas.MOVIE)
    r = tables.read_table(spark, "Rating", store, schemas.RATING)
    tables.write_table(stats.average_scores(r), "AverageMovies", store)
    tables.write_table(stats.genre_top_nested(m, r, FIXTURE_GENRES), "GenresTopMovies", store)
    nested = tables.read_table(spark, "GenresTopMovies", store, schemas.GENRE_RECS)
    return spark.sql("SELECT genres, pos + 1 AS rank, rec.mid AS mid, rec.score AS score "
                     "FROM {g} LATERAL VIEW posexplode(recs) AS pos, rec", g=nested)


def rating_republish(spark, d):
    root = scratch_dir(spark, "republish")
    td.log_lines(spark, d).select("value").write.mode("overwrite").text(f"{root}/in")
    q = logs.start_republisher(spark, "text", f"{root}/in", "parquet", f"{root}/out", f"{root}/ckpt",
                               source_options={"maxFilesPerTrigger": "4"}, available_now=True)
    q.awaitTermination()
    return spark.read.schema("key string, value string").parquet(f"{root}/out")


def rated_layout(spark, d):
    store = TableStore(scratch_dir(spark, "layout"))
    tables.write_by_key(td.ratings(spark, d), "RatingByUser", store, "uid")
    r = tables.read_table(spark, "RatingByUser", store, schemas.RATING)
    return r.groupBy("uid").agg(F.count(F.lit(1)).alias("n_ratings"), round_score(F.avg("score")).alias("avg_score"))


KEYED_READS = 20


def keyed_reads(spark, d):
    """Rows of the KEYED_READS smallest users and movies, read by key from all access paths (K2)."""
    store = TableStore(scratch_dir(spark, "paths"))
    for name, df in (("Movie", td.movies(spark, d)), ("Rating", td.ratings(spark, d)), ("Tag", td.tags(spark, d))):
        tables.write_table(df, name, store)
    jobs.write_access_paths(spark, store)
    out = None
    for name, (_, schema, key) in jobs.ACCESS_PATHS.items():
        rows = tables.read_table(spark, name, store, schema)
        keys = rows.select(key).distinct().orderBy(key).limit(KEYED_READS)
        one = tables.of_keys(rows, keys, key).groupBy(F.lit(name).alias("path"), F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- sinks read back
def search_docs_table(spark, d):
    """Search documents written by the keyed upsert and read back (K3)."""
    store = TableStore(scratch_dir(spark, "docs"))
    docs = stats.search_documents(td.movies(spark, d), td.tags(spark, d))
    tables.upsert_documents(docs, "mid", "MovieWithTags", store)
    return tables.read_table(spark, "MovieWithTags", store, schemas.MOVIE_WITH_TAGS)


def content_recs_table(spark, d):
    """ContentMovieRecs nested, written, read back and exploded (K5)."""
    store = TableStore(scratch_dir(spark, "recs"))
    ranked = content.content_similarity(td.movies(spark, d), k=CONTENT_K)
    tables.write_table(similarity.nest_similarity(ranked), "ContentMovieRecs", store)
    nested = tables.read_table(spark, "ContentMovieRecs", store, schemas.MOVIE_RECS)
    return nested.select(F.col("mid").alias("src"), F.posexplode("recs")).select(
        F.col("src").alias("mid"), (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("col.mid").alias("rec_mid"), F.col("col.score").alias("score"))


def content_recs_map(spark, d):
    """Nested lists as maps item -> score, exploded again (A7)."""
    nested = similarity.nest_similarity(content.content_similarity(td.movies(spark, d), k=CONTENT_K))
    return tables.recs_as_map(nested, "mid").select("mid", F.explode("sims").alias("rec_mid", "score"))


def average_and_tags_tables(spark, d):
    """Tag and AverageMovies written, read back, and counted by movie (K1, K4)."""
    store = TableStore(scratch_dir(spark, "avg"))
    tables.write_table(td.tags(spark, d), "Tag", store)
    tables.write_table(stats.average_scores(td.ratings(spark, d)), "AverageMovies", store)
    tags = tables.read_table(spark, "Tag", store, schemas.TAG).groupBy("mid").agg(F.count(F.lit(1)).alias("n_tags"))
    avg = tables.read_table(spark, "AverageMovies", store, schemas.AVERAGES)
    return avg.join(tags, "mid", "left").select("mid", round_score("avg").alias("avg"), F.coalesce("n_tags", F.lit(0)).alias("n_tags"))


def recent_lists_import(spark, d):
    """Per-user lists as ``uid:<UID>`` / ``MID:SCORE`` texts, parsed back (S12)."""
    recent = realtime.recent_ratings(td.rating_events(spark, d), config.RECENT_RATINGS_K)
    item = F.concat_ws(":", F.col("mid").cast("string"), F.col("score").cast("string"))
    lists = recent.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("rank", item.alias("item")))).alias("l")).select(
        F.concat(F.lit("uid:"), F.col("uid").cast("string")).alias("key"), F.col("l.item").alias("items"))
    return tables.parse_recent_lists(lists).withColumn("rank", F.col("rank").cast("int"))


def log_filter_bytes(spark, d):
    """The log filter over byte values, as a message bus delivers them (X18)."""
    lines = td.log_lines(spark, d).withColumn("value", F.col("value").cast("binary"))
    return logs.extract_messages(lines, keep=("event_id",))


# ---------------------------------------------------------------- ALS, checked from its factors
TOLERANCE = 2e-3         # factors are single precision


def _factors(model, spark) -> tuple[DataFrame, DataFrame]:
    """(uid, u) and (mid, v) with single-precision factors, written once."""
    users = materialize(model.userFactors.select(F.col("id").alias("uid"), F.col("features").alias("u")))
    items = materialize(model.itemFactors.select(F.col("id").alias("mid"), F.col("features").alias("v")))
    return users, items


def _double(name: str):
    """Factors move in single precision and are multiplied in double."""
    return F.col(name).cast("array<double>")


ROUNDING = 2e-6          # scores are rounded to 6 digits
CHECK_ROWS = 65536       # asking vectors of a block
LEAST_CHECK = 4096       # fewer cost more to start than to multiply
CHECK_CELLS = 1 << 22    # components of a block
CHECK_PART = 2048        # vectors met at a time where their lengths differ
CHECK_TABLE = 1 << 24    # entries of the table of angles made at a time
HELD = 1 << 20           # products held back before they are cut


def _parts(two: np.ndarray, reach: np.ndarray):
    """``order, starts, axes, widths``: the rows of ``two`` in parts met one after the other.  Where all
    are of one length a part holds rows of like directions, at most the angle ``widths`` from its
    axis (a part with an unsure axis: any); otherwise parts run from the longest on, without axes."""
    if len(two) < 2 * CHECK_PART or not 0 < reach.max() <= (1 + 1e-6) * reach.min():
        return np.argsort(-reach, kind="stable"), np.arange(0, len(two), CHECK_PART), None, None
    order, starts = near_cells(two)
    middle = np.add.reduceat(two[order], starts, axis=0)
    size = np.sqrt((middle * middle).sum(1))
    axes = middle / np.maximum(size, 1e-12)[:, None]
    part = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(two)]))
    away = np.arccos(np.clip(np.einsum("ij,ij->i", two[order], axes[part]) / reach[order], -1, 1))
    return order, starts, axes.astype("float32"), np.where(size > 1e-6 * reach.max(), np.maximum.reduceat(away, starts), np.pi)


def _highest(one: np.ndarray, two: np.ndarray, k: int, one_ids: np.ndarray | None = None, two_ids: np.ndarray | None = None,
             floors: np.ndarray | None = None) -> list[np.ndarray]:
    """The ``k`` highest products of each row of ``one`` with the rows of ``two``, highest first.
    With ids a row is not multiplied with the one of its own id (unique on each side).  A row's
    kth product so far holds back whatever is no higher, and at first ``floors``: what is not above
    a row's floor may be left out.  A row meets no part that its length or angle keeps below that."""
    reach, lengths = (np.sqrt((x * x).sum(1)) for x in (two, one))
    order, starts, axes, widths = _parts(two, reach)
    two, reach = two[order], reach[order]
    other, ends, longest = two.astype("float32"), np.r_[starts[1:], len(two)], reach.max(initial=0.0)
    slack = 1e-6 * lengths * longest            # single precision only holds back
    rows = 512 if axes is None else max(512, CHECK_TABLE // len(starts))
    turn, out = np.arange(len(one)) if axes is None else near_cells(one)[0], [np.empty(0)] * len(one)
    for s0 in range(0, len(one), rows):
        own = turn[s0:s0 + rows]
        part, low = one[own].astype("float32"), np.full(len(own), -np.inf) if floors is None else floors[own].astype(float)
        r, top, waiting, held = np.empty(0, int), np.empty(0), [], 0
        if axes is not None:
            long = np.where(lengths[own] > 0, lengths[own], 1.0)
            away = axes @ (part / long[:, None].astype("float32")).T
            away = np.arccos(np.clip(away, -1, 1, out=away), out=away)
            away -= widths[:, None].astype("float32")

        def reachable():
            return np.arccos(np.clip((low - slack[own]) / (long * longest), -1, 1)) + 2e-3
        open_to = reachable() if axes is not None else None
        for p, (c0, c1) in enumerate(zip(starts, ends)):
            if axes is None:
                at = np.flatnonzero(lengths[own] * reach[c0] + slack[own] >= low)      # no later row of two is longer
            else:
                at = np.flatnonzero(away[p] <= open_to)
            if len(at):
                raw = part[at] @ other[c0:c1].T
                if c0 == 0 and axes is None and c1 > k + 1:      # one more, which may be its own
                    low[at] = np.maximum(low[at], np.partition(raw, -k - 1, axis=1)[:, -k - 1] - 2 * slack[own][at])
                found = np.flatnonzero(raw >= (low[at] - slack[own][at])[:, None].astype("float32"))
                waiting.append((at[found // (c1 - c0)], c0 + found % (c1 - c0)))
                held += len(found)
            if waiting and (held > max(HELD, k * len(own)) or c1 == len(two)):
                x, y = (np.concatenate(v) for v in zip(*waiting))
                if one_ids is not None:
                    others = one_ids[own[x]] != two_ids[order[y]]
                    x, y = x[others], y[others]
                products = np.concatenate([np.einsum("ij,ij->i", one[own[x[v:v + HELD]]], two[y[v:v + HELD]]) for v in range(0, len(x), HELD)] or [np.empty(0)])
                r, top, waiting, held = np.r_[r, x], np.r_[top, products], [], 0
                best = np.lexsort((-top, r))
                r, top = r[best], top[best]
                rank = np.arange(len(r)) - np.searchsorted(r, r)
                low[r[rank == k - 1]] = np.maximum(low[r[rank == k - 1]], top[rank == k - 1])
                r, top = r[rank < k], top[rank < k]
                open_to = reachable() if axes is not None else None
        for i, found in zip(own, np.split(top, np.searchsorted(r, np.arange(1, len(own))))):
            out[i] = found
    return out


def _demanded(asking: DataFrame, items: DataFrame, k: int, above: float | None = None, own: bool = False) -> DataFrame:
    """What the vectors demand of every ``id``, by products of blocks of (id, vec) rows: its
    ``k`` highest products ``top``, and how many of these are above ``above``, at least and at most
    (within ROUNDING).  With ``own`` an id is not its own neighbour.  Where ``asking`` has a ``floor``,
    an id's products that are not above it may be missing: a list whose last score is claimed to be
    there has too few then, and one with a better entry left out shows it."""
    slots = parallelism(asking.sparkSession)
    if "floor" not in asking.columns:
        asking = asking.withColumn("floor", F.lit(float("-inf")))

    def blocks(rows: DataFrame, side: str, most: int, least: int) -> DataFrame:
        rows = materialize(rows, "check-vectors")
        n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("vec"))).first()
        n = max(1, math.ceil(n / max(1, min(most, CHECK_CELLS // max(1, width or 1)))), min(least, math.ceil(n / LEAST_CHECK)))
        listed = rows.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).alias(side)).agg(F.collect_list(F.struct(*rows.columns)).alias("rows"))
        floors = [F.col("rows.floor").alias("floors")] if "floor" in rows.columns else []
        return materialize(listed.select(side, F.col("rows.id").alias(f"{side}_ids"), F.flatten("rows.vec").alias(f"{side}_vecs"), *floors), "check-blocks")

    def multiply(batches):
        for pdf in batches:
            for a_ids, a, floors, b_ids, b in zip(*(pdf[c] for c in ("a_ids", "a_vecs", "floors", "b_ids", "b_vecs"))):
                a_ids, b_ids = np.asarray(a_ids), np.asarray(b_ids)
                one, two = (np.reshape(x, (len(ids), -1)).astype("float64") for x, ids in ((a, a_ids), (b, b_ids)))
                found = _highest(one, two, k, *((a_ids, b_ids) if own else (None, None)), floors=np.asarray(floors))
                yield pd.DataFrame({"id": a_ids, "top": found})
    two = blocks(items.select("id", "vec"), "b", CHECK_CELLS, 1)
    numbers = [r[0] for r in two.select("b").collect()]           # one a block
    one = blocks(asking.select("id", "vec", "floor"), "a", CHECK_ROWS, math.ceil(4 * slots / max(1, len(numbers))))
    # every block meets every other by its number, one pair to a row; the exploded side is larger
    # than Spark takes it for, so neither is broadcast
    pairs = one.select("*", F.explode(F.array(*map(F.lit, numbers)).cast("array<bigint>")).alias("b")).join(two.hint("merge"), "b").repartition(
        int(asking.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")
    parts = pairs.mapInPandas(multiply, "id int, top array<double>")
    whole = parts.groupBy("id").agg(F.slice(F.sort_array(F.flatten(F.collect_list("top")), False), 1, k).alias("top"))
    cut = float("-inf") if above is None else above
    return whole.select("id", "top", F.size(F.filter("top", lambda x: x > cut + ROUNDING)).alias("least"),
                        F.size(F.filter("top", lambda x: x > cut - ROUNDING)).alias("most"))


def als_normal_equations(spark, d):
    """Per user, whether the last half-step solved its normal equations: the gradient
    ``sum((u.v - r) v) + lambda n u`` vanishes against ``sum |r v|`` (M1, M2, P4)."""
    r = td.ratings(spark, d)
    users, items = _factors(_model(spark, d), spark)
    rows = collab.als_input(r).join(items, "mid").join(users, "uid")
    err = F.aggregate(F.zip_with(_double("u"), _double("v"), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x) - F.col("score")
    # a user's sums of every dimension, side by side: ratings are not multiplied by the rank
    rows = rows.select("uid", err.alias("err"), "score", _double("u").alias("u"), _double("v").alias("v"))
    dims = range(_model(spark, d).rank)
    sums = rows.groupBy("uid").agg(
        *(F.sum(F.col("err") * F.get("v", F.lit(i))).alias(f"g{i}") for i in dims), *(F.sum(F.get("u", F.lit(i))).alias(f"u{i}") for i in dims),
        *(F.sum(F.abs(F.col("score") * F.get("v", F.lit(i)))).alias(f"size{i}") for i in dims))
    grads = F.greatest(*(F.abs(F.col(f"g{i}") + collab.REG_PARAM * F.col(f"u{i}")) for i in dims))
    return sums.select("uid", (grads <= TOLERANCE * (1 + F.greatest(*(F.col(f"size{i}") for i in dims)))).alias("ok"))


def als_user_recs_checks(spark, d):
    """Per user: how many items are listed, and whether ranks run from 1, scores never
    rise, each is the product of the factors and no unlisted item scores higher (M4, T8)."""
    model = _model(spark, d)
    users, items = _factors(model, spark)
    recs = materialize(collab.user_recs(model, config.USER_RECS_K))
    prod = F.aggregate(F.zip_with(_double("u"), _double("v"), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    right = F.abs(prod - F.col("score")) <= TOLERANCE * (1 + F.abs("score"))
    listed = recs.join(users, "uid").join(items, "mid").groupBy("uid").agg(
        F.count(F.lit(1)).alias("n"), F.every(right).alias("right"),
        F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("l"))        # at most k entries
    falls = F.forall(F.sequence(F.lit(2), F.greatest(F.size("l"), F.lit(2))), lambda i: (i > F.size("l")) | (
        F.element_at("l", i - 1)["score"] >= F.get("l", i - 1)["score"]))
    first = (F.element_at("l", 1)["rank"] == 1) & (F.element_at("l", -1)["rank"] == F.size("l"))
    # the products above what a full list claims to be its last score; all where it is not full
    last = recs.groupBy("uid").agg(F.when(F.count(F.lit(1)) >= config.USER_RECS_K, F.min("score")).alias("kth"))
    floor = F.coalesce(F.col("kth") - TOLERANCE * (1 + F.abs("kth")), F.lit(float("-inf")))
    asking = users.join(last, "uid", "left").select(F.col("uid").alias("id"), F.col("u").alias("vec"), floor.alias("floor"))
    top = _demanded(asking, items.select(F.col("mid").alias("id"), F.col("v").alias("vec")), config.USER_RECS_K).select(F.col("id").alias("uid"), "top")
    last, due = F.element_at("l", -1)["score"], F.get("top", (F.col("n") - 1).cast("int"))
    whole = F.coalesce(F.abs(last - due) <= TOLERANCE * (1 + F.abs(due)), F.lit(False))
    return listed.join(top, "uid").select("uid", "n", (F.col("right") & falls & first & whole).alias("ok"))


def als_user_recs_by_length(spark, d):
    """Per user: how many items the search by length lists, and whether rank by rank the scores
    are those of the full products, and no user met more items than there are (M4, T8)."""
    model = _model(spark, d)
    lists, work = collab.recs_by_length(model, config.USER_RECS_K)
    full = collab.user_recs(model, config.USER_RECS_K).select("uid", "rank", F.col("score").alias("due"))
    same = F.coalesce(F.abs(F.col("score") - F.col("due")) <= TOLERANCE * (1 + F.abs("due")), F.lit(False))
    per = lists.join(full, ["uid", "rank"], "full").groupBy("uid").agg(F.count("score").alias("n"), F.every(same).alias("same"))
    most = model.itemFactors.agg(F.count(F.lit(1))).scalar()
    return per.join(work, "uid").select("uid", "n", (F.col("same") & (F.col("products") >= F.col("n")) & (F.col("products") <= most)).alias("ok"))


def als_predict_checks(spark, d):
    """Per user: predicted pairs, and whether each is the product of the factors (M3, J10)."""
    r = td.ratings(spark, d)
    model = _model(spark, d)
    users, items = _factors(model, spark)
    prod = F.aggregate(F.zip_with(_double("u"), _double("v"), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    # by item first, as the predictions lie: only the move to the users, where the groups are, carries factors
    out = collab.predict(model, r).join(items, "mid").join(users, "uid")
    return out.groupBy("uid").agg(F.count(F.lit(1)).alias("n"),
                                  F.every(F.abs(prod - F.col("prediction")) <= TOLERANCE * (1 + F.abs("prediction"))).alias("ok"))


def als_item_lists_checks(spark, d):
    """Per item: whether its list re-scores from the factors, above the threshold, and has as
    many entries and the same scores as the factors demand (M8)."""
    model = _model(spark, d)
    items = _factors(model, spark)[1]
    lists = materialize(collab.item_similarity(model, min_score=config.SIM_LIST_THRESHOLD, k=ALS_SIM_K))
    two = lists.join(items, "mid").join(items.select(F.col("mid").alias("rec_mid"), F.col("v").alias("w")), "rec_mid")
    right = (F.abs(cosine(_double("v"), _double("w")) - F.col("score")) <= TOLERANCE) & (F.col("score") > config.SIM_LIST_THRESHOLD) & (F.col("mid") != F.col("rec_mid"))
    per = two.groupBy("mid").agg(F.every(right).alias("right"), F.max("rank").alias("last"), F.count(F.lit(1)).alias("n"),
                                    F.sort_array(F.collect_list("score"), False).alias("scores"))     # at most k entries
    per = materialize(per, "lists-scored")
    length = F.sqrt(F.aggregate(_double("v"), F.lit(0.0), lambda s, x: s + x * x))
    unit = items.select(F.col("mid").alias("id"), F.transform(_double("v"), lambda x: F.when(length > 0, x / length).otherwise(0.0)).alias("vec"))
    # the neighbours above the threshold, and above what a full list claims to be its last score
    least = config.SIM_LIST_THRESHOLD - 2 * ROUNDING
    kth = per.select(F.col("mid").alias("id"), F.when(F.col("n") >= ALS_SIM_K, F.element_at("scores", -1) - 2 * ROUNDING).alias("kth"))
    asking = unit.join(kth, "id", "left").select("id", "vec", F.greatest(F.lit(least), "kth").alias("floor"))
    due = _demanded(asking, unit, ALS_SIM_K, config.SIM_LIST_THRESHOLD, own=True).withColumnRenamed("id", "mid")
    n = F.coalesce("n", F.lit(0))
    counted = n.between(F.least("least", F.lit(ALS_SIM_K)), F.least("most", F.lit(ALS_SIM_K)))
    same = F.forall(F.arrays_zip("scores", F.slice("top", F.lit(1), n.cast("int")).alias("due")), lambda x: F.abs(x["scores"] - x["due"]) <= ROUNDING)
    listed = F.coalesce(F.col("right") & (F.col("last") == F.col("n")) & same, F.col("n").isNull())
    return items.join(per, "mid", "left").join(due, "mid", "left").select("mid", F.coalesce(counted & listed, F.lit(False)).alias("ok"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "load_movies": load_movies,
    "load_ratings": load_ratings,
    "load_tags": load_tags,
    "ingest_rejects": ingest_rejects,
    "movie_search_docs": movie_search_docs,
    "most_rated": most_rated,
    "most_rated_by_month": most_rated_by_month,
    "recent_popular_as_written": recent_popular_as_written,
    "avg_score": avg_score,
    "genre_top10": genre_top10,
    "distinct_users": distinct_users,
    "distinct_items": distinct_items,
    "user_item_grid_count": user_item_grid_count,
    "item_similarity_dense": item_similarity_dense,
    "item_similarity_l1l2": item_similarity_l1l2,
    "als_item_similarity": als_item_similarity,
    "als_user_recs": als_user_recs,
    "als_predict": als_predict,
    "tfidf_terms": tfidf_terms,
    "content_similarity": content_similarity,
    "content_similarity_with_zeros": content_similarity_with_zeros,
    "content_similarity_hashed": content_similarity_hashed,
    "hashed_tfidf_checks": hashed_tfidf_checks,
    "recent_ratings": recent_ratings,
    "candidate_items": candidate_items,
    "realtime_scores": realtime_scores,
    "log_filter": log_filter,
    "rating_stream_parse": rating_stream_parse,
    "stream_recs": stream_recs,
    "recent_ratings_stream": recent_ratings_stream,
    "table_roundtrip": table_roundtrip,
    "rating_republish": rating_republish,
    "rated_layout": rated_layout,
    "keyed_reads": keyed_reads,
    "stream_progress": stream_progress,
    "search_docs_table": search_docs_table,
    "content_recs_table": content_recs_table,
    "content_recs_map": content_recs_map,
    "average_and_tags_tables": average_and_tags_tables,
    "recent_lists_import": recent_lists_import,
    "log_filter_bytes": log_filter_bytes,
    "als_normal_equations": als_normal_equations,
    "als_user_recs_checks": als_user_recs_checks,
    "als_user_recs_by_length": als_user_recs_by_length,
    "als_predict_checks": als_predict_checks,
    "als_item_lists_checks": als_item_lists_checks,
}
