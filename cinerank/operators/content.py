"""Content features from genres: tokens, term frequencies, IDF, TF-IDF, and
item-to-item content similarity.

Two paths:

* exact vocabulary (``tfidf_terms``, ``content_similarity``): DataFrame
  aggregates, checkable against SQL; idf = ln((m + 1) / (df + 1)) as in
  Spark ML's IDF;
* hashed (``hashed_tfidf``): Spark ML ``Tokenizer -> HashingTF(50) -> IDF``,
  the reference's feature pipeline, then the dense block kernel.
"""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank import config
from cinerank.operators.similarity import dense_pairs, expand_groups, fill_with_zeros, sparse_pairs


def genre_text(movies: DataFrame) -> DataFrame:
    """``mid, genres`` with the ``|`` separators replaced by spaces."""
    return movies.select("mid", F.replace(F.col("genres"), F.lit("|"), F.lit(" ")).alias("genres"))


def words(movies: DataFrame) -> DataFrame:
    """``mid, words``: lower-cased, split on whitespace, empty tokens dropped."""
    toks = F.split(F.lower(F.col("genres")), r"\s", -1)
    return genre_text(movies).select("mid", F.filter(toks, lambda t: t != "").alias("words"))


def _idf(df_col, n_docs) -> F.Column:
    return F.log((n_docs + F.lit(1.0)) / (df_col + F.lit(1.0)))


def tfidf_terms(movies: DataFrame) -> DataFrame:
    """``mid, term, tf, df, idf, tfidf`` for every (movie, term) present.

    tf is the raw count of the term in the movie, df the number of movies that
    contain it, m the number of movies (scalar subquery, including movies
    without terms).
    """
    n_docs = movies.select(F.count(F.lit(1))).scalar()
    w = words(movies)
    tf = w.select("mid", F.explode("words").alias("term")).groupBy("mid", "term").agg(F.count(F.lit(1)).alias("tf"))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    out = tf.join(df, "term").withColumn("idf", _idf(F.col("df"), n_docs))
    return out.select("mid", "term", "tf", "df", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def content_similarity(movies: DataFrame, k: int = 10, include_zero: bool = False) -> DataFrame:
    """Top-k content neighbours per movie by exact TF-IDF cosine:
    ``mid, rank, rec_mid, score`` (score rounded, > 0, ties by rec_mid).

    Movies with the same term multiset have the same TF-IDF vector, so the
    similarity join runs between distinct *signatures* (sorted term lists),
    each identified by its smallest movie id, and is expanded to movies by
    :func:`~cinerank.operators.similarity.expand_groups` -- exact for any
    input.  ``include_zero`` completes short lists with zero-score movies, as
    the reference's full lists do.
    """
    n_docs = movies.select(F.count(F.lit(1))).scalar()
    w = words(movies)
    sig = w.select("mid", F.concat_ws(" ", F.array_sort("words")).alias("sig"),
                   F.size("words").alias("n_terms"))
    sig_sizes = sig.where(F.col("n_terms") > 0).groupBy("sig").agg(F.count(F.lit(1)).alias("n_movies"))
    sig_tf = (sig_sizes.select("sig", "n_movies", F.explode(F.split("sig", " ")).alias("term"))
              .groupBy("sig", "term").agg(F.count(F.lit(1)).alias("tf"), F.first("n_movies").alias("n_movies")))
    doc_freq = sig_tf.groupBy("term").agg(F.sum("n_movies").alias("df"))
    weights = sig_tf.join(doc_freq, "term").select("sig", "term", (F.col("tf") * _idf(F.col("df"), n_docs)).alias("w"))
    gid = sig.groupBy("sig").agg(F.min("mid").alias("gid"))
    members = sig.join(gid, "sig").select("mid", "gid")
    by_gid = weights.join(gid, "sig").select("gid", "term", "w")
    group_pairs = sparse_pairs(by_gid, id_col="gid", k=k + 1, include_self=True).select(
        F.col("mid").alias("gid"), F.col("rec_mid").alias("ngid"), "score")
    ranked = expand_groups(group_pairs, members, k)
    return fill_with_zeros(ranked, movies, k) if include_zero else ranked


def _tokens(movies: DataFrame) -> DataFrame:
    """``mid, words``: the reference's tokenizer (lower case, split on single
    whitespace characters)."""
    return Tokenizer(inputCol="genres", outputCol="words").transform(genre_text(movies)).select("mid", "words")


def hashed_counts(movies: DataFrame, buckets: int = config.TF_BUCKETS) -> DataFrame:
    """``mid, raw``: how many of a movie's tokens fall into each bucket, as an ML vector."""
    return HashingTF(inputCol="words", outputCol="raw", numFeatures=buckets).transform(_tokens(movies)).select("mid", "raw")


def hashed_tfidf(movies: DataFrame, buckets: int = config.TF_BUCKETS) -> DataFrame:
    """The reference's feature pipeline: ``mid, features array<double>``."""
    tf = hashed_counts(movies, buckets)
    model = IDF(inputCol="raw", outputCol="tfidf").fit(tf)
    return model.transform(tf).select("mid", vector_to_array("tfidf").alias("features"))


def hashed_content_similarity(movies: DataFrame, k: int = 10, buckets: int = config.TF_BUCKETS,
                              block_size: int | None = None, include_zero: bool = False) -> DataFrame:
    """Top-k cosine neighbours over hashed TF-IDF vectors:
    ``mid, rank, rec_mid, score`` (score > 0).

    The IDF is fitted on all movies; vectors and the blocked similarity are
    then computed once per distinct token multiset (identified by its
    smallest movie id) and expanded with
    :func:`~cinerank.operators.similarity.expand_groups`; ``include_zero``
    completes short lists with zero-score movies, as the reference does.
    """
    hashing = HashingTF(inputCol="words", outputCol="raw", numFeatures=buckets)
    tokens = _tokens(movies).withColumn("sig", F.array_sort("words"))
    model = IDF(inputCol="raw", outputCol="tfidf").fit(hashing.transform(tokens))
    groups = tokens.groupBy("sig").agg(F.min("mid").alias("gid"))
    members = tokens.join(groups, "sig").select("mid", "gid")
    vectors = model.transform(hashing.transform(groups.select("gid", F.col("sig").alias("words")))).select(
        "gid", vector_to_array("tfidf").alias("features"))
    group_pairs = dense_pairs(vectors, id_col="gid", metric="cosine", min_score=0.0, k=k + 1,
                              block_size=block_size, include_self=True).select(
        F.col("mid").alias("gid"), F.col("rec_mid").alias("ngid"), "score")
    ranked = expand_groups(group_pairs, members, k)
    return fill_with_zeros(ranked, movies, k) if include_zero else ranked
