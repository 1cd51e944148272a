"""Brute-force checks on the small fixture for the queries without a SQL oracle."""

import numpy as np

from cinerank.operators import collab, content, similarity
from cinerank.sources import testdata as td

D = "/root/testdata/sf0.001"


def test_hashed_content_similarity_equals_all_items_kernel(spark):
    movies = td.movies(spark, D)
    grouped = sorted(map(tuple, content.hashed_content_similarity(movies, k=10).collect()))
    direct = sorted(map(tuple, similarity.dense_similarity(content.hashed_tfidf(movies), min_score=0.0,
                                                           k=10).collect()))
    assert grouped == direct and len(grouped) > 0


def test_als_item_similarity_equals_numpy_brute_force(spark):
    model = collab.train(td.ratings(spark, D), max_iter=5)
    factors = collab.item_factors(model).toPandas()
    ids = factors["mid"].to_numpy()
    x = np.stack(factors["features"].to_numpy())
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = similarity.round_half_away(x @ x.T, 6)
    exp = set()
    for i, a in enumerate(ids):
        cand = sorted((-s[i, j], b) for j, b in enumerate(ids) if b != a and s[i, j] > 0.6)[:20]
        exp |= {(int(a), r + 1, int(b), -ns) for r, (ns, b) in enumerate(cand)}
    got = {tuple(r) for r in collab.item_similarity(model, min_score=0.6, k=20).collect()}
    assert got == exp


def test_hashed_include_zero_equals_all_items_kernel(spark):
    movies = td.movies(spark, D)
    filled = sorted(map(tuple, content.hashed_content_similarity(movies, k=10, include_zero=True).collect()))
    direct = sorted(map(tuple, similarity.dense_similarity(content.hashed_tfidf(movies), min_score=None,
                                                           k=10).collect()))
    assert filled == direct
