import pytest
from pyspark.sql import functions as F

from cinerank.operators import collab
from cinerank.plans import catalog
from cinerank.sources import testdata as td

D = "/root/testdata/sf0.001"


def test_als_outputs_have_expected_properties(spark):
    ratings = td.ratings(spark, D)
    model = collab.train(ratings, max_iter=5)
    recs = collab.user_recs(model, 20)
    per_user = recs.groupBy("uid").agg(F.count("*").alias("n"), F.max("rank").alias("mx")).collect()
    assert per_user and all(r["n"] <= 20 and r["mx"] == r["n"] for r in per_user)
    known_u = {r[0] for r in ratings.select("uid").distinct().collect()}
    known_m = {r[0] for r in ratings.select("mid").distinct().collect()}
    rows = recs.collect()
    assert {r["uid"] for r in rows} <= known_u and {r["mid"] for r in rows} <= known_m
    sims = collab.item_similarity(model, min_score=0.6, k=5).collect()
    assert all(r["mid"] != r["rec_mid"] and r["score"] > 0.6 for r in sims)
    pred = collab.predict(model, ratings)
    assert pred.count() == ratings.count()


def test_factors_do_not_depend_on_cores(spark):
    """The same factors with 2 and with 8 cores, each in a session of its own."""
    import subprocess
    import sys
    code = (
        "import sys; sys.path.insert(0, {root!r})\n"
        "from cinerank.session import build_session\n"
        "s = build_session('local[' + sys.argv[1] + ']', shuffle_partitions=8)\n"
        "from cinerank.operators import collab\n"
        "from cinerank.sources import testdata as td\n"
        "m = collab.train(td.ratings(s, '/root/testdata/sf0.001'), max_iter=3)\n"
        "rows = sorted((r.uid, r.rank, r.mid, round(r.score, 3)) for r in collab.user_recs(m, 5).collect())\n"
        "import hashlib; print('DIGEST', len(rows), hashlib.sha256(repr(rows).encode()).hexdigest())\n"
    ).format(root=__file__.rsplit("/tests/", 1)[0])
    out = [subprocess.run([sys.executable, "-c", code, n], capture_output=True, text=True, timeout=600).stdout.split("DIGEST")[1]
           for n in ("2", "8")]
    assert out[0] == out[1]


@pytest.mark.parametrize("fault", ["nothing", "no best", "no last"])
def test_checks_see_missing_entries(spark, monkeypatch, fault):
    wrong = {"nothing": "rank < 0", "no best": "rank > 1", "no last": "rank < 20"}[fault]
    lists, recs = collab.item_similarity, collab.user_recs
    if fault == "no best":         # ranks and the number of entries look right
        monkeypatch.setattr(collab, "item_similarity", lambda m, min_score, k: lists(m, min_score, k + 1).where(wrong).withColumn("rank", F.col("rank") - 1))
        monkeypatch.setattr(collab, "user_recs", lambda m, k: recs(m, k + 1).where(wrong).withColumn("rank", F.col("rank") - 1))
        assert catalog.als_user_recs_checks(spark, D).where("not ok").count() > 0
    else:
        monkeypatch.setattr(collab, "item_similarity", lambda m, min_score, k: lists(m, min_score, k).where(wrong))
    assert catalog.als_item_lists_checks(spark, D).where("not ok").count() > 0


def test_search_by_length_equals_full_products(spark):
    model = collab.train(td.ratings(spark, D), max_iter=3)
    full = {(r["uid"], r["rank"]): r["score"] for r in collab.user_recs(model, 20).collect()}
    fast = {(r["uid"], r["rank"]): r["score"] for r in collab.user_recs(model, 20, by_length=True).collect()}
    assert full.keys() == fast.keys()
    assert all(abs(full[x] - fast[x]) <= 1e-4 * (1 + abs(full[x])) for x in full)


def test_blocks_follow_the_ratings(spark, monkeypatch):
    """F3-F6, F9: ten blocks held any number of ratings; a task sorts a block's in memory."""
    ratings = td.ratings(spark, D)
    n = ratings.count()
    assert collab.block_number(n) == collab.BLOCKS and collab.block_number(216_000_000) == 54
    monkeypatch.setattr(collab, "RATINGS_A_BLOCK", n // 24)
    assert collab.block_number(n) in (24, 25)
    model = collab.train(ratings, max_iter=2)
    assert model.userFactors.rdd.getNumPartitions() == collab.block_number(n)
    assert collab.predict(model, ratings).count() == n
