import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.functions.columns import cosine, l1l2, round_score
from cinerank.operators import similarity


def vecs(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "mid int, features array<double>")


def pairs_of(df):
    return {(r["mid"], r["rec_mid"]): r["score"] for r in df.collect()}


def test_zero_vector_scores_zero(spark):
    got = pairs_of(similarity.dense_pairs(vecs(spark, [(1, [0, 0]), (2, [1, 0])])))
    assert got == {(1, 2): 0.0, (2, 1): 0.0}


def test_asymmetric_metric(spark):
    v = vecs(spark, [(1, [1, 1]), (2, [2, 0])])
    cos = pairs_of(similarity.dense_pairs(v, metric="cosine"))
    assert cos == {(1, 2): 0.707107, (2, 1): 0.707107}
    asym = pairs_of(similarity.dense_pairs(v, metric="l1l2"))
    assert asym == {(1, 2): 0.5, (2, 1): 0.707107}
    row = v.alias("a").join(v.alias("b"), F.col("a.mid") < F.col("b.mid")).select(
        round_score(cosine("a.features", "b.features")).alias("c"),
        round_score(l1l2("a.features", "b.features")).alias("l")).first()
    assert (row["c"], row["l"]) == (0.707107, 0.5)


@pytest.mark.parametrize("metric", ["cosine", "l1l2"])
@pytest.mark.parametrize("k", [None, 3])
def test_blocked_equals_brute_force(spark, metric, k):
    rng = np.random.default_rng(7)
    data = rng.normal(size=(40, 5))
    data[3] = data[4]          # duplicate vectors -> tied scores
    data[5] = 0.0              # zero vector
    v = vecs(spark, [(i, data[i]) for i in range(40)])
    got = similarity.dense_similarity(v, metric=metric, min_score=0.1, k=k, n_blocks=3)
    got = {(r["mid"], r["rank"]): (r["rec_mid"], r["score"]) for r in got.collect()}
    exp = {}
    for i in range(40):
        cand = []
        for j in range(40):
            if i == j:
                continue
            den = (np.abs(data[i]).sum() if metric == "l1l2" else np.linalg.norm(data[i])) * np.linalg.norm(data[j])
            s = 0.0 if den == 0 else float(data[i] @ data[j] / den)
            s = float(similarity.round_half_away(np.array([s]), 6)[0])
            if s > 0.1:
                cand.append((-s, j))
        for rank, (ns, j) in enumerate(sorted(cand)[:k] if k else sorted(cand), start=1):
            exp[(i, rank)] = (j, -ns)
    assert got == exp


def test_properties_symmetric_bounded_no_self(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(25, 4))
    got = pairs_of(similarity.dense_pairs(vecs(spark, [(i, data[i]) for i in range(25)]), n_blocks=4))
    assert len(got) == 25 * 24
    for (a, b), s in got.items():
        assert a != b and -1.0 <= s <= 1.0 and got[(b, a)] == s


def test_sparse_pairs_brute_force(spark):
    w = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 3.0), (3, "c", 1.0), (4, "b", 1.0)],
                              "mid int, term string, w double")
    got = pairs_of(similarity.sparse_pairs(w))
    n1 = math.sqrt(5.0)
    assert got == {(1, 2): round(1 / n1, 6), (2, 1): round(1 / n1, 6),
                   (1, 4): round(2 / n1, 6), (4, 1): round(2 / n1, 6)}


def test_nested_lists_sorted(spark):
    v = vecs(spark, [(1, [1, 0]), (2, [1, 1]), (3, [1, 2])])
    nested = similarity.nest_similarity(similarity.dense_similarity(v)).collect()
    for r in nested:
        scores = [x["score"] for x in r["recs"]]
        assert scores == sorted(scores, reverse=True)


def test_expand_groups_matches_brute_force_with_duplicates(spark):
    # 30 items over 6 distinct vectors (group sizes vary), ties across groups
    rng = np.random.default_rng(11)
    base = rng.integers(0, 3, size=(6, 3)).astype(float)
    base[5] = 0.0
    assign = [0] * 9 + [1] * 7 + [2] * 5 + [3] * 4 + [4] * 3 + [5] * 2
    rng.shuffle(assign)
    items = [(i + 1, base[g]) for i, g in enumerate(assign)]
    v = vecs(spark, items)
    brute = {(r["mid"], r["rank"]): (r["rec_mid"], r["score"])
             for r in similarity.dense_similarity(v, min_score=0.0, k=4).collect()}
    members = spark.createDataFrame([(m, g) for m, g in zip(range(1, 31), assign)], "mid int, g int")
    gid = members.groupBy("g").agg(F.min("mid").alias("gid"))
    members = members.join(gid, "g").select("mid", "gid")
    gvec = vecs(spark, [(int(min(m for m, a in zip(range(1, 31), assign) if a == g)), base[g]) for g in set(assign)])
    pairs = similarity.dense_pairs(gvec, min_score=0.0, k=5, include_self=True).select(
        F.col("mid").alias("gid"), F.col("rec_mid").alias("ngid"), "score")
    got = {(r["mid"], r["rank"]): (r["rec_mid"], r["score"])
           for r in similarity.expand_groups(pairs, members, 4).collect()}
    assert got == brute


@pytest.mark.parametrize("k,include_self", [(None, False), (3, False), (2, True)])
def test_sparse_blocked_equals_brute_force(spark, k, include_self):
    rng = np.random.default_rng(3)
    vocab = ["hot", "a", "b", "c", "d", "e"]
    rows = []
    for i in range(40):
        terms = {"hot"} if i % 3 else set()          # a term shared by two thirds of the items
        terms |= set(rng.choice(vocab[1:], size=int(rng.integers(0, 3)), replace=False))
        rows += [(i, t, float(rng.integers(1, 4))) for t in terms]
    w = spark.createDataFrame(rows, "mid int, term string, w double")
    pairs = similarity.sparse_pairs(w, k=k, include_self=include_self, n_blocks=3)
    if k is not None:  # per block pair the kernel keeps a superset; cut to the final top-k
        from cinerank.operators.topk import by_score, rank_within
        pairs = rank_within(pairs, ["mid"], by_score("score", "rec_mid"), k)
    got = pairs_of(pairs)
    vec = {}
    for i, t, x in rows:
        vec.setdefault(i, {})[t] = x
    exp = {}
    for a in vec:
        na = math.sqrt(sum(x * x for x in vec[a].values()))
        cand = []
        for b in vec:
            if a == b and not include_self:
                continue
            nb = math.sqrt(sum(x * x for x in vec[b].values()))
            dot = sum(x * vec[b].get(t, 0.0) for t, x in vec[a].items())
            s = float(similarity.round_half_away(np.array([dot / (na * nb)]), 6)[0])
            if s > 0:
                cand.append((-s, b))
        for ns, b in (sorted(cand) if k is None else sorted(cand)[:k]):
            exp[(a, b)] = -ns
    assert got == exp


def test_rounding_twins_agree_on_exact_halves(spark):
    from pyspark.sql import functions as F

    from cinerank.functions.columns import round_score
    n = 500_000
    halves = (np.arange(n) * 10 + 5) / 1e7
    df = spark.range(n).select("id", round_score((F.col("id") * 10 + 5).cast("double") / 1e7).alias("s"))
    got = df.orderBy("id").toPandas()["s"].to_numpy()
    assert (got == similarity.round_half_away(halves, 6)).all()
    assert (similarity.round_half_away(-halves[:1000], 6) == -similarity.round_half_away(halves[:1000], 6)).all()


def test_blocks_fill_the_task_slots():
    assert similarity.block_count(500, 4096, 8) * (similarity.block_count(500, 4096, 8) + 1) // 2 >= 8
    assert similarity.block_count(100_000, 4096, 8) == 25 and similarity.block_count(0, 4096, 8) == 1


def clustered(n, centres, spread, seed):
    """Unit-ish vectors around a few axes in 8 dimensions; a third of all around the first."""
    rng = np.random.default_rng(seed)
    axes = np.eye(8)[:centres]
    which = np.where(rng.random(n) < 0.33, 0, rng.integers(0, centres, n))
    return axes[which] + rng.normal(scale=spread, size=(n, 8))


@pytest.mark.parametrize("min_score", [0.0, 0.6, 0.95])
@pytest.mark.parametrize("k", [None, 4])
def test_skipped_block_pairs_lose_nothing(spark, min_score, k):
    data = clustered(400, 5, 0.08, 3)
    data[7], data[11], data[13] = 0.0, data[12], -data[14]
    v = vecs(spark, [(i, data[i]) for i in range(400)])
    got = {(r["mid"], r["rank"]): (r["rec_mid"], r["score"]) for r in
           similarity.dense_similarity(v, min_score=min_score, k=k, n_blocks=8).collect()}
    length = np.linalg.norm(data, axis=1, keepdims=True)
    unit = np.divide(data, length, out=np.zeros_like(data), where=length > 0)
    raw = np.round(unit @ unit.T, 12)
    exp = {}
    for i in range(400):
        cand = sorted((-s, j) for j, s in enumerate(similarity.round_half_away(raw[i], 6).tolist()) if j != i and raw[i, j] > min_score)
        exp.update({(i, rank): (j, -s) for rank, (s, j) in enumerate(cand[:k], 1)})
    assert got.keys() == exp.keys() and all(got[x][0] == exp[x][0] and abs(got[x][1] - exp[x][1]) < 2e-6 for x in exp)


def test_block_pairs_far_apart_are_never_formed(spark):
    data = clustered(2000, 8, 0.03, 4)
    norm = similarity._normalised(vecs(spark, [(i, data[i]) for i in range(2000)]), "mid", "features", "cosine")
    blocked = similarity.pivot_blocks(norm.select("id", "rhs"), 2000, 32).cache()
    sizes = [r["count"] for r in blocked.groupBy("blk").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 2.5 * 2000 / 32          # the third around one axis is many blocks
    share = {}
    for threshold in (0.0, 0.6, 0.9):
        pairs = similarity.pivot_pairs(blocked, threshold).collect()
        assert len(pairs) == len(sizes) * (len(sizes) + 1) // 2
        share[threshold] = sum(not p["needed"] for p in pairs) / len(pairs)

    assert share[0.9] >= share[0.6] > 0.4 and share[0.0] <= share[0.6]


def test_sparse_product_equals_the_dense_one(monkeypatch):
    rng = np.random.default_rng(5)
    for common, width in ((1, 3), (8, 512), (10_000, 512)):              # all common, mixed, all rare
        monkeypatch.setattr(similarity, "COMMON_TERM", common)
        monkeypatch.setattr(similarity, "TERM_SLICE", width)
        a, b = (np.where(rng.random((n, 40)) < rng.random(40) * 0.4, rng.normal(size=(n, 40)), 0.0) for n in (17, 23))
        (ar, at), (br, bt) = np.nonzero(a), np.nonzero(b)
        got = similarity._sparse_product(ar, at, a[ar, at], 17, br, bt, b[br, bt], 23)
        assert np.allclose(got, a @ b.T)
    none = np.empty(0, int)
    assert not similarity._sparse_product(none, none, np.empty(0), 2, none, none, np.empty(0), 3).any()


@pytest.mark.parametrize("ids", [[7], [5, 5, 5], [-2**31, -1, 0, 2**31 - 1], list(range(-300, 90_000, 301))])
def test_packed_results_come_back(ids):
    whole = np.random.default_rng(len(ids)).integers(-10**6, 10**6 + 1, len(ids))
    packed = similarity.pack_results(np.array(ids), whole)
    got = similarity.unpack_results(len(ids), packed)
    assert got[0].tolist() == ids and got[1].tolist() == whole.tolist()
    assert sum(map(len, packed)) <= 8 * len(ids)


@pytest.mark.parametrize("metric,threshold,most", [("l1l2", 0.03, 5.0), ("cosine", 0.25, 6.0)])
def test_whole_lists_move_packed_and_are_not_sorted_as_rows(spark, metric, threshold, most):
    data = np.random.default_rng(9).normal(size=(900, 64))
    v = vecs(spark, [(i * 3, data[i]) for i in range(900)])
    ranked = similarity.dense_similarity(v, metric=metric, min_score=threshold, n_blocks=2)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "score" not in plan.split("Exchange", 1)[1]
    packed = similarity.packed_lists(v, metric=metric, min_score=threshold, n_blocks=2).collect()
    n = sum(r["n"] for r in packed)
    assert n == ranked.count() > 10_000
    assert sum(len(x) for r in packed for x in r["packed"]) < most * n


@pytest.mark.parametrize("metric", ["cosine", "l1l2"])
def test_whole_lists_of_repeated_ids_and_null_vectors(spark, metric):
    one, two = [1.0, 0.0], [3.0, 4.0]
    rows = [(1, one), (2, two), (2, one), (3, None), (4, [0.0, 0.0])]
    v = spark.createDataFrame(rows, "mid int, features array<double>")
    got = sorted(tuple(r) for r in similarity.dense_similarity(v, metric=metric, min_score=0.0, n_blocks=3).collect())
    flat = 0.6 if metric == "cosine" else round(3 / 7, 6)
    exp = [(1, 1, 2, 1.0), (1, 2, 2, 0.6), (2, 1, 1, 1.0), (2, 2, 2, 0.6), (2, 3, 1, flat), (2, 4, 2, flat)]
    if metric == "cosine":                       # ties by id
        exp = [(1, 1, 2, 1.0), (1, 2, 2, 0.6), (2, 1, 1, 1.0), (2, 2, 1, 0.6), (2, 3, 2, 0.6), (2, 4, 2, 0.6)]
    assert got == exp


def test_whole_lists_without_a_threshold_or_rows(spark):
    v = vecs(spark, [(1, [1, 0]), (2, [-1, 0]), (3, [0, 0])])
    got = sorted(tuple(r) for r in similarity.dense_similarity(v, n_blocks=2).collect())
    assert got == [(1, 1, 3, 0.0), (1, 2, 2, -1.0), (2, 1, 3, 0.0), (2, 2, 1, -1.0), (3, 1, 1, 0.0), (3, 2, 2, 0.0)]
    assert similarity.dense_similarity(v.where("mid > 9"), min_score=0.5).count() == 0
    assert similarity.dense_similarity(v.where("mid = 1"), metric="l1l2", min_score=0.5).count() == 0
