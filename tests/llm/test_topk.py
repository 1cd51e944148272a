import math
import random

import numpy as np
import pytest

from cinerank.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)


def brute(rows, every, k=5):
    data = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            data.setdefault(i, []).append([math.floor(256 * float(np.float32(x))) for x in v])
    out = []
    for q, qs in data.items():
        if q % every:
            continue
        best = {}
        for i, vs in data.items():
            scores = [sum(a * b for a, b in zip(x, y)) for x in qs for y in vs if i != q and x and len(x) == len(y)]
            if scores:
                best[i] = max(scores)
        out += [(q, r + 1, i, s) for r, (i, s) in enumerate(sorted(best.items(), key=lambda e: (-e[1], e[0]))[:k])]
    return sorted(out)


def run(df, **how):
    return sorted(tuple(r) for r in topk.top_k(df, **how).collect())


@pytest.mark.parametrize("shape", ["spread", "clusters", "one common vector"])
def test_equals_brute_force(spark, shape):
    rng = np.random.default_rng(len(shape))
    centres = rng.normal(size=(5, 8))
    rows = []
    for i in range(600):
        v = rng.normal(size=8) if shape == "spread" else centres[i % 5] + 0.05 * rng.normal(size=8)
        if shape == "one common vector" and i % 3:
            v = centres[0]
        rows.append((i, [float(x) for x in v]))
    df = table(spark, rows)
    assert run(df, every=20, shard=150, query_block=10) == brute(rows, 20)


def test_edge_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(60)]
    rows += [(100, None), (150, [1.0, None, 2.0]), (200, [float("nan"), 1.0, 1.0]), (250, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]),
             (300, []), (350, [1.0, 2.0]), (7, [0.5, 0.5, 0.5]), (0, rows[0][1]), (400, [3e12, -3e12, 1.0])]
    assert run(table(spark, rows), every=50) == brute(rows, 50)
    assert run(table(spark, []), every=50) == []
    assert run(table(spark, [(0, [1.0]), (3, [2.0])]), every=50) == [(0, 1, 3, 256 * 512)]


def exact_rows(df, **how):
    return sorted((q, r, i, int(x)) for q, r, i, x in run(df, score_type="string", **how))


@pytest.mark.parametrize("size", [2.0 ** 24, 2.0 ** 50, 2.0 ** 100])
def test_large_scores_are_exact(spark, size):
    # scores above 2**53 that differ by less than a double can tell, above 2**63, and components above 2**63
    rows = [(0, [size, 1.0, 0.5])] + [(i, [size, i / 256, (i % 7) / 256]) for i in range(1, 60)] + [(100, [-size, 3.0, 1.0])]
    got = exact_rows(table(spark, rows), every=50, shard=15, query_block=1)
    assert got == brute(rows, 50) and len(got) == 15


def test_scores_that_the_type_cannot_hold(spark):
    rows = [(0, [1.0])] + [(i, [float(i)]) for i in range(1, 8)] + [(50, [-(2.0 ** 60)])]
    # query 50 meets 0 and the small ones at -2**76 and below; none fits a long
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CAST_OVERFLOW"):
        run(table(spark, rows), every=50)
    assert exact_rows(table(spark, rows), every=50) == brute(rows, 50)


def test_sortable_texts_sort_as_their_integers():
    ns = sorted([0, 1, -1, 9, 10, -9, -10, 2 ** 53 + 1, 2 ** 53, -2 ** 63 - 1, -2 ** 63, 10 ** 80, -10 ** 80, 99, 100, -99, -100])
    assert sorted(topk.sortable(n) for n in ns) == [topk.sortable(n) for n in ns]
    assert [topk.from_sortable(topk.sortable(n)) for n in ns] == ns


def test_bounds_hold():
    rng = np.random.default_rng(4)
    points, queries = rng.normal(size=(700, 6)) * 100, rng.normal(size=(40, 6)) * 100
    tree = topk.BallTree(points, 32)
    bounds = tree.leaf_bounds(queries)
    for j, leaf in enumerate(tree.leaves):
        assert (queries @ points[tree.parts[leaf]].T <= bounds[:, [j]]).all()
    assert sorted(np.concatenate([tree.parts[i] for i in tree.leaves]).tolist()) == list(range(700))
