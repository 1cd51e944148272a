import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.llm import quality, queries, toxicity
from cinerank.llm.sampling import bounded_sample

SF = "/root/testdata/sf0.01"


def held_out(df, spark, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    return df.join(labels, "doc_id").filter("held_out").collect()


def test_quality_on_held_out_rows(spark):
    got = queries.op3_quality(spark, SF)
    rows = held_out(got, spark, "quality")
    assert len(rows) > 50 and np.mean([r.predicted == r.y for r in rows]) >= 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert got.filter("score between 0 and 1 and predicted = cast(score >= 0.3 as int)").count() == 1000


def test_toxicity_on_held_out_rows(spark):
    rows = held_out(queries.op6_toxicity(spark, SF), spark, "toxic")
    assert np.mean([r.predicted == r.y for r in rows]) >= 0.94
    assert sum(r.predicted and not r.y for r in rows) <= 1
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


def labelled(spark, n, quality_of, toxic_of=lambda i: 0):
    return spark.createDataFrame([(i, quality_of(i), toxic_of(i), "x") for i in range(n)], "doc_id long, quality int, toxic int, text string")


def test_no_labels_and_edge_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), (3, "word " * 50_000)]
    none = labelled(spark, 0, int)
    for op in (quality, toxicity):
        got = op.classify(docs_of(rows), none).collect()
        assert len(got) == len(rows) and all(r.score == 0.5 for r in got)
        assert [r.held_out for r in got if r.doc_id is None] == [None]
        assert op.classify(docs_of([]), none).count() == 0
        assert op.classify(docs_of([]), labelled(spark, 5, lambda i: 1)).count() == 0
    one = toxicity.classify(docs_of(rows), labelled(spark, 4, lambda i: None, lambda i: 0)).collect()
    assert len({r.score for r in one}) == 1 and one[0].score < 0.5
    few = quality.classify(docs_of(rows), labelled(spark, 4, lambda i: 1)).collect()
    assert all(0 <= r.score <= 1 for r in few)


def test_contradicting_and_repeated_labels(spark, docs_of):
    rows = [(i, f"clean words number {i} here") for i in range(40)]
    labels = labelled(spark, 40, lambda i: 1).unionByName(labelled(spark, 40, lambda i: i % 2))
    assert quality.classify(docs_of(rows), labels).count() == 40


def test_prior_and_risk_without_negatives():
    rng = np.random.default_rng(0)
    p = np.zeros((1500, quality.N_FEATURES))
    u = np.zeros((2000, quality.N_FEATURES))
    p[:, :2] = rng.normal(2, 1, (1500, 2))
    truth = rng.random(2000) < 0.7
    u[:, :2] = np.where(truth[:, None], rng.normal(2, 1, (2000, 2)), rng.normal(-2, 1, (2000, 2)))
    m = quality.train(p, u)
    assert m.prior == pytest.approx(0.7, abs=0.06)
    assert ((m.scores(u) >= 0.5) == truth).mean() > 0.97


def test_log_count_ratios_and_counts(spark):
    texts = [("bad idiot", True), ("good day", False), ("good idiot day", True), ("fine", False)]
    counts, n = toxicity.count_ngrams(spark.createDataFrame(texts, "text string, toxic boolean").repartition(3))
    assert n == (2, 2)
    want = np.zeros((2, toxicity.DIMS))
    for t, y in texts:
        want[int(y)][toxicity.ngrams(t)] += 1
    assert (counts == want).all()
    r = toxicity.log_count_ratios(counts[1], counts[0])
    p, q = counts[1] + 1, counts[0] + 1
    assert np.allclose(r, np.log((p / p.sum()) / (q / q.sum())))


def test_sample_is_bounded_and_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a, b = (sorted(r.k for r in bounded_sample(df.repartition(n), F.col("k"), 100, 1).collect()) for n in (2, 9))
    assert a == b and len(a) == 100
    hot = spark.createDataFrame([(7,)] * 500, "k long")
    assert bounded_sample(hot, F.col("k"), 100, 1).count() <= 100


def test_reliable_ngrams_outside_the_sample_count(spark, docs_of):
    clean, common, rare = "a fine sunny day outside", "you horrid idiot", "zqx wvk jyp"
    kind = lambda i: clean if i % 2 else (rare if i % 20 == 0 else common)
    rows = [(i, kind(i)) for i in range(1200)]
    labels = labelled(spark, 1200, lambda i: 0, lambda i: 1 - i % 2)
    model = toxicity.fit(docs_of(rows), labels, sample=2)
    sampled = [r.id for r in bounded_sample(spark.createDataFrame(
        [(i,) for i in range(0, 1200, 2) if zlib.crc32(str(i).encode()) % 3 != 1], "id long"), F.col("id"), 2, toxicity.MODEL_SEED).collect()]
    assert all(kind(i) == common for i in sampled)          # the sample misses the rare wording
    assert model.score(rare) >= toxicity.CUT and model.score(common) >= toxicity.CUT and model.score(clean) < 0.3


def test_prior_counts_all_unlabelled_rows(spark, docs_of):
    def written(i, fine):
        rng = random.Random(i)
        words = ["the", "committee", "met", "again", "its", "report", "was", "read", "aloud", "nobody", "objected"]
        noise = ["$$", "BUY", "NOW!!!", "###", "WIN", "|||", "99%"]
        return " ".join(rng.choices(words if fine else noise, k=30))

    usable = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 5 != 0]
    ids = spark.createDataFrame([(i,) for i in usable], "id long")
    sampled = sorted(r.id for r in bounded_sample(ids, F.col("id"), 80, quality.SEED + 1).collect())
    trusted = [i for i in usable if i not in set(sampled)][::19][:80]
    fine = set(sampled[::2]) | set(trusted)        # half of the sample, but 120 of about 1600 rows
    rows = [(i, written(i, i in fine)) for i in usable]
    labels = spark.createDataFrame([(i, 1, 0, "x") for i in trusted], "doc_id long, quality int, toxic int, text string")
    model = quality.fit(docs_of(rows), labels, sample=80)
    assert model.prior == pytest.approx(len(fine) / len(usable), abs=0.04)
