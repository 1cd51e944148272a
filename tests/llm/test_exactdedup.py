import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cinerank.llm import exactdedup


def brute(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t, *_ in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def run(df, **how):
    return sorted((tuple(r) for r in exactdedup.exact_groups(df, **how).collect()), key=str)


def random_rows(seed, n=500):
    rng = random.Random(seed)
    texts = ["", None, "a", "A", "a ", "é", "é", "x" * 200_000] + [f"t{i}" for i in range(120)]
    return [(i, "hot" if rng.random() < 0.33 else rng.choice(texts)) for i in range(n)]


@pytest.mark.parametrize("capacity", [3, 65_536])
def test_equals_brute_force(docs_of, capacity):
    rows = random_rows(1)
    assert run(docs_of(rows), capacity=capacity) == brute(rows)


def test_collisions_are_chained_and_told_apart(docs_of, monkeypatch):
    monkeypatch.setattr(exactdedup, "key_of", lambda text: F.length(text).cast("long"))
    rows = random_rows(2)
    assert run(docs_of(rows), capacity=2) == brute(rows)


def test_directory_splits_only_overfull_buckets():
    histogram = {0b0000: 5, 0b0001: 5, 0b0100: 1, 0b1000: 2, 0b1111: 90}
    buckets = exactdedup.grow_directory(histogram, 4, 8)
    assert [(format(p, f"0{d}b"), n) for p, d, n in buckets] == [
        ("0000", 5), ("0001", 5), ("001", 0), ("01", 1), ("10", 2), ("110", 0), ("1110", 0), ("1111", 90)]
    assert sum(2 ** (4 - d) for _, d, _ in buckets) == 16
    assert exactdedup.grow_directory({}, 4, 8) == [(0, 0, 0)]


def test_index_files_hold_every_key_in_its_bucket(docs_of):
    text = docs_of(random_rows(3)).select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    entries = text.select(F.col("doc_id").alias("id"), exactdedup.key_of(F.col("t")).alias("key"),
                          F.sha2("t", 256).alias("digest"), F.octet_length("t").alias("n_bytes"))
    slots, depth = exactdedup.directory(entries, 10, exactdedup.MAX_DEPTH)
    index = exactdedup.build_index(entries, slots, depth)
    assert index.count() == text.select("t").distinct().count() and index.agg(F.sum("rows")).first()[0] == text.count()
    many = text.groupBy("t").count().filter("count > 1").count()
    assert exactdedup.chained(index).count() == many > 10
    per = index.groupBy("bucket").agg(F.count("*").alias("n"), F.max("local_depth").alias("d"),
                                      F.countDistinct(F.expr("shiftrightunsigned(key, 64 - local_depth)")).alias("prefixes")).collect()
    assert all(r.n <= 11 and r.prefixes == 1 for r in per) and len(per) > 10      # the directory goes by a sketch


def test_edge_rows(docs_of):
    rows = [(None, "a"), (None, "a"), (1, "a"), (1, "a"), (None, "b"), (2, None), (3, "")]
    assert run(docs_of(rows)) == brute(rows)
    assert run(docs_of([])) == []


def test_drop_exact_leaves_one_row_of_each_text(docs_of):
    rows = random_rows(4) + [(700, "t1"), (700, "t1"), (None, "only null"), (None, "only null"), (0, "hot", "other source"), (499, "hot", "z")]
    df = docs_of(rows)
    out = exactdedup.drop_exact(df)
    assert out.columns == df.columns
    got = out.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).collect()
    assert len(got) == len({t or "" for _, t, *_ in rows}) == len({r.t for r in got})
    largest = {}
    for i, t, *_ in rows:
        largest[t or ""] = max(largest.get(t or "", -1), -1 if i is None else i)
    assert all((-1 if r.doc_id is None else r.doc_id) == largest[r.t] for r in got)
    assert exactdedup.drop_exact(df.limit(0)).count() == 0


def test_without_the_index_there_are_no_groups(docs_of, monkeypatch):
    """Chains come from the index as read back: one that holds nothing finds no copies."""
    real = exactdedup.build_index
    monkeypatch.setattr(exactdedup, "build_index", lambda *a: real(*a).limit(0))
    assert {r[2] for r in run(docs_of([(1, "a"), (2, "a"), (3, "b")]))} == {1}
