import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from cinerank.llm import simhash


def brute_fp(text):
    words = re.findall("[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    w = min(3, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + w]).encode(), 42) for i in range(len(words) - w + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, near):
    comp = {x: x for x in nodes}
    changed = True
    while changed:
        changed = False
        for x in nodes:
            m = min(comp[y] for y in nodes if near(x, y))
            if m < comp[x]:
                comp[x], changed = m, True
    return comp


def brute(rows):
    fps = [(i, brute_fp(t)) for i, t, *_ in rows]
    distinct = sorted({f for _, f in fps})
    comp = components(distinct, lambda x, y: (x ^ y).bit_count() <= 2)
    least = {}
    for i, f in fps:
        if i is not None:
            least[comp[f]] = min(least.get(comp[f], i), i)
    return sorted(((i, f"{f:016x}", least.get(comp[f])) for i, f in fps), key=str)


def run(df):
    return sorted((tuple(r) for r in simhash.near_duplicates(df).collect()), key=str)


def texts(rng, n):
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 5, 40, 300]))) for _ in range(n // 3)]
    out = list(base)
    while len(out) < n:
        t = rng.choice(base).split(" ")
        t[rng.randrange(len(t))] = rng.choice(words).upper()
        out.append(" ".join(t))
    return out


def test_fingerprint_equals_the_definition():
    rng = random.Random(0)
    for t in ["", " \t\n", "a", "A b", "a b c", "À\x1c x É y z", "x\x0by z\x0cw"] + texts(rng, 60):
        assert simhash.fingerprint(t) & (2**64 - 1) == brute_fp(t)


def test_slices_of_a_long_text_add_up(monkeypatch):
    t = " ".join(f"w{i % 977}" for i in range(5000))
    whole = simhash.fingerprint(t)
    monkeypatch.setattr(simhash, "SLICE", 64)
    assert simhash.fingerprint(t) == whole


def test_equals_brute_force(docs_of):
    rng = random.Random(1)
    rows = list(enumerate(texts(rng, 500), 10)) + [(i, None if i % 2 else " ") for i in range(600, 640)]
    rows += [(i, "Hot text of many rows") for i in range(700, 900)]
    rows += [(None, "a b c d"), (None, None), (3, "a b c d"), (3, "other words here now")]
    assert run(docs_of(rows)) == brute(rows)


@pytest.mark.parametrize("spread", [3, 6, 64])
def test_index_finds_every_link(spark, spread):
    """Fingerprints around a few centres, against all pairs; several levels of the index."""
    rng = random.Random(spread)
    centres, fps = [rng.getrandbits(64) for _ in range(20)], {0, 2**64 - 1, 1 << 63}
    while len(fps) < 3000:
        f = rng.choice(centres)
        for _ in range(rng.randint(0, spread)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    buckets, levels = simhash.gray_index(spark.createDataFrame(signed, "fp long"))
    assert len(levels) == 3
    found = simhash.links(buckets, levels).collect()
    assert all(((u ^ v) & (2**64 - 1)).bit_count() <= 2 for u, v in found)
    parent = {f: f for (f,) in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in found:
        parent[root(u)] = root(v)
    values = [f for (f,) in signed]
    for i, x in enumerate(values):
        for y in values[:i]:
            if ((x ^ y) & (2**64 - 1)).bit_count() <= 2:
                assert root(x) == root(y)


def test_whole_groups_are_pruned(spark):
    rng = random.Random(5)
    fps = [(rng.getrandbits(64) - (1 << 63),) for _ in range(64 * 256)]
    _, levels = simhash.gray_index(spark.createDataFrame(fps, "fp long"))
    pairs = simhash.surviving_pairs(levels, 2).count()
    # 256 buckets share their first 8 bits, fewer where a range is torn: 1 + 8 + 28 partners of 256 each, or some more
    assert 256 <= pairs <= 0.4 * 256 * 257 / 2


def test_gray_neighbours_differ_in_one_bit(spark):
    df = spark.range(1 << 10).select(F.col("id").alias("fp")).withColumn("rank", simhash.gray_rank("fp")).orderBy("rank")
    order = [r["fp"] for r in df.collect()]
    assert all((a ^ b).bit_count() == 1 for a, b in zip(order, order[1:]))


def test_empty_and_one_row(docs_of):
    assert run(docs_of([])) == []
    assert run(docs_of([(7, None)])) == [(7, "0" * 16, 7)]
