import hashlib
import random
import zlib

import numpy as np
import pytest

from cinerank.llm import merkle


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def stated(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def climb(leaves):
    """(root, paths): every leaf's sibling digests by level, with its place."""
    paths, owner, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for i, at in enumerate(owner):
            run = level[at // 16 * 16:at // 16 * 16 + 16]
            paths[i].append((at % 16, run[:at % 16] + run[at % 16 + 1:]))
        level = [H("".join(level[i:i + 16])) for i in range(0, len(level), 16)]
        owner = [at // 16 for at in owner]
    return level[0], paths


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)"""
    trees = {}
    for r in rows:
        trees.setdefault(r[1], []).append((r, H("".join(stated(v) for v in r))))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in names:
        trees[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        made[s] = climb([x[1] for x in trees[s]])
    root, above = climb([made[s][0] for s in names]) if names else (None, [])
    out = []
    for s, up in zip(names, above):
        for (r, leaf), path in zip(trees[s], made[s][1]):
            own = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                own = H("".join(stated(v) for v in (*r[:4], lower(r[4]))))
            for at, sib in path + up:
                own = H("".join(sib[:at]) + own + "".join(sib[at:]))
            out.append((r[0], leaf, made[s][0], root, H("".join("".join(x) for _, x in path + up)), own, own == root))
    return sorted(out, key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for name in ("tree", "at", "digest", "id", "path", "block", "n", "name"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return sorted((tuple(r) for r in merkle.manifest(df, **how)[1].collect()), key=str)


def rows_of(n, seed, sources=("a", "é", "", None, "hot"), ids=None):
    rng = random.Random(seed)
    return [(ids[i] if ids else i, "hot" if rng.random() < 0.4 else rng.choice(sources), rng.choice(["en", None]), rng.choice([i, None]),
             rng.choice([f"Text {i} ÀB", None, "", "SAME"])) for i in range(n)]


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_every_node_has_one_address(levels):
    seen = np.concatenate([merkle.address(d, np.arange(merkle.ARITY ** d), levels) for d in range(levels)])
    assert sorted(seen.tolist()) == list(range(merkle.tree_size(levels)))


def test_levels_split_at_half_height():
    # four levels: a top subtree of two (17 nodes), then 256 bottom subtrees of two, each contiguous
    assert merkle.address(0, 0, 4) == 0 and merkle.address(1, 15, 4) == 16
    assert merkle.address(2, 3, 4) == 17 + 3 * 17 and merkle.address(3, 3 * 16 + 5, 4) == 17 + 3 * 17 + 1 + 5


def test_equals_brute_force(spark):
    rows = rows_of(700, 1)
    assert run(spark, rows) == brute(rows)


def test_more_than_one_tier(spark):
    # blocks of 16 leaves: a source of some 300 is three tiers of blocks; 40 sources are two
    rows = rows_of(800, 2, sources=[f"s{i}" for i in range(40)])
    assert run(spark, rows, height=1) == brute(rows)


def test_whole_blocks_of_production_size(spark):
    rows = [(i, "one" if i < 4097 else "two", "en", i, f"T{i}") for i in range(4097 + 20)]
    assert run(spark, rows) == brute(rows)


def test_nulls_repeated_ids_ties_and_long_texts(spark):
    rows = rows_of(60, 3, ids=[None if i % 7 == 0 else i // 3 for i in range(60)])
    rows += [rows[5]] * 20 + [(1000, "a", "en", 1, "LONG " * 200_000)]
    assert run(spark, rows) == brute(rows)


def test_lone_leaf_is_its_own_root(spark):
    rows = [(5, None, None, None, None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows)[0][1] == run(spark, rows)[0][3]


def test_empty_table(spark):
    assert run(spark, []) == []


def test_stored_blocks_hold_the_tree(spark):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    blocks, leaves = merkle.manifest(df)
    stored = blocks.filter("tier = 0").collect()
    assert len(stored) == 1 and stored[0]["n"] == 300 and stored[0]["height"] == 3
    nodes = np.frombuffer(stored[0]["nodes"], np.uint8).reshape(-1, 32)
    assert len(nodes) == merkle.tree_size(4)
    by_id = {r["doc_id"]: r["leaf"] for r in leaves.collect()}
    assert nodes[merkle.address(3, 123, 4)].tobytes().hex() == by_id[123]
    assert nodes[0].tobytes() == bytes(stored[0]["root"])
