import random
import re

import numpy as np
import pytest

from cinerank.llm import neardup


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def brute(rows, width, percent=80):
    sets = [shingles(t, width) for _, t, *_ in rows]
    label = {i: i for i, *_ in rows if i is not None}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(rows[a][0]), find(rows[b][0])
                label[max(x, y)] = min(x, y)
    return sorted([(i, len(s), None if i is None else find(i), i is None or find(i) == i) for (i, *_), s in zip(rows, sets)], key=str)


def run(df, width):
    return sorted((tuple(r) for r in neardup.near_duplicates(df, width=width).collect()), key=str)


def family(rng, n, words, edits):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = base[:]
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width, small, block", [(2, 16, 512), (5, 16, 512), (2, 2, 8)])
def test_equals_brute_force(docs_of, monkeypatch, width, small, block):
    monkeypatch.setattr(neardup, "SMALL", small)
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(width)
    texts = family(rng, 80, 120, 9) + family(rng, 40, 60, 4) + family(rng, 30, 300, 20)
    texts += [" ".join(f"u{rng.randrange(3000)}" for _ in range(80)) for _ in range(60)]
    texts += ["", None, "one", "ONE", "one two", "  ", "one\x0btwo", "a b c", "A  b\nc"] + [texts[0].upper().replace("W", "w")] * 30
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert run(docs_of(rows), width) == brute(rows, width)


def test_edge_rows(docs_of):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(5, long), (2, long + " tail"), (5, long), (None, long), (7, None), (8, "a b c d e f"), (8, "p q r s t u v"), (9, "p q r s t u v"),
            (3, "a b c d e f")]
    assert run(docs_of(rows), 2) == brute(rows, 2)
    assert run(docs_of([]), 2) == []
    assert run(docs_of([(1, ""), (2, None)]), 5) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_repeated_id_is_one_document(docs_of):
    rows = [(4, "a b c d e f"), (4, "p q r s t u v"), (6, "p q r s t u v"), (1, "a b c d e f")]
    assert {r[0]: r[2] for r in run(docs_of(rows), 2)} == {4: 1, 6: 1, 1: 1}


def test_posterior_bound_keeps_pairs_at_the_threshold():
    needed = neardup.least_matches(0.8, 1e-8)
    rng = np.random.default_rng(1)
    equal = np.cumsum(rng.random((200_000, neardup.PERMS)) < 0.8, axis=1)
    assert all((equal[:, n - 1] >= m).all() for n, m in needed.items())
    assert needed[neardup.PERMS] > 0.55 * neardup.PERMS


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    wrong = []
    for _ in range(200):
        s = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = np.sort(s[:250]), np.sort(s[50:])
        wrong.append((neardup.signature(a) == neardup.signature(b)).mean() - 200 / 300)
    assert abs(np.mean(wrong)) < 0.01 and np.std(wrong) < 0.05


def test_drop_near_keeps_one_of_each_group(docs_of):
    rng = random.Random(9)
    rows = list(enumerate(family(rng, 30, 120, 2) + ["", None, "alone here"])) + [(None, "x")]
    df = docs_of(rows)
    out = neardup.drop_near(df)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(r[0]) for r in brute(rows, 5) if r[3])
