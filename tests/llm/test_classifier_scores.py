"""Whole scores of the two classifiers against plain implementations of their definitions."""

import math
import random
import zlib

import pytest

from cinerank.llm import quality, toxicity

WORDS = ["the", "Committee", "met", "again", "its", "report", "was", "read", "aloud", "nobody", "objected.", "Été", "день"]
NOISE = ["$$", "BUY", "NOW!!!", "###", "WIN", "|||", "99%", "idiot", "horrid", "xXx"]


def adam(n, gradient, epochs, eps):
    w, m, v = [0.0] * n, [0.0] * n, [0.0] * n
    for t in range(1, epochs + 1):
        for i, g in enumerate(gradient(w)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            w[i] -= 0.05 * (m[i] / (1 - 0.9 ** t)) / (math.sqrt(v[i] / (1 - 0.999 ** t)) + eps)
    return w


def sigmoid(z):
    return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def in_fold(i, k, held):
    return zlib.crc32(str(i).encode()) % k == held


# ------------------------------------------------------------------ quality
GROUPS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n\r", "\t", ".", ",", "!?", ";:",
          "'\"", "()[]{}<>", "|", "-_/\\", "#$%&*+=@^~`"]


def style(text):
    n_classes = len(GROUPS) + 3
    out = [0.0] * (n_classes ** 2 + 6)
    if not text:
        return out
    raw = text.encode()
    kind = [next((g for g, cs in enumerate(GROUPS) if b < 128 and chr(b) in cs),
                 len(GROUPS) + (0 if b < 128 else 1 if b < 192 else 2)) for b in raw]
    for a, b in zip(kind, kind[1:]):
        out[a * n_classes + b] += 1
    out[:-6] = [math.sqrt(x / max(1, len(raw) - 1)) for x in out[:-6]]
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    out[-6:] = [sum(a == b for a, b in zip(words, words[1:])) / n, 1 - len(set(words)) / n, 1 - len(set(lines)) / len(lines),
                sum(len(w) > 25 for w in words) / n, sum(w.upper() == w for w in words) / n, math.log1p(len(raw)) / 10]
    return out


def brute_quality(rows, positives):
    usable = [(i, t or "") for i, t in rows if i is not None and not in_fold(i, 5, 0)]
    least = {}
    for i, t in usable:
        key = __import__("hashlib").sha256(t.encode()).hexdigest()
        least[i] = min(least.get(i, (key, t)), (key, t))
    p = [style(least[i][1]) for i in positives if i in least]
    u = [style(t) for _, t in least.values()]
    assert min(len(p), len(u)) < 8                       # so the prior is 0.5 by definition
    both, d = p + u, len(p[0])
    mean = [sum(x[j] for x in both) / len(both) for j in range(d)]
    scale = [math.sqrt(sum((x[j] - mean[j]) ** 2 for x in both) / len(both)) + 1e-3 for j in range(d)]
    scaled = lambda x: [max(-6.0, min(6.0, (a - m) / s)) for a, m, s in zip(x, mean, scale)]
    ps, us = [scaled(x) for x in p], [scaled(x) for x in u]
    z = lambda w, x: sum(a * b for a, b in zip(w, x)) + w[-1]

    def gradient(w):
        zp, zu = [z(w, x) for x in ps], [z(w, x) for x in us]
        risk = sum(math.log1p(math.exp(a)) for a in zu) / len(zu) - 0.5 * sum(math.log1p(math.exp(a)) for a in zp) / len(zp)
        gu, minus = [sigmoid(a) / len(zu) for a in zu], [-0.5 * sigmoid(a) / len(zp) for a in zp]
        gp = [-a for a in minus] if risk < 0 else [0.5 * (sigmoid(a) - 1) / len(zp) + b for a, b in zip(zp, minus)]
        gu = [-a for a in gu] if risk < 0 else gu
        out = [1e-4 * w[j] + sum(g * x[j] for g, x in zip(gp, ps)) + sum(g * x[j] for g, x in zip(gu, us)) for j in range(d)]
        return out + [sum(gp) + sum(gu)]
    w = adam(d + 1, gradient, quality.EPOCHS, 1e-8)
    return [sigmoid(z(w, scaled(style(t or "")))) for _, t in rows]


def text(rng, fine):
    return " ".join(rng.choices(WORDS if fine else NOISE, k=rng.randint(3, 25)))


def repeated_rows(n, ids):
    rng = random.Random(4)
    return [(rng.randrange(ids), text(rng, k % 2)) for k in range(n)] + [(1, None), (2, ""), (3, "one")]


def test_quality_scores_equal_the_definition(spark, docs_of):
    rows = repeated_rows(24, 12)
    ids = sorted({i for i, _ in rows})[:5]
    labels = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, quality int")
    got = [(r.doc_id, r.score) for r in quality.classify(docs_of(rows).coalesce(1), labels).collect()]
    want = brute_quality(rows, [i for i in ids if not in_fold(i, 5, 0)])
    assert [i for i, _ in got] == [i for i, _ in rows]
    assert [s for _, s in got] == pytest.approx(want, abs=2e-3) and max(want) - min(want) > 0.3


# ------------------------------------------------------------------ toxicity
def grams(t):
    padded, out = f" {t.lower()} ", set()
    for n in (4, 5):
        for i in range(len(padded) - n + 1):
            h = 0
            for c in padded[i:i + n]:
                h = (h * 1_114_127 + ord(c)) % 2 ** 64
            out.add(((h + n) * 0x9E3779B97F4A7C15 % 2 ** 64) >> 46)
    return out


def brute_toxicity(rows, toxic_of):
    train = [(i, t or "", toxic_of[i]) for i, t in rows if i in toxic_of and not in_fold(i, 3, 1)]
    count = {True: {}, False: {}}
    for _, t, y in train:
        for g in grams(t):
            count[y][g] = count[y].get(g, 0) + 1
    n = {y: sum(1 for *_, z in train if z == y) for y in (True, False)}
    total = {y: sum(count[y].values()) + 2 ** 18 for y in count}
    ratio, used = {}, set()
    for g in count[True].keys() | count[False].keys():
        p, q = count[True].get(g, 0), count[False].get(g, 0)
        ratio[g] = math.log((p + 1) / total[True]) - math.log((q + 1) / total[False])
        odds = math.log((p + 0.5) / (n[True] - p + 0.5)) - math.log((q + 0.5) / (n[False] - q + 0.5))
        if abs(odds) >= 4.0 * math.sqrt(1 / (p + 0.5) + 1 / (q + 0.5)) / 2:
            used.add(g)
    least = {}
    for i, t, y in train:
        key = __import__("hashlib").sha256(t.encode()).hexdigest()
        least[i, y] = min(least.get((i, y), (key, t)), (key, t))
    docs = [(grams(t) & used, y) for (_, y), (_, t) in least.items()]
    cols = sorted(set().union(*[g for g, _ in docs]))
    at = {g: j for j, g in enumerate(cols)}
    k = {y: sum(z == y for _, z in docs) for y in (True, False)}

    def gradient(w):
        out = [1e-4 * a for a in w[:-1]] + [0.0]
        for g, y in docs:
            s = 0.5 / k[y] * (sigmoid(sum(ratio[x] * w[at[x]] for x in g) + w[-1]) - y)
            out[-1] += s
            for x in g:
                out[at[x]] += ratio[x] * s
        return out
    w = adam(len(cols) + 1, gradient, toxicity.EPOCHS, 1e-10)
    mean = max(0.0, sum(w[:-1]) / len(cols))
    weight = {g: ratio[g] * (w[at[g]] if g in at else mean) for g in used}
    return [sigmoid(sum(weight.get(g, 0.0) for g in grams(t or "")) + w[-1]) for _, t in rows]


def test_toxicity_scores_equal_the_definition(spark, docs_of):
    rng = random.Random(2)
    rows = [(i, text(rng, i % 2)) for i in range(90)] + [(i, text(rng, i % 2)) for i in range(20)] + [(500, None), (501, "déjà день")]
    toxic_of = {i: i % 2 == 0 for i in range(70)}
    labels = spark.createDataFrame([(i, int(y)) for i, y in toxic_of.items()], "doc_id long, toxic int")
    got = [(r.doc_id, r.score) for r in toxicity.classify(docs_of(rows).coalesce(1), labels).collect()]
    want = brute_toxicity(rows, toxic_of)
    assert [i for i, _ in got] == [i for i, _ in rows]
    assert [s for _, s in got] == pytest.approx(want, abs=2e-3) and max(want) - min(want) > 0.5


def test_ngrams_are_of_characters():
    for t in ("", "a", "день", "Ünïté 漢字かな", "😀😀😀"):
        assert set(toxicity.ngrams(t).tolist()) == grams(t)


def test_fitting_is_bounded_by_ngrams(spark, docs_of):
    rows = [(i, ("horrid idiot " if i % 2 else "a sunny day ") + f"number {i} " * 40) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.fit(docs_of(rows), labels, grams=1)          # one document of each class
    assert model.score("horrid idiot") > 0.7 and model.score("a sunny day") < 0.3


@pytest.mark.parametrize("op", [quality, toxicity])
def test_scores_do_not_depend_on_partitions(spark, docs_of, op):
    rows = repeated_rows(150, 40)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    got = []
    for parts in (1, 3, 11):
        df = docs_of(rows).repartition(parts, "text")
        got.append(sorted(((r.doc_id, r.score) for r in op.classify(df, labels).collect()), key=str))
    assert got[0] == got[1] == got[2]
