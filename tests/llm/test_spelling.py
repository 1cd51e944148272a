import random
import re
import zlib

from cinerank.llm import spelling


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def edits_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, t = sorted((a, b), key=len)
    return any(t[:i] + t[i + 1:] == s for i in range(len(t)))


def brute(rows, least_length=6, least_count=5, ratio=5):
    n = {}
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = lower(run)
            if i is not None:
                h = zlib.crc32(f"{i}:{w}".encode())
                if h % 199 == 0:
                    w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] = n.get(w, 0) + 1
    n = {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}
    near = {w: [v for v in n if edits_one(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            form[w] = best
    out = []
    for w in n:
        r = w
        while r in form:
            r = form[r]
        out.append((w, form.get(w), r, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out, key=str)


def run(df, **how):
    return sorted((tuple(r) for r in spelling.variants(df, **how).collect()), key=str)


def random_docs(seed, n=400):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abÀ", k=rng.randint(5, 9))) for _ in range(60)]
    docs = []
    for i in range(n):
        words = [rng.choice(stems[:rng.randint(1, 60)]) for _ in range(rng.randint(0, 60))]
        words = [w.upper() if rng.random() < 0.1 else w for w in words]
        docs.append((i, rng.choice([" ", "×x÷ ", "1", "ā", "-", "’"]).join(words)))
    return docs


def test_equals_brute_force(docs_of):
    rows = random_docs(1) + [(None, "bannana banana " * 30), (7, "banana " * 300), (8, None), (9, ""), (9, "Banana bananas")]
    assert run(docs_of(rows)) == brute(rows)


def test_tiles_of_a_hot_group(docs_of, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 8)
    rows = random_docs(2, 300)
    assert run(docs_of(rows), least_count=1) == brute(rows, least_count=1)


def test_tile_finds_exactly_single_edits():
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(6, 9))) for _ in range(500)})
    pairs = set()
    for longer in range(6, 10):
        k = longer // 2
        for side, affix in (("front", lambda w, k=k: w[:k]), ("back", lambda w, k=k: w[-k:])):
            for a in {affix(w) for w in words}:
                group = [w for w in words if affix(w) == a and len(w) in (longer, longer - 1)]
                found = [(group[i], group[j]) for i, j in zip(*spelling.tile(group, group, longer, side))] if group else []
                assert len(found) == len(set(found)) and not pairs & set(found)      # every pair in one tile
                pairs |= set(found)
    assert pairs == {(a, b) for a in words for b in words if edits_one(a, b)}


def test_forms_lead_to_a_root(docs_of):
    rows = [(10_000 + i, "xlettera " * 5 + "xletterab " * 25 + "xletterabc " * 125) for i in range(1)]
    got = {r[0]: r for r in run(docs_of(rows))}
    assert got["xlettera"][1:3] == ("xletterab", "xletterabc") and got["xletterabc"][1:3] == (None, "xletterabc")


def test_code_points_are_deleted_by_checksum(docs_of):
    rows = [(i, "separate") for i in range(4000)]
    got = run(docs_of(rows), least_count=1)
    assert got == brute(rows, least_count=1) and len(got) > 3


def test_counts_are_handed_on_whole(docs_of, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    rows = random_docs(4, 120)
    assert run(docs_of(rows)) == brute(rows)


def test_empty_long_and_no_words(docs_of):
    assert run(docs_of([])) == []
    assert run(docs_of([(1, None), (2, "1234 ЖЖЖ")])) == []
    rows = [(1, "longword " * 100_000 + "a" * 50_000)]
    assert run(docs_of(rows)) == brute(rows)
