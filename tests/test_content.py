from cinerank import schemas
from cinerank.operators import content


def movies(spark, rows):
    return spark.createDataFrame([(m, f"n{m}", "", "", "", "", "", g, "", "") for m, g in rows], schemas.MOVIE)


def test_empty_genres_have_no_terms_but_count_as_documents(spark):
    mv = movies(spark, [(1, "Drama|Comedy"), (2, ""), (3, "drama")])
    rows = {(r["mid"], r["term"]): r for r in content.tfidf_terms(mv).collect()}
    assert set(rows) == {(1, "drama"), (1, "comedy"), (3, "drama")}
    import math
    assert abs(rows[(1, "drama")]["idf"] - math.log(4 / 3)) < 1e-12      # m = 3 documents, df = 2
    assert abs(rows[(1, "comedy")]["idf"] - math.log(4 / 2)) < 1e-12
    sims = content.content_similarity(mv, k=5).collect()
    assert all(r["mid"] != 2 and r["rec_mid"] != 2 for r in sims)


def test_term_frequency_counts_repeats(spark):
    mv = movies(spark, [(1, "War|war|Drama"), (2, "Drama")])
    tf = {(r["mid"], r["term"]): r["tf"] for r in content.tfidf_terms(mv).collect()}
    assert tf == {(1, "war"): 2, (1, "drama"): 1, (2, "drama"): 1}


def test_identical_genre_strings_score_one_and_rank_by_id(spark):
    mv = movies(spark, [(5, "a|b"), (3, "a|b"), (9, "a|b"), (4, "a|c")])
    got = [(r["rank"], r["rec_mid"], r["score"]) for r in content.content_similarity(mv, k=3).collect()
           if r["mid"] == 9]
    assert sorted(got)[:2] == [(1, 3, 1.0), (2, 5, 1.0)]


def test_include_zero_completes_lists_like_brute_force(spark):
    import math
    mv_rows = [(1, "a"), (2, "b"), (3, "a|c"), (4, ""), (5, "d"), (6, "b|d"), (7, "e")]
    mv = movies(spark, mv_rows)
    k = 4
    got = {(r["mid"], r["rank"]): (r["rec_mid"], r["score"])
           for r in content.content_similarity(mv, k=k, include_zero=True).collect()}
    # brute force: tf-idf cosine over all pairs, zeros kept, (score desc, id asc)
    docs = {m: [t for t in g.lower().replace("|", " ").split(" ") if t] for m, g in mv_rows}
    n = len(docs)
    df = {}
    for ts in docs.values():
        for t in set(ts):
            df[t] = df.get(t, 0) + 1
    vec = {m: {t: ts.count(t) * math.log((n + 1) / (df[t] + 1)) for t in set(ts)} for m, ts in docs.items()}
    norm = {m: math.sqrt(sum(w * w for w in v.values())) for m, v in vec.items()}
    exp = {}
    for a in docs:
        scored = []
        for b in docs:
            if a == b:
                continue
            dot = sum(w * vec[b].get(t, 0.0) for t, w in vec[a].items())
            s = round(dot / (norm[a] * norm[b]), 6) if norm[a] * norm[b] > 0 else 0.0
            scored.append((-s, b))
        for rank, (ns, b) in enumerate(sorted(scored)[:k], start=1):
            exp[(a, rank)] = (b, -ns + 0.0)
    assert got == exp
