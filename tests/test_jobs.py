"""End-to-end: fixture rows written as the reference's text files, then the jobs."""

import pytest

from cinerank import jobs, schemas
from cinerank.config import TableStore
from cinerank.operators import similarity
from cinerank.sources import delimited, tables
from cinerank.sources import testdata as td
from cinerank.streaming import recommender

D = "/root/testdata/sf0.001"


def test_batch_jobs_end_to_end(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    for name, df, layout in (("movies", td.movies(spark, D), delimited.MOVIES),
                             ("ratings", td.ratings(spark, D), delimited.RATINGS),
                             ("tags", td.tags(spark, D), delimited.TAGS)):
        lines = delimited.render(df, layout)
        if name == "ratings":
            lines = lines.union(spark.createDataFrame([("1,x,3.0,5",)], "value string"))
        lines.write.text(f"{raw}/{name}")
    store = TableStore(f"{tmp_root}/tables")
    jobs.loader(spark, f"{raw}/movies", f"{raw}/ratings", f"{raw}/tags", store)
    assert tables.read_table(spark, "Rating", store, schemas.RATING).count() == td.ratings(spark, D).count()
    assert [r["reason"] for r in tables.read_table(spark, "RatingRejects", store).collect()] == ["bad_mid"]
    docs = tables.read_table(spark, "MovieWithTags", store, schemas.MOVIE_WITH_TAGS)
    assert docs.count() == td.movies(spark, D).count()

    jobs.statistics(spark, store, genres=["ring", "gear"])
    g = tables.read_table(spark, "GenresTopMovies", store, schemas.GENRE_RECS).collect()
    assert {r["genres"] for r in g} == {"ring", "gear"} and all(0 < len(r["recs"]) <= 10 for r in g)
    assert tables.read_table(spark, "RateMoreRecentMovies", store).columns == ["yyyymm", "mid", "count"]

    jobs.offline(spark, store, min_score=0.6, item_k=30)
    recs = tables.read_table(spark, "MovieRecsNested", store, schemas.MOVIE_RECS).collect()
    for r in recs:
        scores = [x["score"] for x in r["recs"]]
        assert scores == sorted(scores, reverse=True) and all(s > 0.6 for s in scores) and len(scores) <= 30
        assert r["mid"] not in {x["mid"] for x in r["recs"]}
    long_recs = jobs.similarity_long(spark, store, "MovieRecs")
    assert long_recs.count() == sum(len(r["recs"]) for r in recs)
    users = tables.read_table(spark, "UserRecs", store, schemas.USER_RECS).collect()
    assert users and all(len(u["recs"]) <= 20 for u in users)

    jobs.content_job(spark, store, k=5)
    c = tables.read_table(spark, "ContentMovieRecsNested", store, schemas.MOVIE_RECS).collect()
    assert c and all(len(r["recs"]) <= 5 for r in c)
    long_form = jobs.similarity_long(spark, store, "ContentMovieRecsNested")
    assert long_form.columns == ["mid", "rank", "rec_mid", "score"]
    assert long_form.count() == sum(len(r["recs"]) for r in c)
    stored = sorted(map(tuple, jobs.similarity_long(spark, store, "ContentMovieRecs").collect()))
    assert stored == sorted(map(tuple, long_form.collect()))

    jobs.content_job(spark, store, k=None)    # unbounded lists: long form only
    full = jobs.similarity_long(spark, store, "ContentMovieRecs")
    assert full.where("score <= 0").count() == 0 and full.count() >= len(stored)


def test_streaming_job_with_base_ratings(spark, tmp_root):
    store = TableStore(f"{tmp_root}/tables")
    tables.write_table(spark.createDataFrame([(7, 10, 5.0, 100)], schemas.RATING), "Rating", store)
    jobs.write_access_paths(spark, store, [jobs.RATING_BY_USER])
    sim = spark.createDataFrame([(11, 1, 10, 0.9), (11, 2, 12, 0.8), (10, 1, 11, 0.9), (12, 1, 11, 0.8)],
                                schemas.RANKED_SIMILARITY)
    tables.write_table(sim, "MovieRecs", store)
    with pytest.raises(ValueError, match="does not say"):          # lists of unknown length are refused
        jobs.streaming(spark, store, "parquet", f"{tmp_root}/in", f"{tmp_root}/ckpt0")
    jobs.write_similarity(sim, "MovieRecs", store, None)
    src = f"{tmp_root}/in"
    import datetime as dt
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "7|11|4.0|200")], "event_id long, ts timestamp_ntz, value string") \
        .write.parquet(f"{src}/b0")
    q = jobs.streaming(spark, store, "parquet", f"{src}/*/*.parquet", f"{tmp_root}/ckpt", available_now=True,
                       threshold=0.5)
    q.awaitTermination()
    cur = recommender_current(spark, store)
    # 10 is rated in the base table, so the only unseen candidate of 11 is 12
    assert cur == {7: [12]}


def stream_users(spark, store, root, messages, **options):
    import datetime as dt
    spark.createDataFrame([(i, dt.datetime(2024, 1, 1), m) for i, m in enumerate(messages, 1)],
                          "event_id long, ts timestamp_ntz, value string").write.mode("overwrite").parquet(f"{root}/in/b0")
    jobs.streaming(spark, store, "parquet", f"{root}/in/*/*.parquet", f"{root}/ckpt", available_now=True,
                   threshold=0.1, **options).awaitTermination()
    rows = recommender.current_recs(spark, jobs.stream_tables(store).recs).collect()
    return {r["uid"]: [(x["mid"], x["score"]) for x in r["recs"]] for r in rows}


def test_cut_lists_give_the_same_recommendations_as_whole_ones(spark, tmp_root):
    ratings = [(u, m, float((u * m) % 5 + 1), 100 + m) for u in range(1, 25) for m in range(1, 71)
               if (u == 1 and m <= 40) or (u * 7 + m * 3) % 5 == 0]
    cut, whole = TableStore(f"{tmp_root}/cut"), TableStore(f"{tmp_root}/whole")
    for store in (cut, whole):
        tables.write_table(spark.createDataFrame(ratings, schemas.RATING), "Rating", store)
        jobs.write_access_paths(spark, store, [jobs.RATING_BY_USER])
    jobs.offline(spark, cut, min_score=-0.2, item_k=4)
    factors = tables.read_table(spark, "ItemFactors", cut)
    jobs.write_similarity(similarity.dense_similarity(factors, min_score=-0.2), "MovieRecs", whole, None)
    tables.write_table(factors, "ItemFactors", whole)
    assert jobs.list_cut(spark, cut, "MovieRecs") == (4, -0.2) and jobs.list_cut(spark, whole, "MovieRecs") is None
    messages = ["1|7|5.0|900", "2|9|4.0|900", "3|7|2.0|900", "900|11|5.0|900", "901|999|5.0|900"]
    want = stream_users(spark, whole, f"{tmp_root}/w", messages, factors_table="ItemFactors")
    # a heavy user, two others, one new user, one whose item has no list; pairs by the factors even if not asked for
    assert want[901] == [] and all(len(want[u]) > 4 for u in (1, 2, 3))
    assert stream_users(spark, cut, f"{tmp_root}/c", messages) == want


def test_streaming_refuses_cut_lists_it_cannot_complete(spark, tmp_root):
    store = TableStore(f"{tmp_root}/tables")
    tables.write_table(td.movies(spark, D), "Movie", store)
    jobs.content_job(spark, store, k=2)
    with pytest.raises(ValueError, match="cut to 2 entries"):
        jobs.streaming(spark, store, "parquet", f"{tmp_root}/in", f"{tmp_root}/ckpt", sim_table="ContentMovieRecs")


def recommender_current(spark, store):
    from cinerank.streaming import recommender
    rows = recommender.current_recs(spark, jobs.stream_tables(store).recs).collect()
    return {r["uid"]: [x["mid"] for x in r["recs"]] for r in rows}


def test_command_line_entry(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    spark.createDataFrame([("1^Heat^d^t^s^i^l^Action|Crime^x^y",), ("2^Up^d^t^s^i^l^Animation^x^y",)],
                          "value string").write.text(f"{raw}/movies")
    spark.createDataFrame([("7,1,4.5,1425168000",), ("8,1,3.0,1425167999",), ("8,2,5.0,1425168000",)],
                          "value string").write.text(f"{raw}/ratings")
    spark.createDataFrame([("7,1,heist,1",)], "value string").write.text(f"{raw}/tags")
    root = f"{tmp_root}/tables"
    jobs.main(["loader", "--root", root, "--movies", f"{raw}/movies", "--ratings", f"{raw}/ratings",
               "--tags", f"{raw}/tags"])
    jobs.main(["statistics", "--root", root])
    jobs.main(["content", "--root", root, "--k", "1", "--include-zero"])
    store = TableStore(root)
    months = {tuple(r) for r in tables.read_table(spark, "RateMoreRecentMovies", store).collect()}
    assert months == {(201503, 1, 1), (201502, 1, 1), (201503, 2, 1)}
    top = {r["genres"]: [x["mid"] for x in r["recs"]]
           for r in tables.read_table(spark, "GenresTopMovies", store, schemas.GENRE_RECS).collect()}
    assert top == {"Action": [1], "Crime": [1], "Animation": [2]}
    docs = {r["mid"]: r["tags"] for r in tables.read_table(spark, "MovieWithTags", store).collect()}
    assert docs == {1: "heist", 2: None}
    lists = {tuple(r) for r in jobs.similarity_long(spark, store, "ContentMovieRecs").collect()}
    assert lists == {(1, 1, 2, 0.0), (2, 1, 1, 0.0)}          # no shared genre: zero-score fill


def test_content_job_hashed_paths(spark, tmp_root):
    store = TableStore(f"{tmp_root}/tables")
    tables.write_table(td.movies(spark, D), "Movie", store)
    jobs.content_job(spark, store, k=3, hashed=True)
    bounded = jobs.similarity_long(spark, store, "ContentMovieRecs")
    assert bounded.groupBy("mid").count().where("count > 3").count() == 0
    n_bounded = bounded.count()
    jobs.content_job(spark, store, k=None, hashed=True)
    full = jobs.similarity_long(spark, store, "ContentMovieRecs")
    assert full.count() >= n_bounded and full.where("score <= 0").count() == 0


def test_a_running_stream_takes_over_refreshed_lists(spark, tmp_root):
    """Two offline runs under one query: a batch sees lists and factors of one run only."""
    import datetime as dt
    store = TableStore(f"{tmp_root}/tables")
    vectors = lambda rows: spark.createDataFrame(rows, "mid int, features array<double>")
    lists = lambda rows: spark.createDataFrame(rows, schemas.RANKED_SIMILARITY)
    tables.write_table(vectors([(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])]), "ItemFactors", store, properties={"run": "a"})
    jobs.write_similarity(lists([(1, 1, 2, 0.995037)]), "MovieRecs", store, None, run="a")
    sides = jobs.Followed(spark, store, "MovieRecs", "ItemFactors", False)
    t = jobs.stream_tables(store)
    handle = recommender.make_batch_handler(sides, t, threshold=0.5)
    batch = lambda i: spark.createDataFrame([(i, dt.datetime(2024, 1, 1), f"{i}|1|5.0|{i}")], "event_id long, ts timestamp, value string")
    handle(batch(1), 0)
    held = sides.sides
    tables.write_table(vectors([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.1])]), "ItemFactors", store, properties={"run": "b"})
    handle(batch(2), 1)                                        # the new lists are not there yet
    assert sides.sides is held
    jobs.write_similarity(lists([(1, 1, 3, 0.995037)]), "MovieRecs", store, None, run="b")
    handle(batch(3), 2)
    got = {r["uid"]: [(x["mid"], x["score"]) for x in r["recs"]] for r in recommender.current_recs(spark, t.recs).collect()}
    score = round(5 / 1.01 ** 0.5, 6)
    assert got[1] == got[2] == [(2, pytest.approx(score, abs=2e-5))] and got[3] == [(3, pytest.approx(score, abs=2e-5))]
    assert jobs.compact(spark, store) == 0


def test_keyed_paths_prune(spark, tmp_root):
    from test_streaming import scanned_rows
    store = TableStore(f"{tmp_root}/tables")
    for name, df in (("Movie", td.movies(spark, D)), ("Rating", td.ratings(spark, D)), ("Tag", td.tags(spark, D))):
        tables.write_table(df, name, store)
    jobs.write_access_paths(spark, store)
    for name, (table, schema, key) in jobs.ACCESS_PATHS.items():
        rows = tables.read_table(spark, name, store, schema)
        plan = rows.where(f"{key} = 5")._jdf.queryExecution().executedPlan().toString()
        assert f"EqualTo({key},5)" in plan.split("PushedFilters:")[1]
        assert sorted(map(tuple, rows.collect()), key=str) == sorted(map(tuple, tables.read_table(spark, table, store, schema).collect()), key=str)
        absent = spark.createDataFrame([(10_000_000,)], f"{key} int")
        assert scanned_rows(tables.of_keys(rows, absent, key)) == (0, 0)
