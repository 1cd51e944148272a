
from cinerank import schemas
from cinerank.functions.columns import register_change_date, yyyymm_of_epoch
from cinerank.operators import stats


def movies(spark, rows):
    full = [(m, f"n{m}", "", "", "", "", "", g, "", "") for m, g in rows]
    return spark.createDataFrame(full, schemas.MOVIE)


def test_repeated_tags_are_distinct_and_sorted_and_untagged_is_null(spark):
    tags = spark.createDataFrame([(1, 10, "a", 0), (2, 10, "a", 0), (2, 10, "b", 0)], schemas.TAG)
    docs = stats.search_documents(movies(spark, [(10, "x"), (11, "y")]), tags)
    got = {r["mid"]: r["tags"] for r in docs.collect()}
    assert got == {10: "a|b", 11: None}


def test_month_edge_in_utc(spark):
    df = spark.createDataFrame([(1425167999,), (1425168000,)], "ts int")
    assert [r[0] for r in df.select(yyyymm_of_epoch("ts")).collect()] == [201502, 201503]
    register_change_date(spark)
    assert spark.sql("SELECT change_date(1425167999), change_date(1425168000)").first() == (201502, 201503)


def test_most_rated_sorted_desc(spark):
    r = spark.createDataFrame([(1, 5, 1.0, 0), (2, 5, 1.0, 0), (1, 7, 1.0, 0)], schemas.RATING)
    assert [tuple(x) for x in stats.most_rated(r).collect()] == [(5, 2), (7, 1)]


def test_equal_averages_keep_lowest_ten_mids(spark):
    mv = movies(spark, [(m, "Drama") for m in range(12, 0, -1)])
    r = spark.createDataFrame([(1, m, 4.0, 0) for m in range(1, 13)], schemas.RATING)
    top = stats.genre_top(mv, r, ["Drama"], 10).orderBy("rank").collect()
    assert [x["mid"] for x in top] == list(range(1, 11))
    assert [x["rank"] for x in top] == list(range(1, 11))


def test_genre_substring_vs_token_match(spark):
    mv = movies(spark, [(1, "cold|SMALL"), (2, "old"), (3, "Warm")])
    sub = {(r["genre"], r["mid"]) for r in stats.genre_matches(mv, ["old", "small", "War"]).collect()}
    assert sub == {("old", 1), ("old", 2), ("small", 1), ("War", 3)}
    tok = {(r["genre"], r["mid"]) for r in stats.genre_matches(mv, ["old", "small", "War"], "token").collect()}
    assert tok == {("old", 2), ("small", 1)}


def test_nested_genre_recs_are_ordered(spark):
    mv = movies(spark, [(1, "Drama"), (2, "Drama"), (3, "Drama")])
    r = spark.createDataFrame([(1, 1, 2.0, 0), (1, 2, 5.0, 0), (1, 3, 3.0, 0)], schemas.RATING)
    row = stats.genre_top_nested(mv, r, ["Drama"], 2).first()
    assert [(x["mid"], x["score"]) for x in row["recs"]] == [(2, 5.0), (3, 3.0)]


def test_grid_size_from_counts(spark):
    r = spark.createDataFrame([(1, 5, 1.0, 0), (1, 6, 1.0, 0), (2, 7, 1.0, 0), (2, 7, 2.0, 0)], schemas.RATING)
    got = {x["uid"]: (x["n_rated"], x["n_unrated"]) for x in stats.unrated_grid_size(r).collect()}
    assert got == {1: (2, 1), 2: (1, 2)}


def test_most_rated_as_written_is_ascending(spark):
    r = spark.createDataFrame([(1, 5, 1.0, 0), (2, 5, 1.0, 0), (1, 7, 1.0, 0)], schemas.RATING)
    assert [tuple(x) for x in stats.most_rated(r, as_written=True).collect()] == [(7, 1), (5, 2)]
