
from cinerank import schemas
from cinerank.config import TableStore
from cinerank.sources import tables


def recs_df(spark):
    return spark.createDataFrame([(1, [(2, 0.9), (3, 0.8), (2, 0.5)]), (4, [])], schemas.MOVIE_RECS)


def test_explode_and_map(spark):
    long_rows = [tuple(r) for r in tables.explode_recs(recs_df(spark), "mid").orderBy("mid", "rank").collect()]
    assert long_rows == [(1, 1, 2, 0.9), (1, 2, 3, 0.8), (1, 3, 2, 0.5)]
    maps = {r["mid"]: r["sims"] for r in tables.recs_as_map(recs_df(spark), "mid").collect()}
    assert maps == {1: {2: 0.5, 3: 0.8}, 4: {}}


def test_write_read_conform_and_upsert(spark, tmp_root):
    store = TableStore(tmp_root)
    df = spark.createDataFrame([(1, 2, 3.0, 4, "extra")], "uid long, mid long, score double, timestamp int, x string")
    tables.write_table(df, "Rating", store)
    back = tables.read_table(spark, "Rating", store, schemas.RATING)
    assert back.schema == schemas.RATING and [tuple(r) for r in back.collect()] == [(1, 2, 3.0, 4)]
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "mid int, name string")
    tables.upsert_documents(docs, "mid", "Docs", store)
    assert tables.read_table(spark, "Docs", store).count() == 2


def test_clustered_layout_avoids_shuffle(spark, tmp_root):
    store = TableStore(tmp_root)
    df = spark.createDataFrame([(u % 5, u, 1.0, 0) for u in range(50)], schemas.RATING)
    tables.write_clustered(df, "rating_layout_test", store, key="uid", buckets=4)
    agg = spark.table("rating_layout_test").groupBy("uid").count()
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    assert {r["uid"]: r["count"] for r in agg.collect()} == {u: 10 for u in range(5)}


def test_parse_recent_lists(spark):
    df = spark.createDataFrame([("uid:7", ["1061:3.0", " 12 : 4.5", "bad", "9:x"]), ("uid:x", ["1:1.0"])],
                               "key string, items array<string>")
    got = [tuple(r) for r in tables.parse_recent_lists(df).orderBy("rank").collect()]
    assert got == [(7, 1, 1061, 3.0), (7, 2, 12, 4.5)]
