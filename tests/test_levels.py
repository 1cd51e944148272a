import math

import pytest

from cinerank.config import TableStore
from cinerank.sources import tables, versions
from cinerank.streaming.levels import Levels

SCHEMA = "uid int, v int"


def rows(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def data_files(spark, root):
    found = 0
    for name in versions.names(spark, root):
        if name.endswith(".parquet"):
            found += 1
        elif not name.startswith((".", "_")) and "." not in name:
            found += data_files(spark, f"{root}/{name}")
    return found


@pytest.mark.parametrize("latest", [False, True])
def test_many_batches_leave_few_files(spark, tmp_root, latest):
    table = Levels(f"{tmp_root}/t", SCHEMA, key="uid", latest=latest, fanout=4, retain_seconds=0)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for b in range(64):
            table.write_batch(rows(spark, [(b % 7, b)]).coalesce(1), 0, b)
            table.compact(spark, 0, b)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    got = sorted((r.uid, r.v, r.run_no, r.batch_id) for r in table.read(spark).collect())
    whole = [(b % 7, b, 0, b) for b in range(64)]
    if latest:
        assert set(got) <= set(whole) and {max(r[1] for r in got if r[0] == u) for u in range(7)} == set(range(57, 64))
    else:
        assert got == sorted(whole)
    _, value = table.state(spark)
    levels = math.ceil(math.log(64, 4))
    assert len(value["segments"]) <= 3 * levels and len(table.tail(spark, value)) <= 5
    assert data_files(spark, f"{tmp_root}/t") <= 2 * 3 * levels + 5 + 8      # what was replaced last is still there


def test_a_retried_batch_counts_once(spark, tmp_root):
    table = Levels(f"{tmp_root}/t", SCHEMA, fanout=2)
    for b in (0, 1, 1, 2, 2):
        table.write_batch(rows(spark, [(1, b)]), 0, b)
    assert table.compact(spark, 0, 2) == 1                      # batch 2 may come again
    table.write_batch(rows(spark, [(1, 2)]), 0, 2)
    table.write_batch(rows(spark, [(1, 0)]), 0, 0)              # from an old checkpoint: merged already
    assert sorted(r.v for r in table.read(spark).collect()) == [0, 1, 2]


def test_a_reader_stays_on_its_version(spark, tmp_root):
    table = Levels(f"{tmp_root}/t", SCHEMA, fanout=2, retain_seconds=3600)
    for b in range(3):
        table.write_batch(rows(spark, [(1, b)]), 0, b)
    before = table.read(spark)
    table.compact(spark, 0, 2)
    for b in range(3, 9):
        table.write_batch(rows(spark, [(1, b)]), 0, b)
        table.compact(spark, 0, b)
    assert sorted(r.v for r in before.collect()) == [0, 1, 2]
    assert sorted(r.v for r in table.read(spark).collect()) == list(range(9))


def test_runs_keep_their_numbers(spark, tmp_root):
    table = Levels(f"{tmp_root}/t", SCHEMA, fanout=2)
    assert [table.run_number(spark, r) for r in ("a", "b", "a", "c")] == [0, 1, 0, 2]
    table.write_batch(rows(spark, [(1, 1)]), 0, 0)
    table.write_batch(rows(spark, [(1, 2)]), 1, 0)
    assert table.compact(spark, 1, 0) == 0                      # one finished batch only
    assert table.compact(spark) == 1
    assert table.run_number(spark, "b") == 1 and table.read(spark).count() == 2


def test_empty_table_and_empty_batches(spark, tmp_root):
    table = Levels(f"{tmp_root}/t", SCHEMA, key="uid", latest=True, fanout=2)
    assert table.read(spark).count() == 0 and table.compact(spark) == 0
    for b in range(3):
        table.write_batch(rows(spark, []), 0, b)
    assert table.compact(spark, 0, 3) == 1 and table.read(spark).count() == 0


def test_two_writers_of_one_version(spark, tmp_root):
    versions.publish(spark, f"{tmp_root}/f", 1, {"a": 1})
    with pytest.raises(RuntimeError, match="another writer"):
        versions.publish(spark, f"{tmp_root}/f", 1, {"a": 2})
    assert versions.latest(spark, f"{tmp_root}/f") == (1, {"a": 1})


def test_a_refresh_leaves_running_readers_alone(spark, tmp_root):
    store = TableStore(tmp_root)
    tables.write_table(rows(spark, [(1, 1)]), "T", store)
    before = tables.read_table(spark, "T", store)
    tables.write_table(rows(spark, [(1, 2), (2, 2)]), "T", store)
    assert [r.v for r in before.collect()] == [1] and tables.read_table(spark, "T", store).count() == 2


def test_a_table_is_rewritten_from_itself(spark, tmp_root):
    store = TableStore(tmp_root)
    tables.write_table(rows(spark, [(i, i) for i in range(50)]), "T", store)
    for _ in range(3):
        tables.write_table(tables.read_table(spark, "T", store).selectExpr("uid", "v + 1 AS v"), "T", store)
    assert sorted(r.v for r in tables.read_table(spark, "T", store).collect()) == list(range(3, 53))


def test_a_failed_write_changes_nothing(spark, tmp_root):
    store = TableStore(tmp_root)
    tables.write_table(rows(spark, [(1, 1)]), "T", store)
    with pytest.raises(Exception, match="stop"):
        tables.write_table(rows(spark, [(1, 1)]).selectExpr("uid", "raise_error('stop') AS v"), "T", store)
    assert [r.v for r in tables.read_table(spark, "T", store).collect()] == [1]


def test_replaced_snapshots_go_after_a_while(spark, tmp_root):
    store = TableStore(tmp_root)
    for i in range(4):
        tables.write_table(rows(spark, [(1, i)]), "T", store, retain_seconds=0)
    assert sum(n.startswith("snap-") for n in versions.names(spark, f"{tmp_root}/T")) == 1
    for i in range(3):
        tables.write_table(rows(spark, [(1, i)]), "T", store)
    assert sum(n.startswith("snap-") for n in versions.names(spark, f"{tmp_root}/T")) == 4


def test_folders_written_elsewhere_are_read(spark, tmp_root):
    rows(spark, [(1, 7)]).write.parquet(f"{tmp_root}/T")
    assert [r.v for r in tables.read_table(spark, "T", TableStore(tmp_root)).collect()] == [7]
    assert tables.version_of(spark, "T", TableStore(tmp_root)) == 0 and tables.properties_of(spark, "T", TableStore(tmp_root)) == {}
