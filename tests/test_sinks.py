"""Result tables."""

import os

import pytest
from pyspark.errors import AnalysisException

from conftest import rows
from skyledger.schema import RESULT_TABLES, conform
from skyledger.session import new_dir, session_conf, shared_dir
from skyledger.sinks import (
    batch_writer,
    compact_changes,
    prune_results,
    read_changes,
    read_latest,
    read_table,
    write_table,
)


@pytest.fixture
def means(spark):
    return spark.createDataFrame(
        [(1.5, "BOS", "ATL", "x"), (-2.0, "ATL", "BOS", "y")],
        "arrdelay FLOAT, origin STRING, dest STRING, note STRING")


def same(df):
    return df


def test_table_has_its_declared_columns(spark, means, folder):
    root = folder()
    write_table(means, "results24", root)
    back = read_table(spark, "results24", root)
    assert back.schema == RESULT_TABLES["results24"].schema
    assert rows(back) == [("ATL", "BOS", -2.0), ("BOS", "ATL", 1.5)]


def test_table_refuses_existing_data(means, folder):
    root = folder()
    write_table(means, "results24", root)
    with pytest.raises(AnalysisException):
        write_table(means, "results24", root)


@pytest.mark.parametrize("fmt", ["orc", "json", "csv"])
def test_table_format_is_a_parameter(spark, means, folder, fmt):
    root = folder()
    write_table(means, "results24", root, fmt)
    assert rows(read_table(spark, "results24", root, fmt)) == [("ATL", "BOS", -2.0), ("BOS", "ATL", 1.5)]


def test_every_key_is_a_column():
    for table in RESULT_TABLES.values():
        assert set(table.keys) <= set(table.schema.fieldNames())


def test_conform_refuses_a_missing_column(means):
    with pytest.raises(AnalysisException):
        conform(means.drop("dest"), RESULT_TABLES["results24"].schema).collect()


def test_replayed_batch_replaces_itself(spark, means, folder):
    path = folder()
    write = batch_writer(path, same)
    write(means, 0)
    write(means, 1)
    write(means.limit(1), 1)
    assert read_latest(spark, path).count() == 1


def test_batch_ids_are_ordered_as_numbers(spark, means, folder):
    path = folder()
    for i in (9, 10):
        batch_writer(path, lambda df, i=i: df.selectExpr(f"{i} AS i").limit(1))(means, i)
    assert rows(read_latest(spark, path)) == [(10,)]


def test_unfinished_batch_is_not_read(spark, means, folder):
    path = folder()
    write = batch_writer(path, same)
    write(means, 0)
    write(means.limit(1), 1)
    os.remove(f"{path}/batch_id=1/_SUCCESS")
    assert read_latest(spark, path).count() == 2
    assert read_changes(spark, path, ("origin", "dest")).count() == 2


def test_newest_row_per_key_before_and_after_folding(spark, folder):
    path = folder()

    def write(batch_id, *data):
        batch_writer(path, same)(spark.createDataFrame(data, "k STRING, v INT"), batch_id)

    def batches(where):
        return sorted(name for name in os.listdir(where) if name.startswith("batch_id"))

    write(0, ("a", 1), ("b", 1))
    write(1, ("b", 2), ("c", 0))
    write(2, ("a", None))
    newest = [("a", None), ("b", 2), ("c", 0)]
    assert rows(read_changes(spark, path, ("k",))) == newest
    assert compact_changes(spark, path, ("k",)) == 2
    assert len(batches(path)) == 3
    assert rows(read_changes(spark, path, ("k",))) == newest
    write(3, ("c", 3))
    newest[2] = ("c", 3)
    assert rows(read_changes(spark, path, ("k",))) == newest
    assert compact_changes(spark, path, ("k",)) == 3
    assert batches(path) == ["batch_id=3"]
    assert rows(read_changes(spark, path, ("k",))) == newest
    assert compact_changes(spark, path, ("k",)) == 3
    assert batches(path) == [] and batches(f"{path}-folded") == ["batch_id=3"]
    assert rows(read_changes(spark, path, ("k",))) == newest


def test_old_results_are_pruned(spark, means, folder):
    path = folder()
    for i in range(4):
        batch_writer(path, same)(means, i)
    prune_results(spark, path, 2)
    assert sorted(os.listdir(path)) == ["batch_id=2", "batch_id=3"]
    assert read_latest(spark, path).count() == 2


def test_finish_may_read_its_batch_twice(spark, means, folder):
    path = folder()
    batch_writer(path, lambda df: df.unionByName(df), reread=True)(means, 0)
    assert read_latest(spark, path).count() == 4


def test_show_prints_stored_rows(means, folder, capsys):
    batch_writer(folder(), same, show=5)(means, 0)
    assert "origin" in capsys.readouterr().out


class Session:
    """As much of a session as ``shared_dir`` looks at."""

    def __init__(self, master, settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})()


def test_shared_folder_is_the_one_the_cluster_names():
    assert shared_dir(Session("yarn", {"spark.checkpoint.dir": "hdfs://x/shared/"})) == "hdfs://x/shared"


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn", {}))


def test_new_folders_differ(spark):
    assert new_dir(spark, "x").startswith(shared_dir(spark) + "/x-")
    assert new_dir(spark, "x") != new_dir(spark, "x")


def test_session_conf_is_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with session_conf(spark, spark__sql__shuffle__partitions=3):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == before
