"""Table sinks and the shared folder."""

import os

import pytest

from tallyworks.plans import catalogue
from tallyworks.sinks import tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "course string, n int, batch string")


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_shared_folder_is_the_configured_one(spark):
    assert tables.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert tables.fresh_path(spark, "t").startswith(tables.shared_folder(spark))
    assert tables.fresh_path(spark, "t") != tables.fresh_path(spark, "t")


def test_create_append_and_drop(spark, frame, tmp_path):
    tables.create_table_as(frame, "t_create", str(tmp_path / "t"))
    tables.create_table_as(frame.limit(0), "t_create", str(tmp_path / "t"))  # already there: left alone
    assert rows(spark.table("t_create")) == rows(frame)
    tables.append_rows(frame.where("n = 1"), "t_create")
    assert rows(spark.table("t_create")) == sorted(rows(frame) + [("a", 1, "x")])
    spark.sql("DROP TABLE IF EXISTS t_create")
    assert not spark.catalog.tableExists("t_create")


def test_overwriting_one_partition_keeps_the_others(spark, frame, tmp_path):
    path = str(tmp_path / "p")
    tables.overwrite_partitions(frame, path)
    tables.overwrite_partitions(spark.createDataFrame([("c", 3, "y")], frame.schema), path)
    assert rows(tables.read_partitioned(spark, path, frame.schema)) == [("a", 1, "x"), ("c", 3, "y")]


def test_partitioned_layout_on_disk(spark):
    _, path = catalogue._partitioned_layout(spark, FOLDER)
    folders = [f for f in os.listdir(path) if f.startswith("batch=")]
    assert len(folders) == 7
    files = [f for f in os.listdir(os.path.join(path, folders[0])) if f.endswith(".orc")]
    # tasks own whole groups of rows, so a folder holds few files beyond its four buckets
    assert 1 <= len(files) <= 16


def test_partition_column_stays_text(spark):
    assert dict(catalogue._partitioned_roster(spark, FOLDER).dtypes)["batch"] == "string"
