"""Deleting keys from written tables: against plain filters, and which files are touched."""

from __future__ import annotations

import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from keyfold import definitions as d
from keyfold.operators import copies, published

ROW = "topic string, key string, offset long, note string"
GONE = "topic string, key string, offset long"
START = datetime(2024, 3, 1, tzinfo=timezone.utc)


def parts(path):
    """Data files below a folder, by their place in it."""
    return {
        os.path.relpath(os.path.join(folder, name), path)
        for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")
    }


def some_rows(n):
    """A third of the rows have one key, some have none."""
    keys = ["hot", "a", "hot", "b", None, "c", "hot", "d", "e"]
    return [("t" if i % 2 else "u", keys[i % 9], i, f"n{i}") for i in range(n)]


def expected(data, gone, order):
    marks = {(topic, key): offset for topic, key, offset in gone}
    return sorted(
        (row for row in data if row[:2] not in marks or (order and row[2] > marks[row[:2]])), key=repr
    )


@pytest.mark.parametrize("order", [None, "offset"])
@pytest.mark.parametrize("pushed", [copies.PUSHED_KEYS, 1])
def test_rows_of_keys_go_from_all_folders(spark, rows, tmp_path, monkeypatch, order, pushed):
    monkeypatch.setattr(copies, "PUSHED_KEYS", pushed)
    data, path = some_rows(90), str(tmp_path / "table")
    frame = spark.createDataFrame(data, ROW).repartition(3)
    frame.withColumn("day", F.concat(F.lit("x 0"), F.col("offset") % 4)).write.partitionBy("day").parquet(path)
    gone = [("t", "hot", 40), ("u", None, 30), ("t", "nobody", 5)]
    assert copies.excise_files(spark.createDataFrame(gone, GONE), path, order=order) > 0
    left = spark.read.parquet(path)
    assert rows(left, "topic", "key", "offset", "note") == expected(data, gone, order)
    assert left.filter("day <> concat('x 0', offset % 4)").count() == 0
    assert copies.excise_files(spark.createDataFrame(gone, GONE), path, order=order) == 0


def test_files_without_the_keys_stay(spark, rows, tmp_path):
    path = str(tmp_path)
    for key in "abc":
        spark.createDataFrame([("t", key, 1, "x")], ROW).coalesce(1).write.mode("append").parquet(path)
    before = parts(path)
    assert copies.excise_files(spark.createDataFrame([("t", "b", 9)], GONE), path) == 1
    after = parts(path)
    assert len(before & after) == 2 and after <= before
    assert rows(spark.read.parquet(path), "key") == [("a",), ("c",)]


def test_all_rows_go_but_the_columns_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.createDataFrame([("t", "a", 1, "x"), ("t", "a", 2, "y")], ROW)
    frame.write.partitionBy("offset").parquet(path)
    copies.excise_files(spark.createDataFrame([("t", "a", 9)], GONE), path)
    left = spark.read.parquet(path)
    assert left.count() == 0 and set(left.columns) == {"topic", "key", "offset", "note"}


def test_nothing_to_do(spark, tmp_path):
    none, missing = spark.createDataFrame([], GONE), str(tmp_path / "missing")
    assert copies.excise_files(spark.createDataFrame([("t", "a", 1)], GONE), missing) == 0
    path = str(tmp_path / "t")
    spark.createDataFrame(some_rows(9), ROW).write.parquet(path)
    before = parts(path)
    assert copies.excise_files(none, path) == 0 and parts(path) == before
    os.makedirs(f"{path}/_spark_metadata")
    with pytest.raises(ValueError, match="batch_writer"):
        copies.excise_files(none, path)


@pytest.mark.parametrize("moved", [False, True])
def test_a_run_cut_off_is_finished(spark, rows, tmp_path, monkeypatch, moved):
    data, path = some_rows(40), str(tmp_path)
    spark.createDataFrame(data, ROW).repartition(4).write.mode("append").parquet(path)
    gone = [("t", "hot", 99)]
    marks = spark.createDataFrame(gone, GONE)
    step, calls = copies.move_file if moved else copies.delete_file, []

    def cut_off(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        return step(*args)

    name = "move_file" if moved else "delete_file"
    with monkeypatch.context() as patched:
        patched.setattr(copies, name, cut_off)
        with pytest.raises(OSError):
            copies.excise_files(marks, path)
    copies.finish_excision(spark, path)
    assert rows(spark.read.parquet(path), "topic", "key", "offset", "note") == expected(data, gone, None)
    assert "_excise" not in os.listdir(path)


def test_a_run_cut_off_early_is_undone(spark, tmp_path):
    path = str(tmp_path)
    spark.createDataFrame(some_rows(9), ROW).write.mode("append").parquet(path)
    before = parts(path)
    spark.createDataFrame(some_rows(5), ROW).write.parquet(f"{path}/_excise/rows")
    copies.finish_excision(spark, path)
    assert parts(path) == before and "_excise" not in os.listdir(path)


def test_publications_lose_a_key_in_every_batch(spark, rows, tmp_path):
    path = str(tmp_path / "state")
    latest = d.value("latest", published=True, read_cache=False)
    place = {"subsystem": "shop", "group_id": "g"}
    schema = "topic string, key string, value string, offset long"
    for batch in range(4):
        data = [("t", key, f"secret-{key}-{batch}", batch * 10) for key in ("a", "b", None)]
        data += [("t", f"k{batch}-{i}", "v", batch * 10) for i in range(40 >> batch)]
        published.publish_changes(
            spark.createDataFrame(data, schema), path, latest, batch_id=batch,
            as_of=START + timedelta(hours=batch), kept=3, **place,
        )
    gone = spark.createDataFrame([("t", "a", 99), ("t", "b", 20), ("t", None, 99)], GONE)
    done = copies.excise_copies(gone, {}, [path], order="offset")
    assert done[path] > 0
    reader = published.PublishedReader(spark, path, "shop", latest)
    left = rows(reader.snapshot().filter("key is null or length(key) = 1"), "key", "value")
    assert left == [("b", "secret-b-3")]
    stored = spark.read.parquet(f"{path}/state/shop/latest/g/*")
    assert rows(stored.filter("value like 'secret%'").distinct(), "value") == [("secret-b-3",)]
    assert copies.excise_copies(gone, {}, [path], order="offset")[path] == 0
    more = spark.createDataFrame([("t", "a", "new", 100)], schema)
    published.publish_changes(
        more, path, latest, batch_id=4, as_of=START + timedelta(hours=5), **place
    )
    assert rows(reader.snapshot().filter("key = 'a'"), "value") == [("new",)]
