"""Deletion of keys from rows that are already written: outputs, dead letters, publications.

An excise record clears a key's state; these functions clear the copies that earlier calls
left in tables. Only files that hold rows of the keys are rewritten. They are found by a scan
of the key columns, which row-group statistics narrow where the keys are few.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from urllib.parse import quote, unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.operators.published import rewrite_segments
from keyfold.plans.joins import broadcast_if_small
from keyfold.session import delete_file, delete_folder, file_uri, folder_names, move_file
from keyfold.sources.events import ENTITY

# Keys that are pushed into the scan as literals; more are found by the join alone.
PUSHED_KEYS = 1_000

# Where a rewrite is prepared; Spark's readers skip names with an underscore.
_STAGE = "_excise"

_FILE, _FOLDER = "_excise_file", "_excise_folder"


def last_excised(events: DataFrame) -> DataFrame:
    """``topic, key, offset`` of each key's last excise record. Null keys are a key."""
    gone = events.filter(F.col("payload").isNull())
    return gone.groupBy(*ENTITY).agg(F.max("offset").alias("offset"))


def excise_copies(
    gone: DataFrame,
    tables: Mapping[str, Sequence[str]],
    publications: Iterable[str] = (),
    *,
    order: str | None = None,
) -> dict[str, int]:
    """Delete keys from written tables and publications; files or segments rewritten, by path.

    ``gone`` has ``topic, key`` and, with ``order``, a column of that name: rows of the key
    that are behind it stay, so a key that came back keeps what is new. ``tables`` maps a
    folder to its two columns that hold topic and key, such as ``source_topic, key`` for dead
    letters. The keys are computed once for all of them.
    """
    marks = _Marks(gone, order)
    done = {path: _excise_files(marks, path, entity) for path, entity in tables.items()}
    for path in publications:
        done[path] = rewrite_segments(
            gone.sparkSession, path, lambda rows: marks.hit(rows, ENTITY), lambda rows: marks.left(rows, ENTITY)
        )
    return done


def excise_files(
    gone: DataFrame, path: str, *, entity: Sequence[str] = ENTITY, order: str | None = None
) -> int:
    """Delete keys' rows from a Parquet folder, with or without partition folders.

    Returns how many files were rewritten. Null keys match null keys; a row whose ``order``
    is null goes with its key. Files without the keys stay as they are, those whose rows all
    go disappear, and of a table that loses all rows an empty file keeps the columns. An
    empty or missing folder is left alone. The old files go before the new ones take their
    place, so a reader meets no row twice and none that is deleted, but may miss others for
    that moment: as with any overwrite, read when it is done. A run that was cut off is
    finished, or undone where nothing had been replaced, by the next or by
    ``finish_excision``. Folders that a file stream sink writes have their own list of
    files, so they are refused: write them with ``batch_writer``.
    """
    return _excise_files(_Marks(gone, order), path, entity)


def finish_excision(spark: SparkSession, path: str) -> None:
    """Bring a rewrite that was cut off to its end; does nothing if there is none."""
    stage = f"{path}/{_STAGE}"
    if "_SUCCESS" in folder_names(spark, f"{stage}/files"):
        _replace(spark, path)
    delete_folder(spark, stage)


class _Marks:
    """The keys to delete, computed once, and what they hit."""

    def __init__(self, gone: DataFrame, order: str | None) -> None:
        self.spark, self._order = gone.sparkSession, order
        newest = [] if order is None else [F.max(order).alias("_gone_order")]
        keys = gone.select(F.col("topic").alias("_gone_topic"), F.col("key").alias("_gone_key"), *(
            [] if order is None else [order]
        ))
        keys = keys.groupBy("_gone_topic", "_gone_key").agg(*newest) if newest else keys.distinct()
        self._marks = broadcast_if_small(keys)
        few = self._marks.select("_gone_key").distinct().limit(PUSHED_KEYS + 1).collect()
        self._few = None if len(few) > PUSHED_KEYS else [row[0] for row in few]

    def hit(self, rows: DataFrame, entity: Sequence[str]) -> DataFrame:
        """Rows of the keys."""
        if self._few is not None:
            key = F.col(entity[1])
            named = key.isin([k for k in self._few if k is not None])
            rows = rows.filter(named | key.isNull() if None in self._few else named)
        return rows.join(self._marks, self._same(rows, entity), "left_semi")

    def left(self, rows: DataFrame, entity: Sequence[str]) -> DataFrame:
        """Rows of all other keys."""
        return rows.join(self._marks, self._same(rows, entity), "left_anti")

    def _same(self, rows: DataFrame, entity: Sequence[str]) -> Column:
        topic, key = entity
        same = F.col(topic).eqNullSafe(F.col("_gone_topic")) & F.col(key).eqNullSafe(F.col("_gone_key"))
        if self._order is None or self._order not in rows.columns:
            return same
        return same & F.coalesce(F.col(self._order) <= F.col("_gone_order"), F.lit(True))


def _excise_files(marks: _Marks, path: str, entity: Sequence[str]) -> int:
    spark = marks.spark
    finish_excision(spark, path)
    names = folder_names(spark, path)
    if "_spark_metadata" in names:
        raise ValueError(f"{path}: a file stream sink lists its files; write it with batch_writer")
    if all(name.startswith(("_", ".")) for name in names):
        return 0
    base = file_uri(spark, path)
    table = spark.read.parquet(path)
    held = marks.hit(table.withColumn(_FILE, F.col("_metadata.file_path")), entity)
    # names of files, as a listing of the folder gives them to the driver anyway
    files = [row[0] for row in held.select(_FILE).distinct().collect()]
    if not files:
        return 0
    place = F.regexp_replace(F.col("_metadata.file_path"), "^[^:/]+:(//[^/]*)?", "")
    inside = F.substr(place, F.lit(len(urlsplit(base).path) + 2))
    folder = F.regexp_extract(inside, "^(.*)/[^/]*$", 1)
    old = spark.read.schema(table.schema).option("basePath", path).parquet(
        *[file_uri(spark, file, decoded=True) for file in files]
    )
    rows = marks.left(
        old.withColumn(_FOLDER, F.when(folder == "", ".").otherwise(folder)), entity
    ).drop(*_partition_columns(base, files))
    stage = f"{path}/{_STAGE}"
    rows.write.partitionBy(_FOLDER).parquet(f"{stage}/rows")
    if not _staged(spark, path) and table.select(F.col("_metadata.file_path")).distinct().count() == len(files):
        first = _inside(base, files[0])
        empty = rows.drop(_FOLDER).limit(0)
        empty.write.parquet(f"{stage}/rows/{_FOLDER}={quote(first or '.', safe='')}")
    # from here on the rewrite is decided: whoever comes next finishes it
    spark.createDataFrame([(file,) for file in files], "file string").write.parquet(f"{stage}/files")
    _replace(spark, path)
    delete_folder(spark, stage)
    return len(files)


def _inside(base: str, file: str) -> str:
    """The folder of a file below the table's, empty for the table's own."""
    return urlsplit(file).path[len(urlsplit(base).path) + 1:].rpartition("/")[0]


def _partition_columns(base: str, files: Sequence[str]) -> set[str]:
    """Columns that folder names hold, so that files do not."""
    parts = (part for file in files for part in _inside(base, file).split("/"))
    return {unquote(part).partition("=")[0] for part in parts if "=" in unquote(part)}


def _staged(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """New files: their folder in the stage and their name."""
    rows = f"{path}/{_STAGE}/rows"
    folders = [name for name in folder_names(spark, rows) if name.startswith(f"{_FOLDER}=")]
    return [
        (folder, name) for folder in folders
        for name in folder_names(spark, f"{rows}/{folder}") if not name.startswith(("_", "."))
    ]


def _replace(spark: SparkSession, path: str) -> None:
    """Delete the files listed in the stage and move the new ones in; may be repeated."""
    base, stage = file_uri(spark, path), f"{path}/{_STAGE}"
    for row in spark.read.schema("file string").parquet(f"{stage}/files").collect():
        delete_file(spark, row.file)
    for folder, name in _staged(spark, path):
        inside = unquote(folder.partition("=")[2])
        target = base if inside == "." else f"{base}/{inside}"
        move_file(spark, f"{stage}/rows/{folder}/{name}", target)
