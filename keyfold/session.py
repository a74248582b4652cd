"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)
_ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator assumes to an existing session.

    Event times are instants, so the session zone is pinned to UTC. Adaptive
    execution picks broadcast joins from measured sizes and splits skewed join
    partitions; operators ask for a broadcast only after counting the rows.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set(f"{_ROCKSDB}.changelogCheckpointing.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and staged tables, visible to every executor.

    Comes from ``spark.checkpoint.dir``. Only a local session may fall back to a
    scratch folder; on a cluster a machine-local folder would be lost with its
    executor, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="keyfold-")


def pinned(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    Cuts lineage, and fixes values such as partition numbers that a recomputed task
    could assign differently. The folder survives the loss of executors.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return [status.getPath().getName() for status in files.listStatus(place)]


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the library's own, in whatever store it is."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def file_uri(spark: SparkSession, path: str, decoded: bool = False) -> str:
    """The full address of a path, encoded as ``_metadata.file_path`` is.

    With ``decoded`` the other way: the path of such an address, as readers take it.
    """
    if decoded:
        return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path)).toString()
    files, place = _file_system(spark, path)
    return files.makeQualified(place).toUri().toString()


def delete_file(spark: SparkSession, uri: str) -> None:
    """Delete the file at an encoded address, if it is still there."""
    files, place = _file_system(spark, file_uri(spark, uri, decoded=True))
    files.delete(place, False)


def move_file(spark: SparkSession, path: str, folder_uri: str) -> None:
    """Move a file into the folder at an encoded address, in the same store."""
    files, place = _file_system(spark, path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder_uri))
    files.mkdirs(folder)
    if not files.rename(place, spark._jvm.org.apache.hadoop.fs.Path(folder, place.getName())):
        raise OSError(f"{path}: could not be moved to {folder_uri}")
