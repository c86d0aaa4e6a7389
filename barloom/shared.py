"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_ready: set[str] = set()


def hadoop_path(spark: SparkSession, path: str):
    """File system and path object of a path, as Spark itself opens it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below the one named by ``spark.checkpoint.dir``.

    A session on one machine may leave the setting out and uses its warehouse; on a cluster there
    is no folder to guess that all machines share, so that is an error. The folder and all that
    is left in it go when the application ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines reach")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/barloom_work"
    folder = f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"
    if folder not in _ready:
        files, place = hadoop_path(spark, folder)
        files.mkdirs(place)
        files.deleteOnExit(place)
        _ready.add(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def land(df: DataFrame, path: str) -> DataFrame:
    """Write once, continue from the written copy: no recomputation, no lineage."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a written copy that nothing reads any more."""
    files, place = hadoop_path(spark, path)
    files.delete(place, True)
