"""Written intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir.

    Only where the setting is absent (tests in local mode) a temporary folder
    is made and set, because then all tasks run on this machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="tidegraph-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/tidegraph-{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialise(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write df as Parquet in the shared folder, with the writer's options, and read it back.

    Cuts the lineage, survives lost executors, and lets several readers share
    one computation. forget() removes the files.
    """
    path = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Deletes files and folders, whatever kind of store they are in."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What build() gives, written as by materialise(); all that was written on the way is deleted, since nothing reads it any more."""
    path, mark = new_folder(spark, name), len(_written)
    df = build()
    df.write.parquet(path)
    on_the_way = _written[mark:]
    del _written[mark:]
    delete(spark, on_the_way)
    return spark.read.schema(df.schema).parquet(path)


def forget(spark: SparkSession) -> None:
    """Delete what materialise() wrote; results read from it can't be read afterwards."""
    delete(spark, _written)
    _written.clear()


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder of the shared store, whatever kind of store it is; none if there is no folder."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(conf)
    return sorted(x.getPath().getName() for x in store.listStatus(where)) if store.exists(where) else []
