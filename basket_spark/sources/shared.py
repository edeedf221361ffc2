"""The folder that driver and executors share, for results that later steps start from."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession

_written: dict[str, list[str]] = {}


def work_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` or the context's checkpoint folder. Where neither is set a local session gets a temporary
    folder; on a cluster that is an error, since executors don't share one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="basket-spark-"))
        path = spark.sparkContext.getCheckpointDir()
    return path.rstrip("/")


def stored_at(df: DataFrame, label: str, by: list[str] | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet to the shared folder and read it back, which cuts its lineage and survives lost executors;
    and the folder it is in. ``by``: columns that make folders of their own, so that a read for one value reads no other."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """The frame of ``stored_at``."""
    return stored_at(df, label, by)[0]


def spread(df: DataFrame, *by: str | Column) -> DataFrame:
    """``df`` dealt out by the columns to as many tasks as ``spark.sql.shuffle.partitions`` says. Spark merges partitions of
    other shuffles to 64 MB of compressed rows, which take ten times that where they are sorted or hashed."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


def clear(spark: SparkSession) -> int:
    """Delete all that the session has stored; how many folders. Frames made from them can't be read afterwards."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    remove(spark, *paths)
    return len(paths)
