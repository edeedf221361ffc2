"""Readers of landed files and databases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8", header: bool = True, columns: list[str] | None = None, multiline: bool = False) -> DataFrame:
    """Landed CSV, all columns as text. ``columns`` names them where there is no header. UTF-16 files are read whole by a
    task each, as are files with quoted line feeds (``multiline``)."""
    reader = spark.read.option("sep", sep).option("encoding", encoding).option("header", header).option("quote", '"').option("escape", '"')
    reader = reader.option("multiLine", multiline or encoding.upper().startswith("UTF-16"))
    df = reader.csv(path)
    return df.toDF(*columns) if columns else df


def read_sources(spark: SparkSession, sources: list[dict], columns: list[str]) -> DataFrame:
    """Union of files that differ in format: each source is the arguments of ``read_csv``. A source with a header is
    taken by name, one without by place."""
    frames = []
    for s in sources:
        df = read_csv(spark, **s, columns=None if s.get("header", True) else columns)
        frames.append(df.select([F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]))
    return reduce(DataFrame.unionByName, frames)


def read_database(spark: SparkSession, url: str, query: str, partition_column: str | None = None, bounds: tuple[str, str] | None = None, partitions: int = 16, **options: str) -> DataFrame:
    """A query over JDBC; with a partition column and bounds in that many parallel parts."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if partition_column:
        low, high = bounds
        reader = reader.option("dbtable", f"({query}) q").option("partitionColumn", partition_column).option("lowerBound", low).option("upperBound", high).option("numPartitions", partitions)
    else:
        reader = reader.option("query", query)
    return reader.load()


def modified_since(df: DataFrame, moment: str) -> DataFrame:
    """Rows of files changed at or after the moment."""
    return df.where(F.col("_metadata.file_modification_time") >= F.lit(moment).cast("timestamp"))


def typed(df: DataFrame, types: dict[str, str], load_date: str | None = None) -> DataFrame:
    """Staged text columns as the definition's types: text is trimmed, blanks and bad values become null, DATETIME is
    read as ``Jan  2 2024  3:04PM``. ``load_date`` adds today's date under that name."""
    from ..functions.dates import staged_timestamp

    names = {"INTEGER": "bigint", "INT64": "bigint", "FLOAT": "double", "FLOAT64": "double", "NUMERIC": "decimal(38,9)", "DATE": "date", "TIMESTAMP": "timestamp"}
    out = []
    for name, kind in types.items():
        text = F.trim(F.col(f"`{name}`"))
        blank = F.nullif(text, F.lit(""))
        out.append((text if kind == "STRING" else staged_timestamp(blank) if kind == "DATETIME" else blank.try_cast(names[kind])).alias(name))
    return df.select(*out, *([F.current_date().alias(load_date)] if load_date else []))
