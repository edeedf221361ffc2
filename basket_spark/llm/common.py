"""Helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import stored, work_dir

__all__ = ["few", "narrow", "stored", "table", "utf8", "work_dir"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of the folder ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under internal names, so that extra columns of the input cannot clash.

    ``narrow(docs, id="doc_id", text="text")`` gives the columns ``id`` and ``text``.
    """
    return df.select([F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def few(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of ``rows`` at most, so that what a worker makes of a batch stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The strings of an Arrow column as UTF-8 bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()
