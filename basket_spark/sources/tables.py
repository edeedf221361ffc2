"""Tables: definitions, creation, and idempotent writes, over the session's catalog and Parquet."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import stored

#: Fixed names of column types in table definitions.
TYPES = {
    "STRING": T.StringType(), "FLOAT": T.DoubleType(), "FLOAT64": T.DoubleType(), "INTEGER": T.LongType(), "INT64": T.LongType(), "DATE": T.DateType(), "DATETIME": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampType(), "BYTES": T.BinaryType(), "BOOLEAN": T.BooleanType(), "NUMERIC": T.DecimalType(38, 9), "BIGNUMERIC": T.DecimalType(38, 9),
}


@dataclass
class TableSpec:
    """A table's columns, required columns, partition column and sort columns."""

    name: str
    schema: T.StructType
    partition_by: list[str] = field(default_factory=list)
    sort_by: list[str] = field(default_factory=list)

    @classmethod
    def from_json(cls, source: str | Path | dict) -> TableSpec:
        """From a definition with ``schema``, ``table``, ``columns``, and time or range partitioning, not both."""
        spec = source if isinstance(source, dict) else json.loads(Path(source).read_text())
        time, ranges = spec.get("time_partitioning"), spec.get("range_partitioning")
        if time and ranges:
            raise ValueError("a table has time or range partitioning, not both")
        fields = [T.StructField(c["name"], TYPES[c["field_type"]], c.get("mode", "NULLABLE") != "REQUIRED") for c in spec["columns"]]
        by = (time or ranges or {}).get("field")
        return cls(f"{spec['schema']}.{spec['table']}", T.StructType(fields), [by] if by else [], list(spec.get("clustering_fields") or []))

    def shaped(self, df: DataFrame, positional: bool = False) -> DataFrame:
        """``df`` with the table's columns, by name or (for landed sheets) by place, cast to their types."""
        names = df.columns if positional else self.schema.names
        if positional and len(names) != len(self.schema):
            raise ValueError(f"{len(names)} columns for the {len(self.schema)} of {self.name}")
        return df.select([F.col(f"`{n}`").cast(f.dataType).alias(f.name) for n, f in zip(names, self.schema, strict=True)])

    def create(self, spark: SparkSession, if_exists: str = "raise") -> None:
        """Make the empty table; if there is one: ``raise``, ``ignore`` or ``rebuild``."""
        if if_exists not in ("raise", "ignore", "rebuild"):
            raise ValueError("if_exists must be raise, ignore or rebuild")
        if spark.catalog.tableExists(self.name):
            if if_exists == "ignore":
                return
            if if_exists == "raise":
                raise ValueError(f"{self.name} exists")
            spark.sql(f"DROP TABLE {self.name}")
        _save(spark.createDataFrame([], self.schema), self, "errorifexists")


def _save(df: DataFrame, spec: TableSpec, mode: str) -> None:
    if spec.sort_by:
        df = df.sortWithinPartitions(*spec.partition_by, *spec.sort_by)
    writer = df.write.format("parquet").mode(mode)
    (writer.partitionBy(*spec.partition_by) if spec.partition_by else writer).saveAsTable(spec.name)


def require_table(spark: SparkSession, name: str) -> None:
    if not spark.catalog.tableExists(name):
        raise ValueError(f"there is no table {name}")


def write_table(df: DataFrame, spec: TableSpec, if_exists: str = "fail", positional: bool = False) -> None:
    """Write to the table, made if it is missing; if there is one: ``fail``, ``replace`` or ``append``.

    Columns go by name and are cast; nulls in required columns raise.
    """
    spark, shaped = df.sparkSession, spec.shaped(df, positional)
    required = [f.name for f in spec.schema if not f.nullable]
    if if_exists not in ("fail", "replace", "append"):
        raise ValueError("if_exists must be fail, replace or append")
    if spark.catalog.tableExists(spec.name) and if_exists == "fail":
        raise ValueError(f"{spec.name} exists")
    for c in required:  # checked while rows are written: no pass of its own
        shaped = shaped.withColumn(c, F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} of {spec.name} is required"))).otherwise(F.col(c)))
    _save(shaped.select(spec.schema.names), spec, "overwrite" if if_exists == "replace" else "append")


def create_as(df: DataFrame, name: str, disposition: str = "EMPTY", partition_by: list[str] | None = None, sort_by: list[str] | None = None) -> None:
    """The table as the result of a query: TRUNCATE replaces, APPEND adds, EMPTY raises if the table exists."""
    modes = {"TRUNCATE": "overwrite", "APPEND": "append", "EMPTY": "errorifexists"}
    _save(df, TableSpec(name, df.schema, partition_by or [], sort_by or []), modes[disposition])


def without_slice(old: DataFrame, where: str | Column) -> DataFrame:
    """The rows that DELETE with this condition leaves: those for which it is false or null."""
    condition = F.expr(where) if isinstance(where, str) else where
    return old.where(~F.coalesce(condition, F.lit(False)))


def _partitions(df: DataFrame, spec: TableSpec) -> set[tuple]:
    """The values of the partition columns that ``df`` has, as strings: no more than the table has partitions."""
    return {tuple(r) for r in df.select([F.col(f"`{c}`").cast("string") for c in spec.partition_by]).distinct().collect()}


def overwrite_slice(new: DataFrame, spec: TableSpec, where: str) -> None:
    """Replace the slice of the table that meets ``where`` with ``new``; running it again changes nothing.

    Of a partitioned table only the partitions are written that hold rows of the slice or of ``new``; those that are left
    without rows are dropped. Other tables are written anew beside the old one, once, and then take its name: whatever
    breaks off before leaves the old one as it is.
    """
    spark = new.sparkSession
    if not spark.catalog.tableExists(spec.name):
        write_table(new, spec, "append")
        return
    old, new = spark.table(spec.name).select(spec.schema.names), spec.shaped(new)
    if spec.partition_by:
        gone = _partitions(old.where(where), spec)
        named = spark.createDataFrame(sorted(gone | _partitions(new, spec), key=repr), ", ".join(f"`{c}` string" for c in spec.partition_by))
        same = [F.col(f"old.`{c}`").cast("string").eqNullSafe(F.col(f"named.`{c}`")) for c in spec.partition_by]
        kept = without_slice(old, where).alias("old").join(F.broadcast(named.alias("named")), reduce(Column.__and__, same), "left_semi")
        rows = stored(kept.unionByName(new), "slice")  # a partition can't be read while it is overwritten
        overwrite_partitions(rows, spec)
        for values in gone - _partitions(rows, spec):
            place = ", ".join(f"`{c}`='{v}'" for c, v in zip(spec.partition_by, values, strict=True))
            spark.sql(f"ALTER TABLE {spec.name} DROP IF EXISTS PARTITION ({place})")
        return
    mark = uuid.uuid4().hex
    beside = replace(spec, name=f"{spec.name}_new_{mark}")
    _save(without_slice(old, where).unionByName(new), beside, "errorifexists")
    spark.sql(f"ALTER TABLE {spec.name} RENAME TO {spec.name}_old_{mark}")
    spark.sql(f"ALTER TABLE {beside.name} RENAME TO {spec.name}")
    spark.sql(f"DROP TABLE {spec.name}_old_{mark}")


def overwrite_partitions(new: DataFrame, spec: TableSpec) -> None:
    """Replace the partitions that ``new`` has rows of."""
    spark, mode = new.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        spec.shaped(new).select(spark.table(spec.name).columns).write.mode("overwrite").insertInto(spec.name)
    finally:
        spark.conf.set(mode, before)


def insert_only_merge(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``source`` that a merge without updates inserts: those whose key the target hasn't. Rows with a null
    in the key always are. A key that ``source`` has twice raises when the result is computed."""
    counted = source.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    new = source.join(target.select(keys).distinct(), keys, "left_anti").select(source.columns)
    flagged = new.join(counted, keys, "left").withColumn("__n", F.when(F.col("__n").isNotNull(), F.raise_error(F.lit("the source has a key twice"))).otherwise(F.lit(1)))
    return flagged.where("__n = 1").select(source.columns)


def old_partitions(spark: SparkSession, name: str, column: str, before: str) -> list[str]:
    """The values of a partition column that are older than ``before``, from the catalog."""
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    values = [dict(x.split("=", 1) for x in p.split("/"))[column] for p in parts]
    return sorted({v for v in values if v < before})


def drop_old_partitions(spark: SparkSession, name: str, column: str, before: str) -> int:
    """Drop the partitions older than ``before``; how many there were."""
    found = old_partitions(spark, name, column, before)
    for v in found:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({column}='{v}')")
    return len(found)
