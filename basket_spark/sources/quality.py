"""Gates that a load must pass; each raises with what is wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .shared import remove, stored_at
from .tables import TableSpec, write_table


def assert_columns(df: DataFrame, required: list[str]) -> None:
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"columns missing: {missing}")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of the keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    if found := duplicate_keys(df, keys).limit(5).collect():
        raise ValueError(f"keys occur more than once, among them {[tuple(r)[:-1] for r in found]}")


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row with the number of nulls in each column, in one pass."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns or df.columns])


def assert_no_nulls(df: DataFrame, columns: list[str] | None = None) -> None:
    if bad := {k: v for k, v in null_counts(df, columns).first().asDict().items() if v}:
        raise ValueError(f"nulls: {bad}")


def assert_loaded(before: int, added: int, after: int) -> None:
    if before + added != after:
        raise ValueError(f"{before} rows and {added} new ones make {before + added}, not {after}")


def gated_load(df: DataFrame, spec: TableSpec, keys: list[str], required: list[str], least_rows: int = 1, if_exists: str = "replace") -> int:
    """Load ``df`` into the table if it passes the gates, else raise and leave the table as it is; how many rows.

    Columns of the table must be there, the ``keys`` unique (null keys are equal), the ``required`` columns and the keys
    without nulls, and rows ``least_rows`` at least. One pass over the source stages the rows in the shared folder and
    observes all of it on the way: rows are grouped by key, which leaves unique ones as they are. The table is written
    from the staged rows, whose number is checked against what was observed.
    """
    assert_columns(df, spec.schema.names)
    shaped, before, after = spec.shaped(df), Observation("rows"), Observation("keys")
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in dict.fromkeys([*keys, *required])]
    seen = shaped.observe(before, F.count(F.lit(1)).alias("__rows"), *nulls)
    grouped = seen.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("__n"), F.min(F.struct(*[F.col(f"`{c}`") for c in spec.schema.names])).alias("__row"))
    grouped = grouped.observe(after, F.count(F.lit(1)).alias("__keys"), F.count_if(F.col("__n") > 1).alias("__repeated")).select("__row.*")
    staged, path = stored_at(grouped, "staged")
    try:
        rows, bad = before.get["__rows"], {k: v for k, v in before.get.items() if k != "__rows" and v}
        if bad:
            raise ValueError(f"nulls: {bad}")
        if after.get["__repeated"]:
            raise ValueError(f"{after.get['__repeated']} keys occur more than once")
        if rows < least_rows:
            raise ValueError(f"{rows} rows, not {least_rows}")
        assert_loaded(0, rows, after.get["__keys"])
        write_table(staged, spec, if_exists)
    finally:
        remove(df.sparkSession, path)
    return rows
