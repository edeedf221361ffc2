"""Hand-kept sheets, landed as rows of text with their row number."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def clean_sheet(df: DataFrame, columns: list[str], row_no: str = "row_no", skip_rows: int = 0, insert: dict[str, float] | None = None, drop_null_on: str | None = None, strip: tuple[str, ...] = ("|", "\n"), nan_as_zero: tuple[str, ...] = ()) -> DataFrame:
    """The rows after the first ``skip_rows``, their cells named by place.

    ``columns`` are the names after ``insert`` has put constant columns at their places (for layouts that lack them).
    Characters in ``strip`` go from all cells; rows without ``drop_null_on`` go; ``nan`` and nulls of the named columns
    become 0.
    """
    insert = insert or {}
    cells = [c for c in df.columns if c != row_no][: len(columns) - len(insert)]
    rows, left, out = df.where(F.col(row_no) > skip_rows), iter(cells), []
    for name in columns:
        if name in insert:
            out.append(F.lit(insert[name]).cast("string").alias(name))
            continue
        cell = F.col(f"`{next(left)}`").cast("string")
        for s in strip:
            cell = F.replace(cell, F.lit(s), F.lit(""))
        if name in nan_as_zero:
            cell = F.when(cell.isNull() | (F.lower(cell) == "nan"), F.lit("0")).otherwise(cell)
        out.append(cell.alias(name))
    result = rows.select(F.col(row_no), *out)
    return result.where(F.col(drop_null_on).isNotNull()) if drop_null_on else result


def with_header_row(df: DataFrame, header: int, row_no: str = "row_no") -> DataFrame:
    """The rows below the one numbered ``header``, columns named by its cells (empty ones keep their names)."""
    names = df.where(F.col(row_no) == header).first()
    return df.where(F.col(row_no) > header).select(row_no, *[F.col(f"`{c}`").alias(names[c] or c) for c in df.columns if c != row_no])


def campaign_calendar(df: DataFrame, marker: str, marker_column: str, last_cycle: int, period: int, year: int, row_no: str = "row_no") -> DataFrame:
    """The rows under the header that follows the marker row, with period, year and a running internal cycle."""
    at = df.where(F.col(marker_column) == marker).agg(F.min(row_no)).first()[0]
    if at is None:
        raise ValueError(f"no row has {marker}")
    rows = with_header_row(df, at + 1, row_no)
    order = F.row_number().over(Window.orderBy(row_no))  # a calendar has some dozens of rows
    return rows.select("*", F.lit(period).alias("period"), F.lit(year).alias("year"), (F.lit(last_cycle) + order).alias("internal_cycle"))


def offers_by_ean(offers: DataFrame, eans: DataFrame, cycles: DataFrame) -> DataFrame:
    """Offers with their codes and cycle and a promotion name of single blanks; rows with a null are left out."""
    joined = offers.join(eans, "offer_id", "left").join(cycles, "period", "left")
    name = F.trim(F.regexp_replace(F.concat_ws(" ", "mechanic", "description"), r"\s+", " "))
    return joined.withColumn("promotion_name", name).dropna(how="any")
