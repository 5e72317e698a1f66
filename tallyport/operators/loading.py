"""Typed load, defaults, delivery stamp, quality and ledger rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyport.contract import GENERATED_NAMES, Contract
from tallyport.functions import datatypes
from tallyport.functions.periods import BEGIN_OF_TIME, END_OF_TIME
from tallyport.functions.text import null_or_empty

KEEP = ("record_no", "source_code", "period")


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Text columns of the contract in its order; absent ones get their default or null."""
    columns = []
    for column in contract.columns:
        if column.name in df.columns:
            columns.append(F.col(column.name))
        else:
            columns.append(F.lit(column.default).cast("string").alias(column.name))
    return df.select(*[c for c in df.columns if c not in contract.names], *columns)


def load_typed(df: DataFrame, contract: Contract) -> DataFrame:
    """Cells cast to the contract's types; other columns pass unchanged."""
    typed = [
        datatypes.load_cell(F.col(c.name), c.datatype, c.precision, c.scale).alias(c.name)
        for c in contract.columns
    ]
    return conform(df, contract).select(
        *[c for c in df.columns if c not in contract.names], *typed
    )


def now() -> Column:
    return F.date_trunc("second", F.current_timestamp())


def stamp_delivery(
    df: DataFrame,
    source_code: str | Column,
    period: str | Column,
    valid_from: str = BEGIN_OF_TIME,
    valid_to: str = END_OF_TIME,
) -> DataFrame:
    """Set delivery metadata and validity on the rows that have no period yet."""
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    stamps = {
        "source_code": as_column(source_code),
        "period": as_column(period),
        "valid_from": F.to_date(F.lit(valid_from)),
        "valid_to": F.to_date(F.lit(valid_to)),
        "loaded_at": now(),
    }
    if "period" not in df.columns:
        return df.withColumns(stamps)
    fresh = null_or_empty(F.col("period"))
    return df.withColumns(
        {
            name: F.when(fresh, value).otherwise(F.col(name)) if name in df.columns else value
            for name, value in stamps.items()
        }
    )


def table_order(df: DataFrame, contract: Contract) -> DataFrame:
    return df.select(*GENERATED_NAMES, *contract.names)


def quality_rows(report: DataFrame, source_code: str | Column, period: str | Column) -> DataFrame:
    """The error report in the shape of the quality table."""
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    return report.select(
        F.col("row").alias("record_no"),
        as_column(source_code).alias("source_code"),
        F.col("row").alias("row_number"),
        "column_name",
        F.col("column").cast("string").alias("attribute_code"),
        F.col("error_code").alias("quality_code"),
        as_column(period).alias("period"),
        now().alias("loaded_at"),
    )


def ledger_row(
    counted: DataFrame,
    period: str | Column,
    source_code: str | Column,
    delivered_on: str | Column,
    data_file: str | Column,
    config_text: str = "",
    sequence: Column | None = None,
    created_by: str = "current_user",
    accepted: bool = True,
) -> DataFrame:
    """One ledger row per row of `counted`, which holds `records`.

    The declared delivery date is kept (empty becomes null); processing date and load
    time are now.
    """
    as_column = lambda v: F.lit(v) if isinstance(v, str) else v
    reason = "Not applicable" if accepted else "Errors in data quality"
    given = as_column(delivered_on).cast("string")
    return counted.select(
        (sequence if sequence is not None else F.lit(1)).cast("int").alias("sequence"),
        as_column(period).alias("period"),
        as_column(source_code).alias("source_code"),
        F.lit(created_by).alias("created_by"),
        F.when(~null_or_empty(given), F.try_to_date(given)).alias("delivered_on"),
        F.lit(accepted).alias("accepted"),
        F.lit(reason).alias("reason"),
        F.current_date().alias("processed_on"),
        F.col("records").cast("long").alias("records"),
        F.lit(config_text).alias("config_text"),
        as_column(data_file).alias("data_file"),
        now().alias("loaded_at"),
    )
