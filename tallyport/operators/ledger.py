"""Deliveries: what is declared, offered, stored, loaded, and taken out again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyport.contract import ContractError
from tallyport.functions import periods

# Fixed value: a declared delivery that is not found.
NOT_FOUND = -1
# Fixed value: deliveries are declared under names with this prefix.
PREFIX = "delivery_"


def existing_deliveries(wanted: DataFrame, ledger: DataFrame) -> DataFrame:
    """Wanted periods that are in the ledger already (case sensitive)."""
    return wanted.join(ledger.select("period").distinct(), "period", "left_semi")


def deliveries_to_load(wanted: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """Wanted periods not yet loaded; all of them when forced."""
    if force:
        return wanted
    return wanted.join(ledger.select("period").distinct(), "period", "left_anti")


def period_of_name(name: str) -> str:
    if not name.startswith(PREFIX):
        raise ContractError(f"a delivery is declared as {PREFIX}<period>: {name}")
    return name[len(PREFIX):]


def reconcile(declared: DataFrame, found: DataFrame) -> DataFrame:
    """Declared next to found deliveries: `(supplier, project, period)` and row counts."""
    key = ["supplier", "project", "period"]
    marked = declared.select(*key).withColumn("declared", F.lit(True))
    return marked.join(found.select(*key, "records"), key, "full_outer").select(
        *key,
        F.coalesce("declared", F.lit(False)).alias("declared"),
        F.coalesce("records", F.lit(NOT_FOUND)).cast("long").alias("records"),
    )


def pending(offered: DataFrame, cached: DataFrame, delivered: DataFrame, key: list[str]) -> DataFrame:
    """Offered deliveries that are neither stored nor loaded."""
    return offered.join(cached.select(*key), key, "left_anti").join(
        delivered.select(*key), key, "left_anti"
    )


def with_previous(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """The file of each wanted period, else the one of the period before.

    `wanted` has project and period, `files` project, period and name, at most one each.
    """
    named = files.select("project", "period", F.col("name").alias("own"))
    before = files.select(
        "project", F.col("period").alias("_before"), F.col("name").alias("previous")
    )
    return (
        wanted.withColumn("_before", periods.add(F.col("period"), -1))
        .join(named, ["project", "period"], "left")
        .join(before, ["project", "_before"], "left")
        .select(
            "project",
            "period",
            F.coalesce("own", "previous").alias("name"),
            F.when(F.col("own").isNotNull(), F.col("period"))
            .when(F.col("previous").isNotNull(), F.col("_before"))
            .alias("true_period"),
        )
    )


def note_verdicts(ledger: DataFrame, metadata: DataFrame) -> DataFrame:
    """Delivery notes judged by the metadata of their supplier.

    The letter of the period must be the declared frequency, except for an initial
    delivery; the source code must be the declared one.
    """
    declared = metadata.select(
        "supplier", F.col("frequency").alias("_frequency"), F.col("source_code").alias("_code")
    )
    letter = periods.letter_of(F.col("period"))
    initial = F.col("first") & (letter == "I")
    return ledger.join(declared, "supplier", "left").select(
        *ledger.columns,
        periods.well_formed(F.col("period")).alias("period_ok"),
        F.coalesce((letter == F.col("_frequency")) | initial, F.lit(False)).alias("letter_ok"),
        F.col("source_code").eqNullSafe(F.col("_code")).alias("code_ok"),
    )


def require_accepted(verdicts: DataFrame) -> None:
    """Stop when a note of the delivery at hand is not acceptable."""
    bad = verdicts.where(~(F.col("period_ok") & F.col("letter_ok") & F.col("code_ok")))
    first = bad.select("supplier", "period", "source_code").first()
    if first is not None:
        raise ContractError(f"delivery is not processed: {first.asDict()}")


def next_sequence(ledger: DataFrame) -> DataFrame:
    """The next sequence number and the number of deliveries so far."""
    return ledger.agg(
        F.coalesce(F.max("sequence") + 1, F.lit(1)).cast("long").alias("next_sequence"),
        F.count("*").alias("deliveries"),
    )


def without_delivery(table: DataFrame, period: str) -> DataFrame:
    """The rows that stay when a delivery is removed; a partition prune if stored by period."""
    return table.where(~F.col("period").eqNullSafe(F.lit(period)))


def removed_counts(tables: dict[str, DataFrame], period: str) -> DataFrame:
    """Rows per table that belong to a delivery."""
    counts = None
    for name, table in tables.items():
        one = (
            table.where(F.col("period") == period)
            .agg(F.count("*").alias("removed"))
            .select(F.lit(name).alias("table"), "removed")
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


def drop_delivery(spark: SparkSession, tables: list[str], period: str) -> DataFrame:
    """Take a delivery out of catalogue tables partitioned by period.

    Counts first, then drops the partition: no other delivery is read or written.
    """
    counts = removed_counts({t: spark.table(t) for t in tables}, period).collect()
    quoted = period.replace("'", "\\'")
    for table in tables:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (period = '{quoted}')")
    return spark.createDataFrame(counts, "table string, removed long")


def list_deliveries(tables: dict[tuple[str, str, str], DataFrame | None]) -> DataFrame:
    """Records and deliveries of each `(supplier, project, table)`; None if it is absent."""
    parts = None
    for (supplier, project, name), table in tables.items():
        row = (
            F.lit(supplier).alias("supplier"),
            F.lit(project).alias("project"),
            F.lit(name).alias("table"),
        )
        if table is None:
            continue
        has_period = "period" in table.columns
        deliveries = F.count_distinct("period") if has_period else F.lit(0).cast("long")
        one = table.agg(
            F.count("*").alias("records"), deliveries.alias("deliveries")
        ).select(*row, F.lit(True).alias("present"), "records", "deliveries")
        parts = one if parts is None else parts.unionByName(one)
    absent = [(*k, False, 0, 0) for k, t in tables.items() if t is None]
    if absent:
        spark = SparkSession.active()
        schema = (
            "supplier string, project string, table string, present boolean, "
            "records long, deliveries long"
        )
        missing = spark.createDataFrame(absent, schema)
        parts = missing if parts is None else parts.unionByName(missing)
    return parts


def run_templates(
    spark: SparkSession,
    statements: dict[str, str],
    affected: list[str],
    known: list[str],
    schema: str = "default",
) -> dict[tuple[str, str], DataFrame]:
    """Run SQL templates with `{schema}` and `{table}` for a list of known tables."""
    tables = known if affected == ["*"] else affected
    unknown = [t for t in tables if t not in known]
    if unknown:
        raise ContractError(f"unknown tables: {unknown}")
    return {
        (table, name): spark.sql(text.format(schema=schema, table=table))
        for table in tables
        for name, text in statements.items()
    }
