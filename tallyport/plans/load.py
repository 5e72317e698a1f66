"""One delivery from its files to the tables, or one change file to the history."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyport.contract import Contract, ContractError
from tallyport.functions import periods
from tallyport.functions.periods import change_window
from tallyport.operators import checks, loading
from tallyport.operators.cleaning import CleaningRules, clean
from tallyport.operators.history import ACTION, POSITION
from tallyport.operators.ledger import note_verdicts, removed_counts, require_accepted
from tallyport.operators.published import DeliveryTables, new_load, replace_part
from tallyport.operators.stored import StoredHistory
from tallyport.session import settle
from tallyport.sources import delimited, staging
from tallyport.sources.files import change_files


@dataclass
class Loaded:
    data: DataFrame
    quality: DataFrame
    ledger: DataFrame
    new: bool


def stored_tables(spark: SparkSession, root: str, contract: Contract) -> dict[str, DataFrame]:
    """The visible rows of `ledger`, `data` and `quality` below a folder."""
    return DeliveryTables(spark, root, contract).tables()


def remove_delivery(spark: SparkSession, root: str, contract: Contract, period: str) -> DataFrame:
    """Takes a loaded delivery out of its tables; rows (table, removed).

    One row of the ledger's log takes all of it out at once, then its rows are emptied.
    """
    held = DeliveryTables(spark, root, contract)
    counts = removed_counts(held.tables(), period).collect()
    if period in held.visible:
        row = held.ledger().where(F.col("period") == period)
        held.publish(row, new_load(), period, None, removed=True)
    return spark.createDataFrame(counts, "table string, removed long")


def load_delivery(
    spark: SparkSession,
    path: str,
    contract: Contract,
    rules: CleaningRules,
    period: str,
    delivered_on: str,
    root: str,
    header: bool = True,
    max_errors: int | None = None,
    force: bool = False,
    data_check: bool = True,
    header_file: str | None = None,
    sep: str = ";",
    encoding: str = "utf8",
    multiline: bool = False,
    max_rows: int = 0,
) -> Loaded:
    """Load a delivery into `data`, `quality` and `ledger` below `root`.

    The cleaned delivery is staged once; checks and load read the staged rows. A delivery
    that the ledger names is complete and skipped, unless forced. Its rows become visible with its ledger row, which
    is written last, so a load that is refused or cut short leaves what the period held before, and a forced one
    keeps the sequence number. Cells that pass the checks but do not load are reported too.
    """
    if not periods.is_well_formed(period):
        raise ContractError(f"not a period: {period}")
    held = DeliveryTables(spark, root, contract)
    if period in held.visible and not force:
        return Loaded(**held.tables(), new=False)
    load, first = new_load(), held.next_record(period)

    raw = delimited.read_delivery(
        spark, path, contract, header=header, header_file=header_file, sep=sep, encoding=encoding,
        max_rows=max_rows, traced=True, multiline=multiline, ragged=True,
    )
    staged = staging.stage(clean(raw, contract, rules))
    numbered = staging.number_rows(staged, "row", start=0)

    typed = loading.load_typed(numbered, contract)
    stamped = loading.stamp_delivery(
        typed.withColumn("record_no", F.col("row") + F.lit(first)), contract.source_code, period
    )
    records, last = held.write_data(load, period, loading.table_order(stamped, contract))

    if data_check:
        report = checks.failures(numbered, contract, checks.LOAD_CHECKS)
        report = report.unionByName(checks.ragged_rows(numbered, delimited.RAGGED))
        if max_errors is not None:
            report, _, _ = checks.within_budget(settle(report), max_errors)
    else:
        report, _, _ = checks.check_all(numbered, contract, data_check=False)
    held.write(load, period, "quality", loading.quality_rows(report, contract.source_code, period))
    return published(held, load, period, records, last, delivered_on, path)


def published(
    held: DeliveryTables, load: str, period: str, records: int, last: int | None, delivered_on: str, source: str
) -> Loaded:
    """A written load, made visible by its ledger row."""
    counted = held.spark.createDataFrame([(records,)], "records long")
    sequence = F.lit(held.next_sequence(period))
    row = loading.ledger_row(counted, period, held.contract.source_code, delivered_on, source, sequence=sequence)
    held.publish(row, load, period, last)
    return Loaded(**DeliveryTables(held.spark, held.root, held.contract).tables(), new=True)


def load_seed(spark: SparkSession, path: str, contract: Contract, period: str, root: str, name: str) -> Loaded:
    """A first delivery copied from a stored table, which is not checked; otherwise as `load_delivery`."""
    held = DeliveryTables(spark, root, contract)
    if period in held.visible:
        return Loaded(**held.tables(), new=False)
    load = new_load()
    rows = staging.number_rows(staging.traced_parquet(spark, path), start=held.next_record(period))
    kinds = {f.name: f.dataType for f in contract.typed_schema()}
    typed = rows.select("record_no", *[F.col(c).try_cast(kinds[c]).alias(c) for c in contract.names])
    stamped = loading.stamp_delivery(typed, contract.source_code, period)
    records, last = held.write_data(load, period, loading.table_order(stamped, contract))
    report = checks.seeded_report(spark, name)
    held.write(load, period, "quality", loading.quality_rows(report, contract.source_code, period))
    return published(held, load, period, records, last, "", name)


@dataclass(frozen=True)
class Delivery:
    """What a delivery note says: a file, or a table for a first delivery, and how to read it."""

    path: str
    period: str
    source_code: str
    delivered_on: str = ""
    first: bool = False
    table: bool = False
    options: dict = field(default_factory=dict)


def run_deliveries(
    spark: SparkSession, deliveries: list[Delivery], contract: Contract, rules: CleaningRules, root: str
) -> DataFrame:
    """Loads deliveries one after the other; a row (place, period, verdict, reason, records, errors, repeated_keys) for each.

    A note is judged first: its period, its letter against the declared frequency, its source code.
    What fails there or at the load is `refused` with the reason, a missing file or table too; the deliveries after it are
    loaded all the same, and what its period held before stays. What the ledger names is `skipped`. Key values of
    a delivery that occur more than once in the table, within it or in other periods, are counted.
    """
    declared = spark.createDataFrame(
        [("", contract.frequency, contract.source_code)], "supplier string, frequency string, source_code string"
    )
    schema = "supplier string, period string, source_code string, first boolean"
    out = []
    for place, note in enumerate(deliveries):
        records, errors, repeated = 0, 0, 0
        try:
            said = spark.createDataFrame([("", note.period, note.source_code, note.first)], schema)
            require_accepted(note_verdicts(said, declared))
            if note.table:
                loaded = load_seed(spark, note.path, contract, note.period, root, **note.options)
            else:
                loaded = load_delivery(
                    spark, note.path, contract, rules, note.period, note.delivered_on, root, **note.options
                )
        except (ContractError, AnalysisException) as error:
            reason = str(error) if isinstance(error, ContractError) else error.getCondition()
            out.append((place, note.period, "refused", reason, records, errors, repeated))
            continue
        verdict = "loaded" if loaded.new else "skipped"
        held = DeliveryTables(spark, root, contract)
        records = held.visible[note.period].records
        errors = held.rows("quality", note.period).where("quality_code >= 0").count()
        if contract.keys:
            repeated = held.repeated_keys(note.period).count()
        out.append((place, note.period, verdict, None, records, errors, repeated))
    return spark.createDataFrame(
        out, "place int, period string, verdict string, reason string, records long, errors long, repeated_keys long"
    )


@dataclass(frozen=True)
class Supply:
    """What a supplier delivers for a project: its contract and rules, where its tables are, and its deliveries."""

    supplier: str
    project: str
    contract: Contract
    rules: CleaningRules
    root: str
    deliveries: list[Delivery]


def run_supplies(spark: SparkSession, supplies: list[Supply]) -> DataFrame:
    """The deliveries of all suppliers and projects; the rows of `run_deliveries` with supplier and project."""
    out = None
    for one in supplies:
        rows = run_deliveries(spark, one.deliveries, one.contract, one.rules, one.root)
        rows = rows.select(F.lit(one.supplier).alias("supplier"), F.lit(one.project).alias("project"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


def load_changes(
    spark: SparkSession,
    path: str,
    name: str,
    contract: Contract,
    rules: CleaningRules,
    period: str,
    store: StoredHistory,
    quality: str,
    instruction: str = ACTION,
    sep: str = ";",
    header: bool = True,
    max_errors: int | None = None,
) -> DataFrame:
    """Apply a delivered change file to a stored history; returns the refused changes.

    `name` holds the two dates of the change window and is the file's identity: a name that the
    history knows, from a stream too, is refused. The data columns are cleaned and checked like
    any delivery; existence is judged on the history before the file. Its quality rows replace
    those of the same period and name only.
    """
    if store.has(name):
        raise ContractError(f"change file was applied before: {name}")
    raw = delimited.read_delivery(
        spark, path, contract, header=header, sep=sep, instructions=(instruction,), traced=True, ragged=True
    )
    staged = staging.stage(clean(raw, contract, rules))
    numbered = staging.number_rows(staged, "row", start=0)

    typed = loading.load_typed(numbered, contract).withColumnRenamed("row", POSITION)
    start, end = change_window(F.lit(name))
    first = F.lit(store.last_record() + 1)
    stamps = {
        "record_no": F.col(POSITION) + first,
        "source_code": F.lit(contract.source_code),
        "period": F.lit(period),
        "loaded_at": loading.now(),
    }
    changes = typed.withColumnRenamed(instruction, ACTION).drop(delimited.RAGGED)
    keyed = " and ".join(f"`{k}` is not null" for k in contract.keys)
    report = checks.failures(numbered, contract, checks.LOAD_CHECKS)
    report = report.unionByName(checks.ragged_rows(numbered, delimited.RAGGED))
    if max_errors is not None:
        report, _, _ = checks.within_budget(settle(report), max_errors)
    replace_part(loading.quality_rows(report, contract.source_code, period), quality, period=period, change=name)
    refused = store.apply(name, changes.where(keyed), start, end, stamps)
    return refused.unionByName(changes.where(f"not ({keyed})").select(*changes.columns, F.lit("no key").alias("reason")))


def apply_folder(
    spark: SparkSession,
    folder: str,
    contract: Contract,
    rules: CleaningRules,
    period: str,
    store: StoredHistory,
    quality: str,
    **options,
) -> DataFrame:
    """Apply the change files of a folder in name order; rows (name, verdict, changes_refused).

    Files that the history knows are passed over, so a run that was cut short goes on where it
    stopped. A file without a change window in its name is refused under its path, and so is one that the contract
    refuses; the others are applied. There is one small row for each file.
    """
    done = []
    for row in change_files(spark, folder).collect():
        if row.name is None:
            done.append((row.path, "no change window in the name", 0))
        elif not store.has(row.name):
            try:
                refused = load_changes(spark, row.path, row.name, contract, rules, period, store, quality, **options)
            except ContractError as error:
                done.append((row.name, str(error), 0))
            else:
                done.append((row.name, "applied", refused.count()))
    return spark.createDataFrame(done, "name string, verdict string, changes_refused long")
