"""Dated history: snapshots, change files, streams of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyport.contract import Contract, ContractColumn
from tallyport.functions import periods
from tallyport.operators import history
from tallyport.operators.cleaning import CleaningRules
from tallyport.operators.stored import StoredHistory
from tallyport.plans import checking, inputs, scans
from tallyport.plans.inputs import CHANGES_SQL, CONTRACT, HISTORY_SQL, shown, table
from tallyport.plans.load import apply_folder, load_changes
from tallyport.plans.registry import query
from tallyport.session import scratch
from tallyport.sources import delimited
from tallyport.streaming.checks import check_landing
from tallyport.streaming.mutations import NO_WINDOW, apply_landing, quarantine

KEY = ["cust_id"]
BOTH_SQL = f"{HISTORY_SQL}, {CHANGES_SQL}"
VERDICTS_SQL = f"{BOTH_SQL}, verdicts_changes AS ({inputs.verdict_sql()})"
CHANGE_OUT = "action, cust_id, name, CAST(balance AS DOUBLE) AS balance, pos, change"
HISTORY_OUT = """cust_id, name, CAST(balance AS DOUBLE) AS balance, CAST(valid_from AS VARCHAR) AS valid_from,
  CAST(valid_to AS VARCHAR) AS valid_to"""
FIRST_WINDOW, SECOND_WINDOW = ("2024-02-01", "2024-01-31"), ("2024-03-01", "2024-02-29")


def both(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return inputs.customer_history(spark, sf_dir), inputs.customer_changes(spark, sf_dir)


@query(
    "mutation_insert_ok",
    f"WITH {VERDICTS_SQL} SELECT {CHANGE_OUT} FROM verdicts_changes WHERE lower(action) = 'insert' AND reason IS NULL",
)
def mutation_insert_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(history.accepted(*both(spark, sf_dir), KEY, [history.INSERT]))


@query(
    "mutation_close_ok",
    f"WITH {VERDICTS_SQL} SELECT {CHANGE_OUT} FROM verdicts_changes WHERE lower(action) IN ('update', 'delete') AND reason IS NULL",
)
def mutation_close_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(history.accepted(*both(spark, sf_dir), KEY, history.CLOSING))


@query(
    "mutation_rejects",
    f"WITH {VERDICTS_SQL} SELECT {CHANGE_OUT}, reason FROM verdicts_changes WHERE reason IS NOT NULL",
)
def mutation_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(history.rejects(*both(spark, sf_dir), KEY))


@query(
    "mutation_counts",
    f"WITH {VERDICTS_SQL} SELECT lower(action) AS action, count(*) AS changes, count(reason) AS errors FROM verdicts_changes GROUP BY 1",
)
def mutation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.mutation_counts(history.verdicts(*both(spark, sf_dir), KEY))


@query(
    "check_consistency",
    f"""WITH {BOTH_SQL}, k AS (SELECT DISTINCT lower(action) AS action, cust_id FROM changes)
    SELECT action, count(*) AS keys FROM k WHERE (action = 'insert') = (cust_id IN (SELECT cust_id FROM history)) GROUP BY 1""",
)
def check_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    existing, changes = both(spark, sf_dir)
    return history.inconsistencies(changes, existing, KEY)


@query(
    "asof_snapshot",
    f"WITH {HISTORY_SQL} SELECT {HISTORY_OUT} FROM history WHERE valid_from <= DATE '2024-01-01' AND valid_to >= DATE '2024-01-01'",
)
def asof_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(history.asof(inputs.customer_history(spark, sf_dir), "2024-01-01"))


@query(
    "history_of_key",
    f"WITH {HISTORY_SQL} SELECT {HISTORY_OUT} FROM history WHERE cust_id = (SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'MACHINERY')",
)
def history_of_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'").agg(F.min("c_custkey"))
    return shown(history.history_of(inputs.customer_history(spark, sf_dir), "cust_id", first.scalar()))


@query(
    "history_functions",
    f"""WITH {HISTORY_SQL} SELECT 'at' AS part, {HISTORY_OUT} FROM history WHERE valid_from <= DATE '2024-01-01' AND valid_to >= DATE '2024-01-01'
    UNION ALL SELECT 'of', {HISTORY_OUT} FROM history WHERE cust_id = (SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'MACHINERY')""",
)
def history_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL table functions over a history: all rows of a day, and all versions of a key."""
    inputs.customer_history(spark, sf_dir).createOrReplaceTempView("tallyport_history")
    history.create_history_functions(spark, "tallyport_history", "tallyport", "cust_id")
    first = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'").agg(F.min("c_custkey").alias("k")).first().k
    day = spark.sql("SELECT 'at' AS part, * FROM show_tallyport_at(DATE'2024-01-01')")
    return shown(day.unionByName(spark.sql(f"SELECT 'of' AS part, * FROM show_history_of_tallyport({first})")))


def applied(spark: SparkSession, sf_dir: str, actions: list[str] | None = None) -> history.Applied:
    """The history after all changes as one file, or after those with some actions."""
    before, changes = both(spark, sf_dir)
    if actions is not None:
        changes = changes.where(F.lower("action").isin(actions))
    window = periods.change_window(F.lit(inputs.CHANGE_NAME))
    return history.apply_changes(before, changes.drop("change"), KEY, *window)


def applied_query(name: str, actions: list[str] | None) -> None:
    chosen = "" if actions is None else f" WHERE lower(action) IN ({', '.join(repr(a) for a in actions)})"
    changes = CHANGES_SQL.replace("changes AS", "all_changes AS")
    sql = f"""WITH {HISTORY_SQL}, {changes}, changes AS (SELECT * FROM all_changes{chosen}),
      verdicts_changes AS ({inputs.verdict_sql()}),
      after AS ({inputs.applied_sql('history', 'changes', *FIRST_WINDOW)}) SELECT {HISTORY_OUT} FROM after"""
    query(name, sql)(lambda spark, sf_dir: shown(applied(spark, sf_dir, actions).history))


applied_query("scd2_insert", [history.INSERT])
applied_query("scd2_delete", [history.DELETE])
applied_query("scd2_update", [history.UPDATE])
applied_query("scd2_apply", None)


CUSTOMER_CONTRACT = Contract.of(
    ContractColumn("cust_id", "bigint", "NOT NULL", key="PRIMARY KEY"),
    ContractColumn("name", "text", "NOT NULL"),
    ContractColumn("balance", "numeric", "", "0:450000", precision=12, scale=2),
    source_code="CRM",
)


def customer_store(spark: SparkSession, sf_dir: str) -> StoredHistory:
    """The customers' history with all generated columns, stored."""
    before = inputs.customer_history(spark, sf_dir)
    earlier = F.col("valid_to") == F.to_date(F.lit("2023-12-31"))
    rows = before.withColumns(
        {
            "record_no": F.col("cust_id") * 2 + F.when(earlier, 1).otherwise(2),
            "source_code": F.lit("CRM"),
            "period": F.lit("2023-I"),
            "loaded_at": F.lit(None).cast("timestamp"),
        }
    )
    schema = CUSTOMER_CONTRACT.typed_schema()
    store = StoredHistory(spark, scratch(spark, "history"), schema, KEY)
    store.start(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]))
    return store


WHOLE_FILE_SQL = inputs.applied_sql("history", "changes", *FIRST_WINDOW)


@query(
    "load_changes",
    f"""WITH {VERDICTS_SQL}, after AS ({WHOLE_FILE_SQL})
    SELECT {HISTORY_OUT}, (SELECT count(*) FROM verdicts_changes WHERE reason IS NOT NULL) AS refused,
      (SELECT count(*) FROM changes WHERE balance > 450000) AS failed FROM after""",
)
def load_changes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivered change file, checked and applied to a history with all generated columns."""
    store = customer_store(spark, sf_dir)
    changes = inputs.customer_changes(spark, sf_dir)
    landing = f"{scratch(spark, 'changes')}/{inputs.CHANGE_NAME}"
    ordered = changes.repartitionByRange("pos").sortWithinPartitions("pos")
    delimited.write_delimited(ordered.select("action", "cust_id", "name", "balance"), landing)
    quality = scratch(spark, "quality")
    refused = load_changes(
        spark, landing, inputs.CHANGE_NAME, CUSTOMER_CONTRACT, CleaningRules(strip=("*",)), "2024-M2", store, quality
    )
    after = shown(store.read().select(*inputs.HISTORY_COLUMNS))
    count = lambda df: df.select(F.count("*")).scalar()
    return after.withColumns({"refused": count(refused), "failed": count(spark.read.parquet(quality))})


@query("latest_valid_to", f"WITH {HISTORY_SQL} SELECT CAST(max(valid_to) AS VARCHAR) AS valid_to FROM history")
def latest_valid_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(history.latest_valid_to(inputs.customer_history(spark, sf_dir)))


# --- streams ---------------------------------------------------------------------------

FAILED_OUT = """CAST("row" AS VARCHAR) AS "row", phase, "column", column_name, error_code, message, element"""


@query("stream_checks", f"WITH {checking.FAILED_SQL} SELECT {FAILED_OUT} FROM failed")
def stream_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered files checked as they land; the query ends when all have been read."""
    landing, out = scratch(spark, "landing"), scratch(spark, "stream")
    delimited.write_delimited(inputs.raw_orders(spark, sf_dir).select(*inputs.NAMES), landing)
    check_landing(spark, landing, out, CONTRACT, inputs.RULES, row="order_id").awaitTermination()
    failed = spark.read.parquet(f"{out}/failures")
    return failed.drop("file", "batch")


STREAMED_SQL = f"""{HISTORY_SQL}, {CHANGES_SQL.replace("changes AS", "all_changes AS")},
      one AS (SELECT * FROM all_changes WHERE change = '{inputs.CHANGE_NAME}'),
      two AS (SELECT * FROM all_changes WHERE change = '{inputs.LATER_CHANGE_NAME}'),
      verdicts_one AS ({inputs.verdict_sql('history', 'one')}),
      after_one AS ({inputs.applied_sql('history', 'one', *FIRST_WINDOW)}),
      verdicts_two AS ({inputs.verdict_sql('after_one', 'two')}),
      after_two AS ({inputs.applied_sql('after_one', 'two', *SECOND_WINDOW)})"""


def streamed(spark: SparkSession, sf_dir: str, landing: str) -> StoredHistory:
    """The customers' history after all landed change files."""
    before = inputs.customer_history(spark, sf_dir)
    store = StoredHistory(spark, scratch(spark, "history"), before.schema, KEY)
    store.start(before)
    data = T.StructType([before.schema[c] for c in ("cust_id", "name", "balance")])
    apply_landing(store, landing, data, KEY, scratch(spark, "progress")).awaitTermination()
    return store


@query("stream_mutations", f"WITH {STREAMED_SQL} SELECT {HISTORY_OUT} FROM after_two")
def stream_mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two change files applied to a stored history, the second on the result of the first."""
    return shown(streamed(spark, sf_dir, scans.landed_changes(spark, sf_dir)).read())


BAD_NAME = "mutation_20240301-20240430"


@query(
    "stream_quarantine",
    f"""WITH {STREAMED_SQL} SELECT change, lower(action) AS action, reason, count(*) AS changes FROM (
      SELECT change, action, reason FROM verdicts_one WHERE reason IS NOT NULL
      UNION ALL SELECT change, action, reason FROM verdicts_two WHERE reason IS NOT NULL
      UNION ALL SELECT '{BAD_NAME}', 'insert', CASE WHEN s_acctbal < 0 THEN 'cell is not of its type' ELSE 'number of cells' END FROM supplier
      UNION ALL SELECT '{BAD_NAME}', 'delete', 'no key' FROM region
      UNION ALL SELECT 'corrections', 'update', 'no change window in the name' FROM nation) GROUP BY ALL""",
)
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream does not apply: refused changes, bad cells, keys and lines, and a file without a window."""
    landing = scans.landed_changes(spark, sf_dir)
    key, name = F.col("s_suppkey").cast("string"), F.col("s_name")
    suppliers = table(spark, sf_dir, "supplier").select("s_acctbal", F.lit("insert").alias("action"), key.alias("id"), name)
    put = lambda df, folder: df.write.mode("append").csv(f"{landing}/{folder}")
    put(suppliers.where("s_acctbal < 0").select("action", F.concat("id", F.lit("x")), "s_name", F.lit("1.00")), BAD_NAME)
    put(suppliers.where("s_acctbal >= 0").select("action", "id", "s_name", F.lit("1.00"), F.lit("more")), BAD_NAME)
    put(table(spark, sf_dir, "region").select(F.lit("delete"), F.lit(" "), "r_name", F.lit("")), BAD_NAME)
    put(table(spark, sf_dir, "nation").select(F.lit("update"), "n_nationkey", "n_name", F.lit("1.00")), "corrections")
    rows = quarantine(streamed(spark, sf_dir, landing))
    unnamed = F.col("reason") == NO_WINDOW
    change = F.when(unnamed, F.regexp_extract("file", r"([^/]*)/[^/]*$", 1)).otherwise(F.col("change"))
    return rows.groupBy(change.alias("change"), F.lower("action").alias("action"), "reason").agg(F.count("*").alias("changes"))


STORED_DAY = "2024-02-10"


@query(
    "stored_history",
    f"""WITH {STREAMED_SQL} SELECT 'at' AS part, {HISTORY_OUT} FROM after_two
      WHERE valid_from <= DATE '{STORED_DAY}' AND valid_to >= DATE '{STORED_DAY}'
    UNION ALL SELECT 'of', {HISTORY_OUT} FROM after_two
      WHERE cust_id = (SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'MACHINERY')""",
)
def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day and a key of a stored history, each from the folders that the manifest names for it."""
    store = streamed(spark, sf_dir, scans.landed_changes(spark, sf_dir))
    first = table(spark, sf_dir, "customer").where("c_mktsegment = 'MACHINERY'").agg(F.min("c_custkey").alias("k")).first().k
    day = store.asof(STORED_DAY).select(F.lit("at").alias("part"), "*")
    return shown(day.unionByName(store.history_of(first).select(F.lit("of").alias("part"), "*")))


@query(
    "apply_folder",
    f"""WITH {STREAMED_SQL} SELECT {HISTORY_OUT}, (SELECT count(*) FROM verdicts_one WHERE reason IS NOT NULL)
      + (SELECT count(*) FROM verdicts_two WHERE reason IS NOT NULL) AS refused FROM after_two""",
)
def apply_folder_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of delivered change files, checked and applied one after the other in the order of their names."""
    store = customer_store(spark, sf_dir)
    folder, quality = scratch(spark, "changes"), scratch(spark, "quality")
    ordered = inputs.customer_changes(spark, sf_dir).repartitionByRange("pos").sortWithinPartitions("pos")
    for name in (inputs.LATER_CHANGE_NAME, inputs.CHANGE_NAME):
        rows = ordered.where(F.col("change") == name).select("action", "cust_id", "name", "balance")
        delimited.write_delimited(rows, f"{folder}/{name}")
    done = apply_folder(spark, folder, CUSTOMER_CONTRACT, CleaningRules(strip=("*",)), "2024-M2", store, quality)
    return shown(store.read().select(*inputs.HISTORY_COLUMNS)).withColumn("refused", done.select(F.sum("changes_refused")).scalar())
