"""Projections and cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyport.contract import Contract, ContractColumn
from tallyport.functions import text
from tallyport.operators import cleaning, loading
from tallyport.operators.cleaning import Replacement
from tallyport.plans import inputs
from tallyport.plans.inputs import (
    CLEAN_SQL, CONTRACT, HISTORY_SQL, MINUS_SQL, NAMES, RAW_SQL, WHITE_SPACE_SQL, cells_sql, shown, table,
)
from tallyport.plans.registry import query
from tallyport.sources import staging


def select_only(columns: list[str]):
    """The raw delivery reduced to a row number and some columns."""
    return lambda spark, sf_dir: inputs.raw_orders(spark, sf_dir).select("row", *columns)


@query(
    "normalise_headers",
    f"""SELECT doc_id, CASE WHEN name = '' THEN 'col_' || doc_id ELSE name END AS name FROM (
      SELECT doc_id, regexp_replace(trim(regexp_replace(lower(trim(text, {WHITE_SPACE_SQL})), '[^0-9a-z_]+', '_', 'g'), '_'),
        '^[^a-z]+', '') AS name FROM documents)""",
)
def normalise_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header rule as a column expression, over texts that need all of it."""
    documents = table(spark, sf_dir, "documents")
    return documents.select("doc_id", text.header_name(F.col("text"), F.col("doc_id")).alias("name"))


@query("conform_columns", f"""WITH {RAW_SQL} SELECT "row", order_id, customer_id, 'onbekend' AS region, status, '0' AS rank FROM raw""")
def conform_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery in another column order and without two declared columns."""
    contract = Contract.of(
        ContractColumn("order_id", "bigint"),
        ContractColumn("customer_id", "integer"),
        ContractColumn("region", "text", "DEFAULT 'onbekend'", default="onbekend"),
        ContractColumn("status", "text"),
        ContractColumn("rank", "integer", default="0"),
    )
    return loading.conform(select_only(["status", "customer_id", "order_id"])(spark, sf_dir), contract)


@query(
    "select_rows",
    f"""WITH {RAW_SQL} SELECT "row", status, order_date FROM raw
    WHERE status IN ('P', 'P, X ,,O') AND order_date IN ('', '00000000', '1998-01-02', '1999-05-05')""",
)
def select_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = {"status": ["P", "P, X ,,O"], "order_date": ["", "00000000", "1998-01-02", "1999-05-05"]}
    return cleaning.select_rows(select_only(["status", "order_date"])(spark, sf_dir), wanted)


@query(
    "strip_space",
    f"""SELECT doc_id AS "row", trim(text, {WHITE_SPACE_SQL}) AS text, trim(lang, {WHITE_SPACE_SQL}) AS lang FROM documents
    UNION ALL SELECT o_orderkey, trim(chr(9) || ' ' || o_orderpriority || ' ' || chr(160), {WHITE_SPACE_SQL}), 'xx' FROM orders""",
)
def strip_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends of long texts, and of cells with tabs and no-break spaces."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_no"), "text", "lang")
    orders = inputs.raw_orders(spark, sf_dir).select(
        F.col("row").alias("record_no"), F.col("priority").alias("text"), F.lit("xx").alias("lang")
    )
    return cleaning.strip_space(documents.unionByName(orders)).withColumnRenamed("record_no", "row")


@query("decimal_comma", f"""WITH {RAW_SQL} SELECT "row", status, replace(total, ',', '.') AS total FROM raw""")
def decimal_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.decimal_comma(select_only(["status", "total"])(spark, sf_dir), CONTRACT)


@query(
    "replace_values",
    f"""WITH {RAW_SQL} SELECT "row", CASE status WHEN 'O' THEN 'F' WHEN 'F' THEN 'O' WHEN '' THEN 'leeg' ELSE status END
      AS status, CASE order_date WHEN '00000000' THEN '99991231' ELSE order_date END AS order_date FROM raw""",
)
def replace_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole cells, all at once: O and F are swapped, not chained."""
    rules = (
        Replacement("status", {"O": "F", "F": "O", "": "leeg"}),
        Replacement("order_date", {"00000000": "99991231"}),
    )
    return cleaning.replace_values(select_only(["status", "order_date"])(spark, sf_dir), CONTRACT, rules)


@query(
    "replace_regex",
    f"""WITH {RAW_SQL} SELECT "row", {MINUS_SQL.format('total')} AS total,
      regexp_replace(regexp_replace(order_date, '^([0-9]{{2}})-([0-9]{{2}})-([0-9]{{4}})$', '\\3-\\2-\\1'), '-', '/', 'g')
        AS order_date FROM raw""",
)
def replace_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unanchored patterns with back-references, several in their declared order."""
    dates = {"^(?P<d>[0-9]{2})-([0-9]{2})-([0-9]{4})$": "\\3-\\2-\\1", "-": "/"}
    rules = (
        Replacement("total", inputs.TRAILING_MINUS, regex=True),
        Replacement("order_date", dates, regex=True),
    )
    return cleaning.replace_values(select_only(["total", "order_date"])(spark, sf_dir), CONTRACT, rules)


@query("replace_by_type", cells_sql(CLEAN_SQL, "clean"))
def replace_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All cleaning steps, with replacements declared for datatypes."""
    return inputs.text_cells(inputs.clean_orders(spark, sf_dir))


@query("drop_generated", f"WITH {HISTORY_SQL} SELECT cust_id, name, CAST(balance AS DOUBLE) AS balance FROM history")
def drop_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(cleaning.drop_generated(inputs.customer_history(spark, sf_dir)))


@query(
    "split_instructions",
    f"""WITH {inputs.CHANGES_SQL} SELECT action, count(*) AS changes, count(DISTINCT cust_id) AS keys,
      CAST(sum(balance) AS DOUBLE) AS balance FROM changes GROUP BY 1""",
)
def split_instructions(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = inputs.customer_changes(spark, sf_dir).select("action", "cust_id", "name", "balance")
    instructions, data = cleaning.split_instructions(changes, ("action",))
    key, _, amount = data
    grouped = changes.groupBy(*instructions).agg(
        F.count("*").alias("changes"), F.count_distinct(key).alias("keys"), F.sum(amount).alias("balance")
    )
    return shown(grouped)


@query(
    "stamp_delivery",
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'OLD' ELSE 'ORDERDESK' END AS source_code,
      CASE WHEN o_orderstatus = 'F' THEN {inputs.QUARTER_SQL} ELSE '2002-Q1' END AS period,
      '1970-01-01' AS valid_from, '9999-12-31' AS valid_to FROM orders""",
)
def stamp_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded before keep their stamp; new ones have an empty or no period."""
    loaded = inputs.orders_by_period(spark, sf_dir)
    old, open_ = F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "O"
    table_ = loaded.select(
        "o_orderkey",
        F.when(old, F.lit("OLD")).alias("source_code"),
        F.when(old, F.col("period")).when(open_, F.lit("")).alias("period"),
    )
    return shown(loading.stamp_delivery(table_, inputs.SOURCE_CODE, "2002-Q1").drop("loaded_at"))


@query("number_records", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS record_no FROM orders")
def number_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staging.traced_parquet(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", *staging.TRACE)
    return staging.number_rows(rows)


@query("apply_defaults", f"""WITH {RAW_SQL} SELECT "row", order_id, 'EUR' AS currency, status FROM raw""")
def apply_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only columns the delivery lacks get their default; delivered cells stay empty."""
    contract = Contract.of(
        ContractColumn("order_id", "bigint"),
        ContractColumn("currency", "text", "DEFAULT 'EUR'", default="EUR"),
        ContractColumn("status", "text", "DEFAULT 'O'", default="O"),
    )
    return loading.conform(select_only(["order_id", "status"])(spark, sf_dir), contract)


@query(
    "map_supplier_types",
    f"""WITH {CLEAN_SQL} SELECT TRY_CAST(order_id AS INTEGER) AS order_id, 
      CAST(TRY_CAST(customer_id AS DECIMAL(18,2)) AS DOUBLE) AS customer_id, status, TRY_CAST(total AS DOUBLE) AS total,
      CAST(CAST(coalesce(CASE WHEN regexp_matches(order_date, '^[0-9]{{4}}-') THEN TRY_STRPTIME(order_date, '%Y-%m-%d') END,
      CASE WHEN regexp_matches(order_date, '^[0-9]{{8}}$') THEN TRY_STRPTIME(order_date, '%Y%m%d') END) AS DATE) AS VARCHAR)
      AS order_date FROM clean""",
)
def map_supplier_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types from the supplier's dictionary; decimals make a number numeric."""
    dictionary = [
        ("order_id", "NUMC", 0),
        ("customer_id", "INT4", 2),
        ("status", "CHAR", 0),
        ("total", "CURR", 0),
        ("order_date", "DATS", 0),
    ]
    return shown(cleaning.cast_by_dictionary(inputs.clean_orders(spark, sf_dir), dictionary))


@query(
    "scalar_functions",
    f"""SELECT o_orderkey, trim(lower(o_orderpriority), {WHITE_SPACE_SQL}) AS lowered,
      regexp_replace(o_orderpriority, '[A-Z]+', 'x', 'g') AS replaced, len(string_split(o_orderpriority, '-')) AS parts,
      translate(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS comma,
      regexp_matches(o_orderpriority, '^(?:[1-3]-)') AS matched,
      coalesce(TRY_CAST(left(o_orderpriority, 1) AS DOUBLE), -1) AS number,
      strftime(date_trunc('month', o_orderdate) - INTERVAL 1 DAY, '%Y-%m-%d') AS month_before,
      strftime(strptime(regexp_extract('full_' || strftime(o_orderdate, '%Y%m%d') || '.csv', '([0-9]{{8}})', 1), '%Y%m%d'), '%Y-%m-%d')
        AS day_of_name, o_orderstatus IN ('F') AS empty FROM orders""",
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scalar building blocks of the operators, over all orders."""
    priority, day = F.col("o_orderpriority"), F.col("o_orderdate").cast("date")
    name = F.concat(F.lit("full_"), F.date_format(day, "yyyyMMdd"), F.lit(".csv"))
    numeric = F.substring(priority, 1, 1)
    status = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.strip(F.lower(priority)).alias("lowered"),
        F.regexp_replace(priority, "[A-Z]+", "x").alias("replaced"),
        F.size(F.split(priority, "-")).cast("long").alias("parts"),
        F.translate(inputs.money("o_totalprice"), ".", ",").alias("comma"),
        text.starts_with_match(priority, "[1-3]-").alias("matched"),
        F.coalesce(cleaning.datatypes.numbers.real_number(numeric), F.lit(-1.0)).alias("number"),
        F.date_sub(F.trunc(day, "MM"), 1).cast("string").alias("month_before"),
        F.to_date(F.regexp_extract(name, "([0-9]{8})", 1), "yyyyMMdd").cast("string").alias("day_of_name"),
        text.null_or_empty(status).alias("empty"),
    )
