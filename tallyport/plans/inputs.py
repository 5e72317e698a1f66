"""Deliveries, ledgers and histories that Spark derives from the given tables.

`orders` plays the delivery: every cell as text, with the faults suppliers make. A fault
depends on the values of the row, so all rows take part and each kind of fault occurs.
Each frame comes with the SQL that builds the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyport.contract import Contract, ContractColumn
from tallyport.functions import periods
from tallyport.functions.text import WHITE_SPACE
from tallyport.operators.cleaning import CleaningRules, Replacement, clean
from tallyport.operators.history import ACTION, POSITION
from tallyport.sources.staging import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SOURCE_CODE = "ORDERDESK"
NAMES = ["order_id", "customer_id", "status", "total", "order_date", "priority"]
CONTRACT = Contract.of(
    ContractColumn("order_id", "bigint", "NOT NULL", key="PRIMARY KEY"),
    ContractColumn("customer_id", "integer", "", "0:999999999"),
    ContractColumn("status", "text", "NOT NULL", "['O','F','P']"),
    ContractColumn("total", "numeric", "", "1000:400000", scale=2),
    ContractColumn("order_date", "date"),
    ContractColumn("priority", "text", "", "re:[1-4]-[A-Z ]+$"),
    source_code=SOURCE_CODE,
    frequency="Q",
    decimal_sign=",",
)
TRAILING_MINUS = {"(.*)-": "-\\1"}
RULES = CleaningRules(
    strip=("*",),
    replacements=(
        Replacement("<date>", {"00000000": "99991231", "0": "99991231"}),
        Replacement("<numeric>", TRAILING_MINUS, regex=True),
        Replacement("<integer>", TRAILING_MINUS, regex=True),
        Replacement("<bigint>", TRAILING_MINUS, regex=True),
    ),
)


def money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)").cast("string")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delivery as text. `row` is its position: orders are numbered from 0 in file order."""
    return raw_cells(table(spark, sf_dir, "orders")).withColumn("row", F.col("order_id").cast("long"))


def raw_cells(orders: DataFrame) -> DataFrame:
    """Text cells of order rows; columns other than the order's own go along."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    both = lambda p, s: (priority == p) & (status == s)
    customer, total = F.col("o_custkey").cast("string"), F.translate(money("o_totalprice"), ".", ",")
    day = F.col("o_orderdate").cast("date")
    own = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    return orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.when(both("1-URGENT", "F"), F.concat(customer, F.lit("-"))).otherwise(customer).alias("customer_id"),
        F.when(both("3-MEDIUM", "P"), F.lit(""))
        .when(both("5-LOW", "P"), F.lit("P, X ,,O"))
        .otherwise(status).alias("status"),
        F.when(both("2-HIGH", "O"), F.concat(total, F.lit("-")))
        .when(both("5-LOW", "F"), F.lit("onbekend"))
        .otherwise(total).alias("total"),
        F.when(both("4-NOT SPECIFIED", "P"), F.lit("00000000"))
        .when(both("5-LOW", "O"), F.date_format(day, "dd-MM-yyyy"))
        .when(both("1-URGENT", "P"), F.lit(""))
        .when(status == "F", F.date_format(day, "yyyyMMdd"))
        .otherwise(F.date_format(day, "yyyy-MM-dd")).alias("order_date"),
        F.concat(F.lit("\t "), priority, F.lit(" \u00a0")).alias("priority"),
        *[c for c in orders.columns if c not in own],
    )


RAW_SQL = """raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) || '-'
         ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
    CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN ''
         WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'P, X ,,O'
         ELSE o_orderstatus END AS status,
    CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'
           THEN replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') || '-'
         WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 'onbekend'
         ELSE replace(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR), '.', ',') END AS total,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN '00000000'
         WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN strftime(o_orderdate, '%d-%m-%Y')
         WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN ''
         WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
    chr(9) || ' ' || o_orderpriority || ' ' || chr(160) AS priority,
    o_orderkey AS "row"
  FROM orders)"""

WHITE_SPACE_SQL = " || ".join(f"chr({ord(c)})" for c in WHITE_SPACE)
MINUS_SQL = "regexp_replace({}, '(.*)-', '-\\1')"
# stripped, decimal point, replaced; the replacements act on stripped cells
CLEAN_SQL = f"""{RAW_SQL}, stripped AS (
  SELECT trim(order_id, ws) AS order_id, trim(customer_id, ws) AS customer_id, trim(status, ws) AS status,
    trim(total, ws) AS total, trim(order_date, ws) AS order_date, trim(priority, ws) AS priority, "row"
  FROM raw, (SELECT {WHITE_SPACE_SQL} AS ws)), clean AS (
  SELECT {MINUS_SQL.format('order_id')} AS order_id, {MINUS_SQL.format('customer_id')} AS customer_id, status,
    {MINUS_SQL.format("replace(total, ',', '.')")} AS total,
    CASE order_date WHEN '00000000' THEN '99991231' WHEN '0' THEN '99991231' ELSE order_date END AS order_date,
    priority, "row"
  FROM stripped)"""


def cleaned(raw: DataFrame) -> DataFrame:
    """A raw delivery with its `row`, cleaned by the rules."""
    numbered = raw.withColumnRenamed("row", "record_no")
    return clean(numbered, CONTRACT, RULES).withColumnRenamed("record_no", "row")


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(raw_orders(spark, sf_dir))


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned delivery, written once for the queries that read it several times."""
    return stage(clean_orders(spark, sf_dir))


def text_cells(df: DataFrame) -> DataFrame:
    """A delivery as `(row, column_name, value)`, to compare it cell by cell."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in NAMES if c in df.columns]
    return df.select("row", F.inline(F.array(*cells)))


def cells_sql(ctes: str, source: str, columns: list[str] = NAMES) -> str:
    parts = [f"SELECT \"row\", '{c}' AS column_name, {c} AS value FROM {source}" for c in columns]
    return f"WITH {ctes} " + " UNION ALL ".join(parts)


def orders_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded orders with the quarter they were delivered for."""
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("period", periods.of_date(F.col("o_orderdate"), "Q"))


QUARTER_SQL = "year(o_orderdate) || '-Q' || quarter(o_orderdate)"
LOADED_SQL = f"""loaded AS (SELECT *, {QUARTER_SQL} AS period FROM orders)"""


# --- dated history of customers, and change files made of orders -------------------

HISTORY_COLUMNS = ["cust_id", "name", "balance", "valid_from", "valid_to"]
BALANCE = "decimal(12,2)"


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as versions.

    BUILDING customers are unknown yet, customers in debt were closed at the end of 2023,
    and MACHINERY customers have an earlier version that ended then too.
    """
    known = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    balance = F.col("c_acctbal").cast(BALANCE)
    day = lambda text: F.to_date(F.lit(text))
    earlier = F.struct(
        (balance + 100).cast(BALANCE).alias("balance"),
        day(periods.BEGIN_OF_TIME).alias("valid_from"),
        day("2023-12-31").alias("valid_to"),
    )
    machinery, debt = F.col("c_mktsegment") == "MACHINERY", F.col("c_acctbal") < 0
    latest = F.struct(
        balance.alias("balance"),
        F.when(machinery, day("2024-01-01")).otherwise(day(periods.BEGIN_OF_TIME)).alias("valid_from"),
        F.when(debt, day("2024-01-01")).otherwise(day(periods.END_OF_TIME)).alias("valid_to"),
    )
    versions = F.array_compact(F.array(F.when(machinery, earlier), latest))
    return known.select(
        F.col("c_custkey").alias("cust_id"), F.col("c_name").alias("name"), F.inline(versions)
    )


HISTORY_SQL = """history AS (
  SELECT c_custkey AS cust_id, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(12,2)) + 100 AS DECIMAL(12,2)) AS balance,
    DATE '1970-01-01' AS valid_from, DATE '2023-12-31' AS valid_to
  FROM customer WHERE c_mktsegment = 'MACHINERY'
  UNION ALL
  SELECT c_custkey, c_name, CAST(c_acctbal AS DECIMAL(12,2)),
    CASE WHEN c_mktsegment = 'MACHINERY' THEN DATE '2024-01-01' ELSE DATE '1970-01-01' END,
    CASE WHEN c_acctbal < 0 THEN DATE '2024-01-01' ELSE DATE '9999-12-31' END
  FROM customer WHERE c_mktsegment <> 'BUILDING')"""

CHANGE_NAME = "mutation_20240101-20240215"
LATER_CHANGE_NAME = "mutation_20240201-20240315"


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as changes of their customer: the priority gives the instruction.

    Open orders form the first change file, the other ones the second (`change`).
    """
    action = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "insert")
        .when(F.col("o_orderpriority") == "2-HIGH", "Update")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "delete")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "downdate")
        .otherwise("correct")
    )
    return table(spark, sf_dir, "orders").select(
        action.alias(ACTION),
        F.col("o_custkey").alias("cust_id"),
        F.concat(F.lit("Changed by "), F.col("o_orderkey").cast("string")).alias("name"),
        F.col("o_totalprice").cast(BALANCE).alias("balance"),
        F.col("o_orderkey").alias(POSITION),
        F.when(F.col("o_orderstatus") == "O", CHANGE_NAME).otherwise(LATER_CHANGE_NAME).alias("change"),
    )


CHANGES_SQL = f"""changes AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'insert' WHEN '2-HIGH' THEN 'Update' WHEN '3-MEDIUM' THEN 'delete'
      WHEN '4-NOT SPECIFIED' THEN 'downdate' ELSE 'correct' END AS action,
    o_custkey AS cust_id, 'Changed by ' || o_orderkey AS name, CAST(o_totalprice AS DECIMAL(12,2)) AS balance,
    o_orderkey AS pos,
    CASE WHEN o_orderstatus = 'O' THEN '{CHANGE_NAME}' ELSE '{LATER_CHANGE_NAME}' END AS change
  FROM orders)"""


def verdict_sql(history: str = "history", changes: str = "changes") -> str:
    """Each change with the reason of its refusal, written as correlated tests."""
    return f"""SELECT c.*, CASE
      WHEN lower(action) = 'insert' AND EXISTS (SELECT 1 FROM {history} h WHERE h.cust_id = c.cust_id)
        THEN 'key already exists'
      WHEN lower(action) = 'insert' AND EXISTS (SELECT 1 FROM {changes} e WHERE e.cust_id = c.cust_id
          AND lower(e.action) = 'insert' AND e.pos < c.pos) THEN 'duplicate key in file'
      WHEN lower(action) IN ('update', 'delete') AND NOT EXISTS (SELECT 1 FROM {history} h
          WHERE h.cust_id = c.cust_id AND h.valid_to = DATE '9999-12-31') THEN 'key has no current row'
      WHEN lower(action) NOT IN ('insert', 'update', 'delete', 'downdate') THEN 'unknown instruction'
      END AS reason FROM {changes} c"""


def applied_sql(history: str, changes: str, start: str, end: str) -> str:
    """The history after a change file: the rows before it and its new versions."""
    closed_later = f"""EXISTS (SELECT 1 FROM verdicts_{changes} d WHERE d.cust_id = {{0}}.cust_id
      AND d.reason IS NULL AND lower(d.action) IN ('update', 'delete'){{1}})"""
    return f"""SELECT cust_id, name, balance, valid_from,
      CASE WHEN valid_to = DATE '9999-12-31' AND {closed_later.format('h', '')} THEN DATE '{end}'
        ELSE valid_to END AS valid_to FROM {history} h
    UNION ALL
    SELECT cust_id, name, balance, DATE '{start}',
      CASE WHEN {closed_later.format('n', ' AND d.pos > n.pos')} THEN DATE '{end}' ELSE DATE '9999-12-31' END
    FROM verdicts_{changes} n WHERE reason IS NULL AND lower(action) IN ('insert', 'update')"""


def shown(df: DataFrame) -> DataFrame:
    """Dates and decimals in the form both engines print alike."""
    columns = []
    for field in df.schema:
        kind = field.dataType.typeName()
        column = F.col(field.name)
        if kind == "date":
            column = column.cast("string").alias(field.name)
        elif kind == "decimal":
            column = column.cast("double").alias(field.name)
        columns.append(column)
    return df.select(*columns)
