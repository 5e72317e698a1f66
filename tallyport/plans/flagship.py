"""The flagship: a delivery of order lines, cleaned and checked whole in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyport.contract import Contract, ContractColumn
from tallyport.functions.datatypes import BASE_PATTERNS
from tallyport.operators import checks
from tallyport.operators.cleaning import CleaningRules, Replacement, clean
from tallyport.plans.inputs import MINUS_SQL, TRAILING_MINUS, money, table
from tallyport.plans.registry import query

CONTRACT = Contract.of(
    ContractColumn("order_id", "bigint", "NOT NULL"),
    ContractColumn("quantity", "integer", "NOT NULL", "1:45"),
    ContractColumn("price", "numeric", "", "0:90000"),
    ContractColumn("discount", "numeric"),
    ContractColumn("flag", "text", "NOT NULL", "['A','N']"),
    ContractColumn("ship_date", "date"),
    decimal_sign=",",
)
RULES = CleaningRules(strip=("*",), replacements=(Replacement("<numeric>", TRAILING_MINUS, regex=True),))


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as text, with decimal commas, trailing minus signs and wrong cells."""
    day, price = F.col("l_shipdate"), F.translate(money("l_extendedprice"), ".", ",")
    quantity = F.col("l_quantity").cast("int").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("row"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(F.col("l_quantity") == 50, F.lit("veel"))
        .when(F.col("l_quantity") == 1, F.lit(" "))
        .otherwise(quantity).alias("quantity"),
        F.when(F.col("l_linenumber") == 7, F.concat(price, F.lit("-"))).otherwise(price).alias("price"),
        F.translate(money("l_discount"), ".", ",").alias("discount"),
        F.concat(F.lit(" "), "l_returnflag", F.lit("\t")).alias("flag"),
        F.when(F.col("l_linestatus") == "O", F.date_format(day, "yyyyMMdd"))
        .when(F.col("l_linenumber") == 1, F.date_format(day, "dd/MM/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd")).alias("ship_date"),
    )


CELLS_SQL = f"""lines AS (SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
    CASE WHEN l_quantity = 50 THEN 'veel' WHEN l_quantity = 1 THEN '' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    {MINUS_SQL.format("CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || CASE WHEN l_linenumber = 7 THEN '-' ELSE '' END")} AS price,
    CAST(CAST(l_discount AS DECIMAL(12,2)) AS VARCHAR) AS discount, l_returnflag AS flag,
    CASE WHEN l_linestatus = 'O' THEN strftime(l_shipdate, '%Y%m%d') WHEN l_linenumber = 1 THEN strftime(l_shipdate, '%d/%m/%Y')
      ELSE strftime(l_shipdate, '%Y-%m-%d') END AS ship_date FROM lineitem)"""


@query(
    "delivery_errors",
    f"""WITH {CELLS_SQL}, e AS (
      SELECT 'quantity' AS column_name, 2 AS error_code FROM lines WHERE quantity = ''
      UNION ALL SELECT 'quantity', 6 FROM lines WHERE NOT regexp_matches(quantity, '{BASE_PATTERNS["integer"]}')
      UNION ALL SELECT 'ship_date', 6 FROM lines WHERE NOT regexp_matches(ship_date, '{BASE_PATTERNS["date"]}')
      UNION ALL SELECT 'quantity', 3 FROM lines WHERE coalesce(NOT TRY_CAST(quantity AS INTEGER) BETWEEN 1 AND 45, true)
      UNION ALL SELECT 'price', 3 FROM lines WHERE coalesce(NOT TRY_CAST(price AS DOUBLE) BETWEEN 0 AND 90000, true)
      UNION ALL SELECT 'flag', 1 FROM lines WHERE flag NOT IN ('A', 'N'))
    SELECT column_name, CAST(error_code AS INTEGER) AS error_code, count(*) AS errors FROM e GROUP BY 1, 2""",
)
def delivery_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors per column and kind of all order lines."""
    numbered = raw_lines(spark, sf_dir).withColumnRenamed("row", "record_no")
    cleaned = clean(numbered, CONTRACT, RULES)
    return checks.errors_by_column(checks.failures(cleaned, CONTRACT, row="record_no"))
