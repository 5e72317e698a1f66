"""Counts, moments, frequencies, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyport.contract import Contract, ContractColumn
from tallyport.operators import checks, compare, profile
from tallyport.plans import checking, inputs
from tallyport.plans.inputs import CLEAN_SQL, CONTRACT, QUARTER_SQL, shown, table
from tallyport.plans.registry import query
from tallyport.sources import tables

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey"]


@query("count_by_period", f"SELECT {QUARTER_SQL} AS period, count(*) AS count FROM orders GROUP BY 1")
def count_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.count_by_period(inputs.orders_by_period(spark, sf_dir))


@query("distinct_periods", f"SELECT DISTINCT {QUARTER_SQL} AS period FROM orders")
def distinct_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.orders_by_period(spark, sf_dir).select("period").distinct()


@query("table_size", "SELECT count(*) AS rows FROM lineitem")
def table_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("rows"))


@query(
    "has_rows",
    """SELECT EXISTS (SELECT 1 FROM orders WHERE o_totalprice > 400000) AS expensive,
      EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0) AS negative""",
)
def has_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-empty tests read until the first row only."""
    orders = table(spark, sf_dir, "orders")
    some = lambda condition: F.lit(not orders.where(condition).select("o_orderkey").isEmpty())
    return spark.range(1).select(
        some("o_totalprice > 400000").alias("expensive"), some("o_totalprice < 0").alias("negative")
    )


def rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({c: F.round(c, 4) for c in doubles})


def moments_sql(source: str, column: str, n: str) -> str:
    return f"""SELECT '{column}' AS column_name, {n} AS n, count(*) - count({column}) AS missing,
      round(CAST(min({column}) AS DOUBLE), 4) AS min, round(CAST(max({column}) AS DOUBLE), 4) AS max, round(avg({column}), 4) AS mean,
      round(quantile_cont(CAST({column} AS DOUBLE), 0.5), 4) AS median, round(stddev_samp({column}), 4) AS std FROM {source}"""


@query("moments_table", " UNION ALL ".join(moments_sql("lineitem", c, f"count({c})") for c in NUMERIC))
def moments_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.moments(table(spark, sf_dir, "lineitem"), NUMERIC, text=False))


DELIVERED_SQL = f"""{CLEAN_SQL}, numbers AS (SELECT CAST(TRY_CAST(order_id AS BIGINT) AS DOUBLE) AS order_id,
    CAST(TRY_CAST(customer_id AS BIGINT) AS DOUBLE) AS customer_id, TRY_CAST(total AS DOUBLE) AS total FROM clean)"""
DELIVERED_NUMBERS = ["order_id", "customer_id", "total"]
DELIVERED_MOMENTS = " UNION ALL ".join(moments_sql("numbers", c, "count(*)") for c in DELIVERED_NUMBERS)


@query("moments_delivery", f"WITH {DELIVERED_SQL} {DELIVERED_MOMENTS}")
def moments_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the text delivery: unusable text is missing, and n counts all rows."""
    return rounded(profile.moments(inputs.staged_orders(spark, sf_dir), DELIVERED_NUMBERS, text=True))


LOADED_SQL = """loaded AS (SELECT CAST(o_orderkey AS DOUBLE) AS order_id, CAST(o_custkey AS DOUBLE) AS customer_id,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS total FROM orders)"""


def loaded_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table the delivery can be compared with; pending orders have no total yet."""
    pending = F.col("o_orderstatus") == "P"
    return inputs.orders_by_period(spark, sf_dir).select(
        "period",
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(~pending, F.col("o_totalprice")).alias("total"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(~pending, F.col("o_orderpriority")).alias("priority"),
    )


def compare_moments_sql() -> str:
    """Both sides as text per statistic, joined."""
    def side(source: str, name: str, n: str) -> str:
        rows = []
        for c in DELIVERED_NUMBERS:
            values = {
                "n": f"CAST({n.format(c)} AS VARCHAR)", "missing": f"CAST(count(*) - count({c}) AS VARCHAR)",
                "min": f"min({c})", "max": f"max({c})", "mean": f"avg({c})",
                "median": f"quantile_cont({c}, 0.5)", "std": f"stddev_samp({c})",
            }
            for statistic, value in values.items():
                text = value if value.startswith("CAST") else f"printf('%.2f', {value})"
                rows.append(f"SELECT '{c}' AS column_name, '{statistic}' AS statistic, {text} AS {name} FROM {source}")
        return " UNION ALL ".join(rows)

    return f"""WITH {DELIVERED_SQL}, {LOADED_SQL}, d AS ({side('numbers', 'delivery', 'count(*)')}),
      t AS ({side('loaded', 'database', 'count({})')})
      SELECT column_name, statistic, delivery, database FROM d JOIN t USING (column_name, statistic)"""


@query("moments_compare", compare_moments_sql())
def moments_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivery = profile.moments(inputs.staged_orders(spark, sf_dir), DELIVERED_NUMBERS, text=True)
    return profile.compare_moments(
        delivery, profile.moments(loaded_orders(spark, sf_dir), DELIVERED_NUMBERS, text=False)
    )


COUNTED = ["order_id", "customer_id", "status", "order_date", "priority"]
SHARES_SQL = f"""{CLEAN_SQL}, cells AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, {c} AS value FROM clean" for c in COUNTED)}),
  counts AS (SELECT column_name, value, count(*) AS rows FROM cells GROUP BY 1, 2),
  shares AS (SELECT column_name, value, rows, 100.0 * rows / sum(rows) OVER (PARTITION BY column_name) AS percent FROM counts
    WHERE column_name IN (SELECT column_name FROM counts GROUP BY 1 HAVING count(*) BETWEEN 2 AND 50))"""


@query("freq_delivery", f"WITH {SHARES_SQL} SELECT column_name, value, rows, round(percent, 4) AS percent FROM shares")
def freq_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value counts of the columns with 2 to 50 categories; near-unique columns are left out."""
    return rounded(profile.frequencies(inputs.staged_orders(spark, sf_dir), COUNTED))


@query(
    "freq_table",
    """SELECT o_orderpriority AS value, count(*) AS rows, round(100.0 * count(*) / (SELECT count(*) FROM orders), 4) AS percent
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""",
)
def freq_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a value count in the total."""
    return rounded(profile.table_shares(loaded_orders(spark, sf_dir), "priority"))


FREQ_COMPARE_SQL = f"""{SHARES_SQL}, db AS (
    SELECT 'status' AS column_name, o_orderstatus AS category, count(*) AS rows FROM orders GROUP BY 2
    UNION ALL SELECT 'priority', o_orderpriority, count(*) FROM orders WHERE o_orderstatus <> 'P' GROUP BY 2),
  compared AS (SELECT column_name, category, coalesce(CAST(s.rows AS VARCHAR), 'Missing') AS absolute,
    coalesce(printf('%.2f', CAST(s.percent AS DOUBLE)), 'n.a.') AS delivery_percent,
    coalesce(printf('%.2f', 100.0 * db.rows / (SELECT count(*) FROM orders)), 'Missing') AS database_percent
  FROM (SELECT column_name, value AS category, rows, percent FROM shares) s FULL JOIN db USING (column_name, category))"""


@query("freq_compare", f"WITH {FREQ_COMPARE_SQL} SELECT * FROM compared")
def freq_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = ["status", "priority"]
    delivery = profile.frequencies(inputs.staged_orders(spark, sf_dir), few)
    database = profile.all_table_shares(loaded_orders(spark, sf_dir), few)
    return profile.compare_frequencies(delivery, database, CONTRACT.of_base("date"))


@query(
    "percent_of_total",
    """SELECT l_returnflag AS value, count(*) AS rows, round(100.0 * count(*) / (SELECT count(*) FROM lineitem), 4) AS percent
    FROM lineitem GROUP BY 1""",
)
def percent_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.table_shares(table(spark, sf_dir, "lineitem"), "l_returnflag"))


@query(
    "profile_delivery",
    f"""WITH {FREQ_COMPARE_SQL}, m AS ({compare_moments_sql()})
    SELECT 'period' AS part, '' AS column_name, period AS item, CAST(rows AS VARCHAR) AS delivery, '' AS database FROM
      (SELECT {QUARTER_SQL} AS period, count(*) AS rows FROM orders GROUP BY 1)
    UNION ALL SELECT 'moments', column_name, statistic, delivery, database FROM m
    UNION ALL SELECT 'frequencies', column_name, category, delivery_percent, database_percent FROM compared""",
)
def profile_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole profile as one frame."""
    loaded = loaded_orders(spark, sf_dir)
    parts = profile.profile_delivery(inputs.staged_orders(spark, sf_dir), loaded, CONTRACT, ["*"])
    columns = ["part", "column_name", "item", "delivery", "database"]
    part = lambda name: F.lit(name).alias("part")
    periods_ = parts["periods"].select(
        part("period"), F.lit("").alias("column_name"), F.col("period").alias("item"),
        F.col("count").cast("string").alias("delivery"), F.lit("").alias("database"),
    )
    moments = parts["moments"].select(
        part("moments"), "column_name", F.col("statistic").alias("item"), "delivery", "database"
    )
    shares = parts["frequencies"].select(
        part("frequencies"), "column_name", F.col("category").alias("item"),
        F.col("delivery_percent").alias("delivery"), F.col("database_percent").alias("database"),
    )
    return periods_.unionByName(moments).unionByName(shares).select(*columns)


# --- sorts, limits, set operations --------------------------------------------------


@query("sort_periods", f"SELECT {QUARTER_SQL} AS period, count(*) AS count FROM orders GROUP BY 1 ORDER BY 1")
def sort_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_period(spark, sf_dir).orderBy("period")


@query(
    "sort_freq_desc",
    """SELECT l_linestatus || l_returnflag AS value, count(*) AS rows, round(100.0 * count(*) / (SELECT count(*) FROM lineitem), 4) AS percent
    FROM lineitem GROUP BY 1 ORDER BY 2 DESC""",
)
def sort_freq_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.concat("l_linestatus", "l_returnflag").alias("flags"))
    return rounded(profile.table_shares(rows, "flags")).orderBy(F.desc("percent"), "value")


@query("sort_by_key", "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey")
def sort_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy("c_custkey")


@query("first_row", "SELECT count(*) AS rows, min(o_orderstatus) AS status FROM (SELECT * FROM orders WHERE o_orderstatus = 'F' LIMIT 1)")
def first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row that meets a condition, as the existence test reads it."""
    row = tables.select_from(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_orderstatus = 'F'", limit=1)
    return row.agg(F.count("*").alias("rows"), F.min("o_orderstatus").alias("status"))


@query(
    "union_reports",
    f"""WITH {checking.FAILED_SQL} SELECT 'orders' AS delivery, "row", column_name, error_code, message FROM failed
    UNION ALL SELECT 'customers', c_custkey, 'balance', 3, 'Value ' || CAST(c_acctbal AS VARCHAR) || ' exceeds min 0 or max 100000'
      FROM customer WHERE c_acctbal < 0""",
)
def union_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reports of two deliveries in one."""
    contract = Contract.of(ContractColumn("balance", "numeric", "", "0:100000"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("row"), F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("balance")
    )
    columns = ["delivery", "row", "column_name", "error_code", "message"]
    one = checking.failed_cells()(spark, sf_dir).withColumn("delivery", F.lit("orders"))
    two = checks.failures(customers, contract).withColumn("delivery", F.lit("customers"))
    return one.select(*columns).unionByName(two.select(*columns))


@query(
    "diff_columns",
    """SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def diff_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Except of two sets, for keys of tables as for the names of columns."""
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return keys.subtract(urgent.select("o_custkey"))
