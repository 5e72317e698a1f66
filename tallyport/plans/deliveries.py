"""Ledger joins, periods, comparison, removal, and the delivery as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyport.functions import periods
from tallyport.operators import checks, compare, history, ledger
from tallyport.plans import checking, inputs, scans
from tallyport.plans.inputs import CONTRACT, HISTORY_SQL, QUARTER_SQL, shown, table
from tallyport.plans import load as load_module
from tallyport.plans.load import Delivery, load_delivery, load_seed, run_deliveries
from tallyport.plans.registry import query
from tallyport.session import scratch
from tallyport.sources import delimited, files

WANTED_SQL = f"""wanted AS (SELECT {QUARTER_SQL} AS period, count(*) AS orders FROM orders WHERE o_orderstatus = 'O' GROUP BY 1),
  ledger AS (SELECT {QUARTER_SQL} AS period, count(*) AS records FROM orders
    WHERE quarter(o_orderdate) <= 2 AND o_orderstatus <> 'O' GROUP BY 1)"""


def wanted_and_ledger(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Quarters with open orders, and a ledger of the other orders of first half-years."""
    orders = inputs.orders_by_period(spark, sf_dir)
    open_ = F.col("o_orderstatus") == "O"
    wanted = orders.where(open_).groupBy("period").agg(F.count("*").alias("orders"))
    loaded = orders.where(~open_ & (F.quarter("o_orderdate") <= 2))
    return wanted, loaded.groupBy("period").agg(F.count("*").alias("records"))


@query("delivery_exists", f"WITH {WANTED_SQL} SELECT * FROM wanted WHERE period IN (SELECT period FROM ledger)")
def delivery_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.existing_deliveries(*wanted_and_ledger(spark, sf_dir))


@query("deliveries_to_load", f"WITH {WANTED_SQL} SELECT * FROM wanted WHERE period NOT IN (SELECT period FROM ledger)")
def deliveries_to_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.deliveries_to_load(*wanted_and_ledger(spark, sf_dir))


@query(
    "reconcile_deliveries",
    f"""WITH d AS (SELECT DISTINCT o_orderstatus AS supplier, o_orderpriority AS project, {QUARTER_SQL} AS period FROM orders
      WHERE quarter(o_orderdate) < 4),
    f AS (SELECT o_orderstatus AS supplier, o_orderpriority AS project, {QUARTER_SQL} AS period, count(*) AS records FROM orders
      WHERE quarter(o_orderdate) > 1 GROUP BY 1, 2, 3)
    SELECT supplier, project, period, d.supplier IS NOT NULL AS declared, coalesce(f.records, -1) AS records
    FROM d FULL JOIN f USING (supplier, project, period)""",
)
def reconcile_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared are first to third quarters, found are second to fourth ones."""
    orders = inputs.orders_by_period(spark, sf_dir).withColumnsRenamed(
        {"o_orderstatus": "supplier", "o_orderpriority": "project"}
    )
    key = ["supplier", "project", "period"]
    declared = orders.where(F.quarter("o_orderdate") < 4).select(*key).distinct()
    found = orders.where(F.quarter("o_orderdate") > 1).groupBy(*key).agg(F.count("*").alias("records"))
    return ledger.reconcile(declared, found)


@query(
    "pending_deliveries",
    """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders,
        sum(CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS stored,
        sum(CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 1 ELSE 0 END) AS loaded FROM orders GROUP BY 1)
    SELECT strftime(day, '%Y%m%d') AS "to", orders FROM o WHERE stored = 0 AND loaded = 0""",
)
def pending_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with orders, without those in stored extracts or loaded ones."""
    orders = table(spark, sf_dir, "orders").withColumn("to", F.date_format("o_orderdate", "yyyyMMdd"))
    offered = orders.groupBy("to").agg(F.count("*").alias("orders"))
    stored = orders.where("o_orderstatus = 'F' and o_orderpriority = '1-URGENT'").select(
        files.delivery_range(F.concat(F.lit("full_"), "to"))[1].alias("to")
    )
    loaded = orders.where("o_orderstatus = 'P' and o_orderpriority = '5-LOW'").select("to")
    return ledger.pending(offered, stored.distinct(), loaded.distinct(), ["to"])


@query(
    "previous_period_fallback",
    f"""WITH w AS (SELECT DISTINCT o_orderpriority AS project, year(o_orderdate) AS y, quarter(o_orderdate) AS q FROM orders),
    f AS (SELECT o_orderpriority AS project, year(o_orderdate) AS y, quarter(o_orderdate) AS q,
      strftime(max(o_orderdate), '%Y%m%d') || '_desk' AS name FROM orders
      WHERE month(o_orderdate) NOT IN (4, 5, 6, 7) AND year(o_orderdate) <> 1998 GROUP BY 1, 2, 3)
    SELECT w.project, w.y || '-Q' || w.q AS period, coalesce(own.name, prev.name) AS name,
      CASE WHEN own.name IS NOT NULL THEN w.y || '-Q' || w.q
        WHEN prev.name IS NOT NULL THEN prev.y || '-Q' || prev.q END AS true_period
    FROM w LEFT JOIN f own ON own.project = w.project AND own.y = w.y AND own.q = w.q
    LEFT JOIN f prev ON prev.project = w.project AND prev.y * 4 + prev.q = w.y * 4 + w.q - 1""",
)
def previous_period_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second quarters and 1998 have no file of their own; the one before serves if there is one."""
    orders = inputs.orders_by_period(spark, sf_dir).withColumnRenamed("o_orderpriority", "project")
    wanted = orders.select("project", "period").distinct()
    delivered = orders.where(~F.month("o_orderdate").isin(4, 5, 6, 7) & (F.year("o_orderdate") != 1998))
    name = F.concat(F.date_format(F.max("o_orderdate"), "yyyyMMdd"), F.lit("_desk"))
    return ledger.with_previous(wanted, delivered.groupBy("project", "period").agg(name.alias("name")))


AFTER_SQL = f"""WITH {HISTORY_SQL}, {inputs.CHANGES_SQL}, verdicts_changes AS ({inputs.verdict_sql()}),
  after AS ({inputs.applied_sql('history', 'changes', '2024-02-01', '2024-01-31')}),
  a AS (SELECT cust_id, name, CAST(balance AS VARCHAR) AS balance FROM history WHERE valid_to = DATE '9999-12-31'),
  b AS (SELECT cust_id, name, CAST(balance AS VARCHAR) AS balance FROM after WHERE valid_to = DATE '9999-12-31')"""


@query(
    "compare_tables",
    f"""{AFTER_SQL}, j AS (SELECT cust_id, a.name AS an, b.name AS bn, a.balance AS ab, b.balance AS bb
      , CASE WHEN a.cust_id IS NOT NULL THEN 'present' END AS ar, CASE WHEN b.cust_id IS NOT NULL THEN 'present' END AS br
      FROM a FULL JOIN b USING (cust_id))
    SELECT cust_id, '*' AS column_name, ar AS self, br AS other FROM j WHERE ar IS DISTINCT FROM br
    UNION ALL SELECT cust_id, 'name' AS column_name, an AS self, bn AS other FROM j WHERE an IS DISTINCT FROM bn
    UNION ALL SELECT cust_id, 'balance', ab, bb FROM j WHERE ab IS DISTINCT FROM bb""",
)
def compare_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current customers before and after a change file, cell by cell."""
    before = inputs.customer_history(spark, sf_dir)
    changes = inputs.customer_changes(spark, sf_dir).drop("change")
    window = periods.change_window(F.lit(inputs.CHANGE_NAME))
    after = history.apply_changes(before, changes, ["cust_id"], *window).current
    columns = ["cust_id", "name", "balance"]
    return compare.cell_differences(before.where(history.is_current()).select(*columns), after.select(*columns), ["cust_id"])


@query(
    "compare_shapes",
    f"""WITH {HISTORY_SQL} SELECT 'self' AS side, count(*) AS rows, CAST(5 AS INTEGER) AS columns FROM history
    UNION ALL SELECT 'other', count(*), 5 FROM customer""",
)
def compare_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.shapes(inputs.customer_history(spark, sf_dir), table(spark, sf_dir, "customer"))


@query("next_sequence", f"""SELECT count(*) + 1 AS next_sequence, count(*) AS deliveries FROM
    (SELECT DISTINCT {QUARTER_SQL} AS period FROM orders)""")
def next_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.next_sequence(scans.ledger(spark, sf_dir))


@query("delivery_totals", f"SELECT {QUARTER_SQL} AS period, count(*) AS records FROM orders GROUP BY 1")
def delivery_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record counts as the ledger keeps them."""
    return scans.ledger(spark, sf_dir).select("period", "records")


PERIOD = "1998-Q2"


@query("remove_delivery", f"SELECT o_orderkey, {QUARTER_SQL} AS period FROM orders WHERE {QUARTER_SQL} <> '{PERIOD}'")
def remove_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.orders_by_period(spark, sf_dir).select("o_orderkey", "period")
    return ledger.without_delivery(rows, PERIOD)


@query(
    "deleted_counts",
    f"""WITH {checking.FAILED_SQL}, p AS (SELECT o_orderkey, {QUARTER_SQL} AS period FROM orders)
    SELECT 'data' AS "table", count(*) AS removed FROM p WHERE period = '{PERIOD}'
    UNION ALL SELECT 'quality', count(*) FROM failed JOIN p ON o_orderkey = "row" WHERE period = '{PERIOD}'
    UNION ALL SELECT 'ledger', count(DISTINCT period) FROM p WHERE period = '{PERIOD}'""",
)
def deleted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one delivery in the data, quality and ledger tables."""
    return ledger.removed_counts(delivery_tables(spark, sf_dir), PERIOD)


def delivery_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    data = inputs.orders_by_period(spark, sf_dir)
    orders = inputs.orders_by_period(spark, sf_dir).select("*", F.col("o_orderkey").alias("row"))
    delivery = inputs.cleaned(inputs.raw_cells(orders))
    failed = checks.failures(delivery, CONTRACT, carry=("period",))
    return {"data": data, "quality": failed, "ledger": scans.ledger(spark, sf_dir)}


@query(
    "list_deliveries",
    f"""WITH {checking.FAILED_SQL}, p AS (SELECT o_orderkey, {QUARTER_SQL} AS period FROM orders)
    SELECT 'desk' AS supplier, 'orders' AS project, 'data' AS "table", true AS present, count(*) AS records,
      count(DISTINCT period) AS deliveries FROM p
    UNION ALL SELECT 'desk', 'orders', 'quality', true, count(*), count(DISTINCT period) FROM failed JOIN p ON o_orderkey = "row"
    UNION ALL SELECT 'desk', 'orders', 'ledger', true, count(DISTINCT period), count(DISTINCT period) FROM p
    UNION ALL SELECT 'desk', 'orders', 'meta', false, 0, 0""",
)
def list_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables: dict = {("desk", "orders", name): t for name, t in delivery_tables(spark, sf_dir).items()}
    return ledger.list_deliveries({**tables, ("desk", "orders", "meta"): None})


@query(
    "post_load_sql",
    """SELECT 'tallyport_orders' AS table_name, count(*) AS rows FROM orders
    UNION ALL SELECT 'tallyport_lineitem', count(*) FROM lineitem""",
)
def post_load_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two statements applied to all tables of a project: one defines a view, one reads it."""
    names = []
    for name in ("orders", "lineitem"):
        names.append(f"tallyport_{name}")
        table(spark, sf_dir, name).createOrReplaceTempView(names[-1])
    statements = {
        "view": "CREATE OR REPLACE TEMPORARY VIEW {table}_loaded AS SELECT * FROM {table}",
        "rows": "SELECT '{table}' AS table_name, count(*) AS rows FROM {table}_loaded",
    }
    results = ledger.run_templates(spark, statements, ["*"], names)
    first, second = (results[name, "rows"] for name in names)
    return first.unionByName(second)


# --- periods ---------------------------------------------------------------------

KINDS = {"1-URGENT": "Q", "2-HIGH": "M", "3-MEDIUM": "D", "4-NOT SPECIFIED": "H", "5-LOW": "J"}


@query(
    "period_add",
    """WITH p AS (SELECT o_orderkey, CAST(o_custkey AS INTEGER) - 700 AS steps, year(o_orderdate) AS y,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Q' WHEN '2-HIGH' THEN 'M' WHEN '3-MEDIUM' THEN 'D' WHEN '4-NOT SPECIFIED' THEN 'H' ELSE 'J' END AS k,
      CASE o_orderpriority WHEN '1-URGENT' THEN 4 WHEN '2-HIGH' THEN 12 WHEN '3-MEDIUM' THEN 366 WHEN '4-NOT SPECIFIED' THEN 2 ELSE 1 END AS m,
      CASE o_orderpriority WHEN '1-URGENT' THEN quarter(o_orderdate) WHEN '2-HIGH' THEN month(o_orderdate)
        WHEN '3-MEDIUM' THEN dayofyear(o_orderdate) WHEN '4-NOT SPECIFIED' THEN CAST(ceil(month(o_orderdate) / 6.0) AS INTEGER) ELSE 1 END AS n
      FROM orders), t AS (SELECT *, y * m + n - 1 + steps AS total FROM p)
    SELECT o_orderkey, y || '-' || k || CASE k WHEN 'J' THEN '' ELSE CAST(n AS VARCHAR) END AS period, steps,
      CASE WHEN total // m BETWEEN 1000 AND 9999
        THEN (total // m) || '-' || k || CASE k WHEN 'J' THEN '' ELSE CAST(total % m + 1 AS VARCHAR) END ELSE '-' END AS shifted FROM t""",
)
def period_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods of five kinds moved by many steps in both directions."""
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    period = F.lit(None).cast("string")
    for name, letter in KINDS.items():
        period = F.when(priority == name, periods.of_date(day, letter)).otherwise(period)
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", period.alias("period"), (F.col("o_custkey").cast("int") - 700).alias("steps")
    )
    shifted = F.coalesce(periods.add(F.col("period"), F.col("steps")), F.lit("-"))
    return rows.withColumn("shifted", shifted)


@query(
    "period_calendar",
    """WITH y AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders), k(k, m) AS (VALUES ('H', 2), ('Q', 4), ('M', 12), ('W', 53), ('D', 366), ('J', 1))
    SELECT y AS "year", y || '-' || k || CASE WHEN n < 10 THEN '0' ELSE '' END || n AS period
    FROM (SELECT y, k, unnest(generate_series(1, m)) AS n FROM y, k)""",
)
def period_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All periods of each year that has orders."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").cast("long").alias("year")).distinct()
    kinds = [periods.calendar(F.col("year"), letter) for letter in (*periods.PERIODS_PER_YEAR, "J")]
    return years.select("year", F.explode(F.concat(*kinds)).alias("period"))


@query(
    "change_window",
    """WITH n AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) + CAST(o_custkey AS INTEGER) AS e FROM orders)
    SELECT o_orderkey, 'mutation_' || strftime(d, '%Y%m%d') || '-' || strftime(e, '%Y%m%d') AS name,
      strftime(date_trunc('month', e), '%Y-%m-%d') AS valid_from,
      strftime(date_trunc('month', e) - INTERVAL 1 DAY, '%Y-%m-%d') AS valid_to,
      strftime(date_trunc('quarter', d), '%Y-%m-%d') AS period_from,
      strftime(date_trunc('quarter', d) - INTERVAL 1 DAY, '%Y-%m-%d') AS period_to FROM n""",
)
def change_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of change files from their names, and from the quarter of their order."""
    day = F.col("o_orderdate").cast("date")
    text = lambda d: F.date_format(d, "yyyyMMdd")
    last = F.date_add(day, F.col("o_custkey").cast("int"))
    name = F.concat(F.lit("mutation_"), text(day), F.lit("-"), text(last))
    start, end = periods.change_window(name)
    first, before = periods.period_window(periods.of_date(day, "Q"))
    return shown(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", name.alias("name"), start.alias("valid_from"), end.alias("valid_to"),
            first.alias("period_from"), before.alias("period_to"),
        )
    )


@query(
    "parse_delivery_range",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '20130101' ELSE strftime(o_orderdate, '%Y%m%d') END AS "from",
      CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y%m%d') ELSE strftime(CAST(o_orderdate AS DATE) + CAST(o_custkey AS INTEGER), '%Y%m%d') END AS "to"
    FROM orders""",
)
def parse_delivery_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    text = lambda d: F.date_format(d, "yyyyMMdd")
    mutation = F.concat(
        F.lit("mut_"), text(day), F.lit("-"), text(F.date_add(day, F.col("o_custkey").cast("int"))), F.lit(".csv")
    )
    full = F.concat(F.lit("full_"), text(day))
    name = F.when(F.col("o_orderstatus") == "F", full).otherwise(mutation)
    start, end = files.delivery_range(name)
    return table(spark, sf_dir, "orders").select("o_orderkey", start.alias("from"), end.alias("to"))


@query(
    "load_delivery",
    f"""WITH {checking.FAILED_SQL}, e AS (SELECT "row", count(*) AS errors FROM failed GROUP BY 1)
    SELECT c."row" + 1 AS record_no, 'ORDERDESK' AS source_code, '2024-Q1' AS period, '1970-01-01' AS valid_from,
      '9999-12-31' AS valid_to, TRY_CAST(order_id AS BIGINT) AS order_id, status,
      TRY_CAST(CASE WHEN regexp_matches(total, '^-?[0-9.]+$') THEN total END AS DOUBLE) AS total,
      coalesce(errors, 0) AS errors, (SELECT count(*) FROM orders) AS ledger_records
    FROM clean c LEFT JOIN e ON e."row" = c."row" """,
)
def load_whole_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery from file to table: stored rows, with the errors the quality table has on each."""
    loaded = load_delivery(
        spark,
        scans.delivered(spark, sf_dir, header=True),
        CONTRACT,
        inputs.RULES,
        period="2024-Q1",
        delivered_on="2024-04-01",
        root=scratch(spark, "tables"),
    )
    # rows are numbered from 0 in the quality table, and from 1 in the first delivery
    number = (F.col("row_number") + 1).alias("record_no")
    errors = loaded.quality.groupBy(number).agg(F.count("*").alias("errors"))
    records = loaded.ledger.select("records").scalar()
    data = loaded.data.select("record_no", "source_code", "period", "valid_from", "valid_to", "order_id", "status", "total")
    return shown(data.join(errors, "record_no", "left").withColumns(
        {"errors": F.coalesce("errors", F.lit(0)), "ledger_records": records}
    ))


def note_reason(period: str, code: str) -> str:
    text = "delivery is not processed: " + str({"supplier": "", "period": period, "source_code": code})
    return "'" + text.replace("'", "''") + "'"


PIPELINE_SQL = f"""WITH {checking.FAILED_SQL}, n AS (SELECT (SELECT count(*) FROM orders) AS records, (SELECT count(*) FROM failed) AS errors)
    SELECT CAST(place AS INTEGER) AS place, period, verdict, reason, CASE WHEN verdict = 'refused' THEN 0 ELSE records END AS records,
      CASE WHEN verdict = 'refused' OR place = 0 THEN 0 ELSE errors END AS errors,
      CASE WHEN verdict = 'refused' OR place = 0 THEN 0 ELSE records END AS repeated_keys
    FROM n, (VALUES (0, '2023-I', 'loaded', NULL), (1, '2024-Q1', 'loaded', NULL), (2, '2024-Q1', 'skipped', NULL),
      (3, '2024-M4', 'refused', {note_reason("2024-M4", inputs.SOURCE_CODE)}),
      (4, '2024-Q1', 'refused', 'headers not found in contract: [''unknown'']'),
      (5, '2024-Q2', 'refused', 'PATH_NOT_FOUND'), (6, '2024-Q2', 'loaded', NULL),
      (7, '2024-Q3', 'refused', {note_reason("2024-Q3", "OTHER")}),
      (8, '2024-Q1', 'skipped', NULL)) AS v(place, period, verdict, reason)"""


def order_rows(spark: SparkSession, sf_dir: str) -> str:
    """The orders as a stored table with the contract's names."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"), F.col("o_orderdate").alias("order_date"), F.col("o_orderpriority").alias("priority"),
    )
    path = scratch(spark, "orders")
    orders.write.parquet(path)
    return path


@query("delivery_pipeline", PIPELINE_SQL)
def delivery_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine deliveries in a row: from a table, from files of two kinds with keys the table knows, some again, and four that are refused.

    The forced reload under a wrong header leaves the delivery it was to replace, so the last note is skipped.
    """
    code = inputs.SOURCE_CODE
    comma, wrong = scratch(spark, "commas"), scratch(spark, "wrong")
    raw = inputs.raw_orders(spark, sf_dir).select(*inputs.NAMES)
    delimited.write_delimited(raw, comma, sep=",", header=False)
    delimited.write_delimited(raw.withColumnRenamed("status", "Unknown"), wrong)
    file = scans.delivered(spark, sf_dir, header=True)
    notes = [
        Delivery(order_rows(spark, sf_dir), "2023-I", code, first=True, table=True, options={"name": "orders"}),
        Delivery(file, "2024-Q1", code, "2024-04-01"),
        Delivery(file, "2024-Q1", code, "2024-04-02"),
        Delivery(file, "2024-M4", code, "2024-05-01"),
        Delivery(wrong, "2024-Q1", code, "2024-05-02", options={"force": True}),
        Delivery(f"{comma}-missing", "2024-Q2", code, "2024-07-01"),
        Delivery(comma, "2024-Q2", code, "2024-07-01", options={"sep": ",", "header": False}),
        Delivery(file, "2024-Q3", "OTHER", "2024-10-01"),
        Delivery(file, "2024-Q1", code, "2024-10-02"),
    ]
    return run_deliveries(spark, notes, CONTRACT, inputs.RULES, scratch(spark, "tables"))


@query(
    "remove_loaded_delivery",
    f"""WITH {checking.FAILED_SQL}, n AS (SELECT (SELECT count(*) FROM orders) AS records, (SELECT count(*) FROM failed) AS errors)
    SELECT 'ledger' AS "table", 1 AS removed, 1 AS kept UNION ALL SELECT 'data', records, records FROM n
    UNION ALL SELECT 'quality', errors, 3 FROM n""",
)
def remove_loaded_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a removal takes from the tables of two loaded deliveries, and what is left of the other one."""
    root = scratch(spark, "tables")
    load_seed(spark, order_rows(spark, sf_dir), CONTRACT, "2023-I", root, "orders")
    load_delivery(spark, scans.delivered(spark, sf_dir, header=True), CONTRACT, inputs.RULES, "2024-Q1", "2024-04-01", root)
    removed = load_module.remove_delivery(spark, root, CONTRACT, "2024-Q1")
    kept = [(name, rows.count()) for name, rows in load_module.stored_tables(spark, root, CONTRACT).items()]
    return removed.join(spark.createDataFrame(kept, "table string, kept long"), "table")
