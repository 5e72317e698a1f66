"""Scans, sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tallyport.functions import periods
from tallyport.operators import checks, cleaning, history, loading
from tallyport.plans import inputs
from tallyport.plans.inputs import (
    CHANGES_SQL, CLEAN_SQL, CONTRACT, HISTORY_SQL, NAMES, QUARTER_SQL, RAW_SQL, RULES, cells_sql, shown, table,
)
from tallyport.plans.registry import query
from tallyport.session import scratch
from tallyport.sources import delimited, files, staging, tables

RAW_ROWS = f"WITH {RAW_SQL} SELECT {', '.join(NAMES)} FROM raw"
# Headings as a supplier writes them.
HEADINGS = ["Order ID", "Customer-ID", " Status ", "TOTAL", "Order  Date", "Priority"]


def delivered(spark: SparkSession, sf_dir: str, header: bool) -> str:
    """The raw delivery as delimited files in the shared folder."""
    path = scratch(spark, "delivery")
    rows = inputs.raw_orders(spark, sf_dir).select(*NAMES).toDF(*HEADINGS)
    delimited.write_delimited(rows, path, header=header)
    return path


@query("scan_delimited", RAW_ROWS)
def scan_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.read_delivery(spark, delivered(spark, sf_dir, True), CONTRACT)


@query("scan_headerless", RAW_ROWS)
def scan_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delimited.read_delivery(spark, delivered(spark, sf_dir, False), CONTRACT, header=False)


@query("scan_header_sidecar", RAW_ROWS)
def scan_header_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    sidecar = scratch(spark, "header")
    lines = [f"* line {i}" for i in range(5)] + ["POSITION;FIELDNAME;TYPE"]
    lines += [f"{i};{name};CHAR" for i, name in enumerate(HEADINGS)]
    spark.createDataFrame([("\n".join(lines),)], "value string").write.text(sidecar)
    path = delivered(spark, sf_dir, False)
    return delimited.read_delivery(spark, path, CONTRACT, header=False, header_file=sidecar)


NOTE_SQL = """o_orderpriority || chr(13) || chr(10) || 'said "' || o_orderstatus || '";' ||
    CASE o_orderstatus WHEN 'F' THEN chr(10) || chr(10) WHEN 'O' THEN '"' ELSE '' END"""


@query("scan_multiline", f"SELECT CAST(o_orderkey AS VARCHAR) AS order_id, {NOTE_SQL} AS priority, o_orderstatus AS status FROM orders")
def scan_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with line breaks, quotes and separators, from files that are split."""
    orders = inputs.table(spark, sf_dir, "orders")
    end = F.when(F.col("o_orderstatus") == "F", "\n\n").when(F.col("o_orderstatus") == "O", '"').otherwise("")
    note = F.concat("o_orderpriority", F.lit('\r\nsaid "'), "o_orderstatus", F.lit('";'), end)
    rows = orders.select(F.col("o_orderkey").alias("Order ID"), note.alias("Priority"), F.col("o_orderstatus").alias(" Status "))
    path = scratch(spark, "delivery")
    delimited.write_delimited(rows, path)
    return delimited.read_delivery(spark, path, CONTRACT, multiline=True)


@query("scan_object_store", RAW_ROWS)
def scan_object_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery named by URL; `s3a://` needs no other code than this `file:` URL."""
    path = delivered(spark, sf_dir, True)
    return delimited.read_delivery(spark, path if ":/" in path else f"file://{path}", CONTRACT)


@query("scan_sample", "SELECT least(count(*), 1000) AS sampled, count(*) AS all_rows FROM orders")
def scan_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = delivered(spark, sf_dir, True)
    sampled = delimited.read_delivery(spark, path, CONTRACT, max_rows=1000)
    everything = delimited.read_delivery(spark, path, CONTRACT, max_rows=0)
    return sampled.agg(F.count("*").alias("sampled")).withColumn(
        "all_rows", everything.select(F.count("*")).scalar()
    )


DATA_NAME, HEADER_NAME = r"\d{8}_[a-z]+_[a-z]+$", r"\d{8}_[a-z]+_hdr_[a-z_]+$"
PROJECT_SQL = r"lower(regexp_replace(o_orderpriority, '[^A-Z]+', '', 'g'))"


def landed_objects(spark: SparkSession, sf_dir: str) -> str:
    """Orders as delivered objects below period folders.

    Each year and priority is a data object, dated by the last order; each has a header
    object too, except URGENT, and there are objects of no known kind for LOW.
    """
    orders = table(spark, sf_dir, "orders").select(
        periods.of_date(F.col("o_orderdate"), "J").alias("period"), "o_orderdate", "o_orderpriority"
    )
    project = F.lower(F.regexp_replace("o_orderpriority", "[^A-Z]+", ""))
    date = F.date_format(F.max("o_orderdate"), "yyyyMMdd")
    objects = orders.groupBy("period", project.alias("project")).agg(
        date.alias("date"), F.count("*").alias("orders")
    )
    named = F.array_compact(
        F.array(
            F.concat_ws("_", "date", F.lit("desk"), "project"),
            F.when(F.col("project") != "urgent", F.concat_ws("_", "date", F.lit("desk"), F.lit("hdr"), "project")),
            F.when(F.col("project") == "low", F.concat_ws("_", F.lit("readme"), "project")),
        )
    )
    path = scratch(spark, "landing")
    objects.select("period", F.explode(named).alias("object"), "orders").write.partitionBy("period", "object").csv(path)
    return path


OBJECTS_SQL = f"""objects AS (
  SELECT year(o_orderdate) || '-J' AS period, {PROJECT_SQL} AS project, strftime(max(o_orderdate), '%Y%m%d') AS date
  FROM orders GROUP BY 1, 2)"""


@query(
    "discover_deliveries",
    f"""WITH {OBJECTS_SQL}
    SELECT period, date || '_desk_' || project AS name, 'data' AS kind, date AS delivered_on, 'DESK' AS source_code,
      project FROM objects
    UNION ALL
    SELECT period, date || '_desk_hdr_' || project, 'header', date, 'DESK', project FROM objects
    WHERE project <> 'urgent'""",
)
def discover_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.discover(spark, landed_objects(spark, sf_dir), DATA_NAME, HEADER_NAME)


@query(
    "scan_table",
    """SELECT o_orderpriority, count(*) AS orders, max(o_orderkey) AS last_order FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 100000 GROUP BY 1 LIMIT 10""",
)
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.select_from(
        table(spark, sf_dir, "orders"),
        where="o_orderstatus = 'F' and o_totalprice > 100000",
        group_by=["o_orderpriority"],
        aggregates=[F.count("*").alias("orders"), F.max("o_orderkey").alias("last_order")],
        limit=10,
    )


@query(
    "scan_query",
    """SELECT c_mktsegment, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'O' GROUP BY 1""",
)
def scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.run_query(
        spark,
        """SELECT c_mktsegment, count(*) AS orders FROM {orders} JOIN {customer} ON o_custkey = c_custkey
        WHERE o_orderstatus = :status GROUP BY c_mktsegment""",
        args={"status": "O"},
        orders=table(spark, sf_dir, "orders"),
        customer=table(spark, sf_dir, "customer"),
    )


@query("scan_full_table", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def scan_full_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table(spark, sf_dir, "customer").createOrReplaceTempView("tallyport_customer")
    return tables.full_table(spark, "tallyport_customer", ["c_custkey", "c_name", "c_mktsegment"])


@query(
    "seed_from_table",
    """SELECT row_number() OVER (ORDER BY c_custkey) AS record_no, 'CRM' AS source_code, '2024-I' AS period,
    '1970-01-01' AS valid_from, '9999-12-31' AS valid_to, c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""",
)
def seed_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    rows = staging.traced_parquet(spark, f"{sf_dir}/customer.parquet").select(*columns, *staging.TRACE)
    seeded = loading.stamp_delivery(staging.number_rows(rows), "CRM", "2024-I")
    return shown(seeded.select("record_no", "source_code", "period", "valid_from", "valid_to", *columns))


CHANGE_COLUMNS = ["action", "cust_id", "name", "balance"]
CHANGE_ROWS = """SELECT action, CAST(cust_id AS VARCHAR) AS cust_id, name, CAST(balance AS VARCHAR) AS balance"""


def landed_changes(spark: SparkSession, sf_dir: str) -> str:
    """Change files as comma separated text without header, in the order of their rows."""
    path = scratch(spark, "changes")
    changes = inputs.customer_changes(spark, sf_dir)
    ordered = changes.repartitionByRange("change", "pos").sortWithinPartitions("change", "pos")
    columns = [F.col(c).cast("string").alias(c) for c in CHANGE_COLUMNS]
    ordered.select(*columns, "change").write.partitionBy("change").csv(path)
    return path


@query("scan_change_file", f"WITH {CHANGES_SQL} {CHANGE_ROWS} FROM changes")
def scan_change_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed_changes(spark, sf_dir)
    return delimited.text_frame(spark, f"{path}/*", CHANGE_COLUMNS, sep=",", header=False)


@query(
    "order_change_files",
    f"""WITH {CHANGES_SQL}, f AS (SELECT change, count(*) AS changes, min(pos) AS first_pos, max(pos) AS last_pos
    FROM changes GROUP BY 1)
    SELECT change AS file_name, row_number() OVER (ORDER BY change) AS turn, changes,
      'Changed by ' || first_pos AS first_row, 'Changed by ' || last_pos AS last_row FROM f""",
)
def order_change_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All change files in one scan: their turn, and the first and last row of each."""
    root = landed_changes(spark, sf_dir)
    rows = files.ordered_changes(spark, root, "change=mutation", CHANGE_COLUMNS)
    place = F.struct(*staging.TRACE)
    name = F.regexp_replace("file_name", "^change=", "")
    per_file = rows.groupBy(name.alias("file_name")).agg(
        F.count("*").alias("changes"),
        F.min_by("name", place).alias("first_row"),
        F.max_by("name", place).alias("last_row"),
    )
    # one row per file
    turn = F.row_number().over(Window.orderBy("file_name")).cast("long")
    return per_file.select("file_name", turn.alias("turn"), "changes", "first_row", "last_row")


@query("stage_delivery", cells_sql(CLEAN_SQL, "clean"))
def stage_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered text, cleaned, staged, and numbered by its place in the files."""
    path = delivered(spark, sf_dir, True)
    raw = delimited.read_delivery(spark, path, CONTRACT, traced=True)
    staged = staging.stage(cleaning.clean(raw, CONTRACT, RULES))
    return inputs.text_cells(staging.number_rows(staged, "row", start=0))


TYPED_SQL = f"""WITH {CLEAN_SQL}
SELECT "row", TRY_CAST(order_id AS BIGINT) AS order_id, CAST(TRY_CAST(customer_id AS INTEGER) AS VARCHAR) AS customer_id,
  status, TRY_CAST(CASE WHEN regexp_matches(total, '^-?[0-9.]+$') THEN total END AS DOUBLE) AS total,
  CAST(CAST(coalesce(CASE WHEN regexp_matches(order_date, '^[0-9]{{4}}-') THEN TRY_STRPTIME(order_date, '%Y-%m-%d') END,
    CASE WHEN regexp_matches(order_date, '^[0-9]{{8}}$') THEN TRY_STRPTIME(order_date, '%Y%m%d') END) AS DATE)
    AS VARCHAR) AS order_date, priority FROM clean"""


@query("load_typed", TYPED_SQL)
def load_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "typed")
    typed = loading.load_typed(inputs.clean_orders(spark, sf_dir), CONTRACT)
    tables.append(typed.withColumn("period", F.lit("2024-Q1")), path, "period")
    stored = spark.read.schema(typed.schema).parquet(path).drop("period")
    # as text, so that empty cells keep the type of the column in any comparison
    return shown(stored).withColumn("customer_id", F.col("customer_id").cast("string"))


@query(
    "sink_quality",
    f"""WITH {CLEAN_SQL}
    SELECT "row" AS record_no, 'ORDERDESK' AS source_code, "row" AS row_number, 'status' AS column_name,
      '2' AS attribute_code, CAST(2 AS INTEGER) AS quality_code, '2024-Q1' AS period
    FROM clean WHERE trim(status) = ''""",
)
def sink_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = checks.failures(inputs.clean_orders(spark, sf_dir), CONTRACT, (checks.not_null_check,))
    rows = loading.quality_rows(failed, inputs.SOURCE_CODE, "2024-Q1")
    path = scratch(spark, "quality")
    tables.append(rows, path, "period")
    return spark.read.schema(rows.schema).parquet(path).drop("loaded_at")


@query(
    "sink_ledger",
    f"""WITH p AS (SELECT {QUARTER_SQL} AS period, count(*) AS records, max(o_orderdate) AS last_day FROM orders GROUP BY 1)
    SELECT CAST(row_number() OVER (ORDER BY period) AS INTEGER) AS sequence, period, 'ORDERDESK' AS source_code,
      'current_user' AS created_by, strftime(last_day, '%Y-%m-%d') AS delivered_on, true AS accepted,
      'Not applicable' AS reason, records, '' AS config_text, 'orders_' || period || '.csv' AS data_file,
      true AS processed_today FROM p""",
)
def sink_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "ledger")
    tables.append(ledger(spark, sf_dir), path)
    # a run may last over midnight
    today = F.datediff(F.current_date(), F.col("processed_on")).isin(0, 1)
    return shown(spark.read.parquet(path).withColumn("processed_today", today)).drop("processed_on", "loaded_at")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of the quarters of the orders, in order of period."""
    per_period = inputs.orders_by_period(spark, sf_dir).groupBy("period").agg(
        F.count("*").alias("records"), F.max("o_orderdate").cast("date").alias("last_day")
    )
    return loading.ledger_row(
        per_period,
        F.col("period"),
        inputs.SOURCE_CODE,
        F.col("last_day"),
        F.concat(F.lit("orders_"), F.col("period"), F.lit(".csv")),
        # one row per delivery
        sequence=F.row_number().over(Window.orderBy("period")),
    )


@query(
    "sink_report_csv",
    f"""WITH {CLEAN_SQL}
    SELECT CAST("row" AS VARCHAR) AS "row", '4' AS "column", 'order_date' AS column_name, '6' AS error_code,
      'Datatype not date, value found is "' || order_date || '"' AS message
    FROM clean WHERE NOT regexp_matches(order_date, '^(?:(^[0-9]{{4}}-[0-1][0-9]-[0-3][0-9])$|^([0-9]{{4}}[0-1][0-9][0-3][0-9])$|^$)')""",
)
def sink_report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of a column written as `;` separated text, and what a reader gets back."""
    delivery = inputs.clean_orders(spark, sf_dir).select("row", "order_date")
    failed = checks.failures(delivery, CONTRACT, (checks.type_check,))
    place = F.lit(NAMES.index("order_date")).alias("column")
    path = scratch(spark, "report")
    delimited.write_delimited(failed.select("row", place, *checks.REPORT[2:]), path, quote_all=False)
    return delimited.text_frame(spark, path, checks.REPORT)


@query("sink_replace_table", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal >= 0")
def sink_replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue table overwritten by a second write."""
    name = f"customer_{uuid.uuid4().hex}"
    path = scratch(spark, "table")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    tables.replace_table(rows.where("c_acctbal < 0").drop("c_acctbal"), name, path)
    tables.replace_table(rows.where("c_acctbal >= 0").drop("c_acctbal"), name, path)
    return spark.table(name)


@query(
    "dump_snapshot",
    f"""WITH {HISTORY_SQL} SELECT CAST(cust_id AS VARCHAR) AS cust_id, name, CAST(balance AS VARCHAR) AS balance,
    CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM history
    WHERE valid_from <= DATE '2023-06-15' AND valid_to >= DATE '2023-06-15'""",
)
def dump_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "snapshot")
    valid = history.asof(inputs.customer_history(spark, sf_dir), "2023-06-15")
    delimited.write_delimited(valid, path, quote_all=False)
    return delimited.text_frame(spark, path, inputs.HISTORY_COLUMNS)
