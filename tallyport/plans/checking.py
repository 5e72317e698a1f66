"""Cell checks of a delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyport.functions import periods
from tallyport.functions.datatypes import BASE_PATTERNS
from tallyport.operators import checks, ledger
from tallyport.plans import inputs
from tallyport.plans.inputs import CLEAN_SQL, CONTRACT, NAMES, table
from tallyport.plans.registry import query


def failed_cells(*wanted):
    """Failures of some checks over the cleaned delivery, in report columns."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        delivery = inputs.clean_orders(spark, sf_dir)
        return checks.failures(delivery, CONTRACT, wanted or checks.ALL_CHECKS)

    return run


def only(check, kind: str):
    """A domain check for the columns whose domain is of a kind."""
    return lambda column: check(column) if checks.grammar(column.domain) == kind else []


NOT_NULL_SQL = " UNION ALL ".join(
    f"""SELECT "row", CAST(0 AS INTEGER) AS phase, CAST({NAMES.index(c)} AS INTEGER) AS "column", '{c}' AS column_name,
    CAST(2 AS INTEGER) AS error_code, 'NULL detected where not allowed' AS message, CAST(0 AS INTEGER) AS element
    FROM clean WHERE trim({c}) = ''"""
    for c in ("order_id", "status")
)
TYPE_SQL = " UNION ALL ".join(
    f"""SELECT "row", CAST(1 AS INTEGER) AS phase, CAST({NAMES.index(c)} AS INTEGER) AS "column", '{c}' AS column_name,
    CAST(6 AS INTEGER) AS error_code, 'Datatype not {t}, value found is "' || {c} || '"' AS message,
    CAST(0 AS INTEGER) AS element FROM clean WHERE NOT regexp_matches({c}, '^(?:{BASE_PATTERNS[b]})')"""
    for c, t, b in (
        ("order_id", "bigint", "integer"), ("customer_id", "integer", "integer"),
        ("total", "numeric", "real"), ("order_date", "date", "date"),
    )
)
LIST_SQL = """SELECT "row", CAST(2 AS INTEGER) AS phase, CAST(2 AS INTEGER) AS "column", 'status' AS column_name,
    CAST(1 AS INTEGER) AS error_code, 'Value not in domain list: "' || part || '"' AS message,
    CAST(place - 1 AS INTEGER) AS element
    FROM (SELECT "row", trim(unnest(string_split(status, ','))) AS part,
      generate_subscripts(string_split(status, ','), 1) AS place FROM clean)
    WHERE part NOT IN ('O', 'F', 'P')"""
RANGE_SQL = """SELECT "row", CAST(2 AS INTEGER) AS phase, CAST(1 AS INTEGER) AS "column", 'customer_id' AS column_name,
    CAST(3 AS INTEGER) AS error_code,
    'Value ' || coalesce(CAST(TRY_CAST(customer_id AS BIGINT) AS VARCHAR), customer_id) || ' exceeds min 0 or max 999999999' AS message,
    CAST(0 AS INTEGER) AS element FROM clean
    WHERE customer_id <> '' AND coalesce(NOT TRY_CAST(customer_id AS BIGINT) BETWEEN 0 AND 999999999, true)
  UNION ALL
  SELECT "row", 2, 3, 'total', 3,
    'Value ' || coalesce(CAST(TRY_CAST(total AS DOUBLE) AS VARCHAR), total) || ' exceeds min 1000 or max 400000', 0
    FROM clean WHERE total <> '' AND coalesce(NOT TRY_CAST(total AS DOUBLE) BETWEEN 1000 AND 400000, true)"""
REGEX_SQL = """SELECT "row", CAST(2 AS INTEGER) AS phase, CAST(5 AS INTEGER) AS "column", 'priority' AS column_name,
    CAST(8 AS INTEGER) AS error_code, 'Value "' || priority || '" does not match [1-4]-[A-Z ]+$' AS message,
    CAST(0 AS INTEGER) AS element FROM clean
    WHERE priority <> '' AND NOT regexp_matches(priority, '^(?:[1-4]-[A-Z ]+$)')"""
DOMAIN_SQL = f"{LIST_SQL} UNION ALL {RANGE_SQL} UNION ALL {REGEX_SQL}"
FAILED_SQL = f"{CLEAN_SQL}, failed AS ({NOT_NULL_SQL} UNION ALL {TYPE_SQL} UNION ALL {DOMAIN_SQL})"

query("check_not_null", f"WITH {CLEAN_SQL} {NOT_NULL_SQL}")(failed_cells(checks.not_null_check))
query("check_type", f"WITH {CLEAN_SQL} {TYPE_SQL}")(failed_cells(checks.type_check))
query("check_list", f"WITH {CLEAN_SQL} {LIST_SQL}")(failed_cells(only(checks.list_check, "list")))
query("check_range", f"WITH {CLEAN_SQL} {RANGE_SQL}")(failed_cells(only(checks.range_check, "range")))
query("check_regex", f"WITH {CLEAN_SQL} {REGEX_SQL}")(failed_cells(only(checks.regex_check, "regex")))
query("check_domain", f"WITH {CLEAN_SQL} {DOMAIN_SQL}")(failed_cells(checks.domain_check))


@query(
    "check_range_split",
    f"""WITH {CLEAN_SQL}, v AS (SELECT "row", TRY_CAST(total AS DOUBLE) AS value FROM clean)
    SELECT "row", CAST(2 AS INTEGER) AS phase, CAST(3 AS INTEGER) AS "column", 'total' AS column_name,
      CAST(3 AS INTEGER) AS error_code, 'Value ' || CAST(value AS VARCHAR)
        || CASE WHEN value < 1000 THEN ' exceeds min 1000.0' ELSE ' exceeds max 400000.0' END AS message,
      CAST(0 AS INTEGER) AS element FROM v WHERE value < 1000 OR value > 400000""",
)
def check_range_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    real = lambda column: checks.range_split_check(column) if column.base == "real" else []
    return failed_cells(real)(spark, sf_dir)


REPORT_COLUMNS = """"row", "column", column_name, error_code, message"""


@query(
    "check_all",
    f"""WITH {FAILED_SQL}
    SELECT {REPORT_COLUMNS} FROM failed
    UNION ALL SELECT 0, 0, '', -1, count(*) || ' errors found' FROM failed""",
)
def check_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks in one pass, without a budget."""
    report, _, _ = checks.check_all(inputs.staged_orders(spark, sf_dir), CONTRACT)
    return report


@query(
    "error_budget",
    f"""WITH {FAILED_SQL}, kept AS (
      SELECT * FROM failed ORDER BY phase, "column", "row", element LIMIT 5000)
    SELECT {REPORT_COLUMNS} FROM kept
    UNION ALL SELECT 0, 0, '', -1, count(*) || ' errors found' FROM kept""",
)
def error_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report stops at its budget of errors, which is the feature."""
    report, _, _ = checks.check_all(inputs.staged_orders(spark, sf_dir), CONTRACT, max_errors=5000)
    return report


ERRORS_SQL = "SELECT column_name, error_code, count(*) AS errors FROM failed GROUP BY 1, 2"


@query("errors_by_column", f"WITH {FAILED_SQL} {ERRORS_SQL}")
def errors_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.errors_by_column(failed_cells()(spark, sf_dir))


@query(
    "label_errors",
    f"""WITH {FAILED_SQL} SELECT e.*, CASE error_code {" ".join(f"WHEN {c} THEN '{t}'" for c, t in checks.CODES.items())} END AS meaning
    FROM ({ERRORS_SQL}) e""",
)
def label_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.label_errors(errors_by_column(spark, sf_dir))


@query(
    "check_primary_key",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def check_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


PERIOD_TEXT_SQL = f"""CASE o_orderpriority WHEN '1-URGENT' THEN {inputs.QUARTER_SQL} WHEN '2-HIGH' THEN year(o_orderdate) || '-J'
    WHEN '3-MEDIUM' THEN year(o_orderdate) || 'M' || month(o_orderdate) WHEN '4-NOT SPECIFIED' THEN year(o_orderdate) || '-X1'
    ELSE year(o_orderdate) || '-|' || o_orderstatus END"""


@query(
    "check_period_format",
    f"""SELECT *, regexp_matches(period, '^(?:[0-9]{{4}}-[H|Q|M|W|D][0-9])') OR regexp_matches(period, '^(?:[0-9]{{4}}-[J|A|I])')
      AS well_formed FROM (SELECT o_orderkey, {PERIOD_TEXT_SQL} AS period FROM orders)""",
)
def check_period_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    year = F.year(day)
    written = (
        F.when(priority == "1-URGENT", periods.of_date(day, "Q"))
        .when(priority == "2-HIGH", periods.of_date(day, "J"))
        .when(priority == "3-MEDIUM", F.concat_ws("", year, F.lit("M"), F.month(day)))
        .when(priority == "4-NOT SPECIFIED", F.concat_ws("", year, F.lit("-X1")))
        .otherwise(F.concat_ws("", year, F.lit("-|"), "o_orderstatus"))
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", written.alias("period"))
    return rows.withColumn("well_formed", periods.well_formed(F.col("period")))


@query(
    "check_delivery_note",
    f"""WITH notes AS (SELECT o_orderstatus AS supplier, CASE WHEN o_orderpriority = '5-LOW' THEN year(o_orderdate) || '-I'
        ELSE {inputs.QUARTER_SQL} END AS period, CASE WHEN o_orderpriority = '2-HIGH' THEN 'OTHER' ELSE 'DESK-' || o_orderstatus END
        AS source_code, o_orderstatus = 'F' AS first, count(*) AS records FROM orders GROUP BY 1, 2, 3, 4)
    SELECT supplier, period, source_code, first, records,
      regexp_matches(period, '^[0-9]{{4}}-([HQMWD][0-9]|[JAI])') AS period_ok,
      coalesce(supplier <> 'P' AND (substr(period, 6, 1) = CASE supplier WHEN 'O' THEN 'M' ELSE 'Q' END
        OR (first AND substr(period, 6, 1) = 'I')), false) AS letter_ok,
      supplier <> 'P' AND source_code = 'DESK-' || supplier AS code_ok FROM notes""",
)
def check_delivery_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes of three suppliers: one declared quarterly, one monthly, one not at all."""
    low, high = F.col("o_orderpriority") == "5-LOW", F.col("o_orderpriority") == "2-HIGH"
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    notes = table(spark, sf_dir, "orders").groupBy(
        status.alias("supplier"),
        F.when(low, F.concat_ws("", F.year(day), F.lit("-I"))).otherwise(periods.of_date(day, "Q")).alias("period"),
        F.when(high, F.lit("OTHER")).otherwise(F.concat(F.lit("DESK-"), status)).alias("source_code"),
        (status == "F").alias("first"),
    ).agg(F.count("*").alias("records"))
    declared = spark.createDataFrame(
        [("F", "Q", "DESK-F"), ("O", "M", "DESK-O")], "supplier string, frequency string, source_code string"
    )
    return ledger.note_verdicts(notes, declared)
