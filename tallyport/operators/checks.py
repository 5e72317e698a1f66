"""Cell checks: one pass over a delivery yields a long report of failed cells.

A failed cell is `(row, column, column_name, error_code, message)` plus its phase
(constraints 0, types 1, domains 2) and, for cells that hold a list, the element.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyport.contract import Contract, ContractColumn, ContractError
from tallyport.functions import datatypes, numbers
from tallyport.functions.text import is_blank, starts_with_match, strip
from tallyport.session import settle

# Quality codes and their meaning.
CODES = {
    0: "Valide waarde",
    1: "Domein - Waarde niet in lijst",
    2: "Constraint - Geen waarde, wel verplicht",
    3: "Domein - Waarde ligt niet tussen minimum en maximum",
    4: "Waarde buiten bereik",
    5: "Waarde niet waarschijnlijk",
    6: "Datatype - Waarde geen juist datatype",
    7: "Waarde geen juist formaat",
    8: "Domein - Waarde voldoet niet aan reguliere expressie",
}
NOT_IN_LIST, MISSING, OUT_OF_RANGE, WRONG_TYPE, WRONG_FORM, NOT_LIKE_PATTERN = 1, 2, 3, 6, 7, 8
SUMMARY, SEEDED, UNCHECKED = -1, -2, -3
# Texts of the rows that stand for a whole delivery.
UNCHECKED_TEXT = "Data check is bewust uitgezet, geen datacontrole toegepast"
SEEDED_TEXT = "Initiele levering uit Table {table}. Geen controles uitgevoerd."

CONSTRAINTS, TYPES, DOMAINS, LOADS = range(4)
REPORT = ["row", "column", "column_name", "error_code", "message"]
ORDER = ["phase", "column", "row", "element"]

# How the offending value is shown in a message.
NO_VALUE, AS_TEXT, AS_WHOLE, AS_REAL, PER_ELEMENT = range(5)


@dataclass(frozen=True)
class Check:
    """One test of one column: the condition of a failure and the parts of its message."""

    phase: int
    column: ContractColumn
    code: int
    bad: Column
    before: str
    after: str = ""
    show: int = AS_TEXT
    allowed: tuple[str, ...] = ()


# The texts of the messages below are those of the reports to be matched.


def not_null_check(column: ContractColumn) -> list[Check]:
    if column.nullable:
        return []
    text = "NULL detected where not allowed"
    bad = is_blank(F.col(column.name))
    return [Check(CONSTRAINTS, column, MISSING, bad, text, show=NO_VALUE)]


def type_check(column: ContractColumn) -> list[Check]:
    if column.base == "text":
        return []
    bad = ~starts_with_match(F.col(column.name), datatypes.BASE_PATTERNS[column.base])
    text = f'Datatype not {column.datatype}, value found is "'
    return [Check(TYPES, column, WRONG_TYPE, bad, text, '"')]


def list_domain(domain: str) -> list[str]:
    """Allowed values of `[a, 'b', "c"]`; a trailing comma allows the empty value."""
    inner = domain.strip()[1:-1]
    return [v.strip().strip('"').strip("'").strip('"') for v in inner.split(",")]


def list_check(column: ContractColumn) -> list[Check]:
    """Suspect cells are those that are not one allowed value; their elements are tested."""
    allowed = tuple(list_domain(column.domain))
    cell = strip(F.col(column.name))
    bad = ~cell.isin(*allowed)
    if column.nullable:
        bad = bad & (cell != "")
    text = 'Value not in domain list: "'
    return [Check(DOMAINS, column, NOT_IN_LIST, bad, text, '"', PER_ELEMENT, allowed)]


def _empty_allowed(column: ContractColumn, bad: Column) -> Column:
    return bad & (F.col(column.name) != "") if column.nullable else bad


def range_bounds(domain: str) -> tuple[str, str]:
    low, high = domain.split(":")
    return low, high


def range_check(column: ContractColumn) -> list[Check]:
    """Value outside the inclusive bounds; text that is no number is outside too."""
    low, high = range_bounds(column.domain)
    if column.base == "integer" and not all(b.strip().lstrip("+-").isdigit() for b in (low, high)):
        raise ContractError(f"range of {column.name} is not of whole numbers: {column.domain}")
    kind = "decimal(38,0)" if column.base == "integer" else "double"
    bounds = F.lit(low.strip()).cast(kind), F.lit(high.strip()).cast(kind)
    inside = F.coalesce(F.col(_parsed(column)).between(*bounds), F.lit(False))
    show = AS_WHOLE if column.base == "integer" else AS_REAL
    after = f" exceeds min {low} or max {high}"
    return [Check(DOMAINS, column, OUT_OF_RANGE, _empty_allowed(column, ~inside), "Value ", after, show)]


def range_split_check(column: ContractColumn) -> list[Check]:
    """Range check with separate messages below the minimum and above the maximum."""
    low, high = (float(b) for b in range_bounds(column.domain))
    value = F.col(_parsed(column))
    return [
        Check(DOMAINS, column, OUT_OF_RANGE, value < low, "Value ", f" exceeds min {low}", AS_REAL),
        Check(DOMAINS, column, OUT_OF_RANGE, value > high, "Value ", f" exceeds max {high}", AS_REAL),
    ]


def regex_check(column: ContractColumn) -> list[Check]:
    pattern = column.domain.strip()[3:].strip()
    bad = _empty_allowed(column, ~starts_with_match(F.col(column.name), pattern))
    return [Check(DOMAINS, column, NOT_LIKE_PATTERN, bad, 'Value "', f'" does not match {pattern}')]


def grammar(domain: str) -> str:
    """Kind of a domain: a list, a pattern, a range, or none that is known."""
    domain = domain.strip()
    if domain.startswith("["):
        return "list"
    if domain.startswith("re:"):
        return "regex"
    return "range" if ":" in domain else ""


DOMAIN_CHECKS = {"list": list_check, "regex": regex_check, "range": range_check}


def domain_check(column: ContractColumn) -> list[Check]:
    check = DOMAIN_CHECKS.get(grammar(column.domain))
    return check(column) if check else []


def load_check(column: ContractColumn) -> list[Check]:
    """Cells of the right datatype that would load as null all the same, such as the 39th of a month."""
    cell = F.col(column.name)
    if column.base == "text":
        return []
    fits = starts_with_match(cell, datatypes.BASE_PATTERNS[column.base])
    bad = ~is_blank(cell) & fits & datatypes.load_cell(cell, column.datatype, column.precision, column.scale).isNull()
    return [Check(LOADS, column, WRONG_FORM, bad, 'Value "', f'" does not load as {column.datatype}')]


ALL_CHECKS = (not_null_check, type_check, domain_check)
# With what a load would lose without a word.
LOAD_CHECKS = (*ALL_CHECKS, load_check)


def _parsed(column: ContractColumn) -> str:
    return f"_value_{column.name}"


def parsed_values(df: DataFrame, contract: Contract) -> DataFrame:
    """Numeric values of the cells with a range domain, parsed once for all uses."""
    values = {}
    for column in contract.columns:
        if column.name in df.columns and grammar(column.domain) == "range":
            parse = numbers.whole_number if column.base == "integer" else numbers.real_number
            values[_parsed(column)] = parse(F.col(column.name))
    return df.withColumns(values)


# Conditions are collected as bits of a long.
MASK_BITS = 62


def _mask(found: list[Check]) -> Column:
    """Bit i is set if the i-th condition holds (an unknown condition does not)."""
    bits = [F.when(c.bad, F.lit(2**i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(found)]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask.bitwiseOR(bit)
    return mask


def _set_bits(masks: list[str], count: int) -> Column:
    """Numbers of the set bits; rows without any make no array."""
    unsound = " OR ".join(f"{mask} <> 0" for mask in masks)
    numbers_ = ", ".join(
        f"IF({masks[i // MASK_BITS]} & {2 ** (i % MASK_BITS)} <> 0, {i}, -1)" for i in range(count)
    )
    return F.expr(f"CASE WHEN {unsound} THEN array_remove(array({numbers_}), -1) END")


def failures(
    df: DataFrame,
    contract: Contract,
    checks=ALL_CHECKS,
    row: str = "row",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Failed cells of the delivery, in one pass and without a shuffle.

    Sound cells only pay for their conditions, whose numbers are collected per row and
    exploded; messages are made afterwards, by number, for failed cells only. `row`
    numbers the rows of the delivery from 0; `carry` columns go along.
    """
    present = [c for c in df.columns if c in contract.names]
    found = [check for name in present for make in checks for check in make(contract[name])]
    if not found:
        found = [Check(CONSTRAINTS, contract[present[0]], 0, F.lit(False), "", show=NO_VALUE)]
    valued = parsed_values(df, contract)
    values = [c for c in valued.columns if c.startswith("_value_")]
    masks = [f"_mask_{i}" for i in range(0, len(found), MASK_BITS)]
    masked = valued.select(
        F.col(row).alias("row"), *carry, *present, *values,
        *[_mask(found[i : i + MASK_BITS]).alias(f"_mask_{i}") for i in range(0, len(found), MASK_BITS)],
    )
    # exploded where it is built: a filter on a named column would be pushed down, and then
    # all conditions be evaluated twice and all cleaning once per use of a cell
    failed = masked.select(
        "row", *carry, *present, *values, F.explode(_set_bits(masks, len(found))).alias("_check")
    )

    def by_check(part) -> Column:
        """What belongs to the failed check, from a constant array."""
        parts = [part(c) for c in found]
        if isinstance(parts[0], int):
            # one expression instead of one per check
            return F.get(F.expr(f"array({', '.join(map(str, parts))})"), F.col("_check"))
        return F.get(F.array(*[F.lit(p) for p in parts]), F.col("_check"))

    place = by_check(lambda c: present.index(c.column.name)).alias("column")
    cell = F.get(F.array(*[F.col(c) for c in present]), place)
    shows = {c.show for c in found}
    shown = F.when(by_check(lambda c: c.show) == NO_VALUE, F.lit(""))
    for kind, text in ((AS_WHOLE, lambda v: v.cast("string")), (AS_REAL, numbers.shown_real)):
        if kind in shows:
            # null except for the columns of this kind
            parts = [F.col(_parsed(c.column)) if c.show == kind else F.lit(None) for c in found]
            type_ = "decimal(38,0)" if kind == AS_WHOLE else "double"
            value = F.get(F.array(*[p.cast(type_) for p in parts]), F.col("_check"))
            shown = shown.when(by_check(lambda c: c.show) == kind, F.coalesce(text(value), cell))
    result = failed.select(
        "row", *carry, "_check",
        by_check(lambda c: c.phase).alias("phase"),
        place,
        shown.otherwise(cell).alias("_shown"),
    )
    element = F.lit(0).alias("element")
    if PER_ELEMENT in shows:
        result = result.select("*", F.inline(_elements(found, by_check)))
        shown, element = F.coalesce("_element_text", "_shown"), F.col("element")
    else:
        shown = F.col("_shown")
    return result.select(
        "row", *carry, "phase", "column",
        by_check(lambda c: c.column.name).alias("column_name"),
        by_check(lambda c: c.code).alias("error_code"),
        F.concat(by_check(lambda c: c.before), shown, by_check(lambda c: c.after)).alias("message"),
        element,
    )


def _elements(found: list[Check], by_check) -> Column:
    """The failing elements of a list cell, or one entry for any other failed cell."""
    allowed = F.get(
        F.array(*[F.array(*[F.lit(v) for v in c.allowed]).cast("array<string>") for c in found]),
        F.col("_check"),
    )
    elements = F.transform(
        F.split(strip(F.col("_shown")), ",", -1),
        lambda v, i: F.struct(strip(v).alias("_element_text"), i.alias("element")),
    )
    failing = F.filter(elements, lambda e: ~F.array_contains(allowed, e["_element_text"]))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("_element_text"), F.lit(0).alias("element")))
    return F.when(by_check(lambda c: c.show) == PER_ELEMENT, failing).otherwise(whole)


def ragged_rows(df: DataFrame, line: str, row: str = "row", carry: tuple[str, ...] = ()) -> DataFrame:
    """A failure for each row whose number of cells was not that of the header; `line` holds its raw text."""
    return df.where(F.col(line).isNotNull()).select(
        F.col(row).alias("row"),
        *carry,
        F.lit(LOADS).alias("phase"),
        F.lit(0).alias("column"),
        F.lit("").alias("column_name"),
        F.lit(WRONG_FORM).alias("error_code"),
        F.concat(F.lit('Row does not have the cells of the header: "'), F.col(line), F.lit('"')).alias("message"),
        F.lit(0).alias("element"),
    )


def errors_by_column(failed: DataFrame) -> DataFrame:
    return failed.groupBy("column_name", "error_code").agg(F.count("*").alias("errors"))


def label_errors(failed: DataFrame) -> DataFrame:
    """Meaning of each code, from the fixed table above."""
    meaning = F.lit(None).cast("string")
    for code, text in CODES.items():
        meaning = F.when(F.col("error_code") == code, F.lit(text)).otherwise(meaning)
    return failed.withColumn("meaning", meaning)


def within_budget(failed: DataFrame, max_errors: int) -> tuple[DataFrame, int, bool]:
    """The first `max_errors` failures in report order, the true total, and if cut off.

    The report order is phase, column, row, element. Counts per phase and column (at most
    three per contract column) tell which columns are kept whole; only the column where
    the budget ends is ordered, as a top-k.
    """
    counts = sorted(
        (r.phase, r["column"], r.n)
        for r in failed.groupBy("phase", "column").agg(F.count("*").alias("n")).collect()
    )
    total = sum(n for *_, n in counts)
    if total <= max_errors:
        return failed, total, False
    whole, left, cut = F.lit(False), max_errors, None
    for phase, column, n in counts:
        here = (F.col("phase") == phase) & (F.col("column") == column)
        if n > left:
            cut = failed.where(here).orderBy("row", "element").limit(left)
            break
        whole, left = whole | here, left - n
    return failed.where(whole).unionByName(cut), total, True


def _single(spark: SparkSession, name: str, code: int, message: str) -> DataFrame:
    row = (0, 0, name, code, message)
    schema = "row bigint, column int, column_name string, error_code int, message string"
    return spark.createDataFrame([row], schema)


def report(failed: DataFrame, max_errors: int | None = None) -> tuple[DataFrame, int, bool]:
    """Report rows, within the budget if there is one, and the closing row that counts them.

    The failures are settled first: they are counted and reported from one evaluation.
    """
    failed = settle(failed)
    if max_errors is None:
        kept, total, truncated = failed, failed.count(), False
    else:
        kept, total, truncated = within_budget(failed, max_errors)
    shown = total if max_errors is None else min(total, max_errors)
    closing = _single(failed.sparkSession, "", SUMMARY, f"{shown} errors found")
    rows = kept.select(F.col("row").cast("long"), *REPORT[1:])
    return rows.unionByName(closing), total, truncated


def check_all(
    df: DataFrame,
    contract: Contract,
    max_errors: int | None = None,
    data_check: bool = True,
    row: str = "row",
) -> tuple[DataFrame, int, bool]:
    """All checks of a delivery: report, number of errors, whether the report is cut."""
    spark = df.sparkSession
    if data_check:
        return report(failures(df, contract, row=row), max_errors)
    unchecked = _single(spark, "Overall message", UNCHECKED, UNCHECKED_TEXT)
    return unchecked.unionByName(_single(spark, "", SUMMARY, "1 errors found")), 0, False


def seeded_report(spark: SparkSession, table: str) -> DataFrame:
    """Report of a first delivery copied from a table, which is not checked."""
    rows = _single(spark, "Overall message", UNCHECKED, UNCHECKED_TEXT)
    rows = rows.unionByName(_single(spark, "", SUMMARY, "1 errors found"))
    text = SEEDED_TEXT.format(table=table)
    return rows.unionByName(_single(spark, "General message", SEEDED, text))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def report_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy(*[c for c in ORDER if c in rows.columns])
