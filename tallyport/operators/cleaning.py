"""Cleaning of text cells by declared rules; each step is one projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tallyport.contract import GENERATED_NAMES, Contract
from tallyport.functions import datatypes
from tallyport.functions.text import java_pattern, java_replacement, strip
from tallyport.sources.delimited import RAGGED
from tallyport.sources.staging import TRACE

NOT_DATA = {*GENERATED_NAMES, *TRACE, RAGGED}


@dataclass(frozen=True)
class Replacement:
    """Replace rule of a column, or of all columns of a datatype (`<numeric>`)."""

    target: str
    values: dict[str, str]
    regex: bool = False


@dataclass(frozen=True)
class CleaningRules:
    select: dict[str, list[str]] | None = None
    strip: tuple[str, ...] = ()
    replacements: tuple[Replacement, ...] = ()


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in NOT_DATA]


def select_rows(df: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """Rows that hold, in each listed column, one of its listed values."""
    for column, values in wanted.items():
        df = df.where(F.col(column).isin(values))
    return df


def strip_space(df: DataFrame, columns: tuple[str, ...] = ("*",)) -> DataFrame:
    """No white space at either end; columns the delivery lacks are left out."""
    chosen = data_columns(df)
    if list(columns) != ["*"]:
        chosen = [c for c in chosen if c in columns]
    return df.withColumns({c: strip(F.col(c)) for c in chosen})


def decimal_comma(df: DataFrame, contract: Contract) -> DataFrame:
    """Decimal point in columns of real types, when the supplier writes another sign."""
    if contract.decimal_sign == ".":
        return df
    reals = [c for c in contract.of_base("real") if c in df.columns]
    return df.withColumns({c: F.translate(c, ",", ".") for c in reals})


def replaced(cell: Column, rule: Replacement) -> Column:
    if rule.regex:
        # in declared order, each pattern on the result of the one before
        for pattern, text in rule.values.items():
            cell = F.regexp_replace(cell, java_pattern(pattern), java_replacement(text))
        return cell
    # whole cells, all at once: a new value is not replaced again
    result = cell
    for old, new in reversed(rule.values.items()):
        result = F.when(cell == old, F.lit(new)).otherwise(result)
    return result


def replace_values(
    df: DataFrame, contract: Contract, rules: tuple[Replacement, ...]
) -> DataFrame:
    """Apply replace rules; rules for a datatype reach every column of that type."""
    present = data_columns(df)
    by_column: dict[str, Replacement] = {}
    for rule in rules:
        target = rule.target.strip()
        if target.startswith("<") and target.endswith(">"):
            names = contract.of_type(target[1:-1])
        else:
            names = [target]
        for name in names:
            if name in present:
                by_column.setdefault(name, rule)
    return df.withColumns({n: replaced(F.col(n), r) for n, r in by_column.items()})


def clean(df: DataFrame, contract: Contract, rules: CleaningRules) -> DataFrame:
    """Select rows, strip, convert the decimal sign, replace - in this order."""
    if rules.select:
        df = select_rows(df, rules.select)
    if rules.strip:
        df = strip_space(df, rules.strip)
    return replace_values(decimal_comma(df, contract), contract, rules.replacements)


def drop_generated(df: DataFrame, keep: tuple[str, ...] = ("record_no",)) -> DataFrame:
    return df.drop(*[c for c in GENERATED_NAMES if c not in keep])


def split_instructions(
    df: DataFrame, instructions: tuple[str, ...]
) -> tuple[list[str], list[str]]:
    """Names of the instruction columns and of the data columns of a change delivery."""
    return list(instructions), [c for c in data_columns(df) if c not in instructions]


def supplier_datatype(supplier_type: str, decimals: int = 0, types: dict | None = None) -> str:
    """Load type of a supplier's type; any decimals make it numeric."""
    types = datatypes.SUPPLIER_TYPES if types is None else types
    return "numeric" if decimals > 0 else types.get(supplier_type, "text")


def cast_by_dictionary(
    df: DataFrame, dictionary: list[tuple[str, str, int]], scale: int = 2
) -> DataFrame:
    """Typed columns of a delivery described by `(column, supplier type, decimals)`."""
    return df.select(
        *[
            datatypes.load_cell(
                F.col(name), supplier_datatype(kind, decimals), 38, scale
            ).alias(name)
            for name, kind, decimals in dictionary
        ]
    )
