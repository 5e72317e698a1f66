"""Accepted text per datatype and the casts of the typed load."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from tallyport.functions import numbers
from tallyport.functions.text import is_blank

# Accepted text per base type, and the datatypes that share it.
BASE_PATTERNS = {
    "integer": "^[+-]?[0-9]+$|^[ ]*$",
    "real": "^[+-]?(([0-9]+([.][0-9]*)?|[.][0-9]+))([Ee][+-]?[0-9]+)?$|^$",
    "boolean": "^(0|1|true|false|yes|no)$",
    "date": "(^[0-9]{4}-[0-1][0-9]-[0-3][0-9])$|^([0-9]{4}[0-1][0-9][0-3][0-9])$|^$",
    "timestamp": "(^[0-9]{4}-[0-1][0-9]-[0-3][0-9])"
    "|^([0-9]{4}[0-1][0-9][0-3][0-9])( [0-2][0-9]:[0-6][0-9]:[0-6][0-9]){0,1}$|^$",
}
SUBTYPES = {
    "integer": ["integer", "bigint"],
    "real": ["real", "double precision", "numeric", "decimal"],
    "boolean": ["boolean", "bool"],
    "date": ["date"],
    "timestamp": ["timestamp"],
    "text": ["text", "serial", "bigserial"],
}
# Datatype meant by a supplier's own type name.
SUPPLIER_TYPES = {
    "CHAR": "text",
    "CUKY": "text",
    "UNIT": "text",
    "NUMC": "integer",
    "INT4": "integer",
    "DATS": "date",
    "QUAN": "numeric",
    "DEC": "numeric",
    "CURR": "numeric",
}

BASE_OF = {sub: base for base, subs in SUBTYPES.items() for sub in subs}


def base_type(datatype: str) -> str:
    """Base type of a datatype; unknown datatypes are treated as unchecked text."""
    return BASE_OF.get(datatype, "text")


def spark_type(datatype: str, precision: int = 38, scale: int = 10) -> T.DataType:
    return {
        "integer": T.IntegerType(),
        "bigint": T.LongType(),
        "serial": T.LongType(),
        "bigserial": T.LongType(),
        "real": T.FloatType(),
        "double precision": T.DoubleType(),
        "numeric": T.DecimalType(precision, scale),
        "decimal": T.DecimalType(precision, scale),
        "boolean": T.BooleanType(),
        "bool": T.BooleanType(),
        "date": T.DateType(),
        "timestamp": T.TimestampType(),
    }.get(datatype, T.StringType())


DASHED, COMPACT = "[0-9]{4}-[0-9]{2}-[0-9]{2}", "[0-9]{8}"


def dashed(cell: Column) -> Column:
    """`yyyymmdd` at the start as `yyyy-mm-dd`.

    Trying one date format after the other would raise and catch an error per cell.
    """
    return F.regexp_replace(cell, "^([0-9]{4})([0-9]{2})([0-9]{2})(?![0-9])", "$1-$2-$3")


def load_cell(
    cell: Column, datatype: str, precision: int = 38, scale: int = 10
) -> Column:
    """Typed value of a cell; blank becomes null except in text, unusable text too."""
    base = base_type(datatype)
    target = spark_type(datatype, precision, scale)
    if base == "text":
        return cell.try_cast(target) if isinstance(target, T.LongType) else cell
    if base == "boolean":
        return F.when(cell.isin("1", "true", "yes"), F.lit(True)).when(
            cell.isin("0", "false", "no"), F.lit(False)
        )
    if base == "integer":
        value = F.when(cell.rlike(numbers.WHOLE), F.trim(cell).try_cast(target))
    elif base == "real":
        value = F.when(cell.rlike(numbers.REAL), F.trim(cell).try_cast(target))
    elif base == "date":
        value = F.when(cell.rlike(f"^({DASHED}|{COMPACT})$"), dashed(cell)).try_cast(target)
    else:
        shape = f"^({DASHED}|{COMPACT})( [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}})?$"
        value = F.when(cell.rlike(shape), dashed(cell)).try_cast(target)
    return F.when(~is_blank(cell), value)
