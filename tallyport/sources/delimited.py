"""Delimited deliveries: every cell is text and an empty cell stays the empty string."""

from __future__ import annotations

import csv
import io
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallyport.contract import Contract, ContractError
from tallyport.functions.text import header_names
from tallyport.sources.records import Records, can_split

# A null marker that cannot occur in text, so no cell is ever read as null.
NO_NULL = "\x00"
# Where a cell came from: file, start of the split, and order of reading inside it.
SPLIT = ["_file", "_block"]
PLACE = "_place"
# The raw line of a row with more or fewer cells than the header.
RAGGED = "_ragged"

# Usual spellings of encodings and the names Spark knows them by. Further
# encodings need `spark.sql.legacy.javaCharsets`.
ENCODINGS = {
    "utf8": "UTF-8",
    "latin1": "ISO-8859-1",
    "latin-1": "ISO-8859-1",
    "ascii": "US-ASCII",
    "utf16": "UTF-16",
}


def charset(encoding: str) -> str:
    return ENCODINGS.get(encoding.lower(), encoding)


def _options(sep: str, encoding: str, multiline: bool) -> dict:
    return {
        "sep": sep,
        "encoding": charset(encoding),
        "quote": '"',
        "escape": '"',
        "nullValue": NO_NULL,
        "emptyValue": "",
        "mode": "PERMISSIVE",
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        # Spark's own reader splits files only where cells hold no line breaks
        "multiLine": multiline,
    }


def first_line(spark: SparkSession, path: str, sep: str = ";", encoding: str = "utf8") -> list[str]:
    """Raw header names of a delivery (one row goes to the driver)."""
    options = _options(sep, encoding, False)
    head = spark.read.options(**options, header=False).csv(path).limit(1)
    row = head.first()
    if row is None:
        raise ContractError(f"no header in {path}")
    return ["" if cell is None else cell for cell in row]


def headers_by_file(
    spark: SparkSession, path: str | list[str], sep: str = ";", encoding: str = "utf8"
) -> list[tuple[list[str], str | list[str]]]:
    """Each different raw header of a delivery with the files that have it.

    A delivery of one file costs one row. For several files one scan finds their first lines;
    there is a row for each file, and as a rule all have the same header, which leaves the path as it is.
    """
    lines = spark.read.option("encoding", charset(encoding)).text(path)
    files = lines.inputFiles()
    if len(files) == 1:
        return [(first_line(spark, path, sep, encoding), path)]
    place = F.struct("_metadata.file_block_start", F.monotonically_increasing_id())
    firsts = (
        lines.select(F.col("_metadata.file_path").alias("file"), "value", place.alias("place"))
        .where("value <> ''")
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("line"))
        .collect()
    )
    if not firsts:
        raise ContractError(f"no header in {path}")
    groups: dict[str, list[str]] = {}
    for row in sorted(firsts):
        groups.setdefault(row.line.rstrip("\r"), []).append(row.file)
    parsed = [(next(csv.reader([line], delimiter=sep)), named) for line, named in groups.items()]
    return [(parsed[0][0], path)] if len(parsed) == 1 else parsed


def sorted_headers(
    spark: SparkSession, paths: list[str], contract: Contract, sep: str = ";", encoding: str = "utf8"
) -> tuple[list[tuple[list[str], str | list[str]]], list[tuple[str, str]]]:
    """The headers of files that the contract accepts, and (file, reason) of the files under other ones or none."""
    try:
        found = headers_by_file(spark, paths, sep, encoding)
    except ContractError as error:
        return [], [(path, str(error)) for path in paths]
    good, bad = [], []
    for raw, files in found:
        try:
            accepted_names(raw, contract)
        except ContractError as error:
            bad += [(path, str(error)) for path in ([files] if isinstance(files, str) else files)]
        else:
            good.append((raw, files))
    return good, bad


def sidecar_header(
    spark: SparkSession, path: str, skip: int = 5, field: str = "FIELDNAME", encoding: str = "utf8"
) -> list[str]:
    """Column names kept in a separate header file: a table below `skip` lines of text.

    A header file has one line per column, so it is read on the driver's behalf as one
    small frame.
    """
    lines = [
        r.value
        for r in spark.read.option("wholetext", True).option("encoding", charset(encoding)).text(path)
        .select(F.explode(F.split("value", "\r?\n")).alias("value"))
        .collect()
    ]
    table = [line.split(";") for line in lines[skip:] if line]
    place = table[0].index(field)
    return [row[place].strip('"') for row in table[1:]]


def text_frame(
    spark: SparkSession,
    path: str | list[str],
    names: list[str],
    sep: str = ";",
    encoding: str = "utf8",
    header: bool = True,
    multiline: bool = False,
    traced: bool = False,
    ragged: bool = False,
) -> DataFrame:
    """All cells of a delivery as text under the given names, never inferred.

    `traced` adds the file and the split of each row; `stage` adds the order inside the
    split when it writes the rows, which must happen before any shuffle. `ragged` adds the raw
    line of rows whose number of cells is not that of the names; their cells are cut or filled up.
    """
    extra = [RAGGED] if ragged else []
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *extra]])
    rows = (
        spark.read.schema(schema)
        .options(**_options(sep, encoding, multiline), header=header, enforceSchema=True, columnNameOfCorruptRecord=RAGGED)
        # a parser that skips columns does not count the cells
        .option("columnPruning", not ragged)
        .csv(path)
    )
    cells = [F.col(RAGGED)] if ragged else []
    cells += [F.coalesce(F.col(n), F.lit("")).alias(n) for n in names]
    if traced:
        cells += [
            F.col("_metadata.file_path").alias(SPLIT[0]),
            F.col("_metadata.file_block_start").alias(SPLIT[1]),
        ]
    return rows.select(*cells)


def record_frame(
    rows: DataFrame, names: list[str], sep: str = ";", traced: bool = False, ragged: bool = False
) -> DataFrame:
    """The cells of records (`_file`, `_block`, `value`) as `text_frame` gives those of lines."""
    fields = [f"c{i}" for i in range(len(names))]
    schema = ", ".join(f"{f} string" for f in [*fields, *([RAGGED] if ragged else [])])
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in _options(sep, "utf8", True).items()}
    parsed = F.from_csv("value", schema, options | {"columnNameOfCorruptRecord": RAGGED})
    # as a generator, which parses a record once
    cells = rows.select(*SPLIT, F.inline(F.array(parsed)))
    return cells.select(
        *([RAGGED] if ragged else []),
        *[F.coalesce(F.col(f), F.lit("")).alias(n) for f, n in zip(fields, names, strict=True)],
        *(SPLIT if traced else []),
    )


def record_parts(records: Records, path: str | list[str], sep: str) -> list[tuple[list[str], DataFrame]]:
    """Each different header of files with line breaks inside cells, and the records below it."""
    headers = records.headers()
    if not headers:
        raise ContractError(f"no header in {path}")
    return [(next(csv.reader(io.StringIO(text, newline=""), delimiter=sep)), records.body(text)) for text in headers]


def read_delivery(
    spark: SparkSession,
    path: str,
    contract: Contract,
    header: bool = True,
    header_file: str | None = None,
    sep: str = ";",
    encoding: str = "utf8",
    instructions: tuple[str, ...] = (),
    max_rows: int = 0,
    traced: bool = False,
    multiline: bool = False,
    ragged: bool = False,
    headers: list[tuple[list[str], str | list[str]]] | None = None,
) -> DataFrame:
    """A delivery under its normalised header names, checked against the contract.

    Works on any path Spark can read, `s3a://` included. Names come from the header file
    if there is one, else from the first line of each file, else from the contract in its order.
    Files with different headers are read under their own names; a column that only some of them
    have is empty in the others. `headers` gives headers with their files, where they are known.
    With `multiline` cells may hold line breaks; a file is read by many tasks all the same, unless
    its encoding or a longer separator leaves that to Spark's reader of whole files.
    """
    records = None
    if multiline and headers is None and can_split(sep, charset(encoding)):
        records = Records(spark, path, sep, charset(encoding))
        if header_file is None and header:
            parts = record_parts(records, path, sep)
        else:
            raw = list(instructions) + contract.names if header_file is None else sidecar_header(spark, header_file, encoding=encoding)
            parts = [(raw, records.body())]
    elif headers is not None:
        parts = headers
    elif header_file is not None:
        parts = [(sidecar_header(spark, header_file, encoding=encoding), path)]
    elif header:
        parts = headers_by_file(spark, path, sep, encoding)
    else:
        parts = [(list(instructions) + contract.names, path)]
    named = [(accepted_names(raw, contract, instructions), part) for raw, part in parts]
    if records is not None:
        frames = [record_frame(part, names, sep, traced, ragged) for names, part in named]
    else:
        frames = [text_frame(spark, part, names, sep, encoding, header, multiline, traced, ragged) for names, part in named]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if len(frames) > 1:
        rows = rows.fillna("", [c for c in rows.columns if c in contract.names or c in instructions])
    return rows.limit(max_rows) if max_rows >= 1 else rows


def accepted_names(
    raw: list[str], contract: Contract, instructions: tuple[str, ...] = ()
) -> list[str]:
    """Normalised headers; unknown or repeated ones stop the delivery, absent ones do not."""
    names = header_names(raw)
    unknown = sorted(set(names) - set(contract.names) - set(instructions))
    if unknown:
        raise ContractError(f"headers not found in contract: {unknown}")
    if len(set(names)) < len(names):
        raise ContractError(f"duplicate headers: {names}")
    return names


def write_delimited(df: DataFrame, path: str, sep: str = ";", quote_all: bool = True, header: bool = True) -> None:
    df.write.options(
        sep=sep, header=header, quoteAll=quote_all, quote='"', escape='"',
        emptyValue='""' if quote_all else "", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).mode("errorifexists").csv(path)
