"""The tables of the deliveries of a contract, each load of which becomes visible at once."""

from __future__ import annotations

import uuid
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from tallyport.contract import Contract

QUALITY = (
    "record_no long, source_code string, row_number long, column_name string, "
    "attribute_code string, quality_code int, period string, loaded_at timestamp"
)
LEDGER = (
    "sequence int, period string, source_code string, created_by string, delivered_on date, "
    "accepted boolean, reason string, processed_on date, records long, config_text string, "
    "data_file string, loaded_at timestamp"
)
# What the ledger's log holds besides: the load, its place in the log, whether it took the delivery out, its last record number.
LOG = f"{LEDGER}, load string, entry long, removed boolean, last_record long"
PARTS = ("data", "quality", "keys")
HASH = "_key_hash"


def stored(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table kept at a path under its declared schema; empty if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace_part(df: DataFrame, path: str, **part: str) -> None:
    """Writes rows in place of what a part of a table held before, also if there are none."""
    folders = [f"{name}={quote(value, safe='-_.')}" for name, value in part.items()]
    df.drop(*part).write.mode("overwrite").parquet("/".join([path, *folders]))


class DeliveryTables:
    """`data`, `quality` and `ledger` of a contract below a folder, and the keys of its data.

    A load writes its rows below an id of its own; one row appended to the ledger's log makes all of it visible, in place of
    what the period had before. Readers take the newest row of each period and the parts of the loads it names.
    So a load or removal that is refused or cut short at any point leaves what was there, and is simply repeated. Rows of
    loads that are no longer visible are emptied afterwards. The driver sees the log, a row for each load.

    The key index has the key columns of each load with their hash, sorted by it. A delivery's keys meet those of the table by
    a join on hash and keys, to which Spark adds a Bloom filter of the delivery's hashes; the data are not read.
    """

    def __init__(self, spark: SparkSession, root: str, contract: Contract):
        self.spark, self.root, self.contract = spark, root, contract
        rows = stored(spark, f"{root}/ledger", LOG).collect()
        self.entry = max((r.entry for r in rows), default=0)
        newest: dict[str, Row] = {}
        for row in sorted(rows, key=lambda r: r.entry):
            newest[row.period] = row
        self.visible = {p: r for p, r in newest.items() if not r.removed}

    def schema(self, part: str) -> T.StructType:
        if part == "quality":
            return T.StructType.fromDDL(QUALITY)
        typed = self.contract.typed_schema()
        if part == "data":
            return typed
        return T.StructType([T.StructField(HASH, T.LongType()), *[typed[k] for k in self.contract.keys], typed["period"]])

    def rows(self, part: str, *periods: str) -> DataFrame:
        """The visible rows of a part, of all periods or some."""
        schema = self.schema(part)
        chosen = [r for p, r in self.visible.items() if not periods or p in periods]
        whole = T.StructType([*schema, T.StructField("load", T.StringType())])
        found = stored(self.spark, f"{self.root}/{part}", whole)
        return found.where(F.col("load").isin([r.load for r in chosen])).select(*schema.names)

    def ledger(self) -> DataFrame:
        names = T.StructType.fromDDL(LEDGER).names
        return self.spark.createDataFrame([tuple(r[n] for n in names) for r in self.visible.values()], LEDGER)

    def tables(self) -> dict[str, DataFrame]:
        return {"ledger": self.ledger(), "data": self.rows("data"), "quality": self.rows("quality")}

    def next_sequence(self, period: str) -> int:
        """The number of a delivery: the one it had, or the next."""
        if period in self.visible:
            return self.visible[period].sequence
        return max((r.sequence for r in self.visible.values()), default=0) + 1

    def next_record(self, period: str) -> int:
        """The first free record number, not counting the rows of a period to be replaced."""
        return 1 + max((r.last_record or 0 for p, r in self.visible.items() if p != period), default=0)

    def write(self, load: str, period: str, part: str, rows: DataFrame) -> None:
        replace_part(rows, f"{self.root}/{part}", period=period, load=load)

    def write_data(self, load: str, period: str, rows: DataFrame) -> tuple[int, int | None]:
        """Writes the rows and the index of their keys; their number and the last record number."""
        self.write(load, period, "data", rows)
        whole = T.StructType([*self.schema("data"), T.StructField("load", T.StringType())])
        written = stored(self.spark, f"{self.root}/data", whole).where(F.col("load") == load)
        keys = list(self.contract.keys)
        if keys:
            index = written.select(F.xxhash64(*keys).alias(HASH), *keys, "period")
            self.write(load, period, "keys", index.sortWithinPartitions(HASH))
        return tuple(written.agg(F.count("*"), F.max("record_no")).first())

    def publish(self, row: DataFrame, load: str, period: str, last_record: int | None, removed: bool = False) -> None:
        """Appends a row to the log: from now on readers see the load."""
        extra = {"load": F.lit(load), "entry": F.lit(self.entry + 1).cast("long"), "removed": F.lit(removed), "last_record": F.lit(last_record).cast("long")}
        row.withColumns(extra).select(*T.StructType.fromDDL(LOG).names).coalesce(1).write.mode("append").parquet(f"{self.root}/ledger")
        old = self.visible.get(period)
        if old is not None:
            for part in PARTS:
                if part != "keys" or self.contract.keys:
                    self.write(old.load, period, part, self.spark.createDataFrame([], self.schema(part)))

    def repeated_keys(self, period: str) -> DataFrame:
        """Key values of a delivery that occur more than once in the table: (keys, copies, periods)."""
        keys = list(self.contract.keys)
        own = self.rows("keys", period).select(HASH, *keys).distinct()
        met = self.rows("keys").join(own, [HASH, *keys], "left_semi")
        found = met.groupBy(*keys).agg(F.count("*").alias("copies"), F.count_distinct("period").alias("periods"))
        return found.where("copies > 1")


def new_load() -> str:
    return uuid.uuid4().hex
