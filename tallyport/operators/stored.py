"""A history kept in the shared folder in buckets of its key, one version per change file."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyport.functions.periods import BEGIN_OF_TIME
from tallyport.operators.history import ACTION, DELETE, POSITION, Applied, apply_changes, asof, is_current
from tallyport.session import settle

OPEN, CLOSED, GONE, VERSION = "open", "closed", "gone", "version"
MANIFEST = (
    "version string, name string, state string, bucket int, rows long, first_from date, last_from date, "
    "first_to date, last_to date, last_record long"
)
BUCKETS = 4


class StoredHistory:
    """History as Parquet folders by version, state and bucket of the key's hash.

    - `open` rows: a version writes those of the buckets it changes, the others stay where they are;
    - `closed` rows: written once, by the version that closed them;
    - `gone` keys: those a version left without an open row. A key that is gone never comes back, so open rows
      and gone keys of its bucket tell whether it was ever known, without a look at closed rows.

    The manifest has a row for each folder, with its number of rows and the bounds of their validity; readers
    take from it which folders they need. A version's rows of the manifest are one file, written last: it makes the version
    visible, and a version that was cut short is simply written again. Versions are numbered one after the other, whoever
    adds them, and a change file is known by its name. `buckets` is fixed for the life of a history; choose it so that
    the open rows of a bucket fill a few files. The driver sees at most a few rows for each bucket and folder.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: list[str], buckets: int = BUCKETS):
        self.spark, self.root, self.schema, self.key, self.buckets = spark, root, schema, key, buckets

    # --- what there is ---

    def bucket(self) -> Column:
        keys = [F.col(k).cast(self.schema[k].dataType) for k in self.key]
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def versions(self) -> list[str]:
        """Labels of the visible versions (one per change file), oldest first."""
        return sorted(r.version for r in self.manifest().where(F.col("state") == VERSION).select("version").collect())

    def has(self, name: str) -> bool:
        """Whether a change file of this name was applied."""
        return not self.manifest().where((F.col("state") == VERSION) & (F.col("name") == name)).isEmpty()

    def last_record(self) -> int:
        """The highest record number of all versions, 0 if the rows have none."""
        return self.manifest().agg(F.coalesce(F.max("last_record"), F.lit(0))).first()[0]

    def _open_folders(self, until: str | None = None) -> DataFrame:
        """The manifest's rows of the open rows after a version (the last): the newest of each bucket."""
        rows = self.manifest().where(F.col("state") == OPEN)
        if until is not None:
            rows = rows.where(F.col("version") <= until)
        newest = rows.groupBy("bucket").agg(F.max(F.struct("version", *[c for c in rows.columns if c not in ("version", "bucket")])).alias("m"))
        return newest.select("bucket", "m.*")

    def _folder(self, version: str, state: str, bucket: int) -> str:
        return f"{self.root}/rows/{version}/_state={state}/_bucket={bucket}"

    def _rows(self, folders: DataFrame) -> DataFrame:
        held = folders.where(F.col("rows") > 0).select("version", "state", "bucket").collect()
        if not held:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self._folder(*r) for r in sorted(held)])

    def read(self, version: str | None = None) -> DataFrame:
        """The whole history after a version, as a rule the last."""
        closed = self.manifest().where(F.col("state") == CLOSED)
        if version is not None:
            closed = closed.where(F.col("version") <= version)
        return self._rows(closed).unionByName(self._rows(self._open_folders(version)))

    def asof(self, day: str) -> DataFrame:
        """Rows valid on a day, from the folders whose bounds hold it."""
        date = F.to_date(F.lit(day))
        may = (F.col("first_from") <= date) & (F.col("last_to") >= date)
        closed = self._rows(self.manifest().where((F.col("state") == CLOSED) & may))
        return asof(closed.unionByName(self._rows(self._open_folders().where(may))), day)

    def history_of(self, *values) -> DataFrame:
        """All versions of one key, from its bucket's folders."""
        one = self.spark.createDataFrame([values], T.StructType([self.schema[k] for k in self.key]))
        bucket = F.col("bucket") == one.select(self.bucket()).first()[0]
        closed = self._rows(self.manifest().where((F.col("state") == CLOSED) & bucket))
        rows = closed.unionByName(self._rows(self._open_folders().where(bucket)))
        return rows.join(F.broadcast(one), self.key, "left_semi").select(*self.schema.names)

    def known_in(self, buckets: Iterable[int]) -> DataFrame:
        """Open rows of some buckets, and a closed row for each key that is gone; enough to judge changes of their keys."""
        chosen = F.col("bucket").isin(list(buckets))
        gone = self._rows(self.manifest().where((F.col("state") == GONE) & chosen))
        return self._rows(self._open_folders().where(chosen)).unionByName(gone)

    # --- what is added ---

    def _stub(self, keys: DataFrame) -> DataFrame:
        """Keys as rows of the history that were valid on its first day."""
        day = F.to_date(F.lit(BEGIN_OF_TIME))
        value = lambda f: F.col(f.name) if f.name in self.key else day if f.name in ("valid_from", "valid_to") else F.lit(None)
        return keys.select(*[value(f).cast(f.dataType).alias(f.name) for f in self.schema], F.lit(GONE).alias("_state"))

    def _publish(self, version: str, name: str | None, rows: DataFrame, changed: Iterable[int], before: Callable[[], None] | None) -> None:
        folder = f"{self.root}/rows/{version}"
        placed = rows.withColumn("_bucket", self.bucket())
        # large buckets are split into several files, small ones share a task
        placed = placed.hint("rebalance", F.col("_bucket"), F.col("_state"))
        placed.write.mode("overwrite").partitionBy("_state", "_bucket").parquet(folder)
        if before is not None:
            before()
        schema = T.StructType([*self.schema, T.StructField("_state", T.StringType()), T.StructField("_bucket", T.IntegerType())])
        record = F.max("record_no").cast("long") if "record_no" in self.schema.names else F.lit(None).cast("long")
        bounds = [F.min("valid_from"), F.max("valid_from"), F.min("valid_to"), F.max("valid_to"), record]
        found = self.spark.read.schema(schema).parquet(folder).groupBy("_state", "_bucket").agg(F.count("*"), *bounds).collect()
        written = {(r[0], r[1]): tuple(r) for r in found}
        for bucket in changed:  # a bucket may be left without open rows
            written.setdefault((OPEN, bucket), (OPEN, bucket, 0, *[None] * 5))
        entries = [(version, name, *r) for r in written.values()]
        entries.append((version, name, VERSION, *[None] * 7))
        self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")

    def start(self, history: DataFrame) -> None:
        """The first version, from a history."""
        rows = history.select(*self.schema.names, F.when(is_current(), OPEN).otherwise(CLOSED).alias("_state"))
        ended = history.groupBy(*self.key).agg(F.max(is_current()).alias("_open")).where("not _open")
        self._publish(f"{0:09d}", None, rows.unionByName(self._stub(ended)), range(self.buckets), None)

    def apply(
        self, name: str, changes: DataFrame, start: Column, end: Column,
        stamps: dict[str, Column] | None = None, before: Callable[[DataFrame], None] | None = None,
    ) -> DataFrame:
        """The history after a change file as the next version; returns the refused changes.

        Only buckets with keys of the file are read, and only those with an accepted change are written.
        `before` gets the refused changes and is called before the version becomes visible.
        """
        touched = [r[0] for r in changes.select(self.bucket()).distinct().collect()]
        applied = apply_changes(self.known_in(touched), changes, self.key, start, end, stamps)
        accepted, refused = settle(applied.accepted), settle(applied.rejected)
        changed = [r[0] for r in accepted.select(self.bucket()).distinct().collect()]
        last = accepted.groupBy(*self.key).agg(F.max_by(F.lower(ACTION), POSITION).alias("_last"))
        rows = self._states(applied, changed).unionByName(self._stub(last.where(F.col("_last") == DELETE)))
        version = f"{int(self.versions()[-1]) + 1:09d}"
        self._publish(version, name, rows, changed, (lambda: before(refused)) if before is not None else None)
        return refused

    def _states(self, applied: Applied, changed: list[int]) -> DataFrame:
        names = self.schema.names
        opened = applied.opened.where(self.bucket().isin(changed))
        kept = opened.select(*names, F.when(F.col("_hit"), CLOSED).otherwise(OPEN).alias("_state"))
        fresh = applied.fresh.select(*names, F.when(is_current(), OPEN).otherwise(CLOSED).alias("_state"))
        return kept.unionByName(fresh)
