"""Dated history: versions of rows with an inclusive validity interval.

A row is current while `valid_to` is the end of time. A change file closes current rows
and adds new ones; all its rows share one start date and one end date.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyport.functions.periods import END_OF_TIME
from tallyport.session import small_side

ACTION, POSITION = "action", "pos"
# Instructions of a change file; a downdate is accepted and does nothing.
INSERT, UPDATE, DELETE, IGNORED = "insert", "update", "delete", "downdate"
CLOSING = [UPDATE, DELETE]


def end_of_time() -> Column:
    return F.to_date(F.lit(END_OF_TIME))


def is_current() -> Column:
    return F.col("valid_to") == end_of_time()


def asof(history: DataFrame, day: str | Column) -> DataFrame:
    """Rows valid on a day."""
    day = F.to_date(F.lit(day)) if isinstance(day, str) else day
    return history.where((F.col("valid_from") <= day) & (F.col("valid_to") >= day))


def history_of(history: DataFrame, key: str, value) -> DataFrame:
    """All versions of one key."""
    return history.where(F.col(key) == value)


def create_history_functions(spark: SparkSession, table: str, supplier: str, key: str) -> None:
    """SQL table functions over a catalogue table, as the two queries users call."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in spark.table(table).schema
    )
    kind = spark.table(table).schema[key].dataType.simpleString()
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION show_{supplier}_at(day DATE) "
        f"RETURNS TABLE ({columns}) "
        f"RETURN SELECT * FROM {table} "
        f"WHERE valid_from <= show_{supplier}_at.day AND valid_to >= show_{supplier}_at.day"
    )
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION show_history_of_{supplier}(id {kind}) "
        f"RETURNS TABLE ({columns}) "
        f"RETURN SELECT * FROM {table} WHERE `{key}` = show_history_of_{supplier}.id"
    )


def key_states(history: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    """What the history and the file know about each changed key, one row per key.

    All columns are plain aggregates, so a key with very many changes or versions is
    reduced before the shuffle and never gathered or ordered in one task. The changed keys
    and the result are settled: usually few, they are broadcast and the history stays put.
    """
    action = F.lower(ACTION)
    position = F.col(POSITION)
    in_file = small_side(
        changes.groupBy(*key).agg(
            F.min(F.when(action == INSERT, position)).alias("first_insert"),
            F.max(F.when(action.isin(CLOSING), position)).alias("last_close"),
        )
    )
    known = (
        history.select(*key, is_current().alias("_current"))
        .join(in_file.select(*key), key, "left_semi")
        .groupBy(*key)
        .agg(F.max("_current").alias("current"))
    )
    states = in_file.join(known, key, "left").select(
        *in_file.columns,
        F.col("current").isNotNull().alias("known"),
        F.coalesce("current", F.lit(False)).alias("current"),
    )
    return small_side(states)


def judge(changes: DataFrame, states: DataFrame, key: list[str]) -> DataFrame:
    """Each change with its verdict: `reason` is null if it is accepted.

    Existence is judged against the history before the file; an insert needs a key that
    never existed, a closing action a current row. The first insert of a key wins.
    """
    action = F.lower(ACTION)
    reason = (
        F.when((action == INSERT) & F.col("known"), "key already exists")
        .when((action == INSERT) & (F.col(POSITION) > F.col("first_insert")), "duplicate key in file")
        .when(action.isin(CLOSING) & ~F.col("current"), "key has no current row")
        .when(~F.coalesce(action.isin(INSERT, UPDATE, DELETE, IGNORED), F.lit(False)), "unknown instruction")
    )
    # a change without a key is judged too, so nulls must meet nulls here
    twins = states.withColumnsRenamed({k: f"_{k}" for k in key})
    same = [changes[k].eqNullSafe(twins[f"_{k}"]) for k in key]
    judged = changes.join(twins, same).drop(*[f"_{k}" for k in key])
    return judged.withColumn("reason", reason)


def verdicts(history: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    judged = judge(changes, key_states(history, changes, key), key)
    return judged.select(*changes.columns, "reason")


def accepted(history: DataFrame, changes: DataFrame, key: list[str], actions: list[str]) -> DataFrame:
    rows = changes.where(F.lower(ACTION).isin(actions))
    return verdicts(history, rows, key).where("reason is null").drop("reason")


def rejects(history: DataFrame, changes: DataFrame, key: list[str]) -> DataFrame:
    return verdicts(history, changes, key).where("reason is not null")


@dataclass
class Applied:
    """A history after a change file, in parts, and what was refused."""

    archived: DataFrame  # closed before the file; never touched
    opened: DataFrame  # open before the file; closed by it where `_hit`
    fresh: DataFrame  # versions the file adds
    accepted: DataFrame  # changes that take effect: key, instruction, position
    rejected: DataFrame

    @property
    def history(self) -> DataFrame:
        names = self.archived.columns
        return self.archived.unionByName(self.opened.select(*names)).unionByName(self.fresh)

    @property
    def current(self) -> DataFrame:
        """Open rows after the file."""
        kept = self.opened.where(~F.col("_hit")).select(*self.archived.columns)
        return kept.unionByName(self.fresh.where(is_current()))

    @property
    def closed(self) -> DataFrame:
        """Rows closed by the file, versions replaced within it included."""
        hit = self.opened.where("_hit").select(*self.archived.columns)
        return hit.unionByName(self.fresh.where(~is_current()))


def apply_changes(
    history: DataFrame,
    changes: DataFrame,
    key: list[str],
    start: Column,
    end: Column,
    stamps: dict[str, Column] | None = None,
) -> Applied:
    """Apply one change file to a history.

    Only current rows are joined with the closing keys; rows closed earlier pass by. With
    few changed keys nothing of the history is shuffled. A change affects
    the row that is current when its turn comes, so a version written by the file and
    closed later in the same file gets `valid_to = end`, before its start. `stamps` gives
    the remaining generated columns of new rows.
    """
    names = history.columns
    states = key_states(history, changes, key)
    judged = judge(changes, states, key)
    closing = states.where("current and last_close is not null").select(*key, F.lit(True).alias("_closing"))
    hit = F.col("_closing").isNotNull()
    opened = (
        history.where(is_current())
        .join(closing, key, "left")
        .select(
            *[F.when(hit, end).otherwise(F.col(c)).alias(c) if c == "valid_to" else F.col(c) for c in names],
            hit.alias("_hit"),
        )
    )

    # closing actions are accepted for all of a key's changes or for none
    superseded = F.coalesce(F.col("current") & (F.col(POSITION) < F.col("last_close")), F.lit(False))
    generated = {
        "valid_from": start,
        "valid_to": F.when(superseded, end).otherwise(end_of_time()),
        **(stamps or {}),
    }
    taken = judged.where("reason is null").where(F.lower(ACTION).isin(INSERT, *CLOSING))
    fresh = taken.where(F.lower(ACTION) != DELETE).withColumns(generated)
    value = lambda c: F.col(c) if c in fresh.columns else F.lit(None)
    return Applied(
        archived=history.where(~is_current()),
        opened=opened,
        fresh=fresh.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in history.schema]),
        accepted=taken.select(*key, ACTION, POSITION),
        rejected=judged.where("reason is not null").select(*changes.columns, "reason"),
    )


def mutation_counts(judged: DataFrame) -> DataFrame:
    """Changes per instruction, and how many of them were refused."""
    return judged.groupBy(F.lower(ACTION).alias(ACTION)).agg(
        F.count("*").alias("changes"), F.count("reason").alias("errors")
    )


def inconsistencies(changes: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """Distinct keys per action that contradict the existing keys.

    An insert contradicts an existing key, every other action an absent one.
    """
    keys = changes.select(F.lower(ACTION).alias(ACTION), *key).distinct()
    present = existing.select(*key).distinct()
    wrong = (
        keys.where(F.col(ACTION) == INSERT).join(present, key, "left_semi")
        .unionByName(keys.where(F.col(ACTION) != INSERT).join(present, key, "left_anti"))
    )
    return wrong.groupBy(ACTION).agg(F.count("*").alias("keys"))


def latest_valid_to(history: DataFrame) -> DataFrame:
    return history.agg(F.max("valid_to").alias("valid_to"))
