"""Change files against a row-by-row model of the same rules."""

import datetime
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from tallyport.contract import Contract, ContractColumn, ContractError
from tallyport.functions.periods import change_window
from tallyport.operators import compare, history
from tallyport.operators.cleaning import CleaningRules
from tallyport.operators.stored import StoredHistory
from tallyport.plans.load import apply_folder, load_changes
from tallyport.streaming import mutations
from tallyport.streaming.mutations import apply_landing

END = datetime.date(9999, 12, 31)
BEGIN = datetime.date(1970, 1, 1)
SCHEMA = "id long, v string, valid_from date, valid_to date"
CHANGES = "action string, id long, v string, pos long"


def model(rows, changes, start, end):
    """One change at a time; existence is judged on the rows before the file."""
    known = {r[0] for r in rows if r[0] is not None}
    current = {r[0] for r in rows if r[3] == END and r[0] is not None}
    state = [list(r) for r in rows]
    inserted, refused = set(), []
    for action, key, value, pos in sorted(changes, key=lambda c: c[3]):
        what = (action or "?").lower()
        if what == "insert":
            if key in known or key in inserted:
                refused.append(pos)
                continue
            inserted.add(key)
            state.append([key, value, start, END])
        elif what in ("update", "delete"):
            if key not in current:
                refused.append(pos)
                continue
            for row in state:
                if row[0] == key and row[3] == END:
                    row[3] = end
            if what == "update":
                state.append([key, value, start, END])
        elif what != "downdate":
            refused.append(pos)
    return sorted(map(tuple, state), key=repr), sorted(refused)


def random_case(seed, keys=12, rows=40, changes=60, hot=False):
    rng = random.Random(seed)
    table = []
    for key in range(keys):
        for version in range(rng.randrange(3)):
            open_ = rng.random() < 0.6 and not any(r[0] == key and r[3] == END for r in table)
            table.append((key, f"v{version}", BEGIN, END if open_ else datetime.date(2020, 1, 1)))
    actions = ["insert", "update", "delete", "Delete", "UPDATE", "downdate", "other", None]
    pick = lambda: 3 if hot and rng.random() < 0.5 else rng.randrange(keys + 6)
    edits = [(rng.choice(actions), pick(), f"c{p}", p) for p in range(changes)]
    edits.append(("insert", None, "no key", changes))
    edits.append(("delete", None, "no key", changes + 1))
    return table, edits


@pytest.mark.parametrize("seed, hot", [(1, False), (2, False), (3, True), (4, True)])
@pytest.mark.parametrize("limit", [1_000_000, -1])
def test_apply_changes(spark, monkeypatch, seed, hot, limit):
    """With the states of the keys broadcast, and joined by shuffle."""
    small = history.small_side
    monkeypatch.setattr(history, "small_side", lambda df: small(df, limit))
    table, edits = random_case(seed, hot=hot)
    start, end = datetime.date(2024, 2, 1), datetime.date(2024, 1, 31)
    applied = history.apply_changes(
        spark.createDataFrame(table, SCHEMA), spark.createDataFrame(edits, CHANGES).repartition(4),
        ["id"], F.lit(start), F.lit(end),
    )
    rows, refused = model(table, edits, start, end)
    assert sorted(map(tuple, applied.history.collect()), key=repr) == rows
    assert sorted(r.pos for r in applied.rejected.collect()) == refused
    parts = applied.archived.unionByName(applied.closed).unionByName(applied.current)
    assert sorted(map(tuple, parts.collect()), key=repr) == rows
    assert applied.closed.where("valid_to = date'9999-12-31'").isEmpty()
    open_keys = [r.id for r in applied.current.collect()]
    assert len(open_keys) == len(set(open_keys))


def test_replay_leaves_snapshots_before_the_file_alone(spark):
    table, edits = random_case(9)
    frame = spark.createDataFrame(table, SCHEMA)
    changes = spark.createDataFrame(edits, CHANGES)
    window = F.lit(datetime.date(2024, 2, 1)), F.lit(datetime.date(2024, 1, 31))
    once = history.apply_changes(frame, changes, ["id"], *window).history
    day = "2023-06-15"
    view = lambda df: sorted((r.id, r.v) for r in history.asof(df, day).collect())
    assert view(once) == view(frame)


def test_history_functions(spark):
    table, _ = random_case(5)
    spark.createDataFrame(table, SCHEMA).write.saveAsTable("history_rows")
    history.create_history_functions(spark, "history_rows", "desk", "id")
    valid = spark.sql("SELECT * FROM show_desk_at(date'2019-01-01')")
    assert valid.count() == sum(r[2] <= datetime.date(2019, 1, 1) <= r[3] for r in table)
    key = table[0][0]
    assert spark.sql(f"SELECT * FROM show_history_of_desk({key})").count() == sum(r[0] == key for r in table)


def test_compare_tables(spark):
    one = spark.createDataFrame([(1, "a", None), (2, "b", 5), (3, "c", 6)], "k int, s string, n int")
    two = spark.createDataFrame([(3, "c", 6), (1, "a", None), (2, "B", None)], "k int, s string, n int")
    equal, differing = compare.compare_tables(one, two, ["k"])
    assert not equal
    assert sorted(map(tuple, differing.collect())) == [(2, "n", "5", None), (2, "s", "b", "B")]
    assert compare.compare_tables(one, one.orderBy(F.desc("k")), ["k"])[0]
    # a key that one side lacks differs, also where its other cells are null
    bare = "k int, s string"
    left, right = spark.createDataFrame([(1, None), (None, "n")], bare), spark.createDataFrame([(2, None), (None, "n")], bare)
    equal, differing = compare.compare_tables(left, right, ["k"])
    assert not equal and sorted(map(tuple, differing.collect())) == [(1, "*", "present", None), (2, "*", None, "present")]
    twice = one.unionByName(one)
    with pytest.raises(ContractError, match="unique"):
        compare.compare_tables(twice, twice, ["k"])
    assert compare.compare_tables(one, two.limit(2), ["k"]) == (False, None)
    assert compare.compare_tables(one, two.select("k", "n", "s"), ["k"]) == (False, None)
    assert compare.column_differences(["k", "s"], ["k", "t", "u"]) == [(1, "s", "t"), (2, None, "u")]


def test_change_files_as_they_land(spark, tmp_path):
    """Files in two rounds; a replay of the stream with lost progress changes nothing."""
    schema = T.StructType.fromDDL("id long, v string")
    table, _ = random_case(6)
    store = StoredHistory(spark, str(tmp_path / "history"), spark.createDataFrame([], SCHEMA).schema, ["id"])
    store.start(spark.createDataFrame(table, SCHEMA))
    landing = tmp_path / "landing"
    landing.mkdir()
    expected = sorted(table, key=repr)
    names = ["change_20240101-20240115", "change_20240116-20240220", "change_20240221-20240310"]
    for number, name in enumerate(names):
        _, edits = random_case(20 + number)
        edits = [(a or "none", k, v, p) for a, k, v, p in edits if k is not None]
        lines = "".join(f'{a},{k},"{v}"\n' for a, k, v, _ in edits)
        (landing / f"{name}.csv").write_text(lines)
        end = datetime.datetime.strptime(name[-8:], "%Y%m%d").date().replace(day=1)
        expected, _ = model(expected, edits, end, end - datetime.timedelta(days=1))
        if number != 1:
            # the second file waits for the third: both land in one batch
            apply_landing(store, str(landing), schema, ["id"], str(tmp_path / "progress")).awaitTermination()
            rows = store.read().collect()
            assert sorted(map(tuple, rows), key=repr) == expected
    apply_landing(store, str(landing), schema, ["id"], str(tmp_path / "other progress")).awaitTermination()
    assert len(store.versions()) == 4
    assert sorted(map(tuple, store.read().collect()), key=repr) == expected


def test_change_window(spark):
    row = spark.range(1).select(*change_window(F.lit("mutation_20240101-20240315"))).first()
    assert [str(d) for d in row] == ["2024-03-01", "2024-02-29"]


def test_load_changes(spark, tmp_path):
    """A delivered change file: checked, applied once, refused the second time."""
    contract = Contract.of(
        ContractColumn("id", "bigint", "NOT NULL", key="PRIMARY KEY"),
        ContractColumn("v", "text", "", "re:[a-z]+$"),
        source_code="S",
    )
    schema = contract.typed_schema()
    rows = [(1, "S", "2023-I", BEGIN, END, None, 7, "a"), (2, "S", "2023-I", BEGIN, END, None, 8, "b")]
    store = StoredHistory(spark, str(tmp_path / "history"), schema, ["id"])
    store.start(spark.createDataFrame(rows, schema))
    (tmp_path / "changes.csv").write_text(
        "Action;ID;V\nupdate; 7 ;x\ndelete;8;b\ninsert;9;Q\ninsert;7;y\nother;1;z\n"
    )
    load = lambda: load_changes(
        spark, str(tmp_path / "changes.csv"), "change_20240101-20240215", contract,
        CleaningRules(strip=("*",)), "2024-M2", store, str(tmp_path / "quality"),
    )
    refused = {(r.action, r.id, r.reason) for r in load().collect()}
    assert refused == {("insert", 7, "key already exists"), ("other", 1, "unknown instruction")}
    after = sorted(
        (r.id, r.v, str(r.valid_from), str(r.valid_to), r.record_no, r.period)
        for r in store.read().collect()
    )
    assert after == [
        (7, "a", "1970-01-01", "2024-01-31", 1, "2023-I"),
        (7, "x", "2024-02-01", "9999-12-31", 3, "2024-M2"),
        (8, "b", "1970-01-01", "2024-01-31", 2, "2023-I"),
        (9, "Q", "2024-02-01", "9999-12-31", 5, "2024-M2"),
    ]
    failed = spark.read.parquet(str(tmp_path / "quality")).collect()
    assert [(r.row_number, r.column_name, r.quality_code) for r in failed] == [(2, "v", 8)]
    with pytest.raises(ContractError, match="before"):
        load()
    # a stream goes on with the same history and knows the file; another file keeps its own quality rows
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "change_20240101-20240215.csv").write_text("insert,50,no\n")
    (landing / "change_20240216-20240320.csv").write_text("insert,51,yes\n")
    data = T.StructType.fromDDL("id long, v string")
    apply_landing(store, str(landing), data, ["id"], str(tmp_path / "progress")).awaitTermination()
    folder = tmp_path / "folder"
    folder.mkdir()
    for name, line in (("20240401-20240420", "insert;61;b"), ("20240321-20240331", "insert;60;A"), ("20240101-20240215", "insert;62;c")):
        (folder / f"change_{name}.csv").write_text(f"Action;ID;V\n{line}\n")
    go = lambda: apply_folder(
        spark, str(folder), contract, CleaningRules(), "2024-M2", store, str(tmp_path / "quality")
    ).collect()
    assert [tuple(r) for r in go()] == [("change_20240321-20240331", "applied", 0), ("change_20240401-20240420", "applied", 0)]
    assert go() == []
    keys = {r.id for r in store.read().where(history.is_current()).collect()}
    assert keys == {7, 9, 51, 60, 61}
    failed = spark.read.parquet(str(tmp_path / "quality")).collect()
    assert sorted((r.change[-17:], r.row_number) for r in failed) == [("20240101-20240215", 2), ("20240321-20240331", 0)]


def folders(store, pattern):
    return {str(p.relative_to(store.root)) for p in Path(store.root).glob(pattern)}


def test_one_key_rewrites_one_bucket(spark, tmp_path):
    """Folders written and read by small change files, a day and a key."""
    schema = spark.createDataFrame([], SCHEMA).schema
    store = StoredHistory(spark, str(tmp_path / "history"), schema, ["id"], buckets=8)
    begin, end = datetime.date(1970, 1, 1), datetime.date(9999, 12, 31)
    table = [(k, f"v{k}", begin, end) for k in range(200)]
    store.start(spark.createDataFrame(table, SCHEMA))
    assert len(folders(store, "rows/000000000/_state=open/_bucket=*")) == 8
    day = lambda text: F.to_date(F.lit(text))
    change = lambda *rows: spark.createDataFrame(list(rows), CHANGES)
    refused = store.apply("a_20240101-20240215", change(("update", 5, "new", 0), ("delete", 500, "x", 1)), day("2024-02-01"), day("2024-01-31"))
    assert [(r.id, r.reason) for r in refused.collect()] == [(500, "key has no current row")]
    assert len(folders(store, "rows/000000001/_state=*/_bucket=*")) == 2  # the open rows of a bucket, and what was closed
    # a file that changes nothing writes nothing, and is known
    store.apply("b_20240201-20240315", change(("insert", 5, "x", 0)), day("2024-03-01"), day("2024-02-29"))
    assert not folders(store, "rows/000000002/_state=*/_bucket=*") and store.has("b_20240201-20240315")
    # gone keys stay known
    store.apply("c_20240301-20240415", change(*[("delete", k, "", k) for k in range(200)]), day("2024-04-01"), day("2024-03-31"))
    refused = store.apply("d_20240401-20240515", change(("insert", 5, "x", 0), ("insert", 999, "y", 1)), day("2024-05-01"), day("2024-04-30"))
    assert [r.id for r in refused.collect()] == [5]
    rows = [tuple(r) for r in store.read().collect()]
    assert len(rows) == 202 and [r for r in rows if r[3] == end] == [(999, "y", datetime.date(2024, 5, 1), end)]
    assert sorted(map(tuple, store.read("000000001").collect())) == sorted(
        [(5, "v5", begin, datetime.date(2024, 1, 31)), (5, "new", datetime.date(2024, 2, 1), end)] + [r for r in table if r[0] != 5]
    )
    # what a day reads does not grow with later versions; a key reads its bucket
    early = store.asof("2024-01-15")
    assert sorted(r.id for r in early.collect()) == list(range(200))
    versions_read = {f.split("/rows/")[1][:9] for f in store.asof("2024-03-31").inputFiles()}
    assert versions_read == {"000000003"}
    assert len({f.split("_bucket=")[1][:2] for f in store.history_of(5).inputFiles()}) == 1
    assert sorted((r.v, str(r.valid_to)) for r in store.history_of(5).collect()) == [("new", "2024-03-31"), ("v5", "2024-01-31")]
    assert store.asof("1960-01-01").count() == 0 and store.history_of(12345).count() == 0


def test_a_stream_loses_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    store = StoredHistory(spark, str(tmp_path / "history"), schema, ["id"])
    begin, end = datetime.date(1970, 1, 1), datetime.date(9999, 12, 31)
    store.start(spark.createDataFrame([(1, "a", begin, end)], SCHEMA))
    assert mutations.quarantine(store).count() == 0
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "loose.csv").write_text("insert,7,lost\ninsert,8,lost\n")
    (landing / "odd_20241399-20249999.csv").write_text("insert,9,no such day\n")
    (landing / "change_20240101-20240215.csv").write_text(
        'insert,2,b\ninsert,3x,c\ninsert,4,d,e\ninsert,5\ndelete,99,\ninsert,,f\nupdate,1,"a, ""2"""\ninsert,2,again\n'
    )
    data = T.StructType.fromDDL("id long, v string")
    for progress in ("progress", "lost progress"):
        apply_landing(store, str(landing), data, ["id"], str(tmp_path / progress)).awaitTermination()
        kept = {(r.change, r.raw, r.reason, r.columns) for r in mutations.quarantine(store).collect()}
        name = "change_20240101-20240215"
        assert kept == {
            ("loose.csv", "insert,7,lost", mutations.NO_WINDOW, ""), ("loose.csv", "insert,8,lost", mutations.NO_WINDOW, ""),
            ("odd_20241399-20249999.csv", "insert,9,no such day", mutations.NO_WINDOW, ""),
            (name, "insert,3x,c", mutations.BAD_CELL, "id"), (name, "insert,4,d,e", mutations.CELL_COUNT, ""),
            (name, "insert,5", mutations.CELL_COUNT, ""), (name, 'delete,99,""', "key has no current row", ""),
            (name, 'insert,"",f', mutations.NO_KEY, ""), (name, "insert,2,again", "duplicate key in file", ""),
        }
        assert mutations.quarantine(store).count() == 9
    rows = {(r.id, r.v) for r in store.read().where(history.is_current()).collect()}
    assert rows == {(1, 'a, "2"'), (2, "b")} and len(store.versions()) == 2
