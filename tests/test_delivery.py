"""A small delivery with the faults suppliers make, from file to tables."""

import pytest
from pyspark.sql import functions as F

from tallyport.contract import Contract, ContractColumn, ContractError
from tallyport.operators import checks, cleaning, ledger
from tallyport.operators.cleaning import CleaningRules, Replacement
from tallyport.operators.published import DeliveryTables
from tallyport.plans.load import Delivery, Supply, load_delivery, remove_delivery, run_supplies, stored_tables
from tallyport.sources import delimited, staging
from tallyport.streaming.checks import check_landing

# The sample delivery and its contract.
ROWS = """test_id;col_boolean;col_integer;col_decimal;col_date;check_null;check_minmax;check_list_numeric;check_list_text;check_re
1;yes;1-;1-;20241231;q;3-;3.14;q;
2;no;2-;2-;45657;w;2-;3;w;
3;true;3-;1.0-;00000000;e;-1;2;e;
4;True;4-;2.;561012;r;0;1;r;
5;false;1.0;.2-;0;t;1;-1;t;
6;waar;1.6;3.14-;Yyyy-mm-dd;y;2;-2;y;
7;onwaar;a;3.4e+4;x.y.z;u;3;3-;u;
8;fout;b;-4.5;;;4;0;i;
9;erg fout;col_integer;-4.5E-03;1957-2-29;o;5;0;o;
"""
CONTRACT_FILE = """kolomnaam;leverancier_kolomnaam;leverancier_kolomtype;datatype;keytype;constraints;domein;verstek
test_id;/TEST/ID;NUMC;integer;PRIMARY KEY;;;
col_boolean;/COL/BOOLEAN;CHAR;text;;;['','true','false'];
col_integer;/COL/INTEGER;NUMC;integer;;;1:100;
col_decimal;/COL/DECIMAL;NUMC;numeric;;;;
col_date;/COL/DATE;DATS;date;;;;
check_null;/CHECK/NULL;CHAR;;;NOT NULL;;
check_minmax;CHECK/MINMAX;NUMC;numeric;;;[1:7];
check_list_numeric;CHECK/LIST/NUMERIC;NUMC;numeric;;;[3,5,7,9];
check_list_text;CHECK/LIST/TEXT;CHAR;text;;;['ABC','DEF','XYZ','KLM','ASML',];
check_re;/CHECK/RE;CHAR;text;;;;
"""
MINUS = {"(.*)-": "-\\1"}
RULES = CleaningRules(
    strip=("*",),
    replacements=(
        Replacement("<date>", {"00000000": "99991231", "0": "99991231"}),
        Replacement("<numeric>", MINUS, regex=True),
        Replacement("<integer>", MINUS, regex=True),
    ),
)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivery")
    (folder / "data.csv").write_text(ROWS)
    (folder / "contract.csv").write_text(CONTRACT_FILE)
    return folder


@pytest.fixture(scope="module")
def contract(spark, files):
    return Contract.read(spark, str(files / "contract.csv"), source_code="TEST", frequency="Q")


@pytest.fixture(scope="module")
def delivery(spark, files, contract):
    raw = delimited.read_delivery(spark, str(files / "data.csv"), contract, traced=True)
    staged = staging.stage(cleaning.clean(raw, contract, RULES))
    return staging.number_rows(staged, "row", start=0)


def test_contract(contract):
    assert contract.keys == ("test_id",)
    assert contract["check_null"].datatype == "text"
    assert not contract["check_null"].nullable
    assert contract.of_base("real") == ["col_decimal", "check_minmax", "check_list_numeric"]


def test_cleaning(delivery):
    rows = {r["row"]: r for r in delivery.collect()}
    column = lambda name: [rows[i][name] for i in range(9)]
    assert column("col_decimal") == ["-1", "-2", "-1.0", "2.", "-.2", "-3.14", "3.4e+4", "-4.5", "--4.5E03"]
    assert column("col_date") == [
        "20241231", "45657", "99991231", "561012", "99991231", "Yyyy-mm-dd", "x.y.z", "", "1957-2-29",
    ]
    # a rule for a datatype reaches all its columns
    assert column("col_integer")[:4] == ["-1", "-2", "-3", "-4"]
    assert column("check_list_numeric")[6] == "-3"
    assert column("check_re") == [""] * 9


def test_checks(delivery, contract):
    report, total, cut = checks.check_all(delivery, contract)
    rows = [tuple(r) for r in report.collect()]
    assert not cut and total == len(rows) - 1
    assert (0, 0, "", -1, f"{total} errors found") in rows
    at = lambda code, name: sorted((r[0], r[4]) for r in rows if r[3] == code and r[2] == name)
    assert at(2, "check_null") == [(7, "NULL detected where not allowed")]
    assert [r for r, _ in at(6, "col_date")] == [1, 3, 5, 6, 8]
    assert at(6, "col_decimal") == [(8, 'Datatype not numeric, value found is "--4.5E03"')]
    assert [r for r, _ in at(6, "col_integer")] == [4, 5, 6, 7, 8]
    assert at(3, "col_integer")[0] == (0, "Value -1 exceeds min 1 or max 100")
    assert (6, "Value a exceeds min 1 or max 100") in at(3, "col_integer")
    assert len(at(3, "col_integer")) == 9
    # `[1:7]` is a list of one literal
    assert len(at(1, "check_minmax")) == 9
    assert [r for r, _ in at(1, "check_list_numeric")] == [0, 2, 3, 4, 5, 6, 7, 8]
    assert len(at(1, "check_list_text")) == 9
    assert [m for _, m in at(1, "col_boolean")][-1] == 'Value not in domain list: "erg fout"'


@pytest.mark.parametrize("budget", [1, 7, 20, 33])
def test_budget_keeps_the_first_errors(delivery, contract, budget):
    every = checks.failures(delivery, contract).collect()
    order = sorted(every, key=lambda r: (r.phase, r["column"], r["row"], r.element))
    kept, total, cut = checks.within_budget(checks.failures(delivery, contract), budget)
    assert cut and total == len(every)
    key = lambda r: (r["row"], r["column"], r.error_code, r.message)
    assert sorted(map(key, kept.collect())) == sorted(map(key, order[:budget]))


def test_checks_do_not_depend_on_row_order(delivery, contract):
    one = checks.failures(delivery, contract).collect()
    two = checks.failures(delivery.orderBy(F.rand(7)).repartition(3), contract).collect()
    assert sorted(one) == sorted(two)


def test_headers(spark, files, contract, tmp_path):
    with pytest.raises(ContractError, match="not found"):
        delimited.accepted_names(["test_id", "unknown"], contract)
    with pytest.raises(ContractError, match="duplicate"):
        delimited.accepted_names(["test_id", "TEST id"], contract)
    # absent columns are allowed
    assert delimited.accepted_names([" Test-ID "], contract) == ["test_id"]


def test_encoding_delimiter_and_quotes(spark, tmp_path):
    contract = Contract.of(ContractColumn("a"), ContractColumn("b"))
    path = tmp_path / "latin.csv"
    path.write_bytes('a|b\n"caf\xe9 ""x"""|\n| y \n"NULL"|"p|q"\n'.encode("latin-1"))
    rows = delimited.read_delivery(spark, str(path), contract, sep="|", encoding="latin1").collect()
    assert sorted(map(tuple, rows)) == [("", " y "), ("NULL", "p|q"), ('café "x"', "")]


def test_line_breaks_in_cells(spark, tmp_path):
    contract = Contract.of(ContractColumn("a"), ContractColumn("b"))
    path = tmp_path / "lines.csv"
    path.write_text('a;b\n"one\ntwo";3\n')
    rows = delimited.read_delivery(spark, str(path), contract, multiline=True).collect()
    assert list(map(tuple, rows)) == [("one\ntwo", "3")]


def test_rows_are_numbered_in_file_order(spark, tmp_path):
    contract = Contract.of(ContractColumn("n"))
    for part in range(3):
        lines = "".join(f"{part * 1000 + i}\n" for i in range(1000))
        (tmp_path / f"part{part}.csv").write_text("n\n" + lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        raw = delimited.read_delivery(spark, str(tmp_path), contract, traced=True)
        # dropped rows leave no gaps
        kept = raw.where("cast(n as int) % 10 <> 3")
        rows = staging.number_rows(staging.stage(kept)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    expected = [n for n in range(3000) if n % 10 != 3]
    assert sorted((r.record_no, int(r.n)) for r in rows) == list(enumerate(expected, start=1))


def test_load_and_remove(spark, files, contract, tmp_path):
    load = lambda period, **more: load_delivery(
        spark, str(files / "data.csv"), contract, RULES, period, "2024-02-29", str(tmp_path), **more
    )
    first = load("2023-Q2")
    assert first.new and first.data.count() == 9
    row = first.ledger.first()
    assert (row.sequence, row.records, str(row.delivered_on)) == (1, 9, "2024-02-29")
    # what the ledger names is skipped unless forced, and then replaced
    assert not load("2023-Q2").new
    assert load("2023-Q2", force=True).data.count() == 9
    second = load("2023-Q3", max_errors=5)
    assert second.data.count() == 18
    assert second.quality.where("period = '2023-Q3'").count() == 5
    assert sorted(r.record_no for r in second.data.collect()) == list(range(1, 19))
    typed = {r.test_id: r for r in second.data.where("period = '2023-Q2'").collect()}
    assert typed[1].col_integer == -1 and typed[8].col_date is None and typed[8].check_null == ""
    assert str(typed[1].col_date) == "2024-12-31" and typed[9].col_decimal is None
    assert sorted((r.sequence, r.period) for r in second.ledger.collect()) == [(1, "2023-Q2"), (2, "2023-Q3")]
    kept = ledger.without_delivery(second.data, "2023-Q3")
    assert sorted(kept.collect()) == sorted(second.data.where("period = '2023-Q2'").collect())


def test_clean_and_repeated_loads(spark, tmp_path):
    """A first delivery without errors, one that was cut short, and removals."""
    contract = Contract.of(ContractColumn("id", "integer"), ContractColumn("day", "date"), source_code="C")
    source, root = tmp_path / "d.csv", str(tmp_path / "tables")
    load = lambda period, **more: load_delivery(spark, str(source), contract, CleaningRules(), period, "", root, **more)
    source.write_text("id;day\n1;2024-01-31\n")
    clean = load("2024-Q1")
    assert clean.new and clean.quality.count() == 0 and clean.data.count() == 1
    # cells that pass the checks and do not load are reported; a forced load of a clean one takes the reports away
    source.write_text("id;day\n99999999999;2024-19-39\n2;\n")
    bad = load("2024-Q2")
    assert sorted((r.row_number, r.column_name, r.quality_code) for r in bad.quality.collect()) == [(0, "day", 7), (0, "id", 7)]
    source.write_text("id;day\n5;2024-02-01\n")
    forced = load("2024-Q2", force=True)
    assert forced.quality.count() == 0 and sorted(r.id for r in forced.data.collect()) == [1, 5]
    assert sorted((r.sequence, r.period) for r in forced.ledger.collect()) == [(1, "2024-Q1"), (2, "2024-Q2")]
    with pytest.raises(ContractError):
        load("rubbish")
    # a forced load that is refused leaves the delivery that was there
    source.write_text("id;other\n")
    with pytest.raises(ContractError):
        load("2024-Q2", force=True)
    source.write_text("id;day\n6;\n")
    kept = load("2024-Q2")
    assert not kept.new and sorted(r.id for r in kept.data.collect()) == [1, 5]
    assert load("2024-Q2", force=True).new
    removed = {r.table: r.removed for r in remove_delivery(spark, root, contract, "2024-Q2").collect()}
    assert removed == {"ledger": 1, "data": 1, "quality": 0}
    assert load("2024-Q2").new and not load("2024-Q2").new
    source.write_text("")
    with pytest.raises(ContractError):
        load("2024-Q3")


def test_files_with_headers_of_their_own(spark, tmp_path):
    """Columns in another order, rows that are too long or too short: in batch and as files land."""
    contract = Contract.of(ContractColumn("a", "integer"), ContractColumn("b", "text"), source_code="C")
    landing = tmp_path / "in"
    landing.mkdir()
    (landing / "one.csv").write_text("a;b\n1;x\n2;y;more;cells\n3\n")
    (landing / "two.csv").write_text("B;A\nhello;4\nworld;five\n")
    rows = delimited.read_delivery(spark, str(landing), contract, ragged=True).collect()
    assert {(r.a, r.b) for r in rows} == {("1", "x"), ("2", "y"), ("3", ""), ("4", "hello"), ("five", "world")}
    assert {r._ragged for r in rows} == {None, "2;y;more;cells", "3"}
    loaded = load_delivery(spark, str(landing), contract, CleaningRules(), "2024-Q1", "", str(tmp_path / "t"))
    assert sorted(r.quality_code for r in loaded.quality.collect()) == [6, 7, 7]
    check_landing(spark, str(landing), str(tmp_path / "out"), contract, CleaningRules(), row="b").awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out/failures")).collect()
    assert sorted((r["row"], r.error_code) for r in found) == [("", 7), ("world", 6), ("y", 7)]
    (landing / "three.csv").write_text("b\nz\n")
    check_landing(spark, str(landing), str(tmp_path / "out"), contract, CleaningRules(), row="b").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/failures")).count() == 3
    # files under headers of their own kind, and an empty one, are failures; the file beside them is checked
    (landing / "four.csv").write_text("a;other\n1;2\n")
    (landing / "five.csv").write_text("a;b\nx;five\n")
    (landing / "six.csv").write_text("a;A\n1;2\n")
    check_landing(spark, str(landing), str(tmp_path / "out"), contract, CleaningRules(), row="b").awaitTermination()
    (landing / "empty.csv").write_text("\n")
    check_landing(spark, str(landing), str(tmp_path / "out"), contract, CleaningRules(), row="b").awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out/failures")).where("row is null or row = 'five'").collect()
    assert sorted((r["row"] or "", r.file.split("/")[-1], r.error_code) for r in found) == [
        ("", "empty.csv", 7), ("", "four.csv", 7), ("", "six.csv", 7), ("five", "five.csv", 6),
    ]


def test_unchecked_delivery(spark, files, contract, tmp_path):
    loaded = load_delivery(
        spark, str(files / "data.csv"), contract, RULES, "2023-Q2", "", str(tmp_path), data_check=False
    )
    assert sorted(r.quality_code for r in loaded.quality.collect()) == [-3, -1]
    assert loaded.ledger.first().delivered_on is None


def test_drop_delivery_from_catalogue_tables(spark):
    rows = spark.range(10).withColumn("period", F.when(F.col("id") < 4, "2023-Q1").otherwise("2023-Q2"))
    rows.write.partitionBy("period").saveAsTable("drop_me")
    removed = ledger.drop_delivery(spark, ["drop_me"], "2023-Q1").collect()
    assert [tuple(r) for r in removed] == [("drop_me", 4)]
    assert [r.id for r in spark.table("drop_me").orderBy("id").collect()] == [4, 5, 6, 7, 8, 9]


def test_delivery_note_is_required(spark):
    schema = "supplier string, period string, source_code string, first boolean"
    declared = spark.createDataFrame([("s", "Q", "C")], "supplier string, frequency string, source_code string")
    judge = lambda *note: ledger.note_verdicts(spark.createDataFrame([note], schema), declared)
    ledger.require_accepted(judge("s", "2023-Q1", "C", False))
    ledger.require_accepted(judge("s", "2023-I", "C", True))
    for note in (("s", "2023-M1", "C", False), ("s", "2023-I", "C", False), ("s", "2023-Q1", "D", True)):
        with pytest.raises(ContractError):
            ledger.require_accepted(judge(*note))


def test_sql_templates_need_known_tables(spark):
    with pytest.raises(ContractError):
        ledger.run_templates(spark, {"x": "SELECT 1 FROM {table}"}, ["other"], ["known"])


def test_many_columns(spark):
    """More checks than bits in one mask."""
    columns = [ContractColumn(f"c{i}", "integer", "", f"0:{i}") for i in range(80)]
    contract = Contract.of(*columns)
    value = lambda row, i: "x" if (row + i) % 41 == 0 else str((row * 7 + i) % 90)
    rows = [(row, *[value(row, i) for i in range(80)]) for row in range(20)]
    frame = spark.createDataFrame(rows, "row long, " + ", ".join(f"c{i} string" for i in range(80)))
    expected = []
    for row in range(20):
        for i in range(80):
            cell = value(row, i)
            if cell == "x":
                expected.append((row, i, 6, 'Datatype not integer, value found is "x"'))
            if cell == "x" or int(cell) > i:
                expected.append((row, i, 3, f"Value {cell} exceeds min 0 or max {i}"))
    found = checks.failures(frame, contract).collect()
    assert sorted((r["row"], r["column"], r.error_code, r.message) for r in found) == sorted(expected)


def test_loads_become_visible_at_once(spark, tmp_path, monkeypatch):
    """A forced load that is cut short at each of its writes leaves the old delivery complete."""
    contract = Contract.of(ContractColumn("id", "integer", key="PRIMARY KEY"), ContractColumn("day", "date"), source_code="C")
    source, root = tmp_path / "d.csv", str(tmp_path / "tables")
    load = lambda period, **more: load_delivery(spark, str(source), contract, CleaningRules(), period, "", root, **more)
    source.write_text("id;day\n1;2024-01-31\n1;x\n")
    load("2024-Q1")
    source.write_text("id;day\n7;\n8;\n9;\n")
    state = lambda: {name: sorted(map(str, rows.collect())) for name, rows in stored_tables(spark, root, contract).items()}
    before, calls = state(), 0

    class Cut(Exception):
        pass

    for name in ("write_data", "write", "publish"):
        def cut(self, *args, name=name, **more):
            nonlocal calls
            calls += 1
            if name == "write_data":  # the rows are there, but nothing names them
                DeliveryTables.write(self, args[0], args[1], "data", args[2])
            raise Cut

        with monkeypatch.context() as patch:
            patch.setattr(DeliveryTables, name, cut)
            with pytest.raises(Cut):
                load("2024-Q1", force=True)
        assert state() == before
    assert calls == 3
    # repeated, it takes the old one's place; keys are met across periods, of visible loads only
    assert load("2024-Q1", force=True).data.count() == 3 and load("2024-Q1").ledger.first().sequence == 1
    source.write_text("id;day\n1;\n8;\n9;\n9;\n")
    assert sorted(r.record_no for r in load("2024-Q2").data.collect()) == [1, 2, 3, 4, 5, 6, 7]
    found = {tuple(r) for r in DeliveryTables(spark, root, contract).repeated_keys("2024-Q2").collect()}
    assert found == {(8, 2, 2), (9, 3, 2)}
    remove_delivery(spark, root, contract, "2024-Q1")
    assert [tuple(r) for r in DeliveryTables(spark, root, contract).repeated_keys("2024-Q2").collect()] == [(9, 2, 1)]


def test_runs_go_on_after_a_refusal(spark, tmp_path):
    contract = Contract.of(ContractColumn("id", "integer", key="PRIMARY KEY"), source_code="C", frequency="Q")
    source = tmp_path / "d.csv"
    source.write_text("id\n1\n2\n")
    notes = [
        Delivery(str(tmp_path / "missing.csv"), "2024-Q1", "C"), Delivery(str(source), "2024-Q1", "C"),
        Delivery(str(tmp_path / "no table"), "2024-I", "C", first=True, table=True, options={"name": "t"}), Delivery(str(source), "2024-Q2", "C"),
    ]
    supplies = [Supply(name, "p", contract, CleaningRules(), str(tmp_path / name), notes) for name in ("one", "two")]
    rows = [tuple(r) for r in run_supplies(spark, supplies).orderBy("supplier", "place").collect()]
    for name in ("one", "two"):
        assert [r[2:] for r in rows if r[0] == name] == [
            (0, "2024-Q1", "refused", "PATH_NOT_FOUND", 0, 0, 0), (1, "2024-Q1", "loaded", None, 2, 0, 0),
            (2, "2024-I", "refused", "PATH_NOT_FOUND", 0, 0, 0), (3, "2024-Q2", "loaded", None, 2, 0, 2),
        ]
