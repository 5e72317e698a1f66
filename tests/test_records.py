"""Files with line breaks inside cells: split reading against Spark's reader of whole files and Python's."""

import csv
import io
import random

import pytest

from tallyport.contract import Contract, ContractColumn, ContractError
from tallyport.operators import checks
from tallyport.sources import delimited, staging

CONTRACT = Contract.of(ContractColumn("a"), ContractColumn("b"), ContractColumn("c"))
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


@pytest.fixture(params=["40", "333", "1000000"])
def split(spark, request):
    old = spark.conf.get(SPLIT_BYTES)
    spark.conf.set(SPLIT_BYTES, request.param)
    yield int(request.param)
    spark.conf.set(SPLIT_BYTES, old)


def hard_cells(rng, rows):
    pieces = ["x", "\n", "\n\n", "\r\n", '"', '""', ";", '";"', "\n;", " ", "é", "long " * 12]
    return [tuple("".join(rng.choices(pieces, k=rng.randrange(5))) or "k" for _ in "abc") for _ in range(rows)]


def delivered(rows, header=("a", "b", "c"), end="\n"):
    out = io.StringIO(newline="")
    csv.writer(out, delimiter=";", lineterminator=end).writerows([header, *rows])
    return out.getvalue()


def ordered(spark, path, **options):
    raw = delimited.read_delivery(spark, str(path), CONTRACT, traced=True, multiline=True, **options)
    rows = staging.number_rows(staging.stage(raw), "n", start=0).orderBy("n").collect()
    assert [r.n for r in rows] == list(range(len(rows)))
    return [(r.a, r.b, r.c) for r in rows]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_cells_of_every_kind(spark, tmp_path, split, end):
    rows = hard_cells(random.Random(split), 60)
    path = tmp_path / "delivery.csv"
    path.write_bytes(delivered(rows, end=end).encode())
    assert ordered(spark, path) == rows
    if end == "\n":  # Spark changes breaks inside cells to those between rows
        whole = delimited.text_frame(spark, str(path), ["a", "b", "c"], multiline=True).collect()
        assert sorted(map(tuple, whole)) == sorted(rows)
    lines = spark.read.option("lineSep", "\n").text(str(path))
    assert lines.rdd.getNumPartitions() > 1 or split > 10_000


def test_several_files_and_headers(spark, tmp_path, split):
    rng = random.Random(3)
    one, two, three = (hard_cells(rng, 25) for _ in range(3))
    (tmp_path / "one.csv").write_bytes(b"\xef\xbb\xbf\n\n" + delivered(one).encode())
    (tmp_path / "two.csv").write_bytes(delivered(two).encode())
    turned = [(r[2], r[0]) for r in three]
    (tmp_path / "zed.csv").write_bytes(delivered(turned, header=("C ", '"A"')).encode())
    (tmp_path / "empty.csv").write_bytes(b"")
    got = delimited.read_delivery(spark, str(tmp_path), CONTRACT, multiline=True).select("a", "b", "c").collect()
    assert sorted(map(tuple, got)) == sorted([*one, *two, *[(r[0], "", r[2]) for r in three]])


def test_quotes_that_open_nothing_or_never_close(spark, tmp_path, split):
    """A quote inside a plain cell is a character; an open cell at the end of a file keeps to its own line."""
    path = tmp_path / "odd.csv"
    lines = ["a;b;c", '5" disk;x"y;"q"', '"a"b;2;3', '1;"two', 'lines";3', '7;8;"never closed', *[f"r{i};s;t" for i in range(30)]]
    path.write_text("\n".join(lines) + "\n")
    got = ordered(spark, path)
    assert got[0] == ('5" disk', 'x"y', "q") and got[2] == ("1", "two\nlines", "3")
    assert got[3][:2] == ("7", "8") and got[4:] == [(f"r{i}", "s", "t") for i in range(30)]


def test_rows_of_other_lengths_and_no_header(spark, tmp_path, split):
    path = tmp_path / "rows.csv"
    path.write_bytes('\ufeffx;"1\n2";z\n\n;"p\n"\n1;2;3;4\r\n'.encode())
    rows = delimited.read_delivery(spark, str(path), CONTRACT, header=False, multiline=True, ragged=True, traced=True)
    numbered = staging.number_rows(staging.stage(rows), "row", start=0)
    assert [(r.a, r.b, r.c) for r in numbered.orderBy("row").collect()] == [("x", "1\n2", "z"), ("", "p\n", ""), ("1", "2", "3")]
    assert sorted(r.row for r in checks.ragged_rows(numbered, delimited.RAGGED).collect()) == [1, 2]


def test_latin_letters_and_nothing_at_all(spark, tmp_path, split):
    path = tmp_path / "latin.csv"
    path.write_bytes('a|b|c\n"caf\xe9\n""x"""|\xfc|\n'.encode("latin-1"))
    got = delimited.read_delivery(spark, str(path), CONTRACT, sep="|", encoding="latin1", multiline=True).collect()
    assert list(map(tuple, got)) == [('caf\xe9\n"x"', "\xfc", "")]
    blank = tmp_path / "blank.csv"
    blank.write_text("\n\n")
    with pytest.raises(ContractError, match="no header"):
        delimited.read_delivery(spark, str(blank), CONTRACT, multiline=True)
