"""The header rule: odd ends, and how often Spark evaluates it."""

from pyspark.sql import functions as F

from tallyport.functions import text

HEADERS = [" _9 a_b_ . ", "", "  ", "__", "9", "a__ _", "x_.", "Ab.C\n_\n", "_a", "Zé_é", "a_", "éé", "x  y", " A　", "a" + "_" * 40, "1_2_b."]


def test_ends_of_header_names(spark):
    rows = spark.createDataFrame(list(enumerate([*HEADERS, None])), "i int, c string")
    found = [r[0] for r in rows.orderBy("i").select(text.header_name(F.col("c"), F.col("i"))).collect()]
    assert found == [*text.header_names(HEADERS), f"col_{len(HEADERS)}"]


def test_a_header_is_replaced_once(spark, tmp_path, capsys):
    spark.createDataFrame([(1, "A b")], "i int, c string").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    rows.select(text.header_name(F.col("c"), F.col("i"))).explain("codegen")
    assert capsys.readouterr().out.count("Lower.exec") == 1
