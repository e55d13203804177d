from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata import columns, preview, schema


def test_artifacts_go_by_exact_name(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "_c0 int, `Unnamed: 0` int, index int, a int, INDEX2 int")
    assert columns.drop_artifacts(df).columns == ["a", "INDEX2"]
    both = spark.createDataFrame([(1, 2)], "x int, y int").toDF("index", "Index")
    assert columns.drop_artifacts(both).columns == ["Index"]
    assert columns.drop_artifacts(both).first()[0] == 2


def test_flag_on_numbers_and_null(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (-1,)], "Survived int")
    got = [r["S"] for r in columns.flag(df, "Survived", "S", 1, "yes", "no").collect()]
    assert got == ["yes", "no", "no", "no"]


@pytest.mark.parametrize(
    "text, hit",
    [("1", True), (" 1 ", True), ("1.0", True), ("1.9", True), ("01", True), ("unknown", False), ("", False), (None, False), ("10", False)],
)
def test_flag_on_text(spark, text, hit):
    df = spark.createDataFrame([(text,)], "Survived string")
    assert columns.flag(df, "Survived", "S", 1, True, False).first()["S"] is hit


def test_flag_on_other_types(spark):
    df = spark.createDataFrame([(True, 1.0, "a")], "b boolean, d double, s string")
    out = columns.flag(columns.flag(columns.flag(df, "b", "fb", 1, 1, 0), "d", "fd", 1, 1, 0), "s", "fs", "a", 1, 0)
    assert tuple(out.first())[3:] == (1, 1, 1)


def test_flag_needs_the_exact_column(spark):
    df = spark.createDataFrame([(1,)], "survived int")
    assert columns.flag(df, "Survived", "S", 1, "yes", "no").columns == ["survived"]


def test_stamp_is_one_value_per_query(spark):
    df = columns.stamp(spark.range(1000, numPartitions=8), "at")
    assert df.columns == ["id", "at"]
    assert df.select("at").distinct().count() == 1
    fixed = columns.stamp(spark.range(1), "at", "2031-03-08 16:05:00")
    assert fixed.select(F.col("at").cast("string")).first()[0] == "2031-03-08 16:05:00"


def test_schema_rows(spark):
    df = spark.createDataFrame([], "a int, `b.c` string, d array<bigint>")
    rows = [tuple(r) for r in schema.describe(df).orderBy("position").collect()]
    assert rows == [(1, "a", "IntegerType()"), (2, "b.c", "StringType()"), (3, "d", "ArrayType(LongType(), True)")]


def test_previews(spark):
    df = spark.createDataFrame([(i, -i) for i in range(20)], "a int, `b.c` int")
    assert preview.peek(df, ["b.c"], 3, order_by=["b.c"]).collect()[0][0] == -19
    assert preview.peek(df).count() == 5
    head = preview.column_head(df, 1).collect()
    assert [tuple(r) for r in head] == [(1, "a", 1)]
    assert preview.column_head(df).first()["n_more"] == 0
