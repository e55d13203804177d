"""Replacing a table without a gap, and unions of files whose types differ."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import layers, tables
from strata.plans.config import LayerConfig
from strata.sources import widen


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def beside(path):
    return sorted(n for n in os.listdir(os.path.dirname(path)) if n.startswith("."))


def failing(spark, at):
    stop = F.when(F.col("id") == at, F.raise_error(F.lit("stopped midway"))).otherwise(F.col("id"))
    return spark.range(0, 1000, 1, 8).select(stop.cast("bigint").alias("id"), (F.col("id") % 3).alias("part"))


@pytest.mark.parametrize("part", [None, "part"])
def test_a_failing_writer_leaves_the_former_rows(spark, root, part):
    path = f"{root}/layer"
    tables.write_layer(spark.range(5).select("id", F.lit(7).cast("bigint").alias("part")), path, partition_by=part)
    before = rows(tables.read_layer(spark, path))
    with pytest.raises(Exception, match="stopped midway"):
        tables.write_layer(failing(spark, 990), path, partition_by=part)
    assert rows(tables.read_layer(spark, path)) == before and not beside(path)
    tables.write_layer(failing(spark, -1), path, partition_by=part)
    assert tables.read_layer(spark, path).count() == 1000 and not beside(path)


def test_gold_keeps_its_rows_when_its_writer_fails(spark, passengers, root, monkeypatch):
    config = LayerConfig()
    layers.run(spark, passengers, root, "one", config)
    gold = layers.layer_path(root, "gold")
    before = rows(tables.read_layer(spark, gold))
    broken = layers.enrich
    monkeypatch.setattr(layers, "enrich", lambda df, c: broken(df, c).withColumn("Fare", F.raise_error(F.lit("stopped midway")).cast("double")))
    with pytest.raises(Exception, match="stopped midway"):
        layers.gold(spark, root, "two", config)
    assert rows(tables.read_layer(spark, gold)) == before


def test_a_swap_cut_off_is_finished_by_the_next_reader_or_writer(spark, root):
    path = f"{root}/layer"
    tables.write_layer(spark.range(3).toDF("id"), path)
    spark.range(9).toDF("id").write.parquet(f"{root}/.layer.ready-x")
    # Lost before the first rename: the former table is still there, and the next writer goes on from the new one.
    assert tables.read_layer(spark, path).count() == 3
    # Lost between the two: a reader puts the new table in place.
    os.rename(path, f"{root}/.layer.old-x")
    assert tables.read_layer(spark, path).count() == 9 and beside(path) == [".layer.old-x"]
    spark.range(2).toDF("id").write.parquet(f"{root}/.layer.new-y")
    tables.write_layer(spark.range(4).toDF("id"), path)
    assert tables.read_layer(spark, path).count() == 4 and not beside(path)
    os.rename(path, f"{root}/.layer.old-z")
    tables._settle(spark, path)
    assert tables.read_layer(spark, path).count() == 4 and not beside(path)


def test_what_is_written_is_hidden_from_scans(spark, root):
    tables.write_layer(spark.range(3).toDF("id"), f"{root}/stream=a/batch_id=1")
    spark.range(9).toDF("id").write.parquet(f"{root}/stream=a/.batch_id=2.new-x")
    assert tables.scan_files(spark, root).count() == 3


@pytest.mark.parametrize(
    "a, b, wide",
    [
        ("int", "double", "double"), ("tinyint", "bigint", "bigint"), ("bigint", "decimal(5,2)", "decimal(21,2)"), ("float", "double", "double"),
        ("decimal(38,0)", "decimal(10,5)", "double"), ("date", "timestamp", "timestamp"), ("int", "string", "string"), ("boolean", "int", "string"),
        ("void", "int", "int"), ("array<int>", "array<double>", "array<double>"), ("struct<a:int>", "struct<A:double,b:int>", "struct<a:double,b:int>"),
        ("struct<a:int>", "string", "string"), ("map<string,int>", "map<string,bigint>", "map<string,bigint>"), ("float", "bigint", "double"),
    ],
)
def test_wider_types(a, b, wide):
    one, two = T._parse_datatype_string(a), T._parse_datatype_string(b)
    assert widen.wider(one, two).simpleString() == wide
    assert widen.wider(two, one).simpleString().lower().replace("A:", "a:").startswith(wide[:6])


def test_union_widened(spark):
    one = spark.createDataFrame([(1, "x", (1, [1]), None)], "k int, `a.b` string, s struct<n:int,l:array<int>>, t struct<n:int>")
    two = spark.createDataFrame([(2.5, 7, (1.5, "y"), "z")], "K double, `a.b` int, s struct<n:double,o:string>, t string")
    three = spark.createDataFrame([((3,),)], "t struct<n:int>")
    out = widen.union_widened([one, two, three])
    assert out.dtypes == [("k", "double"), ("a.b", "string"), ("s", "struct<n:double,l:array<int>,o:string>"), ("t", "string")]
    assert [tuple(r) for r in out.collect()] == [(1.0, "x", (1.0, [1], None), None), (2.5, "7", (1.5, None, "y"), "z"), (None, None, None, '{"n":3}')]
    found = {r["column"]: (r["types"], r["merged"]) for r in widen.clashes([one, two, three]).collect()}
    assert found["k"] == (["int", "double"], "double") and set(found) == {"k", "a.b", "s", "t"}


def test_scan_of_files_that_clash(spark, root):
    path = f"{root}/a b"
    for k, kind in enumerate(["int", "double", "string", "int"]):
        spark.range(2).select(F.lit(k).cast(kind).alias("v"), F.col("id").alias(f"only{k}")).write.mode("append").parquet(f"{path}/day={k}")
    with pytest.raises(Exception, match="(?i)merg"):
        tables.scan_files(spark, path)
    df = tables.scan_files(spark, path, f"{root}/absent", widened=True)
    assert df.schema["v"].dataType == T.StringType() and df.count() == 8
    assert {(r.v, r.day) for r in df.collect()} == {("0", 0), ("1.0", 1), ("2", 2), ("3", 3)}
    assert [(r["column"], sorted(r["types"])) for r in tables.type_clashes(spark, path).collect()] == [("v", ["double", "int", "string"])]
    assert tables.scan_files(spark, f"{root}/absent", widened=True).count() == 0
