from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import session, tables


def schema(text):
    return T._parse_datatype_string(text)


def test_conform_fills_missing_and_orders_by_target(spark):
    df = spark.createDataFrame([(1, "x")], "B int, a string")
    out = tables.conform(df, schema("a string, b int, c double"))
    assert out.columns == ["a", "b", "c"]
    assert tuple(out.first()) == ("x", 1, None)


def test_conform_refuses_extra_columns_unless_merging(spark):
    df = spark.createDataFrame([(1, "x")], "a int, extra string")
    with pytest.raises(ValueError, match="extra"):
        tables.conform(df, schema("a int"))
    assert tables.conform(df, schema("a int, gone date"), merge=True).columns == ["a", "gone", "extra"]


@pytest.mark.parametrize(
    "given, wanted, fits",
    [
        ("smallint", "int", True),
        ("int", "smallint", False),
        ("int", "bigint", False),
        ("string", "int", False),
        ("double", "float", False),
        ("decimal(5,2)", "decimal(5,2)", True),
        ("array<int>", "array<int>", True),
        ("array<string>", "array<int>", False),
    ],
)
def test_conform_types(spark, given, wanted, fits):
    df = spark.createDataFrame([(None,)], f"a {given}")
    if fits:
        assert tables.conform(df, schema(f"a {wanted}")).schema["a"].dataType.simpleString() == wanted
    else:
        with pytest.raises(ValueError, match="does not fit"):
            tables.conform(df, schema(f"a {wanted}"))


def test_conform_nested_fields(spark):
    df = spark.createDataFrame(
        [((1, "x"), [(1, "y")]), (None, None)], "s struct<a:int,n:string>, l array<struct<a:int,n:string>>"
    )
    target = schema("s struct<a:int,old:int>, l array<struct<a:int,old:int>>")
    with pytest.raises(ValueError, match="fields not in"):
        tables.conform(df, target)
    out = tables.conform(df, target, merge=True)
    first, second = out.collect()
    assert first["s"].asDict() == {"a": 1, "old": None, "n": "x"}
    assert first["l"][0].asDict() == {"a": 1, "old": None, "n": "y"}
    assert second["s"] is None and second["l"] is None


def test_conform_twice_changes_nothing(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "`a.b` int, `c``d` string, e double")
    target = schema("e double, `a.b` int")
    once = tables.conform(df, target, merge=True)
    twice = tables.conform(once, once.schema, merge=True)
    assert once.schema == twice.schema and once.collect() == twice.collect()


def test_null_typed_column_takes_the_target_type(spark):
    df = spark.range(1).select(F.lit(None).alias("a"))
    assert tables.conform(df, schema("a double")).schema["a"].dataType == T.DoubleType()


def test_partition_text_survives_with_the_written_schema(spark, root):
    df = spark.createDataFrame([("01", 1), ("1.0", 2), (None, 3)], "p string, v int").select("p", "v")
    written = tables.write_layer(df, root, partition_by="p")
    back = tables.read_layer(spark, root, schema=written)
    assert back.columns == ["p", "v"]
    assert sorted((r["v"], r["p"]) for r in back.collect()) == [(1, "01"), (2, "1.0"), (3, None)]
    tables.write_layer(df, root, partition_by="p")  # its own directory types are no obstacle
    assert tables.read_layer(spark, root, schema=written).count() == 3


def test_partition_column_is_optional(spark, root):
    tables.write_layer(spark.range(3).toDF("a"), root, partition_by="absent")
    assert tables.read_layer(spark, root).count() == 3


def test_hot_partition_value_is_split(spark, root):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("p"),
        F.sha2(F.col("id").cast("string"), 512).alias("v"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1m")
    try:
        spread = tables.spread_for_write(df.withColumn("p", F.when(F.col("p") == "hot", "hot").otherwise("rest")), "p")
        tables.write_layer(spread, root, partition_by="p")
    finally:
        spark.conf.set(size, before)
    files = [f for f in tables.read_layer(spark, root).inputFiles() if "p=hot" in f]
    assert len(files) > 1
    assert tables.read_layer(spark, root).count() == 200_000


def test_value_count_decides_on_gathering(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("few"), F.col("id").alias("many"))
    assert not tables.leaves_small_files(df, "few", 1)
    assert tables.leaves_small_files(df, "many", 1)
    # 100 GB are read by about 800 tasks: three values leave files of 42 MB each, below the bound of 64 MB.
    assert tables.leaves_small_files(df, "few", 100 << 30)
    assert not tables.leaves_small_files(df, "few", 100 << 30, least=32 << 20)


def test_many_splits_do_not_make_many_files(spark, root):
    spark.range(20_000).selectExpr("id", "cast(id % 16 as string) AS p").repartition(40).write.parquet(f"{root}/in")
    df = spark.read.parquet(f"{root}/in")
    stored = session.stored_bytes(spark, f"{root}/in")
    assert tables.leaves_small_files(df, "p", 100 * stored)
    tables.write_layer(tables.spread_for_write(df, "p"), f"{root}/out", partition_by="p")
    files = spark.read.parquet(f"{root}/out").select(F.col("_metadata.file_path")).distinct().count()
    assert files <= 16 * 4


def test_scan_files_unions_by_name(spark, root):
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(f"{root}/one")
    spark.createDataFrame([(2.5, True)], "a double, c boolean").write.parquet(f"{root}/two")
    out = tables.scan_files(spark, f"{root}/one", f"{root}/two", f"{root}/absent")
    assert set(out.columns) == {"a", "b", "c"}
    assert sorted(tuple(r[c] for c in "abc") for r in out.collect()) == [(1.0, "x", None), (2.5, None, True)]


def test_scan_files_merges_below_one_path_and_keeps_partitions(spark, root):
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(f"{root}/k=1")
    spark.createDataFrame([(2, True)], "a int, c boolean").write.parquet(f"{root}/k=2")
    out = tables.scan_files(spark, root)
    assert set(out.columns) == {"a", "b", "c", "k"}
    assert out.count() == 2


def test_scan_files_with_a_declared_schema(spark, root):
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(f"{root}/k=1")
    spark.createDataFrame([(2, True)], "a int, c boolean").write.parquet(f"{root}/k=2")
    out = tables.scan_files(spark, root, schema=schema("a int, c boolean, k string"))
    assert sorted(tuple(r) for r in out.collect()) == [(1, None, "1"), (2, True, "2")]
    assert tables.scan_files(spark, f"{root}/absent", schema=schema("a int")).columns == ["a"]


def test_scan_files_without_data_is_empty(spark, root, tmp_path):
    (tmp_path / "void").mkdir()
    for path in (root, str(tmp_path / "void")):
        out = tables.scan_files(spark, path)
        assert (out.columns, out.count()) == ([], 0)


def test_scan_files_with_clashing_types(spark, root):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{root}/k=1")
    spark.createDataFrame([("x",)], "a string").write.parquet(f"{root}/k=2")
    with pytest.raises(Exception, match="MERGE"):
        tables.scan_files(spark, root)
    spark.createDataFrame([(2,)], "a int").write.parquet(f"{root}-other")
    skipped = []
    assert tables.scan_files(spark, root, f"{root}-other", strict=False, skipped=skipped).count() == 1
    assert skipped == [root]
    with pytest.raises(ValueError, match="list for the paths"):
        tables.scan_files(spark, root, strict=False)


def test_guard_does_not_list_files(spark, root, monkeypatch):
    tables.write_layer(spark.range(3).toDF("a"), f"{root}/one")
    tables.write_layer(spark.range(3).toDF("a"), f"{root}/two")
    monkeypatch.setattr(type(spark.range(1)), "inputFiles", lambda self: pytest.fail("it lists all files"))
    tables.write_layer(tables.read_layer(spark, f"{root}/one"), f"{root}/two")
    with pytest.raises(ValueError, match="cannot be overwritten"):
        tables.write_layer(tables.read_layer(spark, f"{root}/two").where("a > 1"), f"{root}/two")


def test_overwriting_the_table_being_read_is_refused(spark, root):
    tables.write_layer(spark.range(3).toDF("a"), root)
    with pytest.raises(ValueError, match="cannot be overwritten"):
        tables.write_layer(tables.read_layer(spark, root), root)
    assert tables.read_layer(spark, root).count() == 3
