from __future__ import annotations

import pytest
from pyspark.sql import types as T

from strata import sources


def types(df):
    return {f.name: f.dataType.simpleString() for f in df.schema}


def test_awkward_csv_header_and_types(spark, tmp_path):
    path = tmp_path / "awkward.csv"
    path.write_text(
        ",Unnamed: 0,a,big,huge,dt,ts,b,n,e,a\n"
        "0,0,1,3000000000,12345678901234567890,2024-01-02,2024-01-02 03:04:05,true,NaN,,7\n"
        "1,1,2,3000000001,12345678901234567891,2024-01-03,2024-01-03 03:04:05,false,1.5,,8\n"
    )
    got = types(sources.read_csv(spark, str(path)))
    assert got == {
        "_c0": "int",
        "Unnamed: 0": "int",
        "a2": "int",
        "big": "bigint",
        "huge": "decimal(20,0)",
        "dt": "date",
        "ts": "timestamp",
        "b": "boolean",
        "n": "double",
        "e": "string",
        "a10": "int",
    }


def test_header_only_csv_is_empty_text(spark, tmp_path):
    path = tmp_path / "empty.csv"
    path.write_text("a,b.c\n")
    df = sources.read_csv(spark, str(path))
    assert df.count() == 0
    assert types(df) == {"a": "string", "b.c": "string"}


def test_json_array_file(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text(
        '[{"a":1,"b":{"c":[1,2]},"d":"2024-01-01","m":null},\n {"a":2.5,"b":null,"d":"x","z":true}]'
    )
    df = sources.read_source(spark, str(path))
    assert types(df) == {
        "a": "double",
        "b": "struct<c:array<bigint>>",
        "d": "string",
        "m": "string",
        "z": "boolean",
    }
    assert df.count() == 2


def test_json_lines_need_the_lines_option(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('{"a":1}\n{"a":2}\n{"a":3}\n')
    with pytest.raises(ValueError, match="more than one JSON value"):
        sources.read_json(spark, str(path))
    assert sources.read_json(spark, str(path), lines=True).count() == 3


@pytest.mark.parametrize("text", ['{"a":1}{"a":2}', '[{"a":1}]\n[{"a":2}]', '{"a":"x\\"}{"}\n\n {"a":"y"}'])
def test_several_json_values_are_refused(spark, tmp_path, text):
    path = tmp_path / "rows.json"
    path.write_text(text)
    with pytest.raises(ValueError, match="lines=True"):
        sources.read_source(spark, str(path))


def test_brackets_within_texts_are_no_values(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('[{"a":"} {","b":[[1],[2]]},\n{"a":"]\\"[","b":[]}]')
    assert [r["a"] for r in sources.read_source(spark, str(path)).collect()] == ["} {", ']"[']


AB = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def test_declared_schema_follows_the_header(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("b,a\nx,1\n")
    assert [tuple(r) for r in sources.read_csv(spark, str(path), AB).collect()] == [(1, "x")]
    path.write_text("B\ny\n")
    assert [tuple(r) for r in sources.read_csv(spark, str(path), AB).collect()] == [(None, "y")]
    path.write_text("b,a,c\nx,1,2\n")
    with pytest.raises(ValueError, match=r"not in the declared schema: \['c'\]"):
        sources.read_csv(spark, str(path), AB)


def test_files_with_other_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,x\n")
    (folder / "2.csv").write_text("b,a\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_csv(spark, str(folder), AB).collect()


@pytest.mark.parametrize("rows", ["xx,y\n", "3\n", "3,y,z\n"])
def test_malformed_csv_rows_fail_or_are_marked(spark, tmp_path, rows):
    path = tmp_path / "rows.csv"
    path.write_text("a,b\n1,x\n" + rows)
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_csv(spark, str(path), AB).collect()
    kept = sources.read_csv(spark, str(path), AB, malformed="keep").collect()
    assert [r["_malformed"] for r in kept] == [None, rows.strip()]
    with pytest.raises(ValueError, match="fail or to keep"):
        sources.read_csv(spark, str(path), AB, malformed="drop")


def test_malformed_json_fails_or_is_marked(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('{"a":1,"b":"x"}\n{"a":"q"}\n{"a":3,\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_json(spark, str(path), AB, lines=True).collect()
    kept = sources.read_json(spark, str(path), AB, lines=True, malformed="keep").collect()
    assert [(r["a"], r["_malformed"] is None) for r in kept] == [(1, True), (None, False), (None, False)]
    whole = tmp_path / "cut.json"
    whole.write_text('[{"a":1,"b":"x"},{"a":')
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_json(spark, str(whole), AB).collect()


def test_truncated_json_is_refused(spark, tmp_path):
    path = tmp_path / "cut.json"
    path.write_text('{"a":1,')
    with pytest.raises(ValueError, match="no readable JSON"):
        sources.read_json(spark, str(path))


@pytest.mark.parametrize(
    "name, json", [("a.json", True), ("A.JSON", True), ("a.csv", False), ("a.txt", False), ("json", False)]
)
def test_reader_follows_the_name(name, json):
    assert sources.is_json(name) is json


def test_declared_schema_is_kept(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text("a,b\n01,x\n")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    assert sources.read_csv(spark, str(path), schema).first()["a"] == "01"


def test_name_validation(spark):
    names = spark.createDataFrame([("a.csv",), ("B.CSV",), ("c.json",), (None,), ("csv",)], "file_name string")
    strict = {r["file_name"]: r["valid"] for r in sources.validate_names(names).collect()}
    assert strict == {"a.csv": True, "B.CSV": True, "c.json": False, None: False, "csv": False}
    both = {r["file_name"]: r["valid"] for r in sources.validate_names(names, (".csv", ".json")).collect()}
    assert both["c.json"] is True
