"""Column types found in the pass that parses the cells, and files whose headers differ."""

from __future__ import annotations

import gzip
import itertools
import random

import pytest
from pyspark.sql import functions as F

from strata import session, sources
from strata.sources import cells

CELLS = [
    "1", "-5", "+7", "007", "2147483648", "-9223372036854775808", "9223372036854775808", "12345678901234567890123", "1" * 39, "1.5", "1e5",
    ".5", "5.", " 5", "NaN", "Inf", "-Inf", "true", "FALSE", "yes", "2024-01-02", "2024-02-30", "2024-01-02 03:04:05", "2024-01-02T03:04:05.123Z",
    "x", "", "-", "1-2",
]


def written(folder, texts):
    folder.mkdir()
    for k, text in enumerate(texts):
        (folder / f"{k}.csv").write_text(text)
    return str(folder)


def theirs(spark, path):
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def test_types_are_those_of_sparks_inference(spark, tmp_path):
    """Every cell alone, and columns of two and three kinds."""
    pick = random.Random(3)
    columns = [[cell] for cell in CELLS] + pick.sample([list(pair) for pair in itertools.combinations(CELLS, 2)], 72)
    columns += [pick.sample(CELLS, 3) for _ in range(20)]
    for lo in range(0, len(columns), 40):
        some = [c + [""] * (3 - len(c)) for c in columns[lo : lo + 40]]
        text = ",".join(f"c{i}" for i in range(len(some))) + ",z\n" + "".join(",".join(c[k] for c in some) + ",z\n" for k in range(3))
        path = written(tmp_path / f"t{lo}", [text])
        mine, other = cells.typed_once(spark.read.option("header", True).csv(path)), theirs(spark, path)
        assert [(c, m, o) for c, (_, m), (_, o) in zip(some, mine.dtypes, other.dtypes, strict=False) if m != o] == []
        assert [str(r) for r in mine.collect()] == [str(r) for r in other.collect()]


def test_states_merge_over_tasks(spark, tmp_path):
    """The cell that decides a type may stand in any file, whatever its header."""
    texts = ["a,b,c\n" + "1,2024-01-01,5\n" * 50 for _ in range(6)]
    texts[4] = "b,a,c\n2024-01-01 10:00:00,2.5,12345678901234567890\n"
    df = sources.read_csv(spark, written(tmp_path / "in", texts))
    assert df.dtypes == [("a", "double"), ("b", "timestamp"), ("c", "decimal(20,0)")] and df.count() == 251


def test_joined_files_are_parsed_once(spark, tmp_path):
    path = written(tmp_path / "in", ["a,b\n007,x\n", "b,a\ny,z\n"])
    df = sources.read_csv(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan.lower() and "csv" not in plan.lower()
    assert "c1" not in df.select("a")._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    (tmp_path / "in" / "0.csv").unlink()
    # A number that meets a text keeps its spelling.
    assert sorted(tuple(r) for r in df.collect()) == [("007", "x"), ("z", "y")]


def test_headers(spark, tmp_path):
    path = written(tmp_path / "a b", ["a,b\n1,2\n", "\n \na,b\n", "", "b\n"])
    with gzip.open(tmp_path / "a b" / "4.csv.gz", "wt") as file:
        file.write("b\n5\n")
    found = cells.headers(spark, path)
    assert {k: [name.rsplit("/", 1)[1] for name in v] for k, v in found.items()} == {"a,b": ["0.csv", "1.csv"], "b": ["3.csv", "4.csv.gz"]}


@pytest.mark.parametrize("malformed", ["fail", "keep"])
def test_files_are_joined_by_header(spark, tmp_path, malformed):
    path = written(tmp_path / "a b", ["a,b\n1,10\n", "b,a\n20,2\n", "b\nx\n", "c,a,b\n2024-01-01,3.5,30\n", "a,b\n"])
    df = sources.read_csv(spark, path, malformed=malformed)
    assert df.dtypes[:3] == [("a", "double"), ("b", "string"), ("c", "date")]
    assert {(r.a, r.b, str(r.c)) for r in df.collect()} == {(1, "10", "None"), (2, "20", "None"), (None, "x", "None"), (3.5, "30", "2024-01-01")}
    assert df.columns == ["a", "b", "c"] + ["_malformed"] * (malformed == "keep")


def test_files_are_joined_by_header_below_folders(spark, tmp_path):
    (tmp_path / "in").mkdir()
    written(tmp_path / "in" / "day=1", ["a,b\n1,10\n"])
    written(tmp_path / "in" / "day=2", ["b,a\n20,2\n"])
    df = sources.read_csv(spark, str(tmp_path / "in"))
    assert {(r.a, r.b, r.day) for r in df.collect()} == {(1, 10, 1), (2, 20, 2)}


def test_malformed_rows_of_joined_files(spark, tmp_path):
    path = written(tmp_path / "in", ["a,b\n1,10\n2\n", "b,a\n20,2,9\n"])
    with pytest.raises(Exception, match="(?i)malformed"):
        sources.read_csv(spark, path).collect()
    kept = sources.read_csv(spark, path, malformed="keep").collect()
    assert sorted(str(r["_malformed"]) for r in kept) == ["2", "20,2,9", "None"]


def test_without_a_shared_folder_other_headers_are_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("strata.sources.files.has_scratch", lambda _: False)
    path = written(tmp_path / "in", ["a,b\n1,10\n", "b,a\n20,2\n"])
    for malformed in ("fail", "keep"):
        with pytest.raises(ValueError, match="differ in their header"):
            sources.read_csv(spark, path, malformed=malformed)
    assert [tuple(r) for r in sources.read_csv(spark, f"{path}/0.csv").collect()] == [(1, 10)]


def test_scratch_needs_a_shared_folder(spark):
    assert session.has_scratch(spark)


def test_kinds(spark):
    df = spark.createDataFrame([(None,), ("",), ("0" * 50 + "7",)], "c string")
    assert [r[0] for r in df.select(cells.kind(F.col("c"))).collect()] == [0, 0, cells.INT]
    assert cells.merged(None, None).simpleString() == cells.merged(0, 3).simpleString() == "string"
