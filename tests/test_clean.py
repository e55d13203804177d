from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from strata import clean, lookup, quality
from strata.plans.layers import refine, refine_counted
from strata.plans.config import LayerConfig

MATRIX = (
    "s string, i int, l bigint, f float, d double, sh smallint, ti tinyint, de decimal(5,2), b boolean, "
    "dt date, ts timestamp, ar array<int>, st struct<x:int>, fn float, dn double"
)
FULL = ("x", 1, 2, 1.5, 2.5, 3, 4, Decimal("1.25"), True, date(2024, 1, 1), datetime(2024, 1, 1), [1], (1,), 1.0, 2.0)
NAN = float("nan")


def test_fill_matrix(spark):
    empty = (None,) * 13 + (NAN, NAN)
    df = spark.createDataFrame([empty, FULL], MATRIX)
    first, second = clean.fill_nulls(df).collect()
    assert first["s"] == "unknown"
    assert [first[c] for c in ("i", "l", "f", "d", "fn", "dn")] == [0, 0, 0.0, 0.0, 0.0, 0.0]
    assert all(first[c] is None for c in ("sh", "ti", "de", "b", "dt", "ts", "ar", "st"))
    assert second == df.collect()[1]
    assert clean.fill_nulls(df).schema.simpleString() == df.schema.simpleString()


def test_null_counts_cover_every_type_but_not_nan(spark):
    df = spark.createDataFrame([(None,) * 13 + (NAN, NAN), FULL], MATRIX)
    counts = quality.null_counts(df).first().asDict()
    assert counts == {f.name: 0 if f.name in ("fn", "dn") else 1 for f in df.schema}
    assert quality.total_nulls(df).first()["total_nulls"] == 13


def test_odd_column_names(spark):
    df = spark.createDataFrame([(None, None, None), (1, "x", 2.0)], "`a.b` int, `c``d` string, `e f` double")
    assert clean.fill_nulls(df).collect()[0] == (0, "unknown", 0.0)
    assert clean.fill_nulls(df).columns == df.columns
    assert quality.null_counts(df).first().asDict() == {"a.b": 1, "c`d": 1, "e f": 1}
    assert clean.dedupe(df.union(df)).count() == 2
    assert quality.null_rows(df, "a.b").count() == 1


def test_columns_that_differ_in_case_only(spark):
    df = spark.createDataFrame([(None, 1)], "x int, y int").toDF("a", "A")
    assert tuple(clean.fill_nulls(df).first()) == (0, 1)
    assert tuple(quality.null_counts(df).first()) == (1, 0)


def test_equal_rows(spark):
    rows = [(None, NAN, 0.0), (None, NAN, -0.0), (1, 1.0, 1.0), (1, 1.0, 1.0), (1, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "a int, b double, c double")
    assert clean.dedupe(df).count() == 3
    assert tuple(clean.dedupe_stats(df).first()) == (5, 3, 2)
    assert clean.dedupe(df, ["a"]).count() == 2
    assert sorted(r["copies"] for r in clean.count_copies(df).collect()) == [1, 2, 2]


@pytest.mark.parametrize("max_rows", [1_000_000, 0])
def test_screened_copies_equal_the_plain_ones(spark, monkeypatch, max_rows):
    rows = [(None, 1, NAN), (1, None, NAN), (None, 1, NAN), (2, 2, 0.0), (2, 2, -0.0), (3, 3, 1.0), (3, 3, None)]
    df = spark.createDataFrame(rows * 3 + [(9, 9, 9.0)], "a int, `b.c` int, d double")
    fits = lookup.fits_broadcast
    monkeypatch.setattr(lookup, "fits_broadcast", lambda frame: fits(frame, max_rows))
    want = sorted(repr([str(v) for v in r]).replace("-0.0", "0.0") for r in clean.count_copies(df).collect())
    got = sorted(repr([str(v) for v in r]).replace("-0.0", "0.0") for r in clean.count_copies_screened(df).collect())
    assert got == want and len(got) == 6


def test_screened_stage_counts_the_same(spark):
    df = spark.createDataFrame([(i % 7, None, "x") for i in range(50)] + [(100 + i, 1.0, None) for i in range(50)], "a int, b double, c string")
    figures, kept = [], []
    for screen in (False, True):
        out, seen = refine_counted(df, LayerConfig(screen_duplicates=screen))
        kept.append(sorted(map(repr, out.collect())))
        figures.append(seen.get)
    assert kept[0] == kept[1] and len(kept[0]) == 57
    assert figures[0] == figures[1] and figures[0]["rows_before"] == 100


def test_stats_of_no_rows(spark):
    df = spark.createDataFrame([], "a int")
    assert tuple(clean.dedupe_stats(df).first()) == (0, 0, 0)
    assert quality.null_sums(df, ["a"]).first()["a"] is None
    assert quality.null_counts(df).first()["a"] == 0
    assert quality.total_nulls(df).first()[0] == 0


@pytest.mark.parametrize("dtype", ["map<string,int>", "struct<m:map<string,int>>", "array<map<string,int>>"])
def test_map_columns_are_refused(spark, dtype):
    df = spark.createDataFrame([(None,)], f"m {dtype}")
    with pytest.raises(ValueError, match="map columns"):
        clean.dedupe(df)


def test_key_check(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert tuple(quality.check_key(df, "k").first()) == ("key_not_null", "k", 1, "warning")
    assert quality.check_key(clean.fill_nulls(df), "k").first()["severity"] == "ok"
    assert quality.check_key(df, "K").count() == 0


SCHEMA = T.StructType(
    [
        T.StructField("a", T.IntegerType()),
        T.StructField("b", T.StringType()),
        T.StructField("c", T.DoubleType()),
        T.StructField("d", T.BooleanType()),
    ]
)
ROWS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(-2, 2)),
        st.one_of(st.none(), st.sampled_from(["", "x", "unknown"])),
        st.one_of(st.none(), st.sampled_from([0.0, 1.5, NAN])),
        st.one_of(st.none(), st.booleans()),
    ),
    max_size=30,
)


def plain(row):
    return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
def test_refining_properties(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    kept = clean.dedupe(df).collect()
    assert sorted(map(repr, map(plain, kept))) == sorted(map(repr, {plain(r) for r in rows}))
    assert clean.dedupe(spark.createDataFrame(kept, SCHEMA)).count() == len(kept)

    before, after, removed = clean.dedupe_stats(df).first()
    assert (before, after, removed) == (len(rows), len(kept), len(rows) - len(kept))

    filled = clean.fill_nulls(df).collect()
    for old, new in zip(df.collect(), filled):
        assert new["a"] == (old["a"] or 0) and new["d"] is old["d"]
        assert new["b"] == ("unknown" if old["b"] is None else old["b"])
        assert new["c"] == (0.0 if old["c"] is None or math.isnan(old["c"]) else old["c"])

    if rows:
        out, seen = refine_counted(df, LayerConfig())
        got = sorted(map(repr, map(plain, out.collect())))
        assert got == sorted(map(repr, map(plain, refine(df).collect())))
        figures = seen.get
        nulls = sum(v is None for row in kept for v in row)
        gaps = sum(row[i] is None or plain(row)[i] == "nan" for row in kept for i in range(3))
        assert (figures["rows_before"], figures["rows"]) == (len(rows), len(kept))
        assert (figures["nulls"], figures["gaps"]) == (nulls, gaps)
