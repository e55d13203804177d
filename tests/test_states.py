from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata import profile, states, tables

SCHEMA = "k string, i int, x double, s string, d date"
ROWS = [
    ("a", 1, 1.5, "z", None),
    ("a", None, -2.0, "", None),
    ("b", 10, None, "10", None),
    (None, 9, 0.0, "9", None),
    ("b", 2, 7.25, None, None),
    ("a", 1, 1.5, "z", None),
]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("by", [None, "k"])
def test_states_of_all_batches_equal_a_full_profile(spark, root, by):
    whole = spark.createDataFrame(ROWS, SCHEMA)
    for batch, part in enumerate([ROWS[:1], ROWS[1:4], ROWS[4:]]):
        states.add(spark.createDataFrame(part, SCHEMA), root, batch, by=by)
    stored = states.load(spark, root)
    assert rows(states.column_profile(stored)) == rows(profile.column_profile(whole, by=by))
    # Merging in steps changes nothing.
    some = states.merged(stored.limit(2)).unionByName(stored.exceptAll(stored.limit(2))) if by is None else states.merged(stored)
    assert rows(states.column_profile(some)) == rows(profile.column_profile(whole, by=by))


def test_a_replayed_batch_counts_once(spark, root):
    whole = spark.createDataFrame(ROWS, SCHEMA)
    for _ in range(2):
        states.add(whole, root, 7)
    assert rows(states.column_profile(states.load(spark, root))) == rows(profile.column_profile(whole))


def test_columns_that_come_later(spark, root):
    early, late = spark.createDataFrame([(1,), (2,)], "a int"), spark.createDataFrame([(3, "x")], "a int, `b.c` string")
    states.add(early, root, 0)
    states.add(late, root, 1)
    got = rows(states.column_profile(states.load(spark, root)))
    assert got == rows(profile.column_profile(tables.union_all([early, late])))


def test_empty_batches_and_empty_tables(spark, root):
    none = spark.createDataFrame([], SCHEMA)
    states.add(none, root, 0)
    assert rows(states.column_profile(states.load(spark, root))) == rows(profile.column_profile(none))
    assert rows(states.layer_summary(states.load(spark, root), "Raw")) == rows(profile.layer_summary({"Raw": none}))
    states.add(spark.createDataFrame(ROWS, SCHEMA), root, 1)
    assert states.layer_summary(states.load(spark, root), "Raw").first()["rows"] == len(ROWS)


def test_summary_shows_the_newest_time(spark, root):
    times = "2024-01-02 03:04:05", "2025-06-07 08:09:10", "2023-01-01 00:00:00"
    frames = [spark.createDataFrame([(1, t)], "a int, t string").select("a", F.col("t").cast("timestamp").alias("_ingest_timestamp")) for t in times]
    for batch, frame in enumerate(frames):
        states.add(frame, root, batch)
    got = states.layer_summary(states.load(spark, root), "Raw")
    assert rows(got) == rows(profile.layer_summary({"Raw": tables.union_all(frames)}))


def test_distinct_values_merge(spark, root):
    whole = spark.range(20_000).select(F.pmod("id", F.lit(5000)).alias("k"), F.col("id").cast("decimal(20,2)").alias("m"), F.lit(1).alias("one"))
    for batch in range(3):
        states.add(whole.filter(F.pmod("k", F.lit(7)) % 3 == batch), root, batch, distinct=["k", "m"])
    got = {r["column"]: r["distinct_values"] for r in states.column_profile(states.load(spark, root)).collect()}
    assert got["k"] == pytest.approx(5000, rel=0.08) and got["m"] == pytest.approx(20_000, rel=0.08) and got["one"] is None
    with pytest.raises(ValueError, match="no such columns"):
        states.state(whole, distinct=["absent"])


def test_profile_reads_states_only(spark, root):
    states.add(spark.createDataFrame(ROWS, SCHEMA), f"{root}/states", 0)
    states.add(spark.createDataFrame(ROWS, SCHEMA), f"{root}/states", 1)
    stored = states.load(spark, f"{root}/states")
    assert stored.count() == 2 and all("/states/batch=" in f for f in stored.inputFiles())
