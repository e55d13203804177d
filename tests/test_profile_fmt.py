from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata import fmt, profile


@pytest.mark.parametrize(
    "text, shown",
    [
        ("2026-07-01T16:04:39.315596+00:00", "01 Jul 2026, 09:34:39 PM IST"),
        ("2026-07-01T16:05:00Z", "01 Jul 2026, 09:35:00 PM IST"),
        ("2026-07-01 16:05:00", "01 Jul 2026, 09:35:00 PM IST"),
        ("2026-07-01T21:35:00+05:30", "01 Jul 2026, 09:35:00 PM IST"),
        ("2026-07-01 16:05:00 UTC", "01 Jul 2026, 09:35:00 PM IST"),
        ("2026-07-01 16:05:00 Asia/Tokyo", "01 Jul 2026, 12:35:00 PM IST"),
        ("2026-07-01", "01 Jul 2026, 05:30:00 AM IST"),
        ("2025-12-31T18:30:00+00:00", "01 Jan 2026, 12:00:00 AM IST"),
        ("soon", "soon"),
        ("", "Not available"),
        (None, "Not available"),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_display(spark, text, shown, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(fmt.display_ts(F.col("t"))).first()[0] == shown
        plain = df.select(fmt.display_ts(F.col("t"), suffix="")).first()[0]
        assert plain == shown.removesuffix(" IST")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def one(spark, expression):
    return spark.range(1).select(expression).first()[0]


def test_small_formats(spark):
    assert one(spark, fmt.status(F.lit("SUCCESS"))) == "success"
    assert one(spark, fmt.status(F.lit(""))) == one(spark, fmt.status(F.lit(None).cast("string"))) == "unknown"
    assert one(spark, fmt.label(F.lit("kpis_generated"))) == "Kpis Generated"
    assert one(spark, fmt.thousands(F.lit(1234567))) == "1,234,567"
    assert one(spark, fmt.duration(F.lit(1.5), F.lit(4.923))) == "3.42 sec"
    assert one(spark, fmt.run_name(F.lit("manual__x"), F.lit(3))) == "Manual Run 3"
    for items in (["a", "it's", 'say "x"', "back\\slash", "line\nbreak", "it's \"x\""], []):
        array = F.array(*[F.lit(i) for i in items]).cast("array<string>")
        assert one(spark, fmt.text_list(array)) == str(items)


def test_profile_by_partition(spark):
    df = spark.createDataFrame(
        [("a", 1, True, [1], None), ("a", 3, None, None, 1.5), ("b", None, False, [2], -2.0), (None, 7, True, [3], 0.5)],
        "part_key string, `i.j` int, b boolean, l array<int>, d double",
    )
    got = {(r["part"], r["column"]): tuple(r)[2:] for r in profile.column_profile(df, "part_key").collect()}
    assert got["a", "i.j"] == (2, "1", "3", 0)
    assert got["a", "d"] == (2, "1.5", "1.5", 1)
    assert got["a", "b"] == (2, None, None, 1)
    assert got["b", "i.j"] == (1, None, None, 1)
    assert got[None, "l"] == (1, None, None, 0)
    assert len(got) == 12
    whole = {r["column"]: tuple(r) for r in profile.column_profile(df).collect()}
    assert whole["i.j"] == (None, "i.j", 4, "1", "7", 1)
    assert whole["part_key"] == (None, "part_key", 4, "a", "b", 1)


def test_last_updated(spark):
    stamps = [(datetime(2026, 7, 1, 16, 5),), (None,), (datetime(2026, 6, 1),)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(stamps, "_ingest_timestamp timestamp_ntz").select(
            F.col("_ingest_timestamp").cast(kind).alias("_ingest_timestamp")
        )
        assert profile.last_updated(df).first()[0] == "01 Jul 2026, 09:35:00 PM"
        assert profile.last_updated(df.limit(0)).first()[0] == "Not available"
        assert profile.last_updated(df.where("_ingest_timestamp is null")).first()[0] == "Not available"
    assert profile.last_updated(spark.range(3)).first()[0] == "Not available"


def test_layers_together(spark):
    layers = {"Bronze": spark.range(3), "Silver": spark.range(0), "Gold": spark.range(2).withColumn("x", F.lit(1))}
    got = {r["layer"]: (r["rows"], r["columns"]) for r in profile.layer_summary(layers).collect()}
    assert got == {"Bronze": (3, 1), "Silver": (0, 0), "Gold": (2, 2)}
    assert tuple(profile.platform_totals(layers).first()) == (5, 2)
