from __future__ import annotations

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from strata import incremental, layers, lookup, runs, seen, tables
from strata.plans.config import LayerConfig

CONFIG = LayerConfig(rules=(), partition_by=None, key="a", across_batches=True)
SCHEMA = "a int, b string"


def refined(spark, root):
    return sorted(tuple(r) for r in tables.read_layer(spark, f"{root}/silver").select("a", "b").collect())


def run(spark, root, batch, rows, config=CONFIG):
    return layers.run(spark, spark.createDataFrame(rows, SCHEMA), root, f"run-{batch}", config, batch=batch)


def test_rows_of_earlier_batches_are_left_out(spark, root):
    run(spark, root, 0, [(1, "x"), (1, "x"), (None, "x"), (None, None)])
    silver = run(spark, root, 1, [(1, "x"), (2, "x"), (2, "x"), (None, None), (None, None)])[1]
    # Filled afterwards: null numbers become 0, null texts "unknown".
    assert refined(spark, root) == [(0, "unknown"), (0, "x"), (1, "x"), (2, "x")]
    assert (silver["rows_before"], silver["rows_after"], silver["duplicates_removed"], silver["nulls_filled"]) == (5, 1, 4, 0)


def test_nulls_are_hashed_by_place(spark, root):
    rows = [("x", None), (None, "x")]
    for batch, row in enumerate(rows):
        layers.run(spark, spark.createDataFrame([row], "a string, b string"), root, "r", CONFIG, batch=batch)
    assert refined(spark, root) == [("unknown", "x"), ("x", "unknown")]


def test_replay_gives_the_same_rows(spark, root):
    run(spark, root, 0, [(1, "x")])
    for _ in range(2):
        run(spark, root, 1, [(1, "x"), (2, "y")])
        assert refined(spark, root) == [(1, "x"), (2, "y")]


def test_replay_after_a_failure_between_index_and_layer(spark, root, monkeypatch):
    run(spark, root, 0, [(1, "x")])
    write = tables.write_layer

    def failing(df, path, **options):
        if "/silver/" in path:
            raise RuntimeError("lost")
        return write(df, path, **options)

    monkeypatch.setattr(tables, "write_layer", failing)
    with pytest.raises(RuntimeError, match="lost"):
        run(spark, root, 1, [(1, "x"), (2, "y")])
    monkeypatch.setattr(tables, "write_layer", write)
    run(spark, root, 1, [(1, "x"), (2, "y")])
    assert refined(spark, root) == [(1, "x"), (2, "y")]


def test_streams_are_kept_apart_and_whole_runs_unchanged(spark, root):
    run(spark, root, "s/0", [(1, "x")])
    run(spark, root, "t/0", [(1, "x")])
    assert refined(spark, root) == [(1, "x"), (1, "x")]
    other = f"{root}-whole"
    for _ in range(2):
        layers.run(spark, spark.createDataFrame([(1, "x")], SCHEMA), other, "r", CONFIG)
    assert refined(spark, other) == [(1, "x")]
    run(spark, f"{root}-off", 0, [(1, "x")], replace(CONFIG, across_batches=False))
    run(spark, f"{root}-off", 1, [(1, "x")], replace(CONFIG, across_batches=False))
    assert refined(spark, f"{root}-off") == [(1, "x"), (1, "x")]


@pytest.mark.parametrize("screened", [False, True])
def test_all_rows_known(spark, root, screened):
    config = replace(CONFIG, screen_duplicates=screened)
    run(spark, root, 0, [(1, "x"), (1, "x")], config)
    records = run(spark, root, 1, [(1, "x"), (1, "x")], config)
    assert refined(spark, root) == [(1, "x")]
    assert records[1]["rows_after"] == 0 and records[2]["skipped"]


@pytest.mark.parametrize("fits", [True, False])
def test_fold_keeps_every_entry(spark, root, monkeypatch, fits):
    monkeypatch.setattr(lookup, "fits_broadcast", lambda df, *a, **k: fits)
    index = layers.seen_path(root, "s/0")
    for n in range(4):
        run(spark, root, f"s/{n}", [(n, "x"), (n - 1, "x")])
        if n == 2:
            seen.fold(spark, index, 2)
            assert seen._folders(spark, index) == [("batch", 2), ("upto", 1)]
    seen.fold(spark, index, 4)
    seen.fold(spark, index, 4)
    assert seen._folders(spark, index) == [("upto", 3)]
    run(spark, root, "s/4", [(n, "x") for n in range(-1, 6)])
    assert refined(spark, root) == [(n, "x") for n in range(-1, 6)]


def test_only_touched_buckets_are_read_and_the_index_is_not_shuffled(spark, root):
    rows = spark.range(1000).select(F.col("id").alias("c0"), F.lit(1).cast("bigint").alias("copies"))
    seen.mark(rows, ["id"], root, 0).count()
    got = seen.mark(rows.filter("c0 = 5"), ["id"], root, 1)
    assert [tuple(r) for r in got.collect()] == [(5, 1, True)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = \d+", plan) and "SortMergeJoin" not in plan


def test_stream(spark, tmp_path, root):
    inbox = tmp_path / "in"
    inbox.mkdir()
    for n in range(3):
        (inbox / f"f{n}.csv").write_text(f"a,b\n{n},x\n{n + 1},x\n{n + 1},x\n")
        incremental.drain(spark, str(inbox), root, spark.createDataFrame([], SCHEMA).schema, f"{root}/checkpoint", config=CONFIG)
    assert refined(spark, root) == [(0, "x"), (1, "x"), (2, "x"), (3, "x")]
    records = runs.read_metrics(spark, layers.metrics_path(root)).where("layer = 'Silver'")
    assert records.agg(F.sum("duplicates_removed")).first()[0] == 5
