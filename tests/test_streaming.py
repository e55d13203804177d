from __future__ import annotations

import os
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from strata import incremental, layers, ledger, runs, tables
from strata.model import LEDGER
from strata.plans.config import LayerConfig

CONFIG = LayerConfig(partition_by="b", key="a")
SCHEMA = "a int, b string"


@pytest.fixture
def inbox(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        (folder / f"f{i}.csv").write_text(f"a,b\n{i},x\n{i},x\n,y{i}\n")
    return folder


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_schema_of_a_file(spark, inbox):
    assert incremental.schema_of(spark, str(inbox / "f0.csv")).simpleString() == "struct<a:int,b:string>"


def batches(query):
    return [p for p in query.recentProgress if p["numInputRows"]]


def test_drain_appends_one_batch_per_file(spark, inbox, root):
    def drain():
        return incremental.drain(
            spark, str(inbox), root, schema(spark), f"{root}/checkpoint", config=CONFIG, mode="append"
        )

    assert len(batches(drain())) == 3
    silver = tables.read_layer(spark, f"{root}/silver")
    assert silver.count() == 6  # duplicates go within a file
    assert silver.select("batch_id").distinct().count() == 3
    assert tables.read_layer(spark, f"{root}/gold").where("b = 'x'").count() == 3
    records = runs.read_metrics(spark, layers.metrics_path(root))
    assert records.where("layer = 'Silver'").agg(F.sum("duplicates_removed"), F.sum("nulls_filled")).first()[:] == (3, 3)
    assert len(batches(drain())) == 0
    (inbox / "f3.csv").write_text("a,b\n9,z\n")
    assert len(batches(drain())) == 1
    assert tables.read_layer(spark, f"{root}/silver").count() == 7


def test_drain_keeps_all_files_by_default(spark, inbox, root):
    incremental.drain(spark, str(inbox), root, schema(spark), f"{root}/checkpoint", config=CONFIG)
    assert tables.read_layer(spark, f"{root}/bronze").count() == 9


def test_old_files_are_not_left_out(spark, inbox, root):
    def drain():
        incremental.drain(spark, str(inbox), root, schema(spark), f"{root}/checkpoint", config=CONFIG)

    drain()
    late = inbox / "late.csv"
    late.write_text("a,b\n9,z\n")
    week_ago = time.time() - 8 * 86_400
    os.utime(late, (week_ago, week_ago))
    drain()
    assert tables.read_layer(spark, f"{root}/silver").count() == 7


def test_streams_and_checkpoints_share_a_root(spark, inbox, root):
    for name, checkpoint in (("one", "a"), (None, "b"), (None, "c")):
        incremental.drain(spark, str(inbox), root, schema(spark), f"{root}/{checkpoint}", config=CONFIG, stream=name)
    silver = tables.read_layer(spark, f"{root}/silver")
    assert silver.count() == 18 and silver.select("stream").distinct().count() == 3
    assert runs.read_metrics(spark, layers.metrics_path(root)).select("run_id").distinct().count() == 9


def test_reordered_header_is_refused_in_a_stream(spark, inbox, root):
    (inbox / "f9.csv").write_text("b,a\nx,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        incremental.drain(spark, str(inbox), root, schema(spark), f"{root}/checkpoint", config=CONFIG)


def test_json_streams(spark, root, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text('{"a":1,"b":"x"}\n{"a":2,"b":"y"}\n')
    config = replace(CONFIG, lines=True)
    incremental.drain(spark, str(folder), root, schema(spark), f"{root}/c1", fmt="json", config=config)
    assert tables.read_layer(spark, f"{root}/silver").count() == 2
    with pytest.raises(Exception, match="more than one JSON value"):
        incremental.drain(spark, str(folder), root, schema(spark), f"{root}/c2", fmt="json", config=CONFIG)


def test_drain_overwrites_on_request(spark, inbox, root):
    incremental.drain(spark, str(inbox), root, schema(spark), f"{root}/checkpoint", config=CONFIG, mode="overwrite")
    bronze = tables.read_layer(spark, f"{root}/bronze")
    assert bronze.count() == 3 and "batch_id" not in bronze.columns


def test_replayed_batch_changes_nothing(spark, root):
    process = incremental.refine_batch(root, CONFIG, "append")
    for _ in range(2):
        process(spark.createDataFrame([(1, "x"), (1, "x"), (None, "y")], SCHEMA), 0)
    assert tables.read_layer(spark, f"{root}/silver").count() == 2
    assert runs.read_metrics(spark, layers.metrics_path(root)).count() == 3
    with pytest.raises(ValueError):
        incremental.refine_batch(root, mode="update")


def test_on_arrival(spark, inbox, root):
    query = incremental.on_arrival(
        spark, str(inbox), root, schema(spark), f"{root}/checkpoint", config=CONFIG, mode="append", every="0 seconds"
    )
    try:
        query.processAllAvailable()
        assert tables.read_layer(spark, f"{root}/gold").count() == 6
        (inbox / "late.csv").write_text("a,b\n7,w\n")
        query.processAllAvailable()
        assert tables.read_layer(spark, f"{root}/gold").count() == 7
    finally:
        query.stop()


def test_scheduled_runs_take_one_file_each(spark, inbox, root):
    entries = ledger.enqueue(spark.createDataFrame([], LEDGER), ["f0.csv", "f1.csv"], "s", "t")
    seen = []
    for run_id in ("r1", "r2", "r3"):
        entries, records = incremental.run_next(spark, entries, str(inbox), root, "s", run_id, "t", CONFIG)
        seen.append([r["status"] for r in records])
        entries.write.parquet(f"{root}/ledger/{run_id}")
        entries = spark.read.parquet(f"{root}/ledger/{run_id}")
    assert seen == [["Success"] * 3, ["Success"] * 3, []]
    state = {r["file_name"]: (r["status"], r["processed_run_id"]) for r in entries.collect()}
    assert state == {"f0.csv": ("processed", "r1"), "f1.csv": ("processed", "r2")}
    assert {r["a"] for r in tables.read_layer(spark, f"{root}/silver").collect()} == {0, 1}


def test_stored_queue_keeps_the_entry_of_a_failing_run(spark, inbox, root):
    path = f"{root}/queue"
    entries = ledger.enqueue(incremental.load_ledger(spark, path), ["gone.csv", "f1.csv"], "s", "t")
    incremental.store_ledger(entries, path)
    state = lambda: [(r["status"], r["reserved_run_id"], r["processed_run_id"]) for r in incremental.load_ledger(spark, path).orderBy("position").collect()]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        incremental.run_stored(spark, path, str(inbox), root, "s", "r1", "t1", CONFIG)
    assert state() == [("reserved", "r1", None), ("queued", None, None)]
    (inbox / "gone.csv").write_text("a,b\n5,q\n")
    assert len(incremental.run_stored(spark, path, str(inbox), root, "s", "r1", "t2", CONFIG)) == 3
    assert len(incremental.run_stored(spark, path, str(inbox), root, "s", "r2", "t3", CONFIG)) == 3
    assert incremental.run_stored(spark, path, str(inbox), root, "s", "r3", "t4", CONFIG) == []
    assert state() == [("processed", "r1", "r1"), ("processed", "r2", "r2")]


def test_failing_run_raises_and_is_recorded(spark, inbox, root):
    entries = ledger.enqueue(spark.createDataFrame([], LEDGER), ["gone.csv"], "s", "t")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        incremental.run_next(spark, entries, str(inbox), root, "s", "r1", "t", CONFIG)
    assert runs.read_metrics(spark, layers.metrics_path(root)).first()["status"] == "FAILED"
