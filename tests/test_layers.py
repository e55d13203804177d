"""The ten-row run, its failures and its early exits."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata import __main__ as cli
from strata import layers, profile, runs, session, tables
from strata.plans.config import FlagRule, LayerConfig


def records(spark, root, run_id="r1"):
    rows = runs.read_metrics(spark, layers.metrics_path(root)).where(F.col("run_id") == run_id).collect()
    return {row["layer"]: row.asDict(recursive=True) for row in rows}


def test_ten_row_run(spark, root, passengers):
    layers.run(spark, passengers, root, "r1")
    bronze, silver, gold = (tables.read_layer(spark, f"{root}/{name}") for name in ("bronze", "silver", "gold"))
    assert (bronze.count(), silver.count(), gold.count()) == (10, 9, 9)
    assert bronze.columns[-1] == "_ingest_timestamp"
    assert silver.columns[-2:] == ["_ingest_timestamp", "_processed_at"]
    assert gold.columns[-4:] == ["_processed_at", "gold_loaded_at", "SurvivalStatus", "Pclass"]
    counts = {row["Pclass"]: row["count"] for row in gold.groupBy("Pclass").count().collect()}
    assert counts == {1: 3, 3: 6}
    flags = {row["SurvivalStatus"]: row["count"] for row in gold.groupBy("SurvivalStatus").count().collect()}
    assert flags == {"Survived": 4, "Did not survive": 5}
    stats = {(r["part"], r["column"]): r for r in profile.column_profile(gold, by="Pclass").collect()}
    assert (stats["1", "Age"]["min"], stats["1", "Age"]["max"]) == ("35", "54")
    assert (stats["3", "Age"]["min"], stats["3", "Age"]["max"]) == ("-5", "27")
    assert (stats["3", "Cabin"]["min"], stats["3", "Cabin"]["max"]) == ("unknown", "unknown")
    assert (stats["1", "Fare"]["min"], stats["1", "Fare"]["max"]) == ("-10.0", "71.2833")
    assert stats["3", "Embarked"]["max"] == "X"
    assert all(row["nulls"] == 0 for row in stats.values())

    got = records(spark, root)
    assert got["Bronze"]["input_rows"] == got["Bronze"]["output_rows"] == 10
    assert got["Bronze"]["source"] == "passengers.csv"
    assert got["Bronze"]["schema"][0] == {"name": "PassengerId", "type": "IntegerType()"}
    assert len(got["Bronze"]["schema"]) == 12
    silver_record = got["Silver"]
    assert (silver_record["rows_before"], silver_record["rows_after"]) == (10, 9)
    assert (silver_record["duplicates_removed"], silver_record["nulls_filled"]) == (1, 8)
    assert silver_record["nulls_filled_exact"] == 8
    assert silver_record["transformations"] == ["Deduplicate rows", "Fill null values", "Add _processed_at timestamp"]
    assert got["Gold"]["aggregation_count"] == 1
    assert got["Gold"]["output_datasets"] == ["gold_partitioned_by_Pclass"]
    assert got["Gold"]["key_nulls"] == 0
    assert {r["status"] for r in got.values()} == {"Success"}
    assert all(r["duration"].endswith(" sec") for r in got.values())


def test_rerun_overwrites(spark, root, passengers):
    layers.run(spark, passengers, root, "r1")
    layers.run(spark, passengers, root, "r1")
    assert tables.read_layer(spark, f"{root}/gold").count() == 9
    assert runs.read_metrics(spark, layers.metrics_path(root)).count() == 3


def test_failed_bronze_is_recorded_and_raised(spark, root, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        layers.bronze(spark, str(tmp_path / "absent.csv"), root, "r1")
    got = records(spark, root)["Bronze"]
    assert got["status"] == "FAILED"
    assert (got["input_rows"], got["output_rows"], got["schema"]) == (0, 0, [])
    assert "PATH_NOT_FOUND" in got["exception"]


def test_failed_silver_keeps_zero_rows_after(spark, root):
    with pytest.raises(Exception):
        layers.silver(spark, root, "r1")
    got = records(spark, root)["Silver"]
    assert (got["status"], got["rows_after"]) == ("FAILED", 0)


def test_empty_source_skips_and_leaves_layers(spark, root, passengers, tmp_path):
    layers.run(spark, passengers, root, "r1")
    header = tmp_path / "empty.csv"
    header.write_text("a,b\n")
    other = root + "-other"
    layers.run(spark, str(header), other, "r2")
    got = records(spark, other, "r2")
    assert got["Bronze"]["output_rows"] == 0
    assert got["Silver"]["status"] == got["Gold"]["status"] == "Success"
    assert got["Silver"]["skipped"] and got["Gold"]["skipped"]
    assert tables.layer_or_none(spark, f"{other}/silver") is None


def test_source_without_rule_columns_passes_through(spark, root, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("a,b\n1,x\n2,\n")
    layers.run(spark, str(path), root, "r1")
    gold = tables.read_layer(spark, f"{root}/gold")
    assert gold.columns == ["a", "b", "_ingest_timestamp", "_processed_at", "gold_loaded_at"]
    got = records(spark, root)["Gold"]
    assert (got["aggregation_count"], got["output_datasets"], got["kpis_generated"]) == (0, ["gold_unpartitioned"], [])


def test_index_columns_go_before_dedupe(spark, root, tmp_path):
    path = tmp_path / "indexed.csv"
    path.write_text(",Unnamed: 0,index,a\n0,0,0,x\n1,1,1,x\n")
    layers.bronze(spark, str(path), root, "r1")
    layers.silver(spark, root, "r1")
    silver = tables.read_layer(spark, f"{root}/silver")
    got = records(spark, root)["Silver"]
    assert got["duplicates_removed"] == 1
    assert silver.columns == ["a", "_ingest_timestamp", "_processed_at"]
    assert got["transformations"][0] == "Remove index columns"


def test_refused_silver_reads_no_data(spark, root, passengers):
    layers.bronze(spark, passengers, root, "r1")
    spark.range(1).write.parquet(f"{root}/silver")
    with pytest.raises(ValueError, match="not in the target"):
        layers.silver(spark, root, "r1")
    got = records(spark, root)["Silver"]
    assert (got["status"], got["rows_before"], got["rows_after"]) == ("FAILED", 0, 0)
    assert "not in the target" in got["exception"]


def test_json_lines_reach_gold(spark, root, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"a":1,"b":"x"}\n{"a":2,"b":"y"}\n{"a":2,"b":"y"}\n')
    config = LayerConfig(rules=(), partition_by="b", key="a", lines=True)
    layers.run(spark, str(path), root, "r1", config)
    assert tables.read_layer(spark, f"{root}/gold").count() == 2
    assert records(spark, root)["Bronze"]["input_rows"] == 3
    with pytest.raises(ValueError, match="lines=True"):
        layers.bronze(spark, str(path), root, "r2", LayerConfig(key="a"))


def test_malformed_rows_are_counted_where_kept(spark, root, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a,b\n1,x\nq,y\n3\n")
    schema = spark.createDataFrame([], "a int, b string").schema
    with pytest.raises(Exception, match="(?i)malformed"):
        layers.bronze(spark, str(path), root, "r1", LayerConfig(key="a"), schema)
    layers.run(spark, str(path), root, "r2", LayerConfig(rules=(), partition_by=None, key="a", malformed="keep"), schema)
    got = records(spark, root, "r2")["Bronze"]
    assert (got["input_rows"], got["malformed_rows"], got["key_nulls"]) == (3, 2, 1)
    found = runs.warnings(runs.read_metrics(spark, layers.metrics_path(root)).where("run_id = 'r2'"))
    assert {(r.layer, r.warning) for r in found.collect()} >= {("Bronze", "2 malformed rows kept"), ("Bronze", "1 rows without a key")}
    assert "_malformed" not in tables.read_layer(spark, f"{root}/silver").columns


def test_skipped_stage_tells_so(spark, root):
    layers.gold(spark, root, "r1")
    got = runs.read_metrics(spark, layers.metrics_path(root))
    assert [(r.key, r.value) for r in runs.unpivot_metrics(got).where("key = 'skipped'").collect()] == [("skipped", "true")]
    assert [r.warning for r in runs.warnings(got).collect()] == ["skipped: no input"]


def test_stages_side_by_side_do_not_mix_settings(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with session.settings(spark, {key: 50}):
        outer = session.settings(spark, {key: 70})
        outer.__enter__()
        assert spark.conf.get(key) == "70"
    assert spark.conf.get(key) == "70"
    outer.__exit__(None, None, None)
    assert spark.conf.get(key) == before


def test_failed_gold_keeps_its_rule_count(spark, root, passengers):
    layers.run(spark, passengers, root, "r1")
    spark.range(1).selectExpr("'x' AS Age").write.mode("overwrite").parquet(f"{root}/gold")
    with pytest.raises(ValueError, match="does not fit"):
        layers.gold(spark, root, "r2")
    got = records(spark, root, "r2")["Gold"]
    assert (got["status"], got["aggregation_count"], got["output_datasets"]) == ("FAILED", 1, [])


def test_shuffle_grows_with_the_stored_data(spark, root, passengers, monkeypatch):
    layers.bronze(spark, passengers, root, "r1")
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    assert session.shuffle_sized_for(spark, f"{root}/bronze") == {setting: int(before)}
    monkeypatch.setattr(session, "STORED_BYTES_PER_PARTITION", 100)
    sized = session.shuffle_sized_for(spark, f"{root}/bronze")
    assert sized[setting] > int(before)
    with session.settings(spark, sized):
        assert int(spark.conf.get(setting)) == sized[setting]
    assert spark.conf.get(setting) == before


def test_gathered_gold_equals_the_direct_one(spark, root, passengers):
    layers.bronze(spark, passengers, root, "r1")
    layers.silver(spark, root, "r1")
    results = []
    for rebalance in (True, False, None):
        layers.gold(spark, root, "r1", LayerConfig(rebalance=rebalance))
        gold = tables.read_layer(spark, f"{root}/gold").drop("gold_loaded_at")
        results.append(sorted(map(repr, gold.collect())))
    assert results[0] == results[1] == results[2] and len(results[0]) == 9


def test_command_line(spark, root, passengers, tmp_path, capsys):
    cli.main(["run", "--root", root, "--source", passengers, "--run-id", "r1"])
    for job in (["bronze", "--source", passengers], ["silver"], ["gold"], ["peek"], ["report"]):
        cli.main([*job, "--root", root, "--run-id", "r1"])
    assert "[GOLD LAYER]\n - layer: Gold" in capsys.readouterr().out
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "p.csv").write_text(open(passengers).read())
    cli.main(["drain", "--root", f"{root}-drained", "--source", str(inbox)])
    assert tables.read_layer(spark, f"{root}-drained/gold").count() == 9
    with pytest.raises(SystemExit):
        cli.main(["bronze", "--root", root])


def test_bronze_enforces_schema_and_gold_evolves(spark, root, tmp_path):
    first, second = tmp_path / "a.csv", tmp_path / "b.csv"
    first.write_text("a,b\n1,x\n")
    second.write_text("a,b,c\n1,x,9\n")
    layers.run(spark, str(first), root, "r1")
    with pytest.raises(ValueError, match="not in the target"):
        layers.bronze(spark, str(second), root, "r2")
    silver = tables.read_layer(spark, f"{root}/silver").withColumn("c", F.lit(9))
    silver.write.parquet(f"{root}-next/silver")
    tables.write_layer(silver.drop("b"), f"{root}/gold", merge_schema=True)
    gold = tables.read_layer(spark, f"{root}/gold")
    assert gold.columns == ["a", "b", "_ingest_timestamp", "_processed_at", "gold_loaded_at", "c"]
    assert gold.first()["b"] is None


def test_key_nulls_are_counted_for_unfilled_types(spark, root, tmp_path):
    path = tmp_path / "keys.csv"
    path.write_text("k,v\n2024-01-01,1\n,2\n")
    layers.run(spark, str(path), root, "r1", LayerConfig(key="k"))
    got = records(spark, root)
    assert got["Gold"]["key_nulls"] == 1
    assert (got["Silver"]["nulls_filled"], got["Silver"]["nulls_filled_exact"]) == (1, 0)


def test_silver_has_one_exchange(spark, root, passengers):
    layers.bronze(spark, passengers, root, "r1")
    df, _ = layers.refine_counted(tables.read_layer(spark, f"{root}/bronze"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    assert plan.count("FileScan") == 1


def test_gold_partition_filter_prunes(spark, root, passengers):
    layers.run(spark, passengers, root, "r1")
    df = tables.read_layer(spark, f"{root}/gold").where("Pclass = 3").select("Age")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Pclass" in plan
    assert df.count() == 6


def test_frames_without_rows(spark, root):
    layers.run(spark, spark.createDataFrame([], "a int, b string"), root, "r1")
    got = records(spark, root)
    assert got["Bronze"]["output_rows"] == 0 and got["Bronze"]["source"] == "stream"
    assert got["Silver"]["skipped"] and got["Gold"]["skipped"]
    layers.bronze(spark, spark.range(5).where("id > 9"), f"{root}-2", "r1")
    assert records(spark, f"{root}-2")["Bronze"]["output_rows"] == 0


def test_odd_headers_pass_all_layers(spark, root, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text("a.b,c d,e-f,g\n1,x,,p\n1,x,,p\n,,2.5,q\n")
    config = LayerConfig(rules=(FlagRule("a.b", "is one", 1, "y", "n"),), partition_by="g", key="a.b")
    for _ in range(2):
        layers.run(spark, str(path), root, "r1", config)
    rows = tables.read_layer(spark, f"{root}/gold").select("`a.b`", "`c d`", "`e-f`", "`is one`", "g").collect()
    assert sorted(tuple(r) for r in rows) == [(0, "unknown", 2.5, "n", "q"), (1, "x", 0.0, "y", "p")]
    got = records(spark, root)
    assert (got["Bronze"]["key_nulls"], got["Gold"]["key_nulls"]) == (1, 0)
    assert got["Silver"]["nulls_filled"] == 3


def test_json_source_with_nested_values(spark, root, tmp_path):
    path = tmp_path / "rows.JSON"
    path.write_text('[{"a": 1, "b": {"c": [1, 2]}, "m": null}, {"a": 1, "b": {"c": [1, 2]}, "m": null},\n {"b": null}]')
    layers.run(spark, str(path), root, "r1")
    silver = tables.read_layer(spark, f"{root}/silver").drop("_ingest_timestamp", "_processed_at")
    rows = {r["a"]: (r["b"], r["m"]) for r in silver.collect()}
    assert rows[0] == (None, "unknown") and rows[1][0]["c"] == [1, 2] and len(rows) == 2
    got = records(spark, root)["Silver"]
    assert (got["nulls_filled"], got["nulls_filled_exact"]) == (4, 3)


def test_command_line_rules_and_compaction(spark, root, passengers):
    rule = ["--rule", "Sex", "Female", "female", "yes", "no", "--rule", "Survived", "Alive", "1", "alive", "dead"]
    cli.main(["run", "--root", root, "--source", passengers, "--run-id", "r1", *rule])
    gold = tables.read_layer(spark, layers.layer_path(root, "gold"))
    assert "SurvivalStatus" not in gold.columns
    assert {(r["Sex"], r["Female"]) for r in gold.collect()} == {("female", "yes"), ("male", "no")}
    assert {(r["Survived"], r["Alive"]) for r in gold.collect()} == {(1, "alive"), (0, "dead")}
    before = sorted(map(repr, records(spark, root).items()))
    cli.main(["compact", "--root", root])
    assert sorted(map(repr, records(spark, root).items())) == before and len(before) == 3
