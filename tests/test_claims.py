from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest

from strata import claims, incremental, ledger, tables
from strata.model import LEDGER
from strata.plans.config import LayerConfig

T0, T1, T2 = "2026-07-01T05:00:00", "2026-07-01T06:00:00", "2026-07-01T09:00:00"


@pytest.fixture
def stored(spark, root):
    entries = ledger.enqueue(spark.createDataFrame([], LEDGER), ["f0.csv", "f1.csv", "f2.csv"], "p", T0)
    incremental.store_ledger(ledger.enqueue(entries, ["other.csv"], "q", T0), root)
    return root


def state(spark, path):
    rows = claims.view(incremental.load_ledger(spark, path), claims.claims(spark, path)).orderBy("position").collect()
    return [(r["file_name"], r["status"], r["reserved_run_id"], r["processed_run_id"]) for r in rows]


def test_no_two_workers_take_one_entry(spark, stored):
    with ThreadPoolExecutor(6) as pool:
        taken = list(pool.map(lambda n: claims.take(spark, stored, "p", f"run-{n}", T0), range(6)))
    got = [c for c in taken if c]
    assert sorted(c.file_name for c in got) == ["f0.csv", "f1.csv", "f2.csv"] and len({c.run_id for c in got}) == 3
    assert [row[1] for row in state(spark, stored)] == ["reserved", "reserved", "reserved", "queued"]


def test_first_in_first_out_and_once(spark, stored):
    first = claims.take(spark, stored, "p", "a", T0)
    assert (first.position, first.attempt, first.file_name) == (0, 1, "f0.csv")
    assert claims.take(spark, stored, "p", "a", T0) == first  # a retry of the run
    claims.finish(spark, stored, first, T1)
    assert claims.take(spark, stored, "p", "a", T1).file_name == "f1.csv"
    assert state(spark, stored)[0] == ("f0.csv", "processed", "a", "a")
    with pytest.raises(claims.LostClaim):
        claims.finish(spark, stored, first, T1)


def test_a_stale_claim_is_taken_again(spark, stored):
    dead = claims.take(spark, stored, "p", "dead", T0, lease=3600)
    assert claims.take(spark, stored, "p", "b", T1, lease=3600).position == 1  # the lease holds up to its last second
    heir = claims.take(spark, stored, "p", "heir", T2, lease=3600)
    assert (heir.position, heir.attempt) == (0, 2)
    with pytest.raises(claims.LostClaim):
        claims.finish(spark, stored, dead, T2)
    claims.finish(spark, stored, heir, T2)
    assert state(spark, stored)[0] == ("f0.csv", "processed", "heir", "heir")


def test_a_draft_that_a_lost_worker_left_is_no_claim(spark, stored):
    claims.take(spark, stored, "p", "a", T0)
    open(f"{stored}/claims/.draft", "w").close()
    assert [row[1] for row in state(spark, stored)] == ["reserved", "queued", "queued", "queued"]
    assert not claims._create(spark, f"{stored}/claims/0-1", "{}")
    assert claims.take(spark, stored, "p", "b", T0).position == 1


def test_fold_moves_finished_entries_only(spark, stored):
    first, second = (claims.take(spark, stored, "p", run, T0) for run in ("a", "b"))
    claims.finish(spark, stored, first, T1)
    before = state(spark, stored)
    claims.fold(spark, stored)
    claims.fold(spark, stored)
    assert state(spark, stored) == before
    rows = {r["position"]: r["status"] for r in incremental.load_ledger(spark, stored).collect()}
    assert rows == {0: "processed", 1: "queued", 2: "queued", 3: "queued"}
    claims.finish(spark, stored, second, T1)
    assert claims.take(spark, stored, "p", "c", T1).position == 2


def test_runs_of_several_workers_end_the_queue(spark, stored, tmp_path):
    for n in range(3):
        (tmp_path / f"f{n}.csv").write_text(f"a,b\n{n},x\n")
    config, out = LayerConfig(rules=(), partition_by=None, key=None), str(tmp_path / "out")
    seen = []
    for n in range(4):
        records = claims.run_claimed(spark, stored, str(tmp_path), out, "p", f"run-{n}", T0, config)
        seen += [tuple(r) for r in tables.read_layer(spark, f"{out}/silver").select("a", "b").collect()] if records else []
    assert sorted(seen) == [(0, "x"), (1, "x"), (2, "x")]
    assert [row[1] for row in state(spark, stored)] == ["processed"] * 3 + ["queued"]
