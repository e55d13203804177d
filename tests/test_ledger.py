from __future__ import annotations

import pytest

from strata import ledger
from strata.model import LEDGER

AT = "2026-07-02T05:00:00"


def entry(position, name, status, target="s", reserved=None, processed=None):
    return (position, name, status, target, "t", reserved, None, processed, None)


@pytest.fixture(scope="module")
def entries(spark):
    rows = [
        entry(0, "other.csv", "queued", "e"),
        entry(1, "done.csv", "processed", "s", "run0", "run0"),
        entry(2, "held.csv", "reserved", "s", "run1"),
        entry(3, "same.csv", "queued"),
        entry(4, "same.csv", "queued"),
    ]
    return spark.createDataFrame(rows[::-1], LEDGER).repartition(3)


def state(df):
    return {r["position"]: (r["status"], r["reserved_run_id"], r["processed_run_id"]) for r in df.collect()}


def test_first_queued_entry_is_next(entries):
    assert [r["position"] for r in ledger.next_entry(entries, "s", "new").collect()] == [3]
    assert [r["position"] for r in ledger.next_entry(entries, "e", "new").collect()] == [0]
    assert ledger.next_entry(entries, "absent", "new").count() == 0


def test_a_retry_gets_the_entry_it_holds(entries):
    assert [r["position"] for r in ledger.next_entry(entries, "s", "run1").collect()] == [2]
    assert state(ledger.reserve(entries, "s", "run1", AT)) == state(entries)
    # A processed entry is no longer held.
    assert [r["position"] for r in ledger.next_entry(entries, "s", "run0").collect()] == [3]


def test_reserve_and_mark(entries):
    reserved = ledger.reserve(entries, "s", "new", AT)
    assert state(reserved)[3] == ("reserved", "new", None)
    assert state(reserved)[4] == ("queued", None, None)
    assert reserved.where("position = 3").first()["reserved_at"] == AT
    assert ledger.next_entry(reserved, "s", "new").first()["position"] == 3
    done = ledger.mark_processed(reserved, "new", AT)
    assert state(done)[3] == ("processed", "new", "new")
    assert done.count() == entries.count() and done.columns == LEDGER.names
    assert ledger.next_entry(done, "s", "new").first()["position"] == 4


def test_mark_takes_the_first_entry_of_any_status(spark):
    df = spark.createDataFrame([entry(1, "a", "processed", "x", "r"), entry(2, "b", "reserved", "s", "r")], LEDGER)
    marked = state(ledger.mark_processed(df, "r", AT))
    assert marked[1] == ("processed", "r", "r") and marked[2] == ("reserved", "r", None)
    assert state(ledger.mark_processed(df, "absent", AT)) == state(df)


def test_nothing_to_reserve(spark):
    df = spark.createDataFrame([entry(1, "a", "processed")], LEDGER)
    assert state(ledger.reserve(df, "s", "new", AT)) == state(df)


def test_enqueue_keeps_order(spark, entries):
    out = ledger.enqueue(entries, ["x.csv", "y.csv"], "s", AT)
    added = [tuple(r) for r in out.where("position > 4").orderBy("position").collect()]
    assert added == [
        (5, "x.csv", "queued", "s", AT, None, None, None, None),
        (6, "y.csv", "queued", "s", AT, None, None, None, None),
    ]
    first = ledger.enqueue(spark.createDataFrame([], LEDGER), ["a"], "s", AT)
    assert first.first()["position"] == 0


def test_depth(entries):
    assert ledger.depth(entries, "s").first()["depth"] == 3
    assert ledger.depth(entries, "absent").first()["depth"] == 0


def test_transitions_need_no_join_or_window(entries):
    plan = ledger.mark_processed(ledger.reserve(entries, "s", "new", AT), "new", AT)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Join" not in text and "Window" not in text
