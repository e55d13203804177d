"""JSON arrays cut by many tasks, against the plain reading of the whole file."""

from __future__ import annotations

import gzip
import json
import random

import pyarrow as pa
import pytest

from strata import sources
from strata.sources import arrays


@pytest.fixture
def small_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "1500", "spark.sql.files.openCostInBytes": "1"}
    former = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in former.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def record(pick, k):
    texts = ["", "} , ] {", '"', "\\", '\\"}', "é 日本 }  x", "a\nb", "x" * pick.choice([1, 40, 900]), "  }  "]
    return {"k": k, "t": pick.choice(texts), "n": {"l": [pick.choice(texts), {"z": "},{"}] * pick.randrange(3)}, "e": pick.choice([None, 1.5])}


def written(path, text):
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def lines(spark, path):
    return sorted(r.value for r in spark.read.text(arrays.as_lines(spark, path)).collect())


@pytest.mark.parametrize("style", [{}, {"indent": 1}, {"separators": (",", ":")}, {"ensure_ascii": False}])
def test_records_of_many_blocks(spark, tmp_path, small_blocks, style):
    pick = random.Random(repr(style))
    rows = [record(pick, k) for k in range(60)]
    path = written(tmp_path / "rows.json", "﻿"[: len(style) % 2] + " " + json.dumps(rows, **style) + "\n \n")
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 4
    got = [json.loads(line) for line in lines(spark, path)]
    assert sorted(got, key=lambda r: r["k"]) == rows
    df = sources.read_json(spark, path)
    assert df.count() == 60 and {(r.k, r.t) for r in df.select("k", "t").collect()} == {(r["k"], r["t"]) for r in rows}


def test_chunks_within_a_block(spark, tmp_path, monkeypatch):
    """The same records come out wherever chunks and blocks end."""
    pick = random.Random(4)
    rows = [record(pick, k) for k in range(30)]
    parts = json.dumps(rows).encode().split(b"}")
    for chunk in (1, 50, 1000):
        monkeypatch.setattr(arrays, "CHUNK", chunk)
        for blocks in ([0] * len(parts), sorted(pick.randrange(5) for _ in parts), list(range(len(parts)))):
            first = blocks[0]
            at = [b - first for b in blocks]
            batch = pa.RecordBatch.from_pydict({"value": pa.array(parts, pa.binary()), "file": ["f"] * len(parts), "at": at, "size": [len(json.dumps(rows).encode())] * len(parts)})
            states = arrays._chained([r for b in arrays._summed(iter([batch])) for r in b.to_pylist()])
            out = [r for b in arrays._cutter(states)(iter([batch])) for r in b.to_pylist()]
            edges, found = "", []
            for row in out:
                if row["kind"] == "record":
                    found.append(row["value"])
                elif row["kind"] != "figures":
                    edges += ("\0" if row["kind"] == "tail" else "") + row["value"]
            edge = edges.split("\0")
            edge[0], edge[-1] = edge[0].replace("[", "", 1), edge[-1]
            edge[-1] = edge[-1][: edge[-1].rindex("]")]
            assert sorted((json.loads(r) for r in found + edge), key=lambda r: r["k"]) == rows


@pytest.mark.parametrize(
    "text, want",
    [("[]", []), (" [ ] ", []), ('{"a": 1}', ['{"a": 1}']), ('[{"a":1}]', ['{"a":1}']), ("[1, {}]", ["1", "{}"]), ("", []), ("\n", []),
     ('[{"a":1},]', [",", '{"a":1}']), ('[,{"a":1}]', [",", '{"a":1}']), ('[{"a":1},,{"a":2}]', [",", '{"a":1}', '{"a":2}']),
     ("[[{}]]", [",[{}]"]), ("﻿{}", ["{}"])],
)
def test_small_files(spark, tmp_path, text, want):
    assert lines(spark, written(tmp_path / "rows.json", text)) == want


@pytest.mark.parametrize("text", ['[{"a":1},{"a":2}', '[{"a":1}', '{"a":1', '{"a":{"b":2}', '[{"a":1}]]', '[{"a":"x\ny"}]', '[{"a":1},[{"a":2}]]'])
def test_broken_files_leave_a_sign(spark, tmp_path, text):
    path = written(tmp_path / "rows.json", text)
    with pytest.raises(ValueError, match="JSON"):
        sources.read_json(spark, path)
    kept = sources.read_json(spark, path, sources.read_json(spark, written(tmp_path / "a.json", '{"a":"1"}')).schema, malformed="keep").collect()
    assert any(r["_malformed"] for r in kept)


@pytest.mark.parametrize("text", ['{"a":1}\n{"a":2}', '[{"a":1}][{"a":2}]', '{"a":1} 5', '[]\n{}'])
def test_several_values_in_blocks_are_refused(spark, tmp_path, small_blocks, text):
    with pytest.raises(ValueError, match="more than one JSON value"):
        sources.read_json(spark, written(tmp_path / "rows.json", " " * 700 + text))


def test_folder_of_files(spark, tmp_path, small_blocks):
    folder = tmp_path / "a b"
    folder.mkdir()
    rows = [{"k": k, "t": "x" * 50} for k in range(40)]
    written(folder / "1.json", json.dumps(rows[:20]))
    written(folder / "2.json", json.dumps(rows[20]))
    written(folder / "3.json.gz", gzip.compress(json.dumps(rows[21:39]).encode()))
    written(folder / "4.json.gz", gzip.compress(json.dumps(rows[39]).encode()))
    assert sorted(r.k for r in sources.read_json(spark, str(folder)).collect()) == list(range(40))


def test_without_a_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("strata.sources.files.has_scratch", lambda _: False)
    assert sources.read_json(spark, written(tmp_path / "rows.json", '[{"a":1},{"a":2}]')).count() == 2
