"""Operators on whole tables: order, decontamination, mixing, URLs, components, and the pipeline."""

from __future__ import annotations

from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import decontaminate, mix, near, order, queries, rules, urls
from strata.llm.components import components

from . import brute
from .conftest import SF_DIR


def stream(spark, path):
    """All tokens of a table written as one part: sequence ``i`` stands at the rank of its permuted number."""
    rows = order.read(spark, path).orderBy("slot").collect()
    assert [r.slot for r in rows] == list(range(len(rows)))
    numbers = spark.read.json(f"{path}/manifest").first()["numbers"]
    slots = np.argsort(np.argsort(order.permute(np.arange(len(rows)), numbers)))
    return np.frombuffer(b"".join(bytes(rows[s].tokens) for s in slots), "<u2")


def decoded(ids, n):
    with open(order.TOKENIZER, "rb") as file:
        encoding = order.encoding(file.read())
    texts, at = [], 0
    for cut in np.flatnonzero(ids == order.SEPARATOR)[:n].tolist():
        texts.append(encoding.decode(ids[at:cut].tolist()))
        at = cut + 1
    return texts, ids[at:]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation(size):
    numbers = np.arange(size)
    slots = order.permute(numbers, size)
    assert sorted(slots.tolist()) == numbers.tolist()
    assert (order.permute(slots, size, back=True) == numbers).all()
    if size > 100:
        assert (slots != numbers).mean() > 0.9
        assert (slots != order.permute(numbers, size, "other")).any()


def test_order_round_trip(spark, documents, tmp_path):
    path = order.materialise(documents.coalesce(1), str(tmp_path / "order"), sequence_tokens=64, shard_sequences=100)
    got, _ = decoded(stream(spark, path), documents.count())
    assert Counter(got) == Counter(r.text for r in documents.select("text").collect())
    later = order.read(spark, path, 250)
    assert later.agg(F.min("slot")).first()[0] == 250 and [x for x in order.shards(spark, path) if x[1] + x[2] <= 250] and later.filter("slot < 250").count() == 0
    for row in later.limit(3).collect():
        (file,) = (tmp_path / "order" / "shards" / f"shard={row.shard}").glob("part-*")
        assert file.read_bytes()[row.byte_offset :][:128] == bytes(row.tokens)


def test_order_awkward(spark, awkward, empty, tmp_path):
    path = order.materialise(awkward.coalesce(1), str(tmp_path / "a"), sequence_tokens=64, shard_sequences=5000)
    got, rest = decoded(stream(spark, path), awkward.count())
    assert Counter(got) == Counter(r.text or "" for r in awkward.select("text").collect())
    assert set(rest.tolist()) <= {order.SEPARATOR} and len(rest) < 64
    assert order.read(spark, order.materialise(empty, str(tmp_path / "b"))).count() == 0


def test_order_of_many_parts(spark, documents, tmp_path):
    """Every token is written once, whatever the parts; parts fill up their last sequence only."""
    path = order.materialise(documents.repartition(5), str(tmp_path / "order"), sequence_tokens=64, shard_sequences=100)
    with open(order.TOKENIZER, "rb") as file:
        encoding = order.encoding(file.read())
    got = Counter(np.frombuffer(b"".join(bytes(r.tokens) for r in order.read(spark, path).collect()), "<u2").tolist())
    want = Counter(t for r in documents.collect() for t in encoding.encode_ordinary(r.text or ""))
    filled = got.pop(order.SEPARATOR) - documents.count()
    assert got == want and 0 <= filled < 64 * 8


def test_order_query(spark):
    got = queries.op5_training_order(spark, SF_DIR)
    assert got.count() == got.agg(F.max("slot")).first()[0] + 1


def test_decontaminate_query(spark, texts):
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    want = {i for i, t in texts if any(item in (t or "") for item in items)}
    got = {r.doc_id for r in queries.op7_decontaminate(spark, SF_DIR).collect()}
    assert want <= got
    assert len(got - want) <= 1


QUESTION = "If Alice has {} apples and gives {} km of them to {} then how many apples does {} keep today"


def test_templates(spark, empty):
    docs = [
        (1, "Well then. " + QUESTION.format(12, 5, "Bob", "Alice")),
        (2, QUESTION.replace("Alice", "Carol").format(31, 7, "Dave", "Carol")),
        (3, QUESTION.replace("Alice", "Carol").format(31, 7, "Dave", "Erin")),
        (4, QUESTION.format("twelve", "five", "nobody", "somebody")),
        (5, None), (6, ""), (None, QUESTION.format(12, 5, "Bob", "Alice")),
        (7, "one two three four five and more"), (7, "one two three four five and more"),
    ]
    items = [(9, QUESTION.format(12, 5, "Bob", "Alice")), (10, None), (11, "one two three four five"), (12, "1 2 3 4 5 6 7 8 9"), (None, "a")]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("hash", F.lit("clash"))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id, r.exchanged) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert got == {(1, 9, False), (2, 9, True), (7, 11, False)}
    long = [f"word{'abcdefghijklmnopqrstuvwxyz'[k % 26]}{'abcdefghijklmnopqrstuvwxyz'[k // 26]}" for k in range(120)]
    parts = spark.createDataFrame([(1, " ".join(long[40:53])), (2, " ".join(long[40:52])), (3, " ".join(long))], "doc_id bigint, text string")
    whole = spark.createDataFrame([(9, " ".join(long))], "item_id bigint, text string")
    assert {r.doc_id for r in decontaminate.contaminated(parts, whole).collect()} == {1, 3}
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(empty, benchmark).count() == 0


def test_verbatim_items(spark):
    """Copies are found whatever their slots and case; slots do not make up for other words."""
    rows = "Add 17 and 25 then 31 minus 8 by 4 over 2 and 96 less 5 or 7"
    items = {
        1: "What is 12 plus 7 minus 3", 2: rows, 3: "1 2 3 4 5 6 7 8 9",
        4: "Did Ann Lee or Bob Ray or Élodie Noël meet Tom Fox near Old York", 5: "4 5 6 7 8",
    }
    docs = [
        (1, "x " + items[1] + "? y"), (2, "so " + rows.lower() + " it is"), (3, "n 1 2 3 4, 5 6 7 8 9 n"), (4, items[4].lower()), (5, items[4].upper()),
        (6, "What is 12 plus 7 minus 4"), (7, "Add 1 and 2 then 3 minus 4 by 5 over 6 and 7 less 8 or 9"), (8, "9 8 7 6 5 4 3 2 1"), (9, "did ann lee or bob ray"),
    ]
    got = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    )
    got = {(r.doc_id, r.item_id, r.covered, r.exchanged) for r in got.collect()}
    assert got == {(1, 1, 1.0, False), (2, 2, 1.0, False), (3, 3, 1.0, False), (3, 5, 1.0, False), (4, 4, 1.0, False), (5, 4, 1.0, False)}


def test_near_copies_of_items(spark):
    """A value that clashes elsewhere does not void passages that are word for word the item's."""
    words = [f"word{'abcdefghijklmnopqrstuvwxyz'[k % 26]}{'abcdefghijklmnopqrstuvwxyz'[k // 26]}" for k in range(90)]
    item = " ".join([*words[:20], "5", *words[20:60], "3", *words[60:70], "4", *words[70:], "5"])
    docs = [(1, item[:-1] + "6"), (2, item.replace(" 3 ", " 7 ").replace(" 4 ", " 7 ")), (3, item.replace(" 5", " 6"))]
    got = decontaminate.contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(9, item)], "item_id bigint, text string")
    )
    got = {r.doc_id: r for r in got.collect()}
    assert set(got) == {1, 2, 3} and got[1].covered == got[3].covered == 1 and 0.7 < got[2].covered < 1
    assert got[1].exchanged and got[3].exchanged and not got[2].exchanged


def test_decontaminate_awkward(awkward, spark):
    benchmark = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20, 50)))], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(awkward, benchmark).collect()}
    assert got == {(i, 1) for i in (1, 2, 3, 7)}


def oracle(sf_dir):
    db = duckdb.connect()
    for name in ("documents", "pages"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def test_mix_query(spark):
    got = queries.op9_mix(spark, SF_DIR)
    assert sorted(map(tuple, got.collect())) == sorted(oracle(SF_DIR).execute(queries.ORACLE["op9_mix"]).fetchall())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def targets(sizes: dict) -> dict:
    """Capping in rounds, as the contract words it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    capped: dict = {}
    while True:
        free = [s for s in names if s not in capped]
        left = sum(sizes.values()) - sum(capped.values())
        share = {s: weight[s] * left / sum(weight[x] for x in free) for s in free}
        over = {s: 3.0 * sizes[s] for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {**capped, **share}
        capped |= over


def test_mix_awkward(spark, awkward, empty, pairs):
    got = mix.mix(awkward).collect()
    sizes: dict = defaultdict(int)
    taken: dict = defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
    want = targets(dict(sizes))
    assert {r.source: pytest.approx(want[r.source]) for r in got} == {r.source: r.target for r in got}
    assert Counter(r.size for r in got) == Counter(len(brute.words(t)) for _, t in pairs)
    assert mix.mix(empty).count() == 0
    again = mix.mix(awkward.repartition(5)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_mix_hot_source(spark):
    """A source with a third of all rows, many ties in size, and sources too small for their share."""
    docs = [(i, "w " * (1 + i % 7), "hot" if i % 3 else f"s{i % 30}") for i in range(6000)]
    got = mix.mix(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).collect()
    sizes: dict = defaultdict(int)
    taken: dict = defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    want = targets(dict(sizes))
    assert all(abs(taken[s] - want[s]) <= 7 for s in sizes)


def test_mix_cut_on_the_target(spark):
    """Documents of one size whose running sum meets the target exactly: no document more is taken."""
    docs = [(i, "w " * 10, "ab"[i % 2]) for i in range(30)]
    got = mix.mix(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).collect()
    taken: dict = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
    assert taken == {"a": 100, "b": 200}


def mixed(spark, docs):
    got = mix.mix(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).collect()
    taken: dict = defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
    assert len(got) == len(docs) and all(0 <= r.taken <= 3 * r.size for r in got)
    return taken, {r.source: r.target for r in got}


@pytest.mark.parametrize("name", [7, None])
@pytest.mark.parametrize("texts", [1, 4, 30])
def test_mix_rows_that_share_an_id(spark, name, texts):
    """Rows of one id, or of none, with one text, a few or one each: the target is met within a document."""
    docs = [(name, f"t{i % texts} " * 10, "abc"[i % 3] if i % 5 else None) for i in range(90)]
    taken, want = mixed(spark, docs)
    assert all(abs(taken[s] - want[s]) <= 10 for s in want)


def test_mix_equal_rows_over_many_files(spark):
    docs = spark.range(3000).select(F.lit(None).cast("bigint").alias("doc_id"), F.lit("a b").alias("text"), F.when(F.col("id") % 3 > 0, "hot").otherwise("x").alias("source"))
    got = mix.mix(docs.repartition(7))
    sums = {r.source: r for r in got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.count("*").alias("n")).collect()}
    assert all(abs(r.taken - r.target) <= 2 for r in sums.values()) and {s: r.n for s, r in sums.items()} == {"hot": 2000, "x": 1000}


def test_mix_odds_grow_with_the_root_of_the_size(spark):
    """A source of which a part is taken: the odds of long documents over those of short ones, near the root of the sizes' ratio."""
    docs = [(i, "w " * (4 if i % 2 else 64), "b" if i < 20_000 else "a") for i in range(24_000)]
    got = mix.mix(spark.createDataFrame(docs, "doc_id bigint, text string, source string"))
    shares = {r["size"]: r.share for r in got.filter("source = 'b'").groupBy("size").agg(F.avg(F.col("copies") - F.floor(F.col("target") / F.col("source_size"))).alias("share")).collect()}
    odds = {size: share / (1 - share) for size, share in shares.items()}
    assert odds[64] / odds[4] == pytest.approx(4, rel=0.25)


def test_url_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in queries.op10_url_filter(spark, SF_DIR).collect():
        host, path, rule, verdict = brute.url(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.confidence else "allow"))


def test_url_awkward(spark):
    rows = ["HTTP://WWW.Example.COM/en/x?y#z", "example.com/en/", None, "", "x://", "a://b://c/d", "https://example.com", "https://example.com/en/", "https://exÄmple.NET/es/1",
            "https://badexample.com/en/", "://net/fr/", "q?u=http://net/es/x", "h://net?/es/", "h://a.net#/es/", "x\ny://com/\n?k"]
    pages = spark.createDataFrame([*enumerate(rows), (None, "h://com/"), (0, rows[0])], "page_id bigint, url string")
    pages = pages.withColumn("rule", F.lit("clash")).withColumn("tokens", F.lit("clash"))
    none = spark.createDataFrame([], "page_id bigint, bad boolean")
    got = urls.url_filter(pages, none).collect()
    want = Counter((brute.url(u)[0], brute.url(u)[1], brute.url(u)[2], brute.url(u)[3] or "allow") for u in [*rows, "h://com/", rows[0]])
    assert Counter((r.host, r.path, r.rule, r.verdict) for r in got) == want
    assert urls.url_filter(pages.limit(0), none).count() == 0


def test_url_rules_are_mined(spark):
    def address(i):
        host = "casino-win" if i % 5 == 0 else f"site{i}"
        return f"https://{host}.example.org/{'shop' if i % 2 else 'news'}/{i}"

    pages = spark.createDataFrame([(i, address(i)) for i in range(600)], "page_id bigint, url string")
    labels = [(i, i % 5 == 0) for i in range(0, 600, 3)] + [(1, True), (1, False), (2, None), (None, True)]
    got = urls.url_filter(pages, spark.createDataFrame(labels, "page_id bigint, bad boolean")).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == set(range(0, 600, 5))


def test_url_rules_of_many_tokens(spark):
    """Only all five parts of a path together go with the label."""
    parts = "abcde"
    paths = [parts] * 40 + [parts.replace(x, "") for x in parts for _ in range(40)]
    pages = spark.createDataFrame([(i, f"h://x/{'/'.join(p)}") for i, p in enumerate(paths)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, p == parts) for i, p in enumerate(paths)], "page_id bigint, bad boolean")
    assert {r.page_id for r in urls.url_filter(pages, labels).collect() if r.verdict == "block"} == set(range(40))


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1040)] + [(2000, k) for k in range(2001, 2100)]
    want = brute.components({x for p in pairs for x in p}, pairs)
    frame = spark.createDataFrame([*pairs, (5, 5), (None, 3), (7, None)], "a bigint, b bigint")
    got = {r.node: r.component for r in components(frame).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: want[x] for x in linked}
    assert components(frame.limit(0)).count() == 0


def test_pipeline_stages(spark, documents, tmp_path):
    """Each stage against its plain version, on what the stage before it kept."""
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.saved(stage(spark, before, SF_DIR), "test-stage")
        seen[name] = (before, docs)
        if name != "training order":
            assert docs.columns == documents.columns
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    before, after = seen["quality rules"]
    judged = rules.quality_rules(before, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert ids(after) == ids(judged.filter("kept"))
    before, after = seen["minhash near-dedup"]
    kept = {i for i, _, _, ok in brute.near([tuple(r) for r in before.select("doc_id", "text").collect()]) if ok}
    assert ids(after) == kept and ids(near.near_duplicates(before).filter("kept")) == kept
    before, after = seen["benchmark decontamination"]
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert ids(before) - ids(after) >= {r.doc_id for r in before.collect() if any(x in r.text for x in items)}
    assert len(ids(before) - ids(after)) < 0.1 * before.count() + 3
    before, after = seen["mixing to target weights"]
    copies = {r.doc_id: r.copies for r in mix.mix(before).collect()}
    assert Counter(r.doc_id for r in after.select("doc_id").collect()) == Counter({i: n for i, n in copies.items() if n})
    before, after = seen["training order"]
    path = order.materialise(before.coalesce(1), str(tmp_path / "order"))
    got, _ = decoded(stream(spark, path), before.count())
    assert Counter(got) == Counter(r.text for r in before.collect())
    assert after.count() >= order.read(spark, path).count()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_awkward(spark, awkward, empty, name, stage):
    got = stage(spark, awkward, SF_DIR)
    if name != "training order":
        assert got.columns == awkward.columns
    if name in ("minhash near-dedup", "benchmark decontamination"):
        assert got.filter("doc_id IS NULL").count() == 2
    assert got.count() > 0
    assert stage(spark, empty, SF_DIR).count() == 0


def test_pipeline_query(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
