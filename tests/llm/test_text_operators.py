"""Operators on single texts and their windows, against their brute-force versions."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import langid, licences, near, pii, queries, repeats, rules

from . import brute
from .conftest import SF_DIR


def test_repeats_query(spark, texts):
    got = queries.op1_repeated_passages(spark, SF_DIR)
    assert set(map(tuple, got.collect())) == brute.repeats(texts)


def test_repeats_awkward(awkward, empty, pairs):
    got = repeats.repeated_passages(awkward).collect()
    with_id = [p for p in pairs if p[0] is not None]
    want = {(i, n, gone) for i, n, gone, _ in brute.repeats(with_id)}
    assert {(r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans)) for r in got if r.doc_id is not None} == want
    assert len(got) == len(pairs)
    free = [r for r in got if r.doc_id is None]
    assert all(not r.spans for r in free) and {r.n_words for r in free} == {0, 60}
    assert repeats.repeated_passages(empty).count() == 0


def test_repeats_windows_of_several_documents(spark):
    """A window covered half by one earlier document and half by another stays; overlapping windows of both go."""
    a, b = [f"a{i}" for i in range(80)], [f"b{i}" for i in range(80)]
    docs = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a[10:70] + b[5:64])), (4, " ".join(a[50:80] + b[:30])),
            (5, " ".join(a[20:69] + ["z"] + b[1:51])), (6, " ".join(a[10:70] + b[5:64] + a[:49]))]
    got = repeats.repeated_passages(spark.createDataFrame(docs, "doc_id bigint, text string"))
    got = got.select("doc_id", "n_words", F.sha2("kept", 256).alias("h")).collect()
    assert {(r.doc_id, r.n_words, r.h) for r in got} == {(i, n, h) for i, n, _, h in brute.repeats(docs)}


def test_repeats_of_rows_that_share_an_id(spark):
    """Each row loses its own windows only, whatever else stands under its id."""
    a = [f"a{i}" for i in range(80)]
    docs = [(1, " ".join(a)), (2, " ".join([f"x{i}" for i in range(120)] + a[5:70])), (2, " ".join(a[15:68] + ["y1", "y2", "y3"])),
            (3, " ".join(["z"] + a[20:75]))]
    got = repeats.repeated_passages(spark.createDataFrame(docs, "doc_id bigint, text string"))
    got = got.select("doc_id", "n_words", F.sha2("kept", 256).alias("h")).collect()
    assert {(r.doc_id, r.n_words, r.h) for r in got} == {(i, n, h) for i, n, _, h in brute.repeats(docs)}


def test_repeats_few_documents_show_windows(spark):
    """A phrase that all documents hold between other words opens no context; only copies changed on one side do."""
    phrase = " ".join(f"p{i}" for i in range(30))
    docs = [(k, " ".join(f"l{k}x{i}" for i in range(60)) + f" {phrase} " + " ".join(f"r{k}x{i}" for i in range(60))) for k in range(40)]
    changed = docs[7][1].split()
    changed[100] = "other"
    docs.append((40, " ".join(changed)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    opened = {r.doc_id for r in repeats.recurring(frame).filter("open").select("doc_id").collect()}
    assert opened == {7, 40}
    got = repeats.repeated_passages(frame).select("doc_id", "n_words", F.sha2("kept", 256).alias("h")).collect()
    assert {(r.doc_id, r.n_words, r.h) for r in got} == {(i, n, h) for i, n, _, h in brute.repeats(docs)}


def test_repeats_of_edited_copies(spark):
    """Copies with words changed, moved or dropped anywhere, against brute force."""
    pick = random.Random(11)
    docs = []
    for k in range(60):
        if k < 6:
            own = [f"w{pick.randrange(40)}" for _ in range(pick.randint(55, 300))]
        else:
            a, b = pick.choice(docs)[1].split(), pick.choice(docs)[1].split()
            cut = pick.randrange(len(a))
            own = a[:cut] + b[pick.randrange(len(b)) :] + [f"x{k}"] * pick.randrange(3)
            for _ in range(pick.randrange(4)):
                own[pick.randrange(len(own))] = f"y{pick.randrange(5)}"
        docs.append((k, " ".join(own)))
    got = repeats.repeated_passages(spark.createDataFrame(docs, "doc_id bigint, text string"))
    got = got.select("doc_id", "n_words", F.sha2("kept", 256).alias("h")).collect()
    assert {(r.doc_id, r.n_words, r.h) for r in got} == {(i, n, h) for i, n, _, h in brute.repeats(docs)}


def test_near_query(spark, texts):
    assert set(map(tuple, queries.op6_near_duplicates(spark, SF_DIR).collect())) == brute.near(texts)


@pytest.mark.parametrize("size", [near.GROUP_SHINGLES, 400])
def test_near_chain_in_blocks(spark, size):
    """Each text is near to the next one only, so the first and last are linked through all others."""
    base = [f"t{i}" for i in range(400)]
    docs = [(k + 1, " ".join(base[: 400 - 12 * (14 - k)] if k % 2 else base[: 400 - 12 * (14 - k)])) for k in range(15)]
    docs += [(100 + k, " ".join(f"u{k}v{i}" for i in range(40))) for k in range(5)]
    got = near.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), group_shingles=size)
    assert set(map(tuple, got.collect())) == brute.near(docs)


def test_near_awkward(awkward, empty, pairs):
    got = near.near_duplicates(awkward).collect()
    with_id = [p for p in pairs if p[0] is not None]
    assert {tuple(r) for r in got if r.doc_id is not None} == brute.near(with_id)
    assert len(got) == len(pairs)
    assert all(r.kept and r.component_id in (None, 1) for r in got if r.doc_id is None)
    assert near.near_duplicates(empty).count() == 0


def test_rules_query(spark, texts, documents):
    got = queries.op3_quality_rules(spark, SF_DIR).collect()
    text = dict(texts)
    for r in got:
        n, chars, symbols, again, repeated = brute.statistics(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, again, repeated)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert r.kept == (not r.base_failed and r.rule == 0)
    assert len(got) == len(texts)


def test_rules_are_learned(spark):
    stats = [(i, f"{'%' if i % 4 == 0 else ''}word{i} " * 3 + " ".join(f"t{i}x{k}" + ("###" if i % 4 == 0 else "") for k in range(60))) for i in range(400)]
    docs = spark.createDataFrame(stats, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(0, 400, 2)], "doc_id bigint, quality int")
    got = rules.quality_rules(docs, labels)
    assert {r.doc_id for r in got.filter("NOT kept").collect()} == set(range(0, 400, 4))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rules_awkward(awkward, labels, empty, pairs):
    got = rules.quality_rules(awkward, labels).collect()
    assert Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter(brute.statistics(t) for _, t in pairs)
    assert rules.quality_rules(empty, labels).count() == 0
    none = labels.limit(0)
    assert all(r.kept != r.base_failed for r in rules.quality_rules(awkward, none).collect())


def test_language_held_out(spark):
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    got = queries.op4_language(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right, n = got.filter("held_out AND lang IS NOT NULL").agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right / n > 0.97


def test_language_awkward(awkward, empty, pairs):
    learned = langid.dictionaries(awkward)
    assert "" in learned and None not in learned
    got = langid.languages(awkward, learned).collect()
    assert len(got) == len(pairs)
    assert {r.lang_pred for r in got if r.doc_id in (4, 5)} == {"und"}
    assert all(0 <= r.score <= 1 and (r.lang_pred in learned or r.lang_pred == "und") for r in got)
    assert langid.languages(empty, learned).count() == 0
    assert {r.lang_pred for r in langid.languages(awkward, langid.dictionaries(empty)).collect()} == {"und"}


def test_language_of_long_texts(spark):
    """A language is learned from texts of any length, and ties go by all of them."""
    def text(lang, i, n):
        return " ".join(f"{lang}{'abcdefghij'[(i + k) % 10]}{'klmnopqrst'[(k * k + i) % 10]}" for k in range(n))

    rows = [(lang, text(word, i, n)) for lang, word, n, count in (("s", "eri", 50, 20), ("l", "uvo", 3000, 30)) for i in range(count)]
    learned = langid.dictionaries(spark.createDataFrame(rows, "lang string, text string"))
    assert list(learned) == ["l", "s"]
    assert all(len(content) <= langid.DICTIONARY_BYTES for content in learned.values())
    docs = spark.createDataFrame([(1, text("uvo", 77, 40)), (2, text("eri", 77, 40))], "doc_id bigint, text string")
    assert {(r.doc_id, r.lang_pred) for r in langid.languages(docs, learned).collect()} == {(1, "l"), (2, "s")}
    parts = [f"{k:04d}" for k in range(3000)]
    got = spark.createDataFrame([("".join(parts),)], "text string").select(langid.excerpt(F.col("text")).alias("x")).first().x
    assert got.startswith("0000") and got.endswith("2999") and len(got) == langid.SAMPLE_CHARS + langid.SAMPLE_BLOCKS - 1


def test_licences_query(spark, texts):
    got = {r.doc_id: tuple(r)[1:6] for r in queries.op8_licences(spark, SF_DIR).collect()}
    assert got == {i: brute.licences(t) for i, t in texts}


def test_licences_awkward(awkward, empty, spark, pairs):
    assert Counter(tuple(r)[1:6] for r in licences.licences(awkward).collect()) == Counter(brute.licences(t) for _, t in pairs)
    assert licences.licences(empty).count() == 0
    tricky = [
        (1, "Under  the-MIT\nlicense under the mit license, Apache License Version 2 CC-BY-NC cc by nc by"),
        (2, "// SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0) OR Apache-2.0 */\nx"),
        (3, "SPDX-License-Identifier: MIT AND"),
        (4, "under the mitlicense; under the mit licenses"),
        (5, "SPDX-License-Identifier: MIT AND GPL-3.0-or-later\nspdx-license-identifier: Zlib"),
    ]
    got = {r.doc_id: r for r in licences.licences(spark.createDataFrame(tricky, "doc_id bigint, text string")).collect()}
    assert all(tuple(got[i])[1:6] == brute.licences(t) for i, t in tricky)
    assert (got[2].labels, got[2].duty) == ("apache-2,gpl-2", 0)
    assert (got[3].labels, got[3].score, got[3].duty) == ("", 0.0, None)
    assert (got[5].labels, got[5].duty) == ("gpl-3,mit,zlib", 2)


@pytest.mark.parametrize("bad", ["", "MIT OR", "AND MIT", "(MIT", "MIT)", "MIT Apache-2.0", "MIT (BSD)", "()", "!", "MIT OR OR BSD"])
def test_malformed_expressions(bad):
    with pytest.raises(ValueError):
        licences.evaluate(bad)


def test_expression_precedence():
    assert licences.postfix("A OR B AND C WITH D") == ["A", "B", "C", "D", "WITH", "AND", "OR"]
    assert licences.postfix("(A OR B) AND C") == ["A", "B", "OR", "C", "AND"]
    assert licences.evaluate("MIT OR GPL-3.0-only AND MPL-2.0") == ({"mit", "gpl-3", "mpl-2.0"}, 0)
    assert licences.evaluate("(MIT OR GPL-3.0-only) AND MPL-2.0")[1] == 1


TRICKY = [
    "a@b.c_d@e.f x@y.z@w.v 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.4 1.2.3.999 +1 (23) 456-7890-12 +1 2 . 4111 1111 1111 1111",
    "é@é é4111111111111111é +49 30 1234567é 4111-1111-1111-1111- 4111  1111 1111 1111 41111111111111112345678",
    "+1 234 +123456789012345678 ++12345678901 a.b+c%d@x-y.example.com. a@b @c.d a@.b",
    "1" * 20_000,
    "a" * 20_000,
    "+" * 2000 + "1." * 2000,
    "",
    None,
    "😀 a@b.cd 😀 10.0.0.1 😀 +12 345 678 901",
]


def test_personal_data_tricky(spark):
    docs = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id bigint, text string")
    found = pii.personal_data(docs)
    got = found.select("doc_id", *(F.size(k).cast("bigint") for k in pii.KINDS), F.sha2(pii.listed(*pii.KINDS), 256)).collect()
    assert {tuple(r) for r in got} == {brute.personal_row(i, t) for i, t in enumerate(TRICKY)}


def test_personal_data_query(spark, texts):
    got = queries.op2_personal_data(spark, SF_DIR)
    assert {tuple(r)[:6] for r in got.collect()} == {brute.personal_row(i, t) for i, t in texts}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_personal_data_awkward(awkward, empty, pairs):
    assert pii.personal_data(awkward).count() == len(pairs)
    assert pii.personal_data(empty).count() == 0


def _planted(i):
    """A text, and the number in it that is spelled otherwise than the pattern of its kind asks (None: no such number)."""
    phone = f"49 30 {5550000 + i * 37} {i % 10}"
    if i % 3 == 0:
        return f"reach us, tel +{phone} any day", None
    if i % 3 == 1:
        # The number of the text before it, without the plus.
        other = f"49 30 {5550000 + (i - 1) * 37} {(i - 1) % 10}"
        return f"reach us, tel {other} any day", other
    return f"order {7000000 + i * 91} of lot {i % 90 + 10}/{i % 7}/{2000 + i % 30} sent", None


def test_personal_data_is_learned(spark):
    """Numbers that other texts give in a base form are found in another spelling, also unseen ones; others are left alone."""
    rows = [(i, *_planted(i)) for i in range(900)] + [(5000, "reach us, tel 49 30 9998887 1 any day", "49 30 9998887 1")]
    got = pii.personal_data(spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")).collect()
    found = {(r.doc_id, s.start, s.end) for r in got for s in [*r.maybe_number, *r.maybe_mail, *r.maybe_address]}
    want = {(i, t.index(n), t.index(n) + len(n)) for i, t, n in rows if n}
    assert len(found & want) >= 0.9 * len(want) and len(found & want) >= 0.95 * len(found)
    assert any(i == 5000 for i, _, _ in found)
    assert all(len(r.phone) == (r.doc_id < 5000 and r.doc_id % 3 == 0) for r in got)


def test_personal_data_choice_among_overlaps(spark):
    spans = "array(named_struct('rank', {}, 'start', {}, 'end', {}, 'generator', 'a'), named_struct('rank', -1.0D, 'start', 5, 'end', 9, 'generator', 'b'))"
    pick = lambda *first: [x.generator for x in spark.range(1).select(pii._best(F.expr(spans.format(*first)))).first()[0]]
    assert pick("-2.0D", 0, 6) == ["a"]
    assert pick("-0.5D", 0, 6) == ["b"]
    assert sorted(pick("-0.5D", 0, 5)) == ["a", "b"]
    assert pick("-1.0D", 4, 9) == ["a"]


def test_licences_of_a_text_with_many_places():
    """Work grows with the text, not with places times text."""
    text = "x cc by nc, under the MIT license. " * 100_000
    reduced = licences._TABLE[np.frombuffer(text.encode(), np.uint8)].tobytes()
    began = time.perf_counter()
    got = licences.scan(reduced, "")
    assert got[:4] == (800_000, 200_000, 1, 799_996)
    assert time.perf_counter() - began < 20


def test_language_keeps_marks():
    assert langid.letters("नमस्ते दुनिया 12_é!") == "नमस्ते दुनिया é"
    assert langid.letters("́ 12") == langid.letters("") == ""


def test_language_sample_of_many_copies(spark, monkeypatch):
    """A language of few texts in very many copies is learned; the sample does not depend on how rows are dealt out."""
    monkeypatch.setattr(langid, "SAMPLE_TEXTS", 5)
    rows = [("a", f"alpha beta {i % 2}") for i in range(3000)] + [("b", f"gamma w{i} delta") for i in range(3000)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    got = langid.dictionaries(frame)
    assert set(got) == {"a", "b"} and got == langid.dictionaries(frame.repartition(7))
    assert langid.dictionaries(frame.limit(0)) == {}


@pytest.mark.parametrize("ids", [5000, 3])
def test_quality_sample_is_the_least_hashes(spark, ids):
    """The cut leaves the rows of the least hashes, however many rows an id has."""
    rows = spark.range(5000).select(F.xxhash64(F.col("id") % ids).alias("chosen"))
    below = rules._least(rows, 100)
    order = [r.chosen for r in rows.orderBy("chosen").limit(100).collect()]
    assert [r.chosen for r in below.orderBy("chosen").limit(100).collect()] == order
    assert ids < 5000 or below.count() < 300
