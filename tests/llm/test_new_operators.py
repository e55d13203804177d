"""Main text of pages, fill-in-middle, and ranked search, against plain versions."""

from __future__ import annotations

import hashlib
import html
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import extract, fim, queries, search
from strata.llm.blocks import leaf_blocks

from .conftest import LONG, SF_DIR

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return db


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Fill-in-middle


def plain_middle(doc_id, text):
    text = text or ""
    units, digest = UNIT.findall(text), sha(f"1:{'' if doc_id is None else doc_id}")
    n, h = len(units), [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc_id, n, "plain", None, None, text)
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 20:
        return (doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def test_middle_query(spark, db):
    got = queries.op12_fill_in_middle(spark, SF_DIR)
    want = db.execute(queries.ORACLE["op12_fill_in_middle"])
    assert got.columns == [c[0] for c in want.description]
    rows = got.collect()
    assert Counter(map(tuple, rows)) == Counter(want.fetchall())
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


MARKED = ["a <P> b", "x<S>", "<M>", "a < P> <s> b<", "<<S", "日本 語é\x00� end", "\n\n\r\n", "👍🏽 ok"]


def test_middle_awkward(spark, awkward, empty, pairs):
    more = [(100 + k, text) for k, text in enumerate(MARKED * 6)]
    docs = awkward.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    got = fim.fill_in_middle(docs).withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
    assert Counter(tuple(r)[:-1] for r in got) == Counter(plain_middle(i, t) for i, t in pairs + more)
    assert Counter(r.again for r in got) == Counter(t or "" for _, t in pairs + more)
    assert Counter(tuple(r) for r in fim.fill_in_middle(awkward).collect()) == Counter(plain_middle(i, t) for i, t in pairs)
    assert fim.fill_in_middle(empty).count() == 0


def test_middle_parameters(documents):
    none = fim.fill_in_middle(documents, cut_of_100=0)
    assert {r.form for r in none.select("form").distinct().collect()} == {"plain"}
    every = fim.fill_in_middle(documents.filter("length(text) > 0"), seed="2", cut_of_100=100, spm_of_100=100)
    assert {r.form for r in every.select("form").distinct().collect()} <= {"plain", "spm"}


# Search


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def plain_search(docs, items, k=10):
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    total, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms_of(t))
    out = []
    for item, own in asked.items():
        found = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1)]
    return out


def test_search_query(spark, db):
    got = queries.op13_search(spark, SF_DIR)
    want = db.execute(queries.ORACLE["op13_search"])
    assert sorted(got.columns) == sorted(c[0] for c in want.description)
    assert Counter(map(tuple, got.select("item_id", "rank", "doc_id", "score").collect())) == Counter(want.fetchall())


ITEMS = [(1, "W1 w59"), (2, None), (3, ""), (4, "same a B"), (5, "é word5x5"), (None, "w7 b"), (4, "word5x5"), (6, "absent"), (7, LONG)]


@pytest.mark.parametrize("passes", [1_000_000, 10_000])
def test_search_awkward(spark, awkward, empty, pairs, passes):
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id bigint, text string, rank string")
    assert Counter(map(tuple, search.search(awkward, items, terms_a_pass=passes).collect())) == Counter(plain_search(pairs, ITEMS))
    assert Counter(map(tuple, search.search(awkward, items, k=1).collect())) == Counter(plain_search(pairs, ITEMS, 1))
    if passes > 10_000:
        assert search.search(empty, items).count() == 0
        assert search.search(awkward, items.limit(0)).count() == 0


def test_search_many_equal_documents(spark):
    """Ties at the threshold, over several parts and blocks, go to the smallest ids."""
    docs = [(i, "one two three" if i % 3 else f"one two three four x{i}") for i in range(4000, 0, -1)]
    items = [(1, "three"), (2, "four one"), (3, "x3999 x3")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    got = search.search(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    assert Counter(map(tuple, got.collect())) == Counter(plain_search(docs, items))


def test_bounds_hold():
    """No bound is below its score, also where an entry is full or shared."""
    rng = np.random.default_rng(5)
    hashes = np.sort(rng.integers(0, 1 << 63, 6000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    asked, weight = hashes[::10], rng.integers(0, 20000, 600)
    rows = 40
    per = [np.sort(rng.choice(6000, 900, replace=False)) for _ in range(rows)]
    times = [rng.choice([1, 2, 3, 254, 255, 256, 100_000], 900) for _ in range(rows)]
    row = np.repeat(np.arange(rows), 900)
    lines = search.sketch(rows, row, hashes[np.concatenate(per)], np.concatenate(times))
    m = rng.integers(10, 5000, rows)
    queries_ = search.Queries(list(range(30)), [rng.choice(600, 20, replace=False) for _ in range(30)], asked, weight)
    bounds = queries_.bounds(lines, m)
    for r in range(rows):
        impact = dict(zip(per[r].tolist(), search.impact(times[r], m[r]).tolist(), strict=True))
        for q in range(30):
            assert bounds[r, q] >= sum(int(weight[t]) * impact.get(10 * int(t), 0) for t in queries_.terms[q])
    assert search.impact(np.array([10**12]), np.array([10]))[0] < search.MOST_IMPACT


# Main text


def plain_article(page):
    inner = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = (re.sub(r"</?b>", "", part.replace("<br>", " ")) for part in re.split(r"</?(?:p|h1)>", inner))
    return "\n\n".join(text for b in blocks if (text := " ".join(html.unescape(b).split())))


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF_DIR}/pages.parquet")


@pytest.fixture(scope="module")
def model(pages):
    return extract.train(pages)


def test_main_text_query(spark, pages):
    got = {(r.page_id, r.url, r.text, r.n_chars) for r in queries.op11_main_text(spark, SF_DIR).collect()}
    assert got == {(r.page_id, r.url, t := plain_article(r.html), len(t)) for r in pages.collect()}


def test_main_text_held_out(model):
    """Layouts and texts that were not learned; pages that lose the mark of their article."""
    reader, right, blocks_seen, same = extract.Reader(model), 0, 0, 0
    for seed in range(50_000, 50_150):
        page, main = extract.made_page(seed)
        blocks = leaf_blocks(page)
        got = set(reader.main(blocks))
        right += sum((b.text in got) == (b.text in main) for b in blocks)
        blocks_seen += len(blocks)
        same += got == main
    assert right / blocks_seen > 0.99 and same / 150 > 0.95


def test_main_text_without_the_mark(pages, model):
    reader, rows = extract.Reader(model), pages.collect()
    bare = [r.html.replace("<article>", "<div>").replace("</article>", "</div>") for r in rows]
    same = sum("\n\n".join(reader.main(leaf_blocks(page))) == plain_article(r.html) for page, r in zip(bare, rows, strict=True))
    assert same / len(rows) > 0.93


STORY = """<body><header><a href=/>Site name</a></header><nav><a href=/a>One</a> <a href=/b>Two</a></nav>
<div class="cookie-notice"><p>We use cookies, as everyone does.</p><button>Accept</button></div>
<article><h1>A  title &amp;
 more</h1><p>First text of the story, <a href=/c>with a link</a>.<script>var x = "<p>no</p>";</script>
<div class="ad">Buy things now, they are cheap.</div><p>Second&nbsp;text &lt;b&gt; of the <i>sto</i>ry.<ul><li>point one.<li>point two.</ul>
<form><label>Mail address</label><input><button>Send</button></form>
<section class="comments"><h2>Comments</h2><article class="comment"><p>I liked this very much, thanks.</p></article></section></article>
<aside><p>Other stories that you may like.</p></aside><footer>&copy; Someone</footer></body>"""


def test_main_text_awkward(spark, model):
    rows = [(1, "u", STORY, "x"), (1, "u", STORY, "x"), (2, None, None, "x"), (3, "", "", "x"), (None, "v", "<nav><a href=/>x</a></nav>", "x"),
            (4, "w", f"<article><h1>Long</h1><p>{LONG}.</p></article>", "x"), (5, "w", "<p" * 1000, "x"), (6, "w", "<!-- <p>open", "x")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = extract.main_text(frame, model).collect()
    text = "A title & more\n\nFirst text of the story, with a link.\n\nSecond text <b> of the story.\n\npoint one.\n\npoint two."
    want = [(1, "u", text), (1, "u", text), (2, None, ""), (3, "", ""), (None, "v", ""), (4, "w", f"Long\n\n{' '.join(LONG.split())}."), (5, "w", ""), (6, "w", "")]
    assert Counter((r.page_id, r.url, r.text) for r in got) == Counter(want)
    nothing = frame.limit(0)
    assert extract.main_text(nothing, extract.train(nothing)).count() == 0


def test_blocks():
    texts = lambda page: [b.text for b in leaf_blocks(page)]
    assert texts("a<br>b<p>c<b>d</p>e<div>f</div><!-- g --><style>h</style>i<td") == ["a b", "cd", "e", "f", "i"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul>d</ul><textarea><p>e</textarea>1 < 2 &am") == ["a", "b", "c", "d", "1 < 2 &am"]
    assert texts("<title>x &am</title>") == texts("<script>a") == texts("<!-- <p>a") == texts("<p>") == []
    assert [sorted(b.around) for b in leaf_blocks('<div id="sideBar" class=\'ad big\'><p>x</div><p>y')] == [
        [".ad", ".bar", ".big", ".side", "div", "p"], ["p"]]


@pytest.mark.parametrize("piece", ["<a ", '<a "', "<!--", "<p>", "<div class=a>", "<script>", "</p>", "<li><ul>", "<b></i>", "&", "<b x='"])
def test_blocks_stay_linear(piece):
    assert leaf_blocks(piece * 50_000 + ">") is not None


def test_viterbi_and_chances_against_all_sequences():
    change = ((0.3, -0.7), (-0.2, 0.9))
    score = [0.4, -1.1, 0.2, -0.3, 2.0]
    weigh = lambda s: sum(score[i] * x for i, x in enumerate(s)) + sum(change[a][b] for a, b in zip(s, s[1:], strict=False))
    every = [tuple((k >> i) & 1 for i in range(5)) for k in range(32)]
    assert tuple(extract.viterbi(score, change)) == max(every, key=weigh)
    chance = np.exp([weigh(s) for s in every])
    chance /= chance.sum()
    padded = np.array([score + [9.0], [5.0, 0, 0, 0, 0, 0]])
    main, pair = extract._chances(padded, np.array([5, 1]), np.array(change))
    assert np.allclose(main[0, :5], [sum(p for s, p in zip(every, chance, strict=True) if s[i]) for i in range(5)])
    assert np.isclose(main[1, 0], 1 / (1 + np.exp(-5.0)))
    both = sum(p for s, p in zip(every, chance, strict=True) for a, b in zip(s, s[1:], strict=False) if a and b)
    assert np.isclose(pair[1, 1], both)


