"""Embedding near-duplicates and page extraction against brute force and worked pages."""

import numpy as np
import pytest

from tessitura.llm import embedding_dedup, html_extract


def brute(rows, threshold):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    cos = lambda a, b: len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= threshold
    links = [sum(cos(a, b) for m, (_, b) in enumerate(fine) if m != n) for n, (_, a) in enumerate(fine)]
    root = {i: i for i, _ in rows if i is not None}
    for n, (i, a) in enumerate(fine):
        for j, b in fine[n + 1 :]:
            if root[i] != root[j] and cos(a, b):
                x, y = root[i], root[j]
                root = {k: min(x, y) if r in (x, y) else r for k, r in root.items()}
    return dict(zip([i for i, _ in fine], links, strict=True)), root


@pytest.mark.parametrize("rows_per_block", [None, 40])
def test_embeddings(spark, rows_per_block):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(25, 16))
    rows = [(int(i), (centres[i % 25] + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.35])).astype(np.float32).tolist()) for i in rng.permutation(220)]
    rows += [(300 + k, rows[0][1]) for k in range(5)] + [(310, None), (311, []), (312, [0.0] * 16), (313, [float("nan")] * 16), (314, [None] * 16), (315, [float("inf")] + [1.0] * 15), (316, [1.0, 2.0]), (317, [2.0, 4.0]), (318, [1e-30] * 16), (319, [3e-30] * 16), (320, [1.0] + [0.0] * 15), (321, [0.9, float(np.sqrt(1 - 0.81))] + [0.0] * 14)]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], "vec_id long, embedding array<float>, label string, key int, block int")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df, rows=rows_per_block).collect()}
    links, root = brute([(r["vec_id"], r["embedding"]) for r in df.collect()], 0.9)
    assert {i: r["n_links"] for i, r in got.items()} == {i: links.get(i, 0) for i in root}
    assert {i: r["component_id"] for i, r in got.items()} == root
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_bounds_are_rigorous():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 64)) * rng.choice([0.01, 1, 50], size=(300, 1))
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    real = unit @ unit.T
    b = embedding_dedup.Block(np.arange(300), np.ones(300), *embedding_dedup.quantised(x))
    product = b.whole.astype(np.float32) @ b.whole.astype(np.float32).T * (b.scale[:, None] * b.scale)
    bound = b.error[:, None] + b.error + b.error[:, None] * b.error
    assert (np.abs(product - real) <= bound).all() and bound.max() < 0.05
    fine = b.fine(np.arange(300))
    second = b.error2[:, None] + b.error2 + b.error2[:, None] * b.error2
    assert (np.abs(fine @ fine.T - real) <= second).all() and second.max() < 2e-4


@pytest.mark.parametrize("threshold", [0.3, 0.0, 0.9])
def test_tile_finds_what_the_product_says(threshold):
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(40, 24)), 6, axis=0) + rng.normal(size=(240, 24)) * 0.4
    x = np.concatenate([x, [[1.0] + [0.0] * 23, [0.9, np.sqrt(1 - 0.81)] + [0.0] * 22]])  # a pair at 0.9 but for rounding
    unit = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    links = (unit @ unit.T >= threshold) & ~np.eye(len(x), dtype=bool)
    b = embedding_dedup.Block(np.arange(len(x)), np.ones(len(x)), *embedding_dedup.quantised(x))
    one, two, label, i, j = embedding_dedup.tile(b, b, threshold, entries=5000)
    open_ = {frozenset(p) for p in zip(i.tolist(), j.tolist(), strict=True)}
    assert len(open_) < 0.01 * links.size and (threshold != 0.9 or frozenset((240, 241)) in open_)
    for p in open_:
        links[tuple(p)] = links[tuple(p)[::-1]] = False
    assert (one + two == links.sum(axis=1)).all()


PAGE = """<!DOCTYPE html><html lang="en"><head><title>T &amp; t</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy!</div><article><h1>T &amp; t</h1><p><b>First  line%s<br>
on&nbsp;and on<p>Second &lt;one&gt; &am</p><form>name <input></form><aside>Side</aside><div class="comments"><p>Nice</p></div><ul><li>a<li>b</ul><table><tr><td>1</td><td>2</td></tr></table></article>
<footer>&copy; host</footer></body></html>"""


def test_pages(spark):
    rows = [(i, f"https://u@Host.example:8/p/{i}", PAGE % i) for i in range(4)] + [(10, None, None), (11, "x", ""), (12, "https://one.example/", "just text &eacute;"), (13, "https://o.example/", "<article><p>cut <b>of"), (13, "https://o.example/", "<article><p>cut <b>of"), (14, "u", "<p>a<b")]
    df = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html_extract.extract(df).collect()}
    for i in range(4):
        assert got[i]["text"] == f"T & t\nFirst line{i} on and on\nSecond <one> &am\na\nb\n1 2"
    assert [got[i]["text"] for i in (10, 11, 12, 13, 14)] == ["", "", "just text é", "cut of", "a"]
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert html_extract.extract(df.limit(0)).count() == 0
    shuffled = {r["page_id"]: r["text"] for r in html_extract.extract(df, most_broadcast=0).collect()}
    assert shuffled == {i: r["text"] for i, r in got.items()}


def test_template_without_article(spark):
    page = "<html><body><div class='top'>Welcome to the site</div><div class='text'><p>Story %d tells of thing number %d at some length</p><p>It goes on %d</p></div><div class='end'>All rights kept</div></body></html>"
    df = spark.createDataFrame([(i, f"http://h.example/{i}", page % (i, i, i)) for i in range(6)], "page_id long, url string, html string")
    t = html_extract.templates(df).first()
    assert len(t["texts"]) == 2 and len(t["paths"]) == 2  # Welcome and All rights, on paths that hold nothing else
    assert html_extract.main_text(page % (1, 1, 1)).startswith("Welcome")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert got == {i: f"Story {i} tells of thing number {i} at some length\nIt goes on {i}" for i in range(6)}


def test_copies_and_further_slots_without_article(spark):
    page = "<html><body><div class='top'>Welcome to the site</div><h1>Title %d</h1><div class='text'><p>Story %d tells of things</p></div><div class='more'><p>More %d</p></div></body></html>"
    rows = [(i, f"http://h.example/{i}", page % (i, i, i)) for i in range(4)] + [(10 + i, f"http://h.example/c{i}", page % (9, 9, 9)) for i in range(4)]
    rows += [(20 + i, f"http://two.example/{i}", page % (7, 7, 7)) for i in range(2)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, k in [*((i, i) for i in range(4)), *((10 + i, 9) for i in range(4))]:
        assert got[i] == f"Title {k}\nStory {k} tells of things\nMore {k}"
    assert all(got[20 + i].endswith("Title 7\nStory 7 tells of things\nMore 7") for i in range(2))


def pages_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


GOLD = {
    # site: (page, main text) with the page's number put in
    "plain": ("<body><div id=x><a href=/>Start</a> <a href=/b>About us</a></div><article><h1>Head %d</h1><p>Body of %d with words</p></article><div>Imprint</div></body>", "Head %d\nBody of %d with words"),
    "main": ("<body><main><div class='tools'><span>Print</span></div><div class='hint'>We store small files</div><h1>Head %d</h1><p>Long body of %d</p><p>A sentence that all share</p></main></body>", "Head %d\nLong body of %d\nA sentence that all share"),
    "bare": ("<body><ul class=m><li>One<li>Two<li>Three</ul><h1>Title %d</h1><div class=body><p>Words of %d</p><p>and more</p></div><div class=legal>All rights kept</div></body>", "Title %d\nWords of %d\nand more"),
    "teaser": ("<body><article>Read this too</article><h1>Heading %d</h1><div>The body %d stands in a div and is much longer than the teaser</div></body>", "Read this too\nHeading %d\nThe body %d stands in a div and is much longer than the teaser"),
    "names": ("<body><article><div class='social-studies'><p>On society %d</p></div><div class='share-holder-report'>Gains of %d</div><div class='cookie-banner'>We bake</div><a title=it's href=x>A link</a> isn't lost</article></body>", "On society %d\nGains of %d\nA link isn't lost"),
}


def test_template_decides(spark):
    """Worked sites with and without article or main; without the template most texts would be others."""
    rows = [(100 * k + i, f"http://{site}.example/{i}", page % (i, i)) for k, (site, (page, _)) in enumerate(GOLD.items()) for i in range(8)]
    want = {100 * k + i: text % (i, i) for k, (_, text) in enumerate(GOLD.values()) for i in range(8)}
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages_frame(spark, rows)).collect()}
    assert got == want
    without = {r[0]: html_extract.main_text(r[2]) for r in rows}
    assert sum(without[i] != got[i] for i in want) == 8 * 3  # the tools and hints in main, the menu and the legal notice beside the body, the links and the imprint beside the article


def test_shared_sentence_and_copies_stay(spark):
    page = "<body><nav>Menu</nav><article><h1>T %d</h1><p>One %d</p>%s<p>Two %d</p></article></body>"
    line = "<p>The same sentence in many articles</p>"
    rows = [(i, "http://h.example/x", page % (i, i, line if i % 4 else "", i)) for i in range(20)] + [(50 + k, "http://h.example/x", page % (9, 9, line, 9)) for k in range(30)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages_frame(spark, rows)).collect()}
    assert all(got[i] == f"T {i}\nOne {i}\n" + ("The same sentence in many articles\n" if i % 4 else "") + f"Two {i}" for i in range(20))
    assert {got[50 + k] for k in range(30)} == {got[9]}


def test_broken_attributes_and_clashing_columns(spark):
    assert html_extract.main_text("<p title=it's>one</p><p>isn't <b class='x>y'>two</b></p><p a=\"") == "one\nisn't two"
    df = pages_frame(spark, [(1, "u", "<p>a"), (None, None, None)]).selectExpr("page_id", "url", "html", "1 AS text", "2 AS n_chars", "3 AS host", "4 AS texts", "5 AS paths", "6 AS id")
    out = html_extract.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and {(r["page_id"], r["text"]) for r in out.collect()} == {(1, "a"), (None, "")}


def test_nothing_else_is_dropped():
    """A form around the page, a story that goes on beside its article, comments under another name, a real form."""
    whole = "<body><form action=x><nav>Menu</nav><article><p>Story</p><form>Search <input></form><p>end</p></article><footer>F</footer></form></body>"
    assert html_extract.main_text(whole) == "Story\nend"
    assert html_extract.main_text("<article><p>part one</p></article><div>part two</div>") == "part one\npart two"
    assert html_extract.main_text("<main><p>x</p><div class='discussion'>me too</div></main>") == "x"
    assert html_extract.main_text("<body><form>Name <input> <button>Go</button></form><p>hello</p>") == "hello"
    assert html_extract.main_text("<body><form><p>Sign in</p></form><form><h1>T</h1><p>text</p>") == "T\ntext"
