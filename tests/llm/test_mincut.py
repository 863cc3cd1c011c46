import itertools
import random

from corpusforge.llm import mincut as mc


def _cost(costs, arcs, label):
    return (sum(max(0, -c) if x else max(0, c) for c, x in zip(costs, label))
            + sum(c for i, j, c in arcs if label[i] != label[j]))


def test_min_cut_is_the_cheapest_labelling():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randint(1, 8)
        costs = [rng.randint(-9, 9) for _ in range(n)]
        arcs = [(i, j, rng.randint(0, 6)) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]
        best = min(_cost(costs, arcs, x) for x in itertools.product((False, True), repeat=n))
        assert _cost(costs, arcs, mc.min_cut(costs, arcs)) == best


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="site"><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><!-- <p>x</p> -->
<div class="cookie-notice">We use cookies, please accept all of them now.</div><div class="ad">Buy two, get one free today.</div>
<article><h1>Big &lt;news&gt;</h1><p><b>First   paragraph&nbsp;of
text.<br><p>Be.<div class="ad">Advert inside the article, read it.</div><ul><li>One item</li><li>Another</li></ul>
<button>Share</button><p>Last words, 5 &gt; 3 &#233;.</p></article>
<section id="comments"><article class="comment"><p>I liked this a lot, thank you for writing it.</p></article></section>
<aside>Read more: other stories of the week.</aside><form><label>Mail</label><input></form>
<footer>&copy; 2024 The Site.</footer></body></html>"""


def test_article_without_the_rest():
    assert mc.main_text(PAGE) == ("Big <news>\nFirst paragraph of text.\nBe.\nOne item\nAnother\nLast words, 5 > 3 é.")


def test_pages_without_article_element():
    page = ("<body><div id=top-menu><a>x</a> <a>y</a></div><div class='post-content'><h2>Title</h2>"
            "<p>One long paragraph of text that goes on for a while, with commas and words.</p><p>Short.</p>"
            "<p>Another long paragraph of text that goes on for a while, with words.</p></div>"
            "<div class=sidebar><p>Some long side text that is a sentence of its own right here.</p></div></body>")
    assert mc.main_text(page).split("\n")[0] == "Title" and "Short." in mc.main_text(page) and "side text" not in mc.main_text(page)
    assert mc.main_text("just some plain words that are no page at all, but a sentence.").startswith("just some")


def test_broken_markup_ends():
    for page in ("<p", "<p class=\"x", "<!-- open", "<script>never closed", "<div " * 50, "<article><p>" * 3000 + "Deep text here.",
                 "</p></div>", "<a href='" + "x" * 1000, "<div hidden><p>secret</p></div><p>" + "Shown text goes here. " * 9):
        mc.main_text(page)
    assert "secret" not in mc.main_text("<div hidden><p>secret</p></div><article><p>Shown.</p></article>")
    assert mc.main_text("<article><p>" * 3000 + "Deep text here.") == "Deep text here."


def test_query_columns_nulls_and_clashes(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "z"), (2, None, None, "z"), (None, "v", "", "z"), (1, "u", PAGE, "z")],
                               "page_id bigint, url string, html string, text string")
    rows = mc.extract(df).collect()
    assert rows[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    n = len(mc.main_text(PAGE))
    assert sorted((str(r["page_id"]), r["n_chars"]) for r in rows) == [("1", n), ("1", n), ("2", 0), ("None", 0)]
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert mc.extract(df.limit(0)).count() == 0


def test_long_broken_pages_take_linear_time():
    """One megabyte of every pattern; each took minutes to hours where tags or parents were searched anew."""
    import time
    for x in ("<a ", "<div>", "<nav>", '<a "> "', "<p><b>", "<div hidden ", "<!x ", "<a 'x>", "<div>x", "<nav>x", "<table><td><p>",
              "<span>x<h1>"):
        begin = time.monotonic()
        mc.read_blocks(x * (1_000_000 // len(x)))
        assert time.monotonic() - begin < 10, x


def test_broken_markup():
    text = lambda page: [b.text for b in mc.read_blocks(page)]
    assert text("<p>one <b title='a > b'>two</b> <!-- never closed <p>three") == ["one two"]
    assert text('<p>one</p><p title="a>two') == ["one", "two"]             # the quote never closes
    assert text("<p>one</p> two <a href=x") == ["one", "two <a href=x"]
    assert text("<div>one<p>two<div>three</div>four") == ["one", "two", "three", "four"]
    assert text("<p>x<![CDATA[y") == ["xy"]
