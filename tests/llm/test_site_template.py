"""Main text of generated pages, against the text they were made of."""

import html
import random
import time

import numpy as np
import pytest

from fieldbook.llm.site_template import extract, main_text, parse

NONE = np.array([], dtype=np.int64)


def text(source, host="h"):
    return main_text(parse(source, host), NONE)[0]


def prose(rng, n):
    return " ".join(rng.choice(("word", "stone", "river", "a & b", "x<y", "naïve", "漢字", "“so”")) + str(rng.randint(0, 99)) for _ in range(n))


def site(seed=1, hosts=5, pages=30):
    """``(id, url, html, text)``: the article has boxes that recur on its site and no mark."""
    rng, rows = random.Random(seed), []
    shared = prose(rng, 60)
    for h in range(hosts):
        menu = "".join(f"<li><a href='/{k}'>{html.escape(prose(rng, 1))}</a>" for k in range(5))
        box, foot, top = prose(rng, 12), prose(rng, 8), prose(rng, 3)
        for p in range(pages):
            paragraphs = [prose(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 6))]
            if p % 3 == 0:
                paragraphs.insert(0, shared)
            title = f"{prose(rng, 4)} {h} {p}"
            inner = "".join(f"<p>{html.escape(x)}" + rng.choice(("</p>", "", "<br>")) for x in paragraphs)
            page = (
                f"<!doctype html><html><head><title>{html.escape(title)}</title><script>if (a < b) x('<p>no</p>')</script></head><body>"
                f"<div class='x1'><div>{html.escape(top)}</div><ul>{menu}</ul></div><article><h1>{html.escape(title)}</h1>"
                f"<div>{html.escape(box)} <b>now</b></div>{inner}</article><section><p>{html.escape(foot)}</section>"
            )
            rows.append((len(rows), f"https://Site{h}.example.org/{p}?q", page, "\n".join([title, *paragraphs])))
    return rows


@pytest.fixture(scope="module")
def rows():
    made = site()
    for k in range(40):  # copies of one page, and near copies under its title
        made.append((1000 + k, "https://site0.example.org/c", made[1][2] + f"<!-- {k} -->" * (k % 2), made[1][3]))
    return made


def table(spark, rows):
    wide = [(i, u, h, "t", 1, None) for i, u, h, *_ in rows]
    return spark.createDataFrame(wide, "page_id bigint, url string, html string, text string, n_chars int, subtree bigint").repartition(3)


def test_templates_of_sites(spark, rows):
    """Boxes without any mark go because they recur; passages and copies of articles stay."""
    got = extract(table(spark, rows), min_pages=5).collect()
    assert sorted((r["page_id"], r["url"], r["text"]) for r in got) == sorted((i, u, t) for i, u, _, t in rows)
    assert all(r["n_chars"] == len(r["text"]) and r["n_template"] >= 3 for r in got)


def test_joined_templates_are_the_same(spark, rows):
    few, many = (extract(table(spark, rows), min_pages=5, sent=n) for n in (10**6, 0))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_few_pages_keep_what_does_not_recur(spark):
    got = extract(table(spark, site(hosts=1, pages=3)), min_pages=5).collect()
    assert all(r["n_template"] == 0 and "now" in r["text"] for r in got)


def test_edges(spark):
    rows = [(1, None, None), (2, "x", ""), (3, "http://h/", "  \n "), (None, "http://h/", "plain &amp; simple"), (4, "http://h", "<p>one<p>two"), (4, "http://h", "<p>one<p>two")]
    got = extract(table(spark, rows)).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in got) == [(0, "plain & simple", 14), (1, "", 0), (2, "", 0), (3, "", 0), (4, "one\ntwo", 7), (4, "one\ntwo", 7)]
    assert extract(table(spark, [])).count() == 0


@pytest.mark.parametrize(
    "source, want",
    [
        ("<article><h1>T</h1><p>a\n  b&nbsp;c</article>", "T\na b c"),
        ("<nav><a>m</a></nav><header><h1>Site</h1></header><main><p>in</p></main><footer>f</footer>", "in"),
        ("<main><p>around</p><article><p>in</p></article></main>", "in"),
        ("<article></article><div>fallback</div>", "fallback"),
        ("<article><header><h2>T</h2><p>by</p></header><p>x</p><footer>f</footer><aside>s</aside></article>", "T\nx"),
        ("<article><p>x</p><section id='comments'><article><p>reader</p></article></section></article>", "x"),
        ("<article><p>x</p></article><div class='comments'><article class='comment'><p>reader</p></article></div>", "x"),
        ("<div class='page with-sidebar'><article><p>x</p></article><div class='sidebar'>s</div></div>", "x"),
        ("<article><div class='ad'>buy</div><p>x</p><form><p>send</p></form><div hidden>h</div><p style='display: none'>n</p></article>", "x"),
        ("<div role='banner'>b</div><div class='cookie-notice'><p>c</p></div><p>x</p>", "x"),
        ("<article><p>1 < 2 &lt; 3 &#x41;&#65; &unknown; &amp;lt;</p></article>", "1 < 2 < 3 AA &unknown; &lt;"),
        ("<article><p>a<b>b<i>c</p><p>d</b>e</article>", "abc\nde"),
        ("<article><ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e</table></article>", "a\nb\nc\nd\ne"),
        ("<article><p title=\"a > b\" data-x='</p>'>x</p><!-- <p>no</p> --><p>y<!-- cut", "x\ny"),
        ("<article><p>x</p><p class='y", "x"),
        ("<script>var a = '</p>';</script><p>x</p><style>p{}", "x"),
        ("<p>a</span></div></b>b", "ab"),
        ("<ARTICLE><P>Up</P></ARTICLE>", "Up"),
    ],
)
def test_markup(source, want):
    assert text(source) == want


@pytest.mark.parametrize("piece", ["<div>", "<article><p>", "<p>x", "<a <a ", "<b x=\"", "</i></section>", "<ul><li>", "&amp;", "<!-", "<article><header><div>", "x<br>"])
def test_long_pages_take_linear_time(piece):
    start = time.time()
    text(piece * (400_000 // len(piece)))
    assert time.time() - start < 20
