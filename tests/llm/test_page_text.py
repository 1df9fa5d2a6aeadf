import numpy as np
import pytest

from newsloom.llm.page_text import extract, hinted, page_text, smoothed, threshold

LONG = "A sentence of the article that goes on for some time, as sentences do. "
CASES = {
    None: "", "": "", "<nav>a</nav><footer>b</footer>": "", "plain text": "plain text",
    "<article><header><h1>T</h1></header><p>Be.<article><p>comment</p></article><footer>f</footer></article><p>x": "T\n\nBe.",
    "<p>a&nbsp;&amp;\n b<br>c<b>d</b>e</p><p>Caf&eacute; &#x1F600;": "a & b cde\n\nCafé 😀",
    "<![odd[ x ]]><p>a</p><script>if(a<b){'</p>'}</script><style>p{}</style><!-- no <p> -->": "a",
    "<form id=page><div><h2>T</h2><p>" + LONG + "</p></div></form><p>x": "T\n\n" + LONG.strip(),
    "<div class=post><p>" + LONG + "</p><form><p>Subscribe<input></form><ul><li>one<li>two</ul></div>":
        LONG.strip() + "\n\none\n\ntwo",
    "<p>before <span class='ad'>Buy</span>after <button>Go</button>": "before after",
    "<div class='no-comments post'><p>" + LONG + "</p></div><div id='reader-comments'><p>" + LONG * 3 + "</div>": LONG.strip(),
    "<table><tr><td>a<td>b<tr><td>c</table>": "a\n\nb\n\nc",
    "<main><h1>M</h1><p>" + LONG + "</p></main><div><p>" + LONG: "M\n\n" + LONG.strip(),
    "<p>cut off <b": "cut off", "</div></p>text</article>": "text",
}
PAGE = """<html><head><title>no</title></head><body class="has-sidebar"><header><h1>Site</h1></header>
<div class="topMenu"><a href=/>Home</a></div><div class="cookie-notice"><p>We use cookies, as everybody does.</p></div>
<div id=wrap><div class=content><h1>Head</h1><p>%s</p><p>Short.</p><div class="share">Tell</div><p>%s</p></div>
<aside><p>%s</p></aside><div class=sidebar><p>%s</p></div></div><div hidden>no</div><footer>c</footer></body></html>"""


@pytest.mark.parametrize("html", list(CASES))
def test_cases(html):
    assert extract(html) == CASES[html]


def test_region_without_article():
    assert extract(PAGE % (LONG, LONG, LONG * 5, LONG * 5)) == "\n\n".join(["Head", LONG.strip(), "Short.", LONG.strip()])


def test_hints_are_words_of_a_name():
    from newsloom.llm.page_text import HINTS

    assert all(hinted(name, HINTS) for name in ("ad", "x top-ad", "relatedPosts", "site_footer", "ADVERT"))
    assert not any(hinted(name, HINTS) for name in ("", "reading", "header", "no-comments", "shared", "badge"))


def test_clusters():
    values = np.array([0.0, 0.1, 0.2, 4.0, 4.1])
    assert 0.2 < threshold(values) < 4
    assert threshold(np.array([1.0, 1.0])) <= 1
    assert np.allclose(smoothed(np.ones(7)), 1) and np.allclose(smoothed(np.arange(9.0))[2:-2], np.arange(9.0)[2:-2])


def test_table(spark):
    html = list(CASES) + ["<article><p>" + LONG * 20_000 + "</article>", "<p>twice", "<p>twice"]
    rows = [(None if i == 3 else i, h, "x", 1) for i, h in enumerate(html)]
    frame = spark.createDataFrame(rows, "page_id long, html string, text string, N_CHARS int").repartition(3)
    found = page_text(frame, ["page_id", "text", "N_CHARS"])
    assert found.columns == ["page_id", "text", "n_chars"]
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == sorted([(r[0], extract(r[1]), len(extract(r[1]))) for r in rows], key=repr)
    assert max(n for _, _, n in got) == len((LONG * 20_000).strip())
    assert page_text(frame.limit(0), ["page_id"]).count() == 0
