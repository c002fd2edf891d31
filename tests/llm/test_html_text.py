from __future__ import annotations

import pytest
from conftest import rows

from statewise.llm.html_text import extract_text, main_text

LONG = "Words of the story go on and on until the paragraph has some length to it, as stories do."

PAGE = f"""<!DOCTYPE html><html><head><title>Not text</title><style>p{{margin:0}}</style>
<script>var t="</p>";</script></head><body><div id="cookie-notice">We use cookies.</div>
<header><h2>Site name</h2></header><nav><ul><li><a href="/">Home</a><li><a href="/x">More</a></ul></nav>
<div class="ad">Buy this now, it is a very long advert that goes on for many words, more than a paragraph.</div>
<article><header><h1>Head &amp; line</h1></header><p>{LONG}<p>Short.<p>{LONG}  &lt;b&gt;
tail<br>after
<aside>See also: something else.</aside><form>Your mail <input><button>Go</button></form>
<blockquote>A &copy; quote&#8212;here</blockquote></article>
<section class="comments"><article class="comment"><p>{LONG} says a reader, at length.</p></article></section>
<footer>&copy; site</footer></body></html>"""


def test_article_without_furniture():
    assert main_text(PAGE) == "\n".join(
        ["Head & line", LONG, "Short.", f"{LONG} <b> tail after", "A © quote—here"]
    )


def test_pages_without_an_article_element():
    menu = "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(30))
    page = f"<body><div><ul>{menu}</ul></div><h1>Title</h1><div id='c'><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div></body>"
    assert main_text(page) == f"Title\n{LONG}\nShort.\n{LONG}"
    form = f"<form><nav>Menu</nav><article><p>{LONG}</p></article></form>"
    assert main_text(form) == LONG


@pytest.mark.parametrize(
    "html, text",
    [
        ("", ""),
        ("plain text only", "plain text only"),
        ("<nav>Menu</nav>", ""),
        ("<p>a<p>b", "a\nb"),
        ("<article>x &am y &nosuch; z</article", "x &am y &nosuch; z"),
        ("<article><p>one</article></p></div>", "one"),
        ("<main><div hidden>no</div><p style='display: none'>no</p>yes</main>", "yes"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>c<td>d</table></article>", "one\ntwo\nc\nd"),
        ("<!-- <p>no</p> --><article>\n a \n\n b </article>", "a b"),
    ],
)
def test_small_pages(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article><p>Long text <span aria-hidden='true'>x</span> tail.</p></article>", "Long text tail."),
        ("<h1>Title <button>Share</button></h1>", "Title"),
        ("<h1>Title <span aria-hidden='true'>#</span></h1>", "Title"),
        ("<h1>A <svg><title>Icon</title><path d='x'/></svg> title</h1>", "A title"),
        ("<p>See <svg/> the chart</p>", "See the chart"),
        ("<p>one <script>var t = '</p>';</script>two</p>", "one two"),
        ("<h1>one <script>f()</script>two</h1>", "one two"),
        ("<p>one <button><div>no</div></button> two</p>", "one two"),
        ("<p>one <span hidden>no <span>no</span> no</span> two</p>", "one two"),
        ("<p>one <span hidden>no<p>two", "one\ntwo"),
        ("<article><ul><li>one <i hidden>no<li>two</ul></article>", "one\ntwo"),
        ("<article>one<nav>no <button>no</button> no</nav>two</article>", "one\ntwo"),
    ],
)
def test_a_removed_inline_part_leaves_its_line_whole(html, text):
    assert main_text(html) == text


MUCH = f"<p>{LONG}</p>" * 3


@pytest.mark.parametrize(
    "html, text",
    [
        (f"<div class='layout has-sidebar'><article><p>{LONG}</p></article></div>", LONG),
        (f"<div class='sidebar'><article><p>{LONG}</p></article></div>", LONG),
        (f"<article class='post comments-open'><p>{LONG}</p></article>", LONG),
        (f"<form><div><div><p>{LONG}</p></div></div></form>", LONG),
        (f"<article><h2 id='related-work'>Work</h2><p>{LONG}</p></article>", f"Work\n{LONG}"),
        (f"<article><p>{LONG}</p><section id='social-impact'><p>Few words.</p></section></article>", f"{LONG}\nFew words."),
        (f"<article><p>{LONG}</p><div class='elementor-widget'><p>Few words.</p></div></article>", f"{LONG}\nFew words."),
        (f"<article><div class='widget'><p>{LONG}</p></div><p>Few words.</p></article>", f"{LONG}\nFew words."),
        (f"<nav>Menu<div><main><p>{LONG}</p></main></div></nav>", LONG),
        (f"<p>{LONG} <span class='share-link'>Share</span> to the end</p>", f"{LONG} to the end"),
        # what stays away, however long it is
        (f"<article><p>{LONG}</p></article><section class='comments'>{MUCH}</section>", LONG),
        (f"<form><div><p>{LONG}</p></div><section class='comments'>{MUCH}</section></form>", LONG),
        (f"<article><p>{LONG}</p><div class='related-posts'><article>{MUCH}</article></div></article>", LONG),
        (f"<article><p>{LONG}</p></article><div class='sidebar'>{MUCH}</div>", LONG),
        (f"<article><p>{LONG}</p><div class='post-comments'>no</div><div class='ad-300x250'>no</div></article>", LONG),
        (f"<div class='comments'><article class='comment'>{MUCH}</article></div>", ""),
        (f"<div hidden>{MUCH}</div><p>{LONG}</p>", LONG),
    ],
)
def test_marks_are_not_believed_against_the_article(html, text):
    assert main_text(html) == text


def _split_page(first, second):
    """Texts of two parts of a page."""
    part = {"more": LONG * 3, "equal": LONG * 2, "less": LONG}
    return part[first], part[second]


@pytest.mark.parametrize("sizes", [("more", "equal"), ("equal", "more"), ("equal", "equal"), ("less", "more")])
@pytest.mark.parametrize(
    "page",
    [
        "<body><p>{}</p><blockquote>{}</blockquote></body>",
        "<body><section><p>{}</p></section><section><p>{}</p></section></body>",
        "<body><div><div><p>{}</p></div></div><div><div><p>{}</p></div></div></body>",
        "<table><tr><td>{}</td></tr><tr><td>{}</td></tr></table>",
        "<table><tr><td>{}</td><td>{}</td></tr></table>",
        "<body><main><article><p>{}</p></article><article><p>{}</p></article></main></body>",
        "<body><main><p>{}</p><article><p>{}</p></article></main></body>",
        "<body><div>Away</div><article><p>{}</p></article><article><p>{}</p></article></body>",
        "<body><div><article><p>{}</p></article></div><div><article><p>{}</p></article></div></body>",
        "<p>{}</p><div>{}</div>",
    ],
)
def test_all_parts_of_the_article_are_kept(page, sizes):
    texts = _split_page(*sizes)
    assert main_text(page.format(*texts)) == "\n".join(texts)


def test_long_page_is_whole():
    text = [f"{i} {LONG}" for i in range(3000)]
    assert main_text("<article>" + "".join(f"<p>{t}</p>" for t in text) + "</article>") == "\n".join(text)


def test_rows(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", "z")],
        "page_id long, url string, html string, text string",
    )
    found = extract_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    text = main_text(PAGE)
    assert rows(found) == rows(
        spark.createDataFrame(
            [(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (None, "v", "", 0)],
            "a long, b string, c string, d long",
        )
    )
    assert extract_text(pages.limit(0)).count() == 0


def test_every_given_page(spark):
    """Between the tags of the article, block by block, on the driver's pages."""
    import html
    import re

    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inside = row.html[row.html.index("<article>") + 9 : row.html.index("</article>")]
        blocks = [re.sub(r"<[^>]*>", " ", re.sub("</?b>", "", x)) for x in re.split("</?(?:p|h1)>", inside)]
        expected = [" ".join(html.unescape(x).split()) for x in blocks]
        assert main_text(row.html) == "\n".join(x for x in expected if x)
