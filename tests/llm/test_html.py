from __future__ import annotations

import time

import pytest

from pageloom.llm import html as T


def text(page, *others):
    w = T.wrapper(T.parse(page))
    for other in others:
        w = T.join(w, T.wrapper(T.parse(other)))
    return T.extract(T.parse(page), w)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("", ""),
        ("plain", "plain"),
        ("<", "<"),
        ("<p>a<p>b", "a\n\nb"),
        ("<article><h1>T&eacute; &amp;amp;</h1><p>One<br>two\n <b>x</b>y</p></article>", "Té &amp;\n\nOne two xy"),
        ("<nav>m</nav><article><p><b>a<br><p>b</article><footer>f</footer>", "a\n\nb"),
        ("<script>var t='</p><article>no';</script><article>yes<style>p{}</style></article>", "yes"),
        ("<body><header>h</header><main><div class='cookie-notice'>c</div><ul><li>a<li>b</ul><div id=comments><p>x</div></main>", "a\n\nb"),
        ("<article>a<article class=comment>no</article><form>f</form><aside>s</aside></article>", "a"),
        ("<article>a<!-- <p>no --> b</article>", "a b"),
        ("<div class=sidebar><p>s</p></div><div class='post-body'><table><tr><td>1<td>2</table></div>", "1\n\n2"),
    ],
)
def test_one_page(page, want):
    assert text(page) == want


def test_an_article_keeps_what_other_pages_have_alike():
    same = "<h2>Summary</h2><table><tr><td>1<td>2</table>"
    pages = [f"<article><p>Read on</p><h1>t{i}</h1>{same}<p>body {i}</p></article>" for i in range(6)]
    assert text(*pages) == "Read on\n\nt0\n\nSummary\n\n1\n\n2\n\nbody 0"
    again = ["<article>" + "<p>same line</p>" * 9 + "</article>"]
    assert text(*again) == "\n\n".join(["same line"] * 9)
    copies = ["<main><article><h3>Part</h3><p>a</p></article></main>"] * 5 + ["<main><article><p>b</p></article></main>"]
    assert text(*copies) == "Part\n\na"


def test_constant_texts_of_pages_without_an_article_are_template():
    pages = [f"<div><p>All rights</p><h2>row {i}</h2></div>" for i in range(6)]
    assert text(*pages) == "row 0"
    assert text(*pages[:3]) == "All rights\n\nrow 0"


BODY = "<h1>Title</h1><p>The text of the article.</p>"


@pytest.mark.parametrize(
    "page",
    [
        f"<body class='has-sidebar'><article>{BODY}</article><div class=sidebar>no</div></body>",
        f"<body class='single search-enabled'><div class='entry-content'>{BODY}</div></body>",
        f"<article class='post comments-open'>{BODY}</article>",
        f"<main class='content with-related'>{BODY}<div class='related-posts related'>no</div></main>",
        f"<div class='page ad-free'><article>{BODY}</article></div>",
        f"<div class='layout no-footer'><div class='post-body'>{BODY}</div></div>",
        f"<html><head><title>no</title><body><article>{BODY}</article></body></html>",
        f"<head><meta charset=utf-8><link rel=x><div class=content>{BODY}</div>",
        f"<nav><a href=x>no</a><article>{BODY}</article>",
        f"<nav><ul><li>no<main>{BODY}</main>",
        f"<header><p>no<main><header><p>no</p></header>{BODY}</main>",
        f"<main id=main class='site-main show-comments'>{BODY}<div class='comment-list'>no</div><div class=cookieNotice>no</div></main>",
        f"<section class='container'><article>{BODY}<div class='post-comments'>no</div><p class='ad-slot ad'>no</p><div class='sidebar-inner'>no</div></article></section>",
    ],
)
def test_names_and_open_elements_of_ordinary_pages(page):
    assert text(page) == "Title\n\nThe text of the article."


def test_mismatches_become_optional_and_repeated():
    w = T.join(T.wrapper(T.parse("<ul><li>a<li>b</ul><h2>x</h2>")), T.wrapper(T.parse("<ul><li>c</ul><p>y</p><h2>x</h2>")))
    ul, p, h2 = w[5]
    assert (ul[0], ul[1], ul[5][0][2]) == ("ul", 0, 1) and (p[0], p[1]) == ("p", 1) and (h2[0], h2[1]) == ("h2", 0)
    assert h2[5][0][4] is not None and ul[5][0][5][0][4] is None
    rows = T.wrapper(T.parse("<dl>" + "<dt>k<dd>v" * 4 + "</dl>"))
    assert [(c[0], c[2]) for c in rows[5][0][5]] == [("dt", 1), ("dd", 1)]


def test_deep_and_long_pages():
    assert text("<div>" * 5000 + "x") == "x"
    assert len(text("<article>" + "<p>word</p>" * 50_000 + "</article>")) == 50_000 * 6 - 2
    assert text("<a '" * 2000)


@pytest.mark.parametrize("deep", [10, 23, 24, 30, 126, 127, 128, 129, 400, 20_000])
def test_deep_elements_close_themselves(deep):
    down, up = "<div>" * deep, "</div>" * deep
    page = f"<main><article><div><p>before</p>{down}<p>in</p><div class=comments><div>no</div>no</div><aside>no</aside><p>out</p>{up}</div><p>after</p></article></main><p>no"
    assert text(page) == "before\n\nin\n\nout\n\nafter"
    assert text(f"<p>no</p>{'<div>' * min(deep, 100)}<article>a<div>b</div>c</article>") == "a\n\nb\n\nc"


def test_many_open_elements_take_no_long():
    begun = time.process_time()
    assert text("<p><div>" + "<ul>" * 50_000 + "<li>x</li>" * 50_000 + "</p></td>" * 50_000).startswith("x\n\nx")
    assert time.process_time() - begun < 20


def test_rows(spark):
    pages = [
        (1, "http://h/a", "<article>one</article>", 0), (1, "http://h/a", "<article>one</article>", 0), (2, None, "<p>x", 1), (None, "no url", None, 2),
        (3, "HTTP://User@H:80/b?c", "<article>two</article>", 3), (4, "http://[", "", 4),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string, host int")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in T.main_texts(df).collect()), key=str)
    assert got == sorted([(1, "one", 3), (1, "one", 3), (2, "x", 1), (None, "", 0), (3, "two", 3), (4, "", 0)], key=str)
    assert sorted(r.host for r in T.wrappers(df).collect()) == ["", "[", "h"]
    assert T.main_texts(df.limit(0)).count() == 0
