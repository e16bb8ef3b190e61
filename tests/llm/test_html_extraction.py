"""Main text of pages that the small test of test_corpus.py has none of."""

import time

import pytest

from shelfspark.llm import html_extraction


def extracted(spark, pages):
    rows = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")
    return [r.text for r in sorted(html_extraction.extract(rows).collect())]


def ordinary(n):
    """Pages of two layouts with short unmarked blocks beside the article."""
    out = []
    for i in range(n):
        paragraphs = "".join(f"<p>Paragraph {k} of page {i} has some words, and marks. It goes on; and on, to its end.</p>" for k in range(5))
        box = "article" if i % 2 else "section"
        out.append(f"<html><body><div>Go {i}</div><{box}><h1>Page {i}</h1>{paragraphs}</{box}><footer>All rights, reserved.</footer></body></html>")
    return out


LONG = "words, and marks. " * 55_556


@pytest.mark.parametrize("long", [LONG, f"<pre>{LONG}</pre>", f"<article><p>{LONG}</p></article>", f"<div><pre>{LONG}</pre></div>"], ids=["bare", "pre", "article", "div"])
def test_one_long_node_changes_no_other_page(spark, long):
    pages = ordinary(40)
    alone = extracted(spark, pages)
    assert all(t.startswith(f"Page {i}\nParagraph 0") and t.endswith("to its end.") for i, t in enumerate(alone))
    assert extracted(spark, [*pages, long]) == [*alone, LONG.strip()]


def test_more_paths_than_are_sent(spark, monkeypatch):
    pages = [*ordinary(12), None, "", "<nav>Menu</nav>", "<article><p>These words, and marks, are <b>bold, as one says; </b>and<br>these are <i>not so, one says</i>. So, it goes on.</p></article>"]
    sent = extracted(spark, pages)
    monkeypatch.setattr(html_extraction, "BROADCAST_PATHS", 1)
    assert extracted(spark, pages) == sent
    assert sent[0] and sent[-1].startswith("These words, and marks, are bold, as one says; and these are not so, one says.") and sent[12:15] == ["", "", ""]
    rows = spark.createDataFrame([(1, "u", pages[0]), (1, "u", pages[0]), (None, None, pages[1])], "page_id long, url string, html string")
    got = html_extraction.extract(rows, keep=("url",)).collect()
    assert sorted((str(r.page_id), str(r.url), r.text) for r in got) == [("1", "u", sent[0])] * 2 + [("None", "None", sent[1])]


WORDS = "".join(f"<p>Sentence {k} of the article, with some words, and marks. It goes on; and on, to its end.</p>" for k in range(4))


@pytest.mark.parametrize(
    "page",
    [
        f'<div class="content-sidebar-wrap"><main>{WORDS}</main></div>',
        f'<div class="sidebar">Start <main>{WORDS}</main></div>',
        f'<div id="comment"><div><div role="main">{WORDS}</div></div></div>',
        f'<div id="main" class="no-sidebar">{WORDS}</div>',
        f'<article class="post has-header">{WORDS}</article>',
        f'<article class="related">{WORDS}</article>',
        f'<div data-id="ad" data-class="sidebar" title="class=ad">{WORDS}</div>',
        f'<div aria-hidden="false">{WORDS}</div>',
        f'<div style="display:block; overflow:hidden">{WORDS}</div>',
    ],
)
def test_names_do_not_cut_the_article(spark, page):
    assert extracted(spark, [page])[0].count("Sentence") == 4


@pytest.mark.parametrize("mark", ['class="post comment"', "class=sidebar", 'id="footer"', 'role="navigation"', 'aria-hidden="true"', "hidden", 'style="display: none"'])
def test_marked_blocks_are_cut(spark, mark):
    assert "Other" not in extracted(spark, [f"<div {mark}><p>Other words, and marks. They go on; and on.</p></div><article>{WORDS}</article>"])[0]


@pytest.mark.parametrize("pile", ["<b><font>" * 30, "<table><tr><td>" * 12, "<i><section>" * 40], ids=["inline", "tables", "sections"])
def test_what_never_holds_an_article_at_any_depth(spark, pile):
    page = f"<div>{pile}{WORDS}<footer>All rights, reserved. Really; all.</footer><div class='ad'>Buy, now. Really; do.</div><p>End, at last.</p></div>"
    got = extracted(spark, [page])[0]
    assert got.count("Sentence") == 4 and "End, at last." in got and "rights" not in got and "Buy" not in got


@pytest.mark.parametrize(
    "page",
    [
        f"<form action=/x><main><article>{WORDS}</article></main></form>",
        f"<form action=/x><div>{WORDS}</div><label>Name</label></form>",
        f"<form><form><div>{WORDS}</div></form></form>",
        f'<div class="post related">{WORDS}</div>',
        f"<aside><article>{WORDS}</article></aside>",
    ],
)
def test_what_holds_the_article_is_kept(spark, page):
    got = extracted(spark, [page])[0]
    assert got.count("Sentence") == 4 and "Name" not in got


def test_forms_headers_and_controls(spark):
    form = "<form><p>Leave, please, a reply. Or, none.</p><label>Name</label><button>Send</button></form>"
    assert "reply" not in extracted(spark, [f"<article>{WORDS}</article>{form}"])[0]
    assert extracted(spark, [f"<header><h1>Site</h1></header><article><header><h1>Title, of it</h1></header>{WORDS}</article>"])[0].startswith("Title, of it\nSentence 0")
    assert "Hi, press OK there" in extracted(spark, [f"<article>{WORDS}<p>Hi, press <label>OK</label> there, and so on.</p></article>"])[0]


@pytest.mark.parametrize(
    "markup, left",
    [
        ('<script src=/js/>var a = "x";</script>', ""),
        ("<style/>p {color:red}</style>", ""),
        ("<svg class=x/>", ""),
        ("<svg><text>No</text></svg>", ""),
        ("<![CDATA[ x > y ]]>", ""),
        ("<!-- a > b -->", ""),
        ('<a title="x > y">z</a>', "z"),
        ("&#000000000000065;&#x41&amp;", "AA&"),
        (f"&#{'9' * 6000};", "\ufffd"),
    ],
)
def test_markup(markup, left):
    assert "".join(t for b in html_extraction.blocks(f"<p>{markup}</p>") for _, t in b) == left


@pytest.mark.parametrize("piece", ["<div>", "<p", "<font ", "<a \">\"", "<ul><li>", "<b>x", "<form>x", "<svg>", "<![CDATA[", "<p>x<div>"])
def test_parsing_time_follows_the_size(piece):
    def took(n):
        start = time.process_time()
        html_extraction.blocks(piece * n)
        return time.process_time() - start

    assert took(60_000) < 3 * took(30_000) + 0.3


def test_empty_table_clashing_columns_and_repeated_rows(spark):
    spec = "page_id int, html string, id string, text string, k0 string"
    assert html_extraction.extract(spark.createDataFrame([], spec)).collect() == []
    page = f"<article>{WORDS}</article>"
    rows = spark.createDataFrame([(1, page, "a", "b", "c"), (1, page, "a", "b", "c"), (2, None, None, None, None)], spec)
    got = html_extraction.extract(rows, keep=("k0",)).collect()
    assert sorted((r.page_id, r.k0 or "", r.text.count("Sentence")) for r in got) == [(1, "c", 4), (1, "c", 4), (2, "", 0)]
