import html
import re
import time

import pytest

from tierflow.llm.mainhtml import extracted, main_text, op11_main_text

SENTENCES = ["The river rose before dawn, and nobody in the valley slept.", "Boats were tied to the church; bells rang twice, then stopped.",
             "By noon the water had reached the mill, the school and the old road.", "What happened next is told differently by each family, of course.",
             "Some say the dam was opened too late, others that it never closed at all."]
LONG = [" ".join(SENTENCES[i:] + SENTENCES[:i]) for i in range(5)]
BODY = "<h1>A flood in the valley</h1>" + "".join(f"<p>{x}</p>" for x in LONG) + "<ul><li>first sign</li><li>second sign</li></ul><h2>After</h2><p>Calm.</p>"
TEXT = " ".join(["A flood in the valley", *LONG, "first sign", "second sign", "After", "Calm."])
MENU = "<ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in "Home News Sport Weather Contact".split()) + "</ul>"
COMMENT = "I was there, and I can tell you: it was worse than that. My uncle lost his barn, his boat and two cows."
NOTICE = "We use cookies, and similar techniques, to show you what you like. Accept all?"

PAGES = {
    "article": f"<nav>{MENU}</nav><div class='ad'>{COMMENT}</div><article>{BODY}</article><footer>&copy; 2020. All rights.</footer>",
    "main_in_page": f"<div class='page has-sidebar'><header><a href='/'>Paper</a> Daily.</header><main>{BODY}</main><aside>{COMMENT}</aside></div>",
    "classes_only": f"<div id='menu'>{MENU}</div><div id='content'>{BODY}</div><div class='sidebar'><p>{COMMENT}</p></div><div id='comments'><p>{COMMENT}</p><p>{COMMENT}</p></div>",
    "nothing_said": f"<div class='x1'>{MENU}</div><div class='x2'>{BODY}</div><div class='x3'>{MENU}</div>",
    "all_in_body": f"<div class='top'>{MENU}</div>{BODY}<div class='cookie-bar'>{NOTICE}</div>",
    "notice_inside": f"<article><header><h1>A flood in the valley</h1></header><div class='cookieNotice'>{NOTICE}</div>{BODY.split('</h1>')[1]}"
                     f"<section class='article-comments'><article class='comment'><p>{COMMENT}</p></article></section></article>",
    "upper_case": f"<NAV>{MENU}</NAV><ARTICLE CLASS=post>{BODY.replace('<p>', '<P>').replace('</p>', '')}</ARTICLE><FORM><LABEL>Search here.</LABEL><INPUT></FORM>",
    "no_head_end": f"<html><head><title>t</title><meta charset=utf-8><div role='banner'>{NOTICE}</div><div role=main>{BODY}</div>",
    "title_outside": f"<div class='wrap'><h1>A flood in the valley</h1><div class='entry-content'>{BODY.split('</h1>')[1]}</div><div class='share'>Share this, please.</div></div>",
    "layout_table": f"<table><tr><td class='leftside'>{MENU}</td><td>{BODY}</td><td><p>Short words beside.</p></td></tr></table>",
    "data_table": f"<div>{BODY.replace('<ul><li>first sign</li><li>second sign</li></ul>', '<table><tr><td>first sign</td><td>second sign</td></tr></table>')}</div>",
    "hidden": f"<article>{BODY}<p hidden>{COMMENT}</p><div style='display: none'>{COMMENT}</div></article>",
    "comment_and_script": f"<article>{BODY.replace('</ul>', '</ul><!-- <p>no</p> --><script>var t=\"</p><p>no\";</script><style>p{{}}</style><noscript>no</noscript>')}</article>",
    "related_articles": f"<main><article>{BODY}</article><section class='related'><article><h2>Other</h2><p>{COMMENT}</p></article></section></main>",
}


@pytest.mark.parametrize("name", list(PAGES))
def test_templates(name):
    assert main_text(f"<!DOCTYPE html><html><head><title>A title.</title></head><body>{PAGES[name]}</body></html>") == TEXT


def test_text_inside_a_block():
    assert main_text("<article><p>a<b>b</b> c\n\t d&nbsp;&amp;&lt;p&gt; &eacute; &#x41;&am x</p><p>1<br>2</p>tail</article>") == "ab c d &<p> é A&am x 1 2 tail"


@pytest.mark.parametrize("text, want", [(None, ""), ("", ""), ("   ", ""), ("<nav>a</nav>", ""), ("word", "word"), ("<p>No marks", "No marks"), ("a < b <3 c", "a < b <3 c"),
                                        ("<article></article><div class=ad>Buy this, now.</div>", ""), ("<!-- never closed <p>x</p>", ""), ("<p>x<!-->y</p>", "xy"),
                                        ("<div><p>same</p></div><div><p>same</p></div>", "same same"), ("<script>x", ""), ("<", "<"), ("<a href='x", ""), ("</p>x</div>", "x")])
def test_odd_pages(text, want):
    assert main_text(text) == want


def test_linear_in_odd_markup():
    for page in ("<div>" * 60_000 + "x", "<p a='" * 60_000, "<" * 300_000, "<p>" + "x" * 3_000_000, "<li></ul>" * 60_000, "</div>" * 100_000, "<!--" * 100_000,
                 "<script>" * 60_000, "&am" * 300_000, "<p a" + " " * 300_000 + "b>x", "<x-a>" * 60_000 + "<li>" * 30_000, "<p>word, word</p>" * 60_000):
        start = time.process_time()
        main_text(page)
        assert time.process_time() - start < 15


def by_pattern(page):
    """Independent reading of the given pages, whose articles are marked."""
    body = re.search("<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub("<[^>]*>", "", re.sub(r"<(?=/?(?:p|h1|br)\b)", " <", body))).split())


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: (r.url, by_pattern(r.html)) for r in pages.collect()}
    got = {r.page_id: (r.url, r.text) for r in op11_main_text(spark, "/root/testdata/sf0.01").collect()}
    assert got == want


def test_query_keeps_every_row(spark, parquet_dir):
    rows = [(1, "u", f"<article>{BODY}</article>", "a", 1), (1, "u", f"<article>{BODY}</article>", "a", 1), (2, None, None, "b", 2), (None, "v", "", "c", 3),
            (3, "w", "<article><p>" + "long. " * 400_000 + "</p></article>", "d", 4), (4, "x", "<article>𝄞</article>", "e", 5)]
    folder = parquet_dir(pages=spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long"))
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in op11_main_text(spark, folder).collect()), key=repr)
    long = ("long. " * 400_000).strip()
    want = [(1, "u", TEXT, len(TEXT))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", long, len(long)), (4, "x", "𝄞", 1)]
    assert got == sorted(want, key=repr)
    assert extracted(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
