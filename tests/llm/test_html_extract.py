import html
import re
import time

import pytest

from benelake.llm.html_extract import extract_text, main_text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b &lt;c&gt;\n  d</p>", "a\n\nb <c> d"),
        ("<article><h1>T</h1><p><b>one<br><p>two</p></article><footer>x</footer>", "T\n\none\n\ntwo"),
        ("<body><nav><p>Home, away, far, and wide, all of it here</p></nav><article><p>Short.</p></article>", "Short."),
        ("<div id='main-menu'>m</div><div><p>Body, text.</p></div><div class='user-comments'><p>c, c, c, c</p></div>", "Body, text."),
        ("<article><p>A</p><section><h2>H</h2><ul><li>1<li>2</ul></section><aside>s</aside><form>f</form></article>", "A\n\nH\n\n1\n\n2"),
        ("<article><p>A<script>var x='</p><p>no';</script> b<style>p{}</style></p><!-- <p>no</p> --></article>", "A b"),
        ("<article><div style='display:none'>no</div><div aria-hidden=true>no</div><p hidden>no</p><p>yes</p></article>", "yes"),
        ("<article><p>5 < 6 & 7 > 4</p></article>", "5 < 6 & 7 > 4"),
        ("<article><p>cut he", "cut he"),
        ("<article><p>cut</p><p class='x", "cut"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\n\nb\n\nc"),
        ("</p></div>stray</article>", "stray"),
        ("<article><p>nbsp&nbsp;&#8212;&#x41;&notareal;</p></article>", "nbsp —A¬areal;"),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<div class='layout has-sidebar'><article><p>A</p></article></div>", "A"),
        ("<div class='sidebar layout'><article><p>A</p></article></div>", "A"),
        ("<div id='main' class='content no-sidebar'><p>Text, more of it.</p></div>", "Text, more of it."),
        ("<article class='post ad-free'><p>A</p></article>", "A"),
        ("<article><p>A longer text.</p><section class='related-work'><h2>Related work</h2><ul><li>B</ul></section></article>", "A longer text.\n\nRelated work\n\nB"),
        ("<article><h2 id='comments'>Comments in C</h2><p>A</p></article>", "Comments in C\n\nA"),
        ("<div class='menu-page'><p>Only text here</p></div>", "Only text here"),
        ("<article><p>A text of some length.</p><div class='ad'>Buy</div><ul class='share-links'><li><a href=x>Mail</a></ul></article>", "A text of some length."),
        ("<article><p>The text itself, longer.</p><section class='comments'><article class='comment'><p>Hm.</p></article></section></article>", "The text itself, longer."),
    ],
)
def test_names_of_clutter_are_weighed(page, text):
    assert main_text(page) == text


LONG = "<p>Running text with commas, several of them, that goes on, and on.</p>" * 5


@pytest.mark.parametrize(
    ("before", "after"),
    [
        ("", "<div><p>Short closing sentence.</p></div>"),
        ("<h1>No full stop</h1>", "<h3>Nor here</h3><ul><li>one<li>two</ul><table><tr><td>a<td>b</table>"),
        ("<div><h2>Title</h2></div>", "<p>End</p><div><p><a href=x>all of it linked</a></p></div>"),
    ],
)
def test_all_next_to_the_best_container_stays(before, after):
    page = f"<body><div><p><a href=y>away</a></p></div><div id=content>{before}<div>{LONG}</div>{after}</div></body>"
    wanted = [x for x in re.sub(r"<a .*?</a>", "", before + LONG + after).replace("<", "\n<").split("\n")]
    wanted = [x for x in (re.sub(r"<[^>]*>", "", w).strip() for w in wanted) if x]
    assert main_text(page).split("\n\n") == wanted


def test_articles_next_to_each_other_stay():
    page = f"<body><div><article>{LONG}</article><article><p>Second one</p></article><article class='ad'><p>Buy this</p></article></div></body>"
    assert main_text(page).endswith("\n\nSecond one")
    page = f"<ul><li><article>{LONG}</article><li><article><p>Second one</p></article></ul>"
    assert main_text(page).endswith("\n\nSecond one")


def test_siblings_and_link_density():
    links = "<div>" + "<p><a href=x>some link text, more, of it, all linked, yes</a></p>" * 6 + "</div>"
    body = "<div>" + "<p>Running text with commas, several of them, that goes on, and on.</p>" * 4 + "</div>"
    got = main_text(f"<html><body>{links}<div>{body}{body}</div></body></html>")
    assert "linked" not in got and got.count("Running") == 8


def test_pages_of_the_test_data(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in extract_text(rows).collect()}
    for r in rows.collect():
        inside = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", p))).split()) for p in re.split(r"</?(?:h1|p)>", inside)]
        text = "\n\n".join(p for p in parts if p)
        assert got[r["page_id"]] == (text, len(text))


def test_tables(spark):
    schema = "page_id long, url string, html string, text int, n_chars string"
    assert extract_text(spark.createDataFrame([], schema)).collect() == []
    page = "<article>" + "<p>x</p>" * 20000
    rows = extract_text(spark.createDataFrame([(1, None, None, 4, "c"), (None, "u", page, 5, None), (None, "u", page, 5, None)], schema)).collect()
    assert [(r["page_id"], r["url"], r["n_chars"]) for r in rows] == [(1, None, 0), (None, "u", 59998), (None, "u", 59998)]


def test_a_quote_in_an_unquoted_attribute_is_no_string():
    page = "<article><p title=it's>Hello world's text, which goes on.</p><p data-x=a\"b class='y > z'>And more.</p></article>"
    assert main_text(page) == "Hello world's text, which goes on.\n\nAnd more."


LONG = "".join(f"<p>Reader {i} says, at length, what he or she thinks of this article and of others.</p>" for i in range(9))


@pytest.mark.parametrize("name", ["class=comments", "id=comments", 'class="comment-list replies"', "class=commentlist"])
@pytest.mark.parametrize("inside", [True, False])
def test_reader_comments_go_however_long(name, inside):
    comments = f"<div {name}>{LONG}</div>"
    article = "<p>The article is short, but it is the article.</p>"
    page = f"<body><article>{article}{comments}</article></body>" if inside else f"<body><article>{article}</article>{comments}</body>"
    assert main_text(page) == "The article is short, but it is the article."


def test_a_sentence_with_a_long_link_stays():
    page = "<div id=a><p>" + "</p><p>".join(["Some long paragraph, with commas, and with words, many words, to score well."] * 4) + "</p><p>See <a href=x>the full report of the committee</a>.</p></div><p>See <a href=x>the other full report</a>.</p><p><a href=y>Home</a> | <a href=z>About</a></p>"
    got = main_text(f"<body>{page}</body>")
    assert "See the full report of the committee." in got and got.endswith("See the other full report.")


@pytest.mark.parametrize("page", ["<i>" * 5000 + "<p>word.</p>" * 5000, "<div><p>some text, here.</p>" * 3000])
def test_deep_nesting_takes_linear_time(page):
    began = time.process_time()
    assert main_text(page).count(".") in (5000, 3000)
    assert time.process_time() - began < 2


def test_a_section_on_social_matters_stays():
    links = "<section class='social'><a href=x>Share</a> <a href=y>Post</a></section>"
    page = f"<article><p>First part of the text.</p><section class='social'><p>Social change is slow, as this part says.</p></section>{links}</article>"
    assert main_text(page) == "First part of the text.\n\nSocial change is slow, as this part says."
