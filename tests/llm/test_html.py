import time

import numpy as np

from rosterlake.llm.html_blocks import blocks, classifier, extract, labelled_blocks, main_text
from rosterlake.llm.trees import Tree

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><h1>Site &amp; Co</h1><a href="/">Home</a></header><nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav>
<div class="cookie-notice">We use cookies to improve this long and winding site.</div>
<article class="post"><header><h1>A title &lt;here&gt;</h1></header><p>First <b>para</b>graph,
 with\t<i>inline</i> &eacute;&#33; text<br>and more.<!-- no <p>comment</p> --><p>Of.
<aside>See also these other fine stories of ours.</aside><form><p>Name</p><input><button>Send</button></form>
<div class=ad>Buy now our fine product for little money.</div><p hidden>secret</p><p>Last &copy words with a <a href="z>z">link</a>.</p></article>
<section id="comments"><p>I disagree with all of the above, said a reader at length and in detail.</p></section>
<footer>&copy; 2020 Site</footer><script>x"""
MAIN = "A title <here> First paragraph, with inline é! text and more. Of. Last © words with a link."


def test_the_article_and_nothing_else():
    assert main_text(PAGE) == MAIN


def test_pages_without_marks():
    long_text = "Plenty of ordinary words make up this paragraph of the story. " * 8
    page = f"<ul><li><a>Home</a></li><li><a>About us</a></li></ul><div>{long_text}</div><div>Short.</div><div>{long_text}</div><p><a>Top</a></p>"
    assert main_text(page) == " ".join([long_text.strip(), "Short.", long_text.strip()])


STORY_TEXT = "Plenty of ordinary words make up this paragraph of the story, which goes on for a while. " * 3
BRIEF_TEXT = "This paragraph of the story is brief but it has nearly twenty words and it stands among others."


def splits(tree):
    return set() if tree.column is None else {tree.column} | splits(tree.low) | splits(tree.high)


def test_words_and_neighbours_decide():
    # The columns are words and link density of the block, of the one before and of the one after; more of words follow.
    found = splits(classifier())
    assert 0 in found and found & {2, 4, 6, 7}


def test_boilerplate_without_names_or_links():
    menu = "".join(f"<div>{w}</div>" for w in ("Home", "News", "About us", "Contact"))
    foot = "<div>Imprint</div><div>Copyright 2020 The Site, all rights reserved.</div>"
    notice = "<p>We use small files on your device to make sure this site works as you like it best today.</p>"
    body = f"<h2>A headline of a few words</h2><p>{STORY_TEXT}</p><p>A short one.</p><p>{STORY_TEXT}</p>"
    want = " ".join(["A headline of a few words", STORY_TEXT.strip(), "A short one.", STORY_TEXT.strip()])
    assert main_text(menu + body + foot) == want
    assert main_text(menu + notice + "<p>OK</p>" + body + foot) == want
    assert main_text(menu + "<h2>A headline of a few words</h2>" + f"<p>{BRIEF_TEXT}</p>" * 4 + foot) == " ".join(
        ["A headline of a few words"] + [BRIEF_TEXT] * 4)
    assert main_text(menu + foot) == ""
    for n in range(1, 20):
        assert main_text(menu + f"<p>{'word ' * n}</p>" + foot) == "", n
    assert main_text(f"<p>{STORY_TEXT}</p><p hidden>{STORY_TEXT}</p><p>{STORY_TEXT}</p>") == f"{STORY_TEXT}{STORY_TEXT}".strip()


MENU = "<ul><li><a href=a>Home</a><li><a href=b>About us</a><li><a href=c>All the news</a></ul>"
BODY = f"<h1>A headline of several words</h1><p>{STORY_TEXT}</p><p>Brief one.</p><p>{STORY_TEXT}</p>"
BODY_TEXT = " ".join(["A headline of several words", STORY_TEXT.strip(), "Brief one.", STORY_TEXT.strip()])


def test_names_that_only_tell_what_an_element_has():
    for names in ('id="page-with-sidebar"', 'class="container with-comments"', 'class="no-ads"', 'class="tags-article"', "class='has-menu x'"):
        assert main_text(f"<body><nav>{MENU}</nav><div {names}>{BODY}</div><footer>x y</footer></body>") == BODY_TEXT, names
    for names in ('class="comments"', 'id="sidebar-left"', 'class="post-comments"', 'class="user-review"', 'class="with-menu sidebar"'):
        assert main_text(f"<body><article>{BODY}</article><div {names}><p>{STORY_TEXT}</p></div></body>") == BODY_TEXT, names


def test_menus_that_are_never_closed():
    for start in (f"<nav>{MENU}", "<nav><a href=a>Home</a> <a href=b>News</a>", f"<div><nav>{MENU}</div>", f"<header><h1>Site</h1>{MENU}",
                  f"<header><nav>{MENU}</header>", f"<nav>{MENU}</nav><nav>{MENU}"):
        assert main_text(f"<body>{start}<div>{BODY}</div></body>") == BODY_TEXT, start
    # One that is closed keeps what stands in it.
    assert main_text(f"<nav>{MENU}<div>{BODY}</div></nav><div>{BODY}</div>") == BODY_TEXT
    assert main_text("<nav>" * 2000 + f"a<div>{BODY}</div>") == BODY_TEXT


def test_links_and_short_lines_inside_an_article():
    links = "<ul><li><a href=x>Read this other thing</a><li><a href=y>Share on Facebook</a></ul>"
    assert main_text(f"<article>{BODY}{links}</article>") == BODY_TEXT
    assert main_text(f"<article>{BODY}<p><a href=y>Share on Facebook</a></p></article>") == BODY_TEXT
    assert main_text(f"<main>{MENU}{BODY}<p>Copyright 2024 Foo</p><p>&copy; 2024 Foo</p></main>") == BODY_TEXT
    assert main_text(f"<article>{BODY}<div class='user-review'><p>{STORY_TEXT}</p></div></article>") == BODY_TEXT
    # Plain short lines are part of it, also those that only mention rights.
    assert main_text(f"<article>{BODY}<p>No.</p><p>All rights reserved.</p></article>") == f"{BODY_TEXT} No. All rights reserved."


def test_short_pages_and_first_headings():
    assert main_text("<p>Just a short page with few words.</p>") == "Just a short page with few words."
    for start in ("", MENU):
        assert main_text(f"{start}<h2>A title here</h2><p>{STORY_TEXT}</p><p>{STORY_TEXT}</p>") == f"A title here {STORY_TEXT}{STORY_TEXT}".strip()
    assert main_text(f"<p>{STORY_TEXT}</p><p hidden>two words</p><p>{STORY_TEXT}</p>") == f"{STORY_TEXT}{STORY_TEXT}".strip()


def test_an_article_inside_furniture():
    for outer in ("<form>", "<div class='sidebar'>", "<aside>", "<div class='menu'>"):
        for inner in ("<article>", "<main>", "<div class='content'>"):
            page = f"{outer}<p>Outer words of the page.</p>{inner}<h2>A headline here</h2><p>{STORY_TEXT}</p><p>Brief.</p><p>{STORY_TEXT}</p>"
            assert main_text(page) == " ".join(["A headline here", STORY_TEXT.strip(), "Brief.", STORY_TEXT.strip()]), (outer, inner)
    # A column that only names its inside so, a named comment and what an article itself surrounds stay out.
    assert main_text("<footer><div class=content><p>Copyright 2020</p><p>All rights reserved.</p></div></footer>") == ""
    assert main_text(f"<section id=comments><article class=comment><p>{STORY_TEXT}</p></article></section>") == ""
    assert main_text(f"<form><article><aside><p>{STORY_TEXT}</p></aside></article></form>") == ""


def test_any_markup_is_read():
    for page in ("", "   ", "<", "<>", "</p>", "<p", "<!--", "<!-- x", "<script>", "<a href='", "&#xZZ; &bogus;", "<p>" * 3000, "</div>" * 3000,
                 "<div>" * 3000 + "x", "<script></scripty>x</script >y", "<p class='a>b'>t</p>", "\x00<b>�", "<svg/>after"):
        assert isinstance(main_text(page), str)
    assert [b.text for b in blocks("a<td>b<td>c<script>no</scripty>no</script >d<svg/>e")] == ["a", "b", "c de"]


def test_the_tree_fits_its_table():
    x, y = labelled_blocks()
    assert len(y) < 200 and ((classifier().predict(x) >= 0.5) == y).all()
    assert Tree(np.zeros((3, 2)), np.array([0.0, 1, 1])).predict(np.zeros((1, 2)))[0] == 2 / 3


def test_tables_of_pages(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"), (1, "u", PAGE, "x"),
                                   (5, "w", "<p>" + "word " * 200_000, "x")],
                                  "page_id long, url string, html string, text string")
    got = extract(pages).collect()
    assert [(r.page_id, r.url, r.text[:5]) for r in got] == [(1, "u", MAIN[:5]), (2, None, ""), (None, "v", ""), (1, "u", MAIN[:5]), (5, "w", "word ")]
    assert got[0].text == MAIN and len(got[4].text) == 5 * 200_000 - 1
    assert extract(spark.createDataFrame([], pages.schema)).count() == 0


def test_deep_nesting_takes_time_in_proportion(monkeypatch):
    text = "word " * 60
    for n in (1000, 100_000):
        began = time.perf_counter()
        for page in ("<div>" * n + "</p>" * n + f"<p>{text}</p>", "<div>" * n + "<i>x</i>" * n + f"<p>{text}</p>" + "</div>" * n):
            assert text.strip() in main_text(page)
        took = time.perf_counter() - began
    assert took < 20
