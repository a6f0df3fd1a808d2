"""op3: hand-written pages of layouts that the generator doesn't know, odd markup, and time in proportion to length."""

import time

import pytest

from framelight.llm import html_text

PAGES = {
    "blog": (
        """<!doctype html><html lang=en><head><meta charset=utf-8><title>My trip</title><style>.x{color:red}</style></head><body class="home single">
<div id="topbar"><a href=/>Home</a> <a href=/about>About</a> <a href="/contact">Contact</a></div>
<div class="content"><h1>A week in the mountains</h1><p>We left early on Monday, before the sun had come up over the valley.</p>
<p>The road was wet, but nobody complained about it. There was coffee &amp; bread for all of us.</p>
<ul><li>The first day we walked for nine hours.</li><li>The second day it rained until noon.</li></ul></div>
<div class="sidebar"><h3>Recent posts</h3><ul><li><a href=1>Old post</a></li><li><a href=2>Older post</a></li></ul></div>
<div id="footer"><p>&copy; 2020 Somebody. All rights reserved.</p></div></body></html>""",
        ["A week in the mountains", "We left early on Monday, before the sun had come up over the valley.", "The road was wet, but nobody complained about it. There was coffee & bread for all of us.", "The first day we walked for nine hours.", "The second day it rained until noon."],
    ),
    "news": (
        """<HTML><BODY><HEADER><NAV><UL><LI><A HREF="/w">World</A><LI><A HREF="/s">Sports</A></UL></NAV></HEADER>
<DIV CLASS="cookie-notice"><P>We use cookies to make this site better.</P><BUTTON>Accept</BUTTON></DIV>
<MAIN><ARTICLE><H1>Bridge opens after two years</H1><P>The new bridge over the river opened on Friday, said the mayor.<P>More than a thousand people came to see it.
<ASIDE CLASS="ad"><P>Cheap shoes, only today!</P></ASIDE><BLOCKQUOTE>I have waited for this day, she said.</BLOCKQUOTE></ARTICLE></MAIN>
<SECTION ID="comments"><H2>Comments</H2><DIV CLASS="comment"><P>Great news, at last!</P></DIV></SECTION><FOOTER>About us &middot; Contact</FOOTER></BODY></HTML>""",
        ["Bridge opens after two years", "The new bridge over the river opened on Friday, said the mayor.", "More than a thousand people came to see it.", "I have waited for this day, she said."],
    ),
    "other language": (
        """<body><nav><a href='#'>Startseite</a><a href='#'>Impressum</a></nav><article><h2>Die Katze</h2><p>Gestern lief eine Katze &#252;ber die Stra&szlig;e, langsam und ruhig.</p><pre>x  =  1
y = 2</pre></article><form><label>E-Mail</label><input name=m><button>Senden</button></form></body>""",
        ["Die Katze", "Gestern lief eine Katze über die Straße, langsam und ruhig.", "x = 1 y = 2"],
    ),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages_by_hand(name):
    source, gold = PAGES[name]
    assert html_text.main_text(source, html_text.default_model()).split("\n\n") == gold


def test_odd_markup():
    text = lambda x: [b.text for b in html_text.blocks_of(x)]
    assert text("a < b and c<d> e") == ["a < b and c e"]
    assert text('<p title="1 > 0">one<p title=\'don"t\'>two<p title=don\'t>three') == ["one", "two", "three"]
    assert text('<a href="x>y</a> z') == ["y z"]
    assert text("one<!-->two<!-- x > y -->three<!-- open") == ["onetwothree"]
    assert text("<![CDATA[a <b> c]]> d") == ["a <b> c d"]
    assert text("x<script>if (a < b) '<p>no</p>'</script>y<style>no") == ["xy"]
    assert text("<div hidden>kept</div><div class='post hidden'>too</div><p><math><mi>x</mi></math> and <object>more</object></p>") == ["kept", "too", "x and more"]
    assert text("<svg><text>no</text></svg><p>yes&nbsp;&#x41;&unknown; b") == ["yes A&unknown; b"]
    assert text("<") == ["<"] and text("<p") == ["<p"] and text("</") == ["</"] and text(None) == text("") == text(" \n") == []
    assert text("<p>" * 600 + "x" + "</p>" * 600 + "<p>y") == ["x", "y"]
    assert text("<div>" * 600 + "x" + "</div>" * 600 + "y") == ["x", "y"]


@pytest.mark.parametrize("piece", ["<a ", '<a ">" ', "<div>x", "<", "<!", "<!--", '<a x="', "<b><i></b>", '<p class="c d">t', "&"])
def test_a_long_page_takes_no_time(piece):
    model, source = html_text.default_model(), piece * (300_000 // len(piece))
    began = time.time()
    html_text.main_text(source, model)
    assert time.time() - began < 6


def test_unclosed_tags_within_a_second():
    html_text.default_model()
    began = time.time()
    html_text.blocks_of("<a " * 350_000)
    assert time.time() - began < 1


def test_rows(spark):
    source, gold = PAGES["blog"]
    rows = [(1, "u", source, "t", 3), (1, "u", source, "t", 3), (None, None, source, "t", 3), (2, "v", None, "t", 3), (3, "w", "", "t", 3), (4, "x", "<p>" * 200_000, "t", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = html_text.extract(pages, html_text.default_model())
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    main = "\n\n".join(gold)
    want = [(1, "u", main, len(main))] * 2 + [(None, None, main, len(main)), (2, "v", "", 0), (3, "w", "", 0), (4, "x", "", 0)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert html_text.extract(pages.limit(0), html_text.default_model()).count() == 0


def test_whole_table_against_the_places_of_blocks(spark):
    """On the given pages the text is in article elements, around it are nav, li, footer and class ad."""
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = html_text.op3_html_extraction(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages)
    for r in got:
        blocks = html_text.blocks_of(pages[r.page_id])
        want = [b.text for b in blocks if "article" in b.path and not {"ad", "comment", "comments"} & set(b.names)]
        assert r.text == "\n\n".join(want) and r.n_chars == len(r.text)
