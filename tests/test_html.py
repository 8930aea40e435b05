import time
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from noticemill.sources.html import ABOUT_CLASS, CARD_CLASS, CONTENT_ID, VOID_TAGS, extract_links, parse_cards, scan_result_cards
from tests.conftest import rows


def card(label, href="/n/1", classes="card-item"):
    return f'<div class="{classes}"><div class="{ABOUT_CLASS}"><a href="{href}">{label}</a></div></div>'


def page(*cards):
    return f'<html><body><div id="content">{"".join(cards)}</div></body></html>'


def test_cards_of_a_page():
    html = page(card("№1"), card("№2", "/n/2", "wide card-item new"), card("no", "/x", "card-items"))
    assert parse_cards(html) == [{"label": "№1", "href": "/n/1"}, {"label": "№2", "href": "/n/2"}]


def test_page_without_cards():
    assert parse_cards(page()) == []
    assert parse_cards("") == []
    assert parse_cards(None) == []


def test_cards_outside_content_do_not_count():
    assert parse_cards(card("№1") + page(card("№2")) + card("№3")) == [{"label": "№2", "href": "/n/1"}]


def test_only_the_first_anchor_of_the_about_block():
    html = page(
        f'<div class="{CARD_CLASS}"><a href="/0">0</a><div class="{ABOUT_CLASS}"><p><span><a href="/1">№<b>1</b></a></span></p>'
        '<a href="/2">2</a></div><a href="/3">3</a></div>'
    )
    assert parse_cards(html) == [{"label": "№1", "href": "/1"}]


def test_card_without_anchor_stays_without_label():
    html = page(f'<div class="{CARD_CLASS}"><div class="{ABOUT_CLASS}">text</div></div>', card("№2"))
    assert parse_cards(html) == [{"label": None, "href": None}, {"label": "№2", "href": "/n/1"}]


def test_entities_comments_scripts_and_quotes():
    html = page(
        "<!-- <div class='card-item'> --><script>var a = '<div class=\"card-item\">';</script>",
        "<div data-x='a>b' class='card-item'><DIV CLASS=card-item__about><br><A title=\"1>0\" HREF='/n?a=1&amp;b=2'>"
        "№&nbsp;5 &lt;x&gt;</A></DIV></div>",
    )
    assert parse_cards(html) == [{"label": "№ 5 <x>", "href": "/n?a=1&b=2"}]


def test_unclosed_tags():
    html = '<div id="content"><p><div class="card-item"><div class="card-item__about"><p><a href="/1">№1</div></div><p>'
    assert parse_cards(html + card("№2") + "</div>") == [{"label": "№1", "href": "/1"}, {"label": "№2", "href": "/n/1"}]


class Tree(HTMLParser):
    """The same rules on the events of the standard parser."""

    def __init__(self):
        super().__init__()
        self.stack, self.cards, self.reading = [], [], None

    def has(self, role):
        return any(r == role for _, r in self.stack)

    def handle_starttag(self, tag, attrs):
        if tag in VOID_TAGS:
            return
        attrs, role = dict(attrs), ""
        classes = (attrs.get("class") or "").split()
        if tag == "div" and self.has("card") and ABOUT_CLASS in classes:
            role = "about"
        elif tag == "div" and self.has("content") and CARD_CLASS in classes:
            role = "card"
            self.cards.append({"label": None, "href": None})
        elif tag == "div" and attrs.get("id") == CONTENT_ID:
            role = "content"
        elif tag == "a" and self.has("about") and self.reading is None and self.cards[-1]["label"] is None:
            role, self.reading = "link", self.cards[-1]
            self.reading.update(label="", href=attrs.get("href"))
        self.stack.append((tag, role))

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.stack):
            while True:
                name, role = self.stack.pop()
                self.reading = None if role == "link" else self.reading
                if name == tag:
                    break

    def handle_data(self, data):
        if self.reading is not None:
            self.reading["label"] += data


PIECES = [
    '<div id="content">',
    '<div class="card-item">',
    '<div class="a card-item__about b">',
    "<div>",
    "</div>",
    "<p>",
    "</p>",
    "<span class='card-item'>",
    "</span>",
    '<a href="/1">',
    "<a name=x href=/2>",
    "<a>",
    "</a>",
    "<br>",
    "<!-- <a href='/c'> -->",
    "№1",
    " &amp; ",
    "text",
]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=40))
def test_same_cards_as_the_standard_parser(pieces):
    html = '<div id="content"><div class="card-item">' + "".join(pieces)
    tree = Tree()
    tree.feed(html)
    tree.close()
    assert parse_cards(html) == tree.cards


def test_scan_keeps_page_keys(spark):
    pages = spark.createDataFrame(
        [(1, 1, page(card("№1"), card("№2", "/n/2"))), (1, 2, page()), (2, 1, None)], "search_id int, page_num int, html string"
    )
    assert rows(scan_result_cards(pages)) == [(1, 1, 0, "№1", "/n/1"), (1, 1, 1, "№2", "/n/2")]


LINKS = {
    '<a href="/1">x</a><A HREF="/yes">y</A><a class="k" href="">z</a><link href="/css"><a name="n">w</a>': ["/1", "/yes", ""],
    "<a href='/single'>": ["/single"],
    "<a href=/bare class=x><a href=/end>": ["/bare", "/end"],
    '<a\n\thref = "/break">': ["/break"],
    '<a data-href="/no" title=" href=/no" href="/own" href="/second">': ["/own"],
    '<!-- <a href="/comment"> --><script>"<a href=/script>"</script><style>a{}</style><a href="/after">': ["/after"],
    '<a href="/n?a=1&amp;b=&quot;2&#34;&#x41;&amp;lt;&#1071;">': ['/n?a=1&b="2"A&lt;\u042f'],
    "<a title='1>0' href='a<b'><abbr href=/no></a href=/no>": ["a<b"],
    '<!-- open <a href="/no">': [],
    '<a href="/unclosed': [],
}


def test_links_of_a_page(spark):
    pages = spark.createDataFrame([*enumerate(LINKS), (98, "none"), (99, None)], "page_id int, html string")
    expected = [(i, k, href) for i, hrefs in enumerate(LINKS.values()) for k, href in enumerate(hrefs)]
    assert rows(extract_links(pages)) == sorted(expected, key=repr)


OPEN = ["<!-- <a ", "<script><a ", "<style>", '<a "', "<a '", "<div class=\"", "<a href=", "<", "<a <b ", "<a x=\"'", '<a "x">']


@pytest.mark.parametrize("piece", OPEN)
def test_unclosed_markup_takes_linear_time(spark, piece):
    def seconds(html):
        start = time.perf_counter()
        parse_cards(html)
        return time.perf_counter() - start

    html = '<div id="content">' + piece * (800_000 // len(piece))
    assert min(seconds(html) for _ in range(2)) < 3
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    start = time.perf_counter()
    extract_links(pages).count()
    assert time.perf_counter() - start < 10


def test_unmatched_end_tags_take_linear_time():
    def seconds(n):
        start = time.perf_counter()
        assert parse_cards("<b>" * n + "</p>" * n) == []
        return time.perf_counter() - start

    seconds(1000)
    assert seconds(40_000) < 5
    assert len(parse_cards("<b>" * 9 + "</p>" * 9 + page(card("x")) + "</i></div>" + page(card("y")))) == 2
