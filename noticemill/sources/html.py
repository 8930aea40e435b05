"""Landed HTML: cards of result pages, links of any page."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticemill.functions import text

# Where a result page keeps its cards.
CONTENT_ID = "content"
CARD_CLASS = "card-item"
ABOUT_CLASS = "card-item__about"

CARD_TYPE = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("href", T.StringType())]))
# Tags that have no end tag and so do not nest.
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())

# Group 1 is `/` of an end tag, 2 the name, 3 the attributes. Outside quotes `<` ends a tag,
# and no group gives back what it has read, so an unclosed quote costs one look ahead.
_TAG = re.compile(r"""<(/?)([a-z][^\s/<>]*+)((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>""", re.IGNORECASE)
_END_OF = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in ("script", "style")}
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def _tags(html: str) -> Iterator[tuple[int, int, re.Match]]:
    """(start, end, match) of the tags in one forward scan; comments, scripts and styles are passed over.

    What is left open reaches to the end of the page.
    """
    at = html.find("<")
    while at >= 0:
        if html.startswith("<!--", at):
            end = html.find("-->", at + 4)
            if end < 0:
                return
            yield at, end + 3, None
            at = html.find("<", end + 3)
            continue
        match = _TAG.match(html, at)
        if match is None:
            at = html.find("<", at + 1)
            continue
        end = match.end()
        name = match[2].lower()
        if name in _END_OF and not match[1]:
            closed = _END_OF[name].search(html, end)
            end = closed.end() if closed else len(html)
            yield at, end, None
        else:
            yield at, end, match
        at = html.find("<", end)


def parse_cards(html: str | None) -> list[dict[str, str | None]]:
    """(label, href) of the first anchor in the about block of each card."""
    html = html or ""
    cards: list[dict[str, str | None]] = []
    stack: list[tuple[str, str]] = []  # (tag, role) of the open elements
    n_open: Counter[str] = Counter()  # how many of them there are of each tag
    inside = {"content": 0, "card": 0, "about": 0}
    linked: dict[str, str | None] = {}  # the card whose anchor is open
    label: list[str] | None = None  # the text of that anchor so far
    end = 0

    def pop_to(tag: str) -> None:
        """Close `tag` and whatever was left open inside it."""
        nonlocal label
        while stack:
            name, role = stack.pop()
            n_open[name] -= 1
            if role == "link":
                linked["label"] = unescape("".join(label or ()))
                label = None
            elif role:
                inside[role] -= 1
            if name == tag:
                return

    for start, after, match in _tags(html):
        if label is not None:
            label.append(html[end:start])
        end = after
        tag = match[2].lower() if match else ""
        if not tag or tag in VOID_TAGS:
            continue
        if match[1]:
            if n_open[tag]:
                pop_to(tag)
            continue
        role = ""
        if tag == "div":
            attributes = _attributes(match[3])
            classes = attributes.get("class", "").split()
            if inside["card"] and ABOUT_CLASS in classes:
                role = "about"
            elif inside["content"] and CARD_CLASS in classes:
                role = "card"
                cards.append({"label": None, "href": None})
            elif attributes.get("id") == CONTENT_ID:
                role = "content"
        elif tag == "a" and inside["about"] and label is None and cards[-1]["label"] is None:
            role, linked, label = "link", cards[-1], []
            linked["href"] = _attributes(match[3]).get("href")
        if role in inside:
            inside[role] += 1
        stack.append((tag, role))
        n_open[tag] += 1
        if match[3].endswith("/"):
            pop_to(tag)
    if label is not None:
        label.append(html[end:])
        pop_to("")
    return cards


@F.pandas_udf(CARD_TYPE)
def html_cards(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in pages:
        yield batch.map(parse_cards)


def scan_result_cards(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row (…, card_pos, label, href) per card of a result page, no shuffle.

    A page without cards gives no rows; a card without an anchor keeps a NULL label and
    ends among the rejects.
    """
    keys = [c for c in pages.columns if c != html]
    cards = pages.select(*keys, F.posexplode(html_cards(F.col(html))).alias("card_pos", "_card"))
    return cards.select(*keys, "card_pos", "_card.label", "_card.href")


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row (…, link_pos, href) per anchor of a page."""
    keys = [c for c in pages.columns if c != html]
    return pages.select(*keys, F.posexplode(text.links(F.col(html))).alias("link_pos", "href"))
