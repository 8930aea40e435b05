"""Text functions over columns: charset, strip, numbers, ids, output lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space (Java's `\s` is ASCII only and misses NBSP).
SPACE = r"[\t-\r\x1c-\x1f \x85\p{Z}]"
# The marks the ids and numbers are recognised by.
NUMBER_AFTER_SIGN = f"№{SPACE}?(\\p{{Nd}}+)"
NOTICE_ID_IN_URL = r"noticeInfoId=(\p{Nd}+)"
PFID_IN_URL = r"pfid=(\p{Nd}+)"
LINE_BREAK = r"\r\n|\r|\n"
# What is no markup, start tags of anchors, and their attributes. Outside
# quotes `<` ends a tag, and no group gives back what it has read, so that no page takes
# more than a few passes however its quotes and comments are left open.
NO_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
ANCHOR_TAG = r"""(?is)<a(?=[\s/>])((?:[^<>"']++|"[^"]*+"|'[^']*+')*+)>"""
ATTRIBUTE = r"""(?s)([^\s=/"'>]++)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]*+))?+"""
# The entities that are decoded beside numeric ones; `&amp;` comes last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": "\xa0"}
NUMERIC_ENTITY = r"&#(?:[0-9]{1,7}|[xX][0-9a-fA-F]{1,6});"

# The upper half of windows-1251 and the same bytes read as Latin-1.
_HIGH_BYTES = bytes(range(128, 256))
_LATIN1 = _HIGH_BYTES.decode("latin-1")
_CYRILLIC = _HIGH_BYTES.decode("cp1251", errors="replace")


def none_if_empty(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def strip(col: Column) -> Column:
    """Drop white space, Unicode kinds too, at both ends (`trim` takes spaces only)."""
    return F.regexp_replace(col, f"^{SPACE}+|{SPACE}+$", "")


def decode_text(content: Column) -> Column:
    """Bytes to text: UTF-16 if marked so, else UTF-8 if valid, else windows-1251.

    Spark does not decode windows-1251, but reading the bytes as Latin-1 and renaming
    the upper 128 characters is the same thing and stays in the JVM.
    """
    utf8 = content.cast("string")
    mark = F.hex(F.substring(content, 1, 2))
    text = (
        F.when(mark.isin("FFFE", "FEFF"), F.decode(content, "UTF-16"))
        .when(F.is_valid_utf8(utf8), utf8)
        .otherwise(F.translate(F.decode(content, "ISO-8859-1"), _LATIN1, _CYRILLIC))
    )
    return F.regexp_replace(text, "^\ufeff", "")


def encode_cyrillic(text: Column) -> Column:
    """Text to windows-1251 bytes, the reverse of `decode_text`."""
    return F.encode(F.translate(text, _CYRILLIC, _LATIN1), "ISO-8859-1")


def lines(text: Column) -> Column:
    return F.split(text, LINE_BREAK)


def notice_number(label: Column) -> Column:
    """The digits after the number sign of a card label; NULL when there are none.

    The number stays a string: leading zeros and length carry meaning.
    """
    return none_if_empty(F.regexp_extract(label, NUMBER_AFTER_SIGN, 1))


def notice_info_id(url: Column) -> Column:
    return none_if_empty(F.regexp_extract(url, NOTICE_ID_IN_URL, 1))


def pfid(url: Column) -> Column:
    return none_if_empty(F.regexp_extract(url, PFID_IN_URL, 1))


def decode_entities(col: Column) -> Column:
    """Numeric entities and the most usual named ones as characters."""
    for entity, char in ENTITIES.items():
        col = F.replace(col, F.lit(entity), F.lit(char))

    def character(entity: Column) -> Column:
        hexadecimal = entity.rlike("^&#[xX]")
        digits = F.regexp_replace(entity, "[&#xX;]", "")
        number = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise("\ufffd")

    numeric = F.array_distinct(F.regexp_extract_all(col, F.lit(NUMERIC_ENTITY), 0))
    col = F.aggregate(numeric, col, lambda text, entity: F.replace(text, entity, character(entity)))
    return F.replace(col, F.lit("&amp;"), F.lit("&"))


def links(html: Column) -> Column:
    """All anchor targets of a page, in page order.

    Any case, white space and kind of quotes; anchors in comments, scripts and styles and
    attributes of other names do not count. Of several `href` of an anchor the first counts.
    """
    tags = F.regexp_extract_all(F.regexp_replace(html, NO_MARKUP, ""), F.lit(ANCHOR_TAG), 1)

    def target(tag: Column) -> Column:
        names = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 1)
        values = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), 2)
        at = F.array_position(F.transform(names, lambda name: F.lower(name)), F.lit("href"))
        value = F.get(values, at.cast("int") - 1)
        return F.when(at > 0, F.regexp_replace(value, "(?s)^([\"'])(.*)\\1$", "$2"))

    return F.transform(F.array_compact(F.transform(tags, target)), decode_entities)


def first_link_with(hrefs: Column, needle: str) -> Column:
    """The first link that contains `needle`; NULL when none does."""
    return F.get(F.filter(hrefs, lambda href: F.contains(href, F.lit(needle))), F.lit(0))


def hit_count(label: Column) -> Column:
    """The count in a label such as `1 234`; NULL when it has no digit."""
    return F.regexp_replace(label, "[^0-9]", "").try_cast("bigint")


def full_pages(hits: Column, per_page: int = 10) -> Column:
    """Number of full result pages: rounds down."""
    return F.floor(hits / F.lit(per_page)).cast("bigint")


def date_label(day: Column) -> Column:
    return F.date_format(day, "dd-MM-yyyy")


def output_line(number: Column, *ids: Column) -> Column:
    """`number` or `number;id;id`: the non-empty fields joined by a semicolon."""
    return F.concat_ws(";", number, *[none_if_empty(i) for i in ids])
