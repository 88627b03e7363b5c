"""XML helpers on string columns, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trackside.schemas import POINT_KINDS, PUSHPORT_URI_STEM

# Prefixes are arbitrary in the feed, so names are matched without them. Spaces inside values
# count: the second character of an activity code may be one.
XML_OPTIONS = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}

_POINTS = "|".join(POINT_KINDS)

# A name's prefix, and what may stand in a start tag before its end: quoted values hold any sign.
_PREFIX = r"(?:[\w.-]+:)?"
_INSIDE = r"""(?:[^>"'/]|/(?!>)|"[^"]*"|'[^']*')*+"""


def once(value: Column) -> Column:
    """A value as a one-row generator.

    A filter on a column would be pushed below a plain projection, even below a shuffle, and the
    column made a second time there. Filters stop at a generator, so each value is made once. Use in a
    ``select`` without another generator.
    """
    return F.explode(F.array(value))


def parse_once(text: Column, ddl: str) -> Column:
    """``from_xml`` by :func:`once`, so that each document is parsed once."""
    return once(F.from_xml(text, ddl, XML_OPTIONS))


def declares(text: Column, uri: str) -> Column:
    """The document binds the namespace, under any prefix or as the default."""
    return F.contains(text, F.lit(f'="{uri}"')) | F.contains(text, F.lit(f"='{uri}'"))


def feed_version(text: Column) -> Column:
    """Schema version of a document from its root namespace, NULL if it has none."""
    stem = PUSHPORT_URI_STEM.replace(".", r"\.")
    found = F.regexp_extract(text, rf"=[\"']{stem}(\d+)[\"']", 1)
    return found.try_cast("int")


def without_comments(text: Column) -> Column:
    """Comments away; the parser would keep only the text after one. CDATA is left as it is."""
    commented = F.contains(text, F.lit("<!--")) & ~F.contains(text, F.lit("<![CDATA["))
    return F.when(commented, F.regexp_replace(text, r"(?s)<!--.*?-->", "")).otherwise(text)


def has_more_than_root(text: Column) -> Column:
    """Something other than comments and instructions follows the document element. The parser
    stops at its end tag and would not notice.

    Most texts end with their only end tag, which is cheaper to see than to match.
    """
    end = "</Pport>"
    before = F.substring_index(text, end, 1)
    plain = F.octet_length(before) == F.octet_length(text) - len(end)
    more = rf"(?s)</{_PREFIX}Pport\s*>\s*(?:(?:<!--.*?-->|<\?.*?\?>)\s*)*+\S"
    return F.when(plain, False).otherwise(text.rlike(more))


def has_element(text: Column, name: str) -> Column:
    """Cheap look at the text before a parse: is there a start tag of this name?"""
    return text.rlike(rf"[<:]{name}[\s/>]")


def points_in_order(text: Column) -> Column:
    """Give all calling point kinds one element name, ``pt``, with the kind as an attribute.

    The parser groups children by element name, which would lose the order between kinds.
    """
    opened = F.regexp_replace(text, rf"<{_PREFIX}({_POINTS})(?=[\s/>])", '<pt kind="$1"')
    return F.regexp_replace(opened, rf"</{_PREFIX}(?:{_POINTS})\s*>", "</pt>")


def fragments(text: Column, name: str) -> Column:
    """All elements of a name as texts in document order; the element must not nest.

    Where one is never closed, what is taken starts at the last start tag, so that a bad element
    does not cost the one after it.
    """
    start = rf"<{_PREFIX}{name}(?=[\s/>])"
    pattern = rf"(?s){start}{_INSIDE}(?:/>|>.*?</{_PREFIX}{name}\s*>)"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(found, lambda one: F.regexp_extract(one, rf"(?s)^.*({start}.*)$", 1))


def inner(text: Column, name: str) -> Column:
    """Text between the tags of the first element of a name; empty if there is none."""
    pattern = rf"(?s)<{_PREFIX}{name}(?=[\s/>]){_INSIDE}>(.*?)</{_PREFIX}{name}\s*>"
    return F.regexp_extract(text, pattern, 1)


# The predefined entities.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&"}

_REFERENCE = r"&(?:#[0-9]+|#x[0-9A-Fa-f]+|" + "|".join(ENTITIES) + ");"
_TAG = r"""<(?:[^>"']|"[^"]*"|'[^']*')*+>"""
_CDATA, _COMMENT = r"<!\[CDATA\[.*?\]\]>", r"<!--.*?-->|<\?.*?\?>"


def _referred(token: Column) -> Column:
    """The character that a reference stands for; other tokens, and numbers that are none, as they are."""
    known = F.when(F.lit(False), "")
    for name, char in ENTITIES.items():
        known = known.when(token == f"&{name};", char)
    digits = F.regexp_extract(token, r"^&#x?([0-9A-Fa-f]+);$", 1)
    code = F.when(F.startswith(token, F.lit("&#x")), F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
    is_char = code.isin(9, 10, 13) | code.between(0x20, 0xD7FF) | code.between(0xE000, 0xFFFD) | code.between(0x10000, 0x10FFFF)
    number = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(F.startswith(token, F.lit("&#")) & is_char, number).otherwise(F.coalesce(known, token))


def unescape(text: Column) -> Column:
    """Resolve character references and the predefined entities, each once: what one gives is no part of
    another. Other entities stay."""
    tokens = F.regexp_extract_all(text, F.lit(rf"{_REFERENCE}|[^&]+|&"), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(tokens, _referred), "")).otherwise(text)


def escape(text: Column) -> Column:
    """Escape for element text or a double-quoted attribute, ``&`` first."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def plain_text(fragment: Column) -> Column:
    """Text content of mixed markup: tags, comments and instructions away, references resolved, CDATA as it
    stands."""
    pattern = rf"(?s){_CDATA}|{_COMMENT}|{_TAG}|{_REFERENCE}|[^<&]+|[<&]"

    def content(token: Column) -> Column:
        marked = F.length(token) > 1
        return (
            F.when(F.startswith(token, F.lit("<![CDATA[")), token.substr(F.lit(10), F.length(token) - 12))
            .when(F.startswith(token, F.lit("<")) & marked, "")
            .otherwise(_referred(token))
        )

    tokens = F.regexp_extract_all(fragment, F.lit(pattern), F.lit(0))
    whole = F.array_join(F.transform(tokens, content), "")
    return F.when(F.contains(fragment, F.lit("<!")), whole).otherwise(unescape(F.regexp_replace(fragment, _TAG, "")))


def links(fragment: Column) -> Column:
    """Targets of the anchors in mixed markup, in order; text, comments and CDATA hold none."""
    marked = F.regexp_replace(fragment, rf"(?s){_CDATA}|{_COMMENT}", "")
    anchors = F.regexp_extract_all(marked, F.lit(rf"""<{_PREFIX}a\s(?:[^>"']|"[^"]*"|'[^']*')*+>"""), F.lit(0))
    given = r"""\shref\s*=\s*("[^"]*"|'[^']*')"""
    found = F.transform(F.filter(anchors, lambda one: one.rlike(given)), lambda one: F.regexp_extract(one, given, 1))
    return F.transform(found, lambda one: unescape(one.substr(F.lit(2), F.length(one) - 2)))
