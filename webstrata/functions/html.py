"""Elements and attributes of HTML text as regular expressions over whole texts.

Every pattern is linear: repeats run over single characters or are possessive, so
a page of any size neither backtracks nor overflows the stack.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# name, optionally "=" and a value in double, single or no quotes. A quote after a
# backslash does not close the value; a missing one is closed by the end of the tag.
_NAME = r"[^\s=/>]+"
_VALUE = (
    r"""(?:\s*+=\s*+(?:"[^>]*?(?:(?<!\\)"|(?=>)|\z)|'[^>]*?(?:(?<!\\)'|(?=>)|\z)|[^\s>]*+))?+"""
)
_UNQUOTE = r"""(?s)\A(["'])(.*?)(?:(?<!\\)\1)?\z"""


def _name(element: str) -> str:
    if not re.fullmatch(r"[A-Za-z][A-Za-z0-9]*", element):
        raise ValueError(f"not an element name: {element!r}")
    return element


def start_tag_pattern(element: str) -> str:
    return rf"(?i)<{_name(element)}(?=[\s>])[^>]*+>?"


def start_tags(html: Column, element: str) -> Column:
    """Array of the start tags of an element."""
    return F.regexp_extract_all(html, F.lit(start_tag_pattern(element)), F.lit(0))


def attributes(tag: Column) -> Column:
    """Array of a start tag's attributes as written; the first item is the tag name."""
    return F.regexp_extract_all(tag, F.lit(_NAME + _VALUE), F.lit(0))


def attribute_name(attribute: Column) -> Column:
    return F.lower(F.regexp_extract(attribute, r"\A[^\s=]+", 0))


def attribute_value(attribute: Column) -> Column:
    """Value without quotes; null for an attribute that has none."""
    written = F.regexp_extract(attribute, r"(?s)\A[^\s=]+\s*=\s*(.*)\z", 1)
    return F.when(F.instr(attribute, "=") > 0, F.regexp_replace(written, _UNQUOTE, "$2"))


def attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute of that name in a start tag."""
    written = attributes(tag)
    names = F.regexp_extract_all(F.lower(tag), F.lit(f"({_NAME}){_VALUE}"), F.lit(1))
    at = F.array_position(names, name.lower())
    return F.when(at > 0, attribute_value(F.try_element_at(written, at.cast("int"))))


# A start tag or element without an end takes the rest of the text in one step: none
# after it can be closed either, so the search does not start over at each tag.
def _element_pattern(element: str) -> str:
    n = _name(element)
    return rf"(?is)<{n}(?=[\s>])[^>]*+(?:\z|(?<!/)>(?:(.*?)</{n}(?:>|\z)|.*\z))"


def elements(html: Column, element: str) -> Column:
    """Array of closed elements with their content, plus an unclosed rest if there is one."""
    return F.regexp_extract_all(html, F.lit(_element_pattern(element)), F.lit(0))


def is_closed(written: Column, element: str) -> Column:
    return written.rlike(rf"(?i)</{_name(element)}>?\z")


def element_content(html: Column, element: str) -> Column:
    """Text from the first start tag to the next closing tag; '' if there is none."""
    return F.regexp_extract(html, _element_pattern(element), 1)


def first_tag(html: Column, element: str) -> Column:
    """The first start tag of an element, '' if there is none."""
    return F.regexp_extract(html, start_tag_pattern(element), 0)
