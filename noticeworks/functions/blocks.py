"""Notice blocks of a page, with the elements that nest in them."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from noticeworks.functions import records
from noticeworks.functions.html import visible

_TAG = re.compile(
    r"<(?P<end>/?)(?P<name>h[1-6]|tr|li|article|div|section|main|aside|body|table|tbody|thead|td|th|ul|ol|dl|details|form)(?=[\s>/])(?P<rest>[^>]*)>", re.I)
_CARD = re.compile(r"""\bclass\s*=\s*["'][^"']*\bcard\b""", re.I)
_BREAKS = re.compile(r"<br\s*/?>|</(?:p|div|h[1-6]|li|tr|dt|dd|section|article)>", re.I)
_ANY_TAG = re.compile(r"<[^>]+>")
#: An element without end tag ends where a sibling begins: up to the nearest of these it is closed.
_SIBLINGS = {"li": ({"li"}, {"ul", "ol"}), "tr": ({"tr"}, {"table", "tbody", "thead"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"})}
_CASE = tuple(re.compile(pattern) for pattern in (records.CASE_LABEL, records.CASE_SHAPE))


def _numbered(content: str) -> bool:
    text = _ANY_TAG.sub(" ", _BREAKS.sub("\n", content))
    return any(pattern.search(text) for pattern in _CASE)


def blocks_of(page: str) -> list[str]:
    """The blocks of a page in the order they begin, those that are part of another as empty.

    A heading, table row, list item, article or card begins a block. It ends where its element closes; a
    heading's where a heading of its rank or above begins or the element around it closes. A block
    inside another is a block of its own if it has a case number, and else part of the outer one.
    What stands in no block is the first one, if it is text or has a number. Takes time in proportion to the page.
    """
    segments: list[tuple[int, str]] = []  # block and markup, in reading order
    around = [0]  # of each block the one around it
    open_: list[tuple[str, int]] = [("", 0)]  # open elements and their blocks; a heading stays open for its section

    def close(names: set[str], stop: set[str] = frozenset()) -> None:
        """Closes the innermost element of these names and all in it, unless it lies beyond one of ``stop``."""
        for i in range(len(open_) - 1, 0, -1):
            if open_[i][0] in names:
                del open_[i:]
                return
            if open_[i][0] in stop:
                return

    at = 0
    for tag in _TAG.finditer(page):
        name = tag["name"].lower()
        heading = name[0] == "h"
        segments.append((open_[-1][1], page[at:tag.start()]))
        at = tag.start()
        if tag["end"]:
            if not heading:
                segments.append((open_[-1][1], tag.group()))
                close({name})
                at = tag.end()
            continue
        if heading:
            while open_[-1][0][:1] == "h" and open_[-1][0] >= name:
                open_.pop()
        elif name in _SIBLINGS:
            close(*_SIBLINGS[name])
        block = open_[-1][1]
        if heading or name in ("tr", "li", "article") or (name == "div" and _CARD.search(tag["rest"])):
            around.append(block)
            block = len(around) - 1
        open_.append((name, block))
    segments.append((open_[-1][1], page[at:]))

    own: list[list[str]] = [[] for _ in around]
    for block, markup in segments:
        own[block].append(markup)
    numbered = [_numbered("".join(parts)) for parts in own]
    owner = [0] * len(around)
    for block in range(1, len(around)):  # outer blocks have smaller numbers
        owner[block] = block if numbered[block] else owner[around[block]]
    contents: list[list[str]] = [[] for _ in around]
    for block, markup in segments:
        contents[owner[block]].append(markup)
    first = 0 if numbered[0] or _ANY_TAG.sub("", "".join(own[0])).strip() else 1
    return ["".join(parts) for parts in contents[first:]]


@F.pandas_udf(ArrayType(StringType()))
def _blocks(pages: pd.Series) -> pd.Series:
    return pages.map(lambda page: None if page is None else blocks_of(page))


def notice_blocks(html: Column) -> Column:
    """``blocks_of`` a page without scripts, frames and comments.

    Elements nest without bound, so tags are walked with a stack of open elements, in Python.
    """
    return _blocks(visible(html))
