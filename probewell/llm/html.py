"""A small HTML event reader: one compiled pattern finds the markup, the text between is kept as it is."""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

#: Elements whose content is not markup.
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp")
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s>/])[^>]*>(?P<inside>.*?)(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*)>"""
    r"|</?[a-zA-Z][^<>]*>|<[!?][^>]*>|</?[a-zA-Z][^<>]*\Z|<[!?][^>]*\Z",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


def events(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", "", text), ("open", name, attributes), ("close", name, "") and ("raw", name, content), in page order.

    Comments, declarations and a tag that the end of the page cuts are left out. Text is not decoded.
    """
    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() > at:
            yield "text", "", page[at : m.start()]
        at = m.end()
        if m["raw"]:
            yield "raw", m["raw"].lower(), m["inside"]
        elif m["name"]:
            yield ("close" if m["close"] else "open"), m["name"].lower(), m["attrs"]
    if at < len(page):
        yield "text", "", page[at:]


def attributes(raw: str) -> dict[str, str]:
    """Attribute values by lower-case name, decoded; the first of a repeated name counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        out.setdefault(name.lower(), _html.unescape(a or b or c))
    return out


def clean(text: str) -> str:
    """Decode character references, make white space one space each, trim."""
    return " ".join(_html.unescape(text).split())
