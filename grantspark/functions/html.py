"""HTML expressions: anchors, tags and block text by pattern, inside code generation."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank, let, squish

#: An attribute's value, quoted or bare.
_VALUE = r"[\"']?((?<=[\"'])[^\"']*|(?<![\"'])[^\s\"'>]+)[\"']?"
ANCHOR = rf"<a\s[^>]*?href\s*=\s*{_VALUE}[^>]*>(.*?)<\/a>"
FRAME_SRC = rf"<(?:iframe|embed|object)\s[^>]*?src\s*=\s*{_VALUE}"
#: Elements whose text is the surroundings of a link.
BLOCK_OPEN = r"<(li|tr|article|section|td|p)([\s>])"
MARK = "\u0001"
_ENTITY = r"^&(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[A-Za-z][A-Za-z0-9]{1,31});"
#: All named entities of HTML 4, from the standard library; a space that does not break is a space.
_NAMED = json.dumps({name: chr(code) for name, code in name2codepoint.items()} | {"nbsp": " ", "apos": "'"})


def _decoded(piece: Column) -> Column:
    """A piece of text that may begin with an entity; unknown ones stay as they are."""
    name = F.regexp_extract(piece, _ENTITY, 1)
    digits = F.lower(F.substring(name, 2, 7))
    code = F.when(digits.startswith("x"), F.conv(F.substring(digits, 2, 6), 16, 10)).otherwise(digits).try_cast("int")
    numeric = F.when(code == 160, " ").when(
        code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    )
    char = F.when(name.startswith("#"), numeric).otherwise(F.try_element_at(F.from_json(F.lit(_NAMED), "map<string,string>"), name))
    rest = F.substring(piece, F.length(name) + 3, F.length(piece))
    return F.when(name == "", piece).otherwise(F.coalesce(F.concat(char, rest), piece))


def unescape(c: Column | str) -> Column:
    """Text with its named and numeric entities decoded, once."""
    return let(blank(c), lambda t: F.when(F.contains(t, F.lit("&")), F.array_join(F.transform(F.split(t, "(?=&)"), _decoded), "")).otherwise(t))


def text_of(html: Column | str) -> Column:
    """Text content, tags removed without a separator, whitespace collapsed."""
    return squish(unescape(F.regexp_replace(blank(html), r"(?s)<[^>]*>", "")))


def without(html: Column | str, *tags: str) -> Column:
    """Drop elements of the given tags with their content."""
    out = blank(html)
    for tag in tags:
        out = F.regexp_replace(out, rf"(?is)<{tag}[\s>].*?<\/{tag}\s*>", "")
    return out


def element(html: Column | str, tag: str, attrs: str = "") -> Column:
    """Inner HTML of the first element of a tag."""
    return F.when(
        blank(html).rlike(rf"(?is)<{tag}(?:\s[^>]*)?{attrs}[^>]*>.*?<\/{tag}\s*>"),
        F.regexp_extract(blank(html), rf"(?is)<{tag}(?:\s[^>]*)?{attrs}[^>]*>(.*?)<\/{tag}\s*>", 1),
    )


def all_matches(html: Column | str, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(blank(html), F.lit("(?is)" + pattern), F.lit(group))


def part(match: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(match, "(?is)" + pattern, group)


def attribute(tag: Column, name: str) -> Column:
    """Decoded value of a tag's attribute, quoted or bare; empty where there is none."""
    pattern = rf"\s{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return F.trim(unescape(F.concat(*[part(tag, pattern, i) for i in (1, 2, 3)])))


def blocks(html: Column | str) -> Column:
    """Page cut before every block element; each piece holds one block's opening and what follows."""
    return F.split(F.regexp_replace(blank(html), "(?i)" + BLOCK_OPEN, MARK + "<$1$2"), MARK)


def block_text(html: Column | str) -> Column:
    """One line per block element, styles and scripts dropped, blank lines removed."""
    h = without(html, "script", "style", "noscript")
    h = F.regexp_replace(h, r"(?i)<br\s*\/?>", "\n")
    h = F.regexp_replace(h, r"(?i)<\/(p|li|div|h1|h2|h3|h4|h5|h6|tr)\s*>", "\n</$1>")
    h = unescape(F.regexp_replace(h, r"(?s)<[^>]*>", ""))
    lines = F.filter(F.transform(F.split(h, "\n"), squish), lambda x: x != "")
    return F.array_join(lines, "\n")
