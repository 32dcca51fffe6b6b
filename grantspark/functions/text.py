"""String expressions with the whitespace and case rules of the notice data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the data's producers see it (Java's \s lacks the non-ASCII part).
WS = r"[\s\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
# The same characters one by one: plain searches for them cost a small part of the pattern, which only texts that hold one need.
ASCII_WS = ("\t", "\n", "\x0b", "\f", "\r")
WIDE_WS = ("\xa0", "\u1680", *map(chr, range(0x2000, 0x200B)), "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", "\ufeff")
#: First bytes of those characters: no text without one of these pairs holds any, and six searches of bytes tell.
WIDE_LEADS = tuple(dict.fromkeys(w.encode()[:2] for w in WIDE_WS))
#: Before this last character ``$`` matches too.
NEXT_LINE = "\x85"
# ASCII word boundaries, spelt out because \b treats accented letters differently per engine.
WB_START = r"(?<![0-9A-Za-z_])"
WB_END = r"(?![0-9A-Za-z_])"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Column | str) -> Column:
    """NULL as the empty string."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def let(value: Column | str, body) -> Column:
    """Evaluate ``value`` once and use it many times: keeps nested text rules from multiplying.

    The value is the start of a fold over nothing, ``body`` its finish. Reading it out of a one-element array instead would have
    Spark work out the type of all nested rules again for each row.
    """
    return F.aggregate(F.array().cast("array<int>"), col(value), lambda held, _: held, body)


def has(c: Column | str, pattern: str) -> Column:
    """Case-insensitive (all scripts) search; NULL text never matches."""
    return blank(c).rlike("(?iu)" + pattern)


def sub(c: Column | str, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(blank(c), "(?iu)" + pattern, replacement)


def grab(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of a group, NULL when the pattern is not found."""
    found = F.regexp_extract_all(blank(c), F.lit("(?iu)" + pattern), F.lit(group))
    return F.get(found, F.lit(0))


def grab_all(c: Column | str, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(blank(c), F.lit("(?iu)" + pattern), F.lit(group))


def _holds(t: Column, parts: tuple[str | bytes, ...]) -> Column:
    return reduce(Column.__or__, [F.contains(t, F.lit(p)) for p in parts])


def squish(c: Column | str) -> Column:
    """Collapse whitespace runs to one space and trim."""

    def tidy(t):
        wide = (F.octet_length(t) != F.length(t)) & _holds(t.cast("binary"), WIDE_LEADS)
        narrow = reduce(lambda x, w: F.replace(x, F.lit(w), F.lit(" ")), ASCII_WS, t)
        spaced = F.when(wide, F.regexp_replace(t, WS, " ")).otherwise(narrow)
        return let(spaced, lambda x: F.trim(F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, "  +", " ")).otherwise(x)))

    return let(blank(c), tidy)


def strip(c: Column | str) -> Column:
    def bare(t):
        edge = F.substring(t, 1, 1).isin(" ", *ASCII_WS, *WIDE_WS) | F.substring(t, -1, 1).isin(" ", NEXT_LINE, *ASCII_WS, *WIDE_WS)
        return F.when(edge, F.regexp_replace(t, f"^{WS}+|{WS}+$", "")).otherwise(t)

    return let(blank(c), bare)


def says(collapsed: Column, *texts: str) -> Column:
    """Whether a text is one of a few in lower case; folding case never shortens, so only the start of a longer one is folded."""
    return F.lower(F.substring(collapsed, 1, max(map(len, texts)) + 1)).isin(*texts)


def none_if_blank(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def head(c: Column | str, n: int) -> Column:
    return F.substring(blank(c), 1, n)


def first_of(*options: Column) -> Column:
    return F.coalesce(*options)


def upto(c: Column, most: int | None) -> Column:
    """The first ``most`` characters; all of them where no limit is given."""
    return c if most is None else head(c, most)
