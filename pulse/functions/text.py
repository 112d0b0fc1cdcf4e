"""String normalisation expressions used by loaders and marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


#: Every character that counts as white space, not the blank alone.
WHITE_SPACE = (" \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
               + "\u2028\u2029\u202f\u205f\u3000")


def strip(x: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.btrim(x, F.lit(WHITE_SPACE))


def blank_to_null(x) -> Column:
    """Trimmed text, or NULL when empty after trimming."""
    return F.nullif(strip(_c(x)), F.lit(""))


def first_available(*cols) -> Column:
    """First alternative that is non-blank (each trimmed)."""
    return F.coalesce(*[blank_to_null(c) for c in cols])


def clip_default(x, default: str, width: int, trim: bool = True) -> Column:
    """Fill NULL/blank with ``default``, cut to ``width`` characters, then trim."""
    v = F.left(F.coalesce(F.nullif(_c(x), F.lit("")), F.lit(default)), F.lit(width))
    return F.trim(v) if trim else v


def clip(x, width: int, trim: bool = True) -> Column:
    """Cut to ``width`` characters (NULL stays NULL)."""
    v = F.left(_c(x), F.lit(width))
    return F.trim(v) if trim else v


def strip_affix(x, affix: str) -> Column:
    """Remove every occurrence of ``affix`` (plain text, no pattern)."""
    return F.replace(_c(x), F.lit(affix), F.lit(""))


def affix_match(x, affix: str, at: str = "end") -> Column:
    """Literal affix test: 'end' (LIKE '%a'), 'start' (LIKE 'a%'), 'anywhere'."""
    c = _c(x)
    if at == "end":
        return c.endswith(affix)
    if at == "start":
        return c.startswith(affix)
    return c.contains(affix)


def address_tail(x) -> Column:
    """Last non-blank comma-separated part of an address string."""
    parts = F.filter(F.transform(F.split(_c(x), ","), strip), lambda p: p != "")
    return F.try_element_at(parts, F.lit(-1))


def truthy(x, tokens=("true", "jah", "1")) -> Column:
    """Case-insensitive token test; NULL -> false."""
    return F.coalesce(F.lower(strip(_c(x))).isin(list(tokens)), F.lit(False))
