"""String helpers with R/stringr semantics, as JVM column expressions.

Each helper documents where Spark's built-in differs from the R verb and
how the difference is closed; nothing here runs Python per row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def detect(col, pattern: str, negate: bool = False) -> Column:
    """``str_detect``: unanchored regex search (``rlike`` is unanchored too)."""
    m = _c(col).rlike(pattern)
    return ~m if negate else m


def remove_first(col, pattern: str) -> Column:
    """``str_remove``: drop the FIRST match only."""
    return _first_match(col, pattern, "")


def replace_first(col, pattern: str, replacement: str) -> Column:
    """``str_replace``: replace the first match; ``replacement`` is literal."""
    return _first_match(col, pattern, replacement.replace("\\", "\\\\").replace("$", "\\$"))


_BACK_REFERENCE = re.compile(r"(?<!\\)(?:\\\\)*\\[1-9]")


def _first_match(col, pattern: str, replacement: str) -> Column:
    """Replace the first match of ``pattern``, wherever and on whatever line it is.

    ``regexp_replace`` replaces every match; anchored at the start of the text, with a lazy
    prefix kept as group 1 and the pattern in a group of its own (an alternation
    would end at the prefix otherwise), it can match once only.  A back-reference would
    count that group in, so numbered ones are refused; named groups work.
    """
    if _BACK_REFERENCE.search(pattern):
        raise ValueError(f"numbered back-reference in {pattern!r}: name the group instead")
    return F.regexp_replace(_c(col), rf"\A((?s:.*?))(?:{pattern})", "$1" + replacement)


def extract(col, pattern: str, group: int = 0) -> Column:
    """``str_extract``: NULL (not '') when the pattern does not match."""
    c = _c(col)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def trim(col) -> Column:
    """``str_trim``: white space of any kind off both ends (``F.trim`` takes spaces only)."""
    return F.regexp_replace(_c(col), r"\A\s+|\s+\z", "")


def str_sub(col, start: int, stop: int) -> Column:
    """``str_sub(x, start, stop)`` with 1-based inclusive positions."""
    return F.substring(_c(col), start, stop - start + 1)


def pad_right(col, width: int, pad: str = " ") -> Column:
    """``str_pad(side='right')``: longer input is kept whole (rpad truncates)."""
    c = _c(col)
    return F.when(F.length(c) >= width, c).otherwise(F.rpad(c, width, pad))


def pad_left(col, width: int, pad: str = " ") -> Column:
    c = _c(col)
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, pad))


def title_case(col) -> Column:
    """``str_to_title``: capitalise after whitespace AND after a hyphen.

    ``initcap`` only splits on whitespace; the hyphen case is fixed by a
    second pass on ``-x`` sequences.
    """
    return _upper_after_hyphen(F.initcap(_c(col)))


def _upper_after_hyphen(c: Column) -> Column:
    # split on hyphen, capitalise each piece's first letter, join back
    parts = F.split(c, "-")
    fixed = F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2))))
    return F.array_join(fixed, "-")


def clean_title(col, cap_all: bool = True) -> Column:
    """Snake-case place key to display title: ``new_haven`` -> ``New Haven``."""
    spaced = F.regexp_replace(_c(col), "_", " ")
    return F.initcap(spaced) if cap_all else F.concat(F.upper(F.substring(spaced, 1, 1)), F.substr(spaced, F.lit(2)))


def recode(col, mapping: Mapping[str, str]) -> Column:
    """``recode`` / ``fct_recode``: value map, unmatched values pass through."""
    c = _c(col)
    out = None
    for old, new in mapping.items():
        out = (F.when(c == old, F.lit(new)) if out is None else out.when(c == old, F.lit(new)))
    return c if out is None else out.otherwise(c)


def collapse(col, groups: Mapping[str, list[str]]) -> Column:
    """``fct_collapse``: several values to one label each."""
    c = _c(col)
    out = None
    for new, olds in groups.items():
        cond = c.isin(list(olds))
        out = F.when(cond, F.lit(new)) if out is None else out.when(cond, F.lit(new))
    return c if out is None else out.otherwise(c)


def percent(col, accuracy: float = 0.1) -> Column:
    """``scales::percent(accuracy=)``: ``0.1234`` -> ``12.3%``; NULL stays NULL.

    The percentage is rounded to a multiple of ``accuracy`` and printed with
    the decimals that ``accuracy`` itself has.  ``format_string`` would print
    ``null%``; the ``when`` keeps NULL.
    """
    exact = Decimal(str(accuracy)).normalize()
    digits = max(0, -exact.as_tuple().exponent)
    c = _c(col)
    pct = c * 100
    if exact.as_tuple().digits != (1,):
        pct = F.round(pct / accuracy) * accuracy
    return F.when(c.isNotNull(), F.concat(F.format_string(f"%.{digits}f", pct), F.lit("%")))


def url_encode(col) -> Column:
    """RFC 3986 percent-encoding: ``%20`` for space, ``*`` encoded, ``~`` kept.

    Spark's ``url_encode`` is form encoding (``+`` for space, ``*`` and
    ``~`` the other way round), so three fix-ups follow it.
    """
    e = F.regexp_replace(F.url_encode(_c(col)), "\\+", "%20")
    e = F.regexp_replace(e, "\\*", "%2A")
    return F.regexp_replace(e, "%7E", "~")


def url_with_query(base: str, params: list[tuple[str, object]]) -> Column:
    """``modify_url(base, query=list(...))``: parameters in the given order.

    Values may be columns or Python scalars; every value is percent-encoded.
    """
    pieces: list[Column] = [F.lit(base + "?")]
    for i, (k, v) in enumerate(params):
        val = v if isinstance(v, Column) else F.lit(str(v))
        if i:
            pieces.append(F.lit("&"))
        pieces.append(F.lit(f"{k}="))
        pieces.append(url_encode(val))
    return F.concat(*pieces)


def unite(cols, sep: str = "_", na: str = "NA") -> Column:
    """``tidyr::unite``: NA is written as the text ``NA`` (concat_ws skips nulls)."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit(na)) for c in cols])


_CLEAN_NON_WORD = re.compile(r"[^0-9a-zA-Z]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def clean_names(names: list[str]) -> list[str]:
    """``janitor::clean_names`` for a header: repeated results get ``_2``, ``_3``, .. in order."""
    seen: dict[str, int] = {}
    out = []
    for name in map(clean_name, names):
        seen[name] = n = seen.get(name, 0) + 1
        out.append(name if n == 1 else f"{name}_{n}")
    return out


def clean_name(name: str) -> str:
    """``janitor::clean_names`` for one header (driver-side, on column names)."""
    s = _CAMEL.sub("_", name.strip())
    s = _CLEAN_NON_WORD.sub("_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s
