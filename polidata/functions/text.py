"""Text functions (JVM-side regular expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from polidata.functions.nullsafe import _c

# Accented letters folded to ASCII in person names.
ACCENTED = "áàâäãéèêëíìîïóòôöõúùûüñç"
PLAIN = "aaaaaeeeeiiiiooooouuuunc"

# Name suffixes ignored when picking a last name.
NAME_SUFFIXES = ["Jr", "II", "III", ""]


def first_match(c, pattern: str) -> Column:
    """``str_extract``: first regex match, NULL when there is none."""
    return F.regexp_substr(_c(c), F.lit(pattern))


def paren_text(c) -> Column:
    """Text inside the first pair of parentheses, NULL when absent."""
    return F.nullif(F.regexp_extract(_c(c), r"\(([^()]*)\)", 1), F.lit(""))


def replace_first(c, pattern: str, replacement: str) -> Column:
    """``str_replace``: only the first match (``regexp_replace`` replaces all);
    texts may have line breaks and the pattern groups of its own."""
    return F.regexp_replace(_c(c), f"^(?<head>(?s:.*?))(?:{pattern})(?<tail>(?s:.*))$", f"${{head}}{replacement}${{tail}}")


def remove_paren(c) -> Column:
    """Drop the first parenthesised group (and the blank before it), trim."""
    return F.trim(replace_first(c, r"\s*\([^()]*\)", ""))


def fold_accents(c) -> Column:
    return F.translate(_c(c), ACCENTED, PLAIN)


def strip_controls(c) -> Column:
    """Remove tabs and newlines (page text cleanup)."""
    return F.regexp_replace(_c(c), r"[\n\t\r]", "")


def drop_last_char(c) -> Column:
    c = _c(c)
    return F.substring(c, F.lit(1), F.greatest(F.length(c) - 1, F.lit(0)))


def ordinal_suffix(n, upto: int | None = 110) -> Column:
    """st / nd / rd / th; the source applies st/nd/rd only below ``upto``.

    With ``upto=None`` the general English rule (11-13 take th) is used.
    """
    n = _c(n)
    last = n % 10
    if upto is not None:
        small = n < upto
        return (F.when(small & (last == 1), "st").when(small & (last == 2), "nd")
                .when(small & (last == 3), "rd").otherwise("th"))
    teen = (n % 100).between(11, 13)
    return (F.when(teen, "th").when(last == 1, "st").when(last == 2, "nd")
            .when(last == 3, "rd").otherwise("th"))


def flip_name(c) -> Column:
    """"Last, First M." -> "First M. Last" (no comma: unchanged)."""
    c = _c(c)
    parts = F.split(c, ",", 2)
    return F.when(F.size(parts) < 2, F.trim(c)).otherwise(
        F.concat_ws(" ", F.trim(F.get(parts, 1)), F.trim(F.get(parts, 0))))


def name_tokens(c) -> Column:
    """Clean a name into match tokens.

    Commas, hyphens and periods become blanks, single capital initials are
    dropped, and the remainder is split on whitespace; empty tokens go.
    """
    s = F.regexp_replace(_c(c), r"[,\-.]", " ")
    s = F.regexp_replace(s, r"^[A-Z]\s+", " ")
    # Initials between blanks (non-overlapping, like a global replace).
    s = F.regexp_replace(s, r"\s+[A-Z]\s+", " ")
    s = F.trim(s)
    return F.filter(F.split(s, r"\s+"), lambda t: t != "")


def last_name(c) -> Column:
    """Last whitespace token that is not a suffix such as Jr / II / III."""
    toks = F.filter(F.split(_c(c), " "), lambda t: ~t.isin(*NAME_SUFFIXES))
    return F.element_at(toks, -1)


def contains_any(c, tokens) -> Column:
    """Case-insensitive: does ``c`` contain any element of the array column
    ``tokens`` as a substring?  (A pattern built from another column, as an
    alternation, without building regex text per row.)"""
    c = _c(c)
    toks = _c(tokens)
    return F.exists(toks, lambda t: (F.length(t) > 0) & F.lower(c).contains(F.lower(t)))
