"""String expressions shared by the normalising projections and the searches.

All of them are JVM-side built-ins, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: prefix of an id in the public catalogue.
CATALOGUE_PREFIX = "https://openalex.org/"

# Every character Python's str.strip() removes. Spark's trim()
# without a character list removes only spaces.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing Unicode white space."""
    return F.btrim(c, F.lit(STRIP_CHARS))


def strip_prefix(c: Column) -> Column:
    """Remove every occurrence of the catalogue prefix."""
    return F.replace(c, F.lit(CATALOGUE_PREFIX), F.lit(""))


def bare_id(c: Column) -> Column:
    """Work id without prefix and outer white space; null becomes ``''``."""
    return strip_ws(strip_prefix(F.coalesce(c, F.lit(""))))


def non_empty(c: Column) -> Column:
    """The text, or null when it is null or ``''`` (blank text is kept)."""
    return F.nullif(c, F.lit(""))


def safe_name(c: Column) -> Column:
    """File-name form of a query text: letters, digits, ``-`` and ``_`` stay,
    any other character becomes ``_``; cut to 80 characters."""
    return F.substring(F.regexp_replace(c, r"[^\p{L}\p{N}_-]", "_"), 1, 80)


def contains_all(text: Column, tokens: list[str]) -> Column:
    """True when the lower-cased text contains every token."""
    lowered = F.lower(text)
    found = F.lit(True)
    for token in tokens:
        found = found & F.contains(lowered, F.lit(token.lower()))
    return found
