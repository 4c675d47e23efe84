"""Tokenisers (Q12-Q15).

The corpus is byte text: whitespace is the ASCII set and lower-casing
touches A-Z only, so ``translate`` is used instead of ``lower`` (which
would also fold accented letters).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII whitespace class and the letter tables for ASCII lower-casing.
WS_PATTERN = "[ \\t\\n\\r\\x0B\\f]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
URL_TERM = "[a-z0-9]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ascii_lower(c) -> Column:
    return F.translate(_col(c), UPPER, LOWER)


def ascii_strip(c) -> Column:
    """Strip ASCII whitespace at both ends (tabs, carriage returns and line feeds too, not only spaces)."""
    return F.regexp_replace(_col(c), "^[ \\t\\n\\r\\x0B\\f]+|[ \\t\\n\\r\\x0B\\f]+$", "")


def ws_terms(c) -> Column:
    """``str.split()``: ASCII-whitespace split with empty strings dropped (Q12)."""
    return F.filter(F.split(_col(c), WS_PATTERN), lambda x: x != F.lit(""))


def lower_ws_terms(c) -> Column:
    """Lower-cased field tokens for title / header / anchor / query (Q13)."""
    return ws_terms(ascii_lower(c))


def url_terms(c) -> Column:
    """Alphanumeric runs of the lower-cased url (Q14)."""
    return F.regexp_extract_all(ascii_lower(c), F.lit(URL_TERM), 0)


def url_flag(c, needle: str) -> Column:
    """Case-sensitive substring flag such as '.pdf' / '.php' (Q15)."""
    return F.instr(_col(c), needle) > 0
