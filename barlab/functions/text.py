"""Text expressions."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the white space of Unicode text.
WHITE_SPACE = (" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
               "\u2028\u2029\u202f\u205f\u3000")


def unicode_pattern(pattern: str) -> str:
    """A pattern whose white space, digits and word ends are those of Unicode text."""
    return "(?U)" + pattern


def strip(value: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.btrim(value, F.lit(WHITE_SPACE))
