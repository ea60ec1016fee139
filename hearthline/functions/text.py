"""Text normalisation with Unicode-aware white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode space plus the four ASCII separator controls.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a pattern class, and the text that collapsing would change.
_SPACE = r"[\s\x1c-\x1f]"
_UNEVEN = rf"(?U){_SPACE}{{2}}|[\s\x1c-\x1f&&[^ ]]"


def trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACES))


def collapse_spaces(c: Column) -> Column:
    """Every run of white space as one space; most text has none to change."""
    even = F.regexp_replace(c, rf"(?U){_SPACE}+", " ")
    return F.when(c.rlike(_UNEVEN), even).otherwise(c)


def normalised(c: Column) -> Column:
    """Trim, lower-case and turn every run of white space into one space."""
    return collapse_spaces(F.lower(trimmed(c)))


def canonical_code(c: Column) -> Column:
    """A code as plain text: ``' 1000 '`` and ``'1000.0'`` are both ``'1000'``."""
    return F.regexp_replace(trimmed(c.cast("string")), r"\.0+$", "")
