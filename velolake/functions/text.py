"""Text standardization."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.
UNICODE_WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Four separators that count as blank in event ids as well.
INFORMATION_SEPARATORS = "\x1c\x1d\x1e\x1f"


# Text that starts and ends with visible ASCII, so nothing is left to trim.
TRIMMED_ASCII = r"^[!-~](.*[!-~])?\z"


def trimmed(text: Column) -> Column:
    """Trim every kind of Unicode white space (plain trim only takes spaces).

    Trimming a set of characters is slow, so it is left to texts that need it.
    """
    spaced = F.trim(text)
    return F.when(spaced.rlike(TRIMMED_ASCII), spaced).otherwise(F.btrim(spaced, F.lit(UNICODE_WHITE_SPACE)))


def category(text: Column) -> Column:
    return F.lower(trimmed(text))


def is_blank(text: Column) -> Column:
    """Nothing but white space; a visible ASCII character settles it at once."""
    return ~text.rlike("[!-~]") & (F.btrim(text, F.lit(UNICODE_WHITE_SPACE + INFORMATION_SEPARATORS)) == "")
