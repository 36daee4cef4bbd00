"""Text in SQL expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(text: str | None) -> str:
    """A text as SQL literal."""
    if text is None:
        return "CAST(NULL AS STRING)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number_text(x: str) -> str:
    """SQL: a double of at most 4 decimals in plain notation: 14.51, 0.0, 12345678.25."""
    plain = f"regexp_replace(CAST(CAST({x} AS DECIMAL(38,4)) AS STRING), r'(\\.\\d+?)0+$', '$1')"
    return f"IF(abs({x}) < 1e16D, {plain}, CAST({x} AS STRING))"


# The characters that count as white space.
_SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Without white space at either end, line breaks included."""
    return F.trim(text, F.lit(_SPACES))
