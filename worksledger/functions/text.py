"""Text clean-up and display."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every Unicode space separator (category Zs). Tabs and line breaks are not in
# that category and therefore survive cleaning.
SPACE_SEPARATORS = (
    "\u0020\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u202f\u205f\u3000"
)


def strip_spaces(col: Column | str) -> Column:
    """Remove space separators at both ends.

    U+0020 is the only ASCII one, so pure ASCII text takes the plain ``trim``;
    only other text pays for the character-set trim (about three times slower).
    """
    c = F.col(col) if isinstance(col, str) else col
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.trim(c)).otherwise(F.btrim(c, F.lit(SPACE_SEPARATORS)))


def clean_text(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Strip the given columns and rename them; only these columns are returned."""
    return df.select(*[strip_spaces(src).alias(dst) for src, dst in mapping.items()])


def truncate_text(col: Column | str, n: int) -> Column:
    """The first ``n`` characters, with an ellipsis when something was cut."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.char_length(c) > n, F.concat(F.substring(c, 1, n), F.lit("…"))).otherwise(c)


def null_display(col: Column | str) -> Column:
    """Text for a table cell; a missing value becomes a dash."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit("—"))


def plain_number(col: Column | str) -> Column:
    """A double as browsers print it: ``12345678``, not ``1.2345678E7``.

    Spark's text is already right between 1e-3 and 1e7 apart from a trailing
    ``.0``. Outside, the value goes through a decimal wide enough to hold the
    shortest digits of any double in that range; only beyond 1e21 and below
    1e-6 is the exponent form itself the expected text.
    """
    c = F.col(col) if isinstance(col, str) else col
    text = c.cast("string")
    size = F.abs(c)

    def digits(kind: str) -> Column:
        return F.regexp_replace(c.cast(kind).cast("string"), r"\.?0+$", "")

    exponent = F.regexp_replace(text, r"\.0E", "E")
    exponent = F.regexp_replace(exponent, r"E(\d)", "e+$1")
    return (
        F.when(c == 0, F.lit("0"))
        .when((size >= 1e-3) & (size < 1e7), F.regexp_replace(text, r"\.0$", ""))
        .when((size >= 1e7) & (size < 1e21), digits("decimal(38,10)"))
        .when((size >= 1e-6) & (size < 1e-3), digits("decimal(38,26)"))
        .otherwise(F.regexp_replace(exponent, "E-", "e-"))
    )
