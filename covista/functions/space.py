"""White space as the membership tables define it (every Unicode space, non-breaking kinds included)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a value.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0            "
    "    　"
)


def strip(c: Column | str) -> Column:
    """``c`` without white space at both ends; null stays null. A JVM built-in, so it stays in codegen."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trim(c, F.lit(WHITE_SPACE))


def blank_to_null(c: Column | str) -> Column:
    """Stripped ``c``, null where nothing is left."""
    return F.nullif(strip(c), F.lit(""))
