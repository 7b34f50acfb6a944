"""Colours of chosen entities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covista.functions.space import strip

# Colours by position of the chosen entity.
PALETTE = ("#00bd00", "#ff42cc", "#ff6300", "#00abff", "#fcee00", "#00e4ca", "#a989ff", "#ff8795", "#7bff83", "#f8a5ff")
_HEX = r"(?i)\A#?([a-f0-9]{2})([a-f0-9]{2})([a-f0-9]{2})\z"


def colour(position: Column) -> Column:
    """Colour of a 0-based position; beyond the list it starts again."""
    return F.element_at(F.array(*map(F.lit, PALETTE)), (F.pmod(position, F.lit(len(PALETTE))) + 1).cast("int"))


def channel(hex_colour: Column, i: int) -> Column:
    """Red (1), green (2) or blue (3) of ``#RRGGBB``, null for anything else."""
    part = F.regexp_extract(strip(hex_colour), _HEX, i)
    return F.when(part != "", F.conv(part, 16, 10).cast("int"))


def rgba(hex_colour: Column, alpha: Column) -> Column:
    """CSS colour with an opacity; black for a malformed colour."""
    a = alpha.cast("string")
    r, g, b = (channel(hex_colour, i).cast("string") for i in (1, 2, 3))
    return F.when(r.isNull(), F.concat(F.lit("rgba(0, 0, 0, "), a, F.lit(")"))).otherwise(
        F.concat(F.lit("rgba("), F.concat_ws(",", r, g, b, a), F.lit(")")))
