"""Document-id search terms: normal form, and whether a term may still become an id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covista.functions.space import strip


def term(raw: Column, prefixes: tuple[str, ...]) -> Column:
    """Upper-case term without extension, hyphens and full stops.

    Behind a known prefix (the first that fits) a closing ``.LETTERS`` goes, also one just
    being typed; elsewhere only a closing .PDF, .WEBP, .JPEG or .JPG. Null and blank give ''.
    """
    u = F.upper(strip(F.coalesce(raw, F.lit(""))))
    out = F.translate(F.regexp_replace(u, r"\.(PDF|WEBP|JPEG|JPG)\z", ""), "-.", "")
    for p in reversed(prefixes):
        rest = F.substring(u, len(p) + 1, 1_000_000)
        rest = F.translate(F.regexp_replace(rest, r"(?i)\.[A-Z]*\z", ""), "-.", "")
        out = F.when(u.startswith(p), F.concat(F.lit(p), rest)).otherwise(out)
    return out


def _may_become(u: Column, prefixes: tuple[str, ...], digits: str) -> Column:
    out = F.lit(False)
    for p in reversed(prefixes):
        rest = F.substring(u, len(p) + 1, 1_000_000)
        out = F.when(F.lit(p).startswith(u), True).when(u.startswith(p), rest.rlike(digits)).otherwise(out)
    return F.when(u == "", True).otherwise(out)


def may_become_id(raw: Column, prefixes: tuple[str, ...]) -> Column:
    """Whether a term is the beginning of PREFIX + digits, as typed or in normal form."""
    u = F.upper(strip(F.coalesce(raw, F.lit(""))))
    return _may_become(term(raw, prefixes), prefixes, r"\A[0-9]*\z") | _may_become(
        u, prefixes, r"\A(?:[0-9]*|[0-9]+(?:-[0-9]+)*(?:\.[A-Z]{0,4})?)\z")
