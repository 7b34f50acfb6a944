"""Escaping, and rewriting of tags in HTML text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The four sets of characters that the outputs escape ('&' always first).
HTML_QUOTED = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"))
HTML_ATTRIBUTE = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"))
HTML_REQUEST = (("&", "&amp;"), ('"', "&quot;"), ("<", "&lt;"))
XML_TEXT = (("&", "&amp;"), (">", "&gt;"), ("<", "&lt;"))


def escape(c: Column, table: tuple[tuple[str, str], ...] = HTML_QUOTED) -> Column:
    for a, b in table:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def replace_first(text: Column, pattern: str, value: Column) -> Column:
    """``text`` with the first match of ``pattern`` (no groups) made ``value``, taken literally; unchanged without a match."""
    hit = F.regexp_substr(text, F.lit(pattern))
    at = F.instr(text, hit)
    return F.when(hit.isNull() | value.isNull(), text).otherwise(
        F.concat(F.substring(text, F.lit(1), at - 1), value, F.substring(text, at + F.length(hit), F.length(text))))


def upsert_meta(html: Column, attr: str, key: str, content: Column) -> Column:
    """Set a meta tag: the first one of that key is replaced, else one is put before the first ``</head>``; without either the text stays.

    The text is split once, at the tag; only a text without the tag is looked through again.
    """
    tag = F.concat(F.lit(f'<meta {attr}="{key}" content="'), content, F.lit('" />'))
    parts = F.split(html, rf'(?i)<meta\s+{attr}="{key}"\s+content="[^"]*"\s*/?>', 2)
    return F.transform(F.array(parts), lambda p: F.when(F.size(p) == 2, F.concat(p[0], tag, p[1])).otherwise(
        replace_first(p[0], r"(?i)</head>", F.concat(F.lit("  "), tag, F.lit("\n</head>")))))[0]


def inject_image(pages: DataFrame, html: str, image_url: Column) -> DataFrame:
    """``pages`` with the social-card tags of the column ``html`` pointed at an image; a null address leaves a page as it is.

    One projection a tag: nested in one expression, each step would repeat the text of the one before.
    """
    c = F.col("_image")
    out = pages.withColumn("_was", F.col(html)).withColumn("_image", escape(image_url, HTML_REQUEST))
    for attr, key in (("property", "og:image"), ("property", "og:image:secure_url"), ("name", "twitter:image")):
        out = out.withColumn(html, upsert_meta(F.col(html), attr, key, c))
    out = out.withColumn(html, upsert_meta(F.col(html), "name", "twitter:card", F.lit("summary_large_image")))
    return out.withColumn(html, F.when(c.isNull(), F.col("_was")).otherwise(F.col(html))).drop("_was", "_image")


def meta_lines(tags: list[tuple[str, str, Column]]) -> Column:
    """One meta tag a line, two spaces in."""
    parts = []
    for attr, key, value in tags:
        parts += [F.lit(f'  <meta {attr}="{key}" content="'), value, F.lit('" />\n')]
    return F.concat(*parts)
