"""Sprite atlas: tiles in rows, in order of key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.model import ATLAS
from covista.operators.pages import numbered_by


def pack(keys: DataFrame, key: str, columns: int, tile: int) -> DataFrame:
    """(key, x, y, w, h): the i-th key in binary order stands in column i mod ``columns``."""
    k = keys.select(F.col(key).alias("key")).where("key is not null").distinct()
    return numbered_by(k, "key").select(
        "key", (F.col("i") % columns * tile).cast("int").alias("x"), (F.floor(F.col("i") / columns) * tile).cast("int").alias("y"),
        F.lit(tile).alias("w"), F.lit(tile).alias("h"))


def read(docs: DataFrame, text: str = "value") -> DataFrame:
    """(key, x, y, w, h) of atlas manifests held as JSON text."""
    return docs.select(F.explode(F.from_json(text, ATLAS)).alias("key", "t")).select("key", "t.*")
