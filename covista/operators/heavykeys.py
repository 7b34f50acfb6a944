"""Per-key results over keys of very unequal weight.

Every aggregate here is algebraic (count, min, sum), so each map task folds its
rows into one small state per key before anything is shuffled: a key with a third
of all rows costs a reducer as many rows as there are map tasks, no more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.sources.tables import memberships


def heavy_keys(df: DataFrame, key: str, part: int = 3, of: int = 100) -> DataFrame:
    """(key, rows, total) of the keys that hold at least ``part``/``of`` of all rows of ``df``.

    All rows count as delivered, repeated ones and those with a null key included;
    the null key itself is nobody and is never named. An empty table names none.
    """
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("rows"))
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return (
        counts.withColumn("total", total)
        .where(F.col("_k").isNotNull() & (F.col("rows") * of >= F.col("total") * part))
        .select(F.col("_k").alias(key), "rows", "total")
    )


def key_profile(df: DataFrame) -> DataFrame:
    """(person_id, rows, image_count, first_image) of every person of a membership table.

    rows counts the rows as delivered, image_count the distinct cleaned images,
    first_image is the least of them (null and 0 for a person with none). The
    distinct step is keyed by person *and* image, so no key is hot there; the second
    step ships one partial state per person and map task. Null person_ids are dropped.
    """
    from covista.functions.space import strip

    pairs = (
        df.select("person_id", strip("image_name").alias("image_name"))
        .where(F.col("person_id").isNotNull())
        .groupBy("person_id", F.nullif(F.col("image_name"), F.lit("")).alias("image_name"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return pairs.groupBy("person_id").agg(
        F.sum("n").alias("rows"), F.count("image_name").alias("image_count"), F.min("image_name").alias("first_image")
    )


def image_counts(df: DataFrame) -> DataFrame:
    """(person_id, image_count) over the cleaned distinct memberships."""
    return memberships(df).distinct().groupBy("person_id").agg(F.count(F.lit(1)).alias("image_count"))
