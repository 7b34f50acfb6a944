"""Parquet tables with explicit schemas; extra columns are pruned at the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covista.functions.space import strip


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a data folder. A missing table is an error at once (catalog check)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def memberships(df: DataFrame, entity: str = "person_id", item: str = "image_name") -> DataFrame:
    """(person_id, image_name) of a membership table, items stripped, null and blank ones dropped.

    Not yet distinct: consumers that deduplicate anyway (grouping by both columns)
    save the extra shuffle. Rows with a null entity belong to nobody and are dropped.
    """
    return df.select(F.col(entity).alias("person_id"), strip(item).alias("image_name")).where(
        F.col("person_id").isNotNull() & (F.col("image_name") != "")
    )
