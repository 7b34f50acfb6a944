"""Entity directory: classes, search, paging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.functions.labels import display_name, photo_label, search_key
from covista.functions.urls import cdn_asset, face_url
from covista.sources.tables import memberships

# Classes in the order of the filter, and those shown by default.
CLASSES = ("named", "unknown", "unidentified", "ignored")
DEFAULT_CLASSES = ("named", "unknown")


def photo_counts(pei: DataFrame) -> DataFrame:
    """(person_id, photo_count, label) of every entity with an item."""
    c = memberships(pei).distinct().groupBy("person_id").agg(F.count(F.lit(1)).alias("photo_count"))
    return c.select("person_id", "photo_count", photo_label(F.col("photo_count")).alias("label"))


def of_classes(people: DataFrame, classes) -> DataFrame:
    """Rows of the given classes; no classes, no rows; unknown class names fit nothing."""
    return people.where(F.col("person_class").isin(*classes)) if classes else people.where(F.lit(False))


def entities(people: DataFrame) -> DataFrame:
    """One row an entity of a dimension with repeated rows."""
    return people.where("person_id is not null").groupBy("person_id").agg(
        *(F.max(c).alias(c) for c in ("name", "best_face_id", "include_in_network", "person_class")))


def directory(people: DataFrame, pei: DataFrame, classes=DEFAULT_CLASSES, query: str = "", cdn: str = "") -> DataFrame:
    """(person_id, name, image, photo_count) of entities of some classes whose displayed name holds the query.

    The search covers all entities, not only a loaded page, and ignores case and accents.
    """
    e = of_classes(entities(people), classes)
    e = e.withColumn("shown", display_name(F.col("person_id"), F.col("name")))
    key = search_key(F.lit(query))
    e = e.where((key == "") | search_key(F.col("shown")).contains(key))
    n = photo_counts(pei).select("person_id", "photo_count")
    image = cdn_asset(face_url(F.col("person_id"), F.col("name"), F.col("best_face_id"), cdn), cdn)
    return e.join(n, "person_id", "left").select(
        "person_id", F.col("shown").alias("name"), image.alias("image"), F.coalesce("photo_count", F.lit(0)).alias("photo_count"))


def page(rows: DataFrame, limit: int, offset: int) -> DataFrame:
    """One page in the total order (photo_count descending, person_id)."""
    return rows.orderBy(F.desc("photo_count"), "person_id").offset(offset).limit(limit)


def total(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("total"))
