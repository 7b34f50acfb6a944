"""Co-presence graph over memberships. Items are compared by 64-bit hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covista.operators import cooc


def edges(members: DataFrame, sets: int = cooc.SETS_OF_AN_ITEM) -> DataFrame:
    """(src, dst, weight), src < dst: entities with common items, and how many: the sets of two, items of very many entities in blocks."""
    coded, items = cooc.hashed(members)
    return cooc._sets(coded, 2, items, sets).select(F.col("ids")[0].alias("src"), F.col("ids")[1].alias("dst"), F.col("image_total").alias("weight"))


def both_ways(e: DataFrame) -> DataFrame:
    """(node, neighbour, weight), every edge from both ends, without computing the edges twice."""
    ends = F.array(F.struct(F.col("src").alias("node"), F.col("dst").alias("neighbour")),
                   F.struct(F.col("dst").alias("node"), F.col("src").alias("neighbour")))
    return e.select(F.explode(ends).alias("x"), "weight").select("x.node", "x.neighbour", "weight")


def degree(e: DataFrame) -> DataFrame:
    """(node, degree): number of different neighbours. Edges are distinct, so a plain count does."""
    return both_ways(e).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def top_neighbours(e: DataFrame, n: int) -> DataFrame:
    """(node, neighbour, weight, rank) of the n heaviest edges of each node; ties by neighbour."""
    w = Window.partitionBy("node").orderBy(F.desc("weight"), "neighbour")
    return both_ways(e).withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= n)


def class_counts(entities: DataFrame, members: DataFrame) -> DataFrame:
    """(person_class, people, images): entities of each class, and distinct items that hold one of them."""
    e = entities.select("person_id", F.coalesce("person_class", F.lit("")).alias("person_class"))
    n = e.groupBy("person_class").agg(F.count(F.lit(1)).alias("people"))
    i = e.join(members, "person_id").select("person_class", "image_name").distinct().groupBy("person_class").agg(
        F.count(F.lit(1)).alias("images"))
    return n.join(i, "person_class", "left").select("person_class", "people", F.coalesce("images", F.lit(0)).alias("images"))


def without_classes(e: DataFrame, entities: DataFrame, hidden: list[str]) -> DataFrame:
    """Edges between nodes of shown classes; an entity without a class, or not in the dimension, is shown."""
    gone = entities.where(F.col("person_class").isin(*hidden)).select("person_id")
    return e.join(gone.select(F.col("person_id").alias("src")), "src", "left_anti").join(
        gone.select(F.col("person_id").alias("dst")), "dst", "left_anti").select("src", "dst", "weight")
