"""k-way co-occurrence: which sets of entities share items, how many, and the first of them.

An equi-join of the memberships with themselves on the item, with the entities in
order, yields only sets that do occur; nothing is enumerated. All sides are hashed by
item, so the planner shuffles the memberships once and reuses the exchange. An item of
so many entities that its sets would be too much for one task is cut into blocks of
entities; each combination of blocks is joined apart.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.session import materialise

#: Sets that one item may yield in one task; an item with more is cut into blocks.
SETS_OF_AN_ITEM = 2_000_000


def numbered(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(memberships (person_id, item_no), items (item_no, image_name, held)): items numbered in binary order, with the number of their entities.

    With numbers the self-joins shuffle longs, and count and first item are aggregated in a hash
    table; the minimum of a string would make Spark sort all co-occurrences. Items are
    range-partitioned and sorted, so the ids that grow with partition and row grow with the name; they
    are written once, for range bounds are sampled.
    """
    ordered = members.groupBy("image_name").agg(F.count(F.lit(1)).alias("held")).repartitionByRange("image_name").sortWithinPartitions("image_name")
    items = materialise(ordered.withColumn("item_no", F.monotonically_increasing_id()), "items")
    return members.join(items.select("image_name", "item_no"), "image_name").select("person_id", "item_no"), items


def hashed(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(memberships (person_id, item_no), items (item_no, held)) with hashes in place of numbers, where counts alone are asked for."""
    m = materialise(members.select("person_id", F.xxhash64("image_name").alias("item_no")), "hashed-members")
    return m, m.groupBy("item_no").agg(F.count(F.lit(1)).alias("held"))


def _joined(coded: DataFrame, k: int, on: list[str]) -> DataFrame:
    """(item_no, e1 .. ek) of the sets of each item, entities in order."""
    sides = coded if isinstance(coded, list) else [coded] * k
    m = sides[0].select(*on, F.col("person_id").alias("e1"))
    for i in range(2, k + 1):
        m = m.join(sides[i - 1].select(*on, F.col("person_id").alias(f"e{i}")), on).where(F.col(f"e{i - 1}") < F.col(f"e{i}"))
    return m.select("item_no", *[f"e{i}" for i in range(1, k + 1)])


def _blocked(coded: DataFrame, wide: DataFrame, k: int, sets: int) -> DataFrame:
    """The same of wide items. An entity has one of g blocks; a cell is a block for each of the k places, and side i of the
    join goes to all cells that have its block at place i, so every set is found in one cell, of about ``sets`` sets at most."""
    g = F.ceil(F.col("held") / max(1, int(sets ** (1 / k))))
    own = coded.join(wide.select("item_no", g.cast("long").alias("g")), "item_no").withColumn("x", F.pmod(F.xxhash64("person_id"), F.col("g")))
    sides = []
    for i in range(1, k + 1):
        low = F.pow("g", F.lit(k - i)).cast("long")
        r = F.explode(F.sequence(F.lit(0).cast("long"), F.pow("g", F.lit(k - 1)).cast("long") - 1))
        spread = own.select("item_no", "person_id", "x", "g", low.alias("low"), r.alias("r"))
        cell = F.expr("r div low") * F.col("low") * F.col("g") + F.col("x") * F.col("low") + F.col("r") % F.col("low")
        sides.append(spread.select("item_no", "person_id", cell.alias("cell")))
    return _joined(sides, k, ["item_no", "cell"])


def most_held(k: int, sets: int) -> int:
    """Entities of which there are no more than ``sets`` sets of k."""
    n = k
    while math.comb(n + 1, k) <= sets:
        n = n + 1 if n < 64 else max(n + 1, int(n * 1.05))
    while math.comb(n, k) > sets:
        n -= 1
    return n


def _sets(coded: DataFrame, k: int, items: DataFrame, sets: int = SETS_OF_AN_ITEM) -> DataFrame:
    """(k, ids, image_total, item_no) of the sets of k; items: item_no, held, the number of an item's entities."""
    ids = [f"e{i}" for i in range(1, k + 1)]
    m = None
    if k > 1:
        wide = items.where(F.col("held") > most_held(k, sets)).select("item_no", "held")
        if not wide.isEmpty():
            m = _blocked(coded, wide, k, sets)
            coded = coded.join(wide.select("item_no"), "item_no", "left_anti")
    narrow = _joined(coded, k, ["item_no"])
    m = narrow if m is None else narrow.unionByName(m)
    found = m.groupBy(*ids).agg(F.count(F.lit(1)).alias("image_total"), F.min("item_no").alias("item_no"))
    return found.select(F.lit(k).alias("k"), F.array(*ids).alias("ids"), "image_total", "item_no")


def _named(found: DataFrame, items: DataFrame) -> DataFrame:
    return found.join(items.select("item_no", "image_name"), "item_no").select("k", "ids", "image_total", F.col("image_name").alias("first_item"))


def cooccur(members: DataFrame, k: int, sets: int = SETS_OF_AN_ITEM) -> DataFrame:
    """(ids array, image_total, first_item) of every set of k entities with a common item.

    members: distinct (person_id, image_name). ids are in binary order. k < 1 is an error.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if k == 1:
        one = members.groupBy("person_id").agg(F.count(F.lit(1)).alias("image_total"), F.min("image_name").alias("first_item"))
        return one.select(F.array("person_id").alias("ids"), "image_total", "first_item")
    coded, items = numbered(members)
    return _named(_sets(coded, k, items, sets), items).drop("k")


def combinations(members: DataFrame, max_k: int, sets: int = SETS_OF_AN_ITEM) -> DataFrame:
    """All non-empty sets of 1 to max_k entities: (k, ids, image_total, first_item)."""
    coded, items = numbered(members)
    return _named(reduce(DataFrame.unionByName, [_sets(coded, k, items, sets) for k in range(1, max_k + 1)]), items)


def counts(members: DataFrame, max_k: int, sets: int = SETS_OF_AN_ITEM) -> DataFrame:
    """(k, ids, image_total) of all non-empty sets of 1 to max_k entities, without their first items. Items are compared by 64-bit hash."""
    coded, items = hashed(members)
    return reduce(DataFrame.unionByName, [_sets(coded, k, items, sets).drop("item_no") for k in range(1, max_k + 1)])


def common_items(members: DataFrame, ids: list[str]) -> DataFrame:
    """Items that hold all the given entities; no ids, no items. One pass, one aggregation by item."""
    wanted = sorted(set(ids))
    hit = members.where(F.col("person_id").isin(wanted)) if wanted else members.where(F.lit(False))
    return hit.groupBy("image_name").agg(F.count_distinct("person_id").alias("n")).where(F.col("n") == len(wanted)).select("image_name")


def run_summary(members: DataFrame, entities: DataFrame, max_k: int) -> DataFrame:
    """One row (in_network, max_k, generated, skipped_empty); the empty sets are counted by the closed form."""
    generated = counts(members, max_k).agg(F.count(F.lit(1)).alias("generated"))
    n = entities.agg(F.count(F.lit(1)).alias("n")).scalar()
    d = F.col("in_network").cast("decimal(38,0)")
    every, term = F.lit(0).cast("decimal(38,0)"), F.lit(1).cast("decimal(38,0)")
    for k in range(1, max_k + 1):
        # C(n, k) = C(n, k - 1) * (n - k + 1) / k, each exact
        term = d if k == 1 else (term * (d - (k - 1)) / k).cast("decimal(38,0)")
        every = (every + F.greatest(term, F.lit(0))).cast("decimal(38,0)")
    return generated.select(
        n.alias("in_network"), F.lit(max_k).alias("max_k"), "generated"
    ).withColumn("skipped_empty", (every - F.col("generated")).cast("bigint"))
