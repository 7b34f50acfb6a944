"""Entities and memberships: the layer every query reads through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.sources.tables import memberships

#: Up to so many entities in the network their ids are broadcast (some tens of MB).
BROADCAST_ENTITIES = 1_000_000


def membership_scan(pei: DataFrame) -> DataFrame:
    """Distinct cleaned (person_id, image_name)."""
    return memberships(pei).distinct()


def network_entities(people: DataFrame) -> DataFrame:
    """Distinct person_id of entities in the network (include_in_network = 1; null is not)."""
    return people.where("include_in_network = 1 and person_id is not null").select("person_id").distinct()


def network_people(people: DataFrame) -> DataFrame:
    """One row (person_id, name, best_face_id) for each entity in the network; repeated rows count once."""
    rows = people.where("include_in_network = 1 and person_id is not null")
    return rows.groupBy("person_id").agg(F.max("name").alias("name"), F.max("best_face_id").alias("best_face_id"))


def network_membership(pei: DataFrame, people: DataFrame) -> DataFrame:
    """Distinct memberships of the entities in the network.

    Up to BROADCAST_ENTITIES entities (counted first) the entity side is broadcast and prunes rows
    before anything is shuffled. Beyond, copies fall together first, by entity *and* item, so that
    an entity with very many rows is never hashed to one task; the semi-join that follows
    is free to split a heavy entity.
    """
    e = network_entities(people)
    if e.limit(BROADCAST_ENTITIES + 1).count() <= BROADCAST_ENTITIES:
        return memberships(pei).join(F.broadcast(e), "person_id", "left_semi").distinct()
    return memberships(pei).distinct().join(e, "person_id", "left_semi")


def without_items_of(members: DataFrame, entities: DataFrame) -> DataFrame:
    """Memberships of items that hold none of the given entities."""
    items = members.join(entities.select("person_id").distinct(), "person_id", "left_semi").select("image_name").distinct()
    return members.join(items, "image_name", "left_anti").select("person_id", "image_name")
