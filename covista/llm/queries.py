"""Queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covista.llm import canonical, leaks, names, overlap, setpairs, subjects, together, tokens
from covista.plans import catalogue
from covista.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.same_look_pairs(table(spark, d, "people"))


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    """The one form of every name."""
    people = table(spark, d, "people").select("person_id", "name").distinct()
    return people.select("person_id", canonical.look_of("name").alias("form"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return setpairs.similar_persons(table(spark, d, "person_eligible_images"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    pei, cmp = table(spark, d, "person_eligible_images"), table(spark, d, "compare_list")
    return overlap.near_sets(overlap.person_overlaps(pei, cmp))


def p5_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Shared images of every pair of compared persons; a pair without a row shares none."""
    o = overlap.person_overlaps(table(spark, d, "person_eligible_images"), table(spark, d, "compare_list"))
    return o.select(F.col("set_a").alias("person_id_a"), F.col("set_b").alias("person_id_b"), "shared")


def p6_together(spark: SparkSession, d: str) -> DataFrame:
    """Shared images of every pair of persons that shares one, and the ratio to the number expected by chance."""
    t = together.persons_together(table(spark, d, "person_eligible_images"), least=1)
    return t.select(F.col("item_a").alias("person_id_a"), F.col("item_b").alias("person_id_b"), "shared", F.round("ratio", 6).alias("ratio"))


def p6_likelihood(spark: SparkSession, d: str) -> DataFrame:
    """p6_together's pairs with Dunning's log-likelihood ratio."""
    t = together.persons_together(table(spark, d, "person_eligible_images"), least=1)
    return t.select(F.col("item_a").alias("person_id_a"), F.col("item_b").alias("person_id_b"), "shared", F.round("ratio", 6).alias("ratio"),
                    (F.round("llr", 6) + F.lit(0.0)).alias("llr"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs found together often, more often than chance, and significantly so.

    The last condition takes nothing away from the first two: with e expected, G² is at
    least 2 (c ln(c / e) - c + e), 8.6 for c = 10 = 3 e, and grows with c and c / e.
    """
    found = together.persons_together(table(spark, d, "person_eligible_images"), least=10, lift=(3, 1), significance=together.SIGNIFICANT)
    return found.select(F.col("item_a").alias("person_id_a"), F.col("item_b").alias("person_id_b"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return names.same_name_pairs(table(spark, d, "people"), table(spark, d, "given_name_forms"))


def p7_entities(spark: SparkSession, d: str) -> DataFrame:
    """Every person_id whose name means somebody, with the least person_id of those that mean the same."""
    return names.entity_ids(table(spark, d, "people"), table(spark, d, "given_name_forms"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaked_items(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_clean(spark: SparkSession, d: str) -> DataFrame:
    """Every document with a leak, without the words of the leaked spans; a document without a row stays as it is."""
    return leaks.without_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.document_subjects(table(spark, d, "documents"), table(spark, d, "subject_labels"), table(spark, d, "subjects"))


def queries():
    return {f.__name__: f for f in (
        p1_found, p1_forms, p2_found, p5_found, p5_overlaps, p6_found, p6_together, p6_likelihood, p7_found, p7_entities, p8_ids, p9_found, p9_clean, p10_found)}


_M = catalogue.M
_PAIRS = f"""{_M}, n as (select person_id p, count(*) n from m group by 1),
pr as (select a.person_id a, b.person_id b, count(*) c from m a join m b on a.image_name = b.image_name and a.person_id < b.person_id group by 1, 2),
pn as (select a person_id_a, b person_id_b, c, x.n na, y.n nb from pr join n x on x.p = a join n y on y.p = b)"""


_G = " + ".join(f"(case when {k} > 0 then ({k}) * ln(({k}) / ({e})) else 0.0 end)" for k, e in (
    ("k", "x * y / n"), ("x - k", "x * (n - y) / n"), ("y - k", "y * (n - x) / n"), ("n - x - y + k", "(n - x) * (n - y) / n")))


def oracle_sql() -> dict[str, str]:
    """SQL where it says the same in reasonable time; the other queries are tested against brute force."""
    return {
        "p2_found": f"with {_PAIRS} select person_id_a, person_id_b from pn where na >= 5 and nb >= 5 and 5 * c >= 3 * (na + nb - c)",
        "p5_found": f"with {_PAIRS} select person_id_a, person_id_b from pn where 5 * c >= 2 * least(na, nb) "
        "and person_id_a in (select person_id from compare_list) and person_id_b in (select person_id from compare_list)",
        "p5_overlaps": f"with {_PAIRS} select person_id_a, person_id_b, c shared from pn "
        "where person_id_a in (select person_id from compare_list) and person_id_b in (select person_id from compare_list)",
        "p6_together": f"with {_PAIRS} select person_id_a, person_id_b, c shared, "
        "round(c::double * (select count(distinct image_name) from m) / (na::double * nb), 6) ratio from pn",
        "p6_likelihood": f"with {_PAIRS}, z as (select *, c::double k, na::double x, nb::double y, (select count(distinct image_name) from m)::double n from pn) "
        f"select person_id_a, person_id_b, c shared, round(k * n / (x * y), 6) ratio, round(2.0 * ({_G}), 6) + 0.0 llr from z",
        "p6_found": f"with {_PAIRS} select person_id_a, person_id_b from pn where c >= 10 and c * (select count(distinct image_name) from m) >= 3 * na * nb",
    }
