"""Names, headings and counts as text. Every function maps columns to a column and stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covista.functions.space import blank_to_null, strip

# Accented Latin letters and the plain letter each stands for in searches, one for one.
ACCENTED = "àáâãäåāăąçćĉċčďđèéêëēĕėęěĝğġģĥħìíîïĩīĭįıĵķĺļľŀłñńņňòóôõöøōŏőŕŗřśŝşšţťŧùúûüũūŭůűųŵýÿŷźżžẑ"
PLAIN = "aaaaaaaaacccccddeeeeeeeeegggghhiiiiiiiiijklllllnnnnooooooooorrrssssttttuuuuuuuuuuwyyyzzzz"
# Letters that stand for two.
DOUBLE = {"æ": "ae", "œ": "oe", "ß": "ss", "þ": "th"}


def chip_label(entity_id: Column | str, name: Column | str) -> Column:
    """Stripped name, or the id where there is none."""
    return F.coalesce(blank_to_null(name), F.col(entity_id) if isinstance(entity_id, str) else entity_id)


def heading(labels: Column) -> Column:
    """'Photos of A', '... A and B', '... A, B, and C'; 'Photos' without labels."""
    n = F.size(labels)
    rest = F.concat_ws(", ", F.slice(labels, F.lit(1), F.greatest(n - 1, F.lit(0))))
    last = F.try_element_at(labels, F.lit(-1))
    return (
        F.when(n <= 0, "Photos")
        .when(n == 1, F.concat(F.lit("Photos of "), last))
        .when(n == 2, F.concat(F.lit("Photos of "), rest, F.lit(" and "), last))
        .otherwise(F.concat(F.lit("Photos of "), rest, F.lit(", and "), last))
    )


def meta_description(head: Column, total: Column, site: str) -> Column:
    """Heading with the count of images, which a count of 0 or less leaves out."""
    return F.when(total <= 0, F.concat(head, F.lit(f" on {site}."))).otherwise(
        F.concat(head, F.lit(" — "), total.cast("string"), F.lit(f" images on {site}.")))


def slug(ids: Column) -> Column:
    """Ids in their given order, joined by '-'."""
    return F.array_join(ids, "-")


def file_label(label: Column) -> Column:
    """Letters, digits and '._- ' of a label, spaces as '_'; 'node' where nothing is left."""
    kept = strip(F.regexp_replace(label, r"[^\p{L}\p{N}._\- ]", ""))
    return F.coalesce(F.nullif(F.replace(kept, F.lit(" "), F.lit("_")), F.lit("")), F.lit("node"))


def stub_number(entity_id: Column) -> Column:
    """Number of an id ``person_<digits>`` in any case, else null (also beyond 64 bits)."""
    return F.regexp_extract(strip(entity_id), r"(?i)\Aperson_(\d+)\z", 1).try_cast("bigint")


def display_name(entity_id: Column, name: Column) -> Column:
    """Stripped name, else 'Person <n>' for a numbered id, else the id."""
    n = stub_number(entity_id)
    return F.coalesce(blank_to_null(name), F.concat(F.lit("Person "), n.cast("string")), entity_id)


def search_key(text: Column) -> Column:
    """Lower case without accents, curly apostrophes straight: the form that name searches compare."""
    t = F.lower(F.translate(strip(F.coalesce(text, F.lit(""))), "’‘", "''"))
    t = F.translate(t, ACCENTED, PLAIN)
    for a, b in DOUBLE.items():
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def photo_label(n: Column) -> Column:
    return F.when(n == 1, "1 photo").otherwise(F.concat(n.cast("string"), F.lit(" photos")))


def subtitle(query: Column, shown: Column, loaded: Column, total: Column, any_class: Column) -> Column:
    """Count line above a directory: nothing, totals, or matches among what is loaded."""
    s = lambda c: c.cast("string")
    blank = F.coalesce(strip(query), F.lit("")) == ""
    return (
        F.when(F.coalesce(total, F.lit(0)) == 0, F.when(any_class, "").otherwise("0 people"))
        .when(blank & (loaded < total), F.concat(s(loaded), F.lit(" of "), s(total), F.lit(" people")))
        .when(blank, F.concat(s(total), F.lit(" people")))
        .when(shown == 0, "No matches")
        .otherwise(F.concat(s(shown), F.lit(" of "), s(loaded), F.lit(" loaded ("), s(total), F.lit(" total)")))
    )


def class_list(raw: Column, present: Column, default: list[str]) -> Column:
    """Classes of a URL parameter: the default where it is absent, none where it is blank."""
    parts = F.filter(F.transform(F.split(raw, ","), lambda x: F.lower(strip(x))), lambda x: x != "")
    return F.when(~present, F.array(*map(F.lit, default))).when(F.coalesce(strip(raw), F.lit("")) == "", F.array().cast(
        "array<string>")).otherwise(parts)


def class_param(classes: Column, default: list[str]) -> Column:
    """Parameter of a selection: sorted; null for the default selection (as a multiset), '' for none."""
    same = F.array_sort(classes) == F.array(*map(F.lit, sorted(default)))
    return F.when(F.size(classes) == 0, "").when(same, F.lit(None)).otherwise(F.array_join(F.array_sort(classes), ","))
