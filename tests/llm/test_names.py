import random

import pytest

from covista.llm import names
from tests.conftest import rows

FORMS = [("Hab", "Habrodain"), ("Jeb", "Jebim"), ("Briko", "Skibrim"), ("Briko", "Zuribris"), ("Tod", "Todutram"), ("Tho", "Thozokaim")]
P = names.Parser(FORMS)
SCHEMA = "person_id string, name string, entity string"


@pytest.mark.parametrize("name, core, givens", [
    ("Jebim Retheshadru", "retheshadru", ("jebim",)), ("Prof. Jebim E. Retheshadru", "retheshadru", ("jebim", "e.")),
    ("Porf. RETHESHADRU Jeb", "retheshadru", ("jebim|jeb~",)), ("Retheshadru, Jebim", "retheshadru", ("jebim",)), ("JebimRetheshadru", "retheshadru", ("jebim",)),
    ("Jbeim Retheshadru", "retheshadru", ("jebim",)), ("Jeb-Retheshadru", "retheshadru", ("jebim|jeb~",)), ("J-Retheshadru", "retheshadru", ("j.",)),
    ("JRetheshadru", "retheshadru", ("j.",)), ("Хабродаин Ретешадру", "reteshadru", ("habrodain",)), ("Ф. Ретешадру", "reteshadru", ("f.|t.",)),
    ("Jebim Retheshadru-Vesk", "retheshadruvesk", ("jebim",))])
def test_parse(name, core, givens):
    kind, c, g, _ = P.parse(name)
    assert (kind, c) == ("person", core)
    if givens:
        assert g == givens


@pytest.mark.parametrize("name", [None, "", "  ", "Guest 2901", "Unknown #7", "12", "--"])
def test_nobody(name):
    assert P.parse(name) is None


def test_organisations():
    P = names.Parser(FORMS, ("film", "works", "group"))
    assert P.parse("Skedra FilmW irks Ltd") == P.parse("Skedra Flim Works Ltd") == ("org", "skedra", ("film", "works"), "")
    assert P.parse("Skedra Film Grp")[2] == ("film", "group")
    a = {P.parse(n) for n in ("Skedra Film Works Ltd", "The Skedra Film Works Limited", "SKEDRA FILM WORKS & SONS", "Skedra Film Works")}
    assert len(a) == 1 and a.pop()[0] == "org"


def test_organisation_words_are_learned(spark):
    r = [(f"{x} Film Works {y}",) for x in ("Skedra", "Pluvan", "Mitor") for y in ("Ltd", "& Co", "GmbH")] + [("Jebim Skedra",), (None,), ("Hab Mitor Ltd",)]
    assert names.organisation_words(spark.createDataFrame(r, "name string")) == ["film", "works"]
    assert names.organisation_words(spark.createDataFrame([], "name string")) == []


def test_ways_of_short_forms_are_learned():
    p = names.Parser([("Rodio", "Rodan"), ("Habio", "Habrodain"), ("Driko", "Habdri"), ("Roko", "Habrodain"), ("Nudriki", "Habdri"), ("Nuroki", "Habrodain"), ("Q", "Quent")])
    assert {(a, e) for a, e, _, _ in p.ways} == {("", "io"), ("", "ko"), ("nu", "ki")}
    assert p.by_rule("dainko") == {"habrodain"} and p.by_rule("nudainki") == {"habrodain"} and p.by_rule("quenio") == {"quent"} and p.by_rule("zz") == set()


def test_monge_elkan():
    """Rare words weigh more; order counts only for the first given name; what one name lacks weighs little."""
    w = {"jebim": 2.0, "todutram": 2.0, "j.": 1.0}
    same = names.name_similarity("person", "retheshadru", ("jebim",), "rethesadru", ("jebim",), 8.0, w, 9.0)
    assert 0.8 <= same < 1.2 and names.name_similarity("person", "retheshadru", ("jebim",), "retheshadru", ("jebim",), 8.0, w, 9.0) == pytest.approx(1.2)
    swapped = names.name_similarity("person", "retheshadru", ("jebim", "todutram"), "retheshadru", ("todutram", "jebim"), 8.0, w, 9.0)
    assert swapped == pytest.approx(1.2)
    assert names.name_similarity("person", "retheshadru", ("jebim",), "retheshadru", ("todutram", "jebim"), 8.0, w, 9.0) == 0
    assert names.name_similarity("org", "skedra", ("film", "works"), "skedra", ("film", "house")) == 0


def test_core_of_very_many_nodes(spark):
    """One core in blocks gives the links of one core whole."""
    r = [("person\x1fretheshadru\x1f" + g, "person", "retheshadru", [g], 1) for g in ("jebim", "jebim|jeb~", "j.", "habrodain", "todutram", "t.", "x~")]
    nodes = spark.createDataFrame(r, "node string, kind string, core string, givens array<string>, n long")
    whole = rows(names.name_links(nodes))
    assert whole and rows(names.name_links(nodes, core_nodes=2)) == whole


def test_edits():
    assert [names.edits(*x, 3) for x in (("abc", "abc"), ("abc", "acb"), ("abc", "ab"), ("abc", "xyz"), ("", "ab"))] == [0, 1, 1, 3, 2]
    assert names.edits("abcdef", "xyz", 1) == 2


def test_collision_curve():
    b = names.bands_for()
    assert 1 - (1 - names.TARGET_SIMILARITY**names.BAND_ROWS) ** b >= names.TARGET_RECALL


def _typed(rng, w, most):
    """w with up to ``most`` slips, swaps of neighbours often."""
    for _ in range(rng.randint(1, most)):
        i = rng.randrange(max(1, len(w)))
        c = rng.choice("abdefgiklmnoprstuvxyzh")
        w = rng.choice([w[:i] + w[i + 1 : i + 2] + w[i : i + 1] + w[i + 2 :], w[:i] + w[i + 1 : i + 2] + w[i : i + 1] + w[i + 2 :],
                        w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + c + w[i:]])
    return w


def test_rests_meet_all_accepted_pairs():
    """Whatever core_distance accepts has a key in common, at every length."""
    rng, seen = random.Random(3), 0
    for k in range(5000):
        w = "".join(rng.choice("abdefgiklmnoprstuvxyzh") for _ in range(k % 24 + 2))
        v = _typed(rng, w, 3)
        if v and names.core_distance(w, v) < 99:
            seen += 1
            assert names.core_rests(w) & names.core_rests(v), (w, v)
    assert seen > 2000


def test_short_and_twice_edited_cores_meet(spark):
    rng, want = random.Random(4), set()
    for n in (4, 5, 6, 7, 8, 9, 10, 14):
        for _ in range(25):
            w = "".join(rng.choice("bdfgklmnprstv" if i % 2 else "aeiou") for i in range(n))
            i, j = n // 2 - 2, n // 2 + 1
            v = w[:i] + w[i + 1] + w[i] + w[i + 2 :]
            if n >= 7:  # two slips apart
                v = w[:i] + "h" + w[i + 1 : j] + "h" + w[j + 1 :]
            if v != w and names.core_distance(w, v) < 99:
                want.add((min(w, v), max(w, v)))
    cores = spark.createDataFrame([(x,) for x in sorted({x for p in want for x in p})], "core string")
    assert len(want) > 150 and want <= {tuple(r) for r in names.core_links(cores).collect()}


def test_links(spark):
    r = [("a1", "Jebim Retheshadru"), ("a2", "RETHESHADRU Jeb"), ("a3", "Dr. Jebim Rethesadru"), ("a4", "J. Retheshadru"), ("a4", "J. Retheshadru"), ("a5", "ｊebim  Retheshádru"),
         ("b1", "Habrodain Retheshadru"), ("b2", "Retheshadru, Hab"), ("c1", "Skibrim Molotoplan"), ("c2", "Zuribris Molotoplan"), ("c3", "Briko Molotoplan"), ("c4", "Skibrim Molotoplam"),
         ("o1", "Skedrastobe Film Works Ltd"), ("o2", "The Skedrastobe Film Works"), ("o3", "Skedrastobe Film Wroks Limited"), ("o4", "Pluvanimor Film Works Ltd"),
         ("n1", "Guest 12"), ("n2", "Guest 12"), ("n3", None), ("n4", " "), (None, "Jebim Retheshadru"), ("l1", "Todutram " + "y" * 3000)]
    people = spark.createDataFrame([(*x, "z") for x in r], SCHEMA)
    forms = spark.createDataFrame(FORMS + [(None, "X"), ("X", None)], "short_form string, given_name string")
    groups = [["a1", "a2", "a3", "a4", "a5"], ["b1", "b2"], ["c1", "c4"], ["o1", "o2", "o3"]]
    want = sorted((x, y) for g in groups for i, x in enumerate(g) for y in g[i + 1 :])
    assert rows(names.same_name_pairs(people, forms)) == want
    assert names.same_name_pairs(people.limit(0), forms).count() == 0
    # without a list of given names equal names still meet
    few = names.same_name_pairs(people, forms.limit(0)).collect()
    assert ("a1", "a5") in {tuple(x) for x in few}


def test_stars_cover_greedily(spark):
    """b and d are centres; c, similar to both, goes to the more similar one."""
    links = [("a", "b", 0.9), ("b", "c", 0.9), ("c", "d", 0.95), ("d", "e", 0.9)]
    both = spark.createDataFrame([*links, *((b, a, s) for a, b, s in links)], "a string, b string, score double")
    ranks = spark.createDataFrame([("a", 1), ("b", 9), ("c", 2), ("d", 8), ("e", 3), ("f", 4)], "node string, rank long")
    assert rows(names.stars(both, ranks)) == [("a", "b"), ("b", "b"), ("c", "d"), ("d", "d"), ("e", "d"), ("f", "f")]
