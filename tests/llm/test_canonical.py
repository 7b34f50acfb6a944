import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from covista.llm import canonical as c
from tests.conftest import rows

SCHEMA = "person_id string, name string, look string"


@pytest.mark.parametrize("a, b", [
    ("Ｅｓｔolol", "Estolol"), ("é", "é"), ("е́", "é"), ("a​́", "á"), ("Ніба", "Hiбa"),
    ("Ⅰⅼ", "Il"), ("ﬁ", "fi"), ("a b", " a b　"), ("x‑y", "x-y"), ("Arϲhiνe", "Archive"), ("S﻿﻿t­", "St")])
def test_same_look(a, b):
    assert c.look(a) == c.look(b)


@pytest.mark.parametrize("a, b", [("e", "é"), ("A", "a"), ("x2", "x²"), ("ab", "a b"), ("Певол", "Pevol"), ("š", "s")])
def test_other_look(a, b):
    assert c.look(a) != c.look(b)


def _whole(text):
    """Brute force: the same steps on the whole text at once, stable characters set apart."""
    out, run = [], ""
    for ch in text:
        if unicodedata.decomposition(ch).startswith(c.VISIBLE_KINDS):
            out += [c._segment(run), ch]
            run = ""
        else:
            run += ch
    return "".join(out) + c._segment(run)


@settings(deadline=None)
@given(st.text(st.sampled_from("aeоеéñк ́̌​ ｅﬁ²가각ᆨⅰ͏Z-\U0001d400"), max_size=12))
def test_segments_equal_whole_text(t):
    # white space of ASCII stays as it is in both
    assert c.canonical(t) == (t if t.isascii() else _whole(t))


@settings(deadline=None)
@given(st.text(max_size=30))
def test_idempotent_and_total(t):
    assert c.look(c.look(t)) == c.look(t)


def test_stable_blocks():
    assert all(c._stable(chr(i)) for a, b in c.STABLE_BLOCKS for i in range(a, b + 1, 97) if not 0xD800 <= i <= 0xDFFF)


def test_pairs(spark):
    r = [("a", "Ann", "z"), ("a", "Ann", "z"), ("b", "Аnn", "z"), ("c", "Ann ", "z"), ("d", "Ann", "z"), ("e", "ann", "z"), ("f", None, "z"),
         ("g", " ", "z"), ("h", " ", "z"), (None, "Ａnn", "z"), ("i", "x" * 50_000, "z"), ("j", "x" * 50_000 + "​", "z")]
    got = rows(c.same_look_pairs(spark.createDataFrame(r, SCHEMA)))
    assert got == [("a", "b"), ("a", "c"), ("b", "c"), ("b", "d"), ("c", "d"), ("i", "j")]
    assert c.same_look_pairs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_column(spark):
    df = spark.createDataFrame([("Ａ  b",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(c.look_of("t")).collect()] == ["A b", None, ""]
    assert [r[0] for r in df.select(c.canonical_of("t")).collect()] == ["A  b", None, ""]


def test_canonically_equivalent_texts_are_equal():
    """Every character of the code space and its decomposition, alone and among others."""
    for cp in range(0xA0, 0x30000):
        x = chr(cp)
        d = unicodedata.normalize("NFD", x)
        if d != x and not 0xD800 <= cp < 0xE000:
            for left, right in (("", ""), ("é", "b")):
                assert len({c.canonical(left + y + right) for y in (x, d, unicodedata.normalize("NFC", x))}) == 1, hex(cp)
    assert c.canonical("ো") == c.canonical("ো") and c.canonical("가" + "ᆨ") == "각"


def test_whole_list(spark):
    t = c.look_alikes(spark)
    assert len(t) > len(c.LOOK_ALIKES) + 100 and all(t[k] == v for k, v in c.LOOK_ALIKES.items())
    assert [t[x] for x in "ꓐᎻⲟᑭ𐐄ᏞӀӏ"] == ["B", "H", "o", "P", "O", "L", "I", "l"]
    assert not {"ノ", "ه", "ס", "б", "З", "م"} & t.keys()
    w = c.whole_list(spark)
    assert w.look("⠀ꓐ" + "Ꮋ´ǃ") == "BH'!" and w.look("Plain é") == "Plain é"


def test_forms_are_made_once(spark, monkeypatch):
    """Python runs in the tasks that write the forms, and nowhere in the plan of the pairs."""
    made = []
    monkeypatch.setattr(c, "materialise", lambda df, name: made.append(df) or df.sparkSession.createDataFrame(df.collect(), df.schema))
    r = [("a", "Ann", "z"), ("b", "Аnn", "z")]
    pairs = c.same_look_pairs(spark.createDataFrame(r, SCHEMA))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert len(made) == 1 and plan(made[0]).count("ArrowEvalPython") == 1 and "ArrowEvalPython" not in plan(pairs)
