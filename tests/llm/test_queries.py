import math

import pytest

from covista.llm import leaks, queries
from covista.sources.tables import table
from tests.test_oracle import _plain

COLUMNS = {"p1_forms": ["person_id", "form"], "p5_overlaps": ["person_id_a", "person_id_b", "shared"], "p7_entities": ["person_id", "entity_id"],
           "p6_together": ["person_id_a", "person_id_b", "shared", "ratio"],
           "p1_found": ["person_id_a", "person_id_b"], "p2_found": ["person_id_a", "person_id_b"], "p5_found": ["person_id_a", "person_id_b"],
           "p6_found": ["person_id_a", "person_id_b"], "p7_found": ["person_id_a", "person_id_b"], "p8_ids": ["doc_id", "ids"],
           "p9_found": ["doc_id", "item_id"], "p10_found": ["doc_id", "subject"]}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, data, name):
    df = queries.queries()[name](spark, data)
    assert df.columns == COLUMNS[name]
    got = [tuple(r) for r in df.collect()]
    if name != "p8_ids":
        assert len(got) == len(set(got))
    if "person_id_a" in df.columns:
        assert all(x[0] < x[1] for x in got)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, data, duck, name):
    assert _plain(queries.queries()[name](spark, data).toPandas()) == _plain(duck.execute(queries.oracle_sql()[name]).df())


def test_likelihood(spark, data, duck):
    """The pairs of p6_together, each with the G² of its 2x2 table."""
    df = queries.queries()["p6_likelihood"](spark, data)
    assert df.columns == [*COLUMNS["p6_together"], "llr"]
    got = {(r.person_id_a, r.person_id_b): r for r in df.collect()}
    sql = queries.oracle_sql()["p6_together"]
    size = dict(duck.execute(sql[: sql.index(", n as")] + " select person_id, count(*) from m group by 1").fetchall())
    n = duck.execute(sql[: sql.index(", n as")] + " select count(distinct image_name) from m").fetchone()[0]
    want = duck.execute(sql).fetchall()
    assert want and len(got) == len(want)
    for a, b, c, ratio in want:
        x, y, r = size[a], size[b], got[a, b]
        cells = ((c, x * y), (x - c, x * (n - y)), (y - c, y * (n - x)), (n - x - y + c, (n - x) * (n - y)))
        assert (r.shared, r.ratio) == (c, pytest.approx(ratio, abs=2e-6))
        assert r.llr == pytest.approx(2 * sum(k * math.log(k * n / e) for k, e in cells if k), rel=1e-6, abs=1e-6)


def test_clean(spark, data):
    """All documents with a leak come out, each without the words of any run of 12 words of an item."""
    all_ = queries.queries()
    assert all_["p9_clean"](spark, data).columns == ["doc_id", "leaked_words", "words", "clean_words", "dropped"]
    got = {r.doc_id: r for r in all_["p9_clean"](spark, data).collect()}
    assert got and got.keys() == {r.doc_id for r in all_["p9_found"](spark, data).collect()}
    runs = {tuple(ws[i : i + 12]) for r in table(spark, data, "eval_items").collect() for ws in [leaks.words(r.item_text)] for i in range(len(ws) - 11)}
    for r in table(spark, data, "documents").where("text is not null").collect():
        if r.doc_id in got:
            ws, g = leaks.words(r.text), got[r.doc_id]
            leaked = {k for i in range(len(ws) - 11) if tuple(ws[i : i + 12]) in runs for k in range(i, i + 12)}
            assert g.clean_words == [w for k, w in enumerate(ws) if k not in leaked]
            assert (g.leaked_words, g.words, g.dropped) == (len(leaked), len(ws), 2 * len(leaked) > len(ws))
