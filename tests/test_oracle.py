"""Every registered query with SQL against DuckDB, on the smallest tables."""

import pytest

from covista.plans import catalogue


def _plain(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted(map(repr, pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_same_rows(spark, data, duck, name):
    got, want = catalogue.QUERIES[name](spark, data).toPandas(), duck.execute(catalogue.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _plain(got) == _plain(want)


def test_no_product_join(spark, data):
    """Sets of entities are found by equi-joins: no cartesian product, no nested loop."""
    plan = catalogue.cooc_k3(spark, data)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
