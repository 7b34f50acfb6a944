"""Snapshot changes and heavy keys: brute force on the test tables, and edge cases."""

import datetime as dt
import re

from covista.operators import heavykeys, snapshots
from covista.sources.tables import table
from tests.conftest import rows

SCHEMA = ("snapshot_no int, snapshot_date string, shard_no int, delivered_at timestamp, version int, "
          "entries map<string, struct<fingerprint: string, lastmod: string>>, _h string")


def T(h):
    return dt.datetime(2031, 1, 5, h)


def _brute(recs):
    """Plain Python: held shards, migrated, dated, diffed."""
    held = {}
    for r in recs:
        k = (r["snapshot_no"], r["shard_no"])
        if k not in held or r["delivered_at"] > held[k]["delivered_at"]:
            held[k] = r
    snaps = {}
    for r in held.values():
        one = snaps.setdefault(r["snapshot_no"], {})
        for key, v in r["entries"].items() if isinstance(r["entries"], dict) else r["entries"]:
            fp, lm = v["fingerprint"], (v["lastmod"] or "").strip()
            if r["version"] == 1:
                p = re.sub(r"^https?://[^/]*", "", key) or "/"
                p = p if p.endswith("/") else p + "/"
                if p.startswith("/search/people/") and len(p) > 15:
                    key, fp = p[15:-1], fp.rsplit("|", 1)[-1]
                else:
                    key = p
            one[key] = (fp, lm[:10])
    out, nos = [], sorted(snaps)
    for a, b in zip(nos, nos[1:]):
        for k in snaps[a].keys() | snaps[b].keys():
            x, y = snaps[a].get(k), snaps[b].get(k)
            if x != y:
                out.append((b, k, "added" if x is None else "removed" if y is None else "changed"))
    return sorted(out, key=repr)


def test_tables_against_brute_force(spark, data):
    import pyarrow.parquet as pq

    recs = pq.read_table(f"{data}/sitemap_lastmod_state.parquet").to_pylist()
    assert rows(snapshots.snapshot_changes(table(spark, data, "sitemap_lastmod_state"))) == _brute(recs)


def test_edges(spark):
    e = lambda **kw: {k: {"fingerprint": f, "lastmod": m} for k, (f, m) in kw.items()}
    r = [
        (1, None, 0, T(1), 2, e(a=("1", None), b=("1", "2031-01-01"), c=("1", "x")), "z"),
        (1, None, None, T(1), None, e(n=("1", "")), "z"),
        (1, None, 1, None, 2, e(f=("1", "")), "z"), (1, None, 1, T(0), 2, None, "z"),  # the later delivery is empty
        (3, None, 5, T(2), 2, e(a=("1", " "), b=("1", "2031-01-01T10:00:00Z"), d=(None, None)), "z"),
        (3, None, 5, T(2), 2, e(a=("1", " "), b=("1", "2031-01-01T10:00:00Z"), d=(None, None)), "z"),  # repeated in full
        (4, None, 0, T(3), 1, {"https://h/search/people/b": {"fingerprint": "x|1", "lastmod": "2031-01-01 07:00"},
                               "https://h/search/people/d/": {"fingerprint": None, "lastmod": ""}}, "z"),
        (None, None, 0, T(9), 2, e(q=("1", "")), "z"),
    ]
    df = spark.createDataFrame(r, SCHEMA)
    assert rows(snapshots.snapshot_changes(df)) == [(3, "c", "removed"), (3, "d", "added"), (3, "n", "removed"), (4, "a", "removed")]
    assert snapshots.snapshot_changes(df.limit(0)).count() == 0
    assert snapshots.snapshot_changes(df.where("snapshot_no = 1")).count() == 0


def test_keys_are_aggregated_not_joined(spark, data):
    """The entries meet in one aggregation: above the explode there is no sort-merge join."""
    df = snapshots.snapshot_changes(table(spark, data, "sitemap_lastmod_state"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Generate explode(knownnotcontainsnull")]
    assert "Join" not in above and above.count("Exchange hashpartitioning") == 1


def test_heavy_keys(spark):
    df = spark.createDataFrame([("a", "1")] * 3 + [("a", " 1 "), ("b", None), (None, "9")] + [("c", "2"), ("c", "1")] + [("d", " ")] * 92, "person_id string, image_name string")
    assert rows(heavykeys.heavy_keys(df, "person_id", 3, 100)) == [("a", 4, 100), ("d", 92, 100)]
    assert rows(heavykeys.key_profile(df)) == [("a", 4, 1, "1"), ("b", 1, 0, None), ("c", 2, 2, "1"), ("d", 92, 0, None)]
    assert heavykeys.heavy_keys(df.limit(0), "person_id").count() == 0 and heavykeys.key_profile(df.limit(0)).count() == 0
    assert rows(heavykeys.image_counts(df)) == [("a", 1), ("c", 2)]
