"""Similar sets, overlaps and co-occurrence against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from covista.llm import overlap, setpairs, together
from tests.conftest import rows

SCHEMA = "person_id string, image_name string, batch_no int"


def make(seed, people=60, items=80):
    """Memberships with near copies, exact copies, one huge set and one item in every set."""
    rng = random.Random(seed)
    sets = {f"p{i}": set(rng.sample(range(items), rng.randint(1, 12))) for i in range(people)}
    for i in range(0, people, 3):
        s = set(sets[f"p{i}"])
        sets[f"q{i}"] = set(s)
        s.discard(next(iter(s)))
        s.add(rng.randrange(items))
        sets[f"r{i}"] = s
    sets["huge"] = set(range(items))
    sets["huge2"] = set(range(2, items))
    for s in sets.values():
        s.add(items)
    return sets


def frame(spark, sets):
    r = [(p, f" i{x:03d}" + "\t" * (x % 2), 1) for p, s in sets.items() for x in sorted(s)]
    return spark.createDataFrame(r + r[::5] + [(None, "i001", 1), ("p0", None, 1), ("p0", " ", 1)], SCHEMA)


def close(sets, num, den, least):
    out = []
    for a, b in itertools.combinations(sorted(sets), 2):
        c = len(sets[a] & sets[b])
        if min(len(sets[a]), len(sets[b])) >= least and c * den >= num * (len(sets[a]) + len(sets[b]) - c):
            out.append((a, b))
    return out


@pytest.mark.parametrize("hood, chunk", [(200, 8192), (3, 4)])
def test_similar_sets(spark, hood, chunk):
    """Also with neighbourhoods that must be deepened and sets kept in chunks."""
    sets = make(1)
    m = frame(spark, sets).where("person_id is not null and trim(image_name) <> ''").select(
        F.col("person_id").alias("id"), F.trim(F.translate("image_name", "\t", "")).alias("item"))
    links, classes = setpairs.similar_sets(m, 3, 5, least=5, neighbourhood=hood, chunk_rows=chunk)
    assert rows(setpairs.expand_pairs(links, classes)) == close(sets, 3, 5, 5)
    cl = {r.id: (r.rep, r.n) for r in classes.collect()}
    assert cl.keys() == {p for p, s in sets.items() if len(s) >= 5}
    assert all(sets[p] == sets[rep] and n == len(sets[p]) for p, (rep, n) in cl.items())


def test_similar_persons(spark):
    sets = make(2)
    assert rows(setpairs.similar_persons(frame(spark, sets))) == close(sets, 3, 5, 5)
    assert setpairs.similar_persons(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_curve():
    """The deepest prefix that the trees allow is taken, and misses of a pair at the threshold stay within the target."""
    assert setpairs.forest(0.6) == (32, 3)
    for t in (0.05, 0.3, 0.5, 0.6, 0.8, 0.95):
        trees, depth = setpairs.forest(t)
        assert (1 - t**depth) ** trees <= 1 - setpairs.TARGET_RECALL
        assert depth == setpairs.DEPTH or setpairs.trees_for(depth + 1, t) > setpairs.TREES
    rng = np.random.default_rng(1)
    same = rng.random((200_000, 32, 3), dtype=np.float32) < 0.6
    assert (~same.all(axis=2).any(axis=1)).mean() <= 0.0006


def test_neighbourhoods_are_runs_of_a_prefix(spark):
    """Across batches and partitions, those wider than the limit apart; brute force groups by prefix."""
    rng = random.Random(6)
    for width, parts in ((3, 1), (3, 5), (50, 4)):
        r = sorted({(t, sum(rng.randrange(3) << (48 - 16 * j) for j in range(4)), 7, f"s{i}", 1) for t in range(3) for i in range(60)})
        df = spark.createDataFrame(r, "tree int, key long, n long, id string, chunks int").repartitionByRange(parts, "tree", "key", "id").sortWithinPartitions("tree", "key", "id")
        groups = {}
        for t, k, _, i, _ in r:
            groups.setdefault((t, k >> 16), []).append(i)
        fit, wide = setpairs._neighbourhoods(df, 3, width)
        assert sorted(sorted(x["id"] for x in g.m) for g in fit.collect()) == sorted(sorted(g) for g in groups.values() if 1 < len(g) <= width)
        assert {x.id for x in wide.collect()} == {i for g in groups.values() if len(g) > width for i in g}


def test_recall_of_deepened_pairs(spark):
    """Pairs at a Jaccard of exactly 3/5, each neighbourhood taken as wide."""
    n = 3000
    r = spark.range(n * 10).selectExpr("id div 10 p", "id % 10 i")
    ids = r.where("i < 8").selectExpr("concat('a', p) id", "concat(p, '-', i) item").unionByName(
        r.where("i > 1").selectExpr("concat('b', p) id", "concat(p, '-', i) item"))
    links, _ = setpairs.similar_sets(ids, 3, 5, neighbourhood=1)
    got = {(x.a, x.b) for x in links.select("a", "b").collect()}
    assert all(a[0] != b[0] and a[1:] == b[1:] for a, b in got)
    assert len(got) >= n - 5


def test_wide_neighbourhoods_are_exact(spark):
    """600 sets that share most of their members stand in neighbourhoods far beyond 200: no pair is lost."""
    rng, sets = random.Random(8), {}
    for i in range(600):
        sets[f"p{i:03d}"] = set(range(20)) | {1000 + rng.randrange(60) for _ in range(rng.randint(6, 14))}
    r = [(p, f"i{x}") for p, s in sets.items() for x in s]
    links, classes = setpairs.similar_sets(spark.createDataFrame(r, "id string, item string"), 3, 5)
    assert rows(setpairs.expand_pairs(links, classes)) == close(sets, 3, 5, 1)


@pytest.mark.parametrize("bits", [6, 64])
def test_trie(bits):
    rng = np.random.default_rng(bits)
    for _ in range(30):
        n = rng.integers(0, 200)
        h = rng.integers(0, 2**min(bits, 63), n, dtype=np.uint64)
        s = rng.integers(0, 8, n)
        sets = {k: set(h[s == k].tolist()) for k in set(s.tolist())}
        want = {(a, b): len(sets[a] & sets[b]) for a in sets for b in sets if a <= b and sets[a] & sets[b]}
        a, b, c = overlap.trie_overlaps(h, s, bits)
        assert dict(zip(zip(a.tolist(), b.tolist()), c.tolist())) == want


def test_trie_skips_leaves_of_complete_subtrees():
    """Two equal sets are counted at the root: the result is there though leaves would need all levels."""
    h = np.repeat(np.arange(5000, dtype=np.uint64), 2)
    a, b, c = overlap.trie_overlaps(h, np.tile([0, 1], 5000), 64)
    assert dict(zip(zip(a.tolist(), b.tolist()), c.tolist())) == {(0, 0): 5000, (1, 1): 5000, (0, 1): 5000}


def test_overlaps(spark, monkeypatch):
    monkeypatch.setattr(overlap, "ROWS_PER_RANGE", 40)
    sets = make(3)
    listed = [p for p in sorted(sets) if p[0] != "q"]
    lst = spark.createDataFrame([(p,) for p in listed] + [(None,), ("p0",), ("nobody",)], "person_id string")
    o = overlap.person_overlaps(frame(spark, sets), lst)
    want = [(a, b, len(sets[a] & sets[b]), len(sets[a]), len(sets[b])) for a, b in itertools.combinations(listed, 2) if sets[a] & sets[b]]
    assert rows(o) == want
    assert rows(overlap.near_sets(o)) == sorted((a, b) for a, b, c, x, y in want if 5 * c >= 2 * min(x, y))
    assert overlap.person_overlaps(spark.createDataFrame([], SCHEMA), lst).count() == 0
    assert overlap.person_overlaps(frame(spark, sets), lst.limit(0)).count() == 0


def test_an_item_of_very_many_sets(spark, monkeypatch):
    """One item in all of 3000 sets: its pairs are counted in blocks, in slices where a node holds many, and none is lost."""
    n = 3000
    r = spark.range(n).selectExpr("concat('s', id) person_id", "'all' image_name").unionByName(
        spark.range(n).selectExpr("concat('s', id) person_id", "concat('own', id div 2) image_name"))
    o = overlap.set_overlaps(r, r.select("person_id"), item_sets=400)
    got = o.groupBy("shared").count().collect()
    assert {x.shared: x["count"] for x in got} == {1: n * (n - 1) // 2 - n // 2, 2: n // 2}
    assert o.where("size_a <> 2 or size_b <> 2 or set_a >= set_b").isEmpty()
    monkeypatch.setattr(overlap, "PAIRS_AT_ONCE", 1000)
    monkeypatch.setattr(overlap, "PAIRS_HELD", 3000)
    a, b, c = overlap.trie_overlaps(np.repeat(np.arange(3, dtype=np.uint64), 300), np.tile(np.arange(300), 3), 64)
    assert len(a) == 300 * 301 // 2 and set(c.tolist()) == {3}


def test_neighbour_blocks():
    assert [together.blocks_for(n) for n in (0, 10, 16_000_000, 16_000_001, 10**9)] == [16, 16, 16, 32, 1024]


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_merger(size):
    """Stripes of one key over any number of batches."""
    import pyarrow as pa

    rng = random.Random(size)
    pairs = sorted((rng.randrange(4), rng.randrange(40)) for _ in range(500))
    stripes = sorted(((a, b & 15, [b], [1]) for a, b in pairs), key=lambda x: x[:2])
    cols = [pa.array([x[i] for x in stripes], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())))]
    batches = pa.Table.from_arrays(cols, names=["a", "blk", "nb", "cnt"]).to_batches(max_chunksize=size)
    got = {(a, b): c for x in together._merger(2, 16)(iter(batches)) for a, b, c in zip(*(x.column(i).to_pylist() for i in range(3)))}
    assert got == {p: pairs.count(p) for p in set(pairs) if pairs.count(p) >= 2}


@pytest.mark.parametrize("limit", [1000, 8])
def test_together(spark, limit):
    """Also with baskets that are cut into blocks."""
    sets = make(4)
    m = frame(spark, sets).where("person_id is not null and trim(image_name) <> ''").select(
        "person_id", F.trim(F.translate("image_name", "\t", "")).alias("image_name"))
    n = len(set().union(*sets.values()))
    for least, lift in ((1, None), (5, (3, 2))):
        want = []
        for a, b in itertools.combinations(sorted(sets), 2):
            c = len(sets[a] & sets[b])
            if c >= least and (not lift or c * n * lift[1] >= lift[0] * len(sets[a]) * len(sets[b])):
                want.append((a, b, c, len(sets[a]), len(sets[b]), n))
        got = together.together(m, least=least, lift=lift, basket_limit=limit)
        assert rows(got.select("item_a", "item_b", "shared", "size_a", "size_b", "baskets")) == sorted(want, key=repr)
        assert got.where("llr < -1e-6 or ratio <= 0").count() == 0
    assert together.persons_together(spark.createDataFrame([], SCHEMA), least=2).count() == 0


def test_log_likelihood(spark):
    r = spark.range(1).select(*(together.log_likelihood(*(F.lit(float(x)) for x in v)).alias(f"l{i}") for i, v in enumerate(
        [(10, 20, 50, 100), (20, 20, 20, 100), (0, 10, 10, 100)]))).first()
    assert abs(r.l0) < 1e-9 and r.l1 > 90 and r.l2 > 1
