"""All similar pairs between set-valued records, by sorted sketch forests.

Each set gets minhashes, a few for each tree. A tree orders the sets lexicographically by
its own minhashes, packed into one sortable long; sets that stand together with a common
prefix are a neighbourhood. A pair at threshold t has a common prefix of depth d in a tree
with probability t^d, so from the deepest prefix on neighbourhoods are widened until the
trees together meet such a pair with the target recall, and no further: the depth follows
from the curve. No two trees share a minhash, so the curve holds.

A neighbourhood too wide to compare all its sets is settled exactly: the sets of wide
neighbourhoods are joined by their rarest members, of which two similar sets always have
one in common. No pair depends on a width. What is compared is verified exactly.

Sets equal in full are one class: the forest sees one representative of each.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covista.session import materialise
from covista.sources.tables import memberships

#: Trees of a forest (more only where even a prefix of one asks for them) and minhashes that a tree sorts by (16 bits each of its key).
TREES, DEPTH = 32, 4
#: Least share of the pairs at the threshold that must be compared; pairs above it fare better.
TARGET_RECALL = 0.9995
#: The sets of a neighbourhood with more sets than this are joined by their rarest members instead.
NEIGHBOURHOOD = 200
#: A set with more rows is kept in chunks of its hash space of about this size; of all sets no more than so many can
#: be larger than a chunk, for the chunk grows with the table: their list is broadcast.
CHUNK_ROWS, MOST_LARGE = 8192, 200_000
#: Minhashes held at once by a sketching task.
MINHASHES_AT_ONCE = 1_000_000

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def trees_for(depth: int, threshold: float, recall: float = TARGET_RECALL) -> int:
    """Trees whose prefixes of this depth meet a pair at the threshold with the given recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth))


def forest(threshold: float, recall: float = TARGET_RECALL) -> tuple[int, int]:
    """(trees, depth): the deepest common prefix at which the trees meet a pair at the threshold with the recall."""
    for depth in range(DEPTH, 0, -1):
        if (trees := trees_for(depth, threshold, recall)) <= TREES or depth == 1:
            return trees, depth


def _seeds(k: int) -> np.ndarray:
    return np.random.default_rng(96).integers(0, 2**63, k, dtype=np.uint64)


def _sketcher(k: int):
    def run(batches):
        seeds, rows = _seeds(k), max(1, MINHASHES_AT_ONCE // k)
        for b in batches:
            for lo in range(0, b.num_rows, rows):
                yield _sketch(b.slice(lo, rows), seeds)

    return run


def _sketch(b: pa.RecordBatch, seeds: np.ndarray) -> pa.RecordBatch:
    """Rows (person, chunks, chunk, hashes) to distinct sorted hashes, size, fingerprint and minhashes of the chunk."""
    col = b.column(3)
    off = col.offsets.to_numpy()
    v = col.values.to_numpy()[off[0] : off[-1]]
    row = np.repeat(np.arange(b.num_rows), np.diff(off))
    o = np.lexsort((v, row))
    v, row = v[o], row[o]
    keep = np.r_[True, (v[1:] != v[:-1]) | (row[1:] != row[:-1])]
    v, row = v[keep], row[keep]
    n = np.bincount(row, minlength=b.num_rows)
    starts = np.cumsum(n) - n
    u = v.view(np.uint64)
    sig = np.empty((b.num_rows, len(seeds)), np.int32)
    for i, s in enumerate(seeds):
        x = (u ^ s) * _MIX1
        x ^= x >> np.uint64(29)
        x *= _MIX2
        sig[:, i] = np.minimum.reduceat(x, starts) >> np.uint64(33)  # leading bits: the least of the chunks' is the set's
    f1 = np.bitwise_xor.reduceat((u * _MIX1) ^ (u >> np.uint64(31)), starts).view(np.int64)
    f2 = np.bitwise_xor.reduceat((u ^ (u >> np.uint64(33))) * _MIX2, starts).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [b.column(0), b.column(1), b.column(2), pa.array(n.astype(np.int64)), pa.array(f1), pa.array(f2),
         pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, len(seeds), dtype=np.int32)), pa.array(sig.ravel())),
         pa.ListArray.from_arrays(pa.array(np.r_[starts, len(v)].astype(np.int32)), pa.array(v))],
        names=["id", "chunks", "chunk", "n", "f1", "f2", "sig", "hashes"])


def _chunked_sets(rows: DataFrame, chunk_rows: int, k: int) -> DataFrame:
    """(id, chunks, chunk, n, f1, f2, sig, hashes), one row a set, or one a chunk of the hash space for large sets.

    chunks is a power of two and the chunk of a member its low hash bits, so the chunks of
    two sets are nested, and every group that a task collects is bounded. Copies of a row
    fall together map-side first. No set is ever hashed to one task by its id alone.
    """
    h = rows.select("id", F.xxhash64("item").alias("h")).distinct()
    size = max(chunk_rows, -(-rows.count() // MOST_LARGE))
    large = h.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > size)
    large = large.select("id", F.expr(f"shiftleft(1, cast(ceil(log2(c / {size})) as int))").alias("chunks"))
    keyed = h.join(F.broadcast(large), "id", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    keyed = keyed.withColumn("chunk", F.expr("cast(h & (chunks - 1) as int)"))
    # the partial step ships raw hashes: for most sets they are smaller than a sketch
    groups = keyed.groupBy("id", "chunks", "chunk").agg(F.collect_list("h").alias("hs"))
    kind = rows.schema["id"].dataType.simpleString()
    return groups.mapInArrow(
        _sketcher(k), f"id {kind}, chunks int, chunk int, n long, f1 long, f2 long, sig array<int>, hashes array<long>")


def _sets(parts: DataFrame) -> DataFrame:
    """One row a set: id, chunks, n, f1, f2, sig. Chunks of large sets are merged (minimum, sum, xor)."""
    one = parts.where("chunks = 1").select("id", "chunks", "n", "f1", "f2", "sig")
    many = parts.where("chunks > 1")
    base = many.groupBy("id", "chunks").agg(F.sum("n").alias("n"), F.bit_xor("f1").alias("f1"), F.bit_xor("f2").alias("f2"))
    mins = many.select("id", F.posexplode("sig").alias("i", "v")).groupBy("id", "i").agg(F.min("v").alias("v"))
    sig = mins.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("s"))
    return one.unionByName(base.join(sig.select("id", F.col("s.v").alias("sig")), "id"))


def _sorted_trees(sets: DataFrame, trees: int) -> DataFrame:
    """(tree, key, n, id, chunks) in the order of each tree. Equal keys are ordered by id, so a prefix that very many sets share is spread over partitions."""
    def key(t):
        parts = [F.shiftleft(F.element_at("sig", t * DEPTH + 1 + j).bitwiseAND(0xFFFF).cast("long"), 16 * (DEPTH - 1 - j)) for j in range(DEPTH)]
        return reduce(lambda x, y: x.bitwiseOR(y), parts)

    keys = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), key)
    rows = sets.select("n", "id", "chunks", F.posexplode(keys).alias("tree", "key"))
    return rows.repartitionByRange("tree", "key", "id").sortWithinPartitions("tree", "key", "id").select("tree", "key", "n", "id", "chunks")


#: What a row of ``_neighbourhoods`` is: a whole neighbourhood, part of one at the edge of a partition, or part of a wide one.
WHOLE, EDGE, WIDE = 0, 1, 2


def _neighbours(depth: int, width: int):
    """Rows of sorted trees to runs of a common prefix: (prefix, state, members); no more than ``width`` rows and a batch are held."""

    def out(b: pa.RecordBatch, starts: np.ndarray, state: np.ndarray, prefix: np.ndarray) -> pa.RecordBatch:
        """The runs of b that begin at ``starts``; single sets are left out but at an edge."""
        size = np.diff(np.r_[starts, b.num_rows])
        keep = (size > 1) | (state != WHOLE)
        rows = b.filter(pa.array(np.repeat(keep, size)))
        offsets = pa.array(np.r_[0, np.cumsum(size[keep])].astype(np.int32))
        members = pa.StructArray.from_arrays([rows.column(2), rows.column(3), rows.column(4)], names=["n", "id", "chunks"])
        return pa.RecordBatch.from_arrays(
            [pa.array(prefix[starts[keep]]), pa.array(state[keep].astype(np.int32)), pa.ListArray.from_arrays(offsets, members)],
            names=["prefix", "state", "m"])

    def run(batches):
        held, wide, edge = None, None, True  # the open run's rows; its prefix if it is known to be wide; nothing closed yet
        for b in batches:
            if not b.num_rows:
                continue
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            tree = b.column(0).to_numpy().astype(np.uint64)
            lead = b.column(1).to_numpy().view(np.uint64) >> np.uint64(16 * (DEPTH - depth))
            prefix = ((lead * _MIX1) ^ (tree * _MIX2)).view(np.int64)
            starts = np.flatnonzero(np.r_[True, (lead[1:] != lead[:-1]) | (tree[1:] != tree[:-1])])
            size = np.diff(np.r_[starts, b.num_rows])
            state = np.where(size > width, WIDE, WHOLE)
            if prefix[0] == wide:
                state[0] = WIDE
            elif edge and state[0] == WHOLE:
                state[0] = EDGE
            n = len(starts)
            if state[-1] == WIDE:
                wide, held = prefix[-1], None
            else:
                wide, held, n = None, b.slice(starts[-1]), n - 1
            edge = edge and n == 0
            if n:
                yield out(b.slice(0, b.num_rows if held is None else starts[-1]), starts[:n], state[:n], prefix)
        if held is not None:
            lead = np.uint64(held.column(1)[0].as_py() % 2**64) >> np.uint64(16 * (DEPTH - depth))
            with np.errstate(over="ignore"):
                prefix = (lead * _MIX1) ^ (np.uint64(held.column(0)[0].as_py()) * _MIX2)
            yield out(held, np.zeros(1, np.int64), np.full(1, EDGE), np.array([prefix]).view(np.int64))

    return run


def _neighbourhoods(ordered: DataFrame, depth: int, width: int) -> tuple[DataFrame, DataFrame]:
    """(m, sets of each neighbourhood of 2 to ``width``) and (id, of the sets of wider ones)."""
    member = f"struct<n:long,id:{ordered.schema['id'].dataType.simpleString()},chunks:int>"
    runs = materialise(ordered.mapInArrow(_neighbours(depth, width), f"prefix long, state int, m array<{member}>"), "neighbourhoods")
    # parts of one neighbourhood on both sides of an edge are put together: a partition has two edges, each of no more than ``width`` sets
    edges = runs.where(F.col("state") != WHOLE).groupBy("prefix").agg(
        F.max("state").alias("state"), F.flatten(F.collect_list(F.when(F.col("state") == EDGE, F.col("m")))).alias("m"))
    wide = (F.col("state") == WIDE) | (F.size("m") > width)
    fit = runs.where(F.col("state") == WHOLE).select("m").unionByName(edges.where(~wide & (F.size("m") > 1)).select("m"))
    ids = runs.where(F.col("state") == WIDE).select("m").unionByName(edges.where(wide).select("m"))
    return fit, ids.select(F.explode("m.id").alias("id")).distinct()


def _pair_up(groups: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs within each neighbourhood whose sizes allow the threshold; a is the smaller set (ties by id)."""
    g = groups.select(F.sort_array("m").alias("m"))
    left = g.select("m", F.posexplode("m").alias("i", "x"))
    pairs = left.select("x", F.explode(F.slice("m", F.col("i") + 2, F.greatest(F.size("m") - F.col("i") - 1, F.lit(0)))).alias("y"))
    return pairs.where(F.col("x.n") * den >= F.col("y.n") * num).select("x", "y")


def _by_rarest(members: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (x, y) of sets that have one of their rarest members in common; members: id, n, chunks, h.

    Of the members of x in one order, two sets with Jaccard >= t have one in common among
    the first n - ceil(t n) + 1 of either. The order is by the number of sets that hold a
    member, and whatever ties with the last one counts too. Members of one set meet nobody.
    """
    often = members.groupBy("h").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    live = members.join(often, "h")
    # how many members of each frequency a set has: few rows a set, whatever its size
    kinds = live.groupBy("id", "f").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"))
    so_far = F.sum("c").over(Window.partitionBy("id").orderBy("f"))
    all_ = F.sum("c").over(Window.partitionBy("id"))
    need = F.col("n") - F.ceil(F.col("n") * num / den) + 1 - (F.col("n") - F.col("all"))  # members of one set come first of all
    cut = kinds.select("id", "f", "n", so_far.alias("so_far"), all_.alias("all")).where((F.col("so_far") >= need) & (need > 0)).groupBy("id").agg(
        F.min("f").alias("cut"))
    first = live.join(cut, "id").where("f <= cut").select("h", F.struct("n", "id", "chunks").alias("x"))
    return first.alias("l").join(first.select("h", F.col("x").alias("y")).alias("r"), "h").where(
        (F.col("x") < F.col("y")) & (F.col("x.n") * den >= F.col("y.n") * num)).select("x", "y")


def similar_sets(rows: DataFrame, num: int = 3, den: int = 5, least: int = 1, neighbourhood: int = NEIGHBOURHOOD,
                 chunk_rows: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """(links, classes) of the sets of ``rows`` (id, item) with at least ``least`` items and Jaccard >= num/den.

    classes: (id, rep, n), every such set and the representative (least id) of the sets
    equal to it. links: (a, b, shared, n_a, n_b) between representatives, each pair once.
    Rows repeated in full count once; rows with nulls must have been dropped; items are
    compared by 64-bit hash. To compare records of two tables, give both with distinct ids.
    """
    trees, depth = forest(num / den)
    parts = materialise(_chunked_sets(rows, chunk_rows, trees * DEPTH), "set-parts")
    sets = materialise(_sets(parts).where(F.col("n") >= least), "sets")
    rep_of = sets.groupBy("n", "f1", "f2").agg(F.min("id").alias("rep"))
    classes = sets.select("id", "n", "f1", "f2").join(rep_of, ["n", "f1", "f2"]).select("id", "rep", "n")
    reps = sets.join(rep_of.select(F.col("rep").alias("id")), "id", "left_semi")

    fit, wide = _neighbourhoods(_sorted_trees(reps, trees), depth, neighbourhood)
    found = _pair_up(fit, num, den)
    if not wide.isEmpty():
        members = parts.select("id", F.explode("hashes").alias("h")).join(sets.join(wide, "id", "left_semi").select("id", "n", "chunks"), "id")
        found = found.unionByName(_by_rarest(members, num, den))

    cand = found.groupBy("x", "y").agg(F.lit(1)).select(
        F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.n").alias("n_a"), F.col("y.n").alias("n_b"),
        F.least("x.chunks", "y.chunks").alias("common"))
    body = parts.select("id", "chunk", "hashes")
    one = cand.join(body.select(F.col("id").alias("a"), F.col("chunk").alias("ca"), F.col("hashes").alias("ha")), "a")
    two = one.join(
        body.select(F.col("id").alias("b"), F.col("chunk").alias("cb"), F.col("hashes").alias("hb")), "b"
    ).where(F.expr("(ca & (common - 1)) = (cb & (common - 1))"))
    # chunks are nested and distinct, so the shares of the chunks add up
    links = (
        two.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("ha", "hb")).cast("long").alias("s"))
        .groupBy("a", "b", "n_a", "n_b").agg(F.sum("s").alias("shared"))
        .where(F.col("shared") * den >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * num)
    )
    return links, classes


def expand_pairs(links: DataFrame, classes: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every pair of different ids whose classes are linked or one."""
    c = classes.select("id", "rep")
    linked = links.select("a", "b").unionByName(c.groupBy(F.col("rep").alias("a")).agg(F.count(F.lit(1)).alias("k"))
                                                .where("k > 1").select("a", F.col("a").alias("b")))
    x = linked.join(c.select(F.col("rep").alias("a"), F.col("id").alias("x")), "a")
    xy = x.join(c.select(F.col("rep").alias("b"), F.col("id").alias("y")), "b")
    once = xy.where((F.col("a") != F.col("b")) | (F.col("x") < F.col("y")))
    return once.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def similar_persons(pei: DataFrame) -> DataFrame:
    """(person_id_a, person_id_b) with >= 5 images each that share at least 3/5 of their joint images."""
    rows = memberships(pei).select(F.col("person_id").alias("id"), F.col("image_name").alias("item"))
    links, classes = similar_sets(rows, 3, 5, least=5)
    return expand_pairs(links, classes).select(F.col("id_a").alias("person_id_a"), F.col("id_b").alias("person_id_b"))
