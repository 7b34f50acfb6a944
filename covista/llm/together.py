"""Items that appear together, by stripes.

Baskets are turned into stripes, one associative array of neighbours and counts
per item, combined within each map batch; stripes are shuffled by item (and a
block of the neighbours' hash space, so that an item found everywhere is no hot
key) and merged. Chance is judged by lift and Dunning's log-likelihood ratio.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.session import materialise
from covista.sources.tables import memberships

#: A basket with more members is cut into blocks of half this size, and pairs of blocks become work items.
BASKET_LIMIT = 1000
#: Blocks of neighbour hashes per item, so that one item's stripes go to several tasks: at least so many, and as many more
#: (a power of two) as keep a block of an item that stands with all others to about so many neighbours.
NEIGHBOUR_BLOCKS, BLOCK_NEIGHBOURS = 16, 1_000_000
#: Dunning's ratio that a chance of 1 in 200 gives (chi-square of one degree).
SIGNIFICANT = 7.879
#: Pair occurrences combined at once by a map task (bounds its memory).
PAIRS_AT_ONCE = 2_000_000


def _flat(col) -> tuple[np.ndarray, np.ndarray]:
    """Values and row lengths of a list column without nulls."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    off = col.offsets.to_numpy()
    return col.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]], np.diff(off)


def _basket_pairs(v: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (a < b) within each basket; v is sorted within baskets, n are their sizes."""
    end = np.repeat(np.cumsum(n), n)
    after = end - np.arange(len(v)) - 1  # partners behind each member
    left = np.repeat(np.arange(len(v)), after)
    first = np.repeat(np.cumsum(after) - after, after)
    return v[left], v[left + 1 + np.arange(len(left)) - first]


def _block_pairs(u: np.ndarray, nu: np.ndarray, v: np.ndarray, nv: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a member of block u with one of block v, row by row."""
    reps = np.repeat(nv, nu)
    left = np.repeat(u, reps)
    at = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
    right = v[at + np.repeat(np.repeat(np.cumsum(nv) - nv, nu), reps)]
    return np.minimum(left, right), np.maximum(left, right)


def blocks_for(items: int) -> int:
    """Neighbour blocks of an item where there are so many items."""
    return max(NEIGHBOUR_BLOCKS, 2 ** math.ceil(math.log2(max(1, items / BLOCK_NEIGHBOURS))))


def _combine(a: np.ndarray, b: np.ndarray, c: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum c by (a, b), sorted by a, block of b, b."""
    blk = (b & (blocks - 1)).astype(np.int32)
    o = np.lexsort((b, blk, a))
    a, b, c = a[o], b[o], c[o]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    i = np.flatnonzero(new)
    return a[i], b[i], np.add.reduceat(c, i) if len(i) else c


def _as_stripes(a: np.ndarray, b: np.ndarray, c: np.ndarray, blocks: int) -> pa.RecordBatch:
    blk = b & (blocks - 1)
    i = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (blk[1:] != blk[:-1])])
    off = pa.array(np.r_[i, len(a)].astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(a[i]), pa.array(blk[i].astype(np.int32)), pa.ListArray.from_arrays(off, pa.array(b)),
         pa.ListArray.from_arrays(off, pa.array(c))], names=["a", "blk", "nb", "cnt"])


def _stripes(blocks: int):
    def run(batches):
        """Baskets (and pairs of blocks) to combined stripes."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        room = 0

        def flush():
            a, b = (np.concatenate(x) for x in zip(*held))
            return _as_stripes(*_combine(a, b, np.ones(len(a), np.int64), blocks), blocks)

        for batch in batches:
            whole = batch.filter(pc.is_null(batch.column(1)))
            split = batch.filter(pc.is_valid(batch.column(1)))
            if whole.num_rows:
                v, n = _flat(whole.column(0))
                # in slices, so that one batch of large baskets stays bounded
                work = np.cumsum(n.astype(np.int64) * (n - 1) // 2)
                cuts = np.r_[0, np.searchsorted(work, np.arange(PAIRS_AT_ONCE, work[-1], PAIRS_AT_ONCE)) + 1, len(n)]
                ends = np.r_[0, np.cumsum(n)]
                for i, j in zip(cuts[:-1], cuts[1:]):
                    held.append(_basket_pairs(v[ends[i] : ends[j]], n[i:j]))
                    room += len(held[-1][0])
                    if room >= PAIRS_AT_ONCE:
                        yield flush()
                        held, room = [], 0
            for r in range(split.num_rows):
                u, nu = _flat(split.slice(r, 1).column(0))
                v, nv = _flat(split.slice(r, 1).column(1))
                held.append(_block_pairs(u, nu, v, nv))
                room += len(held[-1][0])
                if room >= PAIRS_AT_ONCE:
                    yield flush()
                    held, room = [], 0
        if room:
            yield flush()

    return run


def _merger(least: int, blocks: int):
    def merge(batches):
        """Stripes sorted by (a, blk) to (a, b, c) with c >= least; the open key's stripe is carried on and merged when it has doubled."""
        held: list[tuple] = []
        key, room, merged = None, 0, 0

        def close():
            a, b, c = _combine(*(np.concatenate(x) for x in zip(*held)), blocks)
            keep = c >= least
            return pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep]), pa.array(c[keep])], names=["a", "b", "c"])

        for batch in batches:
            if not batch.num_rows:
                continue
            nb, n = _flat(batch.column(2))
            cnt, _ = _flat(batch.column(3))
            head, blk = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            a = np.repeat(head, n)
            first, last = (head[0], blk[0]), (head[-1], blk[-1])
            if first == last == key:
                held.append((a, nb, cnt))
                room += len(a)
                if room > 2 * merged + PAIRS_AT_ONCE:
                    held = [_combine(*(np.concatenate(x) for x in zip(*held)), blocks)]
                    room = merged = len(held[0][0])
                continue
            # all but the last key of the batch are done
            end = int(n[: np.flatnonzero((head != last[0]) | (blk != last[1]))[-1] + 1].sum()) if first != last else 0
            held.append((a[:end], nb[:end], cnt[:end]))
            yield close()
            held, key, merged = [(a[end:], nb[end:], cnt[end:])], last, 0
            room = len(held[0][0])
        if held:
            yield close()

    return merge


def log_likelihood(c: Column, a: Column, b: Column, n: Column) -> Column:
    """Dunning's G² of a 2x2 table: c baskets with both, a and b with either, n in all."""
    def part(k, e):
        return F.when(k > 0, k * F.log(k / e)).otherwise(F.lit(0.0))

    cells = ((c, a * b / n), (a - c, a * (n - b) / n), (b - c, b * (n - a) / n), (n - a - b + c, (n - a) * (n - b) / n))
    return F.lit(2.0) * sum((part(k.cast("double"), e) for k, e in cells[1:]), part(cells[0][0].cast("double"), cells[0][1]))


def _blocks_of(live: DataFrame, big: DataFrame, basket_limit: int) -> DataFrame:
    """(u, v): the pairs of blocks of members of large baskets (k, sz); v is null for a block with itself."""
    g = F.ceil(F.col("sz") * 2 / basket_limit).cast("int")
    blocked = live.join(big, "k").select("k", "h", g.alias("g"), F.pmod(F.xxhash64("h", F.lit(7)), g).cast("int").alias("x"))
    spread = blocked.select("k", "h", "x", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("y")).select(
        "k", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "h", (F.col("x") > F.col("y")).alias("second"))
    cut = spread.groupBy("k", "i", "j").agg(
        F.sort_array(F.collect_list(F.when(~F.col("second"), F.col("h")))).alias("u"),
        F.sort_array(F.collect_list(F.when(F.col("second"), F.col("h")))).alias("v"))
    return cut.select("u", F.when(F.col("i") < F.col("j"), F.col("v")).alias("v"))


def together(rows: DataFrame, item: str = "person_id", basket: str = "image_name", least: int = 1,
             lift: tuple[int, int] | None = None, basket_limit: int = BASKET_LIMIT, significance: float | None = None) -> DataFrame:
    """(item_a, item_b, shared, size_a, size_b, baskets, ratio, llr) of pairs found together in >= ``least`` baskets.

    ``rows``: (basket, item); rows repeated in full count once, nulls must have been
    dropped. item_a < item_b in binary order; ratio is shared x baskets / (size_a x size_b),
    the times more often than chance; ``lift=(p, q)`` keeps pairs with q x ratio >= p,
    compared in whole numbers; ``significance`` keeps pairs with llr >= it. Exact: items in fewer than ``least`` baskets (or, with a
    lift, in too many to reach it) can be in no pair that is asked for, and only those are
    left out before pairing. A basket beyond ``basket_limit`` is cut into blocks, and each
    pair of blocks is a work item of bounded size. Items are paired by 64-bit hash.
    Empty input gives no row.
    """
    # written once: sizes, the number of baskets and the baskets themselves come of it
    m = materialise(rows.select(F.xxhash64(item).alias("h"), F.xxhash64(basket).alias("k")).distinct(), "together")
    baskets = m.groupBy("k").agg(F.count(F.lit(1)).alias("sz"))
    n, most = baskets.agg(F.count(F.lit(1)), F.coalesce(F.max("sz"), F.lit(0))).first()
    sizes = m.groupBy("h").agg(F.count(F.lit(1)).alias("size"))
    blocks = blocks_for(sizes.count())
    sizes = sizes.withColumn("n", F.lit(n))
    fit = F.col("size") >= least
    if lift:
        fit &= F.col("n").cast("double") * lift[1] >= F.col("size").cast("double") * lift[0] * 0.999999
    live = m.join(sizes.where(fit).select("h"), "h", "left_semi")
    big = baskets.where(F.col("sz") > basket_limit)
    small = live.join(big.select("k"), "k", "left_anti") if most > basket_limit else live
    work = small.groupBy("k").agg(F.sort_array(F.collect_list("h")).alias("u")).where(F.size("u") > 1).select(
        "u", F.lit(None).cast("array<bigint>").alias("v"))
    if most > basket_limit:
        work = work.unionByName(_blocks_of(live, big, basket_limit))
    stripes = work.mapInArrow(_stripes(blocks), "a long, blk int, nb array<long>, cnt array<long>")
    pairs = (
        stripes.repartition("a", "blk").sortWithinPartitions("a", "blk")
        .mapInArrow(_merger(least, blocks), "a long, b long, c long")
    )
    # names come back at the end, where few rows are left
    sizes = rows.select(F.col(item).alias("item")).distinct().withColumn("h", F.xxhash64("item")).join(sizes, "h")
    left = sizes.select(F.col("h").alias("a"), F.col("item").alias("x"), F.col("size").alias("sx"), "n")
    right = sizes.select(F.col("h").alias("b"), F.col("item").alias("y"), F.col("size").alias("sy"))
    found = pairs.join(left, "a").join(right, "b")
    swap = F.col("x") > F.col("y")
    out = found.select(
        F.when(swap, F.col("y")).otherwise(F.col("x")).alias("item_a"),
        F.when(swap, F.col("x")).otherwise(F.col("y")).alias("item_b"), F.col("c").alias("shared"),
        F.when(swap, F.col("sy")).otherwise(F.col("sx")).alias("size_a"),
        F.when(swap, F.col("sx")).otherwise(F.col("sy")).alias("size_b"), F.col("n").alias("baskets"))
    if lift:
        big_int = "decimal(38,0)"
        out = out.where(F.col("shared").cast(big_int) * F.col("baskets") * lift[1]
                        >= F.col("size_a").cast(big_int) * F.col("size_b") * lift[0])
    d = {x: F.col(x).cast("double") for x in ("shared", "size_a", "size_b", "baskets")}
    out = out.withColumn("ratio", d["shared"] * d["baskets"] / (d["size_a"] * d["size_b"])).withColumn(
        "llr", log_likelihood(d["shared"], d["size_a"], d["size_b"], d["baskets"]))
    return out if significance is None else out.where(F.col("llr") >= significance)


def persons_together(pei: DataFrame, least: int, lift: tuple[int, int] | None = None, significance: float | None = None) -> DataFrame:
    """Persons that stand together in images, over the cleaned memberships."""
    return together(memberships(pei), least=least, lift=lift, significance=significance)
