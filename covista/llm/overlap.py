"""Overlap sizes of many large sets, without building an intersection.

Members are hashed to 64 bits; the hash space is cut into ranges by its leading
bits, and each range is one subtree of a binary prefix trie over all sets. Within
a range the tries of all sets are descended together, some bits at a time: a node
that fewer than two sets reach is skipped (empty branch), and a set that holds
every value still alive in a node is *complete* there, so its overlap with every
other set is that set's subtree count and its leaves are never visited.

An item of very many sets has no subtree to share: its pairs are counted in blocks of
sets, each pair of blocks a work item of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.session import materialise
from covista.sources.tables import memberships

#: A range holds about so many rows; ranges are what tasks work on.
ROWS_PER_RANGE = 200_000
#: Up to so many sets the list of sets is broadcast.
BROADCAST_SETS = 200_000
#: An item in more of the listed sets is left to blocks of about half so many sets.
ITEM_SETS = 2000
#: Pairs listed at once by a descending task, and distinct ones held before they are counted together.
PAIRS_AT_ONCE, PAIRS_HELD = 2_000_000, 4_000_000
_STEP = 4


def _cross(node: np.ndarray, comp: np.ndarray, count: np.ndarray, who: np.ndarray):
    """For node-sorted rows: every (complete row, other row) of the same node, each unordered pair once; in slices of bounded size."""
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    size = np.diff(np.r_[starts, len(node)])
    start_of, size_of = np.repeat(starts, size), np.repeat(size, size)
    every = np.flatnonzero(comp)
    work = np.cumsum(size_of[every])
    cuts = np.unique(np.r_[0, np.searchsorted(work, np.arange(PAIRS_AT_ONCE, work[-1], PAIRS_AT_ONCE)), len(every)])
    for i, j in zip(cuts[:-1], cuts[1:]):
        c = every[i:j]
        reps = size_of[c]
        left = np.repeat(c, reps)
        right = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(start_of[c], reps)
        keep = (left != right) & (~comp[right] | (left < right))
        left, right = left[keep], right[keep]
        a, b = who[left], who[right]
        yield np.minimum(a, b), np.maximum(a, b), count[right]


class _Counts:
    """Counts of pairs of set numbers below ``base``; repeated pairs are added up now and then, so what is held is bounded by the pairs there are."""

    def __init__(self, base: int):
        self.base, self.held, self.room = base, [], 0

    def add(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> None:
        self.held.append((a.astype(np.int64) * self.base + b, c))
        self.room += len(a)
        if self.room > PAIRS_HELD:
            self.held = [self._total()]
            self.room = len(self.held[0][0]) // 2  # half: what is distinct already is not to be sorted with every slice

    def _total(self) -> tuple[np.ndarray, np.ndarray]:
        keys, inv = np.unique(np.concatenate([k for k, _ in self.held]), return_inverse=True)
        return keys, np.bincount(inv, weights=np.concatenate([c for _, c in self.held])).astype(np.int64)

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys, total = self._total()
        return keys // self.base, keys % self.base, total


def trie_overlaps(h: np.ndarray, s: np.ndarray, top: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, shared) of all sets with members in this range; a = b gives a set's own size.

    h: member hashes (unsigned), s: set numbers; repeated (member, set) rows count once.
    top: how many low bits of h differ within the range.
    """
    names, s = np.unique(s, return_inverse=True)
    if not len(h):
        return names, names, np.zeros(0, np.int64)
    h, s = _distinct(h, s)
    base = len(names)
    counts = _Counts(base)
    sets, sizes = np.unique(s, return_counts=True)
    counts.add(sets, sets, sizes)
    shift = top
    while len(h):
        shift = max(0, shift - _STEP)
        node = h >> np.uint64(shift)
        # values of each node that are alive, and the subtree count of each (node, set)
        value = np.r_[True, h[1:] != h[:-1]]
        new_node = np.r_[True, node[1:] != node[:-1]]
        at = np.cumsum(new_node) - 1
        universe = np.bincount(at, weights=value).astype(np.int64)
        keys, inv, count = np.unique(at * base + s, return_inverse=True, return_counts=True)
        knode, kset = keys // base, keys % base
        complete = count == universe[knode]
        many = np.bincount(knode)[knode] > 1
        if (complete & many).any():
            for x in _cross(knode[many], complete[many], count[many], kset[many]):
                counts.add(*x)
        alive = many & ~complete
        left = np.bincount(knode[alive], minlength=len(universe))
        rows = (alive & (left[knode] > 1))[inv]
        h, s = h[rows], s[rows]
    a, b, c = counts.result()
    return names[a], names[b], c


def _distinct(h: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(h, s) in order, each pair once."""
    order = np.lexsort((s, h))
    h, s = h[order], s[order]
    first = np.r_[True, (h[1:] != h[:-1]) | (s[1:] != s[:-1])]
    return h[first], s[first]


def _wide_items(h: np.ndarray, s: np.ndarray, most: int) -> np.ndarray:
    """Which of the distinct, ordered rows belong to items in more than ``most`` sets."""
    _, inv, n = np.unique(h, return_inverse=True, return_counts=True)
    return (n > most)[inv]


def _block_pairs(wide: DataFrame, most: int) -> DataFrame:
    """(a, b, c) of all pairs of sets of one item; wide: (h, no). Sets of an item go to blocks by hash, and each pair of blocks is a group of its own."""
    size = wide.groupBy("h").agg(F.ceil(F.count(F.lit(1)) * 2 / most).cast("int").alias("g"))
    blocked = wide.join(size, "h").withColumn("x", F.pmod(F.xxhash64("no", F.lit(7)), F.col("g")).cast("int"))
    spread = blocked.select("h", "no", "x", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("y")).select(
        "h", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "no", (F.col("x") > F.col("y")).alias("second"))
    cut = spread.groupBy("h", "i", "j").agg(
        F.collect_list(F.when(~F.col("second"), F.col("no"))).alias("u"), F.collect_list(F.when(F.col("second"), F.col("no"))).alias("v"))
    one = cut.select("i", "j", F.explode("u").alias("p"), F.when(F.col("i") == F.col("j"), F.col("u")).otherwise(F.col("v")).alias("v"))
    two = one.select("i", "j", "p", F.explode("v").alias("q")).where((F.col("i") < F.col("j")) | (F.col("p") < F.col("q")))
    return two.groupBy(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).agg(F.count(F.lit(1)).alias("c"))


def set_overlaps(rows: DataFrame, sets: DataFrame, set_col: str = "person_id", item_col: str = "image_name", item_sets: int = ITEM_SETS) -> DataFrame:
    """(set_a, set_b, shared, size_a, size_b) of all pairs of listed sets that share an item, set_a < set_b.

    ``rows``: (set, item) memberships, repeated ones count once; ``sets``: the listed
    sets, null and repeated ids ignored. A pair without a row shares nothing. Counts
    are exact but for collisions of 64-bit hashes, which stand for items and sets alike. Copies of a row fall
    together map-side; then (item, set) hashes are shuffled by hash range: the rows of an item stay within one range and are bounded
    by its sets, a set of any size is spread over all ranges. Items in more than ``item_sets`` sets are set apart there and
    paired in blocks. The partial counts per pair are summed map-side.
    """
    listed = sets.select(F.col(set_col).alias("_set")).where(F.col("_set").isNotNull()).distinct().withColumn("no", F.xxhash64("_set"))
    small = listed.limit(BROADCAST_SETS + 1).count() <= BROADCAST_SETS
    fix = F.broadcast if small else (lambda d: d)
    mine = rows.join(fix(listed), rows[set_col] == F.col("_set")).select(F.xxhash64(F.col(item_col)).alias("h"), "no").distinct()
    total = rows.count()
    bits = max(0, math.ceil(math.log2(max(1, total / ROWS_PER_RANGE))))
    ranged = mine.withColumn("r", F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long"))

    def descend(pdf: pd.DataFrame) -> pd.DataFrame:
        h, s = _distinct(pdf["h"].to_numpy(np.int64).view(np.uint64), pdf["no"].to_numpy(np.int64))
        wide = _wide_items(h, s, item_sets)
        a, b, c = trie_overlaps(h[~wide], s[~wide], 64 - bits)
        own, n = np.unique(s[wide], return_counts=True)
        out = [(a, b, c), (own, own, n), (h[wide].view(np.int64), s[wide], np.zeros(int(wide.sum()), np.int64))]
        return pd.DataFrame({k: np.concatenate(v) for k, v in zip("abc", zip(*out))})

    parts = materialise(ranged.groupBy("r").applyInPandas(descend, "a long, b long, c long"), "overlap-parts")
    # a count of 0 marks a row of an item that was set apart
    wide = parts.where("c = 0").select(F.col("a").alias("h"), F.col("b").alias("no"))
    counted = parts.where("c > 0")
    if not wide.isEmpty():
        counted = counted.unionByName(_block_pairs(wide, item_sets))
    pairs = counted.groupBy("a", "b").agg(F.sum("c").alias("shared"))
    own = parts.where("c > 0 and a = b").groupBy("a").agg(F.sum("c").alias("size"))
    sized = listed.join(own, listed["no"] == own["a"]).select("_set", "no", "size")
    left = sized.select(F.col("no").alias("a"), F.struct(F.col("_set").alias("id"), "size").alias("x"))
    right = sized.select(F.col("no").alias("b"), F.struct(F.col("_set").alias("id"), "size").alias("y"))
    both = pairs.where("a <> b").join(fix(left), "a").join(fix(right), "b").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "shared")
    return both.select(F.col("x.id").alias("set_a"), F.col("y.id").alias("set_b"), "shared", F.col("x.size").alias("size_a"), F.col("y.size").alias("size_b"))


def person_overlaps(pei: DataFrame, compare_list: DataFrame) -> DataFrame:
    """Overlaps of the compared persons over the cleaned memberships."""
    return set_overlaps(memberships(pei), compare_list)


def near_sets(overlaps: DataFrame, part: int = 2, of: int = 5) -> DataFrame:
    """Pairs that share at least part/of of the smaller set (an empty set is no case)."""
    return overlaps.where(F.col("shared") * of >= F.least("size_a", "size_b") * part).select(
        F.col("set_a").alias("person_id_a"), F.col("set_b").alias("person_id_b"))
