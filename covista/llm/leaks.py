"""Evaluation passages inside a corpus, by a generalised suffix automaton.

The normalised words of all test items form one automaton (its size is bounded:
items are cut into several automata beyond a limit). Each document's words are
streamed through it once, tracking the longest match that ends at each word; a
match of the required length names the items whose text holds it.
"""

from __future__ import annotations

import html
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.llm.canonical import canonical

#: Consecutive words that make a leak.
LEAST_WORDS = 12
#: Words of test items in one automaton; further items go to further automata.
AUTOMATON_WORDS = 200_000
#: Bytes of item text whose automata are broadcast for one pass over the corpus. 200,000 words take 160 MB of a Python worker
#: (measured), so a pass takes one or two automata. More items take more passes; nothing grows with them but their number.
PASS_BYTES = 2**20

# Attributes of HTML that stand without a value.
_BARE = ("async|autofocus|autoplay|checked|controls|default|defer|disabled|download|formnovalidate|hidden|inert|ismap|itemscope|loop|multiple|"
         "muted|nomodule|novalidate|nowrap|open|playsinline|readonly|required|reversed|selected")
#: Tags, comments and declarations. A name between angle brackets is one of a tag only if what follows it are attributes: ``a <b and c> d`` is text.
_TAG = re.compile(
    rf"""<!--.*?-->|<[!?][A-Za-z][^<>]*>|</[A-Za-z][\w:.-]*\s*>|<[A-Za-z][\w:.-]*(?:\s+(?:[\w:@.-]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>=`]+)|(?:{_BARE})(?=[\s/>])))*\s*/?>""",
    re.S | re.I)
_LINK = re.compile(r"(!?\[[^\[\]]*\])\([^()\s]*\)")
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Runs of letters and digits of a text without its markup, canonical and in lower case."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if "](" in text:
        text = _LINK.sub(r"\1", text)
    return _WORD.findall(canonical(text).lower())


class Automaton:
    """Generalised suffix automaton over word numbers, with the items behind each long match."""

    def __init__(self, items: list[tuple[int, list[str]]], least: int = LEAST_WORDS):
        self.least = least
        self.vocab: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ends: list[set[int]] = [set()]
        for item, ws in items:
            last = 0
            for w in ws:
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)), ends)
                ends[last].add(item)
        # items of a state's substrings: its own ends and those of all states that link to it
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            if self.link[v] > 0:
                ends[self.link[v]] |= ends[v]
        self.items = [tuple(sorted(e)) for e in ends]

    def _state(self, length: int, nxt: dict, link: int, ends: list) -> int:
        self.len.append(length)
        self.next.append(nxt)
        self.link.append(link)
        ends.append(set())
        return len(self.len) - 1

    def _split(self, p: int, c: int, ends: list) -> int:
        """The state of p's longest string followed by c, cut off from a longer one where needed."""
        q = self.next[p][c]
        if self.len[q] == self.len[p] + 1:
            return q
        clone = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q], ends)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int, ends: list) -> int:
        if c in self.next[last]:
            return self._split(last, c, ends)
        cur = self._state(self.len[last] + 1, {}, 0, ends)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            self.link[cur] = self._split(p, c, ends)
        return cur

    def spans(self, ws: list[str]) -> list[tuple[int, int, tuple[int, ...]]]:
        """(first word, one past the last, items) at each word where a match of >= least words ends.

        The items are those that hold the last ``least`` words of the match.
        """
        get, nxt, link, length, least = self.vocab.get, self.next, self.link, self.len, self.least
        out, v, n = [], 0, 0
        for i, w in enumerate(ws):
            c = get(w)
            if c is None:
                v = n = 0
                continue
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            if n >= least:
                u = v
                while length[link[u]] >= least:
                    u = link[u]
                out.append((i + 1 - n, i + 1, self.items[u]))
        return out

    def items_in(self, ws: list[str]) -> set[int]:
        """Items with at least ``least`` consecutive words in ws. Stretches too short for a match are passed over."""
        get, run, found = self.vocab.get, 0, False
        for w in ws:
            run = run + 1 if get(w) is not None else 0
            if run >= self.least:
                found = True
                break
        if not found:
            return set()
        return {x for _, _, items in self.spans(ws) for x in items}


def _passes(items: DataFrame, pass_bytes: int) -> list[DataFrame]:
    """The items in parts of about ``pass_bytes`` of text, by the hash of their ids."""
    items = items.select("item_id", "item_text").where("item_id is not null and item_text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("item_text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // pass_bytes))
    return [items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == i) if parts > 1 else items for i in range(parts)]


def _automata(items: DataFrame, least: int, limit: int) -> list[Automaton]:
    rows = sorted((r.item_id, words(r.item_text)) for r in items.collect())
    out, held, n = [], [], 0
    for item, ws in rows:
        if held and n + len(ws) > limit:
            out.append(Automaton(held, least))
            held, n = [], 0
        held.append((item, ws))
        n += len(ws)
    return out + ([Automaton(held, least)] if held else [])


def leaked_items(docs: DataFrame, items: DataFrame, least: int = LEAST_WORDS, limit: int = AUTOMATON_WORDS,
                 pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(doc_id, item_id): documents that hold at least ``least`` consecutive words of an item's text.

    docs: doc_id, text; items: item_id, item_text. Null texts and ids give no row, an
    item shorter than ``least`` words can't leak, an item given twice counts once. Texts
    are read whole. Case, punctuation, white space, line breaks, markup (tags, entities,
    link targets) and characters of the same look make no difference. The automata of
    so many items as memory allows are broadcast for one pass over the corpus; more items take
    more passes. Documents are neither shuffled nor collected. One document given twice under one id gives its pairs once.
    """
    return reduce(DataFrame.unionByName, [_leaks_of(docs, part, least, limit) for part in _passes(items, pass_bytes)]).distinct()


def _leaks_of(docs: DataFrame, items: DataFrame, least: int, limit: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(_automata(items, least, limit))

    def scan(batches):
        autos = shared.value
        for b in batches:
            ids, hit = b.column(0).to_pylist(), ([], [])
            for i, t in zip(ids, b.column(1).to_pylist()):
                ws = words(t)
                if len(ws) < least:
                    continue
                for a in autos:
                    for x in sorted(a.items_in(ws)):
                        hit[0].append(i)
                        hit[1].append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hit[0], b.schema.field(0).type), pa.array(hit[1], pa.int64())], names=["doc_id", "item_id"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (
        docs.select("doc_id", "text").where("doc_id is not null and text is not null")
        .mapInArrow(scan, f"doc_id {kind}, item_id long")
    )


def without_leaks(docs: DataFrame, items: DataFrame, least: int = LEAST_WORDS, coverage: float = 0.5) -> DataFrame:
    """(doc_id, leaked_words, words, clean_words array, dropped) of every document with a leak.

    The words of matched spans are removed; ``dropped`` marks documents of which more
    than ``coverage`` of the words are leaked, which are better left out whole. A document's spans
    must be known together, so the items are a bounded input here: beyond PASS_BYTES it is an error.
    """
    parts = _passes(items, PASS_BYTES)
    if len(parts) > 1:
        raise ValueError("the test items are beyond the stated bound; clean the corpus by parts of them in turn")
    shared = docs.sparkSession.sparkContext.broadcast(_automata(parts[0], least, AUTOMATON_WORDS))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def scan(batches):
        for b in batches:
            rows = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ws = words(t)
                leaked = set()
                for a in shared.value:
                    done = 0  # spans begin and end in order: each word is taken once, however long the match
                    for s, e, _ in a.spans(ws):
                        leaked.update(range(max(s, done), e))
                        done = e
                if leaked:
                    rows.append((i, len(leaked), len(ws), [w for k, w in enumerate(ws) if k not in leaked],
                                 len(leaked) > coverage * len(ws)))
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], b.schema.field(0).type), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], pa.list_(pa.string())), pa.array(cols[4], pa.bool_())],
                names=["doc_id", "leaked_words", "words", "clean_words", "dropped"])

    return docs.select("doc_id", "text").where("doc_id is not null and text is not null").mapInArrow(
        scan, f"doc_id {kind}, leaked_words long, words long, clean_words array<string>, dropped boolean")
