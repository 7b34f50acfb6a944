"""Variant spellings of the names of persons and organisations, linked.

1. What the corpus itself tells is learned first: the words of organisations (those that
   stand behind the first word of many names with a legal form), and from the list of
   short forms how short forms are made. A name is parsed into a *core* (family name, or
   the own words of an organisation; its legal form falls away and its other words
   stand beside), given names in order, and initials; titles fall away. Names of one parse are one node, however many rows hold them.
2. Cores meet by MinHash banding over padded q-grams; the number of bands follows from
   the collision curve and a target recall. Cores whose allowed edits leave fewer q-grams
   in common than that meet by what is left when letters are taken out: every pair within
   the allowed edits has such a rest in common. Core pairs are verified by edit distance.
3. Nodes with linked cores and a given name in common (as a spelling, a short form or an
   initial) are compared by Monge-Elkan similarity: of each word its best match anywhere in
   the other name, weighted by how rare the words are in the corpus.
4. Links are clustered into stars: fully written names are centres, in order of rank, and
   each other name joins its most similar centre. A name that would fit several persons
   (an initial, a short form of several names) joins none of them.
"""

from __future__ import annotations

import itertools
import math
import re
import unicodedata
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from covista.llm.canonical import look
from covista.session import materialise

# Words that name no one.
TITLES = {"mr", "mrs", "ms", "miss", "mx", "dr", "prof", "sir", "rev", "hon", "herr", "frau", "mme", "sr", "jr", "phd", "md", "esq"}
LEGAL = {"co", "company", "ltd", "limited", "inc", "incorporated", "gmbh", "sons", "corp", "corporation", "llc", "plc", "sa", "ag", "kg", "bv"}
# A Cyrillic letter in Latin letters.
CYRILLIC = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюя",
                    "a b v g d e e j z i i k l m n o p r s t u f h ts ch sh shch _ i _ e iu ia".split()))
# Spellings that stand for one sound.
SOUNDS = (("ph", "f"), ("th", "f"), ("ck", "k"), ("c", "k"), ("q", "k"), ("w", "v"), ("z", "s"), ("y", "i"), ("x", "ks"))
#: A word is one of organisations if this share of the names with a legal form (and two of them) hold it behind their first word.
ORGANISATION_SHARE = 0.01
#: A way of making short forms counts if this share of the listed short forms (and two of them) are made so.
SHORT_SHARE = 0.02

QGRAM = 3
#: Minhashes in a band, and the similarity of core spellings (Jaccard of q-grams) that must meet with the target recall.
BAND_ROWS = 3
TARGET_SIMILARITY, TARGET_RECALL = 0.42, 0.985
#: Texts up to this length meet by rests of the whole; from twice ``END`` letters on by rests of their first and last letters.
WHOLE, END = 16, 7
#: Cores taken at once by a banding task.
CORES_AT_ONCE = 1000
#: Monge-Elkan similarity that makes two names one.
LEAST_SIMILARITY = 0.8
#: A vague name joins a person only if no other person fits it within this margin.
VAGUE_MARGIN = 0.02
#: The list of short forms is broadcast up to this many rows.
MAX_FORMS = 500_000
#: A core with more nodes is cut into blocks of about so many, and pairs of blocks are compared apart.
CORE_NODES = 5000
#: What the part of the similarity that the longer name has on its side adds to the score: of equal matches the one that leaves less open ranks first.
OTHER_WAY = 0.2


def bands_for(similarity: float = TARGET_SIMILARITY, recall: float = TARGET_RECALL, rows: int = BAND_ROWS) -> int:
    """Bands of ``rows`` minhashes that meet a pair of this similarity with the given recall (the collision curve, solved)."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def plain(text: str) -> str:
    """Latin letters of a label in lower case, without accents."""
    t = unicodedata.normalize("NFKD", text)
    return "".join(c for c in t if not unicodedata.combining(c)).lower()


#: Latin letters that the look of a Cyrillic name has, back to Cyrillic; only for words that hold a true Cyrillic letter.
_BACK = dict(zip("aeopcyxkmthbi", "аеорсухкмтнві"))
_BACK_UPPER = dict(zip("ABEKMHOPCTYX", "авекмнорстух"))


def cyrillic(text: str) -> bool:
    return any("а" <= c <= "я" or c in "ёі" for c in text.lower())


def latin(word: str, among_cyrillic: bool = False) -> str:
    """A word in plain Latin letters; words in Cyrillic are transliterated letter by letter.

    A word that holds only letters of either look counts as Cyrillic among Cyrillic words.
    """
    if cyrillic(word) or among_cyrillic and all(c in _BACK or c in _BACK_UPPER for c in word):
        back = "".join(_BACK_UPPER.get(c, _BACK.get(c, c.lower())) for c in word)
        return "".join(CYRILLIC.get(c, c) for c in plain_keep(back)).replace("_", "")
    return plain(word)


def plain_keep(word: str) -> str:
    """Lower case without accents, й and ё kept apart from their base letters' marks."""
    t = unicodedata.normalize("NFKD", word.lower())
    return "".join(c for c in t if not unicodedata.combining(c))


@lru_cache(maxsize=200_000)
def sound(word: str) -> str:
    """A word with spellings of one sound made one, and doubled letters single."""
    for a, b in SOUNDS:
        word = word.replace(a, b)
    return re.sub(r"(.)\1+", r"\1", word)


def edits(a: str, b: str, most: int) -> int:
    """Damerau-Levenshtein distance (adjacent swaps), most + 1 where it is beyond ``most``."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i] + [0] * len(b)
        least = i
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            new[j] = d
            least = min(least, d)
        if least > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


class Parser:
    """Parses names against a list of given names and their known short forms, and the words of organisations."""

    def __init__(self, forms: list[tuple[str, str]], organisation: tuple[str, ...] = ()):
        #: given names by sound, as written in Latin letters
        self.given = {sound(latin(g)): latin(g) for _, g in forms}
        written = set(self.given.values())
        self.short: dict[str, set[str]] = defaultdict(set)
        for s, g in forms:
            if latin(s) not in written:
                self.short[latin(s)].add(self.given[sound(latin(g))])
        self.short_sound: dict[str, set[str]] = defaultdict(set)
        for s, gs in self.short.items():
            self.short_sound[sound(s)] |= gs
        self.by_shape: dict[str, set[str]] = defaultdict(set)
        for k, g in self.given.items():
            for x in {k, g}:
                for shape in self._deletions(x):
                    self.by_shape[shape].add(x)
        self._near: dict[str, frozenset] = {}
        self._rule: dict[str, frozenset] = {}
        self._parts: dict[str, set[str]] = defaultdict(set)
        for g in self.given.values():
            for i in range(len(g) - 1):
                self._parts[g[i : i + 2]].add(g)
        self.ways = self._learn_ways()
        self.organisation = {w: w for w in organisation}
        self.organisation |= {w + "s": w for w in organisation if w + "s" not in self.organisation}
        self._organisation_word: dict[str, str | None] = {}

    def _learn_ways(self) -> list[tuple[str, str, bool, int]]:
        """How the listed short forms are made: (letters before, letters behind, from the beginning of the given name, letters kept at least)."""
        seen: dict[tuple, list[int]] = defaultdict(list)
        for s, gs in self.short.items():
            for g in gs:
                kept, at = max(((j - i, -i), i) for i in range(len(s)) for j in range(i + 1, len(s) + 1) if s[i:j] in g)
                kept = kept[0]
                if kept >= 2:
                    start = at == 0 and g.startswith(s[:kept])
                    seen[s[:at], s[at + kept :], start].append(kept)
        least = max(2, SHORT_SHARE * len(self.short))
        return sorted((a, e, start, min(k)) for (a, e, start), k in seen.items() if len(k) >= least and a + e)

    @staticmethod
    def _deletions(w: str):
        yield w
        for i in range(len(w)):
            yield w[:i] + w[i + 1 :]

    def near(self, w: str) -> frozenset:
        """Given names that a written word may stand for by one slip, in its sounds or its letters (two slips in a long word)."""
        return self._near_shape(sound(w)) or self._near_shape(w)

    def _near_shape(self, w: str) -> frozenset:
        if w in self._near:
            return self._near[w]
        out: set[str] = set()
        if w in self.given:
            out = {self.given[w]}
        elif len(w) >= 4:
            cand = set().union(*(self.by_shape.get(k, ()) for k in self._deletions(w)))
            out = {g for g in cand if edits(w, g, 1) <= 1}
            if not out and len(w) >= 7:
                out = {g for g in cand if edits(w, g, 2) <= 2}
            out = {self.given.get(g, g) for g in out}
        if len(self._near) < 500_000:
            self._near[w] = frozenset(out)
        return frozenset(out)

    def known_short(self, w: str) -> set[str]:
        return self.short.get(w) or self.short_sound.get(sound(w)) or set()

    def by_rule(self, w: str, ways: bool = True) -> frozenset:
        """Given names an unlisted short form may stand for: their beginning, or made of them in a way that listed forms are."""
        key = w + "+" * ways
        if key not in self._rule:
            stems = [(w, True)] if len(w) >= 3 else []
            for a, e, start, least in self.ways if ways else ():
                stem = w[len(a) : len(w) - len(e)]
                if len(stem) >= max(least, 3 if start and len(e) < 2 else 2) and w.startswith(a) and w.endswith(e):
                    stems.append((stem, start))
            out = {g for stem, start in stems for g in self._parts.get(stem[:2], ()) if (g.startswith(stem) if start else stem in g)}
            if len(self._rule) >= 500_000:
                return frozenset(out)
            self._rule[key] = frozenset(out)
        return self._rule[key]

    def _words(self, name: str) -> tuple[list[str], int]:
        """Words of a name, split where a space is missing; and how many stand before a comma (0: none)."""
        text = look(name)
        text = re.sub(r"(?<=[^\W\d_A-ZА-Я])(?=[A-ZА-ЯŠŽŘŇÀ-ÖØ-Þ][^\W\d_A-Z])|(?<=\b[A-ZА-Я])(?=[A-ZА-Я][a-zа-я])", " ", text)
        before, among = 0, cyrillic(text)
        out: list[str] = []
        for c, part in enumerate(re.split(r",", text)):
            for chunk in re.split(r"[^\w\-'‐‑]+", part):
                pieces = [latin(p, among) for p in re.split(r"[-‐‑']", chunk) if p]
                joined: list[str] = []
                for p in pieces:
                    # a short second part belongs to the word before it (an addition to a family name)
                    if joined and len(p) <= 4:
                        joined[-1] += p
                    else:
                        joined.append(p)
                pieces = joined
                out += [p for p in pieces if p]
            if c == 0 and "," in text:
                before = len(out)
        self.cyrillic = among
        return out, before

    def parse(self, name: str | None) -> tuple | None:
        """(kind, core, givens, label): kind 'person' or 'org', givens a tuple of alternatives ('a|b') and initials ('t.')."""
        if name is None:
            return None
        words, before = self._words(name)
        words = [w for w in words if any(c.isalnum() for c in w)]
        if not words or (len(words) <= 2 and any(w.isdigit() for w in words)) or not any(c.isalpha() for w in words for c in w):
            return None
        org, legal = self._organisation(words)
        if org:
            return org
        title = lambda w: w in TITLES or w == "the" or (3 < len(w) < 6 and edits(w, "prof", 1) <= 1)
        before -= sum(map(title, words[:before]))
        words = [w for w in words if not title(w)]
        if not words:
            return None
        return self._person(words, before)

    def organisation_word(self, w: str) -> str | None:
        """The word of organisations that w is, with a slip in a longer one."""
        if w not in self._organisation_word:
            k = self.organisation.get(w)
            if k is None and len(w) >= 4:
                k = next((v for o, v in sorted(self.organisation.items()) if len(o) >= 5 and abs(len(o) - len(w)) <= 1 and edits(o, w, 1) <= 1), None)
            if len(self._organisation_word) >= 500_000:
                return k
            self._organisation_word[w] = k
        return self._organisation_word[w]

    def _abbreviated(self, w: str) -> str | None:
        """The word of organisations that w shortens: its first letter and some of the others in order."""
        if not 2 <= len(w) <= 5 or sound(w) in self.given or self.known_short(w):
            return None

        def fits(o: str) -> bool:
            rest = iter(o)
            return o[0] == w[0] and len(o) > len(w) and all(c in rest for c in w)

        found = [o for o in sorted(self.organisation) if fits(o)]
        # a beginning comes before letters picked from within, and of those the word with the same last letter
        return min(found, key=lambda o: (not o.startswith(w), o[-1] != w[-1], len(o)), default=None) if found else None

    def _run_together(self, text: str) -> list[str] | None:
        """The one or two words of organisations that ``text`` is with up to two slips (spaces lost or misplaced)."""
        if len(text) < 6:
            return None
        kinds = sorted(set(self.organisation.values()))
        ways = [[o] for o in kinds] + [[o, q] for o in kinds for q in kinds if abs(len(o) + len(q) - len(text)) <= 2]
        found = min(((edits("".join(x), text, 2), x) for x in ways), default=(3, None))
        return found[1] if found[0] <= 2 else None

    def _organisation(self, words: list[str]):
        """core: the own words, run together; givens: the words of organisations among the others, in order of the alphabet."""
        own, kinds, legal, long, tail = [], [], 0, False, ""
        if len(words) > 2 and 3 <= len(words[0]) <= 4 and edits(words[0], "the", 1) <= 1:
            words = words[1:]
        for w in words:
            if w in ("the", "and"):
                continue
            if w in LEGAL:
                legal += 1
                continue
            k = self.organisation_word(w)
            long |= k is not None and len(k) >= 6
            if k is None and (own or kinds) and (k := self._abbreviated(w)):
                k = self.organisation[k]
            tail += w if own else ""
            (own if k is None else kinds).append(k or w)
        if not own:  # a name of nothing but such words: the first is its own
            own, kinds = kinds[:1], kinds[1:]
        if not own or not (len(kinds) >= 2 or (kinds and legal) or (legal and len(own) >= 2 and words[-1] in LEGAL) or long):
            return None, legal
        if len(own) > 1 and (more := self._run_together(tail)):
            own, kinds = own[:1], more
        return ("org", "".join(own), tuple(sorted(kinds)), ""), legal

    def _person(self, words: list[str], before: int) -> tuple:
        kinds = []
        for w in words:
            if len(w) == 1:
                kinds.append("i")
            elif sound(w) in self.given:
                kinds.append("g")
            elif self.known_short(w):
                kinds.append("s")
            elif len(w) >= 4 and self.near(w):
                kinds.append("n")
            else:
                kinds.append("x")
        # the family name: before a comma, else the longest unknown word, else the last word
        unknown = [i for i, k in enumerate(kinds) if k == "x"]
        if before and before < len(words):
            fam = max(range(before), key=lambda i: (kinds[i] == "x", len(words[i])))
        elif unknown:
            fam = max(unknown, key=lambda i: (len(words[i]), i))
            if len(words[fam]) <= 4 and "n" in kinds:
                fam = max((i for i, k in enumerate(kinds) if k == "n"), key=lambda i: len(words[i]))
        else:
            full_words = [i for i, k in enumerate(kinds) if k != "i"]
            fam = ([i for i in full_words if kinds[i] == "n"] or full_words or [len(words) - 1])[-1]
        core = words[fam]
        if len(words) == 1:
            # a given and a family name written as one word
            for g in sorted(self.given.values(), key=len, reverse=True):
                if len(g) >= 4 and core.startswith(g) and len(core) - len(g) >= 5:
                    return ("person", core[len(g):], (g,), "")
        givens = []
        for i, (w, k) in enumerate(zip(words, kinds)):
            if i == fam:
                continue
            if k == "i":
                givens.append("f.|t." if w == "f" and self.cyrillic else w + ".")
            elif k == "g":
                givens.append(self.given[sound(w)])
            elif k == "s":
                givens.append("|".join(sorted(self.known_short(w) | self.by_rule(w, ways=False) | {w + "~"})))
            elif k == "n":
                givens.append("|".join(sorted(self.near(w))))
            else:
                givens.append("|".join(sorted(self.by_rule(w) | {w + "~"})))
        return ("person", core, tuple(givens), "")


def initials(givens: tuple[str, ...]) -> list[str]:
    """First letters that the first given name may have; '*' where there is none."""
    if not givens:
        return ["*"]
    return sorted({a[0] for a in givens[0].split("|") if a})


def full(givens: tuple[str, ...]) -> str:
    """The first given name if it is known in full, else ''."""
    if not givens or givens[0].endswith(".") or "|" in givens[0] or "~" in givens[0]:
        return ""
    return givens[0]


def given_similarity(a: str, b: str) -> float:
    """Similarity of two given names: alternatives, short forms and initials count."""
    best = 0.0
    for x in a.split("|"):
        for y in b.split("|"):
            if x == y:
                s = 1.0
            elif x.endswith(".") or y.endswith("."):
                s = 0.9 if x[0] == y[0] else 0.0
            elif x.endswith("~") or y.endswith("~"):
                u, v = x.rstrip("~"), y.rstrip("~")
                most = 2 if min(len(u), len(v)) >= 7 else 1 if min(len(u), len(v)) >= 3 else 0
                d = min(edits(u, v, most), edits(sound(u), sound(v), most))
                s = 1 - d / max(len(u), len(v)) if d <= most else 0.0
            else:
                s = 0.0  # two known given names
            best = max(best, s)
    return best


def allowed_edits(n: int) -> int:
    """Edits that a core of n sounds may have."""
    return 0 if n < 4 else 1 if n < 7 else 2 if n < 14 else 3


def _rests(text: str, most: int) -> set[str]:
    """The text with up to ``most`` letters taken out."""
    return {"".join(r) for k in range(min(most, len(text)) + 1) for r in itertools.combinations(text, len(text) - k)}


def core_rests(core: str) -> set[str]:
    """Keys of which two cores within the allowed edits always have one in common, in sounds or in letters.

    An edit or a swap costs either text one letter of what they have in common. Of up to m edits to a
    text of two ends or more, one end sees (m + 1) // 2 at most, for a swap between the ends touches both.
    The lengths of the two ways overlap by as much as the lengths of a pair can differ.
    """
    most = allowed_edits(len(sound(core)))
    out = set()
    for t in {sound(core), core}:
        if len(t) <= WHOLE:
            out |= {f"w{r}" for r in _rests(t, most)}
        if len(t) >= 2 * END:
            out |= {f"a{r}" for r in _rests(t[:END], (most + 1) // 2)}
            out |= {f"z{r}" for r in _rests(t[-END:], (most + 1) // 2)}
    return out


def core_distance(a: str, b: str) -> int:
    """Edits between two cores, in their sounds or their letters, if they may be one, else 99. Longer cores may differ more."""
    x, y = sound(a), sound(b)
    most = allowed_edits(min(len(x), len(y)))
    d = edits(x, y, most)
    if d and (a != x or b != y):
        d = min(d, edits(a, b, most))
    return d if d <= most else 99


def word_weights(counts: dict[str, int], names: int) -> dict[str, float]:
    """How much a given name or initial tells: the logarithm of how rare it is; a common one still counts a little."""
    return {w: 1.0 + math.log(max(1.0, names / n)) for w, n in counts.items()}


def weight_of(given: str, weights: dict[str, float], other: float) -> float:
    """Weight of a part of a name: of alternatives that of the most common one; unlisted forms are as rare as words get."""
    return min((weights.get(x, other) for x in given.split("|") if not x.endswith("~")), default=other)


def _one_way(own: list[tuple[float, float]]) -> float:
    """Weighted mean of (weight, best similarity)."""
    return sum(w * s for w, s in own) / sum(w for w, _ in own)


def name_similarity(kind: str, core_a: str, givens_a: tuple, core_b: str, givens_b: tuple, core_weight: float = 2.0,
                    weights: dict[str, float] | None = None, rare: float = 1.0) -> float:
    """Monge-Elkan similarity: the weighted mean, over the words of the name with fewer, of the best similarity anywhere in the other.

    What the other name has besides weighs little (OTHER_WAY), and only in the score. A
    first given name must be the other's first one, unless all given names are there in
    another order: a person who shares a middle name with another is somebody else.
    """
    d = core_distance(core_a, core_b)
    if d == 99:
        return 0.0
    s_core = 1 - d / max(len(core_a), len(core_b))
    if kind == "org":
        # the words of organisations must be the same; they are told apart by the own words
        s_all = 1 - d / (max(len(core_a), len(core_b)) + len("".join(givens_a)))
        return s_all if givens_a == givens_b and s_all >= LEAST_SIMILARITY else 0.0
    if not givens_a or not givens_b:
        return s_core if not givens_a and not givens_b else 0.0
    few, more = sorted((givens_a, givens_b), key=len)
    s = [[given_similarity(x, y) for y in more] for x in few]
    known = bool(full(few) and full(more))
    if s[0][0] < 0.7 and not (len(few) == len(more) > 1 and all(max(row) >= 1 for row in s) and all(max(col) >= 1 for col in zip(*s))):
        return 0.0
    w = [weight_of(x, weights or {}, rare) for x in few]
    own = [(core_weight, s_core), (w[0], max(s[0]))]
    for i in range(1, len(few)):
        best = max(s[i])
        # middle initials are typed in or left out freely; only beside a bare first initial must one fit a written name
        one = few[i].endswith(".") + more[i].endswith(".")
        if one == 2 and few[i] != more[i] or one == 1 and known:
            continue
        if best < 0.7:
            return 0.0
        own.append((w[i], best))
    if (max(s[0]) < 1 or not known) and d > (1 if len(core_a) < 9 else 2):
        return 0.0
    back = [(core_weight, s_core)] + [(weight_of(y, weights or {}, rare), max(row[j] for row in s)) for j, y in enumerate(more)]
    one = _one_way(own)
    return one + OTHER_WAY * _one_way(back) if one >= LEAST_SIMILARITY else 0.0


# --- Spark ---------------------------------------------------------------------------------------------------------

_parsers: dict = {}


def _forms(forms: DataFrame) -> list[tuple[str, str]]:
    rows = forms.select("short_form", "given_name").where("short_form is not null and given_name is not null").distinct()
    got = rows.limit(MAX_FORMS + 1).collect()
    if len(got) > MAX_FORMS:
        raise ValueError("the list of short forms is beyond its stated bound")
    return sorted((r[0], r[1]) for r in got)


_PARSED = T.StructType([T.StructField("kind", T.StringType()), T.StructField("core", T.StringType()),
                        T.StructField("givens", T.ArrayType(T.StringType()))])


def organisation_words(people: DataFrame) -> list[str]:
    """Words that stand behind the first word of many plainly written names with a legal form.

    Counted over all names. A name has so many words, so no more than that many times 1 / ORGANISATION_SHARE can be that frequent: the list is small.
    """
    words = F.filter(F.split(F.lower("name"), "[^a-z]+"), lambda w: ~w.isin("", "the", "and"))
    legal = people.select("name").where("name is not null").distinct().select(words.alias("ws")).where(
        F.arrays_overlap("ws", F.array(*map(F.lit, sorted(LEGAL)))))
    content = F.filter("ws", lambda w: ~w.isin(*LEGAL) & (F.length(w) > 2))
    behind = legal.select(F.explode(F.array_distinct(F.slice(content, 2, 1_000_000))).alias("w"))
    least = legal.agg(F.greatest(F.lit(2), F.ceil(F.count(F.lit(1)) * ORGANISATION_SHARE)).alias("n")).first()[0]
    return sorted(r[0] for r in behind.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("w").collect())


def parsed_names(people: DataFrame, forms: DataFrame) -> DataFrame:
    """(person_id, kind, core, givens) of every name that means somebody.

    Parsed in the tasks of the scan (a name that a batch repeats once) and written, so that no name is parsed again by what reads the result.
    """
    shared = people.sparkSession.sparkContext.broadcast((_forms(forms), tuple(organisation_words(people))))

    def parse_all(s: pd.Series) -> pd.DataFrame:
        key = id(shared)
        if key not in _parsers:
            _parsers.clear()
            _parsers[key] = Parser(*shared.value)
        p, seen = _parsers[key], {}
        for x in s:
            if x not in seen:
                seen[x] = p.parse(x) or (None, None, None, None)
        rows = [seen[x] for x in s]
        return pd.DataFrame({"kind": [r[0] for r in rows], "core": [r[1] for r in rows],
                             "givens": [list(r[2]) if r[2] is not None else None for r in rows]})

    rows = people.select("person_id", "name").where("person_id is not null and name is not null")
    parsed = materialise(rows.select("person_id", pandas_udf(parse_all, _PARSED)("name").alias("p")), "names")
    return parsed.where("p.core <> ''").select("person_id", "p.kind", "p.core", "p.givens")


def _bands(batches):
    """Cores to (core, its sound, hash of a band or a rest); the bands are over padded q-grams of the sound."""
    bands = bands_for()
    rng = np.random.default_rng(7)
    mul = rng.integers(1, 2**62, bands * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for b in (b.slice(lo, CORES_AT_ONCE) for b in batches for lo in range(0, b.num_rows, CORES_AT_ONCE)):
        cores, sounds, keys = [], [], []
        for core in b.column(0).to_pylist():
            t = "^" * (QGRAM - 1) + sound(core) + "$" * (QGRAM - 1)
            grams = {t[i : i + QGRAM] for i in range(len(t) - QGRAM + 1)}
            h = np.array([int.from_bytes(g.encode("utf-8", "surrogatepass")[:8].ljust(8, b"\0"), "little") for g in grams], np.uint64)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            x = h[:, None] * mul[None, :]
            m = (x ^ (x >> np.uint64(31))).min(axis=0).reshape(bands, BAND_ROWS)
            k = np.zeros(bands, np.uint64)
            for r in range(BAND_ROWS):
                k = (k ^ m[:, r]) * np.uint64(0xBF58476D1CE4E5B9)
                k ^= k >> np.uint64(30)
            k ^= np.arange(bands, dtype=np.uint64) * np.uint64(0x94D049BB133111EB)
            rests = np.fromiter((xxhash.xxh64_intdigest(r.encode("utf-8", "surrogatepass")) for r in core_rests(core)), np.uint64).view(np.int64)
            cores += [core] * (bands + len(rests))
            sounds += [sound(core)] * (bands + len(rests))
            keys += [k.view(np.int64), rests]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cores, pa.string()), pa.array(sounds, pa.string()), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))],
            names=["core", "snd", "band"])


def core_links(cores: DataFrame) -> DataFrame:
    """(core_a, core_b), core_a < core_b: different spellings of a core within the allowed edits."""
    # few bytes and much work a core: spread over the cluster, whatever the planner would make of the bytes
    tasks = 2 * cores.sparkSession.sparkContext.defaultParallelism
    bands = cores.select("core").repartition(tasks, F.xxhash64("core")).mapInArrow(_bands, "core string, snd string, band long")
    a, b = bands.alias("a"), bands.alias("b")
    # first in the JVM, by the plain edit distance with a cut-off: what is within the allowed edits is one, what is beyond twice
    # as many (a swap counts two) is none, and only what lies between is left to the exact rule
    shorter = F.least(F.length("a.snd"), F.length("b.snd"))

    def within(times: int):
        hit = F.col("a.snd") == F.col("b.snd")
        for most in (1, 2, 3):
            near = F.lit(False)
            for c in ("snd", "core"):
                near |= (F.abs(F.length(f"a.{c}") - F.length(f"b.{c}")) <= most) & (F.levenshtein(f"a.{c}", f"b.{c}", times * most) >= 0)
            lo, hi = next(n for n in range(99) if allowed_edits(n) == most), next((n for n in range(99) if allowed_edits(n) > most), None)
            hit |= (shorter >= lo) & (shorter < hi if hi else F.lit(True)) & near
        return hit

    # the planner can't see that a core becomes as many rows as there are bands: never to be broadcast
    met = a.join(b.hint("merge"), (F.col("a.band") == F.col("b.band")) & (F.col("a.core") < F.col("b.core")) & within(2)).select(
        F.col("a.core").alias("core_a"), F.col("b.core").alias("core_b"), within(1).alias("sure")).distinct()

    def near(batches):
        for x in batches:
            keep = [s or core_distance(p, q) < 99 for p, q, s in zip(*(x.column(i).to_pylist() for i in range(3)))]
            yield x.select(["core_a", "core_b"]).filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(near, "core_a string, core_b string")


def name_links(nodes: DataFrame, core_nodes: int = CORE_NODES) -> DataFrame:
    """(a, b, score): similar nodes, each pair in both directions. nodes: node, kind, core, givens, n.

    Of a core with very many nodes pairs of blocks of nodes meet, not all in one group.
    """
    total = nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    cores = nodes.groupBy("core").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("nodes")).select(
        "core", (1 + F.log(F.lit(float(max(1, total))) / F.col("n"))).alias("weight"), F.ceil(F.col("nodes") / core_nodes).cast("int").alias("g"))
    links = core_links(cores)
    both = links.unionByName(links.select(F.col("core_b").alias("core_a"), F.col("core_a").alias("core_b"))).unionByName(
        cores.select(F.col("core").alias("core_a"), F.col("core").alias("core_b"))).join(
        cores.select(F.col("core").alias("core_b"), F.col("weight").alias("weight_b"), F.col("g").alias("g_b")), "core_b")

    # Two names known in full meet under a given name that both have. Only loose ones (with an initial or an
    # unlisted form) meet others by first letter, so that a common family name yields no pairs of strangers.
    alternatives = F.flatten(F.transform("givens", lambda g: F.split(g, r"\|")))
    loose = F.exists(alternatives, lambda x: x.rlike(r"[.~]$"))
    names_ = F.transform(F.filter(alternatives, lambda x: ~x.rlike(r"[.~]$")), lambda x: F.concat(F.lit("g:"), x))
    letters = F.transform(alternatives, lambda x: F.concat(F.lit("l:"), F.substring(x, 1, 1)))
    bare = F.when(F.col("kind") == "org", F.array(F.lit("#"))).when(F.size("givens") == 0, F.array(F.lit("*")))
    weighed = nodes.join(cores, "core")
    block = lambda g: F.pmod(F.xxhash64("node"), F.col(g)).cast("int")
    every = weighed.withColumn("meet", F.explode(F.array_distinct(F.coalesce(bare, F.concat(names_, letters)))))
    asking = weighed.withColumn("meet", F.explode(F.array_distinct(F.coalesce(bare, F.when(loose, F.concat(names_, letters)).otherwise(names_)))))
    left = asking.join(both, asking["core"] == both["core_a"]).select(
        F.col("core_b").alias("core"), "meet", block("g_b").alias("i"), F.explode(F.sequence(F.lit(0), F.col("g_b") - 1)).alias("j"),
        F.struct("node", "kind", asking["core"], "givens", "weight").alias("x"))
    right = every.select("core", "meet", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("i"), block("g").alias("j"),
                         F.struct("node", "kind", "core", "givens", "weight").alias("y"))
    met = left.join(right, ["core", "meet", "i", "j"]).where("x.node <> y.node and x.kind = y.kind")
    pairs = met.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()

    # given names of the list and initials: no more than the list and the letters there are
    part = F.explode(F.filter(F.array_distinct(alternatives), lambda x: ~x.endswith("~")))
    often = nodes.select(part.alias("w"), "n").groupBy("w").agg(F.sum("n").alias("n")).collect()
    weights, rare = word_weights({r.w: r.n for r in often}, total), 1 + math.log(max(1, total))
    shared = nodes.sparkSession.sparkContext.broadcast(weights)

    def compare(it):
        for b in it:
            x, y = b.column(0).to_pylist(), b.column(1).to_pylist()
            s = [name_similarity(p["kind"], p["core"], tuple(p["givens"]), q["core"], tuple(q["givens"]), max(p["weight"], q["weight"]), shared.value, rare)
                 for p, q in zip(x, y)]
            keep = [i for i, v in enumerate(s) if v >= LEAST_SIMILARITY]
            yield pa.RecordBatch.from_arrays([pa.array([x[i]["node"] for i in keep], pa.string()), pa.array([y[i]["node"] for i in keep], pa.string()),
                                              pa.array([s[i] for i in keep], pa.float64())], names=["a", "b", "score"])

    one = materialise(pairs.mapInArrow(compare, "a string, b string, score double"), "name-links")
    return one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))


def _unambiguous(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links without those of a name that several persons would fit.

    A name whose first given name isn't known in full is vague. Of the persons (full first
    names) among its neighbours only those within a margin of the best count: if these are
    one person, its links to others fall away; if they are several, all its links do.
    """
    n = nodes.select("node", F.when(F.col("kind") == "org", F.lit("*")).otherwise(F.col("first")).alias("first"))
    seen = (
        links.join(n.select(F.col("node").alias("a"), F.col("first").alias("fa")), "a")
        .join(n.select(F.col("node").alias("b"), F.col("first").alias("fb")), "b")
    )
    vague = seen.where("fa = '' and fb <> ''")
    best = vague.groupBy("a").agg(F.max("score").alias("best"))
    choice = vague.join(best, "a").where(F.col("score") >= F.col("best") - VAGUE_MARGIN).groupBy("a").agg(
        F.min("fb").alias("lo"), F.max("fb").alias("hi"))
    chosen = choice.select("a", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise("-").alias("of"))
    marked = (
        seen.join(chosen.withColumnRenamed("of", "of_a"), "a", "left")
        .join(chosen.select(F.col("a").alias("b"), F.col("of").alias("of_b")), "b", "left")
    )
    # a vague name that is settled counts as that person; an unsettled one links to nobody
    as_a = F.when(F.col("fa") != "", F.col("fa")).otherwise(F.col("of_a"))
    as_b = F.when(F.col("fb") != "", F.col("fb")).otherwise(F.col("of_b"))
    fits = as_a.isNull() | as_b.isNull() | (as_a == as_b)
    split = F.coalesce(F.col("of_a") == "-", F.lit(False)) | F.coalesce(F.col("of_b") == "-", F.lit(False))
    both_full = (F.col("fa") != "") & (F.col("fb") != "")
    return marked.where(both_full | (fits & ~split)).select("a", "b", "score")


def stars(links: DataFrame, ranks: DataFrame) -> DataFrame:
    """(node, centre): star clusters of the link graph; nodes without a link are their own centre.

    ranks: node, rank (greater first, no ties). In turns, every open node that has the
    greatest rank among its open neighbours becomes a centre and takes its open
    neighbours as satellites, each of which goes to its most similar centre; these turns
    give the greedy star cover in rank order. Each turn is one pass of joins, written out
    to cut the lineage. Every turn settles at least the open node of the greatest rank, so the
    turns end; on names there are two or three.
    """
    edges = materialise(
        links.join(ranks.select(F.col("node").alias("a"), F.col("rank").alias("ra")), "a")
        .join(ranks.select(F.col("node").alias("b"), F.col("rank").alias("rb")), "b"), "star-edges")
    done = None
    for turn in itertools.count():
        top = edges.groupBy("a").agg(F.max("rb").alias("best"), F.first("ra").alias("ra"))
        centres = top.where("ra > best").select(F.col("a").alias("centre"))
        taken = edges.join(centres, edges["b"] == centres["centre"]).groupBy("a").agg(
            F.max(F.struct("score", "rb", "centre")).alias("m")).select(F.col("a").alias("node"), F.col("m.centre").alias("centre"))
        now = materialise(taken.unionByName(centres.select(F.col("centre").alias("node"), "centre")), f"stars-{turn}")
        done = now if done is None else done.unionByName(now)
        gone = now.select("node")
        edges = materialise(
            edges.join(gone.select(F.col("node").alias("a")), "a", "left_anti").join(
                gone.select(F.col("node").alias("b")), "b", "left_anti"), f"star-edges-{turn}")
        if edges.isEmpty():
            break
    rest = ranks.select("node").join(done.select("node"), "node", "left_anti")
    return done.unionByName(rest.select("node", F.col("node").alias("centre")))


def name_entities(people: DataFrame, forms: DataFrame) -> DataFrame:
    """(person_id, entity): every person_id whose name means somebody, with the name that stands for its group.

    people: person_id, name; forms: short_form, given_name. Null and blank names and bare
    labels with a number mean nobody and are left out, as are null ids; repeated rows count once.
    """
    parsed = parsed_names(people, forms).distinct()
    key = F.concat_ws("\x1f", "kind", "core", F.concat_ws(" ", "givens"))
    rows = parsed.withColumn("node", key)
    first = F.when((F.size("givens") > 0) & ~F.col("givens")[0].rlike(r"[|~.]"), F.col("givens")[0]).otherwise(F.lit(""))
    nodes = rows.groupBy("node").agg(F.first("kind").alias("kind"), F.first("core").alias("core"),
                                     F.first("givens").alias("givens"), F.count(F.lit(1)).alias("n"))
    nodes = materialise(nodes.withColumn("first", first), "name-nodes")
    # fully written names first, then names held by more rows, then by text
    ranks = nodes.select("node", F.struct(
        (F.col("first") != "").alias("full"), (F.size("givens") > 1).alias("middle"), F.col("n"), F.col("node").alias("t")).alias("rank"))
    links = name_links(nodes)
    star = stars(_unambiguous(links, nodes), ranks)
    return rows.select("person_id", "node").join(star, "node").select("person_id", F.col("centre").alias("entity"))


def entity_ids(people: DataFrame, forms: DataFrame) -> DataFrame:
    """(person_id, entity_id): entity_id is the least person_id of those whose names mean the same."""
    e = materialise(name_entities(people, forms).distinct(), "entities")
    least = e.groupBy("entity").agg(F.min("person_id").alias("entity_id"))
    return e.join(least, "entity").select("person_id", "entity_id").distinct()


def same_name_pairs(people: DataFrame, forms: DataFrame) -> DataFrame:
    """(person_id_a, person_id_b), a < b in binary order: different ids whose names mean the same person or organisation."""
    e = materialise(name_entities(people, forms).distinct(), "entities")
    a, b = e.alias("a"), e.alias("b")
    return a.join(b, (F.col("a.entity") == F.col("b.entity")) & (F.col("a.person_id") < F.col("b.person_id"))).select(
        F.col("a.person_id").alias("person_id_a"), F.col("b.person_id").alias("person_id_b")).distinct()
