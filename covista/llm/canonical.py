"""Visually identical text in one form.

The form is built segment by segment. A *quick check* tells which characters can
change under the canonicalisation: by Unicode's quick-check properties those whose
answer is No (they decompose) or Maybe (they may join what precedes), those that are
reordered, are invisible or look like another letter. Only runs of such characters,
widened by the character before them as boundary context, are rewritten, and the
results are spliced between the untouched stretches. Plain text costs one regex scan.

That context is enough: a run ends before a character of class 0 whose answer is Yes,
which nothing before it can change, and the character before a run is one too, so it
is the starter that the run's first marks belong to.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from covista.session import materialise

# Letters of other scripts that look like a Latin letter, after Unicode's public list of confusable characters.
LOOK_ALIKES = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Һ": "H", "Ӏ": "I", "Ԁ": "D", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ү": "y", "ѵ": "v", "Ѵ": "V", "ӏ": "l", "ԍ": "g",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J", "ο": "o", "ν": "v", "ρ": "p", "α": "a", "ι": "i", "γ": "y",
    "υ": "u", "σ": "o", "ϲ": "c", "ϳ": "j",
    # Armenian
    "Տ": "S", "Ս": "U", "Օ": "O", "Լ": "L", "ա": "w", "զ": "q", "հ": "h", "ո": "n", "ս": "u", "օ": "o", "ց": "g",
    "ք": "f", "ւ": "i", "յ": "j", "ռ": "n",
    # Latin and letter-like
    "ɑ": "a", "ɡ": "g", "ı": "i", "ɩ": "i", "ʋ": "u", "ᴄ": "c", "ᴏ": "o", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s",
    "ʏ": "y", "ƨ": "s",
    # Punctuation
    "‐": "-", "‑": "-", "‒": "-", "⁃": "-", "−": "-", "˗": "-",
    "’": "'", "‘": "'", "ʼ": "'", "ʹ": "'", "′": "'", "‛": "'",
    "․": ".", "‚": ",", "⁄": "/", "∕": "/", "´": "'", "ǃ": "!",
}
# Characters that show nothing (besides all of category Cf) and the kinds of compatibility form that look different.
INVISIBLE = "͏ᅟᅠ឴឵᠋᠌᠍᠏ㅤﾠ"
# Blocks without any unstable character (ideographs, Hangul syllables, surrogates, private use, unassigned planes).
STABLE_BLOCKS = ((0x3400, 0x9FFF), (0xAC00, 0xF8FF), (0x12000, 0x1342F), (0x14400, 0x160FF), (0x17000, 0x1AFFF), (0x20000, 0x2F7FF), (0x2FA20, 0xDFFFF))
VISIBLE_KINDS = ("<super>", "<sub>", "<circle>", "<square>", "<fraction>", "<vertical>")
# Alphabets (first words of the characters' names) whose letters have shapes of Latin ones.
ALPHABETS = {"LATIN", "GREEK", "CYRILLIC", "ARMENIAN", "COPTIC", "CHEROKEE", "LISU", "CANADIAN", "DESERET", "OSAGE", "TIFINAGH", "RUNIC",
             "OLD", "LYCIAN", "CARIAN", "LYDIAN", "ELBASAN"}
#: A blank that isn't of the white-space property.
BLANK = "\u2800"


def _invisible(c: str) -> bool:
    return unicodedata.category(c) == "Cf" or c in INVISIBLE or 0xFE00 <= ord(c) <= 0xFE0F or 0xE0100 <= ord(c) <= 0xE01EF


def _blank(c: str) -> bool:
    return c.isspace() or c == BLANK


def _open_code_points(end: int) -> list[int]:
    """Code points below ``end`` that aren't ASCII and lie in no stable block."""
    out, at = [], 0x80
    for a, b in (*STABLE_BLOCKS, (0xE0200, 0x10FFFF)):
        out += range(at, min(a, end))
        at = max(at, b + 1)
    return out


@lru_cache(maxsize=2)
def _maybe(end: int) -> frozenset:
    """Characters below ``end`` whose quick check for NFC is Maybe: the second one of a pair that composes, and the Hangul vowels and finals."""
    out = {*map(chr, range(0x1161, 0x1176)), *map(chr, range(0x11A8, 0x11C3))}
    for c in map(chr, _open_code_points(end)):
        d = unicodedata.decomposition(c)
        if " " in d and d[0] != "<" and unicodedata.is_normalized("NFC", c):
            out.add(chr(int(d.split()[1], 16)))
    return frozenset(out)


class Canonicaliser:
    """Texts in canonical form, with a table of look-alike letters (character to character)."""

    def __init__(self, table: dict[str, str] | None = None):
        self.letters = dict(LOOK_ALIKES if table is None else table)
        self.table = {ord(k): v for k, v in self.letters.items()}
        self._runs: dict[int, re.Pattern] = {}

    def stable(self, c: str) -> bool:
        """Quick check: c is left alone by the canonicalisation whatever stands beside it."""
        if ord(c) < 128:
            return True
        if unicodedata.decomposition(c).startswith(VISIBLE_KINDS):
            return True
        return not (
            c in self.letters or unicodedata.combining(c) or c in _maybe(0x10000 if c < "\U00010000" else 0xE0200)
            or _invisible(c) or _blank(c) or not unicodedata.is_normalized("NFKC", c)
            or any(x in self.letters for x in unicodedata.normalize("NFKD", c))
        )

    def runs(self, end: int) -> re.Pattern:
        """Runs of unstable characters below ``end``: of the basic plane alone, a set is one table lookup a character."""
        if end not in self._runs:
            bad = [cp for cp in _open_code_points(end) if unicodedata.category(chr(cp)) != "Cn" and not self.stable(chr(cp))]
            first = [cp for i, cp in enumerate(bad) if not i or bad[i - 1] != cp - 1]
            last = [cp for i, cp in enumerate(bad) if i + 1 == len(bad) or bad[i + 1] != cp + 1]
            self._runs[end] = re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in zip(first, last)) + "]+")
        return self._runs[end]

    def segment(self, run: str) -> str:
        s = "".join(c for c in run if not _invisible(c))
        # some look-alikes have a compatibility form of another look, so the table comes before it as well
        s = unicodedata.normalize("NFKD", unicodedata.normalize("NFD", s).translate(self.table)).translate(self.table)
        return unicodedata.normalize("NFC", "".join(" " if _blank(c) else c for c in s))

    def canonical(self, text: str) -> str:
        """``text`` in the one form that all texts of the same look share. Line breaks and tabs (ASCII) stay."""
        if text.isascii():
            return text
        out, done = [], 0
        for m in self.runs(0x10000 if max(text) < "\U00010000" else 0xE0200).finditer(text):
            # boundary context: the stable character before a run, which a combining mark may join
            start = max(done, m.start() - 1)
            if start < m.start() and unicodedata.decomposition(text[start]).startswith(VISIBLE_KINDS):
                start = m.start()
            out += (text[done:start], self.segment(text[start : m.end()]))
            done = m.end()
        return "".join(out) + text[done:] if out else text

    def look(self, text: str) -> str:
        """Canonical form of a label: white space at the ends dropped, each run of it one space."""
        return " ".join(self.canonical(text).split())


_DEFAULT = Canonicaliser()
canonical, look = _DEFAULT.canonical, _DEFAULT.look
_stable, _segment = _DEFAULT.stable, _DEFAULT.segment


def look_alikes(spark: SparkSession) -> dict[str, str]:
    """LOOK_ALIKES and every other letter that Unicode's list of confusable characters gives the shape of a Latin letter of its case.

    The list is read from the ICU library that Spark brings along. Letters of the alphabets
    named above count (a shape of a syllable sign or an ideograph is no Latin letter); of
    the shapes that Latin letters share, l and I, the case decides.
    """
    out = dict(LOOK_ALIKES)
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    shapes = {checker.getSkeleton(x): x for x in map(chr, range(0x41, 0x7B)) if x.isalpha() and x != "I"}
    letters = [c for c in map(chr, range(0xA0, 0x20000)) if unicodedata.category(c) in ("Lu", "Ll", "Lo")
               and unicodedata.name(c, "").split(" ", 1)[0] in ALPHABETS and unicodedata.is_normalized("NFKC", c)]
    for c, k in zip(letters, checker.getSkeleton("\n".join(letters)).split("\n")):
        x, kind = shapes.get(k), unicodedata.category(c)
        if x == "l" and kind != "Ll":
            x = "I"
        if x and (kind == "Lo" or x.isupper() == (kind == "Lu")):
            out.setdefault(c, x)
    return out


_wide: dict = {}


def whole_list(spark: SparkSession) -> Canonicaliser:
    """The canonicaliser over the whole list, made once an application on the driver."""
    app = spark.sparkContext.applicationId
    if app not in _wide:
        _wide.clear()
        made = Canonicaliser(look_alikes(spark))
        made.runs(0x10000), made.runs(0xE0200)  # compiled here, not by each executor
        _wide[app] = made
    return _wide[app]


def _mapped(spark: SparkSession, method: str, c: Column | str) -> Column:
    shared = spark.sparkContext.broadcast(whole_list(spark))

    def run(s: pd.Series) -> pd.Series:
        return s.map(getattr(shared.value, method), na_action="ignore")

    return pandas_udf(run, "string")(c)


def look_of(c: Column | str) -> Column:
    """The form in which equal-looking labels are equal; null for null, '' for blank."""
    return _mapped(SparkSession.active(), "look", c)


def canonical_of(c: Column | str) -> Column:
    """Canonical form of a whole text, white space kept apart from its kind; null for null."""
    return _mapped(SparkSession.active(), "canonical", c)


def same_look_pairs(people: DataFrame) -> DataFrame:
    """(person_id_a, person_id_b) whose names differ as stored and look the same.

    ``people``: person_id, name (further columns are ignored). Repeated rows count
    once, null ids and null or blank names are no case. Letter case, spelling and real
    accents are visible differences; width, composition, invisible characters,
    look-alike letters and the kind and ends of white space are not. Equal stored names
    are no pair. All joins are by equality and their work is in proportion to the result.
    """
    # Forms are made once, in the tasks of the scan, and written: a filter or a distinct on them can't make them again.
    formed = people.select("person_id", "name").where(F.col("person_id").isNotNull() & F.col("name").isNotNull())
    named = materialise(formed.withColumn("look", look_of("name")), "looks").where("look <> ''").distinct()
    # Spellings are paired before people are: rows of equal stored names, however many, never meet each other.
    spelled = named.select("look", "name").distinct()
    a, b = spelled.alias("a"), spelled.alias("b")
    pairs = a.join(b, (F.col("a.look") == F.col("b.look")) & (F.col("a.name") < F.col("b.name"))).select(
        F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b"))
    left = pairs.join(named.select(F.col("name").alias("name_a"), F.col("person_id").alias("x")), "name_a")
    both = left.join(named.select(F.col("name").alias("name_b"), F.col("person_id").alias("y")), "name_b").where("x <> y")
    return both.select(F.least("x", "y").alias("person_id_a"), F.greatest("x", "y").alias("person_id_b")).distinct()
