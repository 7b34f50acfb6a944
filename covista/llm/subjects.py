"""Subject areas of documents, by subject-specific interpolated n-gram language models.

A labelled document mixes sentences about its subjects with sentences about nothing
in particular, so the models are fitted by expectation-maximisation: each sentence of
a labelled document belongs to one of the document's subjects or to the background,
and every model is an interpolated bigram model of the sentences that are its own. A
sentence is then about the subject of least cross-entropy if that is, per token, enough
below the cross-entropy under the background model (both with the code length of the
document's own mixture) and the other models leave it enough of the sentence; a document
is about every subject that two or more of its sentences are about. How much is enough
is calibrated on labelled documents held out from fitting, the gain over the background
for each subject.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.llm.canonical import canonical
from covista.llm.leaks import _LINK, _TAG, _WORD

#: Labelled documents that the models are fitted on, at most (the bound of what reaches the driver).
SAMPLE_DOCUMENTS = 12_000
#: Bytes of text in the sample, at most: whole documents in the order of their hash, those passed over that don't fit any more.
SAMPLE_BYTES = 64 * 2**20
#: Subjects beyond this number aren't taken.
MAX_SUBJECTS = 1000
#: Of the sample, one document in so many is held out for the calibration.
HOLD_OUT = 5
#: Words and bigrams seen less often are left to the lower order.
LEAST_WORD, LEAST_BIGRAM = 3, 3
MAX_WORDS, MAX_BIGRAMS = 60_000, 200_000
#: Pseudo-counts that interpolate bigrams with the unigram part (at least, and a fitted document: template words precede
#: ever more nouns as the sample grows), and the share of the uniform part.
BACK_OFF, BACK_OFF_A_DOCUMENT, UNIFORM = 8.0, 0.004, 0.02
ROUNDS = 6
#: Sentences about a subject that make a document be about it.
LEAST_SENTENCES = 2
#: Rounds and pseudo-sentences of the document's own mixture.
MIX_ROUNDS, MIX_WEIGHT = 3, 4.0
#: What is taken for as good as the best F1 of a subject.
NEARLY = 0.003

_END = re.compile(r"(?<=[.?!。])[\"'”»)*_]*\s+|[\r\n]+")
_NO_END = re.compile(r"(?:\b[^\W\d_]|\b(?:Dr|Mr|Mrs|Ms|Prof|Co|Ltd|Inc|Assoc|Soc|Intl|Grp|No|St))\.$", re.I)


def sentences(text: str) -> list[list[str]]:
    """Words of each sentence or line: canonical, lower case, without markup; whatever holds a digit is '0'."""
    if "<" in text:
        text = _TAG.sub("\n", text)
    if "&" in text:
        text = html.unescape(text)
    if "](" in text:
        text = _LINK.sub(r"\1", text)
    out, held = [], ""
    for part in _END.split(canonical(text)):
        held = f"{held} {part}" if held else part
        # only the last word decides: the pattern needs at most its letters and the full stop
        if held.endswith(".") and _NO_END.search(held, max(0, len(held) - 8)):
            continue
        ws = [w if w.isalpha() else "0" for w in _WORD.findall(held.lower())]
        if ws:
            out.append(ws)
        held = ""
    ws = [w if w.isalpha() else "0" for w in _WORD.findall(held.lower())]
    if ws:
        out.append(ws)
    return out


@dataclass
class SubjectModel:
    """Log-probabilities by model (row 0: background) for words and for known bigrams."""

    subjects: list[str]
    vocab: dict[str, int]
    uni: np.ndarray  # words x models, log
    bigrams: np.ndarray  # sorted codes: previous word x size + word
    bi: np.ndarray  # bigrams x models, log of the interpolated probability
    back: np.ndarray  # words x models, log weight of the unigram part after a word
    prior: np.ndarray  # models, log
    threshold: np.ndarray | float = 0.0  # of each subject, nats a token below the background's cross-entropy
    share: float = 0.5  # of a sentence that its subject must have among all models
    back_off: float = BACK_OFF

    def encode(self, docs: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers of all sentences in a row, their sentence ends and the document of each sentence."""
        get, ids, ends, doc = self.vocab.get, [], [], []
        for d, ss in enumerate(docs):
            for ws in ss:
                ids.append(0)  # sentence start
                ids.extend([get(w, 1) for w in ws])
                ends.append(len(ids))
                doc.append(d)
        return np.array(ids, np.int64), np.array(ends, np.int64), np.array(doc, np.int64)

    def sentence_scores(self, ids: np.ndarray, ends: np.ndarray, at_once: int = 100_000) -> np.ndarray:
        """Log-likelihood of each sentence under each model; some sentences at a time, to bound memory."""
        out = np.zeros((len(ends), self.uni.shape[1]))
        cuts = np.unique(np.r_[np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, at_once)), len(ends)])
        for lo, hi in zip(np.r_[0, cuts[:-1]], cuts):
            if lo < hi:
                start = ends[lo - 1] if lo else 0
                out[lo:hi] = self._scores(ids[start : ends[hi - 1]], ends[lo:hi] - start)
        return out

    def _scores(self, ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
        code = ids[:-1] * len(self.vocab) + ids[1:]
        at = np.searchsorted(self.bigrams, code)
        at[at == len(self.bigrams)] = 0
        known = self.bigrams[at] == code if len(self.bigrams) else np.zeros(len(code), bool)
        lp = np.where(known[:, None], self.bi[at] if len(self.bigrams) else 0.0, self.uni[ids[1:]] + self.back[ids[:-1]])
        lp[ids[1:] <= 1] = 0.0  # sentence starts, and unknown words, which tell nothing
        total = np.vstack([np.zeros((2, lp.shape[1])), np.cumsum(lp, axis=0, dtype=np.float64)])
        return total[ends] - total[np.r_[0, ends[:-1]] + 1]

    def code_lengths(self, ids: np.ndarray, ends: np.ndarray, doc: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
        """Log-likelihood of each sentence and model together. A document's own mixture of subjects, found in turn with the shares, decides between subjects that share words."""
        s = self.sentence_scores(ids, ends)
        if allowed is not None:
            s = np.where(allowed, s, -np.inf)
        like = np.exp(s - s.max(axis=1, keepdims=True))
        base = np.exp(self.prior)
        mix = np.broadcast_to(base, like.shape)
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        size = np.diff(np.r_[first, len(doc)])
        for _ in range(MIX_ROUNDS):
            p = like * mix
            p /= p.sum(axis=1, keepdims=True)
            own = np.add.reduceat(p, first) + MIX_WEIGHT * base
            mix = np.repeat(own / own.sum(axis=1, keepdims=True), size, axis=0)
        return s + np.log(mix)

    def posteriors(self, ids: np.ndarray, ends: np.ndarray, doc: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
        """Share of each model in each sentence."""
        s = self.code_lengths(ids, ends, doc, allowed)
        p = np.exp(s - s.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def gains(self, ids: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(subject of least cross-entropy, how far that is below the background's, per token, its share among all models) of each sentence."""
        s = self.code_lengths(ids, ends, doc)
        best = s[:, 1:].argmax(axis=1)
        told = np.r_[0, np.cumsum(ids > 1)]
        tokens = told[ends] - told[np.r_[0, ends[:-1]]]
        own = s[np.arange(len(s)), best + 1]
        top = s.max(axis=1)
        return best, (own - s[:, 0]) / np.maximum(1, tokens), np.exp(own - top) / np.exp(s - top[:, None]).sum(axis=1)

    def counts(self, docs: list[list[list[str]]]) -> np.ndarray:
        """Documents x subjects: sentences about the subject."""
        out = np.zeros((len(docs), len(self.subjects)), np.int64)
        ids, ends, doc = self.encode(docs)
        if len(ends):
            best, gain, share = self.gains(ids, ends, doc)
            hit = (share >= self.share) & (gain >= np.broadcast_to(self.threshold, len(self.subjects))[best])
            np.add.at(out, (doc[hit], best[hit]), 1)
        return out


def _estimate(model: SubjectModel, ids: np.ndarray, ends: np.ndarray, post: np.ndarray, weight: np.ndarray | None = None) -> None:
    """Maximisation: every model from the sentences weighted by its share in them."""
    v, m = len(model.vocab), post.shape[1]
    sent = np.repeat(np.arange(len(ends)), np.diff(np.r_[0, ends]))
    share_of = lambda k: (post[:, k] if weight is None else post[:, k] * weight[:, k])[sent]
    real = ids > 1
    uni = np.zeros((v, m))
    code = ids[:-1] * v + ids[1:]
    ok = np.flatnonzero((ids[1:] > 1) & (ids[:-1] != 1))
    at = np.searchsorted(model.bigrams, code[ok])
    at[at == len(model.bigrams)] = 0
    hit = model.bigrams[at] == code[ok] if len(model.bigrams) else np.zeros(len(ok), bool)
    ok, at = ok[hit], at[hit]
    del code, hit
    big = np.zeros((len(model.bigrams), m))
    prev = np.zeros((v, m))
    for k in range(m):
        w = share_of(k)
        uni[:, k] = np.bincount(ids[real], weights=w[real], minlength=v)
        big[:, k] = np.bincount(at, weights=w[ok + 1], minlength=len(big))
        prev[:, k] = np.bincount(ids[:-1], weights=w[1:], minlength=v)
    whole = uni.sum(axis=1, keepdims=True)
    # a subject's unigrams are drawn towards the corpus's as a whole, which leave template words without weight
    shared = (whole + 0.1) / (whole + 0.1).sum()
    p = (uni + 200.0 * shared) / (uni.sum(axis=0) + 200.0)
    p = (1 - UNIFORM) * p + UNIFORM / v
    b1, b2 = model.bigrams // v, model.bigrams % v
    model.uni = np.log(p)
    model.back = np.log(model.back_off / (prev + model.back_off))
    model.bi = np.log((big + model.back_off * p[b2]) / (prev[b1] + model.back_off)) if len(big) else big
    share = post.sum(axis=0) + 1.0
    model.prior = np.log(share / share.sum())


def fit(docs: list[list[list[str]]], labels: list[set[str]], subjects: list[str], langs: list[str] | None = None,
        rounds: int = ROUNDS) -> SubjectModel:
    """Models of sentences; docs as of ``sentences``, labels the subjects of each document.

    With ``langs``, documents are weighted so that every subject has the same mixture of
    languages: which language a text is in must tell nothing about its subject.
    """
    from collections import Counter

    words = Counter(w for d in docs for s in d for w in s)
    vocab = {"": 0, "\0": 1}
    for w, c in sorted(words.items(), key=lambda x: (-x[1], x[0]))[:MAX_WORDS]:
        if c >= LEAST_WORD:
            vocab[w] = len(vocab)
    m = len(subjects) + 1
    v = len(vocab)
    model = SubjectModel(subjects, vocab, np.zeros((v, m)), np.zeros(0, np.int64), np.zeros((0, m)), np.zeros((v, m)), np.zeros(m))
    model.back_off = max(BACK_OFF, BACK_OFF_A_DOCUMENT * len(docs))
    ids, ends, doc = model.encode(docs)
    if not len(ends):
        return model
    code = ids[:-1] * v + ids[1:]
    code, n = np.unique(code[(ids[1:] > 1) & (ids[:-1] != 1)], return_counts=True)
    often = n >= LEAST_BIGRAM
    code, n = code[often], n[often]
    model.bigrams = np.sort(code[np.argsort(-n, kind="stable")[:MAX_BIGRAMS]])
    at = {s: i + 1 for i, s in enumerate(subjects)}
    may = np.zeros((len(docs), m), bool)
    may[:, 0] = True
    for d, ls in enumerate(labels):
        may[d, [at[x] for x in ls if x in at]] = True
    allowed = may[doc]
    weight = None
    if langs:
        kinds, lang = np.unique(np.array(langs), return_inverse=True)
        n = np.zeros((len(kinds), m))
        np.add.at(n, lang, may)
        n[:, 1:] = np.clip(n[:, 1:].mean(axis=1, keepdims=True) / np.maximum(n[:, 1:], 1.0), 0.2, 5.0)
        n[:, 0] = 1.0
        weight = n[lang][doc]
    # first round: half of each sentence to its document's subjects; the background gets what all documents share
    post = np.where(allowed, 1.0, 0.0)
    post[:, 1:] *= 1.0 / np.maximum(1, allowed[:, 1:].sum(axis=1, keepdims=True))
    for r in range(rounds):
        _estimate(model, ids, ends, post, weight)
        if r == 0:
            model.prior = np.full(m, np.log(1.0 / m))
        post = model.posteriors(ids, ends, doc, allowed)
    _estimate(model, ids, ends, post, weight)
    # a priori all subjects are alike: what a label sample holds most of must not decide
    p = np.exp(model.prior)
    model.prior = np.log(np.r_[p[0], np.full(m - 1, (1 - p[0]) / max(1, m - 1))])
    return model


def calibrate(model: SubjectModel, docs: list[list[list[str]]], labels: list[set[str]], least: int = LEAST_SENTENCES) -> float:
    """Set the share and each subject's threshold to what gives the best F1 on held-out documents; returns the F1 of all together.

    A document counts for a subject if its ``least``-th best sentence reaches the threshold, so every such gain is tried. The
    lowest one that is nearly as good as the best is taken, at least 0: a wrong label or two decide nothing.
    """
    ids, ends, doc = model.encode(docs)
    model.threshold, model.share = np.zeros(len(model.subjects)), 0.5
    if not len(ends):
        return 0.0
    best, gain, share = model.gains(ids, ends, doc)
    truth = np.array([[s in ls for s in model.subjects] for ls in labels])

    def nth_gains(t: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, subject, gain of its least-th best sentence) of the sentences with a share of t."""
        on = np.flatnonzero((share >= t) & (gain >= 0))
        order = on[np.lexsort((-gain[on], doc[on], best[on]))]
        d, k, g = doc[order], best[order], gain[order]
        start = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (k[1:] != k[:-1])]) if len(d) else np.zeros(0, np.int64)
        nth = start[np.diff(np.r_[start, len(d)]) >= least] + least - 1
        return d[nth], k[nth], g[nth]

    def f1(d: np.ndarray, k: np.ndarray) -> float:
        return 2 * truth[d, k].sum() / max(1, len(d) + truth.sum())

    model.share = max((0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98), key=lambda t: f1(*nth_gains(t)[:2]))
    d, k, g = nth_gains(model.share)
    for i in range(len(model.subjects)):
        o = np.flatnonzero(k == i)
        o = o[np.argsort(-g[o], kind="stable")]
        if len(o):
            good = 2 * np.cumsum(truth[d[o], i]) / (np.arange(1, len(o) + 1) + truth[:, i].sum())
            last = np.flatnonzero(good >= good.max() - NEARLY)[-1]
            # no sentence was seen between this gain and the next lower one
            model.threshold[i] = (g[o][last] + g[o][last + 1]) / 2 if last + 1 < len(o) else 0.0
    said = g >= model.threshold[k]
    return f1(d[said], k[said])


def fit_subjects(docs: DataFrame, labels: DataFrame, subjects: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> SubjectModel:
    """Models from a bounded sample of the labelled documents (the least ``sample`` by hash of the id, whole)."""
    names = sorted(r[0] for r in subjects.select("subject").where("subject is not null").distinct().limit(MAX_SUBJECTS + 1).collect())
    if len(names) > MAX_SUBJECTS:
        raise ValueError("the subjects are beyond their stated bound")
    known = labels.select("doc_id", "subject").where("doc_id is not null and subject is not null").distinct()
    ids = known.select("doc_id").distinct().withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(sample)
    # no more ids than the sample holds, so they are broadcast and the texts stay where they are; of one id given twice one text is taken
    whole = docs.select("doc_id", "text", F.lower(F.trim("lang")).alias("lang")).where("text is not null")
    sizes = whole.select("doc_id", F.octet_length("text").alias("size")).join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(
        F.max("size").alias("size"), F.min("h").alias("h")).collect()
    taken, room = [], SAMPLE_BYTES
    for r in sorted(sizes, key=lambda r: (r.h, r.doc_id)):
        if r.size <= room:
            taken.append((r.doc_id, r.h))
            room -= r.size
    ids = docs.sparkSession.createDataFrame(taken, ids.schema)
    text = (
        whole.join(F.broadcast(ids), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.min("h").alias("h"), F.min("lang").alias("lang"))
    )
    by_doc = known.join(ids.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id").agg(F.collect_set("subject").alias("ls"))
    rows = sorted(text.join(by_doc, "doc_id").select("h", "doc_id", "text", "ls", "lang").collect(), key=lambda r: (r.h, r.doc_id))
    parsed = [sentences(r.text) for r in rows]
    truth = [set(r.ls) for r in rows]
    held = [i for i in range(len(rows)) if i % HOLD_OUT == 0]
    fitted = [i for i in range(len(rows)) if i % HOLD_OUT]
    model = fit([parsed[i] for i in fitted], [truth[i] for i in fitted], names,
                [rows[i].lang or "" for i in fitted])
    calibrate(model, [parsed[i] for i in held], [truth[i] for i in held])
    return model


def subject_counts(docs: DataFrame, model: SubjectModel) -> DataFrame:
    """(doc_id, subject, sentences): how many sentences of each document are about a subject, 1 or more.

    Texts are read whole; null and empty texts give no row. The model is broadcast:
    its size is bounded by MAX_WORDS and MAX_BIGRAMS. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        m = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                part = b.slice(lo, 2000)
                n = m.counts([sentences(t) for t in part.column(1).to_pylist()])
                d, s = np.nonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(d)), pa.array([m.subjects[i] for i in s], pa.string()),
                     pa.array(n[d, s])], names=["doc_id", "subject", "sentences"])

    return docs.select("doc_id", "text").where("text is not null and doc_id is not null").mapInArrow(
        run, f"doc_id {kind}, subject string, sentences long")


def document_subjects(docs: DataFrame, labels: DataFrame, subjects: DataFrame, least: int = LEAST_SENTENCES) -> DataFrame:
    """(doc_id, subject) of every document with two or more sentences about the subject; none gives no row.

    A document given twice under one id gives its pairs once. Labels of unknown
    subjects or documents, null and repeated ones are passed over; without labels no
    document gets a subject.
    """
    model = fit_subjects(docs, labels, subjects)
    return subject_counts(docs, model).where(F.col("sentences") >= least).select("doc_id", "subject").distinct()
