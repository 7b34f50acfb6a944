"""Tokens, leaks and subjects."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from covista.llm import leaks, subjects, tokens
from covista.sources.tables import table
from tests.conftest import rows

FILE = f"{tokens.DEFAULT_FOLDER}/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def encoder():
    try:
        return tokens.load_encoder(open(FILE, "rb").read())
    except OSError:
        pytest.skip("no tokenizer files here")


def test_against_other_library(spark, data, encoder):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    docs = table(spark, data, "documents")
    got = {r.doc_id: r.ids for r in tokens.encode_corpus(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert got.keys() == texts.keys()
    for i, x in texts.items():
        assert got[i] == (t.encode(x, add_special_tokens=False).ids if x else [])


@settings(max_examples=200)
@given(st.text(st.sampled_from("ab 1\n\t é漢.'!<|endoftext|>"), max_size=80), st.integers(1, 20))
def test_pieces(encoder, text, limit):
    pieces = tokens.safe_pieces(text, limit)
    assert "".join(pieces) == text
    assert tokens.encode_text(encoder, text, limit) == encoder.encode_ordinary(text)
    assert tokens.decode_ids(encoder, encoder.encode_ordinary(text)) == text.encode()


def test_token_edges(spark, encoder):
    r = [(1, None, 0), (2, "", 0), (3, "<|endoftext|>", 0), (3, "<|endoftext|>", 0), (None, "a", 0), (4, "x" * 200_000, 0), (5, "w " * 60_000, 0)]
    df = spark.createDataFrame(r, "doc_id long, text string, ids int")
    got = sorted(((r.doc_id, r.ids) for r in tokens.encode_corpus(df).collect()), key=lambda x: (x[0] or 0, len(x[1])))
    assert len(got) == 7 and got[1:3] == [(1, []), (2, [])] and got[3] == got[4] and 50256 not in got[3][1]
    assert tokens.decode_ids(encoder, got[5][1]) == b"x" * 200_000 and tokens.decode_ids(encoder, got[6][1]) == b"w " * 60_000
    assert tokens.encode_corpus(df.limit(0)).count() == 0


# --- leaks ---


def test_words():
    assert leaks.words("<p>It&rsquo;s  a <b>Bicyсle</b>-race_no. ４2</p>\r\n[see](http://x/y) ** b​ird") == [
        "it", "s", "a", "bicycle", "race", "no", "42", "see", "bird"]


@pytest.mark.parametrize("text, want", [
    ("if a <b and c then d> e", "if a b and c then d e"), ("x < y and y > z", "x y and y z"), ('<a href="u" data-x=1 hidden>t</a >', "t"), ("<br/>a<br />b", "a b"),
    ("<!-- a\nb -->c<!DOCTYPE html>", "c"), ("<input disabled checked>k", "k"), ("<td nowrap class='x y'>k", "k"), ("a <3 b> c", "a 3 b c")])
def test_markup_and_plain_words(text, want):
    assert leaks.words(text) == want.split()


def _brute(doc, items, least):
    runs = {tuple(doc[i : i + least]) for i in range(len(doc) - least + 1)}
    return {k for k, ws in items if any(tuple(ws[i : i + least]) in runs for i in range(len(ws) - least + 1))}


def test_automaton_is_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        v = "abc"[: rng.randint(1, 3)]
        items = [(k, [rng.choice(v) for _ in range(rng.randint(0, 14))]) for k in range(rng.randint(1, 5))]
        least = rng.randint(1, 5)
        a = leaks.Automaton(items, least)
        for _ in range(5):
            doc = [rng.choice(v + "z") for _ in range(rng.randint(0, 25))]
            assert a.items_in(doc) == _brute(doc, items, least)
            longest = max([0, *(e - s for s, e, _ in a.spans(doc))])
            assert longest == max([0, *(n for n in range(least, 15) if _brute(doc, items, n))])


def test_leaks_on_tables(spark, data):
    docs, items = table(spark, data, "documents"), table(spark, data, "eval_items")
    its = [(r.item_id, leaks.words(r.item_text)) for r in items.collect()]
    want = sorted(((r.doc_id, k) for r in docs.where("text is not null").collect() for k in _brute(leaks.words(r.text), its, 12)), key=repr)
    assert want and rows(leaks.leaked_items(docs, items)) == want
    assert rows(leaks.leaked_items(docs, items, limit=500)) == want  # several automata
    assert rows(leaks.leaked_items(docs, items, pass_bytes=10_000)) == want  # several passes


def test_leak_edges(spark):
    text = " ".join(f"w{i}" for i in range(30))
    items = spark.createDataFrame([(1, text), (1, text), (2, "w1 w2"), (None, text), (3, None), (4, "")], "item_id long, item_text string")
    r = [(1, "X " + text.upper(), 0), (1, "X " + text.upper(), 0), (2, None, 0), (3, "", 0), (None, text, 0), (4, " ".join(text.split()[5:16]), 0),
         (5, "n " * 100_000 + "<i>" + text.replace(" ", "<br>\n"), 0), (6, " ".join(text.split()[5:17]), 0)]
    docs = spark.createDataFrame(r, "doc_id long, text string, item_id int")
    assert rows(leaks.leaked_items(docs, items)) == [(1, 1), (5, 1), (6, 1)]
    assert leaks.leaked_items(docs.limit(0), items).count() == 0 and leaks.leaked_items(docs, items.limit(0)).count() == 0
    clean = {r.doc_id: r for r in leaks.without_leaks(docs, items).collect()}
    assert clean[1].clean_words == ["x"] and clean[1].dropped and not clean[5].dropped and clean[5].leaked_words == 30


# --- subjects ---

NOUNS = {"sea": "boat anchor sail harbour mast tide".split(), "farm": "cow barn plough hay tractor field".split(), "court": "judge verdict trial jury clerk field".split()}
FORMS = ["the {0} and the {1} are both here", "somebody saw a {0} near the {1}", "talk of the {0} went on and on with the {1}"]
PLAIN = ["names are shown later", "the print is torn", "no name was given for the person", "see also the contact sheet"]


def corpus(n, seed):
    rng, out = random.Random(seed), []
    for i in range(n):
        subs = rng.sample(sorted(NOUNS), rng.choice([1, 1, 2]) if i % 5 else 0)
        s = [rng.choice(FORMS).format(*rng.sample(NOUNS[x], 2)) for x in subs for _ in range(rng.randint(2, 4))]
        s += [rng.choice(PLAIN) for _ in range(rng.randint(2, 5))]
        other = rng.choice(sorted(NOUNS))
        if rng.random() < 0.3 and other not in subs:
            s.append(f"a poster for a {rng.choice(NOUNS[other])} hangs in the back")
        rng.shuffle(s)
        out.append((i, ". ".join(x.capitalize() for x in s) + ".", set(subs)))
    return out


def test_sentences():
    assert subjects.sentences("Dr. K. Ann saw it. <p>No 12 a\nb?</p> c") == [["dr", "k", "ann", "saw", "it"], ["no", "0", "a"], ["b"], ["c"]]


def test_subjects_held_out(spark):
    fit, held = corpus(500, 1), corpus(300, 2)
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in fit] + [(10_000 + i, t, None) for i, t, _ in held] + [(None, "x", "en"), (20_000, None, None), (20_001, "", "en")],
                                 "doc_id long, text string, lang string")
    wrong = [(i, "sea") for i, _, s in fit if s and i % 50 == 1]
    labels = spark.createDataFrame([(i, x) for i, _, s in fit for x in s] + wrong + [(1, None), (None, "sea"), (99_999, "sea")], "doc_id long, subject string")
    subs = spark.createDataFrame([(s, s) for s in NOUNS] + [("sea", "again"), (None, "x")], "subject string, description string")
    got = {(r.doc_id - 10_000, r.subject) for r in subjects.document_subjects(docs, labels, subs).collect() if 10_000 <= r.doc_id < 20_000}
    want = {(i, x) for i, _, s in held for x in s}
    assert len(got & want) / len(got) > 0.93 and len(got & want) / len(want) > 0.93
    assert subjects.document_subjects(docs.limit(0), labels, subs).count() == 0
    assert subjects.document_subjects(docs, labels.limit(0), subs).count() == 0


def test_sample_holds_whole_documents(spark, monkeypatch):
    late = "the print is torn. " * 1200 + "a late zeppelin is here. " * 5
    docs = spark.createDataFrame([(i, late, "en") for i in range(10)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, "air") for i in range(10)], "doc_id long, subject string")
    subs = spark.createDataFrame([("air", "x")], "subject string, description string")
    assert "zeppelin" in subjects.fit_subjects(docs, labels, subs).vocab
    seen = []
    monkeypatch.setattr(subjects, "sentences", lambda t: seen.append(t) or [["a"]])
    monkeypatch.setattr(subjects, "SAMPLE_BYTES", 3 * len(late) + 10)
    subjects.fit_subjects(docs, labels, subs)
    assert seen == [late] * 3


def test_too_many_subjects(spark):
    subs = spark.range(1001).selectExpr("cast(id as string) subject", "'x' description")
    none = spark.createDataFrame([], "doc_id long, text string, lang string, subject string")
    with pytest.raises(ValueError):
        subjects.fit_subjects(none, none, subs)
