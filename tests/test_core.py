"""Operators of the engine on small hand-made tables: brute force, edge cases, invariants."""

import itertools
import json
from math import comb

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from covista.functions import documents, labels, markup, urls
from covista.model import ATLAS, METADATA, STATE_V2, SiteConfig
from covista.operators import atlas, cooc, directory, graph, membership, pages, routing, state
from covista.sources import files
from tests.conftest import rows

PEOPLE = [("person_10", "Alpha One", "f1", 1, "named"), ("person_2", None, "f2", 1, "unknown"), ("person_3", "  ", None, 1, "unidentified"),
          ("x-4", "Bêta Ædan", None, 0, "ignored"), ("x-4", "Bêta Ædan", None, 0, "ignored"), (None, "Nobody", None, 1, "named")]
PEI = [("person_10", "a/L1.jpg"), ("person_10", " a/L1.jpg "), ("person_2", "\ta/L1.jpg\n"), ("person_2", None), ("person_3", ""),
       ("person_3", " 　"), ("zzz", "b.JPG"), (None, "c.jpg")]
CFG = SiteConfig()


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "person_id string, name string, best_face_id string, include_in_network int, person_class string")


@pytest.fixture(scope="module")
def pei(spark):
    return spark.createDataFrame(PEI, "person_id string, image_name string")


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(f(F.col("c"))).first()[0]


def test_membership(pei, people):
    assert rows(membership.membership_scan(pei)) == [("person_10", "a/L1.jpg"), ("person_2", "a/L1.jpg"), ("zzz", "b.JPG")]
    assert rows(membership.network_membership(pei, people)) == [("person_10", "a/L1.jpg"), ("person_2", "a/L1.jpg")]
    m = membership.membership_scan(pei)
    assert rows(membership.without_items_of(m, people.where("person_id = 'person_2'"))) == [("zzz", "b.JPG")]


def test_network_without_broadcast(pei, people, monkeypatch):
    monkeypatch.setattr(membership, "BROADCAST_ENTITIES", 1)
    assert rows(membership.network_membership(pei, people)) == [("person_10", "a/L1.jpg"), ("person_2", "a/L1.jpg")]


def test_summary_of_fixture(pei, people):
    m = membership.network_membership(pei, people)
    r = cooc.run_summary(m, membership.network_entities(people), 3).first()
    assert (r.in_network, r.generated, r.skipped_empty) == (3, 3, 4)


@settings(max_examples=8, deadline=None)
@given(st.sets(st.tuples(st.sampled_from("abcdef"), st.sampled_from("123456")), max_size=25))
def test_cooccurrence_is_brute_force(spark, pairs):
    m = spark.createDataFrame(sorted(pairs), "person_id string, image_name string")
    sets = {e: {i for x, i in pairs if x == e} for e, _ in pairs}
    want = {}
    for k in (1, 2, 3):
        for c in itertools.combinations(sorted(sets), k):
            common = set.intersection(*(sets[e] for e in c))
            if common:
                want[c] = (len(common), min(common))
    got = {tuple(r.ids): (r.image_total, r.first_item) for r in cooc.combinations(m, 3).collect()}
    assert got == want
    ents = m.select("person_id").distinct()
    s = cooc.run_summary(m, ents, 3).first()
    assert s.generated + s.skipped_empty == sum(comb(len(sets), k) for k in (1, 2, 3))
    assert cooc.common_items(m, []).count() == 0


def test_bad_k(pei):
    with pytest.raises(ValueError):
        cooc.cooccur(pei, 0)
    with pytest.raises(ValueError):
        SiteConfig(max_k=0)


def test_headings(spark, people):
    h = lambda ls: one(spark, ls, labels.heading, "array<string>")
    assert [h([]), h(["A"]), h(["A", "B"]), h(["A", "B", "C"])] == ["Photos", "Photos of A", "Photos of A and B", "Photos of A, B, and C"]
    d = lambda n: spark.createDataFrame([(n,)], "n long").select(labels.meta_description(F.lit("H"), F.col("n"), "S")).first()[0]
    assert (d(0), d(1)) == ("H on S.", "H — 1 images on S.")
    p = spark.createDataFrame([(["person_10", "person_2", "gone"], 4)], "ids array<string>, image_total long")
    r = pages.headings(p, membership.network_people(people), CFG).first()
    assert r.heading == "Photos of Alpha One, person_2, and gone"


@pytest.mark.parametrize("raw, want", [("A/b: c", "Ab_c"), ("", "node"), ("//", "node"), ("é.1-_x", "é.1-_x")])
def test_file_label(spark, raw, want):
    assert one(spark, raw, labels.file_label) == want


def test_names(spark, people):
    got = {r[0]: r[1] for r in directory.entities(people).select("person_id", labels.display_name(F.col("person_id"), F.col("name"))).collect()}
    assert got == {"person_10": "Alpha One", "person_2": "Person 2", "person_3": "Person 3", "x-4": "Bêta Ædan"}
    assert one(spark, " L’Œuvre Šx ", labels.search_key) == "l'oeuvre sx"
    assert one(spark, None, labels.search_key) == ""
    assert one(spark, "person_99999999999999999999", labels.stub_number) is None
    assert [one(spark, n, labels.photo_label, "long") for n in (0, 1, 2)] == ["0 photos", "1 photo", "2 photos"]


@pytest.mark.parametrize("query, stripped, valid", [
    ("", "", True), ("d", "D", True), ("DOCX", "DOCX", True), ("docx12.pdf", "DOCX12", True), ("DOCX12-3.webp", "DOCX123", True),
    ("DOCX12.P", "DOCX12", True), ("DOCX1X", "DOCX1X", False), ("ALBUM_BOX_7", "ALBUM_BOX_7", True), ("ALBUM-BOX", "ALBUMBOX", False),
    ("abc.PDF", "ABC", False), ("DOCX1\n", "DOCX1", True), (None, "", True)])
def test_document_terms(spark, query, stripped, valid):
    p = ("DOCX", "ALBUM_BOX_")
    assert one(spark, query, lambda c: documents.term(c, p)) == stripped
    assert one(spark, query, lambda c: documents.may_become_id(c, p)) is valid


def test_urls(spark):
    assert one(spark, "a b*~!'()é/", urls.quote) == "a%20b%2A~%21%27%28%29%C3%A9%2F"
    assert one(spark, "a b*~!'()é/", urls.quote_component) == "a%20b*~!'()%C3%A9%2F"
    assert [one(spark, x, urls.unquote_component) for x in ("a%20b+c", "%zz")] == ["a b+c", "%zz"]
    assert [one(spark, x, urls.normal_path) for x in ("https://h", "https://h/a?b#c", "https://h/a/")] == ["/", "/a/", "/a/"]
    q = lambda u: one(spark, u, lambda c: urls.query_value(c, "photo"))
    assert [q(u) for u in ("h/?photo=a+b%2F", "h/?x=1&photo=", "h/?photo", "h/?xphoto=1", "h/#?photo=1")] == ["a b/", "", "", None, None]
    assert one(spark, [" b", None, "", "a "], urls.people_url, "array<string>") == "/search/people/a-b/"
    assert one(spark, ["", None], urls.people_url, "array<string>") is None
    base = "https://c/"
    assert [one(spark, x, lambda c: urls.cdn_asset(c, base)) for x in ("HTTP://x/y", "//a/b", "", None)] == ["HTTP://x/y", "https://c/a/b", None, None]
    assert one(spark, "a/b.c.jpg", lambda c: urls.cdn_thumbnail(c, base)) == "https://c/thumbnails/b.c.webp"
    assert one(spark, "x/a.jpg.jpg ", lambda c: urls.cdn_image_published(c, "https://c")) == "https://c/images/a.webp.webp"
    assert [one(spark, x, lambda c: urls.cdn_image_requested(c, base)) for x in ("x/a.jpg.JPG", "a/", " ")] == [
        "https://c/images/a.jpg.webp", "https://c/images/a%2F", None]


def test_inject(spark):
    tag = '<meta property="og:image" content="x">'
    cases = [(1, f"<head>{tag}{tag}</head></HEAD>"), (2, "<p>none</p>"), (3, '<head><meta content="x" property="og:image"/></head>')]
    out = {r.id: r.html for r in markup.inject_image(
        spark.createDataFrame(cases, "id int, html string"), "html", F.lit('i"$1&')).collect()}
    assert out[1].count('content="i&quot;$1&amp;"') == 3 and out[1].count(tag) == 1
    assert out[2] == "<p>none</p>"
    assert '<meta property="og:image" content="i&quot;$1&amp;" />\n</head>' in out[3].replace('  <meta property="og:image:secure_url"', "~", 1).split("~")[0] + "</head>"
    same = markup.inject_image(spark.createDataFrame(cases, "id int, html string"), "html", F.lit(None).cast("string"))
    assert {r.html for r in same.collect()} == {h for _, h in cases}


def test_routes(spark):
    r = [(1, "POST", "https://h/search/people/a/", 200, "text/html"), (2, "GET", "https://h/search/document/%zz/?photo=p.jpg", None, None),
         (3, "GET", "https://h/search/document/a%20b", 500, None), (4, "GET", "https://h/search/people/a/x/?photo=p.jpg", 200, "text/html; c"),
         (5, "GET", "https://h/search/people/a?photo=p.jpg", 200, "image/png"), (6, "GET", "https://h/search/people/a", 404, None),
         (7, "GET", "https://h/about/", 200, None), (8, None, None, None, None)]
    df = spark.createDataFrame(r, "request_id long, http_method string, url string, upstream_status int, content_type string")
    got = {x.request_id: (x.route, x.action, x.doc_id, x.status) for x in routing.route(df, CFG).collect()}
    assert got == {1: ("other", "pass", None, 200), 2: ("document", "shell", "%zz", 200), 3: ("document", "shell_lookup", "a b", 200),
                   4: ("people", "inject", None, 200), 5: ("people", "pass", None, 200), 6: ("people", "shell", None, 200),
                   7: ("other", "pass", None, 200), 8: ("other", "pass", None, None)}


def test_nav(spark):
    p = spark.createDataFrame([("/",), ("/search/people/x/",), ("/nowhere",)], "path string")
    assert dict(rows(routing.active_link(p, CFG))) == {"/": "/", "/search/people/x/": "/search/", "/nowhere": None}


def _doc(spark, text):
    return spark.createDataFrame([(text,)], "value string").select(F.from_json("value", STATE_V2).alias("s")).select("s.*")


def test_state_versions(spark):
    v2 = '{"version":2,"entries":{"a-b":{"fingerprint":"1","lastmod":"2026-01-01"},"/":{"fingerprint":"m:1","lastmod":""}}}'
    v1 = '{"version":1,"urls":{"https://h/search/people/a-b":{"fingerprint":"x|y|7","lastmod":"2026-01-01"},"https://h":{"fingerprint":"m|2","lastmod":"d"}}}'
    assert rows(state.read_entries(_doc(spark, v2))) == [("/", "m:1", ""), ("a-b", "1", "2026-01-01")]
    assert rows(state.read_entries(_doc(spark, v1))) == [("/", "m|2", "d"), ("a-b", "7", "2026-01-01")]
    assert rows(state.read_entries(_doc(spark, v1.replace('"version":1,', "")))) == rows(state.read_entries(_doc(spark, v1)))
    assert rows(state.read_entries(_doc(spark, "{}"))) == []
    for bad in ('{"version":3,"entries":{}}', '{"version":2}', '{"version":2,"entries":{"a":{"fingerprint":"1"}}}',
                '{"version":1,"urls":{"https://h/other/":{"fingerprint":"1","lastmod":"d"}}}'):
        with pytest.raises(Exception):
            state.read_entries(_doc(spark, bad)).collect()


def test_merge_is_stable(spark):
    new = spark.createDataFrame([("n", "1"), ("c", "2"), ("u", "3"), ("b", "4")], "entry_key string, fingerprint string")
    old = spark.createDataFrame([("c", "1", "d0"), ("u", "3", "d1"), ("b", "4", ""), ("r", "9", "d2")], "entry_key string, fingerprint string, lastmod string")
    got = state.merge_lastmod(new, old, "T")
    assert rows(got) == [("b", "4", "T"), ("c", "2", "T"), ("n", "1", "T"), ("u", "3", "d1")]
    assert rows(state.merge_lastmod(new, got, "T2")) == rows(got)
    assert dict(rows(state.change_report(new, old))) == {"n": "new", "c": "changed", "u": "unchanged", "b": "unchanged", "r": "removed"}
    assert rows(state.removed_keys(new, old)) == [("r",)]


def test_sitemap_needs_lastmod(spark):
    locs = spark.createDataFrame([("https://h/b&",), ("https://h/a",)], "loc string")
    lm = spark.createDataFrame([("https://h/b&", "d"), ("https://h/a", "e")], "loc string, lastmod string")
    assert [r.loc for r in pages.sitemap_entries(locs, lm).collect()] == ["https://h/a", "https://h/b&"]
    with pytest.raises(Exception):
        pages.sitemap_entries(locs, lm.limit(1)).collect()


def test_heads(spark):
    meta = {"shared": {"site_origin": "https://h/", "twitter_card": "c"}, "pages": [{"out": "a", "title": "\"'<&>"}, {"out": "a"}]}
    df = spark.createDataFrame([(json.dumps(meta),)], "v string").select(F.from_json("v", METADATA).alias("m")).select("m.*")
    r = pages.metadata_rows(df)
    assert rows(pages.duplicate_outputs(r)) == [("a", 2)]
    with pytest.raises(Exception):
        pages.head_partials(r, "x").collect()


def test_assemble_missing(spark):
    recipe = spark.createDataFrame([("p", 0, "a"), ("p", 1, "b")], "page string, pos int, fragment string")
    with pytest.raises(Exception):
        pages.assemble(recipe, spark.createDataFrame([("a", "A")], "fragment string, text string")).collect()


def test_directory(people, pei):
    d = directory.directory(people, pei, ["named", "unknown", "nonsense"], cdn="https://c")
    assert [(r.person_id, r.photo_count) for r in directory.page(d, 10, 0).collect()] == [("person_10", 1), ("person_2", 1)]
    assert directory.page(d, 1, 1).first().person_id == "person_2"
    assert directory.directory(people, pei, []).count() == 0
    assert [r.person_id for r in directory.directory(people, pei, ["ignored"], "beta AED").collect()] == ["x-4"]


def test_graph(spark):
    m = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("a", "2"), ("b", "2")], "person_id string, image_name string")
    e = graph.edges(m)
    assert rows(e) == [("a", "b", 2), ("a", "c", 1), ("b", "c", 1)]
    assert dict(rows(graph.degree(e))) == {"a": 2, "b": 2, "c": 2}
    assert rows(graph.top_neighbours(e, 1)) == [("a", "b", 2, 1), ("b", "a", 2, 1), ("c", "a", 1, 1)]


def test_atlas(spark):
    k = spark.createDataFrame([(f"node_{i:03d}",) for i in range(10)] + [(None,), ("node_000",)], "k string")
    got = {r.key: (r.x, r.y) for r in atlas.pack(k, "k", 3, 100).collect()}
    assert got == {f"node_{i:03d}": (i % 3 * 100, i // 3 * 100) for i in range(10)}
    assert atlas.pack(k.limit(0), "k", 3, 100).count() == 0
    assert ATLAS.valueType.fieldNames() == ["x", "y", "w", "h"]


def test_files(spark, tmp_path):
    e = spark.createDataFrame([("b", "2", "d"), ("a", "1", "d")], "entry_key string, fingerprint string, lastmod string")
    where = str(tmp_path / "state")
    assert files.read_state(spark, where, must_exist=False).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_state(spark, where)
    files.write_state(e, where)
    assert rows(files.read_state(spark, where)) == rows(e)
    files.write_state(state.merge_lastmod(e.select("entry_key", "fingerprint"), files.read_state(spark, where), "t"), where)  # reads what it replaces
    assert rows(files.read_state(spark, where)) == rows(e)
    p = spark.createDataFrame([("a", "<html>\n1</html>"), ("b", "2")], "slug string, html string")
    files.write_pages(p, str(tmp_path / "out"))
    assert files.read_pages(spark, str(tmp_path / "out")).orderBy("slug").collect()[0].html == "<html>\n1</html>"
    files.write_sitemap(spark.createDataFrame([("u", "E")], "loc string, entry string"), str(tmp_path / "map"))
    assert [r.value for r in spark.read.text(str(tmp_path / "map")).collect()][-1] == "</urlset>"


@pytest.mark.parametrize("k, sets", [(2, 3), (2, 50), (3, 4), (3, 40)])
def test_items_of_very_many_entities(spark, k, sets):
    """In blocks as whole, beside items that aren't cut; brute force gives the same sets, counts and first items."""
    import itertools

    from covista.operators import cooc, graph

    items = {"a": range(14), "b": range(0, 14, 2), "c": range(5, 9), "d": [3], "e": range(12, 14)}
    m = spark.createDataFrame([(f"p{e:02d}", i) for i, es in items.items() for e in es], "person_id string, image_name string")
    want = {}
    for i, es in sorted(items.items()):
        for s in itertools.combinations([f"p{e:02d}" for e in es], k):
            n, first = want.get(s, (0, i))
            want[s] = n + 1, first
    got = cooc.cooccur(m, k, sets).collect()
    assert len(got) == len(want) and all(want[tuple(r.ids)] == (r.image_total, r.first_item) for r in got)
    if k == 2:
        assert {(r.src, r.dst): r.weight for r in graph.edges(m, sets).collect()} == {s: n for s, (n, _) in want.items()}


def test_most_held():
    import math

    from covista.operators import cooc

    for k in (2, 3, 4):
        for sets in (1, 10, 12345, 2_000_000):
            n = cooc.most_held(k, sets)
            assert math.comb(n, k) <= max(1, sets) < math.comb(n + 1, k)
