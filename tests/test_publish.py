import json

import pytest

from covista.model import SiteConfig, StoreSettings, setting
from covista.plans import publish
from covista.sources import files
from tests.conftest import rows
from tests.test_core import PEI, PEOPLE


@pytest.fixture()
def tables(spark):
    return (spark.createDataFrame(PEI, "person_id string, image_name string"),
            spark.createDataFrame(PEOPLE, "person_id string, name string, best_face_id string, include_in_network int, person_class string"))


def test_run(spark, tables, tmp_path):
    pei, people = tables
    (tmp_path / "index.html").write_text("home")
    core = publish.core_fingerprints(spark, {"/": str(tmp_path / "index.html")})
    st, out = str(tmp_path / "state"), str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        publish.publish(spark, pei, people, core, out, st, as_of="2031-01-01")
    (tmp_path / "state").mkdir()
    (tmp_path / "state" / "seed.json").write_text('{"version":2,"entries":{"gone":{"fingerprint":"1","lastmod":"2030-01-01"}}}\n')
    got = publish.publish(spark, pei, people, core, out, st, as_of="2031-01-01")
    assert got == {"in_network": 3, "max_k": 3, "generated": 3, "skipped_empty": 4, "urls": 4, "entries": 4}
    dry = publish.publish(spark, pei, people, core, out + "2", st, dry_run=True)
    assert (dry["generated"], dry["skipped_empty"]) == (3, 4) and not (tmp_path / "out2").exists()
    page = {r.slug: r.html for r in files.read_pages(spark, out + "/pages").collect()}
    assert set(page) == {"person_10", "person_2", "person_10-person_2"}
    assert "<title>Photos of Alpha One and person_2 · Archive</title>" in page["person_10-person_2"]
    assert "https://cdn.h.example/faces/Alpha_One_f1.webp" in page["person_10"] and "images/L1.webp" in page["person_10-person_2"]
    assert {json.loads(r.value)["path"] for r in spark.read.text(out + "/manifest/pages").collect()} == {f"/search/people/{s}/" for s in page}
    envelope = [json.loads(r.value) for r in spark.read.text(out + "/manifest/envelope").collect()]
    assert envelope == [{"site_origin": "https://h.example", "page_count": 3}]
    text = "\n".join(r.value for r in spark.read.text(out + "/sitemap/file=0").collect())
    assert text.count("<lastmod>2031-01-01</lastmod>") == 4 and text.index("example/</loc>") < text.index("person_10/")
    # a second run over one image more: only what changed is dated anew, the seed's key is gone
    more = pei.unionByName(spark.createDataFrame([("person_2", "b/L2.jpg")], pei.schema))
    publish.publish(spark, more, people, core, out, st, as_of="2031-02-02")
    assert [(k, lm) for k, _, lm in rows(files.read_state(spark, st))] == [
        ("/", "2031-01-01"), ("person_10", "2031-01-01"), ("person_10-person_2", "2031-01-01"), ("person_2", "2031-02-02")]


def test_dry_run_computes_no_combinations(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(publish.cooc, "combinations", lambda *_: pytest.fail("a dry run has no use for them"))
    got = publish.publish(spark, *tables, tables[0].limit(0), str(tmp_path / "o"), str(tmp_path / "s"), dry_run=True)
    assert got["generated"] == 3 and list(tmp_path.iterdir()) == []


@pytest.mark.parametrize("n", [0, 1, 100, 101, 250])
def test_sitemap_files_are_bounded(spark, tmp_path, n):
    """As with 50,000: no file has more addresses than the limit, they are in order, and the index names every file."""
    p = str(tmp_path / "map")
    e = spark.range(n).selectExpr("format_string('https://h.example/%05d/', (id * 37) % 1000) loc").selectExpr("loc", "concat('<url>', loc, '</url>') entry")
    files.write_sitemap(e, p, "https://h.example/sitemap", limit=100)
    docs = ["\n".join(r.value for r in spark.read.text(f"{p}/file={i}").collect()) for i in range(max(1, -(-n // 100)))]
    assert len(list((tmp_path / "map").glob("file=*"))) == len(docs)
    assert all(x.startswith("<?xml") and x.endswith("</urlset>") and x.count("<url>") <= 100 for x in docs)
    assert [x for t in docs for x in t.split("\n") if x.startswith("<url>")] == sorted(f"<url>{r.loc}</url>" for r in e.collect())
    index = "\n".join(r.value for r in spark.read.text(p + "-index").collect())
    assert index.count("<loc>") == len(docs) and "file=0</loc>" in index and index.endswith("</sitemapindex>")


@pytest.mark.parametrize("fails", [1, 2])
def test_failed_rename_leaves_the_state(spark, tmp_path, monkeypatch, fails):
    """A file system that answers false to the first or the second rename: an error, and the old state stands."""
    st = str(tmp_path / "state")
    old = spark.createDataFrame([("a", "1", "2031-01-01")], "entry_key string, fingerprint string, lastmod string")
    files.write_state(old, st)
    real, calls = files._fs, []

    class Failing:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, *a):
            calls.append(a)
            return False if len(calls) == fails else self.fs.rename(*a)

    monkeypatch.setattr(files, "_fs", lambda s, p: (lambda path, fs: (path, Failing(fs)))(*real(s, p)))
    with pytest.raises(OSError):
        files.write_state(old.limit(0), st)
    monkeypatch.undo()
    assert rows(files.read_state(spark, st)) == [("a", "1", "2031-01-01")] and [x.name for x in tmp_path.iterdir()] == ["state"]


def test_fragments(spark, tmp_path):
    (tmp_path / "nav.html").write_text("<nav>\n</nav>\n")
    assert rows(files.read_fragments(spark, str(tmp_path), ["nav.html"])) == [("nav.html", "<nav>\n</nav>\n")]
    assert files.read_fragments(spark, str(tmp_path), []).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_fragments(spark, str(tmp_path), ["nav.html", "gone.html"])


def test_settings():
    have = {"covista.store.endpoint": " https://store ", "covista.store.bucket": "b", "covista.store.key": "k", "covista.store.secret": "s", "path": "  "}
    got = StoreSettings.read(have)
    assert got.endpoint == "https://store" and got.uri("/x") == "s3a://b/x" and got.hadoop()["fs.s3a.bucket.b.access.key"] == "k"
    with pytest.raises(ValueError, match="secret"):
        StoreSettings.read(have | {"covista.store.secret": " "})
    assert setting(have, "path", "default") == "default" and setting(have, "none") is None


def test_nobody_in_network(spark, tables, tmp_path):
    pei, people = tables
    with pytest.raises(ValueError):
        publish.publish(spark, pei, people.where("false"), people.limit(0), str(tmp_path), str(tmp_path), SiteConfig(), dry_run=True)
