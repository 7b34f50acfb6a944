"""The registered queries of the engine, each over its whole tables, and DuckDB SQL for the same rows."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covista.functions import documents, labels, markup, palette, urls
from covista.functions.space import WHITE_SPACE, strip
from covista.model import METADATA, SiteConfig
from covista.operators import atlas, cooc, directory, graph, heavykeys, membership, pages, routing, snapshots, state
from covista.sources.tables import memberships, table

CFG = SiteConfig()
AS_OF = "2031-02-23"
#: Entries in one document of the state that is written.
SHARD_ENTRIES = 5000
CHOSEN = ["person_1", "person_7", "person_12"]
PREFIXES = ["lmp00000", "LMP0001", "LMP9", "x"]

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# --- SQL fragments ---

WS = WHITE_SPACE


def t(x: str) -> str:
    return f"trim({x}, '{WS}')"


M = (f"m as (select distinct person_id, {t('image_name')} image_name from person_eligible_images "
     f"where person_id is not null and {t('image_name')} <> '')")
NET = "net as (select distinct person_id from people where include_in_network = 1 and person_id is not null)"
NM = f"{M}, {NET}, nm as (select person_id, image_name from m where person_id in (select person_id from net))"
ENT = ("ent as (select person_id, max(name) name, max(best_face_id) best_face_id, max(include_in_network) include_in_network, "
       "max(person_class) person_class from people where person_id is not null group by 1)")
NETENT = "netent as (select person_id, max(name) name, max(best_face_id) best_face_id from people where include_in_network = 1 and person_id is not null group by 1)"
PAIRS = "select a.person_id e1, b.person_id e2, a.image_name from nm a join nm b on a.image_name = b.image_name and a.person_id < b.person_id"
COMBOS = f"""{NM}, pr as ({PAIRS}),
c1 as (select 1 k, [person_id] ids, count(*) image_total, min(image_name) first_item from nm group by person_id),
c2 as (select 2 k, [e1, e2] ids, count(*) image_total, min(image_name) first_item from pr group by e1, e2),
c3 as (select 3 k, [e1, e2, c.person_id] ids, count(*) image_total, min(pr.image_name) first_item from pr join nm c on c.image_name = pr.image_name and e2 < c.person_id group by e1, e2, c.person_id),
combos as (select * from c1 union all select * from c2 union all select * from c3)"""
SLUG = "array_to_string(ids, '-')"
LABEL = f"coalesce(nullif({t('name')}, ''), person_id)"


def path_of(u: str) -> str:
    return rf"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"


def slashed(u: str) -> str:
    p = path_of(u)
    return f"case when {p} = '' then '/' when {p} like '%/' then {p} else {p} || '/' end"


HELD = """held as (select * from (select *, row_number() over (partition by snapshot_no, shard_no order by delivered_at desc nulls last) rn
  from sitemap_lastmod_state where snapshot_no is not null) where rn = 1),
ex as (select snapshot_no, shard_no, coalesce(version, 2) version, unnest(map_entries(entries)) e from held),
ep as (select *, """ + slashed("e.key") + """ p from ex),
st as (select snapshot_no, shard_no, version,
  case when version <> 1 then e.key when p like '/search/people/_%' then substr(p, 16, length(p) - 16) else p end entry_key,
  case when version = 1 and p like '/search/people/_%' then string_split(e.value.fingerprint, '|')[-1] else e.value.fingerprint end fingerprint,
  e.value.lastmod lastmod from ep)"""
LM = f"case when coalesce({t('lastmod')}, '') = '' then '' else left({t('lastmod')}, 10) end"
FPS = """fps as (select array_to_string(person_ids, '-') entry_key, cast(image_total as varchar) fingerprint from published_pages),
core as (select * from (values ('/', 'core:0'), ('/search/', 'core:1'), ('/people/', 'core:2'), ('/about/', 'core:3')) v(entry_key, fingerprint)),
new as (select * from fps where entry_key not in (select entry_key from core) union all select * from core)"""
BEFORE_LAST = "(select max(snapshot_no) from sitemap_lastmod_state where snapshot_no < (select max(snapshot_no) from sitemap_lastmod_state))"
MERGED = f"""{HELD}, {FPS}, prev as (select * from st where snapshot_no = {BEFORE_LAST}),
merged as (select new.entry_key, new.fingerprint, case when prev.fingerprint is null or prev.fingerprint <> new.fingerprint then '{AS_OF}'
  else coalesce(nullif(prev.lastmod, ''), '{AS_OF}') end lastmod from new left join prev on new.entry_key = prev.entry_key)"""
LOC = "case when entry_key in ('/', '/search/', '/people/', '/about/') then 'https://h.example' || entry_key else 'https://h.example/search/people/' || entry_key || '/' end"
LABELS = f"""{NETENT}, pg as (select array_to_string(person_ids, '-') slug, person_ids ids, image_total, canonical_url, og_image_url from published_pages),
one as (select slug, unnest(ids) person_id, generate_subscripts(ids, 1) pos from pg),
lb as (select slug, list(coalesce(nullif({t('n.name')}, ''), one.person_id) order by pos) ls from one left join netent n on n.person_id = one.person_id group by slug),
hd as (select slug, case len(ls) when 1 then 'Photos of ' || ls[1] when 2 then 'Photos of ' || ls[1] || ' and ' || ls[2]
  else 'Photos of ' || array_to_string(ls[1:-2], ', ') || ', and ' || ls[-1] end heading from lb),
hm as (select pg.*, heading, heading || '{CFG.title_suffix}' title,
  heading || case when image_total <= 0 then ' on Archive.' else ' — ' || image_total || ' images on Archive.' end description from pg join hd using (slug))"""


def esc(x: str, table_) -> str:
    for a, b in table_:
        x = f"replace({x}, '{a.replace(chr(39), chr(39) * 2)}', '{b}')"
    return x


def fold(x: str) -> str:
    out = f"translate(lower(translate(coalesce({t(x)}, ''), '’‘', '''''')), '{labels.ACCENTED}', '{labels.PLAIN}')"
    for a, b in labels.DOUBLE.items():
        out = f"replace({out}, '{a}', '{b}')"
    return out


STUB = rf"try_cast(regexp_extract(lower({t('person_id')}), '^person_([0-9]+)$', 1) as bigint)"
SHOWN = f"coalesce(nullif({t('name')}, ''), 'Person ' || {STUB}, person_id)"
_KEPT = f"regexp_replace({LABEL}, '[^\\p{{L}}\\p{{N}}._\\- ]', '', 'g')"
FILE = f"coalesce(nullif(replace({t(_KEPT)}, ' ', '_'), ''), 'node')"
FACE = f"case when {t('best_face_id')} <> '' then '{CFG.cdn_base}/faces/' || {FILE} || '_' || {t('best_face_id')} || '.webp' end"


def last(x: str) -> str:
    return f"string_split({x}, '/')[-1]"


def js(x: str) -> str:
    out = f"url_encode({x})"
    for a, b in (("%21", "!"), ("%27", "''"), ("%28", "("), ("%29", ")"), ("%2A", "*")):
        out = f"replace({out}, '{a}', '{b}')"
    return out


def img_py(x: str) -> str:
    return f"'{CFG.cdn_base}/images/' || url_encode(replace({t(last(x))}, '.jpg', '.webp'))"


def img_js(x: str) -> str:
    b = f"case when {last(t(x))} = '' then {t(x)} else {last(t(x))} end"
    return f"case when {t(x)} <> '' then '{CFG.cdn_base}/images/' || {js(f'regexp_replace({b}, {chr(39)}(?i)[.]jpg$' + chr(39) + ', ' + chr(39) + '.webp' + chr(39) + ')')} end"


# --- inputs ---


def _members(spark, d):
    return membership.network_membership(table(spark, d, "person_eligible_images"), table(spark, d, "people"))


def _pages(spark, d) -> DataFrame:
    return table(spark, d, "published_pages").select(F.col("person_ids").alias("ids"), "image_total", "canonical_url", "og_image_url")


def _core(spark) -> DataFrame:
    return spark.createDataFrame([(p, f"core:{i}") for i, p in enumerate(CFG.core_paths)], "entry_key string, fingerprint string")


def _new(spark, d) -> DataFrame:
    return pages.fingerprint_union(pages.page_fingerprints(_pages(spark, d)), _core(spark))


def _previous(spark, d, raw: bool = False) -> DataFrame:
    """The state before the published pages, which are those of the last snapshot: the last snapshot but one."""
    rows = table(spark, d, "sitemap_lastmod_state")
    last = [r[0] for r in rows.select("snapshot_no").where("snapshot_no is not null").distinct().orderBy(F.desc("snapshot_no")).limit(2).collect()]
    return snapshots.snapshot_entries(rows.where(F.col("snapshot_no") == last[1]) if len(last) > 1 else rows.limit(0), raw=raw)


def _merged(spark, d) -> DataFrame:
    return state.merge_lastmod(_new(spark, d), _previous(spark, d, raw=True), AS_OF)


def _documents(spark, d) -> DataFrame:
    """The shards that hold as state documents (version, entries, urls); a null lastmod is written as '', for a state entry must have one."""
    held = snapshots.held_shards(table(spark, d, "sitemap_lastmod_state"))
    whole = F.transform_values("entries", lambda k, v: F.struct(v["fingerprint"].alias("fingerprint"), F.coalesce(v["lastmod"], F.lit("")).alias("lastmod")))
    first = F.coalesce(F.col("version") == 1, F.lit(False))
    return held.select("snapshot_no", "version", F.when(~first, whole).alias("entries"), F.when(first, whole).alias("urls"))


# --- memberships ---


@query(f"with {M} select person_id, image_name from m")
def membership_scan(spark: SparkSession, d: str) -> DataFrame:
    return membership.membership_scan(table(spark, d, "person_eligible_images"))


@query(f"with {NET} select person_id from net")
def network_entities(spark: SparkSession, d: str) -> DataFrame:
    return membership.network_entities(table(spark, d, "people"))


@query(f"with {NM} select person_id, image_name from nm")
def network_membership(spark: SparkSession, d: str) -> DataFrame:
    return _members(spark, d)


@query(f"""with {M} select person_id, image_name from m where image_name not in
  (select image_name from m where person_id in (select person_id from people where person_class = 'ignored'))""")
def membership_without_ignored(spark: SparkSession, d: str) -> DataFrame:
    m = membership.membership_scan(table(spark, d, "person_eligible_images"))
    return membership.without_items_of(m, table(spark, d, "people").where("person_class = 'ignored'"))


@query(f"with {M} select person_id, count(*) photo_count, case when count(*) = 1 then '1 photo' else count(*) || ' photos' end label from m group by 1")
def photo_counts(spark: SparkSession, d: str) -> DataFrame:
    return directory.photo_counts(table(spark, d, "person_eligible_images"))


# --- co-occurrence ---


def _flat(df: DataFrame) -> DataFrame:
    return df.select(labels.slug(F.col("ids")).alias("slug"), "image_total", "first_item")


@query(f"with {NM} select person_id slug, count(*) image_total, min(image_name) first_item from nm group by 1")
def cooc_k1(spark: SparkSession, d: str) -> DataFrame:
    return _flat(cooc.cooccur(_members(spark, d), 1))


@query(f"with {NM}, pr as ({PAIRS}) select e1 || '-' || e2 slug, count(*) image_total, min(image_name) first_item from pr group by e1, e2")
def cooc_k2(spark: SparkSession, d: str) -> DataFrame:
    return _flat(cooc.cooccur(_members(spark, d), 2))


@query(f"with {COMBOS} select {SLUG} slug, image_total, first_item from c3")
def cooc_k3(spark: SparkSession, d: str) -> DataFrame:
    return _flat(cooc.cooccur(_members(spark, d), 3))


@query(f"with {COMBOS} select k::bigint k, {SLUG} slug, first_item from combos")
def cooc_first_item(spark: SparkSession, d: str) -> DataFrame:
    c = cooc.combinations(_members(spark, d), CFG.max_k)
    return c.select(F.col("k").cast("bigint").alias("k"), labels.slug(F.col("ids")).alias("slug"), "first_item")


@query(f"with {M} " + " intersect ".join(f"select image_name from m where person_id = '{x}'" for x in CHOSEN))
def cooc_intersect_sql(spark: SparkSession, d: str) -> DataFrame:
    return cooc.common_items(memberships(table(spark, d, "person_eligible_images")), CHOSEN)


@query(f"""with {COMBOS}, n as (select count(*)::hugeint n from net)
select n::bigint in_network, 3::bigint max_k, (select count(*) from combos) generated,
 (n + n * (n - 1) // 2 + n * (n - 1) * (n - 2) // 6 - (select count(*) from combos))::bigint skipped_empty from n""")
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    r = cooc.run_summary(_members(spark, d), membership.network_entities(table(spark, d, "people")), CFG.max_k)
    return r.withColumn("max_k", F.col("max_k").cast("bigint"))


# --- labels ---


@query(f"with {NETENT} select person_id, {LABEL} as label from netent")
def chip_labels(spark: SparkSession, d: str) -> DataFrame:
    return pages.entity_labels(membership.network_people(table(spark, d, "people")))


@query(f"with {ENT} select person_id, {SHOWN} as display_name, ({STUB})::varchar stub from ent")
def display_names(spark: SparkSession, d: str) -> DataFrame:
    e = directory.entities(table(spark, d, "people"))
    return e.select("person_id", labels.display_name(F.col("person_id"), F.col("name")).alias("display_name"),
                    labels.stub_number(F.col("person_id")).cast("string").alias("stub"))


@query(f"with {LABELS} select slug, heading, title, description from hm")
def headings(spark: SparkSession, d: str) -> DataFrame:
    return pages.headings(_pages(spark, d).select("ids", "image_total"), membership.network_people(table(spark, d, "people")), CFG)


@query("select array_to_string(list_reverse(person_ids), ',') given, '/search/people/' || array_to_string(list_sort(person_ids), '-') || '/' url from published_pages")
def people_url(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "published_pages").select(
        F.array_join(F.reverse("person_ids"), ",").alias("given"), urls.people_url(F.reverse("person_ids")).alias("url"))


@query(f"with {ENT} select person_id, {FILE} as file_label from ent")
def filename_sanitise(spark: SparkSession, d: str) -> DataFrame:
    e = directory.entities(table(spark, d, "people"))
    return e.select("person_id", labels.file_label(labels.chip_label("person_id", "name")).alias("file_label"))


@query(f"""with i as (select distinct image_name p from person_eligible_images where image_name is not null),
s as (select p, {t('p')} q, {last(t('p'))} b from i)
select p as path, case when p = '' then null when regexp_matches(q, '(?i)^https?://') then q else '{CFG.cdn_base}/' || regexp_replace(q, '^/+', '') end asset,
 case when b <> '' then '{CFG.cdn_base}/images/' || {js('b')} end image, case when b <> '' then '{CFG.cdn_base}/faces/' || {js('b')} end face,
 case when b <> '' then '{CFG.cdn_base}/thumbnails/' || {js("regexp_replace(b, '[.][^.]+$', '')")} || '.webp' end thumbnail from s""")
def cdn_urls(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "person_eligible_images").select(F.col("image_name").alias("path")).where("path is not null").distinct()
    p = F.col("path")
    return i.select("path", urls.cdn_asset(p, CFG.cdn_base).alias("asset"), urls.cdn_file(p, CFG.cdn_base, "images").alias("image"),
                    urls.cdn_file(p, CFG.cdn_base, "faces").alias("face"), urls.cdn_thumbnail(p, CFG.cdn_base).alias("thumbnail"))


@query(f"""with i as (select distinct image_name p from person_eligible_images where image_name is not null)
select p as image_name, {img_py('p')} published, {img_js('p')} requested from i""")
def cdn_image_abs(spark: SparkSession, d: str) -> DataFrame:
    i = table(spark, d, "person_eligible_images").select("image_name").where("image_name is not null").distinct()
    n = F.col("image_name")
    return i.select("image_name", urls.cdn_image_published(n, CFG.cdn_base).alias("published"),
                    urls.cdn_image_requested(n, CFG.cdn_base).alias("requested"))


@query(f"""with {ENT} select person_id, {esc('name', markup.HTML_QUOTED)} html, {esc('name', markup.HTML_ATTRIBUTE)} attribute,
 {esc('name', markup.HTML_REQUEST)} request, {esc('name', markup.XML_TEXT)} xml from ent""")
def escape_variants(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("name")
    return directory.entities(table(spark, d, "people")).select(
        "person_id", markup.escape(n, markup.HTML_QUOTED).alias("html"), markup.escape(n, markup.HTML_ATTRIBUTE).alias("attribute"),
        markup.escape(n, markup.HTML_REQUEST).alias("request"), markup.escape(n, markup.XML_TEXT).alias("xml"))


_PALETTE = ", ".join(f"'{c}'" for c in palette.PALETTE)


@query(f"""with o as (select page_path, unnest(person_ids) person_id, generate_subscripts(person_ids, 1) - 1 pos from published_pages),
c as (select *, ([{_PALETTE}])[(pos % 10 + 1)::int] colour from o)
select page_path, pos::bigint pos, colour, 'rgba(' || ('0x' || substr(colour, 2, 2))::int || ',' || ('0x' || substr(colour, 4, 2))::int || ',' ||
 ('0x' || substr(colour, 6, 2))::int || ',0.25)' rgba from c""")
def palette_rgba(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "published_pages").select("page_path", F.posexplode("person_ids").alias("pos", "person_id"))
    c = palette.colour(F.col("pos"))
    return o.select("page_path", F.col("pos").cast("bigint").alias("pos"), c.alias("colour"), palette.rgba(c, F.lit("0.25")).alias("rgba"))


# --- pages ---

_REP = f"""{COMBOS}, {NETENT}, faces as (select person_id, {FACE} face from netent),
mf as (select k, ids, image_total, coalesce(face, {img_py('first_item')}) og_image_url from combos left join faces on k = 1 and faces.person_id = ids[1])"""


@query(f"with {_REP} select {SLUG} slug, og_image_url from mf")
def rep_image(spark: SparkSession, d: str) -> DataFrame:
    r = pages.representative_images(cooc.combinations(_members(spark, d), CFG.max_k), membership.network_people(table(spark, d, "people")), CFG)
    return r.select(labels.slug(F.col("ids")).alias("slug"), "og_image_url")


@query(f"""with {_REP} select '/search/people/' || {SLUG} || '/' path, 'https://h.example/search/people/' || {SLUG} || '/' canonical_url,
 array_to_string(ids, ',') person_ids, image_total, og_image_url from mf""")
def manifest_pages(spark: SparkSession, d: str) -> DataFrame:
    m = pages.manifest(cooc.combinations(_members(spark, d), CFG.max_k), membership.network_people(table(spark, d, "people")), CFG)
    return m.withColumn("person_ids", F.array_join("person_ids", ","))


@query(f"with {COMBOS} select {SLUG} entry_key, image_total::varchar fingerprint from combos")
def page_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return pages.page_fingerprints(cooc.counts(_members(spark, d), CFG.max_k))


@query(f"with {COMBOS} select '{CFG.site_origin}' site_origin, count(*) page_count from combos")
def manifest_envelope(spark: SparkSession, d: str) -> DataFrame:
    return pages.manifest_envelope(cooc.counts(_members(spark, d), CFG.max_k), CFG.site_origin)


@query(f"with {FPS} select entry_key, fingerprint from new")
def fingerprint_union(spark: SparkSession, d: str) -> DataFrame:
    return _new(spark, d)


@query(f"with {MERGED} select {LOC} loc, lastmod from merged")
def sitemap_urls(spark: SparkSession, d: str) -> DataFrame:
    return pages.sitemap_locs(_merged(spark, d), CFG)


@query(f"""with {MERGED}, l as (select {LOC} loc, lastmod from merged)
select loc, '  <url>\n    <loc>' || {esc('loc', markup.XML_TEXT)} || '</loc>\n    <lastmod>' || {esc('lastmod', markup.XML_TEXT)} || '</lastmod>\n  </url>' entry from l""")
def sitemap_xml(spark: SparkSession, d: str) -> DataFrame:
    m = pages.sitemap_locs(_merged(spark, d), CFG)
    return pages.sitemap_entries(m.select("loc"), m)


def _sql_meta(attr: str, key: str, value: str) -> str:
    return f"'  <meta {attr}=\"{key}\" content=\"' || {value} || '\" />\n'"


def _sql_head(title: str, desc: str, address: str, tags: list[str]) -> str:
    return " || ".join([
        "'<!DOCTYPE html>\n<html lang=\"en\">\n<head>\n  <meta charset=\"utf-8\">\n  <meta name=\"viewport\" content=\"width=device-width, initial-scale=1, viewport-fit=cover\">\n  <title>'",
        title, "'</title>\n'", _sql_meta("name", "description", desc), "'  <link rel=\"canonical\" href=\"'", address, "'\" />\n'", *tags,
        "'  <link rel=\"icon\" type=\"image/svg+xml\" href=\"/favicon.svg\">\n  <link rel=\"stylesheet\" href=\"/styles.css\">\n  <script src=\"/js/nav.js\" defer></script>\n  <script src=\"/js/disclaimer.js\" defer></script>\n</head>\n'"])


def _sql_social(t_: str, d_: str, a_: str, site: str, loc: str) -> list[str]:
    return [_sql_meta("property", k, v) for k, v in (("og:title", t_), ("og:description", d_), ("og:url", a_), ("og:site_name", site),
                                                     ("og:locale", loc), ("og:type", "'website'"))]


_E = lambda x: esc(x, markup.HTML_QUOTED)
_IMG = _E(f"coalesce(nullif(og_image_url, ''), '{CFG.cdn_base}/og/search.webp')")
_HTML = " || ".join([
    _sql_head(_E("title"), _E("description"), _E("canonical_url"), _sql_social(
        _E("title"), _E("description"), _E("canonical_url"), "'h.example'", "'en_US'") + [
        _sql_meta("name", "twitter:title", _E("title")), _sql_meta("name", "twitter:description", _E("description")),
        _sql_meta("property", "og:image", _IMG), _sql_meta("property", "og:image:secure_url", _IMG),
        _sql_meta("name", "twitter:card", "'summary_large_image'"), _sql_meta("name", "twitter:image", _IMG)]),
    "'<body class=\"page-search\">\n<nav></nav>\n<script>window.__STATIC_SEARCH__='",
    "'{\"person_ids\":[\"' || array_to_string(ids, '\",\"') || '\"],\"image_total\":' || image_total || ',\"canonical_path\":\"/search/people/' || slug || '/\"}'",
    "';</script>\n<main></main>\n<footer></footer>\n<aside></aside>\n</body>\n</html>\n'"])


def _static(spark, d) -> DataFrame:
    return pages.static_pages(_pages(spark, d), membership.network_people(table(spark, d, "people")), CFG,
                              "<nav></nav>\n", "<main></main>\n", "<footer></footer>\n", "<aside></aside>\n")


@query(f"with {LABELS} select slug, {_HTML} html from hm")
def static_pages(spark: SparkSession, d: str) -> DataFrame:
    return _static(spark, d)


_NEW_IMG = "(case when og_image_url <> '' then 'https://cdn.h.example/images/' || slug || '&x.webp' end)"
_NEW_ESC = esc(_NEW_IMG, markup.HTML_REQUEST)


def _sql_inject(html: str) -> str:
    was = html
    for attr, key, v in (("property", "og:image", _NEW_ESC), ("property", "og:image:secure_url", _NEW_ESC), ("name", "twitter:image", _NEW_ESC),
                         ("name", "twitter:card", "'summary_large_image'")):
        pat = rf'<meta\s+{attr}="{key}"\s+content="[^"]*"\s*/?>'
        tag = f"'<meta {attr}=\"{key}\" content=\"' || {v} || '\" />'"
        html = (f"(select case when regexp_matches(x, '{pat}') then regexp_replace(x, '{pat}', {tag}) "
                f"else regexp_replace(x, '</head>', '  ' || {tag} || '\n</head>') end from (select {html} x))")
    return f"case when {_NEW_IMG} is null then {was} else {html} end"


#: Pages of one entity lack two of the tags, those of three have no end of the head either.
_LACKS = (('property="og:image" ', 'property="og:was" '), ('name="twitter:card"', 'name="twitter:was"'))


def _sql_lacking(html: str) -> str:
    few = html
    for a, b in _LACKS:
        few = f"replace({few}, '{a}', '{b}')"
    return f"case len(ids) when 1 then {few} when 3 then replace({few}, '</head>', '') else {html} end"


@query(f"with {LABELS}, h0 as (select slug, ids, og_image_url, {_HTML} html from hm), hh as (select slug, og_image_url, {_sql_lacking('html')} html from h0) "
       f"select slug, {_sql_inject('html')} html from hh")
def og_inject(spark: SparkSession, d: str) -> DataFrame:
    """Pages with and without the tags, and pages of no image, which stay as they are."""
    k = _pages(spark, d).select(labels.slug(F.col("ids")).alias("slug"), F.size("ids").alias("n"), "og_image_url")
    few = F.col("html")
    for a, b in _LACKS:
        few = F.replace(few, F.lit(a), F.lit(b))
    html = F.when(F.col("n") == 1, few).when(F.col("n") == 3, F.replace(few, F.lit("</head>"), F.lit(""))).otherwise(F.col("html"))
    given = _static(spark, d).join(k, "slug").select("slug", html.alias("html"), "og_image_url")
    img = F.when(F.col("og_image_url") != "", F.concat(F.lit("https://cdn.h.example/images/"), F.col("slug"), F.lit("&x.webp")))
    return markup.inject_image(given, "html", img).drop("og_image_url")


# --- state ---


@query(f"with {HELD} select snapshot_no, entry_key, fingerprint, coalesce(lastmod, '') lastmod from st where version <> 1")
def state_read_v2(spark: SparkSession, d: str) -> DataFrame:
    return state.read_entries(_documents(spark, d).where("version is null or version <> 1"), ("snapshot_no",))


@query(f"with {HELD} select snapshot_no, entry_key, fingerprint, coalesce(lastmod, '') lastmod from st where version = 1")
def state_migrate_v1(spark: SparkSession, d: str) -> DataFrame:
    return state.read_entries(_documents(spark, d).where("version = 1"), ("snapshot_no",))


@query(f"with {MERGED} select entry_key, fingerprint, lastmod from merged")
def lastmod_merge(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d)


@query(f"""with {MERGED} select coalesce(new.entry_key, prev.entry_key) entry_key, case when prev.entry_key is null then 'new' when new.entry_key is null then 'removed'
 when new.fingerprint = prev.fingerprint then 'unchanged' else 'changed' end change_type from new full join prev on new.entry_key = prev.entry_key""")
def lastmod_changes(spark: SparkSession, d: str) -> DataFrame:
    return state.change_report(_new(spark, d), _previous(spark, d))


@query(f"with {MERGED} select entry_key from prev where entry_key not in (select entry_key from new)")
def lastmod_removed(spark: SparkSession, d: str) -> DataFrame:
    return state.removed_keys(_new(spark, d), _previous(spark, d))


@query(f"""with {MERGED}, g as (select ('0x' || substr(md5(entry_key), 1, 8))::bigint % (select greatest(1, ceil(count(*) / {SHARD_ENTRIES}.0))::bigint from merged) shard, entry_key, fingerprint, lastmod from merged)
select shard, '{{"version":2,"entries":{{' || string_agg('"' || entry_key || '":{{"fingerprint":"' || fingerprint || '","lastmod":"' || lastmod || '"}}', ',' order by entry_key) || '}}}}' json from g group by 1""")
def state_write(spark: SparkSession, d: str) -> DataFrame:
    return state.state_json(state.sharded(_merged(spark, d), SHARD_ENTRIES), "shard")


@query(f"select distinct url, {slashed('url')} path from request_log where url is not null")
def url_normalise(spark: SparkSession, d: str) -> DataFrame:
    u = table(spark, d, "request_log").select("url").where("url is not null").distinct()
    return u.select("url", urls.normal_path(F.col("url")).alias("path"))


# --- directory ---

_DIR = f"""{ENT}, {M}, pc as (select person_id, count(*) photo_count from m group by 1),
dir as (select ent.person_id, {SHOWN.replace('person_id', 'ent.person_id')} as name, {FACE.replace('person_id', 'ent.person_id')} image,
 coalesce(photo_count, 0) photo_count from ent left join pc on pc.person_id = ent.person_id where person_class in ('named', 'unknown'))"""


def _directory(spark, d, q=""):
    return directory.directory(table(spark, d, "people"), table(spark, d, "person_eligible_images"), query=q, cdn=CFG.cdn_base)


@query(f"with {ENT} select person_id, person_class from ent where person_class in ('named', 'unidentified')")
def class_filter(spark: SparkSession, d: str) -> DataFrame:
    return directory.of_classes(directory.entities(table(spark, d, "people")), ["named", "unidentified"]).select("person_id", "person_class")


@query(f"""with {ENT}, c as (select a.person_id, upper(a.person_class) || ', ,' || a.include_in_network || ',' || case when a.include_in_network = 1 then 'named' else 'unknown' end raw from ent a),
l as (select person_id, case when raw is null then ['named', 'unknown'] else list_filter(list_transform(string_split(lower(raw), ','), lambda x: trim(x)), lambda x: x <> '') end cl from c)
select person_id, array_to_string(cl, ',') classes, case when list_sort(list_distinct(cl)) = ['named', 'unknown'] and len(cl) = 2 then null else array_to_string(list_sort(cl), ',') end param,
 'https://api.h.example/faces?limit=1000&offset=' || (2000)::varchar || case when list_sort(list_distinct(cl)) = ['named', 'unknown'] and len(cl) = 2 then '' else '&classes=' || replace(array_to_string(list_sort(cl), ','), ',', '%2C') end url from l""")
def class_canonicalise(spark: SparkSession, d: str) -> DataFrame:
    """Choices of classes made of every entity's fields, in one form, as a parameter and in the address of a directory page."""
    n, net = F.col("person_class"), F.col("include_in_network")
    raw = F.concat(F.upper(n), F.lit(", ,"), net.cast("string"), F.lit(","), F.when(net == 1, "named").otherwise("unknown"))
    rows = directory.entities(table(spark, d, "people")).select("person_id", raw.alias("raw"))
    c = labels.class_list(F.col("raw"), F.col("raw").isNotNull(), list(directory.DEFAULT_CLASSES))
    param = labels.class_param(c, list(directory.DEFAULT_CLASSES))
    return rows.select("person_id", F.array_join(c, ",").alias("classes"), param.alias("param"),
                       urls.directory_url("https://api.h.example/", F.lit(1000), F.lit(2000), param).alias("url"))


@query(f"with {_DIR} select person_id, name, image, photo_count from dir order by photo_count desc, person_id limit 1000 offset 100")
def directory_page(spark: SparkSession, d: str) -> DataFrame:
    return directory.page(_directory(spark, d), CFG.page_size, 100)


@query(f"with {_DIR} select count(*) total from dir")
def directory_total(spark: SparkSession, d: str) -> DataFrame:
    return directory.total(_directory(spark, d))


@query(f"with {_DIR} select person_id, name, image, photo_count from dir where {fold('name')} like '%bra%'")
def name_search(spark: SparkSession, d: str) -> DataFrame:
    return _directory(spark, d, "Brá ")


@query(f"""with {ENT}, g as (select coalesce(person_class, '') cls, count(*) total, count(best_face_id) loaded, count(*) filter (where {t('name')} like '%bra%') shown from ent group by 1),
q as (select cls, total, loaded, shown, unnest(['', ' ', 'bra']) q from g)
select cls, q, case when q = 'bra' then case when shown = 0 then 'No matches' else shown || ' of ' || loaded || ' loaded (' || total || ' total)' end
 when loaded = 0 and total = 0 then '' when loaded < total then loaded || ' of ' || total || ' people' else total || ' people' end subtitle from q""")
def directory_subtitle(spark: SparkSession, d: str) -> DataFrame:
    """The line above the entities of each class, without and with a search."""
    e = directory.entities(table(spark, d, "people"))
    g = e.groupBy(F.coalesce("person_class", F.lit("")).alias("cls")).agg(
        F.count(F.lit(1)).alias("total"), F.count("best_face_id").alias("loaded"), F.count(F.when(strip("name").contains("bra"), 1)).alias("shown"))
    rows = g.select("*", F.explode(F.array(F.lit(""), F.lit(" "), F.lit("bra"))).alias("q"))
    return rows.select("cls", "q", labels.subtitle(*(F.col(c) for c in ("q", "shown", "loaded", "total")), F.lit(True)).alias("subtitle"))


# --- requests ---

_DOCID = r"regexp_extract(p, '^/search/document/([^/]+)/?', 1)"
_ROUTED = rf"""rq as (select *, {path_of('url')} p, regexp_extract(url, '[?&]photo=([^&#]*)', 1) ph from request_log),
kind as (select *, case when http_method = 'GET' and {_DOCID} <> '' then 'document' when http_method = 'GET' and regexp_matches(p, '^/search/people/[^/]+/?') then 'people' else 'other' end route from rq),
r0 as (select *, case when route = 'document' then url_decode({_DOCID}) end doc_id, case when route <> 'other' then nullif(url_decode(replace(ph, '+', ' ')), '') end photo from kind),
r1 as (select *, {img_js('photo')} image_url from r0),
r2 as (select *, case when route = 'other' then 'pass' when route = 'document' and photo is null then 'shell_lookup' when route = 'document' then 'shell'
 when upstream_status = 404 then 'shell' when image_url is not null and upstream_status = 200 and content_type like '%text/html%' then 'inject' else 'pass' end action from r1),
rt as (select request_id, route, action, doc_id, photo, image_url,
 case when route = 'document' or route = 'people' and upstream_status = 404 then regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/search/index.html'
  when route = 'people' and photo is not null then regexp_replace(url, '[?][^#]*', '') else url end upstream_url,
 case when action like 'shell%' then 200 else upstream_status end status from r2)"""


def _routed(spark, d):
    return routing.route(table(spark, d, "request_log"), CFG)


@query(f"with {_ROUTED} select * replace (status::varchar as status) from rt")
def route_requests(spark: SparkSession, d: str) -> DataFrame:
    return _routed(spark, d).withColumn("status", F.col("status").cast("string"))


def _sql_term(u: str, prefixes=CFG.document_prefixes) -> str:
    out = f"replace(replace(regexp_replace({u}, '[.](PDF|WEBP|JPEG|JPG)$', ''), '-', ''), '.', '')"
    for p in reversed(prefixes):
        rest = f"substr({u}, {len(p) + 1})"
        out = f"case when starts_with({u}, '{p}') then '{p}' || replace(replace(regexp_replace({rest}, '[.][A-Z]*$', ''), '-', ''), '.', '') else {out} end"
    return out


def _sql_valid(u: str, digits: str, prefixes=CFG.document_prefixes) -> str:
    out = "false"
    for p in reversed(prefixes):
        out = f"case when starts_with('{p}', {u}) then true when starts_with({u}, '{p}') then regexp_matches(substr({u}, {len(p) + 1}), '{digits}') else {out} end"
    return f"case when {u} = '' then true else {out} end"


@query(f"with {_ROUTED}, dd as (select distinct doc_id, upper({t('doc_id')}) u from rt where doc_id is not null) select doc_id, {_sql_term('u')} term from dd")
def doc_term_strip(spark: SparkSession, d: str) -> DataFrame:
    return routing.document_terms(_routed(spark, d), CFG).select("doc_id", "term")


@query(f"""with {_ROUTED}, dd as (select distinct doc_id, upper({t('doc_id')}) u from rt where doc_id is not null), dt as (select doc_id, u, {_sql_term('u')} w from dd)
select doc_id, ({_sql_valid('w', '^[0-9]*$')}) or ({_sql_valid('u', '^([0-9]*|[0-9]+(-[0-9]+)*([.][A-Z]{0,4})?)$')}) as valid from dt""")
def doc_query_valid(spark: SparkSession, d: str) -> DataFrame:
    return routing.document_terms(_routed(spark, d), CFG).select("doc_id", "valid")


@query(f"""with {_ROUTED}, {M}, px as (select distinct upper({t('doc_id')}) prefix from rt where doc_id is not null and {t('doc_id')} <> ''
 union select upper(x) from (values {', '.join(f"('{p}')" for p in PREFIXES)}) v(x)),
im as (select distinct image_name, upper({last('image_name')}) doc from m),
ln as (select distinct length(prefix) n from px), bg as (select substr(doc, 1, n) b, min(image_name) f from im join ln on n <= length(doc) group by 1)
select prefix, f first_item from px left join bg on b = prefix""")
def doc_prefix_first(spark: SparkSession, d: str) -> DataFrame:
    asked = _routed(spark, d).where("doc_id is not null").select(F.col("doc_id").alias("prefix")).unionByName(
        spark.createDataFrame([(p,) for p in PREFIXES], "prefix string"))
    return routing.first_by_prefix(asked, memberships(table(spark, d, "person_eligible_images")))


@query(f"""select doc_id, nullif({t("coalesce(nullif(image_name, ''), nullif(source, ''), nullif(lang, ''))")}, '') photo, '{CFG.cdn_base}/atlas/atlas.webp' atlas from documents""")
def doc_photo(spark: SparkSession, d: str) -> DataFrame:
    """The photo a row of the document lookup shows, the first of three fields, and the atlas its tile lies in."""
    return table(spark, d, "documents").select("doc_id", routing.photo_of("image_name", "source", "lang").alias("photo"), urls.atlas_url(CFG.cdn_base).alias("atlas"))


@query(f"""with pt as (select distinct {path_of('url')} path from request_log where url is not null)
select path, case when path = '/' then '/' when path like '/search/%' then '/search/' when path like '/people/%' then '/people/' when path like '/about/%' then '/about/' end link from pt""")
def nav_longest_prefix(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "request_log").where("url is not null").select(urls.url_path(F.col("url")).alias("path")).distinct()
    return routing.active_link(p, CFG)


# --- graph ---

_EDGES = f"{NM}, pr as ({PAIRS}), ed as (select e1 src, e2 dst, count(*) weight from pr group by 1, 2), bw as (select src node, dst neighbour, weight from ed union all select dst, src, weight from ed)"


@query(f"with {_EDGES} select src, dst, weight from ed")
def graph_edges(spark: SparkSession, d: str) -> DataFrame:
    return graph.edges(_members(spark, d))


@query(f"with {_EDGES} select node, count(distinct neighbour) degree from bw group by 1")
def node_degree(spark: SparkSession, d: str) -> DataFrame:
    return graph.degree(graph.edges(_members(spark, d)))


@query(f"with {_EDGES} select * from (select node, neighbour, weight, row_number() over (partition by node order by weight desc, neighbour) rank from bw) where rank <= 10")
def top_neighbors(spark: SparkSession, d: str) -> DataFrame:
    return graph.top_neighbours(graph.edges(_members(spark, d)), 10)


@query(f"""with {ENT}, {M}, e as (select person_id, coalesce(person_class, '') person_class from ent)
select person_class, count(distinct e.person_id) people, count(distinct image_name) images from e left join m using (person_id) group by 1""")
def class_counts(spark: SparkSession, d: str) -> DataFrame:
    return graph.class_counts(directory.entities(table(spark, d, "people")), membership.membership_scan(table(spark, d, "person_eligible_images")))


@query(f"""with {_EDGES}, gone as (select person_id from people where person_class in ('unknown', 'unidentified'))
select src, dst, weight from ed where src not in (select * from gone) and dst not in (select * from gone)""")
def graph_class_filter(spark: SparkSession, d: str) -> DataFrame:
    return graph.without_classes(graph.edges(_members(spark, d)), table(spark, d, "people"), ["unknown", "unidentified"])


# --- atlas, metadata, assembly ---


@query(f"with {NET}, o as (select person_id, row_number() over (order by person_id) - 1 i from net) select person_id as key, (i % 21 * 100)::int x, (i // 21 * 100)::int y, 100 w, 100 h from o")
def atlas_pack(spark: SparkSession, d: str) -> DataFrame:
    return atlas.pack(membership.network_entities(table(spark, d, "people")), "person_id", CFG.atlas_columns, CFG.atlas_tile)


@query(f"with {NET}, o as (select person_id, row_number() over (order by person_id) - 1 i from net) select person_id as key, (i % 21 * 100)::int x, (i // 21 * 100)::int y, 100 w, 100 h from o")
def atlas_read(spark: SparkSession, d: str) -> DataFrame:
    packed = atlas_pack(spark, d)
    docs = packed.groupBy("y").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("key", F.struct("x", "y", "w", "h"))))).alias("value"))
    return atlas.read(docs)


_META = {
    "shared": {"site_origin": "https://h.example/", "spaces_cdn_base": "https://cdn.h.example", "og_site_name": "h.example", "og_locale": "en_US",
               "og_image_type": "image/webp", "og_image_width": 1200, "og_image_height": 630, "twitter_card": "summary_large_image"},
    "pages": [
        {"out": "head-root.html", "url_path": "/", "body_class": "page-home", "title": "Archive & more", "description": "What's <in> it",
         "og_image_filename": "home.webp", "og_image_alt": 'A "map"'},
        {"out": "head-about.html", "url_path": "/about/", "body_class": "page-about", "title": "About · Archive", "description": "About it",
         "og_image_filename": "about.webp", "og_image_alt": "Text"},
    ],
}
BANNER = "<!-- generated from the site metadata -->"
_META_SQL = "mt as (select * from (values " + ", ".join(
    "(" + ", ".join(f"'{str(x).replace(chr(39), chr(39) * 2)}'" for x in (*p.values(), *_META["shared"].values())) + ")" for p in _META["pages"]
) + f") v({', '.join((*_META['pages'][0], *_META['shared']))}))"


def _meta(spark) -> DataFrame:
    docs = spark.createDataFrame([(json.dumps(_META),)], "value string")
    return pages.metadata_rows(docs.select(F.from_json("value", METADATA).alias("m")).select("m.*"))


@query(f"with {_META_SQL} select out, url_path, title, site_origin, og_image_width::int og_image_width, twitter_card from mt")
def page_metadata(spark: SparkSession, d: str) -> DataFrame:
    return _meta(spark).select("out", "url_path", "title", "site_origin", "og_image_width", "twitter_card")


_A = lambda x: esc(x, markup.HTML_ATTRIBUTE)
_MADDR = _A("rtrim(site_origin, '/') || url_path")
_MIMG = _A("rtrim(spaces_cdn_base, '/') || '/og/' || og_image_filename")
_MHTML = " || ".join([f"'{BANNER}\n'", _sql_head(_A("title"), _A("description"), _MADDR, _sql_social(
    _A("title"), _A("description"), _MADDR, _A("og_site_name"), _A("og_locale")) + [
    _sql_meta("property", "og:image", _MIMG), _sql_meta("property", "og:image:secure_url", _MIMG), _sql_meta("property", "og:image:type", _A("og_image_type")),
    _sql_meta("property", "og:image:width", _A("og_image_width")), _sql_meta("property", "og:image:height", _A("og_image_height")),
    _sql_meta("property", "og:image:alt", _A("og_image_alt")), _sql_meta("name", "twitter:card", _A("twitter_card")),
    _sql_meta("name", "twitter:title", _A("title")), _sql_meta("name", "twitter:description", _A("description")), _sql_meta("name", "twitter:image", _MIMG)]),
    "'<body class=\"'", _A("body_class"), "'\">\n'"])


@query(f"with {_META_SQL} select out, {_MHTML} html from mt")
def head_partials(spark: SparkSession, d: str) -> DataFrame:
    return pages.head_partials(_meta(spark), BANNER)


@query("select page_path as out, count(*) n from (select page_path from published_pages union all select '/search/people/' || person_id || '/' from people where person_id is not null) group by 1 having count(*) > 1")
def duplicate_outputs(spark: SparkSession, d: str) -> DataFrame:
    outs = table(spark, d, "published_pages").select(F.col("page_path").alias("out")).unionByName(
        table(spark, d, "people").where("person_id is not null").select(F.concat(F.lit("/search/people/"), "person_id", F.lit("/")).alias("out")))
    return pages.duplicate_outputs(outs)


_RECIPE = [(p, i, f) for p, fs in (("index", ("head", "nav", "home", "close")), ("about", ("head", "nav", "about", "footer", "close"))) for i, f in enumerate(fs)]


@query("""select * from (values ('index', '[head][nav][home][close]'), ('about', '[head][nav][about][footer][close]')) v(page, html)""")
def assemble_pages(spark: SparkSession, d: str) -> DataFrame:
    recipe = spark.createDataFrame(_RECIPE, "page string, pos int, fragment string")
    fragments = spark.createDataFrame([(f, f"[{f}]") for f in ("head", "nav", "home", "about", "footer", "close")], "fragment string, text string")
    return pages.assemble(recipe, fragments)


# --- general training-data operators ---


@query(f"""with {HELD}, en as (select snapshot_no, entry_key, fingerprint, {LM} lm from st), sn as (select snapshot_no, lead(snapshot_no) over (order by snapshot_no) nx from (select distinct snapshot_no from held)),
cur as (select * from en where snapshot_no <> (select min(snapshot_no) from held)), prv as (select nx snapshot_no, entry_key, fingerprint, lm from en join sn using (snapshot_no) where nx is not null)
select * from (select coalesce(cur.snapshot_no, prv.snapshot_no) snapshot_no, coalesce(cur.entry_key, prv.entry_key) entry_key,
 case when prv.entry_key is null then 'added' when cur.entry_key is null then 'removed' when cur.fingerprint <> prv.fingerprint or cur.lm <> prv.lm then 'changed' end change_type
 from cur full join prv on cur.snapshot_no = prv.snapshot_no and cur.entry_key = prv.entry_key) where change_type is not null""")
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.snapshot_changes(table(spark, d, "sitemap_lastmod_state"))


@query("select person_id from person_eligible_images where person_id is not null group by 1 having count(*) * 100 >= 3 * (select count(*) from person_eligible_images)")
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return heavykeys.heavy_keys(table(spark, d, "person_eligible_images"), "person_id", 3, 100).select("person_id")


@query(f"""select person_id, count(*) as rows, count(distinct nullif({t('image_name')}, '')) image_count, min(nullif({t('image_name')}, '')) first_image
 from person_eligible_images where person_id is not null group by 1""")
def p4_person_images(spark: SparkSession, d: str) -> DataFrame:
    return heavykeys.key_profile(table(spark, d, "person_eligible_images"))
