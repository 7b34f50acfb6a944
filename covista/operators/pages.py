"""Result pages: labels, headings, addresses, fingerprints, manifest, sitemap and HTML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from covista.functions import labels, markup, urls
from covista.model import SiteConfig
from covista.session import materialise


def entity_labels(entities: DataFrame) -> DataFrame:
    """(person_id, label) of a dimension with one row an entity."""
    return entities.select("person_id", labels.chip_label("person_id", "name").alias("label"))


def labelled(pages: DataFrame, key: str, entities: DataFrame) -> DataFrame:
    """(key, labels array): labels of each page's ids in their order; ids without a name stand for themselves."""
    one = pages.select(key, F.posexplode("ids").alias("pos", "person_id"))
    named = one.join(entity_labels(entities), "person_id", "left")
    label = F.coalesce("label", "person_id")
    return named.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", label.alias("label")))), lambda x: x["label"]).alias("labels"))


def headings(pages: DataFrame, entities: DataFrame, cfg: SiteConfig) -> DataFrame:
    """(slug, heading, title, description) of pages (ids, image_total)."""
    p = pages.withColumn("slug", labels.slug(F.col("ids")))
    h = labelled(p, "slug", entities).select("slug", labels.heading(F.col("labels")).alias("heading"))
    return p.join(h, "slug").select(
        "slug", "heading", F.concat("heading", F.lit(cfg.title_suffix)).alias("title"),
        labels.meta_description(F.col("heading"), F.col("image_total"), cfg.described_as).alias("description"))


def representative_images(combos: DataFrame, entities: DataFrame, cfg: SiteConfig) -> DataFrame:
    """combos with og_image_url: of one entity its best face, else (and for sets) the first common item."""
    faces = entities.select(F.col("person_id").alias("id1"), urls.face_url(
        F.col("person_id"), F.col("name"), F.col("best_face_id"), cfg.cdn_base).alias("face"))
    first = urls.cdn_image_published(F.col("first_item"), cfg.cdn_base)
    return (
        combos.withColumn("id1", F.when(F.size("ids") == 1, F.col("ids")[0])).join(faces, "id1", "left")
        .select(*combos.columns, F.coalesce("face", first).alias("og_image_url"))
    )


def manifest(combos: DataFrame, entities: DataFrame, cfg: SiteConfig) -> DataFrame:
    """(path, canonical_url, person_ids, image_total, og_image_url) of every non-empty set."""
    path = F.concat(F.lit("/search/people/"), labels.slug(F.col("ids")), F.lit("/"))
    return representative_images(combos, entities, cfg).select(
        path.alias("path"), F.concat(F.lit(cfg.site_origin.rstrip("/")), path).alias("canonical_url"),
        F.col("ids").alias("person_ids"), "image_total", "og_image_url")


def manifest_envelope(m: DataFrame, site_origin: str | None = None) -> DataFrame:
    """One row (site_origin, page_count) for a manifest."""
    return m.agg(F.count(F.lit(1)).alias("page_count")).select(F.lit(site_origin).cast("string").alias("site_origin"), "page_count")


def numbered_by(rows: DataFrame, key: str) -> DataFrame:
    """rows with i, their number from 0 in the order of ``key``, without a single-task window over them.

    Rows are range-partitioned and sorted, each partition is counted, and a row's number is its place plus
    the partitions before it. Written once: range bounds are sampled, and partition numbers must be computed once.
    """
    ranged = materialise(rows.repartitionByRange(key).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("_part", F.coalesce(F.sum("n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_skip"))
    w = Window.partitionBy("_part").orderBy(key)
    # few rows: one a partition
    return ranged.join(F.broadcast(before), "_part").withColumn("i", F.row_number().over(w) - 1 + F.col("_skip")).drop("_part", "_skip")


def page_fingerprints(pages: DataFrame) -> DataFrame:
    """(entry_key, fingerprint): the slug, and the count of items as text."""
    return pages.select(labels.slug(F.col("ids")).alias("entry_key"), F.col("image_total").cast("string").alias("fingerprint"))


def fingerprint_union(pages: DataFrame, core: DataFrame) -> DataFrame:
    """Page fingerprints overlaid with those of the core paths, which win; one row a key."""
    kept = pages.join(core.select("entry_key"), "entry_key", "left_anti")
    return kept.unionByName(core)


def sitemap_entries(locs: DataFrame, lastmods: DataFrame) -> DataFrame:
    """(loc, entry): a sitemap element for every address, in order of loc; an address without lastmod is an error."""
    both = locs.select("loc").join(lastmods.select("loc", "lastmod"), "loc", "left")
    lm = F.when(F.col("lastmod").isNull(), F.raise_error(F.concat(F.lit("no lastmod for "), F.col("loc")))).otherwise(F.col("lastmod"))
    entry = F.concat(
        F.lit("  <url>\n    <loc>"), markup.escape(F.col("loc"), markup.XML_TEXT), F.lit("</loc>\n    <lastmod>"),
        markup.escape(lm, markup.XML_TEXT), F.lit("</lastmod>\n  </url>"))
    return both.select("loc", entry.alias("entry")).orderBy("loc")


def sitemap_locs(state: DataFrame, cfg: SiteConfig) -> DataFrame:
    """(loc, lastmod) of a state (entry_key, lastmod)."""
    return state.select(urls.canonical_url(F.col("entry_key"), cfg.site_origin, cfg.core_paths).alias("loc"), "lastmod")


def _social(title: Column, desc: Column, address: Column, site: Column, locale: Column) -> list[tuple[str, str, Column]]:
    return [("property", "og:title", title), ("property", "og:description", desc), ("property", "og:url", address),
            ("property", "og:site_name", site), ("property", "og:locale", locale), ("property", "og:type", F.lit("website"))]


# The lines of a document's head that every page has.
def _head(title: Column, desc: Column, address: Column, tags: Column) -> Column:
    """Document head; all values come escaped."""
    return F.concat(
        F.lit('<!DOCTYPE html>\n<html lang="en">\n<head>\n  <meta charset="utf-8">\n'
              '  <meta name="viewport" content="width=device-width, initial-scale=1, viewport-fit=cover">\n  <title>'),
        title, F.lit("</title>\n"), markup.meta_lines([("name", "description", desc)]),
        F.lit('  <link rel="canonical" href="'), address, F.lit('" />\n'), tags,
        F.lit('  <link rel="icon" type="image/svg+xml" href="/favicon.svg">\n  <link rel="stylesheet" href="/styles.css">\n'
              '  <script src="/js/nav.js" defer></script>\n  <script src="/js/disclaimer.js" defer></script>\n</head>\n'))


def page_head(title: Column, desc: Column, address: Column, image: Column, cfg: SiteConfig) -> Column:
    """Head of a result page; without an image of its own it shows the default one."""
    e = markup.escape
    img = e(F.coalesce(F.nullif(image, F.lit("")), F.lit(f"{cfg.cdn_base}/og/{cfg.default_og_file}")))
    t, d, a = e(title), e(desc), e(address)
    tags = _social(t, d, a, e(F.lit(cfg.site_name)), e(F.lit(cfg.locale))) + [
        ("name", "twitter:title", t), ("name", "twitter:description", d),
        ("property", "og:image", img), ("property", "og:image:secure_url", img),
        ("name", "twitter:card", F.lit("summary_large_image")), ("name", "twitter:image", img)]
    return _head(t, d, a, markup.meta_lines(tags))


def bootstrap_json(ids: Column, total: Column) -> Column:
    """Compact JSON a page starts from."""
    path = F.concat(F.lit("/search/people/"), labels.slug(ids), F.lit("/"))
    return F.to_json(F.struct(ids.alias("person_ids"), total.alias("image_total"), path.alias("canonical_path")))


def static_pages(pages: DataFrame, entities: DataFrame, cfg: SiteConfig, nav: str = "", body: str = "", footer: str = "",
                 disclaimer: str = "") -> DataFrame:
    """(slug, html) of pages (ids, image_total, canonical_url, og_image_url): head, fragments, bootstrap."""
    p = pages.withColumn("slug", labels.slug(F.col("ids")))
    h = headings(pages.select("ids", "image_total"), entities, cfg)
    both = p.join(h, "slug")
    html = F.concat(
        page_head(F.col("title"), F.col("description"), F.col("canonical_url"), F.col("og_image_url"), cfg),
        F.lit('<body class="page-search">\n' + nav + f"<script>window.{cfg.bootstrap_name}="),
        bootstrap_json(F.col("ids"), F.col("image_total")),
        F.lit(";</script>\n" + body + footer + disclaimer + "</body>\n</html>\n"))
    return both.select("slug", html.alias("html"))


def metadata_rows(meta: DataFrame) -> DataFrame:
    """One row a page of the site metadata (shared struct, pages array), with the shared values beside it."""
    return meta.select("shared.*", F.explode("pages").alias("p")).select("*", "p.*").drop("p")


def duplicate_outputs(rows: DataFrame) -> DataFrame:
    """(out, n) of outputs named more than once."""
    return rows.groupBy("out").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def head_partials(rows: DataFrame, banner: str) -> DataFrame:
    """(out, html): the head of each page of the metadata, down to the opening body tag; a repeated ``out`` is an error."""
    e = lambda c: markup.escape(F.col(c).cast("string"), markup.HTML_ATTRIBUTE)
    strip_slash = lambda c: F.regexp_replace(F.col(c), r"/+\z", "")
    address = markup.escape(F.concat(strip_slash("site_origin"), F.col("url_path")), markup.HTML_ATTRIBUTE)
    img = markup.escape(F.concat(strip_slash("spaces_cdn_base"), F.lit("/og/"), F.col("og_image_filename")), markup.HTML_ATTRIBUTE)
    t, d = e("title"), e("description")
    tags = _social(t, d, address, e("og_site_name"), e("og_locale")) + [
        ("property", "og:image", img), ("property", "og:image:secure_url", img), ("property", "og:image:type", e("og_image_type")),
        ("property", "og:image:width", e("og_image_width")), ("property", "og:image:height", e("og_image_height")),
        ("property", "og:image:alt", e("og_image_alt")), ("name", "twitter:card", e("twitter_card")),
        ("name", "twitter:title", t), ("name", "twitter:description", d), ("name", "twitter:image", img)]
    html = F.concat(F.lit(banner + "\n"), _head(t, d, address, markup.meta_lines(tags)), F.lit('<body class="'), e("body_class"), F.lit('">\n'))
    n = F.count(F.lit(1)).over(Window.partitionBy("out"))
    checked = F.when(n > 1, F.raise_error(F.concat(F.lit("repeated output "), F.col("out")))).otherwise(html)
    return rows.select("out", checked.alias("html"))


def assemble(recipe: DataFrame, fragments: DataFrame) -> DataFrame:
    """(page, html): fragments joined in the order of the recipe (page, pos, fragment); a missing fragment is an error."""
    both = recipe.join(fragments, "fragment", "left")
    text = F.when(F.col("text").isNull(), F.raise_error(F.concat(F.lit("no fragment "), F.col("fragment")))).otherwise(F.col("text"))
    return both.groupBy("page").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", text.alias("text")))), lambda x: x["text"]), "").alias("html"))
