"""Requests: what is served for each, which image it shows, which navigation link it lies under."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.functions import documents, urls
from covista.functions.space import blank_to_null, strip
from covista.model import SiteConfig

PEOPLE = r"\A/search/people/[^/]+/?"
DOCUMENT = r"\A/search/document/([^/]+)/?"


def route(requests: DataFrame, cfg: SiteConfig) -> DataFrame:
    """requests with route, action, doc_id, photo, image_url, upstream_url and status.

    route: other, document or people. action: pass (as it comes), shell (the search shell at this
    address), shell_lookup (the same, the image being looked up by doc_id), inject (the page with
    its image tags set). A request other than GET passes.
    """
    path = urls.url_path(F.col("url"))
    get = F.coalesce(F.col("http_method") == "GET", F.lit(False))
    doc = F.regexp_extract(path, DOCUMENT, 1)
    kind = F.when(get & (doc != ""), "document").when(get & path.rlike(PEOPLE), "people").otherwise("other")
    r = requests.select(
        "request_id", "url", "upstream_status", "content_type", kind.alias("route"),
        F.when(kind == "document", urls.unquote_component(doc)).alias("doc_id"),
        F.when(kind != "other", F.nullif(urls.query_value(F.col("url"), "photo"), F.lit(""))).alias("photo"))
    image = urls.cdn_image_requested(F.col("photo"), cfg.cdn_base)
    html = F.coalesce(F.col("content_type").contains("text/html"), F.lit(False))
    missing, fine = F.coalesce(F.col("upstream_status") == 404, F.lit(False)), F.coalesce(F.col("upstream_status") == 200, F.lit(False))
    action = (
        F.when(F.col("route") == "other", "pass")
        .when((F.col("route") == "document") & F.col("photo").isNull(), "shell_lookup")
        .when(F.col("route") == "document", "shell")
        .when(missing, "shell")
        .when(image.isNotNull() & fine & html, "inject")
        .otherwise("pass")
    )
    shell = F.concat(urls.url_origin(F.col("url")), F.lit("/search/index.html"))
    bare = F.regexp_replace("url", r"\?[^#]*", "")
    upstream = F.when(F.col("route") == "document", shell).when((F.col("route") == "people") & missing, shell).when(
        (F.col("route") == "people") & F.col("photo").isNotNull(), bare).otherwise(F.col("url"))
    return r.select(
        "request_id", "route", action.alias("action"), "doc_id", "photo", image.alias("image_url"), upstream.alias("upstream_url"),
        F.when(action.startswith("shell"), F.lit(200)).otherwise(F.col("upstream_status")).alias("status"))


def document_terms(routed: DataFrame, cfg: SiteConfig) -> DataFrame:
    """(term, prefix, valid, looked_up) of every distinct document id asked for."""
    t = routed.where("doc_id is not null").select("doc_id").distinct()
    return t.select("doc_id", documents.term(F.col("doc_id"), cfg.document_prefixes).alias("term"),
                    documents.may_become_id(F.col("doc_id"), cfg.document_prefixes).alias("valid"))


def first_by_prefix(prefixes: DataFrame, items: DataFrame) -> DataFrame:
    """(prefix, first_item): the least item whose document id (last segment, upper case) begins with the prefix.

    Each item is offered under its beginnings of the lengths that are asked for, and meets
    the prefixes by equality; those lengths are few (a bounded list). No match gives null.
    """
    p = prefixes.select(F.upper(strip("prefix")).alias("prefix")).where("prefix <> ''").distinct()
    lengths = p.agg(F.array_sort(F.collect_set(F.length("prefix"))).alias("ls")).scalar()
    name = items.select("image_name").distinct().withColumn("doc", F.upper(F.substring_index("image_name", "/", -1)))
    begun = name.select("image_name", "doc", F.explode(lengths).alias("n")).where(F.col("n") <= F.length("doc")).select(
        F.expr("substring(doc, 1, n)").alias("prefix"), "image_name")
    hit = begun.join(p, "prefix", "left_semi").groupBy("prefix").agg(F.min("image_name").alias("first_item"))
    return p.join(hit, "prefix", "left")


def photo_of(*fields: str) -> Column:
    """The first field of a looked-up row that isn't empty, stripped; null where none is, or it is blank."""
    return blank_to_null(F.coalesce(*[F.nullif(F.col(f), F.lit("")) for f in fields]))


def active_link(paths: DataFrame, cfg: SiteConfig) -> DataFrame:
    """(path, link): the longest navigation link that is a beginning of the path ('/' only for itself); null without one."""
    links = sorted(cfg.nav_links, key=len, reverse=True)
    best = F.lit(None).cast("string")
    for a in reversed(links):
        hit = F.col("path") == "/" if a == "/" else F.col("path").startswith(a)
        best = F.when(hit, a).otherwise(best)
    return paths.select("path", best.alias("link"))
