"""URLs: percent encoding, CDN addresses, canonical paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from covista.functions.labels import chip_label, file_label
from covista.functions.space import blank_to_null, strip


def quote(c: Column) -> Column:
    """Percent encoding that leaves letters, digits and ``_.-~`` (RFC 3986)."""
    e = F.url_encode(c)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        e = F.replace(e, F.lit(a), F.lit(b))
    return e


def quote_component(c: Column) -> Column:
    """Percent encoding of a browser's URI component: ``!*'()`` stay too."""
    e = quote(c)
    for code, ch in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%2A", "*")):
        e = F.replace(e, F.lit(code), F.lit(ch))
    return e


def unquote_component(c: Column) -> Column:
    """Decoded URI component; a malformed one stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def unquote_query(c: Column) -> Column:
    """Decoded value of a query parameter, '+' being a space; malformed escapes stay."""
    return F.coalesce(F.try_url_decode(c), F.replace(c, F.lit("+"), F.lit(" ")))


def url_path(url: Column) -> Column:
    """Path of a URL as written, without query and fragment ('' if there is none)."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_origin(url: Column) -> Column:
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)


def query_value(url: Column, name: str) -> Column:
    """First value of a query parameter, decoded; null where it is absent."""
    raw = F.regexp_extract(url, rf"^[^?#]*\?(?:[^#]*&)??{name}(=[^&#]*|(?=[&#]|\z))", 1)
    there = F.regexp_like(url, F.lit(rf"^[^?#]*\?(?:[^#]*&)??{name}(?:=|[&#]|\z)"))
    return F.when(there, unquote_query(F.substring(raw, 2, 1_000_000)))


def normal_path(url: Column) -> Column:
    """Path with a closing slash; '/' for none."""
    p = url_path(url)
    return F.when(p == "", "/").when(p.endswith("/"), p).otherwise(F.concat(p, F.lit("/")))


def last_segment(path: Column) -> Column:
    return F.substring_index(strip(F.coalesce(path, F.lit(""))), "/", -1)


def cdn_asset(path: Column, base: str) -> Column:
    """Address of a path at the CDN; full http(s) addresses pass, null and '' give null."""
    s = strip(path)
    return F.when(F.coalesce(path, F.lit("")) == "", F.lit(None)).when(s.rlike(r"(?i)\Ahttps?://"), s).otherwise(
        F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(s, r"\A/+", "")))


def cdn_file(path: Column, base: str, folder: str) -> Column:
    """Address of a path's last segment in a CDN folder; null where there is none."""
    b = last_segment(path)
    return F.when(b != "", F.concat(F.lit(f"{base.rstrip('/')}/{folder}/"), quote_component(b)))


def cdn_thumbnail(path: Column, base: str) -> Column:
    """Address of the thumbnail: last extension dropped, ``.webp``."""
    b = last_segment(path)
    return F.when(b != "", F.concat(F.lit(f"{base.rstrip('/')}/thumbnails/"), quote_component(
        F.regexp_replace(b, r"\.[^.]+\z", "")), F.lit(".webp")))


def cdn_image_published(name: Column, base: str) -> Column:
    """Address of an image in published pages: last segment, stripped, every ``.jpg`` made ``.webp``."""
    b = F.replace(strip(F.substring_index(name, "/", -1)), F.lit(".jpg"), F.lit(".webp"))
    return F.concat(F.lit(f"{base}/images/"), quote(b))


def cdn_image_requested(raw: Column, base: str) -> Column:
    """Address of an image named in a request: stripped, last segment (all, if it ends in '/'), a closing .jpg in any case made .webp."""
    t = strip(raw)
    seg = F.substring_index(t, "/", -1)
    b = F.regexp_replace(F.when(seg == "", t).otherwise(seg), r"(?i)\.jpg\z", ".webp")
    return F.when(F.coalesce(t, F.lit("")) != "", F.concat(F.lit(f"{base.rstrip('/')}/images/"), quote_component(b)))


def face_url(entity_id: Column, name: Column, face: Column, base: str) -> Column:
    """Address of an entity's best face; null without one. Not percent encoded."""
    f = blank_to_null(face)
    label = file_label(chip_label(entity_id, name))
    return F.when(f.isNotNull(), F.concat(F.lit(f"{base}/faces/"), label, F.lit("_"), f, F.lit(".webp")))


def atlas_url(base: str, file: str = "atlas.webp") -> Column:
    """Address of the sprite atlas at the CDN."""
    return F.lit(f"{base.rstrip('/')}/atlas/{file}")


def directory_url(base: str, limit: Column, offset: Column, classes: Column) -> Column:
    """Address of a page of the directory: limit, offset and the class parameter (null leaves it out, '' is an empty choice)."""
    return F.concat(F.lit(f"{base.rstrip('/')}/faces?limit="), limit.cast("string"), F.lit("&offset="), offset.cast("string"),
                    F.when(classes.isNull(), F.lit("")).otherwise(F.concat(F.lit("&classes="), quote_component(classes))))


def people_url(ids: Column) -> Column:
    """Canonical path of a set of ids: stripped, blanks dropped, sorted; null where none is left."""
    kept = F.array_sort(F.filter(F.transform(ids, lambda x: strip(F.coalesce(x, F.lit("")))), lambda x: x != ""))
    return F.when(F.size(kept) > 0, F.concat(F.lit("/search/people/"), F.array_join(kept, "-"), F.lit("/")))


def canonical_url(key: Column, origin: str, core: tuple[str, ...]) -> Column:
    """Full address of a state key: a core path, or the slug of a people page."""
    o = origin.rstrip("/")
    return F.when(key.isin(*core), F.concat(F.lit(o), key)).otherwise(
        F.concat(F.lit(f"{o}/search/people/"), key, F.lit("/")))
