"""Configuration and schemas of the engine."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class SiteConfig:
    """What a deployment sets: origins, names, limits. Defaults fit the test tables."""

    site_origin: str = "https://h.example"
    cdn_base: str = "https://cdn.h.example"
    site_name: str = "h.example"
    title_suffix: str = " · Archive"
    described_as: str = "Archive"
    locale: str = "en_US"
    max_k: int = 3
    core_paths: tuple[str, ...] = ("/", "/search/", "/people/", "/about/")
    document_prefixes: tuple[str, ...] = ("LMP", "ALBUM_")
    page_size: int = 1000
    atlas_columns: int = 21
    atlas_tile: int = 100
    bootstrap_name: str = "__STATIC_SEARCH__"
    default_og_file: str = "search.webp"
    nav_links: tuple[str, ...] = field(default=("/", "/search/", "/people/", "/about/"))

    def __post_init__(self):
        if self.max_k < 1:
            raise ValueError("max_k must be at least 1")


@dataclass(frozen=True)
class StoreSettings:
    """Where an object store's state lies. Every setting is needed; blank is unset."""

    endpoint: str
    bucket: str
    key: str
    secret: str
    prefix: str = "covista.store."

    @classmethod
    def read(cls, settings: Mapping[str, str], prefix: str = "covista.store.") -> StoreSettings:
        got = {x: setting(settings, prefix + x) for x in ("endpoint", "bucket", "key", "secret")}
        if missing := sorted(k for k, v in got.items() if v is None):
            raise ValueError(f"settings missing or blank: {', '.join(prefix + x for x in missing)}")
        return cls(**got, prefix=prefix)

    def hadoop(self) -> dict[str, str]:
        """Hadoop settings of this bucket."""
        at = f"fs.s3a.bucket.{self.bucket}."
        return {at + "endpoint": self.endpoint, at + "access.key": self.key, at + "secret.key": self.secret}

    def uri(self, path: str) -> str:
        return f"s3a://{self.bucket}/{path.lstrip('/')}"


def setting(settings: Mapping[str, str], name: str, default: str | None = None) -> str | None:
    """A setting without the white space around it; a blank one counts as unset."""
    return (settings.get(name) or "").strip() or default


STATE_ENTRY = T.StructType([T.StructField("fingerprint", T.StringType()), T.StructField("lastmod", T.StringType())])
STATE_V2 = T.StructType([T.StructField("version", T.IntegerType()), T.StructField("entries", T.MapType(T.StringType(), STATE_ENTRY)),
                         T.StructField("urls", T.MapType(T.StringType(), STATE_ENTRY))])
TILE = T.StructType([T.StructField(x, T.IntegerType()) for x in "xywh"])
ATLAS = T.MapType(T.StringType(), TILE)
METADATA = T.StructType([
    T.StructField("shared", T.StructType([
        *(T.StructField(x, T.StringType()) for x in ("site_origin", "spaces_cdn_base", "og_site_name", "og_locale", "og_image_type")),
        T.StructField("og_image_width", T.IntegerType()), T.StructField("og_image_height", T.IntegerType()),
        T.StructField("twitter_card", T.StringType())])),
    T.StructField("pages", T.ArrayType(T.StructType([
        T.StructField(x, T.StringType())
        for x in ("out", "url_path", "body_class", "title", "description", "og_image_filename", "og_image_alt")]))),
])
