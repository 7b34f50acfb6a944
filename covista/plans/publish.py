"""One publishing run: every non-empty set of entities as a page, manifest, sitemap, and the state that dates them."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covista.model import SiteConfig
from covista.operators import cooc, membership, pages, state
from covista.session import materialise
from covista.sources import files


@dataclass(frozen=True)
class Fragments:
    """Texts that every page shares."""

    nav: str = ""
    body: str = ""
    footer: str = ""
    disclaimer: str = ""


def publish(spark: SparkSession, pei: DataFrame, people: DataFrame, core: DataFrame, out: str, state_path: str,
            cfg: SiteConfig | None = None, fragments: Fragments = Fragments(), as_of: str | None = None, dry_run: bool = False) -> dict:
    """Counts of the run (in_network, max_k, generated, skipped_empty, urls, entries); writes under ``out`` unless dry_run.

    core: (entry_key, fingerprint) of the core paths. The previous state must exist. The combinations are
    computed once and serve all outputs. Pages, manifest and sitemap are written before the state is
    swapped: a run that breaks off leaves the old state, and the next run dates its changes again.
    as_of: date of new and changed pages, by default today in UTC. No entity in the network is an error.
    """
    cfg = cfg or SiteConfig()
    as_of = as_of or dt.datetime.now(dt.timezone.utc).date().isoformat()
    entities = membership.network_people(people)
    if entities.isEmpty():
        raise ValueError("no entity is in the network")
    members = membership.network_membership(pei, people)
    if dry_run:
        return cooc.run_summary(members, entities.select("person_id"), cfg.max_k).first().asDict()

    previous = materialise(files.read_state(spark, state_path), "previous-state")
    combos = materialise(cooc.combinations(members, cfg.max_k), "combinations")
    listed = pages.manifest(combos, entities, cfg)
    new = pages.fingerprint_union(pages.page_fingerprints(combos), core)
    merged = materialise(state.merge_lastmod(new, previous, as_of), "merged-state")
    locs = pages.sitemap_locs(merged, cfg)

    rendered = pages.static_pages(listed.withColumnRenamed("person_ids", "ids"), entities, cfg, fragments.nav, fragments.body,
                                  fragments.footer, fragments.disclaimer)
    files.write_pages(rendered, f"{out}/pages")
    files.write_manifest(listed, f"{out}/manifest", cfg.site_origin)
    files.write_sitemap(pages.sitemap_entries(locs.select("loc"), locs), f"{out}/sitemap", f"{cfg.site_origin.rstrip('/')}/sitemap")
    files.write_state(merged, state_path)
    n, generated, entries = entities.count(), combos.count(), merged.count()
    every = sum(math.comb(n, k) for k in range(1, cfg.max_k + 1))
    return {"in_network": n, "max_k": cfg.max_k, "generated": generated, "skipped_empty": every - generated, "urls": entries, "entries": entries}


def core_fingerprints(spark: SparkSession, built: dict[str, str]) -> DataFrame:
    """(entry_key, fingerprint) of the built core pages (core path -> file): a hash of the content.

    A content hash changes only when the page does; rebuilding an equal page keeps its date. A missing file is an error.
    """
    parts = None
    for key, file in built.items():
        one = spark.read.format("binaryFile").load(file).select(
            F.lit(key).alias("entry_key"), F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("fingerprint"))
        parts = one if parts is None else parts.unionByName(one)
    return parts if parts is not None else spark.createDataFrame([], "entry_key string, fingerprint string")
