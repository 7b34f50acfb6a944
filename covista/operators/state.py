"""Incremental last-modified state: reading both versions, merging, reporting changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covista.operators.snapshots import entry_fingerprint, entry_key, PEOPLE_PREFIX, url_path


def read_entries(docs: DataFrame, beside: tuple[str, ...] = ()) -> DataFrame:
    """(*beside, entry_key, fingerprint, lastmod) of state documents (version, entries, urls, columns kept beside), both versions.

    Version 1, or no version and only ``urls``, is migrated; version 2, or no version
    with ``entries``, is taken as it is; another version, a missing map, an entry without
    fingerprint or lastmod, and a version-1 address that is no known page are errors.
    """
    old = (F.col("version") == 1) | (F.col("version").isNull() & F.col("urls").isNotNull() & F.col("entries").isNull())
    bad = F.col("version").isNotNull() & ~F.col("version").isin(1, 2)
    need = F.when(old, F.col("urls")).otherwise(F.col("entries"))
    checked = (
        F.when(bad, F.raise_error(F.concat(F.lit("unknown state version "), F.col("version").cast("string"))))
        .when(F.col("version").isNotNull() & need.isNull(), F.raise_error(F.lit("a state without entries")))
        .otherwise(need)
    )
    e = docs.select(*beside, F.coalesce(old, F.lit(False)).alias("old"), F.explode(checked).alias("k", "v"))
    whole = F.when(F.col("v.fingerprint").isNull() | F.col("v.lastmod").isNull(),
                   F.raise_error(F.concat(F.lit("incomplete entry "), F.col("k")))).otherwise(F.col("k"))
    return migrate_v1(e.where("old").select(*beside, whole.alias("url"), "v.fingerprint", "v.lastmod"), beside=beside).unionByName(
        e.where("not old").select(*beside, whole.alias("entry_key"), "v.fingerprint", "v.lastmod"))


def migrate_v1(rows: DataFrame, core: tuple[str, ...] = ("/", "/search/", "/people/", "/about/"), beside: tuple[str, ...] = ()) -> DataFrame:
    """(entry_key, fingerprint, lastmod) of version-1 rows (url, fingerprint, lastmod); an unknown address is an error."""
    path, one = url_path(F.col("url")), F.lit(1)
    known = path.isin(*core) | (path.startswith(PEOPLE_PREFIX) & (F.length(path) > len(PEOPLE_PREFIX)))
    key = F.when(~known, F.raise_error(F.concat(F.lit("unknown address "), F.col("url")))).otherwise(entry_key(F.col("url"), one))
    return rows.select(*beside, key.alias("entry_key"), entry_fingerprint(F.col("url"), F.col("fingerprint"), one).alias("fingerprint"), "lastmod")


def merge_lastmod(new: DataFrame, previous: DataFrame, as_of: str) -> DataFrame:
    """(entry_key, fingerprint, lastmod) of exactly the new keys.

    New or changed fingerprints get ``as_of``; unchanged ones keep their lastmod, or get
    ``as_of`` where it is null or blank. Running it twice changes nothing.
    """
    p = previous.select(F.col("entry_key").alias("k"), F.col("fingerprint").alias("pf"), F.col("lastmod").alias("pl"))
    lm = F.when(F.col("pf").isNull() | (F.col("pf") != F.col("fingerprint")), F.lit(as_of)).otherwise(
        F.coalesce(F.nullif("pl", F.lit("")), F.lit(as_of)))
    return new.join(p, new["entry_key"] == p["k"], "left").select("entry_key", "fingerprint", lm.alias("lastmod"))


def change_report(new: DataFrame, previous: DataFrame) -> DataFrame:
    """(entry_key, change_type) of all keys: new, changed, unchanged or removed; one aggregation, no join."""
    both = new.select("entry_key", F.col("fingerprint").alias("n"), F.lit(None).cast("string").alias("p"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        previous.select("entry_key", F.lit(None).cast("string").alias("n"), F.col("fingerprint").alias("p"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    g = both.groupBy("entry_key").agg(F.max("n").alias("n"), F.max("p").alias("p"), F.max("a").alias("a"), F.max("b").alias("b"))
    kind = F.when(F.col("b") == 0, "new").when(F.col("a") == 0, "removed").when(F.col("n").eqNullSafe(F.col("p")), "unchanged").otherwise("changed")
    return g.select("entry_key", kind.alias("change_type"))


def removed_keys(new: DataFrame, previous: DataFrame) -> DataFrame:
    return previous.select("entry_key").join(new.select("entry_key"), "entry_key", "left_anti")


def shard_of(key: Column, shards: Column) -> Column:
    """Shard of an entry: by a hash of its key, so shards are of even size whatever the keys look like."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % shards


def sharded(entries: DataFrame, shard_entries: int) -> DataFrame:
    """entries with ``shard``: as many shards as hold about ``shard_entries`` each, one at least."""
    n = entries.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / shard_entries)).alias("n")).scalar()
    return entries.withColumn("shard", shard_of(F.col("entry_key").cast("binary"), n))


def state_json(entries: DataFrame, group: str) -> DataFrame:
    """(group, json): one version-2 document for each group of entries, sorted by key.

    The state is written as documents of bounded size (its shards), not as one object.
    """
    e = F.array_sort(F.collect_list(F.struct("entry_key", F.struct("fingerprint", "lastmod").alias("v"))))
    g = entries.groupBy(group).agg(F.map_from_entries(e).alias("entries"))
    doc = F.struct(F.lit(2).alias("version"), F.col("entries"))
    return g.select(group, F.to_json(doc, {"ignoreNullFields": "false"}).alias("json"))
