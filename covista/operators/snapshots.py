"""What changed between consecutive full snapshots.

Every held entry is tagged twice, as the *new* side of its own snapshot and as
the *old* side of the next one; one aggregation by (snapshot, key) then sees
both sides' row hashes and classifies the key. Nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from covista.functions.space import strip

PEOPLE_PREFIX = "/search/people/"
#: Up to so many snapshots the (snapshot, next) list is broadcast; beyond, it is joined by shuffle.
BROADCAST_SNAPSHOTS = 100_000


PATH_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def _slashed(path: Column) -> Column:
    return F.when(path == "", "/").when(path.endswith("/"), path).otherwise(F.concat(path, F.lit("/")))


def url_path(url: Column) -> Column:
    """Path of a URL, ``/`` when empty, always with a closing slash."""
    return _slashed(F.regexp_extract(url, PATH_PATTERN, 1))


def entry_key(key: Column, version: Column, path: Column | None = None) -> Column:
    """Key in the form of version 2: a page's slug or a core path. Keys of version 1 are URLs.

    path: ``url_path(key)`` where it is already a column.
    """
    path = url_path(key) if path is None else path
    page = path.startswith(PEOPLE_PREFIX) & (F.length(path) > len(PEOPLE_PREFIX))
    slug = path.substr(F.lit(len(PEOPLE_PREFIX) + 1), F.length(path) - len(PEOPLE_PREFIX) - 1)
    return F.when(version == 1, F.when(page, slug).otherwise(path)).otherwise(key)


def entry_fingerprint(key: Column, fingerprint: Column, version: Column, path: Column | None = None) -> Column:
    """Fingerprint in the form of version 2: of a version-1 page, what follows the last ``|``."""
    path = url_path(key) if path is None else path
    page = path.startswith(PEOPLE_PREFIX) & (F.length(path) > len(PEOPLE_PREFIX))
    return F.when((version == 1) & page, F.substring_index(fingerprint, "|", -1)).otherwise(fingerprint)


def lastmod_date(lastmod: Column) -> Column:
    """The date of a lastmod; null and blank are one value, a time of day is dropped."""
    s = strip(lastmod)
    dated = F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2})(?:[T\s].*)?$", 1)
    return F.when(F.coalesce(s, F.lit("")) == "", F.lit("")).when(dated != "", dated).otherwise(s)


def held_shards(df: DataFrame) -> DataFrame:
    """Of each (snapshot_no, shard_no) the delivery that holds: the latest one, alone.

    Null delivery times rank first, a null shard_no is a shard of its own, rows
    without snapshot_no belong to no snapshot. Of deliveries of the same time one
    holds whole, chosen by content hash, so the result doesn't depend on row order;
    rows repeated in full change nothing.
    """
    at = F.coalesce(F.unix_micros(F.col("delivered_at").cast("timestamp")), F.lit(-(2**62)))
    rows = df.where(F.col("snapshot_no").isNotNull()).select(
        "snapshot_no", "shard_no", "version", "entries", at.alias("_at"),
        F.xxhash64(F.col("version"), F.array_sort(F.map_entries("entries"))).alias("_h"),
    )
    # Narrow rows decide; the maps themselves are read by the second branch only.
    last = rows.groupBy("snapshot_no", "shard_no").agg(F.max("_at").alias("_last"))
    tie = (
        rows.alias("r")
        .join(last.alias("l"), (F.col("r.snapshot_no") == F.col("l.snapshot_no"))
              & F.col("r.shard_no").eqNullSafe(F.col("l.shard_no")) & (F.col("r._at") == F.col("l._last")))
        .select("r.*")
    )
    w = Window.partitionBy("snapshot_no", "shard_no").orderBy("_h")
    return tie.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("snapshot_no", "version", "entries")


def _with_path(e: DataFrame) -> DataFrame:
    """e (k, version, ...) with the path of version-1 keys as a column, so that its pattern is matched once a row."""
    raw = F.regexp_extract("k", PATH_PATTERN, 1)
    return e.withColumn("_raw", F.when(F.col("version") == 1, raw)).withColumn("_path", _slashed(F.col("_raw")))


def snapshot_entries(df: DataFrame, raw: bool = False, version: int | None = None) -> DataFrame:
    """(snapshot_no, entry_key, fingerprint, lastmod) of the deliveries that hold, in the form of version 2.

    ``raw`` keeps lastmods as written; ``version`` takes the shards of one version only (null counts as 2).
    """
    e = held_shards(df).select("snapshot_no", F.coalesce("version", F.lit(2)).alias("version"),
                               F.explode("entries").alias("k", "v"))
    if version is not None:
        e = e.where(F.col("version") == version)
    return _with_path(e).select(
        "snapshot_no",
        entry_key(F.col("k"), F.col("version"), F.col("_path")).alias("entry_key"),
        entry_fingerprint(F.col("k"), F.col("v.fingerprint"), F.col("version"), F.col("_path")).alias("fingerprint"),
        (F.col("v.lastmod") if raw else lastmod_date(F.col("v.lastmod"))).alias("lastmod"),
    )


def _with_next(df: DataFrame) -> DataFrame:
    """df with ``_next``, the snapshot that follows (null for the last), and ``_first``."""
    spark = df.sparkSession
    nos = df.select("snapshot_no").distinct()
    head = [r[0] for r in nos.orderBy("snapshot_no").limit(BROADCAST_SNAPSHOTS + 1).collect()]
    kind = df.schema["snapshot_no"].dataType
    schema = T.StructType([T.StructField("snapshot_no", kind), T.StructField("_next", kind),
                           T.StructField("_first", T.BooleanType())])
    if len(head) <= BROADCAST_SNAPSHOTS:
        rows = [(n, head[i + 1] if i + 1 < len(head) else None, i == 0) for i, n in enumerate(head)]
        return df.join(F.broadcast(spark.createDataFrame(rows, schema)), "snapshot_no")
    w = Window.orderBy("snapshot_no")
    listed = nos.select("snapshot_no", F.lead("snapshot_no").over(w).alias("_next"),
                        (F.row_number().over(w) == 1).alias("_first"))
    return df.join(listed, "snapshot_no")


def snapshot_changes(df: DataFrame) -> DataFrame:
    """(snapshot_no, entry_key, change_type) for every snapshot after the first.

    ``df``: snapshot_no, shard_no, delivered_at, version, entries (extra columns are
    ignored). change_type is added, removed or changed; unchanged keys give no row.
    Snapshots are consecutive in the order of snapshot_no, gaps included. Should two
    held shards of one snapshot carry the same key, the entry with the greater row
    hash counts. Null or empty entries are an empty shard; an empty table or a single
    snapshot gives no row.
    """
    df = df.select("snapshot_no", "shard_no", "delivered_at", "version", "entries")
    held = _with_next(held_shards(df))
    e = held.select("snapshot_no", "_next", "_first", F.coalesce("version", F.lit(2)).alias("version"),
                    F.explode("entries").alias("k", "v"))
    e = _with_path(e)
    e = e.select(
        "snapshot_no", "_next", "_first",
        entry_key(F.col("k"), F.col("version"), F.col("_path")).alias("entry_key"),
        F.xxhash64(entry_fingerprint(F.col("k"), F.col("v.fingerprint"), F.col("version"), F.col("_path")),
                   lastmod_date(F.col("v.lastmod"))).alias("h"),
    )
    sides = F.array(
        F.when(~F.col("_first"), F.struct(F.col("snapshot_no").alias("at"), F.lit(True).alias("new"))),
        F.when(F.col("_next").isNotNull(), F.struct(F.col("_next").alias("at"), F.lit(False).alias("new"))),
    )
    tagged = e.select("entry_key", "h", F.explode(F.array_compact(sides)).alias("side")).select(
        F.col("side.at").alias("snapshot_no"), "entry_key",
        F.when(F.col("side.new"), F.col("h")).alias("h_new"),
        F.when(~F.col("side.new"), F.col("h")).alias("h_old"),
    )
    both = tagged.groupBy("snapshot_no", "entry_key").agg(F.max("h_new").alias("n"), F.max("h_old").alias("o"))
    kind = (
        F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("n") != F.col("o"), "changed")
    )
    return both.select("snapshot_no", "entry_key", kind.alias("change_type")).where(F.col("change_type").isNotNull())
