"""Files the engine reads and writes besides tables: state, pages, manifest, sitemap, metadata, atlas.

Everything goes through Spark's file systems, so a path may lie in an object store.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covista.model import METADATA, STATE_V2
from covista.operators import atlas, pages, state

#: Entries in one written state document.
STATE_SHARD_ENTRIES = 50_000


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _swap(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another; the old one is removed last.

    A file system reports a rename that failed by false: the old folder is then put back, and it is an error.
    """
    target, fs = _fs(spark, path)
    made, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (new, f"{path}.old-{uuid.uuid4().hex}"))
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        fs.delete(made, True)
        raise OSError(f"{path} can't be moved away; it stays as it was")
    if not fs.rename(made, target):
        if had:
            fs.rename(old, target)
        fs.delete(made, True)
        raise OSError(f"{path} can't be replaced; it stays as it was")
    if had:
        fs.delete(old, True)


def read_state(spark: SparkSession, path: str, must_exist: bool = True) -> DataFrame:
    """Entries of the state documents (JSON, one a line) under a path; a missing path is an error or an empty state."""
    if not exists(spark, path):
        if must_exist:
            raise FileNotFoundError(f"no state at {path}; seed it with an empty version-2 document")
        return spark.createDataFrame([], "entry_key string, fingerprint string, lastmod string")
    docs = spark.read.text(path).select(F.from_json("value", STATE_V2).alias("s")).select("s.*")
    return state.read_entries(docs)


def write_state(entries: DataFrame, path: str, shard_entries: int = STATE_SHARD_ENTRIES) -> None:
    """Replace the state: written beside it in documents of bounded size, then swapped, so it may be read in the same run."""
    spark = entries.sparkSession
    rows = entries.select("entry_key", "fingerprint", "lastmod")
    docs = state.state_json(state.sharded(rows, shard_entries), "shard")
    tmp = f"{path}.new-{uuid.uuid4().hex}"
    docs.select(F.col("json").alias("value")).write.text(tmp)
    _swap(spark, tmp, path)


def write_pages(p: DataFrame, path: str) -> None:
    """Pages (slug, html) as Parquet files sorted by slug: millions of results make no millions of files."""
    p.select("slug", "html").repartitionByRange("slug").sortWithinPartitions("slug").write.mode("overwrite").parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("slug string, html string").parquet(path)


def write_manifest(m: DataFrame, path: str, site_origin: str | None = None) -> None:
    """Manifest pages as JSON lines under ``path``/pages, null addresses written out, and one object (site_origin, page_count) under ``path``/envelope."""
    m.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/pages")
    pages.manifest_envelope(m, site_origin).coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/envelope")


def read_fragments(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """(fragment, text) of the named files of a folder of templates; a missing one is an error at once."""
    for n in names:
        if not exists(spark, f"{folder}/{n}"):
            raise FileNotFoundError(f"no fragment {n} in {folder}")
    if not names:
        return spark.createDataFrame([], "fragment string, text string")
    return spark.read.text([f"{folder}/{n}" for n in names], wholetext=True).select(
        F.substring_index(F.input_file_name(), "/", -1).alias("fragment"), F.col("value").alias("text"))


#: Addresses of one sitemap file, by the protocol.
SITEMAP_ENTRIES = 50_000


def write_sitemap(entries: DataFrame, path: str, address: str = "", limit: int = SITEMAP_ENTRIES) -> None:
    """Sitemap (loc, entry) as text in order of loc: files of at most ``limit`` addresses under ``path``/file=N, and their index beside it, under ``path``-index.

    Entries are range-partitioned and counted, so none is numbered by a single task; a task
    writes one file, whose size the protocol bounds. The index has one line a file; address
    is where the folder will be found. An empty sitemap is one file without addresses.
    """
    spark = entries.sparkSession
    ordered = pages.numbered_by(entries.select("loc", "entry"), "loc").select(
        F.floor(F.col("i") / limit).cast("long").alias("file"), F.lit(1).alias("part"), "loc", F.col("entry").alias("value"))
    files_ = max(1, -(-entries.count() // limit))
    # The opening lines of the protocol.
    head = '<?xml version="1.0" encoding="UTF-8"?>\n<{} xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
    ends = spark.range(files_).select(F.col("id").alias("file"), F.explode(F.array(
        F.struct(F.lit(0).alias("part"), F.lit(head.format("urlset")).alias("value")), F.struct(F.lit(2).alias("part"), F.lit("</urlset>").alias("value")))).alias("x"))
    rows = ordered.unionByName(ends.select("file", "x.part", F.lit("").alias("loc"), "x.value"))
    rows.repartition(files_, "file").sortWithinPartitions("file", "part", "loc").select("file", "value").write.mode("overwrite").partitionBy("file").text(path)
    lines = spark.range(files_).select(F.concat(F.lit(f"  <sitemap>\n    <loc>{address}/file="), "id", F.lit("</loc>\n  </sitemap>")).alias("value"), "id")
    index = spark.createDataFrame([(head.format("sitemapindex"), -1), ("</sitemapindex>", files_)], "value string, id long").unionByName(lines)
    index.orderBy("id").coalesce(1).select("value").write.mode("overwrite").text(f"{path}-index")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """One row a page of a site metadata file (one JSON object)."""
    return pages.metadata_rows(spark.read.schema(METADATA).json(path, multiLine=True))


def read_atlas(spark: SparkSession, path: str) -> DataFrame:
    """(key, x, y, w, h) of an atlas manifest (one JSON object a file)."""
    return atlas.read(spark.read.text(path, wholetext=True))
