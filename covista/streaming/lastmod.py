"""The last-modified state kept up by a stream of fingerprints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.operators import routing, state
from covista.model import SiteConfig
from covista.sources import files


def merge_into(path: str, as_of: Callable[[], str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch sink: each batch of (entry_key, fingerprint) is merged into the state at ``path``.

    Keys that a batch doesn't hold keep their entry (a batch is a part, not a snapshot);
    of a key that it holds twice the greater fingerprint counts. A batch that is run
    again after a failure changes nothing: its fingerprints are already there.
    """

    def sink(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        old = files.read_state(spark, path, must_exist=False)
        new = batch.where("entry_key is not null").groupBy("entry_key").agg(F.max("fingerprint").alias("fingerprint"))
        kept = old.join(new.select("entry_key"), "entry_key", "left_anti")
        files.write_state(state.merge_lastmod(new, old, as_of()).unionByName(kept), path)

    return sink


def requests_by_route(requests: DataFrame, cfg: SiteConfig, late: str = "1 day", window: str = "1 hour") -> DataFrame:
    """Counts of requests by hour, route and action from a stream of log rows.

    A request delivered twice counts once (by request_id and received_at) and rows later
    than ``late`` are dropped by the watermark, which also bounds the state.
    """
    once = requests.withWatermark("received_at", late).dropDuplicatesWithinWatermark(["request_id"])
    routed = once.select(
        F.struct("request_id", "url", "http_method", "upstream_status", "content_type").alias("r"), "received_at").select("r.*", "received_at")
    path_routed = routing.route(routed.withColumn("request_id", F.struct("request_id", "received_at")), cfg)
    return path_routed.groupBy(F.window("request_id.received_at", window).alias("hour"), "route", "action").count()
