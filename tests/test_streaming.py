from pyspark.sql import functions as F

from covista.model import SiteConfig
from covista.sources import files
from covista.streaming import lastmod
from tests.conftest import rows


def test_state_by_batches(spark, tmp_path):
    src, where = str(tmp_path / "in"), str(tmp_path / "state")
    days = iter(["d1", "d2", "d3", "d4"])
    schema = "entry_key string, fingerprint string"
    for i, part in enumerate([[("a", "1"), ("b", "1")], [("a", "2"), ("c", "1"), ("c", "1")]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").json(src)
        q = (spark.readStream.schema(schema).json(src).writeStream.foreachBatch(lastmod.merge_into(where, lambda: next(days)))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
        q.awaitTermination()
    assert rows(files.read_state(spark, where)) == [("a", "2", "d2"), ("b", "1", "d1"), ("c", "1", "d2")]


def test_requests_by_route(spark, tmp_path):
    src = str(tmp_path / "log")
    r = [(1, "2031-01-05 00:10:00", "GET", "https://h/search/people/a/", 404, None), (1, "2031-01-05 00:10:00", "GET", "https://h/search/people/a/", 404, None),
         (2, "2031-01-05 00:20:00", "GET", "https://h/about/", 200, None)]
    schema = "request_id long, received_at timestamp, http_method string, url string, upstream_status int, content_type string"
    df = spark.createDataFrame(r, "request_id long, received_at string, http_method string, url string, upstream_status int, content_type string")
    df.withColumn("received_at", F.to_timestamp("received_at")).write.parquet(src)
    q = (lastmod.requests_by_route(spark.readStream.schema(schema).parquet(src), SiteConfig()).writeStream.outputMode("complete")
         .format("memory").queryName("routes").trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.table("routes").select("route", "action", "count")) == [("other", "pass", 1), ("people", "shell", 1)]
