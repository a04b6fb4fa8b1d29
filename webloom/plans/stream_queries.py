"""Streaming queries: run over the tables as streams with ``availableNow``, results read back."""

from __future__ import annotations

import uuid

from webloom.operators import graph
from webloom.plans.catalog import register
from webloom.streaming import crawl


def _shared(spark) -> str:
    graph.reliable(spark.range(1))  # sees to the checkpoint folder
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{named.rstrip('/')}/webloom-stream-{uuid.uuid4().hex}"


def _drained(spark, stream, mode="append"):
    base = _shared(spark)
    crawl.drain(stream, f"{base}/out", f"{base}/checkpoint", mode)
    return spark.read.parquet(f"{base}/out")


@register("stream_fresh_pages", "SELECT DISTINCT replace(url, '://www.', '://') AS norm_url FROM pages WHERE url <> ''")
def stream_fresh_pages(spark, sf_dir):
    stream = crawl.table_stream(spark, sf_dir, "pages")
    return _drained(spark, crawl.fresh_pages(stream).select("norm_url"))


@register("stream_retries", "SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'")
def stream_retries(spark, sf_dir):
    stream = crawl.table_stream(spark, sf_dir, "events")
    return _drained(spark, crawl.retries(stream))


@register("stream_rates", "WITH h AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1) SELECT hour, n, errors FROM h WHERE hour + INTERVAL 3 HOUR <= (SELECT max(ts) FROM events)")
def stream_rates(spark, sf_dir):
    """Attempts and errors by hour of event time: the hours that the watermark, two hours late, has passed."""
    return _drained(spark, crawl.rates(crawl.table_stream(spark, sf_dir, "events")))
