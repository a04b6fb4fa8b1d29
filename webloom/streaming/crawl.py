"""Pages and attempts as streams: seen URLs, error queues and rates survive restarts in the checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions import urls as U
from webloom.session import table


def stream_of(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream, so many files to a micro-batch."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables under a folder as a stream: a folder of Parquet files, or a single file beside the others."""
    stream = spark.readStream.schema(table(spark, sf_dir, name).schema)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return stream.parquet(f"{sf_dir}/{name}.parquet")
    return stream.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def fresh_pages(pages: DataFrame, url: str = "url") -> DataFrame:
    """The first page of each normalized URL. The state holds every URL seen, as the crawl's own does; with an event time, use
    ``fresh_within`` to bound it."""
    return pages.withColumn("norm_url", U.normalize(F.col(url))).where("norm_url is not null").dropDuplicates(["norm_url"])


def fresh_within(pages: DataFrame, time: str, late: str, url: str = "url") -> DataFrame:
    """As ``fresh_pages``, with URLs forgotten once the watermark has passed them."""
    return pages.withColumn("norm_url", U.normalize(F.col(url))).withWatermark(time, late).dropDuplicatesWithinWatermark(["norm_url"])


def rates(events: DataFrame, time: str = "ts", window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Attempts and errors in each window of event time; late rows within the watermark count."""
    kind = events.schema[time].dataType  # watermarks need a zone's timestamps; the hours come back as the times came
    counted = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, window).alias("w"))
    return counted.agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors")).select(F.col("w.start").cast(kind).alias("hour"), "n", "errors")


def retries(events: DataFrame) -> DataFrame:
    """Failed attempts, to be queued again."""
    return events.where("event_type = 'error'").select("event_id", "user_id", "ts")


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process all there is now and stop; a restart goes on from the checkpoint."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
