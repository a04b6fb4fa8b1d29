"""Sinks: markdown by depth, chunk lines, vectors, JSON reports, crawl state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.urls import safe_filename


def write_markdown(pages: DataFrame, path: str, depth: str = "depth", text: str = "markdown") -> None:
    """Markdown under ``depth=N`` folders, a line separator of our own between pages."""
    pages.select(depth, F.col(text).alias("value")).write.mode("overwrite").partitionBy(depth).option("lineSep", "\n\f\n").text(path)


def write_page_files(pages: DataFrame, path: str, depth: str = "depth", url: str = "url", text: str = "markdown") -> None:
    """A file for each page, in a folder that has the page's file name, under its depth."""
    named = pages.select(F.concat(F.lit("depth_"), F.col(depth).cast("string")).alias("folder"), safe_filename(F.col(url)).alias("file"), F.col(text).alias("value"))
    named.write.mode("overwrite").partitionBy("folder", "file").option("lineSep", "\n").text(path)


def write_chunks(chunks: DataFrame, path: str, text: str = "chunk") -> None:
    """One chunk a line; raises when there is none."""
    if chunks.isEmpty():
        raise ValueError("no chunk to write")
    chunks.select(F.regexp_replace(text, r"\s*\n\s*", " ").alias("value")).write.mode("overwrite").text(path)


def write_index(vectors: DataFrame, path: str) -> None:
    """A vector store: unit vectors as Parquet."""
    vectors.write.mode("overwrite").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def save_state(state: DataFrame, path: str) -> None:
    """A crawl's state: written whole beside the old one, which then makes way; between the two renames the old state is there
    under ``.old``, where ``recover_state`` finds it."""
    spark = state.sparkSession
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    new, old = where.suffix(".new"), where.suffix(".old")
    state.write.mode("overwrite").json(new.toString())
    recover_state(spark, path)
    files.delete(old, True)
    if files.exists(where) and not files.rename(where, old):
        raise OSError(f"{path} can't be moved")
    if not files.rename(new, where):
        raise OSError(f"{new.toString()} can't be moved")
    files.delete(old, True)


def recover_state(spark, path: str) -> None:
    """Put the old state back where a writer was lost between its two renames."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where) and files.exists(where.suffix(".old")):
        files.rename(where.suffix(".old"), where)


def observed(pages: DataFrame, observation) -> DataFrame:
    """pages, whose numbers of rows and of errors the observation has once an action has run: no pass of its own."""
    return pages.observe(observation, F.count(F.lit(1)).alias("pages"), F.count("error").alias("errors"))
