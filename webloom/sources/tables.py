"""Sources: seeds, stored pages, checkpoint state, PDF files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE = "seen_final_urls array<string>, seed_urls_processed array<string>, depth_by_url map<string,int>, pages_processed long, max_depth_crawled int, timestamp string"
RESULTS = "seq long, url string, redirected_url string, status_code int, success boolean, error_message string, html string, fit_md string, raw_md string, depth int, meta map<string,string>"


def seeds(spark: SparkSession, urls: list[str]) -> DataFrame:
    """The seed list: (seq, url)."""
    return spark.createDataFrame(list(enumerate(urls)), "seq long, url string")


def checkpoint_state(spark: SparkSession, path: str) -> DataFrame:
    """A crawl's saved state from JSON; an absent field is null."""
    return spark.read.schema(STATE).option("multiLine", True).json(path)


def pdf_texts(spark: SparkSession, path: str, reader=None) -> DataFrame:
    """(path, length, text, error) of PDF files. reader: bytes -> text, run in Arrow batches; without one the text is null and
    the error says so. A file that the reader refuses gives its error and doesn't fail the others."""

    def read(batches):
        for pdf in batches:
            rows = []
            for name, size, content in zip(pdf["path"], pdf["length"], pdf["content"], strict=True):
                try:
                    rows.append((name, size, reader(content), None) if reader else (name, size, None, "no PDF reader is given"))
                except Exception as problem:  # one bad file is a row with its error
                    rows.append((name, size, None, f"{type(problem).__name__}: {problem}"))
            yield pd.DataFrame(rows, columns=["path", "length", "text", "error"])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(path).select("path", "length", "content")
    return found.mapInPandas(read, "path string, length long, text string, error string")


def unseen(pages: DataFrame, state: DataFrame, url_col: str = "url") -> DataFrame:
    """Pages whose URL the state hasn't seen."""
    seen = state.select(F.explode("seen_final_urls").alias(url_col)).distinct()
    return pages.join(seen, url_col, "left_anti")
