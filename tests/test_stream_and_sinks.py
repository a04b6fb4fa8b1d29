import json

import pytest

from webloom.sources import sinks, tables
from webloom.streaming import crawl


def test_a_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    source, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    pages = spark.createDataFrame([(1, "https://www.a.org/"), (2, "https://a.org/"), (3, "https://b.org/")], "page_id long, url string")
    pages.coalesce(1).write.parquet(source)
    fresh = lambda: crawl.fresh_pages(crawl.stream_of(spark, source)).select("norm_url")
    crawl.drain(fresh(), out, checkpoint)
    assert sorted(r["norm_url"] for r in spark.read.parquet(out).collect()) == ["https://a.org/", "https://b.org/"]
    spark.createDataFrame([(4, "https://b.org/"), (5, "https://c.org/")], pages.schema).coalesce(1).write.mode("append").parquet(source)
    crawl.drain(fresh(), out, checkpoint)
    assert sorted(r["norm_url"] for r in spark.read.parquet(out).collect()) == ["https://a.org/", "https://b.org/", "https://c.org/"]


def test_sinks_and_state(spark, tmp_path):
    pages = spark.createDataFrame([(0, "# a\ntext"), (1, "# b")], "depth int, markdown string")
    sinks.write_markdown(pages, str(tmp_path / "md"))
    assert sorted(p.name for p in (tmp_path / "md").iterdir() if p.is_dir()) == ["depth=0", "depth=1"]
    sinks.write_chunks(spark.createDataFrame([("one\n two",), ("three",)], "chunk string"), str(tmp_path / "chunks"))
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "chunks")).collect()) == ["one two", "three"]
    with pytest.raises(ValueError):
        sinks.write_chunks(spark.createDataFrame([], "chunk string"), str(tmp_path / "none"))
    (tmp_path / "state.json").write_text(json.dumps({"seen_final_urls": ["https://a.org/"], "pages_processed": 1}))
    state = tables.checkpoint_state(spark, str(tmp_path / "state.json"))
    left = tables.unseen(spark.createDataFrame([("https://a.org/",), ("https://b.org/",)], "url string"), state)
    assert [r["url"] for r in left.collect()] == ["https://b.org/"] and state.first()["max_depth_crawled"] is None


def test_pdf_files_without_a_reader_and_with_a_failing_one(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF-1.4")
    (only,) = tables.pdf_texts(spark, str(tmp_path)).collect()
    assert only["text"] is None and only["error"] == "no PDF reader is given" and only["length"] == 8

    def reader(data):
        raise ValueError("bad file")

    assert tables.pdf_texts(spark, str(tmp_path), reader).first()["error"] == "ValueError: bad file"


def test_progress_of_a_write(spark):
    from pyspark.sql import Observation

    seen = Observation("crawl")
    sinks.observed(spark.createDataFrame([("a", None), ("a", "x"), ("b", None)], "url string, error string"), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"pages": 3, "errors": 1}
