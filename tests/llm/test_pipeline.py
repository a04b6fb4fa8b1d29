import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_repeats import covered
from webloom.llm import common


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(spark, df):
    path = common.scratch(spark, "test")
    df.write.parquet(path)
    return spark.read.parquet(path)


def shingles(text, n=5):
    words = (text or "").lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def test_quality_stage_keeps_what_it_accepts(spark, docs, sf_dir):
    kept = corpus_pipeline.quality_stage(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    ids = {r["doc_id"] for r in kept.collect()}
    good, bad = [i for i, q in labels.items() if q == 1], [i for i, q in labels.items() if q == 0]
    assert sum(i in ids for i in good) >= 0.9 * len(good)
    assert sum(i in ids for i in bad) <= 0.2 * len(bad)


def test_near_copies_stage_leaves_one_of_each_group(spark, docs, sf_dir):
    kept = corpus_pipeline.near_copies_stage(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    rows = {r["doc_id"]: shingles(r["text"]) for r in docs.collect()}
    ids = {r["doc_id"] for r in kept.collect()}
    jaccard = lambda a, b: len(a & b) / len(a | b)
    pairs = {(a, b): s for a in rows for b in rows if a < b and (s := jaccard(rows[a], rows[b])) > 0.5}
    both = [(a, b) for (a, b), s in pairs.items() if s >= 0.8 and a in ids and b in ids]
    assert len(both) <= 0.05 * sum(s >= 0.8 for s in pairs.values())
    gone = set(rows) - ids
    assert all(any((min(a, b), max(a, b)) in pairs for b in rows if b != a) for a in gone)


def test_passages_stage_cuts_what_occurs_again(spark, docs, sf_dir):
    kept = {r["doc_id"]: r for r in corpus_pipeline.passages_stage(spark, docs, sf_dir).collect()}
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    for (i, text), mask in zip(rows, covered([t for _, t in rows], corpus_pipeline.PASSAGE_BYTES), strict=True):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(int), [0]])))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            mask[a:b] = len(text[a:b].split()) > 50
        left = bytes(b for b, m in zip(text, mask, strict=True) if not m).decode("utf-8", "ignore")
        if i in kept:
            assert (kept[i]["text"] or "") == left and kept[i]["n_chars"] == len(left)
        else:
            assert not left.strip(" ")


def test_leaks_stage_drops_what_holds_a_window(spark, docs, sf_dir):
    kept = {r["doc_id"] for r in corpus_pipeline.leaks_stage(spark, docs, sf_dir).collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = leaks([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert {repr(i) for i in kept} == {i for hit, i, *_ in found if hit == "False"}


def test_the_whole_pipeline(spark, docs, sf_dir):
    out = written(spark, corpus_pipeline.run(spark, sf_dir))
    assert set(docs.columns) < set(out.columns)
    assert 0 < out.count() < docs.count()
    assert out.where("not decodes").count() == 0 and out.where("n_tokens <> size(token_ids)").count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination", "SentencePiece encoding and decoding"]
    assert "pipeline" in __spark_entry__.queries() and "pipeline" not in __spark_entry__.oracle_sql()


def test_rows_of_every_kind_and_none(spark, documents, sf_dir):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, documents, sf_dir)
        assert out.columns == documents.columns
        out.collect()
        empty = stage(spark, documents.where("false"), sf_dir)
        assert empty.columns == documents.columns and empty.collect() == []
    assert corpus_pipeline.tokens_stage(spark, documents, sf_dir).count() == documents.count()


def test_rows_that_share_an_id_or_have_none_are_decided_each_for_itself(spark, sf_dir):
    draw = __import__("random").Random(3)
    a, b, c, d = (" ".join(f"w{draw.randrange(5000)}" for _ in range(200)) for _ in range(4))
    leak = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
    texts = lambda df: sorted((str(r["doc_id"]), r["text"]) for r in df.collect())
    near = table([(1, a), (2, a + " more"), (2, b), (3, c), (3, d), (None, c), (None, leak), (None, leak)])
    assert texts(corpus_pipeline.near_copies_stage(spark, near, sf_dir)) == sorted([("1", a), ("2", b), ("3", c), ("3", d), ("None", leak)])
    leaks = table([(1, a), (2, leak), (2, b), (None, leak), (None, c)])
    assert texts(corpus_pipeline.leaks_stage(spark, leaks, sf_dir)) == sorted([("1", a), ("2", b), ("None", c)])


def test_documents_blank_on_input_are_not_dropped_as_repeats(spark, sf_dir):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(1, ""), (2, "  "), (3, None), (4, passage), (5, passage)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.passages_stage(spark, docs, sf_dir).collect()) == [1, 2, 3]
