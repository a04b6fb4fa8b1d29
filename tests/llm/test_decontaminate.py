import hashlib
import re

import numpy as np
import pytest

from tests.llm.conftest import clashing, rows_of
from webloom.llm import catalog, decontaminate
from webloom.llm.common import scratch

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return SPLIT.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    windows = {}
    for name, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + window]), set()).add(name)
    sizes = sorted({len(w) for w in windows})
    out = []
    for i, text in docs:
        w, found = words_of(text), set()
        hit = np.zeros(len(w), bool)
        for n in sizes:
            for s in range(len(w) - n + 1):
                names = windows.get(tuple(w[s : s + n]))
                if names is not None:
                    hit[s : s + n] = True
                    found |= {str(x) for x in names if x is not None}
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((repr(bool(hit.any())), repr(i), repr(sha), repr(int(hit.sum())), repr(len(found)), repr(len(w))))
    return sorted(out)


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short item"), (3, None), (4, "... !!"), (10, "two three four five six seven eight nine ten eleven"), (5, "the the the the the the the the the the the"), (None, "an item without a name is here too of course"), (6, "Ünïcode wörds"), (6, "repeated id short")]
DOCS = [
    (1, "zero ONE two-three four, five six seven eight nine ten eleven twelve thirteen"), (2, "a short ITEM and short item short item"), (3, None), (4, ""), (5, "the " * 40), (6, "the " * 9), (7, "one two three four five six seven eight nine"),
    (8, "nine ten eleven twelve"), (None, "short item"), (8, "ünïcode wörds Ünïcode wörds"), (9, "an item without a name is here too of course"), (10, "word " * 30_000 + "repeated id short"), (11, "one two three four five six seven eight nine ten eleven two three four five six seven eight nine ten eleven twelve"),
]


def frames(spark):
    docs = clashing(spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3))
    items = clashing(spark.createDataFrame(ITEMS, "item_id long, text string"))
    return docs, items


def test_documents_of_every_kind(spark):
    docs, items = frames(spark)
    assert rows_of(decontaminate.contamination(docs, items)) == brute(DOCS, ITEMS)


def test_items_in_several_blocks(spark, monkeypatch):
    docs, items = frames(spark)
    one = decontaminate.blocks
    monkeypatch.setattr(decontaminate, "blocks", lambda *a: one(*a[:4], 40))
    assert rows_of(decontaminate.contamination(docs, items)) == brute(DOCS, ITEMS)


@pytest.mark.parametrize("seed", range(3))
def test_random_words(spark, seed):
    draw = np.random.default_rng(seed)
    text = lambda n: " ".join(draw.choice(list("abc"), n))
    docs = [(i, text(int(draw.integers(0, 200)))) for i in range(60)]
    items = [(i, text(int(draw.integers(0, 16)))) for i in range(20)]
    got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(got) == brute(docs, items)


def test_the_query_over_the_table(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert rows_of(catalog.op10_decontamination(spark, sf_dir)) == brute(docs, items)


def stored(spark, docs):
    decontaminate.write_index(docs, path := scratch(spark, "index"))
    return decontaminate.read_index(spark, path)


@pytest.mark.parametrize("seed", range(3))
def test_random_words_near_each_other(spark, seed):
    draw = np.random.default_rng(seed)
    text = lambda n: [str(w) for w in draw.choice(list("abcdef"), n)]
    docs = {i: text(int(draw.integers(0, 60))) for i in range(40)}
    items = {str(i): text(int(draw.integers(1, 7))) for i in range(12)}
    block = decontaminate.Block([(k, [w.encode() for w in v]) for k, v in items.items()], window=4)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs.items()], "doc_id long, text string").repartition(2)
    found = decontaminate.proximity_matches(stored(spark, df), block, slop=2).collect()
    want = set()
    for k, words in items.items():
        for w in [words[i : i + 4] for i in range(max(1, len(words) - 3))]:
            want |= {(i, k) for i, t in docs.items() for s in range(len(t)) if set(w) <= set(t[s : s + len(w) + 2])}
    assert {(r["id"], r["item"]) for r in found} == want
    for r in found:
        held = docs[r["id"]][r["start"] : r["stop"]]
        assert any(set(w) <= set(held) and len(held) <= len(w) + 2 for w in [items[r["item"]][i : i + 4] for i in range(max(1, len(items[r["item"]]) - 3))])


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "red x green y blue"), (2, "blue red green"), (3, "red x x x x x x x x green blue"), (4, "red green"), (5, None)], "doc_id long, text string")
    block = decontaminate.Block([("a", [b"red", b"green", b"blue"])])
    found = decontaminate.proximity_matches(stored(spark, docs), block, slop=2)
    assert sorted((r["id"], r["item"], r["start"], r["stop"]) for r in found.collect()) == [(1, "a", 0, 5), (2, "a", 0, 3)]


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert decontaminate.contamination(docs.where("false"), items).collect() == []
    assert rows_of(decontaminate.contamination(docs, items.where("false"))) == brute(DOCS, [])
