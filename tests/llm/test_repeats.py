import hashlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import clashing, rows_of
from webloom.llm import catalog, repeats


def covered(texts, length):
    """For each text a mask of the bytes inside windows that start anywhere else, too."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    masks = []
    for t in texts:
        hit = np.zeros(len(t) + 1, int)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                hit[i] += 1
                hit[min(i + length, len(t))] -= 1
        masks.append(np.cumsum(hit)[:-1] > 0)
    return masks


def expected(rows, length=400):
    texts = [(t or "").encode() for _, t in rows]
    out = []
    for (i, _), t, m in zip(rows, texts, covered(texts, length), strict=True):
        kept = bytes(np.frombuffer(t, np.uint8)[~m])
        spans = int((np.diff(np.concatenate([[0], m.astype(int)])) == 1).sum())
        out.append((repr(i), repr(hashlib.sha256(kept).hexdigest()), repr(len(t)), repr(int(m.sum())), repr(spans)))
    return sorted(out)


def test_documents_of_every_kind(documents):
    assert rows_of(repeats.repeats_digest(clashing(documents))) == expected([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_the_query_over_the_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows_of(catalog.op8_repeats(spark, sf_dir)) == expected(rows)


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_of_few_letters(spark, seed, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    monkeypatch.setattr(repeats, "GROUP_BYTES", 2000)
    monkeypatch.setattr(repeats, "SUFFIXES", 100)
    draw = np.random.default_rng(seed)
    parts = ["".join(draw.choice(list("abé"), int(draw.integers(5, 60)))) for _ in range(6)]
    rows = [(int(draw.integers(0, 15)), "".join(draw.choice(parts, int(draw.integers(0, 30))))) for _ in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).checkpoint()
    spans = sorted((r["doc_id"], r["text"], str([(s["start"], s["stop"]) for s in r["repeat_spans"]])) for r in repeats.repeats(df, length=40).collect())
    want = []
    for (i, text), m in zip(rows, covered([t.encode() for _, t in rows], 40), strict=True):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], m.astype(int), [0]])))
        want.append((i, text, str(list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)))))
    assert spans == sorted(want)


def test_many_copies_of_one_text_in_many_partitions(spark):
    text = "".join(chr(97 + (i * i * 31 + i // 7) % 26) for i in range(1500))
    rows = [(i, text) for i in range(300)] + [(1000 + i, f"{i} " + text[: 300 + i]) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16).checkpoint()
    assert rows_of(repeats.repeats_digest(df)) == expected(rows)


@pytest.mark.parametrize(("hot", "local"), [(3, 1), (40, 2), (100_000, 100_000)])
def test_a_passage_among_many_different_neighbours(spark, monkeypatch, hot, local):
    """Anchors at its borders meet in as many stretches as there are documents: below and above the bounds, the same result."""
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "LOCAL", local)
    draw = np.random.default_rng(5)
    word = lambda n: " ".join("".join(draw.choice(list("etaoinshrd"), 5)) for _ in range(n))
    passage = word(90)
    rows = [(i, f"{word(int(draw.integers(0, 90)))} {passage[: 500 + i % 3]} {word(int(draw.integers(0, 90)))}") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).checkpoint()
    assert rows_of(repeats.repeats_digest(df)) == expected(rows)


@pytest.mark.parametrize(("hot", "local", "seed"), [(3, 1, 0), (3, 2, 1), (10_000, 1, 2), (10_000, 2, 3), (5, 8, 4)])
def test_copies_and_parts_of_a_common_passage(spark, monkeypatch, hot, local, seed):
    """Stretches of one anchor that come once, again in the same task, and again in parts only."""
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "LOCAL", local)
    draw = np.random.default_rng(seed)
    word = lambda n: " ".join("".join(draw.choice(list("etaoinshrd"), 5)) for _ in range(n))
    passage, before, after = word(40), [word(12) for _ in range(6)], [word(12) for _ in range(6)]
    rows = []
    for i in range(90):
        a, b = int(draw.integers(0, 60)), int(draw.integers(0, 60))
        rows.append((i, f"{draw.choice(before)[a:]} {passage} {draw.choice(after)[:b]}" if draw.random() < 0.7 else rows[int(draw.integers(0, i))][1] if i else passage))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).checkpoint()
    got = {(r["doc_id"], str([(s["start"], s["stop"]) for s in r["repeat_spans"]])) for r in repeats.repeats(df, length=60).collect()}
    want = set()
    for (i, _), m in zip(rows, covered([t.encode() for _, t in rows], 60), strict=True):
        edge = np.flatnonzero(np.diff(np.concatenate([[0], m.astype(int), [0]])))
        want.add((i, str(list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)))))
    assert got == want


def test_a_text_of_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 5000)
    draw = np.random.default_rng(6)
    text = "".join(draw.choice(list("abcdefgh "), 40_000))
    rows = [(1, text), (2, text[7_000:21_500]), (3, text[39_000:] + text[:450]), (4, text[:100])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2).checkpoint()
    assert rows_of(repeats.repeats_digest(df)) == expected(rows)


def test_sorting_only_through_the_threshold():
    data = b"abcabcabdabcabc"
    at = np.arange(len(data) - 5)
    got = repeats.sort_through(np.frombuffer(data, np.uint8), at, 6)
    seen = Counter(data[i : i + 6] for i in at)
    assert sorted(got.tolist()) == [i for i in at.tolist() if seen[data[i : i + 6]] > 1]


def test_texts_without_their_repeats(spark):
    row = "x" * 30 + "shared passage of some length that comes twice" + "é"
    df = clashing(spark.createDataFrame([(1, "begin " + row), (2, row + " end"), (3, None), (4, "alone")], "doc_id long, text string")).checkpoint()
    out = repeats.remove_repeats(df, length=40)
    assert out.columns == df.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "begin ", 2: " end", 3: None, 4: "alone"}


def test_an_empty_table(documents):
    assert repeats.repeats_digest(documents.where("false")).collect() == []
