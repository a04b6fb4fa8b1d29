from itertools import combinations

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tests.llm.conftest import clashing, rows_of
from webloom.llm import catalog, simhash


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids, fps, radius=3):
    """The smallest id reachable from each row, by all pairs."""
    by = sorted(set(fps))
    root = {f: f for f in by}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(by, 2):
        if (a ^ b).bit_count() <= radius:
            root[find(a)] = find(b)
    least = {}
    for i, f in zip(ids, fps, strict=True):
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    return [least.get(find(f)) for f in fps]


def expected(rows):
    fps = [fingerprint(t) for _, t in rows]
    found = classes([i for i, _ in rows], fps)
    return sorted((repr(c), repr(i), repr(f"{f:016x}")) for (i, _), f, c in zip(rows, fps, found, strict=True))


def test_documents_of_every_kind(documents):
    assert rows_of(simhash.simhash_components(clashing(documents))) == expected([(r["doc_id"], r["text"]) for r in documents.collect()])


def test_the_query_over_the_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows_of(catalog.op5_simhash(spark, sf_dir)) == expected(rows)


def test_an_empty_table(documents):
    assert simhash.simhash_components(documents.where("false")).collect() == []


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pattern_within_the_radius(radius):
    bits = list(range(30))
    masks = simhash.covering_masks(bits, radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for pattern in combinations(bits, radius):
        differing = sum(1 << b for b in pattern)
        assert any(not m & differing for m in masks)


def close_fingerprints(seed, n=400):
    draw = np.random.default_rng(seed)
    base = draw.integers(0, 1 << 63, 12, dtype=np.uint64)
    out = set()
    for _ in range(n):
        x = int(draw.choice(base))
        for b in draw.choice(64, int(draw.integers(0, 6)), replace=False):
            x ^= 1 << int(b)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("bucket", [4096, 8])
def test_links_are_those_of_all_pairs_with_and_without_a_second_level(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    fps = close_fingerprints(bucket)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long").repartition(3)
    edges = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.links(df, 3).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in edges)
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        root[find(a)] = find(b)
    least = {}
    for f in fps:
        least[find(f)] = min(f, least.get(find(f), f))
    assert [least[find(f)] for f in fps] == classes(fps, fps)


def test_similar_documents_at_the_shingle_similarity(spark):
    draw = np.random.default_rng(1)
    words = [f"w{i}" for i in range(5000)]
    base = [[words[i] for i in draw.integers(0, 5000, 300)] for _ in range(40)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    rows += [(100 + i, " ".join(b[:-8] + ["other"] * 8)) for i, b in enumerate(base)]  # a similarity above 0.9
    rows += [(200 + i, " ".join(b[:150] + [words[j] for j in draw.integers(0, 5000, 150)])) for i, b in enumerate(base)]  # about a third
    found = {r["id"]: r["component"] for r in simhash.similar_documents(clashing(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert all(found[100 + i] == found[i] == i for i in range(40))
    assert all(found[200 + i] == 200 + i for i in range(40))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def shingles(text, n=5):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def groups(ids, linked):
    """The smallest id that links reach, for each id."""
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        x, y = sorted([find(a), find(b)])
        root[y] = x
    return {i: find(i) for i in ids}


def test_similar_documents_never_link_below_the_similarity(spark):
    draw = np.random.default_rng(2)
    words = [f"w{i}" for i in range(5000)]
    base = [[words[i] for i in draw.integers(0, 5000, 300)] for _ in range(40)]
    rows = [(i, " ".join(b)) for i, b in enumerate(base)]
    rows += [(100 + i, " ".join(b[:-42] + [words[j] for j in draw.integers(0, 5000, 42)])) for i, b in enumerate(base)]  # a similarity of 0.75
    found = {r["id"]: r["component"] for r in simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: i for i, _ in rows}


@pytest.mark.parametrize("block", [1 << 20, 400])
def test_similar_documents_are_those_of_all_pairs(spark, sf_dir, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sets = {r["doc_id"]: shingles(r["text"]) for r in docs.collect()}
    linked = [(a, b) for a, b in combinations(sorted(sets), 2) if min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b])) and jaccard(sets[a], sets[b]) >= 0.8]
    found = {r["id"]: r["component"] for r in simhash.similar_documents(docs).collect()}
    assert found == groups(sets, linked)


def test_a_failed_link_is_tried_again_with_the_others():
    sets = [np.arange(0, 100), np.arange(20, 120), np.arange(10, 110)]  # neighbours at 0.82, the first two at 0.67
    rows = np.zeros((3, simhash.WIDE), np.uint64)
    assert sorted(simhash._similar(rows, [s.astype(np.uint64) for s in sets], 100, 0.8)) == [(0, 2), (2, 1)]


def test_shingles_of_a_text_in_pieces():
    draw = np.random.default_rng(8)
    for _ in range(60):
        text = "".join(draw.choice(["ab", "C", " ", "\n\t ", "é"], int(draw.integers(0, 80)))).encode()
        for words in (1, 3, 5):
            whole = [int(h) for x in simhash.shingle_hashes(text, words) for h in x]
            assert whole == [int(h) for x in simhash.shingle_hashes(text, words, most=7) for h in x]
