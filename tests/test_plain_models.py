"""Operators without a SQL form, and greedy ones that have one, against plain loops."""

import re
from collections import Counter
from difflib import SequenceMatcher
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.functions import scripts
from webloom.functions import text as X
from webloom.operators import dedup, vector
from webloom.options import Options
from webloom.plans import catalog
from webloom.sources import sinks, tables


def alike(a, b):
    return sum(x == y for x, y in zip(a, b, strict=False)) / max(len(a), len(b)) if a and b else 0.0


def gone_by_lines(lines, above=0.95):
    """Line numbers that go, by going through the lines in order; lines: (number, comparable text)."""
    seen, out = {}, set()
    for i, t in lines:
        for other, where in seen.items():
            if alike(t, other) > above:
                out |= {i, *where}
                break
        for other, where in seen.items():
            if t in other or other in t:
                out |= {i} if len(t) < len(other) else set(where)
                break
        seen.setdefault(t, []).append(i)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_alike_lines_and_pairs(spark, seed):
    draw = np.random.default_rng(seed)
    base = ["".join(draw.choice(list("abc d"), int(draw.integers(10, 60)))).strip() or "aaaaaaaaaa" for _ in range(8)]
    rows = []
    for doc in range(4):
        for n in range(25):
            t = str(draw.choice(base))
            kind = draw.integers(0, 4)
            t = t + " and more of it" if kind == 1 else t[: len(t) // 2 + 5] if kind == 2 else t[:-1] + "x" if kind == 3 else t
            rows.append((doc, n, t))
    df = spark.createDataFrame(rows, "doc long, n long, t string")
    got = {(r["doc"], r["n"]) for r in dedup.alike_lines(df, "doc", "n", "t").collect()}
    assert got == {(d, i) for d in range(4) for i in gone_by_lines([(n, t) for x, n, t in rows if x == d])}
    for above in (0.9, 0.95):
        pairs = {(d, a, b) for d, a, s in rows for e, b, t in rows if d == e and a < b and alike(s, t) > above}
        assert {tuple(r) for r in dedup.similar_pairs(df, "doc", "n", "t", above).collect()} == pairs
        later = {(d, b) for d, a, b in pairs}
        assert {tuple(r) for r in dedup.later_alike(df, "doc", "n", "t", above).collect()} == later


def test_leader_dedup(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("pos", "s")).where(X.word_count(F.col("s")) > 5).where("doc_id < 25").collect()
    kept = set()
    for doc in {r["doc_id"] for r in rows}:
        own, leaders = sorted((r["pos"], r["s"]) for r in rows if r["doc_id"] == doc), []
        for pos, s in own:
            t = s.strip().lower()
            if not any(SequenceMatcher(None, t, x).ratio() > 0.9 for x in leaders):
                leaders.append(t)
                kept.add((doc, pos))
    df = spark.createDataFrame([(r["doc_id"], r["pos"], r["s"]) for r in rows], "doc_id long, pos int, s string")
    assert {(r["doc_id"], r["pos"]) for r in dedup.leader_dedup(df, "doc_id", "pos", "s").collect()} == kept


def test_maximal_marginal_relevance(spark, sf_dir):
    rows = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()}
    unit = {i: v / np.linalg.norm(v) for i, v in rows.items()}
    want = set()
    for q in [i for i in unit if i % 50 == 0]:
        best = [i for i in sorted(unit, key=lambda i: (-round(float(unit[i] @ unit[q]), 12), i))[:31] if i != q]
        chosen = []
        while len(chosen) < 5:
            value = lambda i: round(0.5 * float(unit[i] @ unit[q]) - 0.5 * max((float(unit[i] @ unit[c]) for c in chosen), default=0.0), 12)  # noqa: E731, B023
            chosen.append(max((i for i in best if i not in chosen), key=lambda i: (value(i), -best.index(i))))
        want |= {(q, n, i) for n, i in enumerate(chosen, 1)}
    assert {(r["query_id"], r["rank"], r["id"]) for r in catalog.QUERIES["mmr_topk"](spark, sf_dir).collect()} == want


def test_hashed_embeddings(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in catalog.QUERIES["hashed_embeddings"](spark, sf_dir).collect():
        counts = Counter()
        for word in texts[r["doc_id"]].lower().split():
            counts[crc32(word.encode()) % 64] += 1 if crc32(word.encode()) >= 1 << 31 else -1
        v = np.array([counts[i] for i in range(64)], float)
        assert np.allclose(r["embedding"], v / (np.linalg.norm(v) or 1))


def test_doubled_words(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = catalog.QUERIES["doubled_words"](spark, sf_dir).collect()
    assert all(r["cleaned"] == (texts[r["doc_id"]] and re.sub(r"(?a:\b)([A-ZÄÖÜ][a-zäöüß]+)(?a:\s+)\1(?a:\b)", r"\1", texts[r["doc_id"]])) for r in found)


def test_a_state_is_there_whatever_is_lost(spark, tmp_path):
    path = str(tmp_path / "state")
    state = lambda n: spark.createDataFrame([(n,)], "pages_processed long")
    sinks.save_state(state(1), path)
    sinks.save_state(state(2), path)
    assert [r["pages_processed"] for r in tables.checkpoint_state(spark, path).collect()] == [2]
    (tmp_path / "state").rename(tmp_path / "state.old")  # a writer lost between its renames
    sinks.recover_state(spark, path)
    assert [r["pages_processed"] for r in tables.checkpoint_state(spark, path).collect()] == [2]


def test_a_file_for_each_page(spark, tmp_path):
    pages = spark.createDataFrame([(0, "https://a.org/x", "one\ntwo"), (1, "https://a.org/y:1", "three")], "depth int, url string, markdown string")
    sinks.write_page_files(pages, str(tmp_path / "out"))
    found = {str(p.parent.relative_to(tmp_path / "out")): p.read_text() for p in (tmp_path / "out").rglob("part-*")}
    assert found == {"folder=depth_0/file=a.org_x.md": "one\ntwo\n", "folder=depth_1/file=a.org_y_1.md": "three\n"}


def test_options_and_limits(spark):
    assert Options().depth_overflow == "clamp" and Options.simple().seed_exempt and Options.simple(max_depth=2).max_depth == 2
    for bad in ({"depth_overflow": "no"}, {"max_pages": -1}):
        with pytest.raises(ValueError):
            Options(**bad)
    assert vector.exactly(spark.range(5), 5).count() == 5
    with pytest.raises(ValueError):
        vector.exactly(spark.range(4), 5)


def test_other_alphabets():
    assert scripts.romanized(scripts.mended("naÃ¯ve Ωmega Щука — “ok”")) == 'naive Omega Shchuka -- "ok"'
    assert scripts.mended("plain Â text") == "plain Â text"
