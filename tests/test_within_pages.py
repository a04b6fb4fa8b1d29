"""Searches within a page: plain text rules against the column expressions, blocks against whole texts, and plans that move no lines."""

from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.functions import plain
from webloom.functions import text as X
from webloom.operators import batches, dedup, dom
from webloom.plans import catalog

ODD = [
    "", " ", "a", "Word word  WORD word.", "[ Ann ](mailto:a@b.c) Ann ann,", "x [a](b) [c] (d) [e](f", "[[a](b)", "[](x) []( y)", "[a]()b) [c](d)", "a]( b [c](d)", "at: 10:30 :\t 5", "( in ) [ out ]",
    "mailto:  x@y.org mailto:z", "Größe größe, ÉTÉ été — ça", "½ x² ⅷ", "tab\tand\rreturn", "[a\tb](c) [d](e) [f](g)", "a-b a_b a b", "no.stop", "[" * 50 + "](x)", "İstanbul", "a [b](c)(d) [e](f)g [h](i)",
]


def test_comparable_texts_are_those_of_the_expressions(spark):
    draw = np.random.default_rng(5)
    drawn = ["".join(draw.choice(list("aB é.[]():\t  "), 30)) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in ODD + drawn], "x string")
    assert [(r[0], r[1]) for r in df.select("x", X.comparable(F.col("x"))).collect()] == [(x, plain.comparable(x)) for x in ODD + drawn]


def test_blocks_are_compared_as_whole_texts():
    draw = np.random.default_rng(6)
    for _ in range(200):
        lines = [" ".join(draw.choice(["a", "b", "A.", "-", "at:", "[x](y)", "(", "[x"], int(draw.integers(0, 4)), p=[0.3, 0.3, 0.2, 0.1, 0.025, 0.025, 0.025, 0.025])) for _ in range(6)]
        assert plain.comparable_blocks(lines, 3) == [plain.comparable("\n".join(lines[i : i + 3])) for i in range(4)]
    assert plain.comparable_blocks(["a", "b"], 3) == []


def test_texts_inside_others():
    draw = np.random.default_rng(7)
    for _ in range(50):
        texts = sorted({"".join(draw.choice(list("ab "), int(draw.integers(1, 12)))) for _ in range(20)})
        assert sorted(dedup.contained(texts)) == sorted((i, j) for i, s in enumerate(texts) for j, t in enumerate(texts) if len(s) < len(t) and s in t)


@pytest.mark.parametrize("name", ["similar_lines", "similar_blocks", "contained_lines", "alike_lines", "repeated_lines", "repeated_sentences", "repeated_sentences_all", "repetition_union", "leader_dedup"])
def test_no_line_is_moved(spark, sf_dir, name):
    """A document's lines are searched where its row stands: pieces, words and texts of lines aren't shuffled."""
    assert "Exchange" not in catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_leaders_are_those_of_a_plain_loop():
    draw = np.random.default_rng(8)
    base = ["".join(draw.choice(list("abcde fgé"), n)) for n in (3, 12, 40, 90, 250, 400)]
    page = []
    for n in range(150):
        text = list(str(draw.choice(base)))
        for _ in range(int(draw.integers(0, 1 + len(text) // 6))):
            text[int(draw.integers(0, len(text)))] = str(draw.choice(list("ABx")))
        page.append((n, "".join(text)))
    kept = []
    for key, text in page:
        if not any(SequenceMatcher(None, text.strip().lower(), t.strip().lower()).ratio() > 0.9 for _, t in kept):
            kept.append((key, text))
    assert 20 < len(kept) < 130 and list(dedup.leaders(page)) == kept


def test_frames_are_sent_before_the_next_is_made(spark):
    """However many pages come in at once, a stage holds a bounded number of result rows and characters."""
    made = []
    rows = ((made.append(i), "x" * 1000)[1:] for i in range(100_000))
    sizes = [(len(f), len(made)) for f, _ in zip(batches.frames(rows, ["t"]), range(3), strict=False)]
    assert sizes == [(4000, 4000), (4000, 8000), (4000, 12000)]
    assert [len(f) for f in batches.frames(((i,) for i in range(25_000)), ["n"])] == [10_000, 10_000, 5000] and list(batches.frames([], ["n"])) == []
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("<p>" * 10).alias("html")).repartition(1)
    assert dom.dom_nodes(pages).groupBy("page_id").count().where("count = 10").count() == 3000
