import math

import numpy as np
import pytest

from tests.llm.conftest import clashing
from webloom.llm import catalog, topk


def brute(rows, k=5, scale=256, every=50):
    """(query, rank, id, score) of rows (id, vector) by all inner products."""
    usable = [(i, v) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)]
    if not usable:
        return []
    width = len(min(usable)[1])
    usable = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in usable if len(v) == width]
    out = set()
    for q, x in usable:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in usable if i != q)[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return sorted(out)


def found(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.nearest(df).collect())


KIND = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("seed", range(3))
def test_random_vectors_with_ties(spark, seed):
    draw = np.random.default_rng(seed)
    rows = [(i, draw.integers(-2, 3, 6).astype(float).tolist()) for i in range(300)]
    assert found(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND).repartition(3)) == brute(rows)


def test_a_vector_that_most_rows_share(spark):
    rows = [(i, [1.0, 0.5, 0.25, 0.0] if i % 3 else [float(i), -1.0, 0.5, 2.0]) for i in range(400)]
    assert found(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND)) == brute(rows)


def test_what_takes_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, []), (6, [1.0]), (7, [0.5, -0.3]), (None, [9.0, 9.0]), (50, [0.001, -0.001]), (100, None), (150, [0.0, 0.0])]
    assert found(clashing(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND))) == brute(rows)


def test_repeated_ids_that_share_a_vector(spark):
    """An id's repeats don't push other ids of its class out."""
    rows = [(50, [1.0, 2.0])] * 7 + [(51, [1.0, 2.0]), (52, [1.0, 2.0]), (53, [0.5, 0.5])] + [(54, [0.25, 0.5])] * 9
    got = found(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND).repartition(3))
    want = []
    for q, x in {(i, tuple(v)) for i, v in rows if i % 50 == 0}:
        scored = sorted((-sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(x, y, strict=True)), i) for i, y in rows if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert got == sorted(want) and [r[2] for r in got] == [51, 52, 53, 54, 54]


def test_fewer_rows_than_asked_for_and_none(spark):
    rows = [(50, [1.0, 0.0]), (3, [0.0, 1.0])]
    assert found(spark.createDataFrame([(i, v, 0) for i, v in rows], KIND)) == brute(rows)
    assert found(spark.createDataFrame([], KIND)) == []


def test_the_query_over_the_table(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in catalog.op2_topk(spark, sf_dir).collect())
    assert got == brute(rows)
