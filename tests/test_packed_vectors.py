"""Packed vectors: rankings without a shuffle of pairs, scores from Arrow's buffers."""

import numpy as np
import pyarrow as pa
import pytest

from webloom.operators import vector
from webloom.plans import catalog


def test_packed_rows_are_read_where_they_lie():
    kind = pa.list_(pa.struct([("id", pa.int64()), ("v", pa.list_(pa.float32()))]))
    rows = [[{"id": 1, "v": [1.0, 2.0]}], [{"id": 2, "v": [3.0, 4.0]}, {"id": 3, "v": [5.0, 6.0]}]]
    ids, m = vector._unpacked(pa.array([[], *rows], kind)[1:], 1)
    assert ids.tolist() == [2, 3] and m.tolist() == [[3.0, 4.0], [5.0, 6.0]]
    for bad in (None, [1.0]):
        with pytest.raises(ValueError):
            vector._unpacked(pa.array([[*rows[1], {"id": 4, "v": bad}]], kind), 0)


@pytest.mark.parametrize("name", ["mean_topk_by_label", "rag_map_prompts"])
def test_scores_make_no_object_of_a_vector(spark, sf_dir, name):
    plan = catalog.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "MapInPandas" not in plan


def test_a_ranking_of_all_rows(spark):
    draw = np.random.default_rng(3)
    base = draw.integers(-2, 3, (9, 4)).astype(float)
    rows = {i: base[i % 9] * (1 + i % 2) for i in range(40)} | {40: np.zeros(4), 41: np.full(4, np.nan)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows.items()], "id long, v array<double>")
    unit = {i: v / max(np.linalg.norm(v), 1e-300) for i, v in rows.items()}
    got = {(r["query_id"], r["rank"]): (r["id"], r["score"]) for r in vector.ranking(df, df.where("id % 5 = 0"), "id", "v", size=7, asked=3, most=50).collect()}
    assert len(got) == 9 * 42
    for q in range(0, 42, 5):
        ids, scores = zip(*[got[q, n] for n in range(1, 43)], strict=True)
        assert sorted(ids) == sorted(rows) and ids[0] == 41 and np.isnan(scores[0])
        assert np.allclose(scores[1:], [unit[q] @ unit[i] for i in ids[1:]]) and all((-s, i) < (-t, j) for s, t, i, j in zip(scores[1:], scores[2:], ids[1:], ids[2:], strict=False))


def test_no_pair_of_a_ranking_is_sent(spark, sf_dir):
    plan = catalog.QUERIES["ranked_scores"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and plan.index("MapInArrow") < plan.index("Exchange")
