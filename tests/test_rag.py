"""The retrieval chains over whole texts, against a plain loop."""

import numpy as np
import pytest

from webloom.plans import catalog


@pytest.fixture(scope="module")
def retrieved(spark, sf_dir):
    """The texts of each query's 30 best rows, best first."""
    rows = sorted((r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect())
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids, v = [i for i, _ in rows], np.array([e for _, e in rows], float)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    found = {}
    for i, x in zip(ids, v, strict=True):
        if i % 50 == 0:
            best = [ids[j] for j in np.argsort(-(v @ x), kind="stable")[:30]]
            found[i] = [texts[j] for j in best if j in texts]
    return {i: t for i, t in found.items() if t}


def test_the_stuff_chain_holds_whole_texts(spark, sf_dir, retrieved):
    found = {r["query_id"]: (r["context"], r["n"]) for r in catalog.QUERIES["rag_stuff_context"](spark, sf_dir).collect()}
    assert found == {i: ("\n".join(t), len(t)) for i, t in retrieved.items()}
    assert any(len(t) > 5 for t in retrieved.values()) and any(len(x) > 200 for t in retrieved.values() for x in t)


def test_the_map_reduce_chain_prompts_over_every_whole_text(spark, sf_dir, retrieved):
    parts = {i: [f"Summarise for question {i}: {x or ''}" for x in t] for i, t in retrieved.items()}
    prompts = {}
    for r in sorted(catalog.QUERIES["rag_map_prompts"](spark, sf_dir).collect(), key=lambda r: r["rank"]):
        prompts.setdefault(r["query_id"], []).append(r["prompt"])
    assert prompts == parts
    assert {r["query_id"]: r["prompt"] for r in catalog.QUERIES["rag_map_reduce"](spark, sf_dir).collect()} == {i: "Combine: " + " || ".join(p) for i, p in parts.items()}
