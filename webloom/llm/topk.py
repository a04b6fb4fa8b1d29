"""Exact top-k by inner product with a three-phase uniform threshold.

Vectors are cut into fragments of dimensions; a node holds a block of vectors, and a list of partial scores for each fragment.

1. Every node sends, for each query, the k best entries of each of its lists, with their full scores. The k-th best of those
   scores is a safe cutoff: no result can be below it.
2. The cutoff goes back with the queries. A vector that reaches cutoff t in all must reach t/m in some of the m fragments, so
   in each list the entries of at least that are sufficient.
3. Their remaining scores are resolved exactly where they stand, since a node holds all fragments of its vectors; what reaches
   the cutoff is sent.

Equal vectors are one class, scored once: a class keeps its smallest distinct ids, as many as a result can hold, and of each as
many rows, so that a vector that a third of the rows share brings no more pairs than any other. Classes are told apart by their
vectors and numbered. Queries go against all classes in blocks.

Defined results: vectors that are null, hold null or non-finite components, or have another length than the vector of the smallest
id, and rows without an id, take no part. Ties go to the smaller id. Repeated ids are separate candidates, but never
candidates of the query of the same id; a query is asked once for each different vector of its id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import checkpointed, lean

K, SCALE, FRAGMENTS = 5, 256, 2
#: Bytes of a block of classes and of one of queries: a task holds one of each and scores in strips of ``STRIP`` queries.
BLOCK, QUERIES, STRIP = 8 << 20, 1 << 19, 128


def _matrix(column) -> np.ndarray:
    """Packed int64 vectors as a matrix of doubles, which hold them and their products exactly below 2^53."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), np.int64).reshape(len(raw), -1) if raw else np.zeros((0, 0), np.int64)


def _product(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where every sum stays below 2^53, else in 64-bit integers."""
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
    return q.astype(float) @ c.T.astype(float) if bound < 2**53 else q @ c.T


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of every component as packed 64-bit integers, of the rows that take part."""
    source = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x")).where("id is not null and x is not null")

    def run(batches):
        for batch in batches:
            x = batch.column(1)
            offsets, values = np.asarray(x.offsets), x.values
            flat = np.where(np.asarray(values.is_null()), np.nan, values.fill_null(0.0).to_numpy(zero_copy_only=False)) if values.null_count else values.to_numpy(zero_copy_only=False)
            ids, packed = [], []
            for i, a, b in zip(batch.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                v = flat[a:b]
                if b > a and np.isfinite(v).all():
                    ids.append(i)
                    packed.append(np.floor(v * scale).astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(packed, pa.binary())], ["id", "v"])

    found = source.mapInArrow(lean(run), f"id {source.schema['id'].dataType.simpleString()}, v binary")
    width = found.select(F.min_by(F.length("v"), "id").alias("width"))
    return found.join(F.broadcast(width), F.length("v") == F.col("width")).drop("width")


def _blocks(rows: DataFrame, size: int, extra: list[str]) -> tuple[DataFrame, int]:
    """Rows packed into one row for each block of about ``size`` bytes of vectors: (block, rows of c, v and extra); and how many blocks."""
    n = max(1, -(-int(rows.agg(F.sum(F.length("v"))).first()[0] or 0) // size))
    spread = rows.withColumn("block", (F.pmod(F.xxhash64("c"), F.lit(n))).cast("int"))
    return spread.groupBy("block").agg(F.collect_list(F.struct("c", "v", *extra)).alias("rows")), n


def _nodes(queries: DataFrame, classes: DataFrame, n_queries: int) -> DataFrame:
    """Every block of queries beside every block of classes: the stated query set against all rows."""
    each = classes.select(F.col("block").alias("cblock"), F.col("rows").alias("crows"), F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))).alias("block"))
    return each.join(queries.select("block", F.col("rows").alias("qrows")), "block").select("qrows", "crows")


def _fields(batch: pa.RecordBatch, name: str, i: int):
    rows = batch.column(batch.schema.get_field_index(name))
    a, b = rows.offsets[i].as_py(), rows.offsets[i + 1].as_py()
    return [rows.values.field(j).slice(a, b - a) for j in range(rows.values.type.num_fields)]


def _edges(width: int, fragments: int) -> list[tuple[int, int]]:
    at = np.linspace(0, width, min(fragments, width) + 1).astype(int)
    return list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


ENTRIES = "q long, c long, score long"


def _entries(k: int, fragments: int, threshold: bool):
    """Entries that nodes send, with their full scores. Phase 1: the k best of each fragment's list. Phases 2 and 3: of all that
    have the query's share of its cutoff in some list, those that reach the cutoff."""

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                queries, classes = _fields(batch, "qrows", i), _fields(batch, "crows", i)
                qid, cid = queries[0].to_numpy(), classes[0].to_numpy()
                q, c = _matrix(queries[1]), _matrix(classes[1])
                edges = _edges(c.shape[1], fragments)
                for s in range(0, len(q), STRIP):
                    lists = [_product(q[s : s + STRIP, a:b], c[:, a:b]) for a, b in edges]
                    total = sum(lists)
                    sent = np.zeros(total.shape, bool)
                    if threshold:
                        cutoff = np.array(queries[2].to_numpy()[s : s + STRIP])[:, None]
                        for part in lists:
                            sent |= part >= -(-cutoff // len(edges))
                        sent &= total >= cutoff
                    else:
                        top = min(k, len(c))
                        for part in lists:
                            np.put_along_axis(sent, np.argpartition(part, len(c) - top, axis=1)[:, -top:], True, axis=1)
                    rows, columns = np.nonzero(sent)
                    yield pa.RecordBatch.from_arrays([pa.array(qid[s + rows]), pa.array(cid[columns]), pa.array(total[rows, columns].astype(np.int64))], ["q", "c", "score"])

    return lean(run)


def search(candidates: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE, fragments: int = FRAGMENTS) -> DataFrame:
    """(query_id, rank, id, score): each query's k best among the candidates of other ids; scores are inner products of floor(scale * x)."""
    rows = quantised(candidates, id_col, vector_col, scale).groupBy("v", "id").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("rows"))
    asked = checkpointed(quantised(queries, id_col, vector_col, scale).distinct())
    need = k + 1  # of classes, and of ids in a class: one may be the query's own
    smallest = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= need)  # limited before the shuffle, too
    classes = few.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("id", "rows"))).alias("ids"))
    classes = checkpointed(classes.withColumn("c", F.monotonically_increasing_id()))
    distinct = checkpointed(asked.select("v").distinct().withColumn("c", F.monotonically_increasing_id()))
    cblocks, _ = _blocks(classes.select("c", "v"), BLOCK, [])
    qblocks, n = _blocks(distinct, QUERIES, [])
    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    lists = _nodes(qblocks, cblocks, n).mapInArrow(_entries(need, fragments, False), ENTRIES)
    cutoff = lists.withColumn("n", F.row_number().over(best)).where(F.col("n") <= need).groupBy("q").agg(F.min("score").alias("cutoff"))
    known = checkpointed(distinct.join(cutoff, distinct.c == cutoff.q).select("c", "v", "cutoff"))
    qblocks, n = _blocks(known, QUERIES, ["cutoff"])
    exact = _nodes(qblocks, cblocks, n).mapInArrow(_entries(need, fragments, True), ENTRIES)
    ranked = exact.join(classes.select("c", "ids"), "c").withColumn("least", F.col("ids")[0]["id"])
    top = ranked.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "least"))).where(F.col("n") <= need)
    answers = asked.join(distinct, "v").select(F.col("c").alias("q"), F.col("id").alias("query_id"))
    found = F.struct("score", F.flatten(F.transform("ids", lambda x: F.array_repeat(x["id"], x["rows"].cast("int")))).alias("ids"))
    pairs = answers.join(top.groupBy("q").agg(F.collect_list(found).alias("found")), "q").select("query_id", "q", F.explode("found").alias("f")).select("query_id", "q", F.col("f.score").alias("score"), F.explode("f.ids").alias("id")).where("id <> query_id")
    final = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def nearest(embeddings: DataFrame) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose vec_id is divisible by 50, their 5 best among all other rows."""
    asked = embeddings.where(F.col("vec_id") % 50 == 0)
    return search(embeddings, asked).withColumnRenamed("id", "vec_id")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
