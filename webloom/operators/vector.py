"""Vector retrieval: exact cosine and distance rankings, diversity, and ranking metrics."""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Rows of a ranking that are sent on at once.
ROWS = 500_000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(df: DataFrame, vector: str, out: str) -> DataFrame:
    """df with the vector in doubles and of length 1; a zero vector stays zero."""
    v = F.col(vector).cast("array<double>")
    return df.withColumn(out, v).withColumn("__n", norm(F.col(out))).withColumn(out, F.transform(F.col(out), lambda x: F.when(F.col("__n") > 0, x / F.col("__n")).otherwise(0.0))).drop("__n")


def _packed(df: DataFrame, id_col: str, vector: str, size: int) -> tuple[DataFrame, int]:
    """Rows of about ``size`` vectors each, by a hash of the id; and how many. Floats stay floats until they are multiplied."""
    n = max(1, -(-df.count() // size))
    own = F.col(vector) if df.schema[vector].dataType.simpleString() == "array<float>" else F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_col).alias("id"), own.alias("v"), F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(n)).cast("int").alias("block"))
    return rows.groupBy("block").agg(F.collect_list(F.struct("id", "v")).alias("rows")), n


def _unpacked(column: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids and the matrix of a packed row, straight from Arrow's buffers."""
    ids, vectors = column[i].values.flatten()
    widths = set(vectors.value_lengths().unique().to_pylist())
    if len(widths) != 1 or None in widths:
        raise ValueError("vectors must be there and of one length")
    return ids.to_numpy(zero_copy_only=False), vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), widths.pop())


def _unit(m: np.ndarray) -> np.ndarray:
    m = m.astype(float)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def scores(docs: DataFrame, queries: DataFrame, id_col: str, vector: str, metric: str = "cosine", k: int | None = None, size: int = 4096, asked: int = 256, least: float | None = None) -> DataFrame:
    """(query_id, id, score) of the stated queries against all rows: similarities (cosine) or squared distances (l2).

    Blocks of queries meet blocks of rows by block number, so a task multiplies two matrices of bounded size; with ``k`` it
    sends each query's best k of its block only (and equal scores of the last), which is all that a ranking can need; with
    ``least`` only similarities of at least that."""
    rows, _ = _packed(docs, id_col, vector, size)
    wanted, n = _packed(queries, id_col, vector, asked)
    nodes = rows.select(F.col("rows").alias("docs"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block")).join(wanted, "block").select("docs", "rows")

    def multiply(batches):
        for batch in batches:
            kind = batch.column(0).type.value_type[0].type
            for n in range(batch.num_rows):
                (ids, dv), (qid, qv) = _unpacked(batch.column(0), n), _unpacked(batch.column(1), n)
                if metric == "cosine":
                    s = _unit(qv) @ _unit(dv).T
                else:
                    dv, qv = dv.astype(float), qv.astype(float)
                    s = (qv**2).sum(axis=1)[:, None] + (dv**2).sum(axis=1)[None, :] - 2 * qv @ dv.T
                if k is not None and k < len(ids):
                    goal = -s if metric == "cosine" else s
                    edge = np.partition(goal, k - 1, axis=1)[:, k - 1 : k]
                    i, j = np.nonzero(goal <= edge + 1e-9)
                elif least is not None:
                    i, j = np.nonzero(s >= least)
                else:
                    i, j = np.repeat(np.arange(len(qid)), len(ids)), np.tile(np.arange(len(ids)), len(qid))
                yield pa.RecordBatch.from_arrays([pa.array(qid[i], kind), pa.array(ids[j], kind), pa.array(s[i, j])], ["query_id", "id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return nodes.mapInArrow(multiply, f"query_id {kind}, id {kind}, score double")


def ranking(docs: DataFrame, queries: DataFrame, id_col: str, vector: str, size: int = 4096, asked: int = 128, most: int = 8_000_000) -> DataFrame:
    """(query_id, rank, id, score): all rows ranked by cosine for each stated query, ties to the smaller id.

    A block of queries meets all rows in one task, so what is sent are the packed rows, once for each block, and no pair. A task holds
    the rows' vectors and about ``most`` scores; the pairs themselves are as many as they are."""
    rows, _ = _packed(docs, id_col, vector, size)
    wanted, n = _packed(queries, id_col, vector, asked)
    each = rows.select(F.col("rows").alias("docs"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block")).repartition(n, "block")
    nodes = each.join(wanted, "block").select("docs", "rows", "block").sortWithinPartitions("block")

    def read(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                ids, vectors = _unpacked(batch.column(0), n)
                yield batch.column(2)[n].as_py(), ids.copy(), vectors.copy(), _unpacked(batch.column(1), n), batch.column(0).type.value_type[0].type

    def rank(batches):
        for _, group in groupby(read(batches), key=lambda r: r[0]):
            ids, parts = [], []
            for _, own, vectors, (qid, qv), kind in group:
                ids.append(own)
                parts.append(vectors)
                asked_for = qid.copy(), qv.copy(), kind
            qid, qv, kind = asked_for
            ids = np.concatenate(ids)
            by = np.argsort(ids, kind="stable")
            ids, at_once = ids[by], max(1, most // len(ids))
            for a in range(0, len(qid), at_once):
                some = _unit(qv[a : a + at_once])
                s = np.concatenate([some @ _unit(m).T for m in parts], axis=1)
                for q, own in zip(qid[a : a + at_once], s, strict=True):
                    own = own[by]
                    best = np.argsort(-own, kind="stable") if not np.isnan(own).any() else np.lexsort((-own, ~np.isnan(own)))  # as Spark: no number before all numbers
                    for i in range(0, len(best), ROWS):
                        at = best[i : i + ROWS]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), q), kind), pa.array(np.arange(i + 1, i + 1 + len(at), dtype=np.int32)), pa.array(ids[at], kind), pa.array(own[at])], ["query_id", "rank", "id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return nodes.mapInArrow(rank, f"query_id {kind}, rank int, id {kind}, score double")


def top_k(scored: DataFrame, k: int | None, largest: bool = True) -> DataFrame:
    """(query_id, rank, id, score): the best k of each query, ties to the smaller id, limited in each task before the shuffle; None: all."""
    best = F.desc("score") if largest else F.asc("score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(best, "id"))
    ranked = scored.withColumn("rank", rank)
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def exactly(rows: DataFrame, n: int) -> DataFrame:
    """The first n rows; raises if there are fewer."""
    found = rows.limit(n)
    if (there := found.count()) < n:
        raise ValueError(f"{n} rows are wanted, there are {there}")
    return found


def diverse(found: DataFrame, docs: DataFrame, id_col: str, vector: str, k: int, weight: float = 0.5) -> DataFrame:
    """(query_id, rank, id): maximal marginal relevance over each query's fetched rows (query_id, id, score)."""
    rows = found.join(docs.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("v")), "id").select("query_id", "id", "score", "v")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["score", "id"], ascending=[False, True]).reset_index(drop=True)
        v = np.array(pdf["v"].tolist())
        v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)
        gain, near, picked = pdf["score"].to_numpy(), np.full(len(pdf), 0.0), []
        while len(picked) < min(k, len(pdf)):
            value = np.round(weight * gain - (1 - weight) * near, 12)  # equal but for the last digits: the first in order
            value[picked] = -np.inf
            best = int(np.argmax(value))
            near = np.maximum(near, v @ v[best]) if picked else v @ v[best]
            picked.append(best)
        return pd.DataFrame({"query_id": pdf["query_id"].iloc[picked].to_numpy(), "rank": np.arange(1, len(picked) + 1), "id": pdf["id"].iloc[picked].to_numpy()})

    kind = found.schema["id"].dataType.simpleString()
    return rows.groupBy("query_id").applyInPandas(choose, f"query_id {kind}, rank int, id {kind}")


def hashing(width: int):
    """Texts as unit vectors of signed word counts by hash: needs no model, and is the same everywhere."""

    def vectors(texts: list[str]) -> list[list[float]]:
        from zlib import crc32

        out = np.zeros((len(texts), width))
        for i, text in enumerate(texts):
            for word in text.lower().split():
                h = crc32(word.encode())
                out[i, h % width] += 1 if h >> 31 else -1
        return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-300)).tolist()

    return vectors


def embed(df: DataFrame, text: str, out: str, model=None, width: int = 64) -> DataFrame:
    """df with a vector for each text, in Arrow batches. model: texts -> vectors; without one the hashing embedder. Null counts as empty."""
    vectors = model or hashing(width)

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(list(vectors(["" if t is None else t for t in texts])), index=texts.index)

    return df.withColumn(out, run(F.col(text)))
