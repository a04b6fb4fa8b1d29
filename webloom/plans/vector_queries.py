"""Retrieval queries over ``embeddings``; relevance is an equal label."""

from __future__ import annotations

from pyspark.sql import functions as F

from webloom.operators import vector as V
from webloom.plans.catalog import register
from webloom.session import table

DOUBLES = "v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"
PAIRS = f"{DOUBLES}, s AS (SELECT q.vec_id AS query_id, d.vec_id AS id, q.label AS ql, d.label AS dl, list_cosine_similarity(q.e, d.e) AS score FROM v q JOIN v d ON true WHERE q.vec_id % 50 = 0)"
TOP = PAIRS + ", t AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INTEGER) AS rank FROM s)"


def _rows(spark, sf_dir):
    return table(spark, sf_dir, "embeddings")


def _asked(spark, sf_dir):
    return _rows(spark, sf_dir).where("vec_id % 50 = 0")


def _cosine(spark, sf_dir, k):
    return V.top_k(V.scores(_rows(spark, sf_dir), _asked(spark, sf_dir), "vec_id", "embedding", k=k), k)


def _judged(spark, sf_dir, k):
    """The top k with whether each is relevant."""
    labels = _rows(spark, sf_dir).select("vec_id", "label")
    found = _cosine(spark, sf_dir, k).join(labels.withColumnsRenamed({"vec_id": "id", "label": "dl"}), "id").join(labels.withColumnsRenamed({"vec_id": "query_id", "label": "ql"}), "query_id")
    return found.withColumn("hit", (F.col("ql") == F.col("dl")).cast("int"))


@register("unit_vectors", f"WITH {DOUBLES} SELECT vec_id, round(sqrt(list_inner_product(e, e)), 5) AS norm, round(e[1] / sqrt(list_inner_product(e, e)), 5) AS first FROM v")
def unit_vectors(spark, sf_dir):
    rows = V.unit(_rows(spark, sf_dir), "embedding", "u")
    return rows.select("vec_id", F.round(V.norm(F.col("embedding").cast("array<double>")), 5).alias("norm"), F.round(F.col("u")[0], 5).alias("first"))


@register("cosine_topk", f"WITH {TOP} SELECT query_id, rank, id, round(score, 6) AS score FROM t WHERE rank <= 5")
def cosine_topk(spark, sf_dir):
    return _cosine(spark, sf_dir, 5).select("query_id", "rank", "id", F.round("score", 6).alias("score"))


@register("retriever_topk", f"WITH {TOP} SELECT query_id, rank, id FROM t WHERE rank <= 30")
def retriever_topk(spark, sf_dir):
    return _cosine(spark, sf_dir, 30).select("query_id", "rank", "id")


@register("l2_topk", f"WITH {DOUBLES}, s AS (SELECT q.vec_id AS query_id, d.vec_id AS id, pow(list_distance(q.e, d.e), 2) AS score FROM v q JOIN v d ON true WHERE q.vec_id % 50 = 0), t AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9), id) AS INTEGER) AS rank FROM s) SELECT query_id, rank, id, round(score, 5) AS distance FROM t WHERE rank <= 5")
def l2_topk(spark, sf_dir):
    scored = V.scores(_rows(spark, sf_dir), _asked(spark, sf_dir), "vec_id", "embedding", "l2", k=5).withColumn("score", F.abs(F.round("score", 9)))
    return V.top_k(scored, 5, largest=False).select("query_id", "rank", "id", F.round("score", 5).alias("distance"))


@register("score_threshold", f"WITH {PAIRS} SELECT query_id, count(*) AS n FROM s WHERE score >= 0.3 GROUP BY query_id")
def score_threshold(spark, sf_dir):
    return V.scores(_rows(spark, sf_dir), _asked(spark, sf_dir), "vec_id", "embedding", least=0.3).groupBy("query_id").agg(F.count("*").alias("n"))


@register("mean_topk_by_label", f"WITH {TOP} SELECT ql AS label, round(avg(score), 5) AS mean_score FROM t WHERE rank <= 5 GROUP BY ql")
def mean_topk_by_label(spark, sf_dir):
    return _judged(spark, sf_dir, 5).groupBy(F.col("ql").alias("label")).agg(F.round(F.avg("score"), 5).alias("mean_score"))


@register("precision_at_k", f"WITH {TOP} SELECT query_id, round(sum(CASE WHEN ql = dl THEN 1 ELSE 0 END) / 10.0, 4) AS precision FROM t WHERE rank <= 10 GROUP BY query_id")
def precision_at_k(spark, sf_dir):
    return _judged(spark, sf_dir, 10).groupBy("query_id").agg(F.round(F.sum("hit") / 10, 4).alias("precision"))


@register("recall_at_k", f"WITH {TOP}, r AS (SELECT label, count(*) AS relevant FROM embeddings GROUP BY label) SELECT query_id, round(sum(CASE WHEN ql = dl THEN 1 ELSE 0 END) / max(relevant), 5) AS recall FROM t JOIN r ON r.label = t.ql WHERE rank <= 30 GROUP BY query_id")
def recall_at_k(spark, sf_dir):
    relevant = _rows(spark, sf_dir).groupBy(F.col("label").alias("ql")).agg(F.count("*").alias("relevant"))
    return _judged(spark, sf_dir, 30).join(relevant, "ql").groupBy("query_id").agg(F.round(F.sum("hit") / F.max("relevant"), 5).alias("recall"))


@register("f1_at_k", f"WITH {TOP}, r AS (SELECT label, count(*) AS relevant FROM embeddings GROUP BY label), h AS (SELECT query_id, sum(CASE WHEN ql = dl THEN 1 ELSE 0 END) AS hits, max(relevant) AS relevant FROM t JOIN r ON r.label = t.ql WHERE rank <= 30 GROUP BY query_id) SELECT query_id, round(2.0 * hits / (30 + relevant), 5) AS f1 FROM h")
def f1_at_k(spark, sf_dir):
    relevant = _rows(spark, sf_dir).groupBy(F.col("label").alias("ql")).agg(F.count("*").alias("relevant"))
    return _judged(spark, sf_dir, 30).join(relevant, "ql").groupBy("query_id").agg(F.round(2.0 * F.sum("hit") / (30 + F.max("relevant")), 5).alias("f1"))


@register("mrr", f"WITH {TOP}, f AS (SELECT query_id, min(CASE WHEN ql = dl AND id <> query_id THEN rank END) AS first FROM t WHERE rank <= 30 GROUP BY query_id) SELECT round(avg(coalesce(1.0 / first, 0)), 5) AS mrr, count(*) AS n FROM f")
def mrr(spark, sf_dir):
    first = _judged(spark, sf_dir, 30).groupBy("query_id").agg(F.min(F.when((F.col("hit") == 1) & (F.col("id") != F.col("query_id")), F.col("rank"))).alias("first"))
    return first.agg(F.round(F.avg(F.coalesce(1.0 / F.col("first"), F.lit(0.0))), 5).alias("mrr"), F.count("*").alias("n"))


@register("ndcg", f"WITH {TOP}, g AS (SELECT query_id, sum(CASE WHEN ql = dl THEN 1 / log2(rank + 1) ELSE 0 END) AS dcg FROM t WHERE rank <= 10 GROUP BY query_id) SELECT query_id, round(dcg / (SELECT sum(1 / log2(i + 1)) FROM range(1, 11) r(i)), 5) AS ndcg FROM g")
def ndcg(spark, sf_dir):
    ideal = F.lit(sum(1 / __import__("math").log2(i + 1) for i in range(1, 11)))
    gain = F.when(F.col("hit") == 1, 1 / F.log2(F.col("rank") + 1)).otherwise(0.0)
    return _judged(spark, sf_dir, 10).groupBy("query_id").agg(F.round(F.sum(gain) / ideal, 5).alias("ndcg"))


@register("mmr_topk")
def mmr_topk(spark, sf_dir):
    """Greedy diversity over 30 fetched rows, the query's own not among them: no SQL form; the tests hold it against a plain loop."""
    fetched = _cosine(spark, sf_dir, 31).where("id <> query_id").select("query_id", "id", "score")
    return V.diverse(fetched, _rows(spark, sf_dir), "vec_id", "embedding", 5)


@register("sample_rows", "SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || ':265'), doc_id LIMIT 100")
def sample_rows(spark, sf_dir):
    """A sample of 100 that any engine draws alike: the smallest hashes. Fewer rows than that are an error."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return V.exactly(docs.orderBy(F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":265")).cast("binary")), "doc_id"), 100)


#: Rows that the retriever hands to its chains.
RETRIEVED = 30
_CHAIN = f"{TOP}, x AS (SELECT query_id, rank, coalesce(text, '') AS text FROM t JOIN documents ON doc_id = id WHERE rank <= {RETRIEVED})"


def _retrieved(spark, sf_dir):
    """(query_id, rank, text): the retriever's rows with their whole texts."""
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return _cosine(spark, sf_dir, RETRIEVED).join(texts, "id").select("query_id", "rank", "text")


def _in_order(column, by):
    """A group's values of the column as one text, best first."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", column))), lambda x: x[column]), by)


@register("rag_stuff_context", f"WITH {_CHAIN} SELECT query_id, string_agg(text, chr(10) ORDER BY rank) AS context, count(*) AS n FROM x GROUP BY query_id")
def rag_stuff_context(spark, sf_dir):
    """The 'stuff' chain: every retrieved text, whole, in one context, best first."""
    return _retrieved(spark, sf_dir).groupBy("query_id").agg(_in_order("text", "\n").alias("context"), F.count("*").alias("n"))


@register("rag_map_prompts", f"WITH {_CHAIN} SELECT query_id, rank, 'Summarise for question ' || query_id || ': ' || text AS prompt FROM x")
def rag_map_prompts(spark, sf_dir):
    """The first half of the 'map_reduce' chain: a prompt for each retrieved text, whole."""
    return _retrieved(spark, sf_dir).select("query_id", "rank", _part().alias("prompt"))


def _part():
    return F.concat(F.lit("Summarise for question "), F.col("query_id").cast("string"), F.lit(": "), "text")


@register("rag_map_reduce", f"WITH {_CHAIN} SELECT query_id, 'Combine: ' || string_agg('Summarise for question ' || query_id || ': ' || text, ' || ' ORDER BY rank) AS prompt FROM x GROUP BY query_id")
def rag_map_reduce(spark, sf_dir):
    """A prompt for each retrieved text, best first, and the one that combines them; a model would answer between the two."""
    mapped = _retrieved(spark, sf_dir).select("query_id", "rank", _part().alias("part"))
    return mapped.groupBy("query_id").agg(F.concat(F.lit("Combine: "), _in_order("part", " || ")).alias("prompt"))


@register("rag_questions", f"""WITH q AS (SELECT conv_id AS query_id, text AS question FROM conversations WHERE turn = 0 AND role = 'user' AND conv_id % 50 = 0), {_CHAIN},
  c AS (SELECT query_id, string_agg(text, chr(10) ORDER BY rank) AS context FROM x WHERE rank <= 5 GROUP BY query_id)
  SELECT query_id, 'Use the context to answer.' || chr(10) || 'Context: ' || context || chr(10) || 'Question: ' || coalesce(question, '') || chr(10) || 'Answer:' AS prompt,
    'Question: ' || coalesce(question, '') || chr(10) || 'Answer:' AS baseline FROM q JOIN c USING (query_id)""")
def rag_questions(spark, sf_dir):
    """The loop over questions as one plan: each with its five best texts, and without any."""
    from webloom.functions import text as X

    asked = table(spark, sf_dir, "conversations").where("turn = 0 and role = 'user' and conv_id % 50 = 0").select(F.col("conv_id").alias("query_id"), F.coalesce("text", F.lit("")).alias("question"))
    context = _retrieved(spark, sf_dir).where("rank <= 5").groupBy("query_id").agg(_in_order("text", "\n").alias("context"))
    return asked.join(context, "query_id").select("query_id", X.prompt(F.col("question"), F.col("context")).alias("prompt"), X.prompt(F.col("question")).alias("baseline"))


@register("ranked_scores", f"WITH {TOP} SELECT query_id, rank, id, round(score, 6) AS score FROM t")
def ranked_scores(spark, sf_dir):
    """Every row scored against each stated query, best first."""
    return V.ranking(_rows(spark, sf_dir), _asked(spark, sf_dir), "vec_id", "embedding").select("query_id", "rank", "id", F.round("score", 6).alias("score"))


@register("model_means", f"""WITH {DOUBLES}, m AS (SELECT 'whole' AS model, vec_id, e FROM v UNION ALL SELECT 'half' AS model, vec_id, e[1:32] AS e FROM v),
  s AS (SELECT q.model, q.vec_id AS query_id, d.vec_id AS id, list_cosine_similarity(q.e, d.e) AS score FROM m q JOIN m d ON q.model = d.model WHERE q.vec_id % 50 = 0),
  t AS (SELECT *, row_number() OVER (PARTITION BY model, query_id ORDER BY score DESC, id) AS rank FROM s) SELECT model, query_id, round(avg(score), 4) AS mean_score FROM t WHERE rank <= 5 GROUP BY model, query_id""")
def model_means(spark, sf_dir):
    """Models compared by their mean score over the five best rows of each query; here a model is all or half of the components."""
    out = None
    for name, vector in (("whole", F.col("embedding")), ("half", F.slice("embedding", 1, 32))):
        rows = _rows(spark, sf_dir).select("vec_id", vector.alias("embedding"))
        best = V.top_k(V.scores(rows, rows.where("vec_id % 50 = 0"), "vec_id", "embedding", k=5), 5)
        mean = best.groupBy(F.lit(name).alias("model"), "query_id").agg(F.round(F.avg("score"), 4).alias("mean_score"))
        out = mean if out is None else out.union(mean)
    return out
