"""Dense search queries over ``points = embeddings ⋈ documents`` (KNN-1..8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from simsift.functions import filters as flt
from simsift.functions.vectors import COSINE, DOT
from simsift.operators import search
from simsift.plans.registry import register, sql_score
from simsift.sources import tables

# Fixed query parameters of the registered search queries.
QUERY_ID = 0          # the query vector is the embedding of this point
K = 10
FILTER_LANG = "en"
FILTER_MIN_CHARS = 1000

PTS_SQL = """pts AS (
  SELECT e.vec_id AS id, e.embedding AS vector, d.lang, d.source, d.n_chars
  FROM embeddings e LEFT JOIN documents d ON e.vec_id = d.doc_id)"""
QV_SQL = f"qv AS (SELECT embedding AS q FROM embeddings WHERE vec_id = {QUERY_ID})"


def split_scores(spark, sf_dir, where=None, keep=(), metric=COSINE, payload_cols=()):
    """Scores of all vectors (embeddings), filtered by the payload (documents) when ``where`` is given."""
    return search.score_split(tables.vectors(spark, sf_dir), tables.payload(spark, sf_dir, *payload_cols),
                              query_vector(spark, sf_dir), where=where, keep=keep, metric=metric)


def query_vector(spark, sf_dir, qid=QUERY_ID):
    emb = tables.read_table(spark, sf_dir, "embeddings")
    return tables.vector_of(emb, qid, id_col="vec_id", vector="embedding")


def _topk_sql(score_sql: str, where: str = "TRUE", k: int = K, extra: str = ", s.lang, s.source, s.n_chars",
              text: bool = False) -> str:
    tail = ", d.text" if text else ""
    join = "LEFT JOIN documents d ON d.doc_id = t.id" if text else ""
    return f"""
WITH {PTS_SQL}, {QV_SQL},
scored AS (SELECT p.id, {score_sql} AS score, p.lang, p.source, p.n_chars FROM pts p, qv WHERE {where}),
t AS (SELECT row_number() OVER (ORDER BY s.score DESC, s.id) AS rank, s.id, s.score{extra}
      FROM scored s WHERE s.score IS NOT NULL ORDER BY s.score DESC, s.id LIMIT {k})
SELECT t.*{tail} FROM t {join}"""


FILTERED_WHERE = f"p.lang = '{FILTER_LANG}' AND p.n_chars >= {FILTER_MIN_CHARS}"


@register("knn_filtered", _topk_sql(sql_score("p.vector", "qv.q"), FILTERED_WHERE, text=True))
def knn_filtered(spark, sf_dir):
    """Minimum slice: keyword + range filter, cosine top-10, payload incl. text."""
    cond = flt.must(flt.match_value("lang", FILTER_LANG), flt.range_("n_chars", gte=FILTER_MIN_CHARS))
    return search.top_k(split_scores(spark, sf_dir, where=cond), K,
                        payload=tables.payload(spark, sf_dir, *tables.PAYLOAD_COLS, "text"))


@register("knn_cosine", _topk_sql(sql_score("p.vector", "qv.q")))
def knn_cosine(spark, sf_dir):
    return search.top_k(split_scores(spark, sf_dir), K, payload=tables.payload(spark, sf_dir))


@register("knn_dot", _topk_sql(sql_score("p.vector", "qv.q", DOT)))
def knn_dot(spark, sf_dir):
    return search.top_k(split_scores(spark, sf_dir, metric=DOT), K, payload=tables.payload(spark, sf_dir))


# Named vectors: the 64-dim embedding is split into two named vectors.
NAMED_SPLIT = 32
NAMED_K = 5


@register("knn_named", f"""
WITH {PTS_SQL}, {QV_SQL},
np AS (SELECT id, vector[{NAMED_SPLIT + 1}:{2 * NAMED_SPLIT}] AS vec_tail, lang, source, n_chars FROM pts),
scored AS (SELECT p.id, {sql_score("p.vec_tail", f"qv.q[{NAMED_SPLIT + 1}:{2 * NAMED_SPLIT}]")} AS score,
           p.lang, p.source, p.n_chars FROM np p, qv WHERE p.vec_tail IS NOT NULL)
SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, score, lang, source, n_chars
FROM scored WHERE score IS NOT NULL ORDER BY score DESC, id LIMIT {NAMED_K}""")
def knn_named(spark, sf_dir):
    """KNN-5: search the ``tail`` named vector only (scored where the vectors are read)."""
    q = query_vector(spark, sf_dir)[NAMED_SPLIT:2 * NAMED_SPLIT]
    emb = tables.read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.slice("embedding", NAMED_SPLIT + 1, NAMED_SPLIT).alias("vec_tail"))
    return search.knn(emb, q, vector="vec_tail", k=NAMED_K, payload=tables.payload(spark, sf_dir))


GROUP_LIMIT = 4
GROUP_SIZE = 2


@register("knn_grouped", f"""
WITH {PTS_SQL}, {QV_SQL},
s AS (SELECT p.id, p.source AS group_id, {sql_score("p.vector", "qv.q")} AS score
      FROM pts p, qv WHERE p.n_chars >= {FILTER_MIN_CHARS}),
h AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY score DESC, id) AS hit_rank
      FROM s WHERE score IS NOT NULL AND group_id IS NOT NULL),
h2 AS (SELECT * FROM h WHERE hit_rank <= {GROUP_SIZE}),
b AS (SELECT group_id, row_number() OVER (ORDER BY score DESC, id) AS group_rank
      FROM h2 WHERE hit_rank = 1 ORDER BY score DESC, id LIMIT {GROUP_LIMIT})
SELECT b.group_rank, h2.group_id, h2.hit_rank, h2.id, h2.score FROM h2 JOIN b USING (group_id)""")
def knn_grouped(spark, sf_dir):
    """KNN-7: grouped by source, range filter, best 2 per group, best 4 groups."""
    scored = split_scores(spark, sf_dir, where=flt.range_("n_chars", gte=FILTER_MIN_CHARS), keep=("source",))
    return search.grouped_top_k(scored, "source", limit=GROUP_LIMIT, group_size=GROUP_SIZE)


# Strategies of the multi-strategy search: name -> (first element, length), 1-based.
STRATEGIES = {"full": (1, 64), "head": (1, NAMED_SPLIT), "tail": (NAMED_SPLIT + 1, NAMED_SPLIT)}


def _strategy_sql() -> str:
    arms = " UNION ALL ".join(
        f"SELECT '{s}' AS strategy, p.id, {sql_score(f'p.vector[{a}:{a + n - 1}]', f'qv.q[{a}:{a + n - 1}]')} AS score "
        f"FROM pts p, qv" for s, (a, n) in STRATEGIES.items())
    return f"""
WITH {PTS_SQL}, {QV_SQL}, s AS ({arms}),
r AS (SELECT strategy, row_number() OVER (PARTITION BY strategy ORDER BY score DESC, id) AS rank, id, score
      FROM s WHERE score IS NOT NULL)
SELECT * FROM r WHERE rank <= {K}"""


@register("knn_multi_strategy", _strategy_sql())
def knn_multi_strategy(spark, sf_dir):
    """KNN-8: the same query over every strategy in one job (vectors scored where read)."""
    q = query_vector(spark, sf_dir)
    queries = {s: q[a - 1:a - 1 + n] for s, (a, n) in STRATEGIES.items()}
    emb = tables.read_table(spark, sf_dir, "embeddings")
    arms = F.array(*[F.struct(F.lit(s).alias("strategy"), F.slice("embedding", a, n).alias("vector"))
                     for s, (a, n) in STRATEGIES.items()])
    long = emb.select(F.col("vec_id").alias("id"), F.inline(arms))
    return search.knn_by_strategy(long, queries, k=K)


def many_queries(spark, sf_dir):
    """Every vector whose id 50 divides, as a query set that grows with the table."""
    return tables.vectors(spark, sf_dir).where(F.col("id") % 50 == 0).withColumnRenamed("id", "qid")


MANY_SQL = f"""
WITH {PTS_SQL},
qs AS (SELECT vec_id AS qid, embedding AS q FROM embeddings WHERE vec_id % 50 = 0),
s AS (SELECT qs.qid, p.id, {sql_score("p.vector", "qs.q")} AS score FROM pts p, qs),
r AS (SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank, id, score
      FROM s WHERE score IS NOT NULL)
SELECT * FROM r WHERE rank <= {K}"""


@register("knn_batch", MANY_SQL)
def knn_batch(spark, sf_dir):
    """KNN-11: all query vectors in one kNN join (Arrow matrix-product kernel)."""
    from simsift.operators.knn_join import knn_join

    return knn_join(tables.vectors(spark, sf_dir), many_queries(spark, sf_dir), k=K)


@register("knn_group_best", f"""
WITH {PTS_SQL}, {QV_SQL},
s AS (SELECT p.id, p.source AS group_id, {sql_score("p.vector", "qv.q")} AS score
      FROM pts p, qv WHERE p.n_chars >= {FILTER_MIN_CHARS} AND p.source IS NOT NULL),
b AS (SELECT group_id, id, score, row_number() OVER (PARTITION BY group_id ORDER BY score DESC, id) AS rn
      FROM s WHERE score IS NOT NULL)
SELECT row_number() OVER (ORDER BY score DESC, id) AS group_rank, group_id, score AS best_score
FROM b WHERE rn = 1 ORDER BY score DESC, id LIMIT {GROUP_LIMIT}""")
def knn_group_best(spark, sf_dir):
    """PRJ-12: group id and its best score for the best groups of the grouped search."""
    scored = split_scores(spark, sf_dir, where=flt.range_("n_chars", gte=FILTER_MIN_CHARS), keep=("source",))
    return search.group_best(search.grouped_top_k(scored, "source", limit=GROUP_LIMIT, group_size=1))


@register("vector_preview", """
SELECT vec_id AS id, len(embedding)::INTEGER AS dim, embedding[1:5] AS head FROM embeddings""")
def vector_preview(spark, sf_dir):
    """PRJ-11: dimension and first five values of every vector."""
    from simsift.functions.vectors import preview

    emb = tables.read_table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("id"), *preview("embedding", 5))
