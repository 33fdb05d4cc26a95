"""Chunk points end to end, and the remaining rows of the survey (EMB-3, KNN-3, SRC-4, AGG-3/4, IDX-1/2, PRJ-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from simsift.functions import filters as flt
from simsift.functions import text as tx
from simsift.operators import chunk_points as cp
from simsift.operators import chunking, embed, layout, search
from simsift.plans.chunk_queries import EMBED_DIM, budgeted_sql, sql_semantic_chunks, sql_sentence_chunks
from simsift.plans.feature_queries import FIXED_SQL, _uuid5_sql
from simsift.plans.index_queries import TEXT_K, TEXT_QUERY, sql_dense, sql_terms
from simsift.plans.registry import register, sql_score
from simsift.plans.search_queries import FILTER_LANG, FILTER_MIN_CHARS, GROUP_LIMIT, GROUP_SIZE, K, QV_SQL, query_vector, \
    split_scores
from simsift.sources import indexes, tables
from simsift.sources import records as rec

KEEP = tables.PAYLOAD_COLS


def built_points(spark, sf_dir):
    docs = tables.read_table(spark, sf_dir, "documents")
    return cp.chunk_points(docs, "text", key="doc_id", keep=KEEP, dim=EMBED_DIM)


def stored_points(spark, sf_dir):
    """The chunk-point table, built once per application, one folder per chunking."""
    return indexes.stored(spark, "chunk-points", sf_dir, lambda path: built_points(spark, sf_dir).write
                          .mode("overwrite").partitionBy("chunking").parquet(path))


_KEYS = "doc_id, chunking, chunk_index"
POINTS_SQL = f"""{FIXED_SQL}, sen AS ({sql_sentence_chunks("(SELECT doc_id, text, 256 AS sz FROM documents)", "doc_id", "text", "sz")}),
{sql_semantic_chunks("documents", "doc_id", "text").strip()},
u AS (SELECT doc_id, '{chunking.FIXED}' AS chunking, chunk_index, chunk FROM fx
      UNION ALL SELECT doc_id, '{chunking.SENTENCE}', chunk_index, chunk FROM sen
      UNION ALL SELECT doc_id, '{chunking.SEMANTIC}', chunk_index, chunk FROM sem),
ev AS ({sql_dense(sql_terms("u", _KEYS, "chunk"), _KEYS)}),
cpts AS (SELECT u.doc_id, u.chunking, u.chunk_index, u.chunk, d.lang, d.source, d.n_chars,
                {_uuid5_sql("doc_id::VARCHAR || '|' || chunking || '|' || chunk_index::VARCHAR")} AS id,
                coalesce(ev.vector, list_transform(range({EMBED_DIM}), lambda x: 0::FLOAT)) AS v
         FROM u LEFT JOIN ev USING (doc_id, chunking, chunk_index) JOIN documents d USING (doc_id))"""
_Q = "([" + ", ".join(repr(float(x)) for x in embed.embed_query(None, TEXT_QUERY, dim=EMBED_DIM)) + "]::DOUBLE[])"


@register("chunk_points", f"""
WITH {POINTS_SQL}
SELECT id, doc_id, chunking, chunk_index, chunk, lang, source, n_chars,
       CASE WHEN chunking = '{chunking.FIXED}' THEN v END AS vec_fixed,
       CASE WHEN chunking = '{chunking.SENTENCE}' THEN v END AS vec_sentence,
       CASE WHEN chunking = '{chunking.SEMANTIC}' THEN v END AS vec_semantic FROM cpts""")
def chunk_points(spark, sf_dir):
    """CHK-6 + EMB-1 + PRJ-4/8: every chunk of every document with its named vector and source fields."""
    return built_points(spark, sf_dir)


_B_KEYS = "id, chunking, chunk_index"


@register("chunk_points_budgeted", f"""
WITH b AS ({budgeted_sql()}),
ev AS ({sql_dense(sql_terms("b", _B_KEYS, "chunk"), _B_KEYS)}),
v AS (SELECT b.*, coalesce(ev.vector, list_transform(range({EMBED_DIM}), lambda x: 0::FLOAT)) AS v
      FROM b LEFT JOIN ev USING (id, chunking, chunk_index))
SELECT point_id AS id, v.id AS record_id, chunking, chunk_index, chunk, d.source AS name, d.lang AS cuisine,
       d.n_chars::DOUBLE AS rating,
       CASE WHEN chunking = '{chunking.FIXED}' THEN v END AS vec_fixed,
       CASE WHEN chunking = '{chunking.SENTENCE}' THEN v END AS vec_sentence,
       CASE WHEN chunking = '{chunking.SEMANTIC}' THEN v END AS vec_semantic
FROM v JOIN documents d ON d.doc_id = v.id""")
def chunk_points_budgeted(spark, sf_dir):
    """CHK-7 + EMB-1: records chunked within the budget their menu leaves; menu and chunk are embedded together."""
    r = (rec.records(spark, sf_dir).withColumn("menu_text", tx.menu_highlights("menu_items"))
            .withColumn("budget", tx.chunk_budget("menu_text")).withColumnRenamed("id", "record_id"))
    pts = cp.chunk_points(r, "description", key="record_id", keep=("menu_text", "name", "cuisine", "rating"),
                          size=F.col("budget"), dim=EMBED_DIM, dress=lambda c: tx.prepend_menu(c, "menu_text"))
    return pts.drop("menu_text")


@register("chunk_search_strategies", f"""
WITH {POINTS_SQL},
s AS (SELECT chunking AS strategy, id, {sql_score("v", _Q)} AS score FROM cpts),
r AS (SELECT strategy, row_number() OVER (PARTITION BY strategy ORDER BY score DESC, id) AS rank, id, score
      FROM s WHERE score IS NOT NULL)
SELECT * FROM r WHERE rank <= {TEXT_K}""")
def chunk_search_strategies(spark, sf_dir):
    """KNN-8: the best chunks of each strategy for one query text, in one pass over the stored points."""
    q = embed.embed_query(spark, TEXT_QUERY, dim=EMBED_DIM)
    long = cp.long_vectors(stored_points(spark, sf_dir))
    return search.knn_by_strategy(long, {s: q for s in cp.STRATEGIES}, k=TEXT_K)


@register("chunk_search_filtered", f"""
WITH {POINTS_SQL},
s AS (SELECT id, {sql_score("v", _Q)} AS score, doc_id, chunk_index, lang, n_chars, chunk FROM cpts
      WHERE chunking = '{chunking.SENTENCE}' AND lang = '{FILTER_LANG}' AND n_chars >= {FILTER_MIN_CHARS})
SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, score, doc_id, chunk_index, lang, n_chars, chunk,
       printf('%.4f', score) AS score_text, printf('%.1f', n_chars::DOUBLE) AS n_chars_text
FROM s WHERE score IS NOT NULL ORDER BY score DESC, id LIMIT {TEXT_K}""")
def chunk_search_filtered(spark, sf_dir):
    """KNN-5/6 + PRJ-9/10: a filtered search of one named vector, payload and formatted numbers with the hits."""
    q = embed.embed_query(spark, TEXT_QUERY, dim=EMBED_DIM)
    pts = stored_points(spark, sf_dir).where(F.col("chunking") == chunking.SENTENCE)
    cond = flt.must(flt.match_value("lang", FILTER_LANG), flt.range_("n_chars", gte=FILTER_MIN_CHARS))
    hits = search.search_and_inspect(pts, q, chunking.SENTENCE, k=TEXT_K, where=cond,
                                     keep=("doc_id", "chunk_index", "lang", "n_chars"),
                                     payload=pts.select("id", "chunk", F.col("n_chars").cast("double").alias("_n")),
                                     formats={"_n": "%.1f"})
    return hits.drop("_n").withColumnRenamed("_n_text", "n_chars_text")


@register("chunk_search_grouped", f"""
WITH {POINTS_SQL},
s AS (SELECT id, doc_id AS group_id, {sql_score("v", _Q)} AS score FROM cpts WHERE chunking = '{chunking.SEMANTIC}'),
h AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY score DESC, id) AS hit_rank FROM s WHERE score IS NOT NULL),
h2 AS (SELECT * FROM h WHERE hit_rank <= {GROUP_SIZE}),
b AS (SELECT group_id, row_number() OVER (ORDER BY score DESC, id) AS group_rank
      FROM h2 WHERE hit_rank = 1 ORDER BY score DESC, id LIMIT {GROUP_LIMIT})
SELECT b.group_rank, h2.group_id, h2.hit_rank, h2.id, h2.score FROM h2 JOIN b USING (group_id)""")
def chunk_search_grouped(spark, sf_dir):
    """KNN-7: the best documents by their best semantic chunks."""
    q = embed.embed_query(spark, TEXT_QUERY, dim=EMBED_DIM)
    pts = stored_points(spark, sf_dir).where(F.col("chunking") == chunking.SEMANTIC)
    return search.knn_grouped(pts, q, group_by="doc_id", vector=cp.vector_of(chunking.SEMANTIC), limit=GROUP_LIMIT,
                              group_size=GROUP_SIZE)


# ---- small rows ----------------------------------------------------------------

@register("search_empty_text", "SELECT 1::BIGINT AS rank, '' AS id, 0.0::DOUBLE AS score FROM documents WHERE false")
def search_empty_text(spark, sf_dir):
    """EMB-3: an empty query text embeds to the zero vector and finds nothing."""
    q = embed.embed_query(spark, "", dim=EMBED_DIM)
    return search.knn(stored_points(spark, sf_dir), q, vector=cp.vector_of(chunking.SENTENCE))


_DEFAULT_SQL = f"""
WITH {QV_SQL}, s AS (SELECT vec_id AS id, {sql_score("embedding", "qv.q")} AS score FROM embeddings, qv)
SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, score FROM s WHERE score IS NOT NULL
ORDER BY score DESC, id LIMIT 10"""


@register("knn_default_limit", _DEFAULT_SQL)
def knn_default_limit(spark, sf_dir):
    """KNN-3: ten hits when no limit is given."""
    return search.knn(tables.vectors(spark, sf_dir), query_vector(spark, sf_dir))


@register("hit_counts", f"""
WITH {QV_SQL}, s AS (SELECT e.vec_id AS id, {sql_score("e.embedding", "qv.q")} AS score, d.lang
                     FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id, qv),
c AS (SELECT t.lang, count(s.id) AS n FROM (VALUES ('en'), ('fr'), ('xx')) t(lang)
      LEFT JOIN s ON s.lang = t.lang AND s.score IS NOT NULL GROUP BY t.lang)
SELECT lang, least(n, {K}) AS hits, n = 0 AS none FROM c""")
def hit_counts(spark, sf_dir):
    """AGG-4: hits of one search per language filter, with the "no results" case."""
    parts = []
    for lang in ("en", "fr", "xx"):
        hits = search.top_k(split_scores(spark, sf_dir, where=flt.match_value("lang", lang)), K)
        parts.append(hits.agg(F.count(F.lit(1)).alias("hits")).select(
            F.lit(lang).alias("lang"), "hits", (F.col("hits") == 0).alias("none")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("load_totals", """
SELECT day, loaded, sum(loaded) OVER (ORDER BY day)::BIGINT AS total
FROM (SELECT CAST(ts AS DATE) AS day, count(*) AS loaded FROM events GROUP BY 1)""")
def load_totals(spark, sf_dir):
    """AGG-3: rows per load batch (events by day) with the running total; one narrow row per batch."""
    from pyspark.sql import Window

    ev = tables.read_table(spark, sf_dir, "events")
    batches = ev.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("loaded"))
    return batches.withColumn("total", F.sum("loaded").over(Window.orderBy("day")))


@register("dataset_report", """
SELECT (SELECT count(*) FROM documents) AS n_rows, ['doc_id', 'text', 'lang', 'source', 'n_chars'] AS columns,
       doc_id AS first_id, n_chars AS first_n_chars FROM documents ORDER BY doc_id LIMIT 1""")
def dataset_report(spark, sf_dir):
    """SRC-4: size, columns and the first row of the documents."""
    rep = tables.dataset_report(tables.read_table(spark, sf_dir, "documents"), "doc_id")
    return spark.createDataFrame([(rep["rows"], rep["columns"], rep["first"]["doc_id"], rep["first"]["n_chars"])],
                                 "n_rows bigint, columns array<string>, first_id bigint, first_n_chars bigint")


def by_lang(spark, sf_dir):
    docs = tables.payload(spark, sf_dir)
    return indexes.stored(spark, "by-lang", sf_dir, lambda path: layout.write_keyword_layout(docs, "lang", path))


def by_size(spark, sf_dir):
    docs = tables.payload(spark, sf_dir)
    return indexes.stored(spark, "by-size", sf_dir, lambda path: layout.write_range_layout(docs, "n_chars", path))


@register("keyword_layout_read", f"""
SELECT source, count(*) AS n FROM documents WHERE lang = '{FILTER_LANG}' GROUP BY source""")
def keyword_layout_read(spark, sf_dir):
    """IDX-1: a keyword filter answered from one folder of the keyword layout."""
    return by_lang(spark, sf_dir).where(flt.match_value("lang", FILTER_LANG)).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"))


@register("range_layout_read", f"""
SELECT lang, count(*) AS n, min(n_chars) AS low FROM documents WHERE n_chars >= {FILTER_MIN_CHARS} GROUP BY lang""")
def range_layout_read(spark, sf_dir):
    """IDX-2: a range filter answered from the range layout."""
    return by_size(spark, sf_dir).where(flt.range_("n_chars", gte=FILTER_MIN_CHARS)).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.min("n_chars").alias("low"))


@register("results_json_nulls", f"""
WITH {QV_SQL}, s AS (SELECT e.vec_id AS id, {sql_score("e.embedding", "qv.q")} AS score, d.lang, d.n_chars
                     FROM embeddings e LEFT JOIN (SELECT * FROM documents WHERE doc_id % 2 = 0) d ON d.doc_id = e.vec_id, qv),
t AS (SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, * FROM s WHERE score IS NOT NULL
      ORDER BY score DESC, id LIMIT {K})
SELECT rank, to_json({{'id': id, 'score': score, 'payload': {{'lang': lang, 'n_chars': n_chars}}}})::VARCHAR AS json FROM t""")
def results_json_nulls(spark, sf_dir):
    """SNK-8: JSON results in which points without payload (here: those of odd ids) keep null fields."""
    pay = tables.payload(spark, sf_dir, "lang", "n_chars").where(F.col("id") % 2 == 0)
    hits = search.top_k(split_scores(spark, sf_dir), K, payload=pay)
    return search.results_as_json(hits, ("lang", "n_chars"))


@register("records_file", """
SELECT d.doc_id AS id, d.source AS name, d.lang AS cuisine,
       CASE WHEN p.p_partkey IS NULL THEN NULL
            ELSE list_filter([p.p_name, p.p_type], lambda x: x IS NOT NULL) END AS menu_items,
       d.n_chars::DOUBLE AS rating, d.text AS description
FROM documents d LEFT JOIN part p ON p.p_partkey = d.doc_id""")
def records_file(spark, sf_dir):
    """SRC-2: nested records written as JSON lines and read back through the checking reader."""
    path = indexes.stored_path(spark, "records", sf_dir, lambda path: rec.records(spark, sf_dir).write
                               .mode("overwrite").json(path))
    return rec.read_records(spark, path)
