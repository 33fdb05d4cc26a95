"""Embedding, sparse, postings, LSH and summary queries (EMB-*, KNN-6/9/10, IDX-3, ANN-*, AGG-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from simsift.functions import filters as flt
from simsift.operators import ann, chunking, embed, impacts, layout, search, sparse, summary
from simsift.plans.chunk_queries import EMBED_DIM, sql_sentence_chunks
from simsift.plans.feature_queries import FIXED_SQL, MATCH_QUERY, _filtered_sql, _uuid5_sql, sql_tokens, sql_words
from simsift.plans.registry import register, sql_dot, sql_score
from simsift.plans.search_queries import FILTERED_WHERE, FILTER_LANG, FILTER_MIN_CHARS, K, PTS_SQL, QV_SQL, \
    query_vector
from simsift.sources import indexes, tables

# Fixed query parameters.
TEXT_QUERY = "the old house by the river"
TEXT_K = 5
LSH = ann.LshParams(bits=8, tables=4, radius=1)


# ---- embedding ---------------------------------------------------------------

def sql_terms(src: str, keys: str, text: str, dim: int = EMBED_DIM) -> str:
    return f"""SELECT {keys}, (h % {dim})::INTEGER AS bucket, sum(1 - 2 * ((h // {dim}) % 2))::INTEGER AS value
  FROM (SELECT {keys}, ('0x' || substr(md5(lower(tok)), 1, 8))::BIGINT AS h
        FROM (SELECT {keys}, unnest({sql_tokens(text)}) AS tok FROM {src}))
  GROUP BY ALL HAVING sum(1 - 2 * ((h // {dim}) % 2)) <> 0"""


def sql_dense(terms: str, keys: str, dim: int = EMBED_DIM) -> str:
    return f"""SELECT {keys}, list_transform(range({dim}), lambda d: coalesce(m[d::INTEGER], 0)::FLOAT) AS vector
  FROM (SELECT {keys}, map_from_entries(list({{'k': bucket, 'v': value}})) AS m FROM ({terms}) GROUP BY ALL)"""


@register("embed_hashing", f"""
WITH {FIXED_SQL}, ev AS ({sql_dense(sql_terms("fx", "doc_id, chunk_index", "chunk"), "doc_id, chunk_index")})
SELECT fx.doc_id, fx.chunk_index,
       coalesce(ev.vector, list_transform(range({EMBED_DIM}), lambda d: 0::FLOAT)) AS vector
FROM fx LEFT JOIN ev USING (doc_id, chunk_index)""")
def embed_hashing(spark, sf_dir):
    """EMB-1: hashed 256-dim vector of every fixed chunk."""
    docs = tables.read_table(spark, sf_dir, "documents")
    fx = chunking.fixed_chunks(docs, "text", keep=("doc_id",))
    return embed.embed(fx, "chunk", ["doc_id", "chunk_index"], dim=EMBED_DIM).select(
        "doc_id", "chunk_index", "vector")


def sentence_points(spark, sf_dir, where=None):
    """Sentence-chunk points: ``(id=point_id, doc_id, chunk_index, chunk, vec_sentence, payload)``."""
    from simsift.functions.text import point_id

    docs = tables.read_table(spark, sf_dir, "documents")
    if where is not None:
        docs = docs.where(where)
    ch = chunking.sentence_chunks(docs, "text", keep=("doc_id", "lang", "n_chars"))
    ch = ch.withColumn("id", point_id(F.col("doc_id"), F.lit(chunking.SENTENCE), F.col("chunk_index")))
    return embed.embed(ch, "chunk", ["doc_id", "chunk_index"], dim=EMBED_DIM, out="vec_sentence")


def _text_search_sql() -> str:
    q = embed.embed_query(None, TEXT_QUERY, dim=EMBED_DIM)
    qlit = "([" + ", ".join(repr(float(x)) for x in q) + "]::DOUBLE[])"
    key = "doc_id::VARCHAR || '|sentence|' || chunk_index::VARCHAR"
    return f"""
WITH d AS (SELECT doc_id, text, lang, n_chars, 256 AS sz FROM documents
           WHERE lang = '{FILTER_LANG}' AND n_chars >= {FILTER_MIN_CHARS}),
c AS ({sql_sentence_chunks("d", "doc_id", "text", "sz")}),
ev AS ({sql_dense(sql_terms("c", "doc_id, chunk_index", "chunk"), "doc_id, chunk_index")}),
p AS (SELECT c.doc_id, c.chunk_index, c.chunk, {_uuid5_sql(key)} AS id,
             coalesce(ev.vector, list_transform(range({EMBED_DIM}), lambda x: 0::FLOAT)) AS v
      FROM c LEFT JOIN ev USING (doc_id, chunk_index)),
s AS (SELECT id, doc_id, chunk_index, chunk, {sql_score("v", qlit)} AS score FROM p)
SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, score, doc_id, chunk_index, chunk
FROM s WHERE score IS NOT NULL ORDER BY score DESC, id LIMIT {TEXT_K}"""


@register("text_search", _text_search_sql())
def text_search(spark, sf_dir):
    """KNN-6 + EMB-2: query text -> hashed vector -> filtered top-5 over sentence chunks."""
    cond = flt.must(flt.match_value("lang", FILTER_LANG), flt.range_("n_chars", gte=FILTER_MIN_CHARS))
    pts = sentence_points(spark, sf_dir, where=cond)
    q = embed.embed_query(spark, TEXT_QUERY, dim=EMBED_DIM)
    hits = search.search_and_inspect(pts, q, "sentence", k=TEXT_K, keep=("doc_id", "chunk_index", "chunk"))
    return hits.select("rank", "id", "score", "doc_id", "chunk_index", "chunk")


# ---- sparse ------------------------------------------------------------------

def sparse_terms(spark, sf_dir):
    """Inverted index over every term of every document, stored sorted by index; made from the stored vectors."""
    return indexes.stored(spark, "sparse", sf_dir, lambda path: sparse.build_inverted(
        sparse_points(spark, sf_dir), "sp", path))


_Q_TERMS = ", ".join(f"({i}::BIGINT, {v}::DOUBLE)" for i, v in zip(*sparse.query_terms(TEXT_QUERY)))
SPARSE_SQL = f"""
WITH lp AS (SELECT id, idx, count(*)::DOUBLE AS val FROM (
              SELECT doc_id AS id, ('0x' || substr(md5(lower(tok)), 1, 8))::BIGINT AS idx
              FROM (SELECT doc_id, unnest({sql_tokens('text')}) AS tok FROM documents)) GROUP BY ALL),
q AS (SELECT * FROM (VALUES {_Q_TERMS}) t(idx, qval)),
s AS (SELECT lp.id, round(sum(lp.val * q.qval), 6) AS score FROM lp JOIN q USING (idx) GROUP BY lp.id)
SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, score FROM s ORDER BY score DESC, id LIMIT {K}"""


def sparse_points(spark, sf_dir):
    """The sparse vector of every document, counted where the document is read and stored."""
    docs = tables.read_table(spark, sf_dir, "documents")
    return indexes.stored(spark, "sparse-points", sf_dir, lambda path: sparse.term_vectors(
        docs, "text", id_col="doc_id").write.mode("overwrite").parquet(path))


@register("sparse_knn_scan", SPARSE_SQL)
def sparse_knn_scan(spark, sf_dir):
    """KNN-9/10 full-scan path: each stored row folds its own arrays of all its terms against the query."""
    qi, qv = sparse.query_terms(TEXT_QUERY)
    return sparse.knn_scan(sparse_points(spark, sf_dir), "sp", qi, qv, k=K)


@register("sparse_knn_blocks", SPARSE_SQL)
def sparse_knn_blocks(spark, sf_dir):
    """KNN-10 by impact: the greatest postings first, until no other point can reach the top-10."""
    blocks = indexes.stored(spark, "sparse-blocks", sf_dir, lambda path: impacts.write_blocks(
        impacts.posting_blocks(sparse.to_long(sparse_points(spark, sf_dir), "sp")), path))
    qi, qv = sparse.query_terms(TEXT_QUERY)
    return impacts.knn_block_max(blocks, sparse_points(spark, sf_dir), qi, qv, k=K)[0]


@register("sparse_knn_inverted", SPARSE_SQL)
def sparse_knn_inverted(spark, sf_dir):
    """KNN-10 inverted path: the stored long (idx, id, val) table joined with the query terms."""
    qi, qv = sparse.query_terms(TEXT_QUERY)
    return sparse.knn_inverted(sparse_terms(spark, sf_dir), qi, qv, k=K)


# ---- postings ----------------------------------------------------------------

@register("postings_build", f"""
SELECT DISTINCT unnest({sql_words('text')}) AS token, doc_id AS id FROM documents""")
def postings_build(spark, sf_dir):
    """IDX-3 build: (token, id) postings of every document."""
    docs = tables.read_table(spark, sf_dir, "documents")
    return layout.postings(docs, "text", id_col="doc_id")


@register("postings_search", _filtered_sql(
    f"list_has_all({sql_words('d.text')}, {flt.query_words(MATCH_QUERY)!r})"))
def postings_search(spark, sf_dir):
    """IDX-3 + ANN-2: text filter answered from the stored postings, then cosine top-10."""
    docs = tables.read_table(spark, sf_dir, "documents")
    post = indexes.stored(spark, "postings", sf_dir, lambda path: layout.write_postings(
        layout.postings(docs, "text", id_col="doc_id"), path))
    cand = layout.match_ids(post, MATCH_QUERY)
    small = search.sized_broadcast(cand)
    vec = tables.vectors(spark, sf_dir)
    query = query_vector(spark, sf_dir)
    if small is not None:
        vec = vec.join(small, "id", "left_semi")
        return search.knn(vec, query, k=K, payload=tables.payload(spark, sf_dir))
    scored = search.score_split(vec, tables.payload(spark, sf_dir), query).join(cand, "id", "left_semi")
    return search.top_k(scored, K, payload=tables.payload(spark, sf_dir))


# ---- LSH ---------------------------------------------------------------------

def _sig_sql(params: ann.LshParams = LSH) -> str:
    b = params.bits
    n = params.bits * params.tables
    sign = "CASE WHEN (('0x' || substr(md5(p::VARCHAR || '|' || i::VARCHAR), 1, 2))::INTEGER & 1) = 1 THEN -1.0 ELSE 1.0 END"
    return f"""
dimq AS (SELECT len(embedding) AS dim FROM embeddings WHERE vec_id = 0),
planes AS (SELECT p, list(({sign})::DOUBLE ORDER BY i) AS pl
           FROM range(0, {n}) t(p), range(0, (SELECT dim FROM dimq)) s(i) GROUP BY p),
sigs AS (SELECT x.id, (pl.p // {b})::INTEGER AS table_no,
                sum(CASE WHEN {sql_dot("x.vector", "pl.pl")} >= 0 THEN (1::BIGINT << (pl.p % {b})::INTEGER) ELSE 0 END)::BIGINT AS sig
         FROM pts x, planes pl WHERE len(x.vector) = (SELECT dim FROM dimq) GROUP BY ALL),
qsig AS (SELECT table_no, sig AS qs FROM sigs WHERE id = 0),
ham AS (SELECT s.id, min(bit_count(xor(s.sig, q.qs))) AS h FROM sigs s JOIN qsig q USING (table_no) GROUP BY s.id)"""


def lsh_sigs(spark, sf_dir, dim):
    """Stored signatures of every vector, sorted by (table_no, sig)."""
    return indexes.stored(spark, f"lsh-{LSH.bits}-{LSH.tables}-{dim}", sf_dir, lambda path: ann.write_signatures(
        ann.signatures(tables.vectors(spark, sf_dir), LSH, dim), path))


@register("lsh_signatures", f"WITH {PTS_SQL}, {_sig_sql()} SELECT id, table_no, sig FROM sigs")
def lsh_signatures(spark, sf_dir):
    """ANN-1 build: 4 tables x 8-bit random-hyperplane signatures of every vector, where it is read."""
    return ann.signatures(tables.vectors(spark, sf_dir), LSH, len(query_vector(spark, sf_dir)))


def _ann_sql(where: str = "TRUE") -> str:
    return f"""
WITH {PTS_SQL}, {QV_SQL}, {_sig_sql()},
el AS (SELECT p.id, ham.h FROM pts p JOIN ham USING (id) WHERE {where}),
rad AS (SELECT min(r)::INTEGER AS radius FROM range({LSH.radius}, {LSH.bits} + 1) t(r)
        WHERE r = {LSH.bits} OR (SELECT count(*) FROM el WHERE el.h <= r) >= {K}),
s AS (SELECT p.id, {sql_score("p.vector", "qv.q")} AS score, p.lang, p.source, p.n_chars, rad.radius
      FROM pts p JOIN el USING (id), qv, rad WHERE el.h <= rad.radius)
SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, score, lang, source, n_chars, radius
FROM s WHERE score IS NOT NULL ORDER BY score DESC, id LIMIT {K}"""


def _ann(spark, sf_dir, where=None):
    q = query_vector(spark, sf_dir)
    return ann.ann_search_split(tables.vectors(spark, sf_dir), tables.payload(spark, sf_dir),
                                lsh_sigs(spark, sf_dir, len(q)), q, LSH, k=K, where=where, keep=tables.PAYLOAD_COLS)


@register("ann_search", _ann_sql())
def ann_search(spark, sf_dir):
    """ANN-1 search: signatures near the query's, radius widened to k candidates, exact re-rank."""
    return _ann(spark, sf_dir)


def _filter():
    return flt.must(flt.match_value("lang", FILTER_LANG), flt.range_("n_chars", gte=FILTER_MIN_CHARS))


@register("ann_filtered", _ann_sql(FILTERED_WHERE))
def ann_filtered(spark, sf_dir):
    """ANN-2: the payload filter restricts the candidates before the exact re-rank."""
    return _ann(spark, sf_dir, _filter())


@register("ann_switch", f"""
WITH {PTS_SQL}, {QV_SQL},
s AS (SELECT p.id, {sql_score("p.vector", "qv.q")} AS score, p.lang, p.source, p.n_chars
      FROM pts p, qv WHERE {FILTERED_WHERE})
SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, score, lang, source, n_chars
FROM s WHERE score IS NOT NULL ORDER BY score DESC, id LIMIT {K}""")
def ann_switch(spark, sf_dir):
    """ANN-3: the caller's mode decides; here the exact answer (``ann_filtered`` is the other mode)."""
    q = query_vector(spark, sf_dir)
    return ann.search_by_mode(tables.vectors(spark, sf_dir), tables.payload(spark, sf_dir), None, q, LSH,
                              mode="exact", k=K, where=_filter(), keep=tables.PAYLOAD_COLS)


@register("ann_recall", f"""
WITH {PTS_SQL}, {QV_SQL}, {_sig_sql()},
s AS (SELECT p.id, {sql_score("p.vector", "qv.q")} AS score, ham.h FROM pts p JOIN ham USING (id), qv),
r AS (SELECT id, score, unnest(range(h::INTEGER, {LSH.bits} + 1)) AS radius FROM s),
t AS (SELECT radius, id FROM (SELECT radius, id, score,
        row_number() OVER (PARTITION BY radius ORDER BY score DESC, id) AS rn FROM r)
      WHERE rn <= {K} AND score IS NOT NULL),
ex AS (SELECT id FROM s WHERE score IS NOT NULL ORDER BY score DESC, id LIMIT {K}),
radii AS (SELECT range::INTEGER AS radius FROM range(0, {LSH.bits} + 1)),
f AS (SELECT t.radius, count(*) AS returned, count(ex.id) AS found FROM t LEFT JOIN ex USING (id) GROUP BY t.radius)
SELECT radii.radius, coalesce(f.returned, 0)::BIGINT AS returned,
       round(coalesce(f.found, 0) / {float(K)}, 6) AS recall
FROM radii LEFT JOIN f USING (radius)""")
def ann_recall(spark, sf_dir):
    """ANN-4: recall@10 of the LSH answer against exact search at every probe radius."""
    q = query_vector(spark, sf_dir)
    scored = search.score_split(tables.vectors(spark, sf_dir), tables.payload(spark, sf_dir), q)
    return ann.recall_by_radius(None, lsh_sigs(spark, sf_dir, len(q)), q, LSH, k=K, scored=scored)


# ---- timing summary ----------------------------------------------------------

@register("latency_by_variant", """
SELECT event_type AS variant, count(*) AS runs, round(avg(value), 6) AS mean_ms,
       min(value) AS min_ms, max(value) AS max_ms FROM events GROUP BY event_type""")
def latency_by_variant(spark, sf_dir):
    """AGG-1: runs, mean, min and max per variant of a timings table (events by event_type)."""
    ev = tables.read_table(spark, sf_dir, "events").select(F.col("event_type").alias("variant"),
                                                           F.col("value").alias("ms"))
    return summary.timing_summary(ev)


@register("latency_summary", """
WITH a AS (SELECT avg(value) FILTER (WHERE event_type = 'view') AS b,
                  avg(value) FILTER (WHERE event_type = 'click') AS u,
                  avg(value) FILTER (WHERE event_type = 'error') AS i FROM events)
SELECT round(b, 6) AS baseline_ms, round(u, 6) AS unindexed_ms, round(i, 6) AS indexed_ms,
       round(CASE WHEN u > 0 AND i > 0 THEN u / i ELSE 0.0 END, 6) AS index_speedup,
       round(CASE WHEN u > 0 AND i > 0 THEN u - b ELSE 0.0 END, 6) AS overhead_unindexed_ms,
       round(CASE WHEN u > 0 AND i > 0 THEN i - b ELSE 0.0 END, 6) AS overhead_indexed_ms
FROM a""")
def latency_summary(spark, sf_dir):
    """AGG-2: variants pivoted into one row: index speed-up and filter overheads (0 unless both means > 0)."""
    ev = tables.read_table(spark, sf_dir, "events").select(F.col("event_type").alias("variant"),
                                                           F.col("value").alias("ms"))
    return summary.variant_summary(ev, baseline="view", unindexed="click", indexed="error")
