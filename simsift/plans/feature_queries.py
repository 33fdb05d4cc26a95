"""Filters, derived features, stable ids and JSON results (FLT-4/5, PRJ-*, SNK-8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from simsift.functions import filters as flt
from simsift.functions import text as tx
from simsift.operators import chunking, search
from simsift.operators.ids import sequential_ids
from simsift.plans.registry import register, sql_score
from simsift.plans.search_queries import FILTERED_WHERE, FILTER_LANG, FILTER_MIN_CHARS, K, PTS_SQL, QV_SQL, \
    split_scores
from simsift.sources import records as rec
from simsift.sources import tables

# Fixed query parameters.
CONTAINS_TERM = "data"
MATCH_QUERY = "the of"

# DuckDB mirrors of the native text functions.
SQL_TOKENS = r"list_filter(regexp_split_to_array({t}, '\s+'), lambda x: x <> '')"
SQL_WORDS = r"list_filter(regexp_split_to_array(lower({t}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"


def sql_tokens(t: str) -> str:
    return SQL_TOKENS.format(t=t)


def sql_words(t: str) -> str:
    return SQL_WORDS.format(t=t)


def _filtered_sql(cond: str) -> str:
    return f"""
WITH {PTS_SQL}, {QV_SQL},
scored AS (SELECT p.id, {sql_score("p.vector", "qv.q")} AS score, p.lang, p.source, p.n_chars
           FROM pts p JOIN documents d ON d.doc_id = p.id, qv WHERE {cond})
SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, score, lang, source, n_chars
FROM scored WHERE score IS NOT NULL ORDER BY score DESC, id LIMIT {K}"""


@register("filter_text_contains", _filtered_sql(f"contains(d.text, '{CONTAINS_TERM}')"))
def filter_text_contains(spark, sf_dir):
    """FLT-4 + KNN-4: substring filter (no index), then cosine top-10."""
    return search.top_k(split_scores(spark, sf_dir, where=flt.text_contains("text", CONTAINS_TERM), payload_cols=("text",)), K,
                        payload=tables.payload(spark, sf_dir))


@register("filter_text_match", _filtered_sql(
    f"list_has_all({sql_words('d.text')}, {flt.query_words(MATCH_QUERY)!r})"))
def filter_text_match(spark, sf_dir):
    """FLT-5 + KNN-4: all query words present as word tokens, then cosine top-10."""
    return search.top_k(split_scores(spark, sf_dir, where=flt.text_match("text", MATCH_QUERY), payload_cols=("text",)), K,
                        payload=tables.payload(spark, sf_dir))


@register("text_features", f"""
SELECT doc_id, length(text)::INTEGER AS length,
       regexp_matches(text, '{tx.DIGIT_CLASS}') AS has_numbers,
       len({sql_tokens('text')})::INTEGER AS n_tokens
FROM documents""")
def text_features(spark, sf_dir):
    """PRJ-1/2 + CHK-1: derived payload of every document."""
    docs = tables.read_table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.text_length("text").alias("length"),
                       tx.has_numbers("text").alias("has_numbers"), tx.n_tokens("text").alias("n_tokens"))


def _menu_sql() -> str:
    menu = ("CASE WHEN len(coalesce(menu_items, []::VARCHAR[])) > 0 THEN "
            f"'{tx.MENU_PREFIX}' || array_to_string(menu_items, '{tx.MENU_SEP}') || '{tx.MENU_END}' ELSE '' END")
    return f"""
WITH r AS (
  SELECT d.doc_id AS id, d.text AS description,
         CASE WHEN p.p_partkey IS NULL THEN NULL
              ELSE list_filter([p.p_name, p.p_type], lambda x: x IS NOT NULL) END AS menu_items
  FROM documents d LEFT JOIN part p ON p.p_partkey = d.doc_id),
m AS (SELECT id, description, {menu} AS menu_text FROM r)
SELECT id, menu_text,
       len({sql_tokens('menu_text')})::INTEGER AS menu_tokens,
       greatest({tx.MAX_TOKENS} - len({sql_tokens('menu_text')}), 1)::INTEGER AS budget,
       len({sql_tokens('menu_text')}) >= {tx.MAX_TOKENS} AS over_budget,
       len({sql_tokens("CASE WHEN menu_text = '' THEN description ELSE menu_text || chr(10) || chr(10) || description END")})::INTEGER AS full_tokens
FROM m"""


@register("menu_prefix", _menu_sql())
def menu_prefix(spark, sf_dir):
    """PRJ-5/6/7 + CHK-2: menu text, its token cost, the chunk budget, full-text tokens."""
    r = rec.records(spark, sf_dir).withColumn("menu_text", tx.menu_highlights("menu_items"))
    menu_tokens = tx.n_tokens("menu_text")
    return r.select("id", "menu_text", menu_tokens.alias("menu_tokens"),
                    tx.chunk_budget("menu_text").alias("budget"),
                    (menu_tokens >= F.lit(tx.MAX_TOKENS)).alias("over_budget"),
                    tx.n_tokens(tx.prepend_menu("description", "menu_text")).alias("full_tokens"))


FIXED_SQL = f"""fx AS (
  SELECT doc_id, (s // {tx.MAX_TOKENS})::INTEGER AS chunk_index,
         array_to_string(toks[s + 1:s + {tx.MAX_TOKENS}], ' ') AS chunk
  FROM (SELECT doc_id, toks, unnest(range(0, len(toks), {tx.MAX_TOKENS})) AS s
        FROM (SELECT doc_id, {sql_tokens('text')} AS toks FROM documents)))"""


def _uuid5_sql(key: str) -> str:
    h = f"sha1(unhex('{tx.POINT_ID_NAMESPACE.hex}') || ({key})::BLOB)"
    return f"""(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
        lower(printf('%x', ((('0x' || substr(h, 17, 1))::INTEGER & 3) | 8))) || substr(h, 18, 3) || '-' ||
        substr(h, 21, 12) FROM (SELECT {h} AS h))"""


@register("point_uuid5", f"""
WITH {FIXED_SQL}
SELECT doc_id, chunk_index, {_uuid5_sql("doc_id::VARCHAR || '|fixed|' || chunk_index::VARCHAR")} AS point_id
FROM fx""")
def point_uuid5(spark, sf_dir):
    """PRJ-4: deterministic UUIDv5 point id for every fixed chunk."""
    docs = tables.read_table(spark, sf_dir, "documents")
    fx = chunking.fixed_chunks(docs, "text", keep=("doc_id",))
    return fx.select("doc_id", "chunk_index",
                     tx.point_id(F.col("doc_id"), F.lit(chunking.FIXED), F.col("chunk_index")).alias("point_id"))


@register("row_ids", f"""
WITH {FIXED_SQL}
SELECT doc_id, chunk_index, row_number() OVER (ORDER BY doc_id, chunk_index) - 1 AS row_id FROM fx""")
def row_ids(spark, sf_dir):
    """PRJ-3: sequential ids over all fixed chunks in (doc_id, chunk_index) order."""
    docs = tables.read_table(spark, sf_dir, "documents")
    fx = chunking.fixed_chunks(docs, "text", keep=("doc_id",)).select("doc_id", "chunk_index")
    return sequential_ids(fx, ["doc_id", "chunk_index"]).select("doc_id", "chunk_index", "row_id")


@register("results_json", f"""
WITH {PTS_SQL}, {QV_SQL},
scored AS (SELECT p.id, {sql_score("p.vector", "qv.q")} AS score, p.lang, p.source, p.n_chars
           FROM pts p, qv WHERE {FILTERED_WHERE}),
t AS (SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, * FROM scored WHERE score IS NOT NULL
      ORDER BY score DESC, id LIMIT {K})
SELECT rank, to_json({{'id': id, 'score': score,
        'payload': {{'lang': lang, 'source': source, 'n_chars': n_chars}}}})::VARCHAR AS json FROM t""")
def results_json(spark, sf_dir):
    """SNK-8: filtered hits as JSON objects ``{id, score, payload}``."""
    cond = flt.must(flt.match_value("lang", FILTER_LANG), flt.range_("n_chars", gte=FILTER_MIN_CHARS))
    hits = search.top_k(split_scores(spark, sf_dir, where=cond), K, payload=tables.payload(spark, sf_dir))
    return search.results_as_json(hits, tables.PAYLOAD_COLS)
