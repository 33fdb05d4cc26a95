"""Chunking queries (CHK-1..7, SET-1) over ``documents`` and the derived records."""

from __future__ import annotations

from pyspark.sql import functions as F

from simsift.functions import text as tx
from simsift.operators import chunking as ch
from simsift.plans.feature_queries import FIXED_SQL, _uuid5_sql, sql_tokens
from simsift.plans.registry import register
from simsift.sources import records as rec
from simsift.sources import tables

EMBED_DIM = 256
PCT = ch.SEMANTIC_PERCENTILE

# ---- DuckDB mirrors ----------------------------------------------------------

SQL_SENTS = ("list_filter(string_split(regexp_replace({t}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), "
             "lambda s: len(" + sql_tokens("s") + ") > 0)")


def sql_sents(t: str) -> str:
    return SQL_SENTS.format(t=t)


def sql_units(t: str, size: str) -> str:
    return (f"flatten(list_transform({sql_sents(t)}, lambda s: list_transform(range(0, len({sql_tokens('s')}), "
            f"{size}), lambda st: {sql_tokens('s')}[st + 1:st + {size}])))")


def sql_sentence_chunks(src: str, key: str, text: str, size: str, overlap: int = ch.SENTENCE_OVERLAP) -> str:
    """SELECT returning (key, chunk_index, chunk) for the packing fold (CTE body)."""
    lim = f"least({overlap}, {size} - c[i + 1])"
    back = f"""list_reduce(CASE WHEN i - 1 >= acc.start + 1 THEN range(i - 1, acc.start, -1) ELSE []::BIGINT[] END,
        lambda st, j: {{'r': st.r + c[j + 1],
                       'best': CASE WHEN st.r + c[j + 1] <= {lim} THEN j ELSE st.best END,
                       'rb': CASE WHEN st.r + c[j + 1] <= {lim} THEN st.r + c[j + 1] ELSE st.rb END}},
        {{'r': 0::BIGINT, 'best': i::BIGINT, 'rb': 0::BIGINT}})"""
    fold = f"""list_reduce(range(len(u)), lambda acc, i:
        CASE WHEN acc.total + c[i + 1] <= {size} THEN {{'start': acc.start, 'total': acc.total + c[i + 1], 'bounds': acc.bounds}}
        ELSE {{'start': ({back}).best, 'total': ({back}).rb + c[i + 1],
               'bounds': list_append(acc.bounds, {{'s': acc.start, 'e': i}})}} END,
        {{'start': 0::BIGINT, 'total': 0::BIGINT, 'bounds': []::STRUCT(s BIGINT, e BIGINT)[]}})"""
    return f"""SELECT {key}, (pos - 1)::INTEGER AS chunk_index,
       array_to_string(flatten(u[bd.s + 1:bd.e]), ' ') AS chunk
FROM (SELECT {key}, u, unnest(bounds) AS bd, unnest(range(1, len(bounds) + 1)) AS pos FROM (
  SELECT {key}, u, CASE WHEN fs IS NULL THEN []::STRUCT(s BIGINT, e BIGINT)[]
                        ELSE list_append(fs.bounds, {{'s': fs.start, 'e': len(u)::BIGINT}}) END AS bounds
  FROM (SELECT {key}, u, CASE WHEN len(u) = 0 THEN NULL ELSE {fold} END AS fs
        FROM (SELECT {key}, {size}, u, list_transform(u, lambda x: len(x)::BIGINT) AS c
              FROM (SELECT {key}, {size}, {sql_units(text, size)} AS u FROM {src})))))"""


def sql_semantic_chunks(src: str, key: str, text: str, dim: int = EMBED_DIM, pct: float = PCT) -> str:
    """CTE list ending in ``sem(key, chunk_index, chunk)``."""
    return f"""
sem_st AS (SELECT {key}, list_transform({sql_sents(text)}, lambda s: {sql_tokens('s')}) AS sts FROM {src}),
sem_sent AS (SELECT {key}, len(sts) AS m, unnest(range(len(sts))) AS si, unnest(sts) AS toks FROM sem_st),
sem_h AS (SELECT {key}, si, m, ('0x' || substr(md5(lower(tok)), 1, 8))::BIGINT AS h
          FROM (SELECT {key}, si, m, unnest(toks) AS tok FROM sem_sent)),
sem_terms AS (SELECT {key}, si, m, (h % {dim})::INTEGER AS bucket, sum(1 - 2 * ((h // {dim}) % 2)) AS value
              FROM sem_h GROUP BY ALL HAVING sum(1 - 2 * ((h // {dim}) % 2)) <> 0),
sem_win AS (SELECT {key}, w, bucket, sum(value)::DOUBLE AS v FROM (
              SELECT {key}, m, bucket, value, unnest([si - 1, si, si + 1]) AS w FROM sem_terms)
            WHERE w >= 0 AND w < m GROUP BY ALL),
sem_norms AS (SELECT {key}, w, sqrt(sum(v * v)) AS nrm FROM sem_win GROUP BY ALL),
sem_dots AS (SELECT a.{key}, a.w, sum(a.v * b.v) AS dot FROM sem_win a JOIN sem_win b
             ON a.{key} = b.{key} AND a.bucket = b.bucket AND b.w = a.w + 1 GROUP BY ALL),
sem_pairs AS (SELECT na.{key}, na.w, na.nrm * nb.nrm AS den FROM sem_norms na JOIN sem_norms nb
              ON na.{key} = nb.{key} AND nb.w = na.w + 1),
sem_dist AS (SELECT p.{key}, p.w, round(1.0 - CASE WHEN den = 0 THEN NULL ELSE coalesce(dot, 0.0) / den END, 6) AS d
             FROM sem_pairs p LEFT JOIN sem_dots USING ({key}, w)),
sem_thr AS (SELECT {key}, round(quantile_cont(d, {pct}), 6) AS thr FROM sem_dist GROUP BY ALL),
sem_brk AS (SELECT {key}, w, coalesce(d > thr, false)::INTEGER AS brk FROM sem_dist JOIN sem_thr USING ({key})),
sem_cum AS (SELECT {key}, w + 1 AS si, sum(brk) OVER (PARTITION BY {key} ORDER BY w
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM sem_brk),
sem_lab AS (SELECT s.{key}, s.si, s.toks, coalesce(c.cum, 0) AS chunk_index
            FROM sem_sent s LEFT JOIN sem_cum c USING ({key}, si)),
sem AS (SELECT {key}, chunk_index::INTEGER AS chunk_index,
               array_to_string(flatten(list(toks ORDER BY si)), ' ') AS chunk FROM sem_lab GROUP BY ALL)"""


# ---- Queries -----------------------------------------------------------------

def _docs(spark, sf_dir):
    return tables.read_table(spark, sf_dir, "documents")


@register("token_report", f"""
SELECT doc_id, n AS n_tokens, greatest(n - {tx.MAX_TOKENS}, 0) AS excess, n > {tx.MAX_TOKENS} AS over_limit
FROM (SELECT doc_id, len({sql_tokens('text')})::INTEGER AS n FROM documents)""")
def token_report(spark, sf_dir):
    """CHK-1/2: tokens per document and the excess over the 256-token limit."""
    return ch.token_report(_docs(spark, sf_dir), "text", keep=("doc_id",))


@register("chunk_fixed", f"WITH {FIXED_SQL} SELECT doc_id, chunk_index, chunk FROM fx")
def chunk_fixed(spark, sf_dir):
    """CHK-3: 256-token windows of every document."""
    return ch.fixed_chunks(_docs(spark, sf_dir), "text", keep=("doc_id",))


@register("chunk_sentence", f"WITH d AS (SELECT doc_id, text, {tx.MAX_TOKENS} AS sz FROM documents) "
                            + sql_sentence_chunks("d", "doc_id", "text", "sz"))
def chunk_sentence(spark, sf_dir):
    """CHK-4: sentence packing, 256 tokens, 40-token overlap, every document."""
    return ch.sentence_chunks(_docs(spark, sf_dir), "text", keep=("doc_id",))


@register("chunk_semantic", "WITH " + sql_semantic_chunks("documents", "doc_id", "text").strip()
                            + " SELECT doc_id, chunk_index, chunk FROM sem")
def chunk_semantic(spark, sf_dir):
    """CHK-5: semantic breaks at the per-document 95th percentile of neighbour distance."""
    return ch.semantic_chunks(_docs(spark, sf_dir), "text", key="doc_id", percentile=PCT, dim=EMBED_DIM)


def chunk_union_df(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    # fixed and sentence chunks come out of one narrow pass over the documents
    narrow = ch.tagged_chunks(docs, {ch.FIXED: ch.fixed_chunk_array("text"),
                                     ch.SENTENCE: ch.sentence_chunk_array("text")}, keep=("doc_id",))
    sem = (ch.semantic_chunks(docs, "text", key="doc_id", percentile=PCT, dim=EMBED_DIM)
             .withColumn("chunking", F.lit(ch.SEMANTIC)))
    u = narrow.unionByName(sem)
    return u.select("doc_id", "chunking", "chunk_index",
                    tx.point_id(F.col("doc_id"), F.col("chunking"), F.col("chunk_index")).alias("point_id"),
                    "chunk", tx.n_tokens("chunk").alias("n_tokens"))


def _union_sql() -> str:
    key = "doc_id::VARCHAR || '|' || chunking || '|' || chunk_index::VARCHAR"
    return f"""WITH {FIXED_SQL}, sen AS ({sql_sentence_chunks(
        "(SELECT doc_id, text, 256 AS sz FROM documents)", "doc_id", "text", "sz")}),
{sql_semantic_chunks("documents", "doc_id", "text").strip()},
u AS (SELECT doc_id, 'fixed' AS chunking, chunk_index, chunk FROM fx
      UNION ALL SELECT doc_id, 'sentence', chunk_index, chunk FROM sen
      UNION ALL SELECT doc_id, 'semantic', chunk_index, chunk FROM sem)
SELECT doc_id, chunking, chunk_index, {_uuid5_sql(key)} AS point_id, chunk,
       len({sql_tokens('chunk')})::INTEGER AS n_tokens FROM u"""


@register("chunk_union", _union_sql())
def chunk_union(spark, sf_dir):
    """CHK-6 + SET-1 + PRJ-4/8: all three strategies, tagged, with stable point ids."""
    return chunk_union_df(spark, sf_dir)


def chunk_budgeted_df(spark, sf_dir):
    r = (rec.records(spark, sf_dir)
            .withColumn("menu_text", tx.menu_highlights("menu_items"))
            .withColumn("budget", tx.chunk_budget("menu_text")))
    keep = ("id", "menu_text")
    # fixed and sentence chunks (menu-adjusted budget) in one pass over the records
    narrow = ch.tagged_chunks(r, {ch.FIXED: ch.fixed_chunk_array("description", F.col("budget")),
                                  ch.SENTENCE: ch.sentence_chunk_array("description", F.col("budget"))}, keep=keep)
    sem = (ch.semantic_chunks(r, "description", key="id", percentile=PCT, dim=EMBED_DIM, keep=("menu_text",))
             .withColumn("chunking", F.lit(ch.SEMANTIC)))
    u = narrow.unionByName(sem)
    return u.select("id", "chunking", "chunk_index",
                    tx.point_id(F.col("id"), F.col("chunking"), F.col("chunk_index")).alias("point_id"),
                    tx.prepend_menu("chunk", "menu_text").alias("chunk"))


def budgeted_sql() -> str:
    menu = ("CASE WHEN len(coalesce(menu_items, []::VARCHAR[])) > 0 THEN "
            f"'{tx.MENU_PREFIX}' || array_to_string(menu_items, '{tx.MENU_SEP}') || '{tx.MENU_END}' ELSE '' END")
    key = "id::VARCHAR || '|' || chunking || '|' || chunk_index::VARCHAR"
    fixed = f"""SELECT id, (s // budget)::INTEGER AS chunk_index, array_to_string(toks[s + 1:s + budget], ' ') AS chunk
  FROM (SELECT id, budget, toks, unnest(range(0, len(toks), budget)) AS s
        FROM (SELECT id, budget, {sql_tokens('description')} AS toks FROM rb))"""
    return f"""WITH r AS (
  SELECT d.doc_id AS id, d.text AS description,
         CASE WHEN p.p_partkey IS NULL THEN NULL
              ELSE list_filter([p.p_name, p.p_type], lambda x: x IS NOT NULL) END AS menu_items
  FROM documents d LEFT JOIN part p ON p.p_partkey = d.doc_id),
rm AS (SELECT id, description, {menu} AS menu_text FROM r),
rb AS (SELECT id, description, menu_text,
              greatest({tx.MAX_TOKENS} - len({sql_tokens('menu_text')}), 1)::BIGINT AS budget FROM rm),
bf AS ({fixed}),
bs AS ({sql_sentence_chunks("rb", "id", "description", "budget")}),
{sql_semantic_chunks("rb", "id", "description").strip()},
u AS (SELECT id, 'fixed' AS chunking, chunk_index, chunk FROM bf
      UNION ALL SELECT id, 'sentence', chunk_index, chunk FROM bs
      UNION ALL SELECT id, 'semantic', chunk_index, chunk FROM sem)
SELECT u.id, u.chunking, u.chunk_index, {_uuid5_sql(key)} AS point_id,
       CASE WHEN rb.menu_text = '' THEN u.chunk ELSE rb.menu_text || chr(10) || chr(10) || u.chunk END AS chunk
FROM u JOIN rb USING (id)"""


@register("chunk_budgeted", budgeted_sql())
def chunk_budgeted(spark, sf_dir):
    """CHK-7: records chunked with the menu-adjusted budget; every chunk carries the menu."""
    return chunk_budgeted_df(spark, sf_dir)
