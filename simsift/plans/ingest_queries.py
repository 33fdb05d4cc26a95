"""Load-side queries: upsert, completeness, vector profile, exact count (SNK-1/5/7/9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from simsift.operators import ingest
from simsift.plans.registry import register, sql_norm
from simsift.plans.search_queries import NAMED_SPLIT
from simsift.sources import tables


@register("upsert_latest", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def upsert_latest(spark, sf_dir):
    """SNK-1: events keyed by user_id, seq = event_id; two batches merged into one table.

    Batch 1 holds the 'view' events, batch 2 everything else: together the whole
    table, so the result is the latest event per user.
    """
    ev = tables.read_table(spark, sf_dir, "events")
    is_view = F.col("event_type").eqNullSafe("view")
    first = ingest.upsert(None, ev.where(is_view), id_col="user_id", seq_col="event_id", check="lazy")
    return ingest.upsert(first, ev.where(~is_view), id_col="user_id", seq_col="event_id", check="lazy")


@register("load_missing", """
SELECT d.doc_id AS id, d.lang, d.source, d.n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM embeddings e WHERE e.vec_id = d.doc_id)""")
def load_missing(spark, sf_dir):
    """SNK-5: documents not yet present in the point table (anti-join on id)."""
    docs = tables.read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), *tables.PAYLOAD_COLS)
    existing = tables.read_table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"))
    return ingest.load_missing(docs, existing)


def _profile_arm(name: str, expr: str) -> str:
    n = sql_norm("v")
    return f"""SELECT '{name}' AS vector, count(*) AS rows, count(*) FILTER (WHERE v IS NULL) AS nulls,
  min(len(v))::INTEGER AS min_dim, max(len(v))::INTEGER AS max_dim,
  count(*) FILTER (WHERE {n} = 0) AS zero_norm, round(min({n}), 6) AS min_norm, round(max({n}), 6) AS max_norm
FROM (SELECT {expr} AS v FROM embeddings)"""


@register("vector_profile", " UNION ALL ".join([
    _profile_arm("embedding", "embedding"),
    _profile_arm("vec_head", f"embedding[1:{NAMED_SPLIT}]"),
    _profile_arm("vec_tail", f"embedding[{NAMED_SPLIT + 1}:{2 * NAMED_SPLIT}]")]))
def vector_profile(spark, sf_dir):
    """SNK-9 + FLT-7: size/null/norm profile of every named vector."""
    emb = tables.read_table(spark, sf_dir, "embeddings")
    named = emb.select("embedding", F.slice("embedding", 1, NAMED_SPLIT).alias("vec_head"),
                       F.slice("embedding", NAMED_SPLIT + 1, NAMED_SPLIT).alias("vec_tail"))
    return ingest.vector_profile(named, ["embedding", "vec_head", "vec_tail"])


@register("table_count", "SELECT count(*) AS n_points FROM embeddings")
def table_count(spark, sf_dir):
    """SNK-7: exact row count of the point table (one row per vector, payload or not)."""
    return tables.vectors(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_points"))
