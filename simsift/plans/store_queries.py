"""Table builds through the catalog store (SNK-2/3/4/6), inline records (SRC-3) and parameter checks (FLT-6)."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsift.functions.vectors import COSINE, DOT
from simsift.operators import ann, chunking
from simsift.operators.knn_join import knn_join
from simsift.plans.registry import register, sql_score
from simsift.plans.search_queries import K
from simsift.session import checkpoint_dir
from simsift.sources import store, tables
from simsift.streaming import keyed_upsert

PAYLOAD = T.StructType([T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                        T.StructField("n_chars", T.LongType())])


@contextmanager
def _table(spark):
    """A new table name and root; the catalog entry goes afterwards, the files stay for the result."""
    name = f"simsift_{uuid.uuid4().hex[:12]}"
    try:
        yield name, f"{checkpoint_dir(spark).rstrip('/')}/simsift-store"
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _points(spark, sf_dir):
    return tables.vectors(spark, sf_dir).join(tables.payload(spark, sf_dir), "id", "left")


def _dim(spark, sf_dir) -> int:
    return tables.vectors(spark, sf_dir).agg(F.max(F.size("vector"))).first()[0]


@register("bulk_load", """
SELECT e.vec_id AS id, e.embedding AS vector, d.lang, d.source, d.n_chars
FROM embeddings e LEFT JOIN documents d ON e.vec_id = d.doc_id""")
def bulk_load(spark, sf_dir):
    """SNK-2/5: points in files of at most 10,000 rows; a first load of the points with payload, then a resumed one of all."""
    pts = _points(spark, sf_dir)
    with _table(spark) as (name, root):
        store.get_or_create_table(spark, name, root, vectors=store.VectorParams(_dim(spark, sf_dir), COSINE), payload=PAYLOAD)
        store.load_missing_into(spark, name, pts.where("lang IS NOT NULL"))
        loaded = store.load_missing_into(spark, name, pts)
        return spark.read.parquet(loaded["location"]).drop("seq")


@register("chunk_table_load", """
SELECT 'fixed' AS chunking, count(*) AS chunks, count(*) AS loaded FROM (
  SELECT unnest(range(0, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')), 256)) FROM documents)""")
def chunk_table_load(spark, sf_dir):
    """SNK-3: the fixed chunks of every document written as a table version; the write itself counts its rows."""
    from simsift.functions.text import point_id

    docs = tables.read_table(spark, sf_dir, "documents")
    fixed = chunking.fixed_chunks(docs, "text", keep=("doc_id",))
    rows = fixed.select(point_id(F.col("doc_id"), F.lit(chunking.FIXED), F.col("chunk_index")).alias("id"), "doc_id",
                        F.col("chunk_index").cast("long").alias("chunk_index"), "chunk")
    payload = T.StructType([f for f in rows.schema.fields if f.name != "id"])
    with _table(spark) as (name, root):
        store.get_or_create_table(spark, name, root, vectors=store.VectorParams(4, COSINE), id_type="string", payload=payload)
        done = store.commit(spark, name, rows)
        return spark.read.parquet(done["location"]).agg(F.count(F.lit(1)).alias("chunks")).select(
            F.lit(chunking.FIXED).alias("chunking"), "chunks", F.lit(done["rows"]).cast("long").alias("loaded"))


@register("table_config", """
WITH d AS (SELECT max(len(embedding))::INTEGER AS dim, count(*) AS n FROM embeddings)
SELECT 'full' AS vector, dim AS size, 'cosine' AS metric, TRUE AS first_created, FALSE AS second_created, n AS points FROM d
UNION ALL SELECT 'head', dim // 2, 'dot', TRUE, FALSE, n FROM d""")
def table_config(spark, sf_dir):
    """SNK-4/9: a table of two named vectors is created once, found again after its load, and its config read back."""
    dim = _dim(spark, sf_dir)
    given = {"full": store.VectorParams(dim, COSINE), "head": store.VectorParams(dim // 2, DOT)}
    pts = tables.vectors(spark, sf_dir).select("id", F.col("vector").alias("vec_full"), F.slice("vector", 1, dim // 2).alias("vec_head"))
    with _table(spark) as (name, root):
        first = store.get_or_create_table(spark, name, root, vectors=given)
        n = store.commit(spark, name, pts)["rows"]
        second = store.get_or_create_table(spark, name, root, vectors=given)
        told = store.describe(spark, name).vectors
    return spark.createDataFrame(
        [(v, p.size, p.metric, first.created, second.created, n) for v, p in told.items()],
        "vector string, size int, metric string, first_created boolean, second_created boolean, points long")


@register("rebuild_changed", """
SELECT 1 AS step, '16' AS m, count(*) AS kept, count(*) AS points FROM embeddings
UNION ALL SELECT 2, '16', count(*), count(*) FROM embeddings
UNION ALL SELECT 3, '32', 0, count(*) FROM embeddings""")
def rebuild_changed(spark, sf_dir):
    """SNK-6: the same build parameter keeps the loaded rows, another one rebuilds the table, and the load fills it again."""
    pts, rows = tables.vectors(spark, sf_dir), []
    size = store.VectorParams(_dim(spark, sf_dir), COSINE)
    with _table(spark) as (name, root):
        for step, m in enumerate((16, 16, 32), 1):
            info = store.get_or_create_table(spark, name, root, vectors=size, build={"m": m}, rebuild_on_change=True)
            before = spark.table(name).count()
            store.load_missing_into(spark, name, pts)
            after = spark.table(name).count()
            rows.append((step, str(info.build["m"]), after if step == 1 else before, after))
    return spark.createDataFrame(rows, "step int, m string, kept long, points long")


@register("literal_query_points", f"""
WITH qs AS (SELECT q.qid::BIGINT AS qid, list_transform(range((SELECT max(len(embedding)) FROM embeddings)),
                   lambda i: CASE WHEN i % 3 = q.qid THEN 1.0::FLOAT ELSE 0.0::FLOAT END) AS v FROM range(0, 3) q(qid)),
s AS (SELECT qs.qid, e.vec_id AS id, {sql_score("e.embedding", "qs.v")} AS score FROM embeddings e, qs),
r AS (SELECT qid, row_number() OVER (PARTITION BY qid ORDER BY score DESC, id) AS rank, id, score FROM s WHERE score IS NOT NULL)
SELECT * FROM r WHERE rank <= {K}""")
def literal_query_points(spark, sf_dir):
    """SRC-3: three points written inline are searched for among all vectors."""
    dim = _dim(spark, sf_dir)
    rows = [(q, [1.0 if i % 3 == q else 0.0 for i in range(dim)]) for q in range(3)]
    asked = tables.literal_points(spark, rows, "qid long, vector array<float>")
    return knn_join(tables.vectors(spark, sf_dir), asked, k=K)


#: Parameter sets within and beyond the checked ranges: (bits, tables, radius).
ASKED = [(4, 1, 0), (8, 4, 1), (3, 4, 1), (33, 4, 1), (8, 0, 1), (8, 65, 1), (8, 4, 9), (16, 2, 16)]


@register("lsh_param_check", f"""
SELECT bits, tables, radius, ok AS accepted, CASE WHEN ok THEN tables * (SELECT count(*) FROM embeddings) ELSE 0 END::BIGINT AS signatures
FROM (SELECT *, bits BETWEEN 4 AND 32 AND tables BETWEEN 1 AND 64 AND radius BETWEEN 0 AND bits AS ok
      FROM (VALUES {", ".join(f"({b}::INTEGER, {t}::INTEGER, {r}::INTEGER)" for b, t, r in ASKED)}) v(bits, tables, radius))""")
def lsh_param_check(spark, sf_dir):
    """FLT-6: parameter sets out of range are refused before any job; the others sign every vector."""
    out, dim = None, _dim(spark, sf_dir)
    for bits, n_tables, radius in ASKED:
        try:
            params = ann.LshParams(bits, n_tables, radius)
        except ValueError:
            params = None
        pts = tables.vectors(spark, sf_dir) if params else tables.vectors(spark, sf_dir).where(F.lit(False))
        sigs = ann.signatures(pts, params or ann.LshParams(), dim)
        row = sigs.agg(F.count(F.lit(1)).alias("signatures")).select(
            F.lit(bits).alias("bits"), F.lit(n_tables).alias("tables"), F.lit(radius).alias("radius"),
            F.lit(params is not None).alias("accepted"), "signatures")
        out = row if out is None else out.unionByName(row)
    return out


@register("stream_upsert", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def stream_upsert(spark, sf_dir):
    """STR-1: all events streamed by user_id, the winning event_id of a user held in state."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/simsift-stream/{uuid.uuid4().hex}"
    schema = tables.SCHEMAS["events"]
    keyed_upsert.upsert_stream_stateful(spark, tables.table_path(sf_dir, "events"), schema, f"{base}/table",
                                        checkpoint=f"{base}/state", id_col="user_id", seq_col="event_id")
    return keyed_upsert.current(spark, f"{base}/table", schema, id_col="user_id", seq_col="event_id")
