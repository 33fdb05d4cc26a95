"""Exact similarity search over point tables (KNN-1..8, KNN-11).

Plan shape for one query (checked with ``explain``):

    Scan(pushed payload filters, pruned columns) -> Filter -> Project(score)
      -> TakeOrderedAndProject(k)            # per-partition top-k, k*P rows merged
      -> payload scan filtered by the ids of the k hits, broadcast to them

The score is added *after* the filter so Catalyst keeps the filter (and any
payload join) below the scoring projection. Wide payload (text) is joined back
after the top-k so it never travels through the scoring stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsift.functions.vectors import COSINE, score

# Fixed value: number of hits returned when no limit is given.
DEFAULT_LIMIT = 10
# At most this many hits (rank, id, score and narrow columns) are fetched and
# broadcast for the payload join; above this the join stays a shuffle join.
MAX_BROADCAST_K = 100_000
# Up to this many ids go to the payload scan as a pushed IN filter.
MAX_PUSHED_IDS = 1_000
# Filtered candidates are broadcast to the vector scan up to this size.
MAX_BROADCAST_BYTES = 64 << 20
# TakeOrderedAndProject merges k rows from every task in one task; above this k
# the ranking is done by range partitioning instead (exact, distributed).
MAX_SINGLE_MERGE_K = 100_000


def _order(score_col: str = "score", id_col: str = "id") -> list[Column]:
    return [F.col(score_col).desc(), F.col(id_col).asc()]


def with_rank(top: DataFrame, name: str = "rank", partition_by: Sequence[str] = ()) -> DataFrame:
    """PRJ-10: 1-based rank by (score desc, id asc).

    Without ``partition_by`` this is only applied to an already limited frame
    (at most k rows), so the single-partition window is bounded.
    """
    w = Window.partitionBy(*partition_by).orderBy(*_order()) if partition_by else Window.orderBy(*_order())
    return top.withColumn(name, F.row_number().over(w).cast("long"))


def join_payload(hits: DataFrame, payload: DataFrame | None, k: int, id_col: str = "id") -> DataFrame:
    """PRJ-9: attach payload columns to at most ``k`` hits.

    The hits are fetched (at most ``k`` narrow rows), so that the ranking runs
    once and the payload scan is filtered by a broadcast of their ids: the payload
    table itself is never shuffled or broadcast. Beyond ``MAX_BROADCAST_K`` hits
    the join is a shuffle join.
    """
    if payload is None:
        return hits
    extra = [c for c in payload.columns if c != id_col and c not in hits.columns]
    wanted = payload.select(id_col, *extra)
    if k <= MAX_BROADCAST_K:
        rows = hits.collect()
        hits = hits.sparkSession.createDataFrame(rows, hits.schema)
        if len(rows) <= MAX_PUSHED_IDS:
            wanted = wanted.where(F.col(id_col).isin([r[id_col] for r in rows]))     # reaches the scan
        else:
            wanted = wanted.join(F.broadcast(hits.select(id_col)), id_col, "left_semi")
        wanted = F.broadcast(wanted)
    return hits.join(wanted, on=id_col, how="left").select(*hits.columns, *extra)


def row_bytes(df: DataFrame) -> int:
    """Estimated size of one broadcast row, from the schema."""
    return 24 + sum(48 if isinstance(f.dataType, (T.StringType, T.ArrayType, T.StructType)) else 8 for f in df.schema)


def sized_broadcast(df: DataFrame) -> DataFrame | None:
    """``df`` with a broadcast hint when its counted rows fit ``MAX_BROADCAST_BYTES``, else None.

    The answer of the caller's plan is the same either way.
    """
    return F.broadcast(df) if df.count() * row_bytes(df) <= MAX_BROADCAST_BYTES else None


def arrow_scores(vectors: DataFrame, query: Sequence[float], *, vector: str = "vector", id_col: str = "id",
                 metric: str = COSINE, keep: Sequence[str] = ()) -> DataFrame:
    """``(id, score)`` for every vector, scored in Arrow batches with one numpy
    matrix-vector product per batch (for high-dimensional vectors, where the
    per-element JVM fold is the slow part). NULL for a zero norm or wrong size."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    from simsift.functions.vectors import SCORE_DIGITS

    q = np.asarray([float(x) for x in query], dtype=np.float64)
    qn = float(np.sqrt(q @ q))
    dim = len(q)

    keep = tuple(keep)

    def run(batches):
        for rb in batches:
            ids = rb.column(0)
            vec = rb.column(1)
            passthrough = [rb.column(2 + i) for i in range(len(keep))]
            lens = pc.fill_null(pc.list_value_length(vec), -1).to_numpy(zero_copy_only=False)
            good = lens == dim
            out = np.full(rb.num_rows, np.nan)
            if good.any():
                x = pc.list_flatten(pc.filter(vec, pa.array(good))).to_numpy(zero_copy_only=False)
                x = x.astype(np.float64).reshape(-1, dim)
                s = x @ q
                if metric == COSINE:
                    with np.errstate(divide="ignore", invalid="ignore"):
                        s = s / (np.sqrt((x * x).sum(axis=1)) * qn)
                out[good] = s
            out[~np.isfinite(out)] = np.nan
            yield pa.RecordBatch.from_arrays(
                [ids, *passthrough, pa.array(out, pa.float64(), mask=np.isnan(out))], names=["id", *keep, "raw"])

    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector), *keep)
    schema = T.StructType([src.schema["id"], *[src.schema[c] for c in keep], T.StructField("raw", T.DoubleType())])
    raw = src.mapInArrow(run, schema)
    return raw.select("id", *keep, F.round("raw", SCORE_DIGITS).alias("score"))


def score_split(vectors: DataFrame, payload: DataFrame, query, *, where: Column | None = None,
                keep: Sequence[str] = (), vector: str = "vector", id_col: str = "id",
                metric: str = COSINE, vector_keep: Sequence[str] = (), engine: str = "native") -> DataFrame:
    """Scores for vectors and payload kept in separate tables: ``(id, *keep, score)``.

    Every vector is scored; a vector without payload has NULL in ``keep``. With a
    filter only the points whose payload satisfies it remain. The filtered
    payload is counted (narrow columns, filters pushed to its scan) and either

    * broadcast to the vector scan, when it fits ``MAX_BROADCAST_BYTES``: only
      matching vectors are scored, without any shuffle; or
    * joined with the ``(id, score)`` of every vector, never with the vectors.
    """
    if engine == "arrow":
        if vector_keep or isinstance(query, Column):
            raise ValueError("engine='arrow' takes one literal query and no vector-side columns")
        scored = arrow_scores(vectors, query, vector=vector, id_col=id_col, metric=metric)
    elif engine != "native":
        raise ValueError("engine must be 'native' or 'arrow'")
    vec = vectors.select(F.col(id_col).alias("id"), *vector_keep, F.col(vector).alias("_v"))
    sc = score("_v", query, metric).alias("score")
    if engine == "native":
        scored = vec.select("id", *vector_keep, sc)
    keep = tuple(vector_keep) + tuple(keep)
    narrow = payload.select(F.col(id_col).alias("id"), *[c for c in keep if c not in vector_keep]) if where is None else \
        payload.where(where).select(F.col(id_col).alias("id"), *[c for c in keep if c not in vector_keep])
    if where is None:
        return (scored if narrow.columns == ["id"] else scored.join(narrow, "id", "left")).select("id", *keep, "score")
    small = sized_broadcast(narrow)
    if small is not None and engine == "native":
        return vec.join(small, "id").select("id", *keep, sc)
    return scored.join(narrow if small is None else small, "id").select("id", *keep, "score")


def top_k(scored: DataFrame, k: int = DEFAULT_LIMIT, *, keep: Sequence[str] = (),
          payload: DataFrame | None = None) -> DataFrame:
    """Top-k of an ``(id, *keep, score)`` frame: ``(rank, id, score, *keep, *payload)``."""
    if k <= 0:
        raise ValueError("k must be positive")
    if k > MAX_SINGLE_MERGE_K:
        return join_payload(_top_k_distributed(scored, k).select("rank", "id", "score", *keep), payload, k)
    top = scored.orderBy(*_order()).limit(k).where(F.col("score").isNotNull())
    return join_payload(with_rank(top).select("rank", "id", "score", *keep), payload, k)


def _top_k_distributed(scored: DataFrame, k: int) -> DataFrame:
    """Exact top-k for a large k: global rank from a range-partitioned sort
    (per-partition counts -> broadcast offsets, see ``ids.sequential_ids``); no
    single task ever holds more than its own range."""
    from simsift.operators.ids import sequential_ids

    s = scored.where(F.col("score").isNotNull()).withColumn("_neg", -F.col("score"))
    ranked = sequential_ids(s, ["_neg", "id"], name="rank", start=1)
    return ranked.where(F.col("rank") <= k).drop("_neg")


def knn(points: DataFrame, query: Sequence[float], *, vector: str = "vector", id_col: str = "id",
        metric: str = COSINE, k: int = DEFAULT_LIMIT, where: Column | None = None,
        keep: Sequence[str] = (), payload: DataFrame | None = None, engine: str = "native") -> DataFrame:
    """Top-k by similarity (KNN-1/2/3/4/5).

    ``where`` filters before ranking (KNN-4); ``vector`` picks a named vector
    column (KNN-5, NULL vectors never score); ``keep`` carries narrow payload
    columns through the ranking; ``payload`` (keyed by ``id``) is joined after.
    Returns ``(rank, id, score, *keep, *payload)`` with exactly min(k, matches) rows.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    df = points if where is None else points.where(where)
    if engine == "arrow":          # numpy matrix-vector product per Arrow batch (high dims)
        return top_k(arrow_scores(df, query, vector=vector, id_col=id_col, metric=metric, keep=keep), k,
                     keep=keep, payload=payload)
    if engine != "native":
        raise ValueError("engine must be 'native' or 'arrow'")
    scored = df.select(F.col(id_col).alias("id"), *keep, score(vector, query, metric).alias("score"))
    # NULL scores (zero norm, size mismatch) sort last, so dropping them *after*
    # the limit still leaves exactly min(k, matches) rows. Filtering before the
    # limit would let Catalyst infer the predicate into the scan side and score
    # every row twice, below the payload filter.
    return top_k(scored, k, keep=keep, payload=payload)


def grouped_top_k(scored: DataFrame, group_by: str, *, limit: int = DEFAULT_LIMIT,
                  group_size: int = 1) -> DataFrame:
    """KNN-7 over an ``(id, group_by, score)`` frame (see ``knn_grouped``)."""
    scored = scored.where(F.col(group_by).isNotNull()).select("id", F.col(group_by).alias("group_id"), "score")
    w = Window.partitionBy("group_id").orderBy(*_order())
    hits = (scored.withColumn("hit_rank", F.row_number().over(w).cast("long"))
                  .where((F.col("hit_rank") <= group_size) & F.col("score").isNotNull()))
    # one row per group with its cut hits, so the groups are ranked without a second pass over the scores
    groups = hits.groupBy("group_id").agg(F.sort_array(F.collect_list(F.struct("hit_rank", "id", "score"))).alias("hits"))
    best = top_k(groups.select("group_id", F.col("hits")[0]["id"].alias("id"), F.col("hits")[0]["score"].alias("score"),
                               "hits"), limit, keep=("group_id", "hits"))
    return best.select(F.col("rank").alias("group_rank"), "group_id", F.inline("hits")) \
        .select("group_rank", "group_id", "hit_rank", "id", "score")


def top_k_per(scored: DataFrame, part: str, k: int = DEFAULT_LIMIT) -> DataFrame:
    """Top-k per value of ``part`` (WindowGroupLimit): ``(part, rank, id, score)``."""
    w = Window.partitionBy(part).orderBy(*_order())
    return (scored.withColumn("rank", F.row_number().over(w).cast("long"))
                  .where((F.col("rank") <= k) & F.col("score").isNotNull())
                  .select(part, "rank", "id", "score"))


def knn_grouped(points: DataFrame, query: Sequence[float], *, group_by: str, vector: str = "vector",
                id_col: str = "id", metric: str = COSINE, limit: int = DEFAULT_LIMIT,
                group_size: int = 1, where: Column | None = None, engine: str = "native") -> DataFrame:
    """KNN-7 grouped top-k: best ``group_size`` hits per group, best ``limit`` groups.

    The per-group cut is a ``row_number <= n`` window that Spark plans as a
    partial + final ``WindowGroupLimit``: a hot group is cut to ``group_size``
    rows inside every map task before the shuffle, so a group holding a third
    of the table costs no more than any other. Groups are ranked by their best
    hit with a distributed top-``limit``; only ``limit`` group keys are broadcast.
    """
    df = (points if where is None else points.where(where)).where(F.col(group_by).isNotNull())
    if engine == "arrow":
        scored = arrow_scores(df, query, vector=vector, id_col=id_col, metric=metric, keep=(group_by,))
    else:
        scored = df.select(F.col(id_col).alias("id"), F.col(group_by), score(vector, query, metric).alias("score"))
    # NULL scores rank last inside a group; dropping them after the cut is exact.
    return grouped_top_k(scored, group_by, limit=limit, group_size=group_size)


def knn_by_strategy(long_points: DataFrame, queries: dict[str, Sequence[float]], *,
                    strategy: str = "strategy", vector: str = "vector", id_col: str = "id",
                    metric: str = COSINE, k: int = DEFAULT_LIMIT) -> DataFrame:
    """KNN-8: one query per strategy over a long ``(strategy, id, vector)`` table, one job.

    The query for each row is looked up from a literal map keyed by strategy;
    the per-strategy top-k is a ``WindowGroupLimit`` (partial before shuffle).
    """
    qmap = F.create_map(*[x for s, q in queries.items()
                          for x in (F.lit(s), F.array(*[F.lit(float(v)) for v in q]))])
    df = long_points.where(F.col(strategy).isin(list(queries)))
    scored = df.select(F.col(strategy).alias("strategy"), F.col(id_col).alias("id"),
                       score(vector, F.element_at(qmap, F.col(strategy)), metric).alias("score"))
    return top_k_per(scored, "strategy", k)


def strategy_queries(queries: dict[str, Sequence[float]], strategy: str = "strategy") -> Column:
    """The per-row query of a long ``(strategy, ...)`` table, from a literal map."""
    qmap = F.create_map(*[x for s, q in queries.items()
                          for x in (F.lit(s), F.array(*[F.lit(float(v)) for v in q]))])
    return F.element_at(qmap, F.col(strategy))


def search_and_inspect(points: DataFrame, query: Sequence[float], vector_name: str, *, k: int = 3,
                       where: Column | None = None, keep: Sequence[str] = (),
                       payload: DataFrame | None = None, id_col: str = "id",
                       formats: dict[str, str] | None = None, engine: str = "native") -> DataFrame:
    """KNN-6: search one named vector (``vec_<name>``) with an optional filter; ranked
    rows with payload, the score formatted to 4 places and any ``formats``
    (column -> printf pattern, e.g. ``{"rating": "%.1f"}``) as ``<col>_text``."""
    col = vector_name if vector_name in points.columns else f"vec_{vector_name}"
    # NULL vectors score NULL and are no hits; a filter on them would compute a derived vector twice
    hits = knn(points, query, vector=col, id_col=id_col, k=k, where=where, keep=keep, payload=payload,
               engine=engine)
    hits = hits.withColumn("score_text", F.format_string("%.4f", F.col("score")))
    for c, fmt in (formats or {}).items():
        hits = hits.withColumn(f"{c}_text", F.format_string(fmt, F.col(c)))
    return hits


def group_best(grouped: DataFrame) -> DataFrame:
    """PRJ-12 / TOP-2: per group its id and best score (the ``hit_rank = 1`` row)."""
    return grouped.where(F.col("hit_rank") == 1).select("group_rank", "group_id", F.col("score").alias("best_score"))


def results_as_json(hits: DataFrame, payload_cols: Sequence[str]) -> DataFrame:
    """SNK-8: ``(rank, json)`` with ``json = {"id", "score", "payload": {...}}`` per hit."""
    return hits.select("rank", F.to_json(F.struct(
        "id", "score", F.struct(*payload_cols).alias("payload")), {"ignoreNullFields": "false"}).alias("json"))


def write_results_json(hits: DataFrame, payload_cols: Sequence[str], path: str) -> None:
    """SNK-8: hits as JSON lines in rank order (part files in order; one file for a small ``k``)."""
    results_as_json(hits, payload_cols).orderBy("rank").select("json").write.mode("overwrite").text(path)
