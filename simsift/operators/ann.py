"""Approximate search with random-hyperplane LSH (ANN-1..4).

Re-aim of a graph index as the published sign-random-projection scheme:
``tables`` independent signatures of ``bits`` hyperplanes each. Build knob:
bits and tables; search knob: the probe radius (Hamming distance) around the
query's signature.

* planes: element i of plane p is +1 when the low bit of the first byte of
  ``md5("p|i")`` is 0, else -1 — deterministic, so every engine derives the
  same planes; the planes are a bounded literal (tables x bits x dim).
* signatures ``(table_no, sig, id)``: one narrow pass; written sorted by
  ``(table_no, sig)`` so Parquet statistics skip files at probe time.
* search: the radius widens until k (filtered) candidates exist; the probe set (all signatures within the radius, at most
  tables x sum C(bits, r) rows, enumerated on the driver from the parameters)
  is broadcast and equi-joined with the signatures; candidate ids are
  de-duplicated, semi-joined to the (filtered) points and re-ranked exactly.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simsift.functions.vectors import COSINE, score
from simsift.operators import search

# Fixed parameter ranges (checked before any job starts).
MIN_BITS, MAX_BITS, DEFAULT_BITS = 4, 32, 8
MAX_TABLES = 64
# Probe sets up to this many (table, sig) rows are enumerated and broadcast;
# beyond it candidates are found by a Hamming-distance filter on the signatures.
MAX_PROBES = 100_000


@dataclass(frozen=True)
class LshParams:
    bits: int = DEFAULT_BITS
    tables: int = 4
    radius: int = 1

    def __post_init__(self):
        if not (MIN_BITS <= self.bits <= MAX_BITS):
            raise ValueError(f"bits={self.bits} out of range; must be between {MIN_BITS} and {MAX_BITS}")
        if not (1 <= self.tables <= MAX_TABLES):
            raise ValueError(f"tables={self.tables} out of range 1..{MAX_TABLES}")
        if not (0 <= self.radius <= self.bits):
            raise ValueError(f"radius={self.radius} out of range 0..{self.bits}")


def plane_sign(p: int, i: int) -> float:
    return -1.0 if hashlib.md5(f"{p}|{i}".encode()).digest()[0] & 1 else 1.0


def planes(params: LshParams, dim: int) -> list[list[list[float]]]:
    """planes[t][b] = the dim-long +-1 hyperplane for bit b of table t."""
    return [[[plane_sign(t * params.bits + b, i) for i in range(dim)] for b in range(params.bits)]
            for t in range(params.tables)]


def _fold_dot(v, plane) -> float:
    s = 0.0
    for x, y in zip(v, plane):
        s += float(x) * y
    return s


def query_signatures(q, params: LshParams) -> list[int]:
    """Signature of a query vector per table (same fold order as the Spark expression)."""
    pl = planes(params, len(q))
    return [sum(1 << b for b in range(params.bits) if _fold_dot(q, pl[t][b]) >= 0.0)
            for t in range(params.tables)]


def _planes_sql(params: LshParams, dim: int) -> str:
    """All hyperplanes as one nested array literal (one expression, not thousands of calls)."""
    pl = planes(params, dim)
    rows = ["array(" + ", ".join("1.0D" if x > 0 else "-1.0D" for x in plane) + ")"
            for t in range(params.tables) for plane in pl[t]]
    return "array(" + ", ".join(rows) + ")"


def _sig_sql(vector: str, params: LshParams, dim: int, table: int) -> str:
    """Signature of one table: bit b set when dot(vector, plane[table*bits + b]) >= 0.

    The dot product is the same left fold in index order as ``functions.vectors.dot``.
    """
    b0 = table * params.bits
    dot = (f"aggregate(zip_with(`{vector}`, element_at(_planes, {b0} + b + 1), (x, y) -> CAST(x AS DOUBLE) * y), "
           f"0.0D, (a, z) -> a + z)")
    return (f"aggregate(sequence(0, {params.bits - 1}), 0L, "
            f"(acc, b) -> acc + IF({dot} >= 0.0D, shiftleft(1L, b), 0L))")


def signatures(points: DataFrame, params: LshParams, dim: int, *, vector: str = "vector",
               id_col: str = "id", engine: str = "native") -> DataFrame:
    """ANN-1 build: ``(id, table_no, sig)`` for every point with a vector of ``dim`` values.

    ``engine="arrow"`` computes all ``tables x bits`` projections of a batch with
    one matrix product (for high dimensions); a projection that lands exactly on
    a plane (|dot| ~ 1e-12) may get the other bit than the JVM fold.
    """
    if engine == "arrow":
        return _signatures_arrow(points, params, dim, vector=vector, id_col=id_col)
    if engine != "native":
        raise ValueError("engine must be 'native' or 'arrow'")
    arms = ", ".join(f"named_struct('table_no', {t}, 'sig', {_sig_sql(vector, params, dim, t)})"
                     for t in range(params.tables))
    return (points.where(F.size(vector) == dim)
                  .select(F.col(id_col).alias("id"), F.col(vector),
                          F.expr(_planes_sql(params, dim)).alias("_planes"))
                  .select("id", F.expr(f"inline(array({arms}))")))


def _signatures_arrow(points: DataFrame, params: LshParams, dim: int, *, vector: str, id_col: str) -> DataFrame:
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    planes_mat = np.array([p for t in planes(params, dim) for p in t], dtype=np.float64)   # (T*B, dim)
    weights = (1 << np.arange(params.bits)).astype(np.int64)
    block = points.sparkSession.sparkContext.broadcast(planes_mat)

    def run(batches):
        pm = block.value
        for rb in batches:
            vec = rb.column(1)
            lens = pc.fill_null(pc.list_value_length(vec), -1).to_numpy(zero_copy_only=False)
            good = lens == dim
            if not good.any():
                continue
            ids = rb.column(0).to_numpy(zero_copy_only=False)[good].astype(np.int64)
            x = pc.list_flatten(pc.filter(vec, pa.array(good))).to_numpy(zero_copy_only=False)
            bits = (x.astype(np.float64).reshape(-1, dim) @ pm.T) >= 0.0                    # (n, T*B)
            sig = (bits.reshape(len(ids), params.tables, params.bits) * weights).sum(axis=2)   # (n, T)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, params.tables)),
                 pa.array(np.tile(np.arange(params.tables, dtype=np.int32), len(ids))),
                 pa.array(sig.reshape(-1).astype(np.int64))], names=["id", "table_no", "sig"])

    src = points.select(F.col(id_col).cast("long").alias("id"), F.col(vector))
    return src.mapInArrow(run, "id long, table_no int, sig long")


def write_signatures(sigs: DataFrame, path: str) -> None:
    # the id tiebreak splits a crowded signature bucket over several files
    sigs.repartitionByRange("table_no", "sig", "id").sortWithinPartitions("table_no", "sig", "id") \
        .write.mode("overwrite").parquet(path)


def probes(qsigs: list[int], params: LshParams, radius: int | None = None) -> list[tuple[int, int]]:
    """All (table_no, sig) within Hamming ``radius`` of the query signatures."""
    r = params.radius if radius is None else radius
    out = []
    for t, s in enumerate(qsigs):
        for d in range(r + 1):
            for flip in itertools.combinations(range(params.bits), d):
                x = s
                for b in flip:
                    x ^= 1 << b
                out.append((t, x))
    return out


def n_probes(params: LshParams, radius: int | None = None) -> int:
    r = params.radius if radius is None else radius
    return params.tables * sum(math.comb(params.bits, d) for d in range(r + 1))


def candidates(sigs: DataFrame, qsigs: list[int], params: LshParams, radius: int | None = None) -> DataFrame:
    """Distinct candidate ids whose signature collides within the radius in any table.

    Small probe sets (checked: at most ``MAX_PROBES`` rows) are broadcast and
    equi-joined, which lets sorted signature files skip row groups; larger ones
    would not fit, so the signatures are filtered by Hamming distance instead.
    """
    spark = sigs.sparkSession
    r = params.radius if radius is None else radius
    if n_probes(params, r) <= MAX_PROBES:
        probe = spark.createDataFrame(probes(qsigs, params, r), "table_no int, sig long")
        hit = sigs.join(F.broadcast(probe), ["table_no", "sig"], "left_semi")
    else:
        qmap = F.create_map(*[x for t, s in enumerate(qsigs) for x in (F.lit(t), F.lit(s).cast("long"))])
        hit = sigs.where(F.bit_count(F.col("sig").bitwiseXOR(F.element_at(qmap, F.col("table_no")))) <= r)
    return hit.select("id").distinct()


def distances(sigs: DataFrame, qsigs: list[int]) -> DataFrame:
    """``(id, h)``: the smallest Hamming distance of each point's signatures to the query's."""
    qmap = F.create_map(*[x for t, s in enumerate(qsigs) for x in (F.lit(t), F.lit(s).cast("long"))])
    h = F.bit_count(F.col("sig").bitwiseXOR(F.element_at(qmap, F.col("table_no"))))
    return sigs.select("id", h.alias("h")).groupBy("id").agg(F.min("h").alias("h"))


def widened_radius(eligible: DataFrame | None, sigs: DataFrame, qsigs: list[int], params: LshParams, k: int) -> int:
    """The probe radius, widened from ``params.radius`` until ``k`` eligible candidates exist.

    ``eligible`` holds the ids that pass the filter (None: all). The usual radius
    is probed first; only when it falls short are the distances of all points
    counted (one row per distance reaches the driver).
    """
    first = candidates(sigs, qsigs, params)
    if eligible is not None:
        first = first.join(eligible, "id", "left_semi")
    if first.limit(k).count() >= k:
        return params.radius
    dist = distances(sigs, qsigs)
    if eligible is not None:
        dist = dist.join(eligible, "id", "left_semi")
    counts = {r["h"]: r["n"] for r in dist.groupBy("h").agg(F.count(F.lit(1)).alias("n")).collect()}
    for radius in range(params.radius, params.bits):
        if sum(n for h, n in counts.items() if h <= radius) >= k:
            return radius
    return params.bits


def ann_search(points: DataFrame, sigs: DataFrame, query, params: LshParams, *, k: int = 10,
               metric: str = COSINE, where: Column | None = None, keep=(), vector: str = "vector") -> DataFrame:
    """ANN-1/2: candidates from the signatures, the filter applied to them, exact re-rank.

    The radius widens until ``k`` filtered candidates exist, so ``min(k, matches)``
    hits come back; ``radius`` says how far it had to go.
    """
    qsigs = query_signatures(query, params)
    pts = points if where is None else points.where(where)
    radius = widened_radius(None if where is None else pts.select("id"), sigs, qsigs, params, k)
    pts = pts.join(candidates(sigs, qsigs, params, radius), "id", "left_semi")
    return search.knn(pts, query, vector=vector, metric=metric, k=k, keep=keep).withColumn("radius", F.lit(radius))


def ann_search_split(vectors: DataFrame, payload: DataFrame, sigs: DataFrame, query, params: LshParams, *,
                     k: int = 10, metric: str = COSINE, where: Column | None = None, keep=(),
                     vector: str = "vector") -> DataFrame:
    """ANN-1/2 with vectors and (optional) payload in separate tables.

    Candidate ids come from the signatures, with a filter intersected with the
    filtered payload; they are broadcast into the vector scan when they fit, so
    only candidates are re-ranked and no vector is shuffled. ``keep`` columns of
    the payload are fetched for the hits.
    """
    qsigs = query_signatures(query, params)
    eligible = None if where is None else payload.where(where).select("id")
    radius = widened_radius(eligible, sigs, qsigs, params, k)
    cand = candidates(sigs, qsigs, params, radius)
    if eligible is not None:
        cand = cand.join(eligible, "id", "left_semi")
    small = search.sized_broadcast(cand)
    vec = vectors.select("id", F.col(vector).alias("_v"))
    sc = score("_v", query, metric).alias("score")
    scored = vec.join(small, "id", "left_semi").select("id", sc) if small is not None else \
        vec.select("id", sc).join(cand, "id", "left_semi")
    hits = search.top_k(scored, k, payload=payload.select("id", *keep) if keep else None)
    return hits.withColumn("radius", F.lit(radius))


def search_by_mode(vectors: DataFrame, payload: DataFrame, sigs: DataFrame | None, query, params: LshParams, *,
                   mode: str, k: int = 10, where: Column | None = None, keep=(), vector: str = "vector") -> DataFrame:
    """ANN-3: the caller says ``mode="exact"`` or ``mode="ann"``; nothing switches by size."""
    if mode == "exact":
        scored = search.score_split(vectors, payload, query, where=where, vector=vector)
        return search.top_k(scored, k, payload=payload.select("id", *keep) if keep else None)
    if mode == "ann":
        return ann_search_split(vectors, payload, sigs, query, params, k=k, where=where, keep=keep, vector=vector)
    raise ValueError(f"mode must be 'exact' or 'ann', not {mode!r}")


def recall_by_radius(points: DataFrame | None, sigs: DataFrame, query, params: LshParams, *, k: int = 10,
                     vector: str = "vector", scored: DataFrame | None = None) -> DataFrame:
    """ANN-4: recall@k of the ANN answer against the exact one, for every radius 0..bits.

    A point is a candidate at radius r when its smallest Hamming distance over the
    tables is <= r. The best ``k`` of each distance are cut first (partial
    ``WindowGroupLimit``), and only these ``k * (bits + 1)`` rows are repeated for
    the radii they qualify for.
    """
    qsigs = query_signatures(query, params)
    if scored is None:                       # exact scores of every point: (id, score)
        scored = points.select(F.col("id"), score(vector, query).alias("score"))
    order = [F.col("score").desc(), F.col("id").asc()]
    near = scored.select("id", "score").join(distances(sigs, qsigs), "id")
    per_h = near.withColumn("rn", F.row_number().over(Window.partitionBy("h").orderBy(*order))) \
        .where((F.col("rn") <= k) & F.col("score").isNotNull())
    per_r = per_h.select("id", "score", F.explode(F.sequence(F.col("h").cast("int"), F.lit(params.bits))).alias("radius"))
    w = Window.partitionBy("radius").orderBy(*order)
    topr = per_r.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    exact = search.top_k(scored, k).select("id", F.lit(1).alias("hit"))
    if k <= search.MAX_BROADCAST_K:
        exact = F.broadcast(exact)
    found = (topr.join(exact, "id", "left")
                 .groupBy("radius").agg(F.sum(F.coalesce("hit", F.lit(0))).alias("found"),
                                        F.count(F.lit(1)).alias("returned")))
    radii = sigs.sparkSession.range(0, params.bits + 1).select(F.col("id").cast("int").alias("radius"))
    found = (topr.join(F.broadcast(exact), "id", "left")
                 .groupBy("radius").agg(F.sum(F.coalesce("hit", F.lit(0))).alias("found"),
                                        F.count(F.lit(1)).alias("returned")))
    return (radii.join(found, "radius", "left")
                 .select("radius", F.coalesce("returned", F.lit(0)).cast("long").alias("returned"),
                         F.round(F.coalesce("found", F.lit(0)) / F.lit(float(k)), 6).alias("recall")))
