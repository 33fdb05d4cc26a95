"""Sparse vectors: dot-product search by full scan or by inverted index (KNN-9/10).

A sparse vector is ``STRUCT<indices: ARRAY<BIGINT>, values: ARRAY<FLOAT>>``
(indices up to 4,294,967,295, so BIGINT). Hits are points sharing at least one
index with the query; score = sum of products over shared indices, rounded to 6.

* scan: every row folds its own arrays against the query held as a literal array
  (queries of at most ``MAX_SCAN_TERMS`` terms); narrow, no shuffle.
* inverted: the long table ``(idx, id, val)`` (written sorted by ``idx`` so
  Parquet min/max statistics skip row groups) is semi-filtered to the query's
  indices, joined with the broadcast query terms (at most the query's non-zeros)
  and summed per id with map-side partial aggregation. A hot index only
  lengthens its own scan range; the shuffle carries one partial sum per
  (task, id).

Both paths return the same answer (tested).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.functions.vectors import SCORE_DIGITS

MAX_INDEX = 4_294_967_295
# Query terms up to this many are broadcast (and pushed as an IN filter);
# longer queries join the postings by a shuffle.
MAX_BROADCAST_TERMS = 100_000
# Longer queries search the long form instead of comparing every entry with every term.
MAX_SCAN_TERMS = 64
# Up to this many query indices reach the scan as a pushed IN filter.
MAX_PUSHED_TERMS = 1_000


def sparse_from_dense(dense, threshold: float):
    """Sparse struct of the entries with ``|x| > threshold`` (0-based indices)."""
    d = F.col(dense) if isinstance(dense, str) else dense
    kept = F.filter(F.transform(d, lambda x, i: F.struct(i.cast("long").alias("i"), x.alias("v"))),
                    lambda e: F.abs(e["v"]) > F.lit(threshold))
    return F.struct(F.transform(kept, lambda e: e["i"]).alias("indices"),
                    F.transform(kept, lambda e: e["v"].cast("float")).alias("values"))


def validate_sparse(col: str):
    """Indices within uint32, unique, and as many values as indices."""
    c = F.col(col)
    return ((F.size(c["indices"]) == F.size(c["values"]))
            & F.forall(c["indices"], lambda i: (i >= 0) & (i <= F.lit(MAX_INDEX)))
            & (F.size(F.array_distinct(c["indices"])) == F.size(c["indices"])))


def to_long(df: DataFrame, col: str, id_col: str = "id") -> DataFrame:
    """Long form ``(idx, id, val)`` for the inverted path."""
    e = F.arrays_zip(F.col(f"{col}.indices").alias("idx"), F.col(f"{col}.values").alias("val"))
    return (df.select(F.col(id_col).alias("id"), F.explode(e).alias("_e"))
              .select(F.col("_e.idx").alias("idx"), "id", F.col("_e.val").alias("val")))


def term_counts(df: DataFrame, text: str, id_col: str = "id") -> DataFrame:
    """Long sparse vectors ``(idx, id, val)`` of texts: per lower-cased token its hash (32 bits) and count."""
    from simsift.functions.text import tokens

    tok = df.select(F.col(id_col).alias("id"), F.explode(tokens(text)).alias("_tok"))
    idx = F.conv(F.substring(F.md5(F.lower("_tok")), 1, 8), 16, 10).cast("long")
    return tok.groupBy(idx.alias("idx"), "id").agg(F.count(F.lit(1)).cast("float").alias("val"))


def term_vectors(df: DataFrame, text: str, id_col: str = "id", out: str = "sp") -> DataFrame:
    """``(id, out struct<indices, values>)`` of texts, as :func:`term_counts` and :func:`collect_vectors` give them.

    A text is one row, so its tokens are hashed, sorted and counted where it is read, without a shuffle.
    Only texts that share an id meet: they are counted together in long form.
    """
    from simsift.functions.text import tokens
    from simsift.operators.chunking import let
    from simsift.operators.search import sized_broadcast

    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("_text"))

    def counted(h):
        starts = F.when(F.size(h) > 0, F.filter(F.sequence(F.lit(0), F.size(h) - 1),
                                                lambda i: (i == 0) | (F.get(h, i) != F.get(h, i - 1))))
        return let(F.coalesce(starts, F.array().cast("array<int>")), lambda s: F.struct(
            F.transform(s, lambda i: F.get(h, i)).alias("indices"),
            F.transform(s, lambda i, n: (F.coalesce(F.get(s, n + 1), F.size(h)) - i).cast("float")).alias("values")))

    hashes = F.sort_array(F.transform(tokens("_text"), lambda t: F.conv(
        F.substring(F.md5(F.lower(t)), 1, 8), 16, 10).cast("long")))
    lone = lambda r: r.select("id", let(hashes, counted).alias(out)).where(F.size(F.col(out)["indices"]) > 0)
    twice = rows.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("id").alias("_id"))
    if twice.isEmpty():
        return lone(rows)
    same = F.col("id").eqNullSafe(F.col("_id"))
    few = sized_broadcast(twice)
    twice = twice if few is None else few
    shared = collect_vectors(term_counts(rows.join(twice, same, "left_semi"), "_text"), out)
    return lone(rows.join(twice, same, "left_anti")).unionByName(shared)


def query_terms(text: str) -> tuple[list[int], list[float]]:
    """A query text as ``(indices, values)``, hashed and counted like :func:`term_counts`."""
    import hashlib
    import re
    from collections import Counter

    counts = Counter(int(hashlib.md5(t.lower().encode("utf-8")).hexdigest()[:8], 16)
                     for t in re.split(r"[ \t\n\x0b\f\r]+", text) if t)
    return list(counts), [float(n) for n in counts.values()]


def collect_vectors(long: DataFrame, out: str = "sp") -> DataFrame:
    """Long form ``(idx, id, val)`` -> ``(id, out struct<indices, values>)``, indices ascending."""
    e = F.sort_array(F.collect_list(F.struct("idx", "val")))
    return (long.groupBy("id").agg(e.alias("_e"))
                .select("id", F.struct(F.col("_e.idx").alias("indices"), F.col("_e.val").alias("values")).alias(out)))


def build_inverted(df: DataFrame, col: str, path: str, *, id_col: str = "id") -> None:
    """Write the inverted index sorted by ``idx`` (range-partitioned, so files hold disjoint idx ranges)."""
    long = to_long(df, col, id_col)
    # (idx, id) ranges: a hot index spans several files instead of one task
    long.repartitionByRange("idx", "id").sortWithinPartitions("idx", "id").write.mode("overwrite").parquet(path)


def _query_terms(query_indices: Sequence[int], query_values: Sequence[float]) -> list[tuple[int, float]]:
    if len(query_indices) != len(query_values):
        raise ValueError("query indices and values differ in length")
    if len(set(query_indices)) != len(query_indices):
        raise ValueError("query indices must be unique")
    if any(i < 0 or i > MAX_INDEX for i in query_indices):
        raise ValueError("query index outside 0..4294967295")
    return [(int(i), float(v)) for i, v in zip(query_indices, query_values)]


def _topk(scored: DataFrame, k: int) -> DataFrame:
    from simsift.operators.search import top_k

    return top_k(scored, k)


def knn_scan(df: DataFrame, col: str, query_indices, query_values, *, k: int = 10, id_col: str = "id") -> DataFrame:
    terms = _query_terms(query_indices, query_values)
    if not terms:
        return df.sparkSession.createDataFrame([], "rank long, id long, score double")
    if len(terms) > MAX_SCAN_TERMS:
        return knn_inverted(to_long(df.where(F.col(col).isNotNull()), col, id_col), query_indices, query_values, k=k)
    terms = sorted(terms)
    keys = F.array(*[F.lit(i).cast("long") for i, _ in terms])
    weights = F.array(*[F.lit(v).cast("double") for _, v in terms])
    pairs = F.arrays_zip(F.col(f"{col}.indices").alias("i"), F.col(f"{col}.values").alias("v"))
    hits = F.transform(pairs, lambda e: F.struct(F.array_position(keys, e["i"]).alias("p"), e["v"].alias("v")))
    shared = F.filter(hits, lambda e: e["p"] > 0)
    dot = F.aggregate(shared, F.lit(0.0).cast("double"),
                      lambda acc, e: acc + e["v"].cast("double") * F.element_at(weights, e["p"].cast("int")))
    scored = (df.where(F.col(col).isNotNull())
                .select(F.col(id_col).alias("id"), F.size(shared).alias("_n"),
                        F.round(dot, SCORE_DIGITS).alias("score"))
                .where(F.col("_n") > 0))
    return _topk(scored, k)


def knn_inverted(long: DataFrame, query_indices, query_values, *, k: int = 10) -> DataFrame:
    """Search the long ``(idx, id, val)`` table."""
    terms = _query_terms(query_indices, query_values)
    spark = long.sparkSession
    if not terms:
        return spark.createDataFrame([], "rank long, id long, score double")
    q = spark.createDataFrame(terms, "idx long, qval double")
    if len(terms) <= MAX_BROADCAST_TERMS:
        post = long.where(F.col("idx").isin([i for i, _ in terms])) if len(terms) <= MAX_PUSHED_TERMS else long
        q = F.broadcast(q)
    else:
        post = long
    scored = (post.join(q, "idx")
                  .groupBy("id").agg(F.sum(F.col("val").cast("double") * F.col("qval")).alias("_s"))
                  .select("id", F.round("_s", SCORE_DIGITS).alias("score")))
    return _topk(scored, k)
