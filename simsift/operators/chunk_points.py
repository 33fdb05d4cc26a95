"""Chunks of documents as points with one named vector each (CHK-6/7, PRJ-8, KNN-5/7/8).

Every chunking of a document becomes points of one table: the source fields, a
stable id, the chunk, and the vector of its chunking (``vec_fixed``,
``vec_sentence``, ``vec_semantic``), the other two NULL. All chunks are embedded
in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsift.functions.text import point_id
from simsift.operators import chunking, embed

STRATEGIES = (chunking.FIXED, chunking.SENTENCE, chunking.SEMANTIC)


def vector_of(strategy: str) -> str:
    return f"vec_{strategy}"


def chunk_points(df: DataFrame, text: str, *, key: str = "id", keep: Sequence[str] = (), size=chunking.MAX_TOKENS,
                 dim: int = embed.EMBED_DIM, percentile: float = chunking.SEMANTIC_PERCENTILE,
                 dress: Callable[[Column], Column] | None = None) -> DataFrame:
    """``(id, key, chunking, chunk_index, chunk, *keep, vec_fixed, vec_sentence, vec_semantic)``.

    Narrow from the document scan to the points: nothing is shuffled. ``dress``
    adds to a chunk what goes with it (a menu, say) before it is embedded; it may
    use the ``keep`` columns.
    """
    cols = (key, *keep)
    narrow = chunking.tagged_chunks(df, {chunking.FIXED: chunking.fixed_chunk_array(text, size),
                                         chunking.SENTENCE: chunking.sentence_chunk_array(text, size)}, keep=cols)
    semantic = chunking.semantic_chunks(df, text, key=key, percentile=percentile, dim=dim, keep=tuple(keep)) \
        .withColumn("chunking", F.lit(chunking.SEMANTIC))
    points = narrow.unionByName(semantic)
    if dress is not None:
        points = points.withColumn("chunk", dress(F.col("chunk")))
    points = points.withColumn("_pid", point_id(F.col(key), F.col("chunking"), F.col("chunk_index")))
    points = embed.embed(points, "chunk", [key, "chunking", "chunk_index"], dim=dim, out="_v")
    vectors = [F.when(F.col("chunking") == s, F.col("_v")).alias(vector_of(s)) for s in STRATEGIES]
    return points.select(F.col("_pid").alias("id"), *[c for c in (key,) if c != "id"], "chunking", "chunk_index", "chunk",
                         *keep, *vectors)


def long_vectors(points: DataFrame) -> DataFrame:
    """``(strategy, id, vector)`` of a chunk-point table, for searches over every strategy at once."""
    return points.select(F.col("chunking").alias("strategy"), "id",
                         F.coalesce(*[F.col(vector_of(s)) for s in STRATEGIES]).alias("vector"))
