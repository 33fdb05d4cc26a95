"""Sparse top-k over impact-ordered posting blocks with a rising threshold (KNN-9/10).

The postings of an index are sorted by value, greatest first, and cut into blocks
of ``block_rows`` with their greatest value: ``(idx, block, top, entries)``. A
search reads the first blocks of every query index and doubles the depth until no
point outside of what was read can reach the k-th best score:

* the k-th best of the partial sums seen so far is a lower bound of the answer;
* a point met in no block read yet scores at most the sum of query value x
  greatest value of the next block, over all query indices.

Points whose partial sum plus that bound reaches the threshold are then scored
exactly from the stored vectors, so the answer equals the full scan's. An index
with a negative query value, or with negative stored values, bounds nothing and
is read whole. Points of the answer share an index with the query, as in the scan.

Blocks are cut from one global sort where its partitions lie (a hot index spreads over
tasks), and numbered by the blocks of the partitions before; postings are shuffled once.
The driver sees one row per query index a round.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simsift.functions.vectors import SCORE_DIGITS
from simsift.operators import sparse
from simsift.operators.batches import trimmed
from simsift.operators.search import sized_broadcast
from simsift.session import checkpoint_dir

BLOCK_ROWS = 128
FIRST_DEPTH = 4


def _cut(block_rows: int):
    """Arrow function: a partition's ``(idx, id, val)``, sorted, to its blocks, numbered from 0."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def blocks(idx, ids, vals, first):
            at = idx.to_numpy(zero_copy_only=False)
            no = first + np.arange(len(at)) // block_rows
            new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (no[1:] != no[:-1])])
            v = vals.to_numpy(zero_copy_only=False)
            entries = pa.ListArray.from_arrays(pa.array(np.r_[new, len(at)].astype(np.int32)),
                                               pa.StructArray.from_arrays([ids, vals], ["id", "val"]))
            return pa.RecordBatch.from_arrays(
                [idx.take(pa.array(new)), pa.array(no[new]), pa.array(np.maximum.reduceat(v, new)),
                 pa.array(np.minimum.reduceat(v, new)), entries], names=["idx", "_local", "top", "least", "entries"])

        rest, done = None, 0
        for rb in batches:
            cols = list(rb.columns) if rest is None else [pa.concat_arrays([a, b]) for a, b in zip(rest, rb.columns)]
            full = len(cols[0]) // block_rows * block_rows         # what is left begins a block with the next batch
            if full:
                yield blocks(*(c.slice(0, full) for c in cols), done)
            done += full // block_rows
            rest = [pc.take(c, pa.array(np.arange(full, len(c)))) for c in cols]
        if rest is not None and len(rest[0]):
            yield blocks(*rest, done)

    return trimmed(run)


def posting_blocks(long: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(idx, block, top, least, entries)`` of a long ``(idx, id, val)`` table; blocks of an index are consecutive.

    The blocks lie in order of (idx, block), as cut, and are checkpointed: range bounds come from sampling.
    """
    if block_rows < 1:
        raise ValueError("block_rows must be positive")
    checkpoint_dir(long.sparkSession)
    val = F.col("val").cast("double")
    rows = long.select("idx", "id", val.alias("val"), (-val).alias("_down")).where("val IS NOT NULL")
    ranged = rows.repartitionByRange("idx", "_down", "id").sortWithinPartitions("idx", "_down", "id").select("idx", "id", "val")
    kinds = {f.name: f.dataType.simpleString() for f in ranged.schema}
    cut = ranged.mapInArrow(_cut(block_rows), f"idx {kinds['idx']}, _local bigint, top double, least double, "
                            f"entries array<struct<id:{kinds['id']},val:double>>")
    held = cut.withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    before = held.groupBy("_pid").agg((F.max("_local") + 1).alias("_n")).select(
        "_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))               # one row per partition
    return held.join(F.broadcast(before), "_pid").select("idx", (F.col("_off") + F.col("_local")).alias("block"), "top",
                                                         "least", "entries")


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Files of :func:`posting_blocks`, which lie in order of (idx, block), so that a search skips what it does not read."""
    blocks.write.mode("overwrite").parquet(path)


@dataclass
class Report:
    """What a search read: blocks of the query's indices, those read in the last round, rounds, points scored exactly."""

    blocks: int = 0
    read: int = 0
    rounds: int = 0
    candidates: int = 0


def knn_block_max(blocks: DataFrame, points: DataFrame, query_indices, query_values, *, k: int = 10, vector: str = "sp",
                  id_col: str = "id", first_depth: int = FIRST_DEPTH) -> tuple[DataFrame, Report]:
    """Exact sparse top-k ``(rank, id, score)`` and what it read.

    ``points`` holds the vectors ``(id, sp)`` from which the survivors are scored.
    """
    spark, report = blocks.sparkSession, Report()
    terms = sparse._query_terms(query_indices, query_values)
    mine = blocks.where(F.col("idx").isin([i for i, _ in terms])) if 0 < len(terms) <= sparse.MAX_PUSHED_TERMS else \
        blocks.join(F.broadcast(spark.createDataFrame([(i,) for i, _ in terms], "idx long")), "idx", "left_semi")
    known = {r.idx: r for r in mine.groupBy("idx").agg(
        F.min("block").alias("lo"), F.max("block").alias("hi"), F.min("least").alias("least")).collect()}   # one per query index
    terms = [(i, v) for i, v in terms if i in known]
    report.blocks = sum(r.hi - r.lo + 1 for r in known.values())
    if not terms:
        return spark.createDataFrame([], "rank long, id long, score double"), report
    depth, slack = first_depth, 10.0 ** -SCORE_DIGITS
    while True:
        report.rounds += 1
        upto = {i: known[i].lo + depth if v >= 0 and known[i].least >= 0 else known[i].hi + 1 for i, v in terms}
        report.read = sum(min(upto[i], known[i].hi + 1) - known[i].lo for i, _ in terms)
        asked = spark.createDataFrame([(i, v, upto[i]) for i, v in terms], "idx long, qval double, upto long")
        seen = (mine.join(F.broadcast(asked), "idx").where(F.col("block") < F.col("upto"))        # one row per query index
                .select("qval", F.inline("entries")).groupBy("id")
                .agg(F.sum(F.col("val") * F.col("qval")).alias("partial")))
        after = mine.join(F.broadcast(asked), "idx").where(F.col("block") == F.col("upto"))
        bound = sum(r.qval * r.top for r in after.select("qval", "top").collect())
        if not bound and report.read == report.blocks:
            return sparse._topk(seen.select("id", F.round("partial", SCORE_DIGITS).alias("score")), k), report
        best = seen.orderBy(F.desc("partial")).limit(k).agg(F.min("partial").alias("kth"), F.count(F.lit(1)).alias("n")).first()
        if best.n == k and best.kth > bound + 2 * slack:
            break
        depth *= 2
    near = seen.where(F.col("partial") + F.lit(bound) >= F.lit(best.kth - 2 * slack)).select("id")
    small = sized_broadcast(near)
    report.candidates = near.count()
    held = points.select(F.col(id_col).alias("id"), F.col(vector).alias("sp")).join(near if small is None else small, "id", "left_semi")
    return sparse.knn_scan(held, "sp", [i for i, _ in terms], [v for _, v in terms], k=k), report
