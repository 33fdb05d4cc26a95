"""Many queries at once (KNN-11): an exact kNN join.

Queries and points are dealt into blocks, and every pair of a query block and a
point block is one task: one matrix product, then a partial top-k per query.
The partial lists are merged by a per-query ``row_number <= k`` window
(WindowGroupLimit, partial before the shuffle).

A query set of at most ``block_rows`` rows is one block: it is broadcast and
meets the points where they are read, without a shuffle. A larger set never
passes through the driver; its blocks meet the point blocks in a cogrouped
shuffle, points repeated once per query block. The work is inherently
queries x points; blocks only bound memory.

A task scores points in slices of about ``SLICE_SCORES`` scores and carries, for each
query, the k-th best score so far; only rows that reach it are held. So its memory
depends on queries x k, not on how many points a batch or a block holds.

Ranking is decided by Spark's own rounding: a task keeps every row within half a
rounding step of its k-th best raw score, and the final window breaks ties by id. Of
rows with one and the same raw score only the k smallest ids can be hits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simsift.functions.vectors import COSINE, DOT, SCORE_DIGITS
from simsift.operators.batches import trimmed

# A block of 4,096 queries x 1,536 float64 dims is 48 MiB inside each task.
DEFAULT_BLOCK_ROWS = 4096
# Points of one block of the cogrouped form.
POINT_BLOCK_ROWS = 50_000
# Scores that a task computes at once (float64).
SLICE_SCORES = 1 << 19

_PARTIAL = "qid long, id long, raw_score double"


def _scorer(k: int, metric: str):
    """Returns ``best(qids, qmat, blocks) -> (qid, id, raw)`` over a stream of ``(ids, x)``; self-contained, as it
    runs on executors."""
    cosine, slack, slice_scores = metric == COSINE, 10.0 ** -SCORE_DIGITS, SLICE_SCORES

    def cut(held, low):
        """The rows of each query within ``slack`` of its k-th best, which becomes its ``low``."""
        import numpy as np

        q, i, s = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (s[1:] != s[:-1])
        place = np.arange(len(q))
        fine = place - np.maximum.accumulate(np.where(new, place, 0)) < k          # of equal scores the k smallest ids
        q, i, s = q[fine], i[fine], s[fine]
        first, after = np.searchsorted(q, q), np.searchsorted(q, q, side="right")
        full = after - first >= k
        low[q[full]] = s[np.minimum(first + k, after) - 1][full]
        fine = s >= low[q] - slack
        return q[fine], i[fine], s[fine]

    def best(qids, qmat, blocks):
        import numpy as np

        nq, held, waiting = len(qids), [], 0
        low, qnorm = np.full(nq, -np.inf), np.sqrt((qmat * qmat).sum(axis=1))
        step, room = max(1, slice_scores // max(1, nq)), 2 * k * nq + slice_scores
        for all_ids, points in blocks:
            for a in range(0, len(all_ids), step):
                ids, x = all_ids[a:a + step], points[a:a + step].astype(np.float64)
                s = x @ qmat.T
                if cosine:
                    with np.errstate(divide="ignore", invalid="ignore"):
                        s /= np.sqrt((x * x).sum(axis=1))[:, None] * qnorm[None, :]
                s[~np.isfinite(s)] = -np.inf
                least = low
                if len(ids) > k and np.isneginf(low).any():
                    least = np.maximum(low, np.partition(s, len(ids) - k, axis=0)[len(ids) - k])
                rows, cols = np.nonzero((s >= least - slack) & (s > -np.inf))
                held.append((cols, ids[rows], s[rows, cols]))
                waiting += len(rows)
                if waiting > room:
                    held = [cut(held, low)]
                    waiting = len(held[0][0])
                    room = waiting + k * nq + slice_scores
        if not waiting:
            return [], [], []
        q, i, s = cut(held, low)
        return qids[q], i, s

    return best


def _functions(k: int, metric: str):
    """The two Arrow functions: against a broadcast block, and over a cogroup of blocks."""
    best = _scorer(k, metric)

    def matrix(col, dim: int | None):
        """``(usable rows, matrix)`` of an Arrow list column; rows of another length or with NULLs are unusable."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        if isinstance(col, pa.ChunkedArray):
            col = col.combine_chunks()
        lens = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
        if dim is None:
            dim = int(lens.max()) if len(lens) else 0
        good = lens == dim
        flat = pc.list_flatten(pc.filter(col, pa.array(good))).to_numpy(zero_copy_only=False)
        return good, flat.reshape(int(good.sum()), dim)

    def table(got):
        import pyarrow as pa

        return pa.table([pa.array(got[0], pa.int64()), pa.array(got[1], pa.int64()), pa.array(got[2], pa.float64())],
                        names=["qid", "id", "raw_score"])

    def against(block):
        def run(batches):
            qids, qmat = block.value

            def blocks():
                for rb in batches:
                    good, x = matrix(rb.column(1), qmat.shape[1])
                    yield rb.column(0).to_numpy(zero_copy_only=False)[good], x

            yield from table(best(qids, qmat, blocks())).to_batches(max_chunksize=100_000)
        return trimmed(run)

    def cogroup(points, queries):
        import numpy as np

        got = ([], [], [])
        if points.num_rows and queries.num_rows:
            known, qmat = matrix(queries.column("qv"), None)
            good, x = matrix(points.column("v"), qmat.shape[1])
            ids = points.column("id").to_numpy()[good]
            got = best(queries.column("qid").to_numpy()[known], qmat.astype(np.float64), [(ids, x)])
        return table(got)

    return against, cogroup


def knn_join(points: DataFrame, queries: DataFrame, *, k: int = 10, metric: str = COSINE,
             vector: str = "vector", id_col: str = "id", qid_col: str = "qid",
             qvector: str = "vector", block_rows: int = DEFAULT_BLOCK_ROWS,
             point_block_rows: int = POINT_BLOCK_ROWS) -> DataFrame:
    """Exact top-k for every query row: ``(qid, rank, id, score)``."""
    import numpy as np

    if metric not in (COSINE, DOT):
        raise ValueError(f"unknown metric {metric!r}")
    q = queries.select(F.col(qid_col).cast("long").alias("qid"), F.col(qvector).alias("qv")).where(F.col("qv").isNotNull())
    shape = q.agg(F.count(F.lit(1)).alias("n"), F.min(F.size("qv")).alias("lo"), F.max(F.size("qv")).alias("hi")).collect()[0]
    if not shape["n"]:
        return points.sparkSession.createDataFrame([], "qid long, rank long, id long, score double")
    if shape["lo"] != shape["hi"]:
        raise ValueError(f"query vectors must share one dimension, got {shape['lo']} to {shape['hi']}")
    pts = points.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("v"))
    against, cogroup = _functions(k, metric)
    if shape["n"] <= block_rows:
        rows = q.collect()                                   # at most block_rows rows
        block = points.sparkSession.sparkContext.broadcast(
            (np.array([r.qid for r in rows], np.int64), np.array([list(r.qv) for r in rows], np.float64)))
        partial = pts.mapInArrow(against(block), _PARTIAL)
    else:
        nq = -(-shape["n"] // block_rows)
        np_ = max(1, -(-pts.count() // point_block_rows))
        left = pts.withColumn("pb", F.pmod(F.xxhash64("id"), F.lit(np_))) \
            .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nq - 1).cast("long"))))
        right = q.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(nq))) \
            .withColumn("pb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(np_ - 1).cast("long"))))
        partial = left.groupBy("pb", "qb").cogroup(right.groupBy("pb", "qb")).applyInArrow(cogroup, _PARTIAL)
    scored = partial.select("qid", "id", F.round("raw_score", SCORE_DIGITS).alias("score"))
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc())
    return (scored.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
                  .select("qid", "rank", "id", "score"))
