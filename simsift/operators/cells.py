"""Inverted-file index over vectors: cells, product codes, pruned exact search (ANN-1/4, KNN-1/11).

* **Cells** are the parts of a Voronoi partition of the unit sphere. Centroids come from
  Lloyd rounds on a bounded sample (about ``sample_rows``, chosen by a hash of the id); each
  round is one distributed aggregate of partial sums, and only the centroids
  (``cells`` x dim) reach the driver.
* **Codes**: a vector is cut into parts of ``part_dims`` values, and each part is named by
  one byte, the nearest of 256 part centroids from the same Lloyd rounds.
* The **index** holds every point that can be a hit (not NULL, of the index's dimension,
  norm above 0): ``(cell, angle, id, codes, vector)``, sorted by cell and angle to the
  centroid, so that a search reads the columns and cells it needs.

Searches take many queries at once:

* :func:`search` is approximate: a query probes its nearest cells until they hold
  ``share`` of all points. Points are scored from their codes by per-query tables, the
  best ``rerank`` of a query are fetched and scored exactly. Without codes every probed
  point is scored from its vector.
* :func:`search_exact` gives the exact answer and skips only what the triangle inequality
  rules out. Angles on the sphere are a metric: a point at angle ``a`` of its centroid is at
  least ``|t - a|`` away from a query at angle ``t`` of it. The k-th best score of the
  cells nearest to a query bounds its answer from below; cells, and within a cell the run
  of points by angle, that cannot reach it are not scored.

Up to ``block_rows`` queries are broadcast to where the index is read. More of them
are cut into blocks by a hash of their id and meet the index in a cogrouped shuffle,
points repeated once a block. A task scores about ``SLICE_SCORES`` (point, query) pairs at
once and carries every query's last score that still counts, so its memory depends on the
queries of a block, not on batches or cells. Scores follow the library's contract: rounded to 6
places by Spark, ties by id.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from simsift.functions.vectors import COSINE, SCORE_DIGITS, score
from simsift.operators.batches import pieces, trimmed
from simsift.session import checkpoint_dir

# functions of this module run in Arrow tasks; they travel by value, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Queries of one broadcast block, points of one block of the cogrouped form.
BLOCK_ROWS, POINT_BLOCK_ROWS = 2048, 50_000
# Scores computed at once; rows assigned to centroids, and queries to cells, at once.
SLICE_SCORES, SLICE_ROWS = 1 << 19, 512
MAX_CELLS = 4096
CODES = 256
# Rounding room of an angle (arc cosine near 1 keeps half the digits).
ANGLE_SLACK = 1e-7


@dataclass(frozen=True)
class CellParams:
    """Build knobs: number of cells, Lloyd rounds, sample size, and values of a vector per code byte."""

    cells: int = 1024
    rounds: int = 6
    sample_rows: int = 1 << 17
    part_dims: int = 4

    def __post_init__(self):
        if not 1 <= self.cells <= MAX_CELLS:
            raise ValueError(f"cells={self.cells} out of range 1..{MAX_CELLS}")
        if self.rounds < 0 or self.sample_rows < 1 or self.part_dims < 1:
            raise ValueError("rounds, sample_rows and part_dims must not be negative or 0")


@dataclass(frozen=True)
class CellModel:
    """Centroids (cells x dim, unit length), part centroids (parts x codes x part_dims) and the dimension."""

    centroids: np.ndarray
    parts: np.ndarray
    dim: int


def _matrix(col, dim: int):
    """``(usable rows, unit rows, exact float64 rows)`` of an Arrow list column: right size, no NULL, norm above 0."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    good = pc.fill_null(pc.equal(pc.list_value_length(col), dim), False).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(pc.filter(col, pa.array(good)))
    x = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dim)
    norm = np.sqrt((x * x).sum(axis=1))
    fine = np.isfinite(norm) & (norm > 0)
    good[np.flatnonzero(good)] = fine
    return good, x[fine] / norm[fine, None], x[fine]


def _nearest(x, centroids, spherical: bool):
    import numpy as np

    s = x @ centroids.T
    if not spherical:
        s -= 0.5 * (centroids * centroids).sum(axis=1)
    return np.argmax(s, axis=1)


def _lloyd(sample: DataFrame, start: np.ndarray, rounds: int, spherical: bool) -> np.ndarray:
    """Lloyd rounds for every part at once; ``start`` is (parts, k, part dims). One aggregate a round."""
    import pyarrow as pa

    spark, at = sample.sparkSession, start
    parts, k, sub = at.shape
    dim = parts * sub
    schema = pa.schema([("cell", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.float64()))])

    def partial(block):
        def run(batches):
            sums, n = np.zeros((parts * k, sub)), np.zeros(parts * k, np.int64)
            for rb in pieces(batches, SLICE_ROWS):
                _, x, _ = _matrix(rb.column(0), dim)
                for p in range(parts):
                    piece = x[:, p * sub:(p + 1) * sub]
                    cell = p * k + _nearest(piece, block.value[p], spherical)
                    order = np.argsort(cell, kind="stable")
                    found, first = np.unique(cell[order], return_index=True)
                    if len(found):
                        sums[found] += np.add.reduceat(piece[order], first, axis=0)
                        n += np.bincount(cell, minlength=parts * k)
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some]),
                                              pa.array(list(sums[some]), pa.list_(pa.float64()))], schema=schema)
        return run

    def merged(batches):
        total = {}
        for rb in batches:
            for c, n, s in zip(*(col.to_pylist() for col in rb.columns)):
                a, b = total.get(c, (0, 0.0))
                total[c] = (a + n, b + np.array(s))
        yield pa.RecordBatch.from_pydict({"cell": list(total), "n": [v[0] for v in total.values()],
                                          "total": [list(v[1]) for v in total.values()]}, schema=schema)

    out = "cell int, n bigint, total array<double>"
    for _ in range(rounds):
        block = spark.sparkContext.broadcast(at)
        rows = sample.mapInArrow(trimmed(partial(block)), out).repartition("cell").mapInArrow(merged, out).collect()   # parts * k rows
        moved = at.reshape(parts * k, sub).copy()
        for r in rows:
            mean = np.round(np.array(r.total) / r.n, 9)
            size = np.sqrt((mean * mean).sum())
            if not spherical or size > 0:
                moved[r.cell] = mean / size if spherical else mean
        at = moved.reshape(parts, k, sub)
    return at


def train(points: DataFrame, params: CellParams, *, vector: str = "vector", id_col: str = "id") -> CellModel:
    """Centroids and part centroids of the usable points, from a sample of about ``params.sample_rows``.

    With fewer points than cells every point is a centroid; no usable point is an error.
    """
    usable = points.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda e: e.isNotNull()) & F.exists("v", lambda e: e != 0))
    sizes = usable.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not sizes:
        raise ValueError("no usable vector to train on")
    dim, n = sizes[0]["dim"], sizes[0]["n"]
    if dim % params.part_dims:
        raise ValueError(f"part_dims={params.part_dims} must divide the dimension {dim}")
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    usable = usable.where(F.size("v") == dim)
    # a share of the ids by hash, a little more than needed, then the rows of the smallest hashes
    wide = usable.where(drawn < int(min(1.0, 1.2 * params.sample_rows / n) * (1 << 40)) + 1)
    seeds = wide.orderBy(drawn, "id").limit(max(params.cells, CODES)).select("v").toArrow()     # cells x dim numbers
    unit = _matrix(seeds["v"], dim)[1]
    checkpoint_dir(points.sparkSession)
    sample = wide.select("v").checkpoint()                                                    # read once a round
    cells = _lloyd(sample, unit[None, :params.cells], params.rounds, True)[0]
    parts = unit[:CODES].reshape(-1, dim // params.part_dims, params.part_dims).transpose(1, 0, 2)
    return CellModel(cells, _lloyd(sample, np.ascontiguousarray(parts), params.rounds, False), dim)


def build(points: DataFrame, model: CellModel, *, vector: str = "vector", id_col: str = "id") -> DataFrame:
    """``(cell, angle, id, codes, vector)`` of every usable point, where it is read."""
    import pyarrow as pa

    spark = points.sparkSession
    block, dim, sub = spark.sparkContext.broadcast((model.centroids, model.parts)), model.dim, model.parts.shape[2]

    def run(batches):
        cents, parts = block.value
        for rb in pieces(batches, SLICE_ROWS):
            good, x, _ = _matrix(rb.column(1), dim)
            cell = _nearest(x, cents, True)
            angle = np.arccos(np.clip((x * cents[cell]).sum(axis=1), -1.0, 1.0))
            codes = np.empty((len(x), len(parts)), np.uint8)
            for p in range(len(parts)):
                codes[:, p] = _nearest(x[:, p * sub:(p + 1) * sub], parts[p], False)
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int32)), pa.array(angle), rb.column(0).filter(keep),
                 pa.array([c.tobytes() for c in codes], pa.binary()), rb.column(1).filter(keep)],
                names=["cell", "angle", "id", "codes", "vector"])

    rows = points.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("vector"))
    kind = rows.schema["vector"].dataType.simpleString()
    return rows.mapInArrow(trimmed(run), f"cell int, angle double, id long, codes binary, vector {kind}")


def write_index(index: DataFrame, path: str) -> None:
    """Files sorted by cell and angle; a large cell spans several files."""
    index.repartitionByRange("cell", "angle").sortWithinPartitions("cell", "angle", "id").write.mode("overwrite").parquet(path)


def write_model(spark: SparkSession, model: CellModel, path: str) -> None:
    """The model as a small table: centroids are part -1."""
    rows = [(-1, i, v.tolist()) for i, v in enumerate(model.centroids)]
    rows += [(p, i, v.tolist()) for p, part in enumerate(model.parts) for i, v in enumerate(part)]
    spark.createDataFrame(rows, "part int, i int, v array<double>").coalesce(1).write.mode("overwrite").parquet(path)


def read_model(spark: SparkSession, path: str) -> CellModel:
    rows = spark.read.parquet(path).orderBy("part", "i").collect()
    centroids = np.array([r.v for r in rows if r.part < 0])
    parts = np.array([r.v for r in rows if r.part >= 0]).reshape(max(r.part for r in rows) + 1, -1, len(rows[-1].v))
    return CellModel(centroids, parts, centroids.shape[1])


def cell_sizes(index: DataFrame, model: CellModel) -> tuple[np.ndarray, np.ndarray]:
    """Points and greatest angle of every cell (at most ``MAX_CELLS`` rows)."""
    n, radius = np.zeros(len(model.centroids), np.int64), np.zeros(len(model.centroids))
    for r in index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("r")).collect():
        n[r.cell], radius[r.cell] = r.n, r.r
    return n, radius


def nearest_cells(t, sizes, points: int):
    """``[query, cell]``: the cells in order of the angle ``t`` until they hold ``points`` points."""
    order = np.argsort(t, axis=1, kind="stable")
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    out = np.zeros(t.shape, bool)
    np.put_along_axis(out, order, before < points, axis=1)
    return out & (sizes > 0)


def _probed(t, sizes, points: int):
    """:func:`nearest_cells` of many queries, some at once."""
    out = np.zeros(t.shape, bool)
    for a in range(0, len(t), SLICE_ROWS):
        out[a:a + SLICE_ROWS] = nearest_cells(t[a:a + SLICE_ROWS], sizes, points)
    return out


def _rows(qids, ids, values):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(qids, pa.int64()), pa.array(ids, pa.int64()), pa.array(values, pa.float64())],
                                      names=["qid", "id", "raw"])


def _best(out, keep: int, slack: float, low):
    """Of ``(query row, id, score)`` arrays, every query's rows within ``slack`` of its ``keep``-th best score.

    That score becomes the query's ``low``. Of equal scores of a query only the ``keep`` smallest ids can count.
    """
    q, i, s = (np.concatenate(c) for c in zip(*out))
    order = np.lexsort((i, -s, q))
    q, i, s = q[order], i[order], s[order]
    new = np.ones(len(q), bool)
    new[1:] = (q[1:] != q[:-1]) | (s[1:] != s[:-1])
    place = np.arange(len(q))
    fine = place - np.maximum.accumulate(np.where(new, place, 0)) < keep
    q, i, s = q[fine], i[fine], s[fine]
    first, after = np.searchsorted(q, q), np.searchsorted(q, q, side="right")      # of the query's run
    full = after - first >= keep
    low[q[full]] = s[np.minimum(first + keep, after) - 1][full]
    fine = s >= low[q] - slack
    return q[fine], i[fine], s[fine]


def _scan(queries, cells, column, probe, prepare, evaluate, keep: int, slack: float, prune=None):
    """Scores of the probed points of a stream of index batches; the best of each query at the end.

    ``column`` batches are (cell, angle, id, values); ``evaluate(rows, query rows)`` scores a run of
    rows against the queries that probe its cell. With ``prune`` (least score, angles) only
    the points are scored whose angle lets them reach the least score. A row with a NULL id
    tells how many points were scored for a query.
    """
    held, scored, waiting = [], np.zeros(len(queries), np.int64), 0
    low, room = np.full(len(queries), -np.inf), 2 * keep * len(queries) + SLICE_SCORES
    for rb in column:
        cell = rb.column(0).to_numpy(zero_copy_only=False)
        if not len(cell):
            continue
        angle, ids = (rb.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
        values = prepare(rb.column(3))
        order = np.lexsort((angle, cell))
        found, first = np.unique(cell[order], return_index=True)
        for c, a, b in zip(found, first, np.r_[first[1:], len(order)]):
            who = np.flatnonzero(probe[:, c])
            if not len(who):
                continue
            rows, lo, hi = order[a:b], None, None
            if prune is None:
                scored[who] += len(rows)
            else:
                least, t = prune
                reach = np.arccos(np.clip(least[who], -1.0, 1.0)) + ANGLE_SLACK
                lo = np.searchsorted(angle[rows], t[who, c] - reach)
                hi = np.searchsorted(angle[rows], t[who, c] + reach, side="right")
                some = lo < hi
                who, lo, hi = who[some], lo[some], hi[some]
                if not len(who):
                    continue
                scored[who] += hi - lo
            # the whole run, or the points that any of its queries reaches, in slices of bounded size
            start, stop = (0, len(rows)) if lo is None else (lo.min(), hi.max())
            step = max(1, SLICE_SCORES // len(who))
            for at in range(start, stop, step):
                part = rows[at:min(at + step, stop)]
                s = evaluate(values[part], who)
                fine = s >= low[who] - slack
                if lo is not None:
                    row = np.arange(at, at + len(part))[:, None]
                    fine &= (row >= lo) & (row < hi) & (s >= least[who] - slack)
                if len(part) > keep and np.isneginf(low[who]).any():
                    kth = np.partition(s, len(part) - keep, axis=0)[len(part) - keep]
                    fine &= s >= kth - slack
                r, w = np.nonzero(fine)
                held.append((who[w], ids[part][r], s[r, w]))
                waiting += len(r)
                if waiting > room:
                    held = [_best(held, keep, slack, low)]
                    waiting = len(held[0][0])
                    room = waiting + keep * len(queries) + SLICE_SCORES
    if waiting:
        q, i, s = _best(held, keep, slack, low)
        yield _rows(queries[q], i, s)
    told = np.flatnonzero(scored)
    import pyarrow as pa

    yield pa.RecordBatch.from_arrays([pa.array(queries[told], pa.int64()), pa.nulls(len(told), pa.int64()),
                                      pa.array(scored[told].astype(np.float64))], names=["qid", "id", "raw"])


def _against(index: DataFrame, column: str, queries: DataFrame, block_rows: int, point_block_rows: int, make):
    """``make(qids, unit vectors, other columns)`` scans index batches, for one broadcast block or for cogrouped blocks."""
    import pyarrow as pa

    spark, out = index.sparkSession, "qid long, id long, raw double"
    data = index.select("cell", "angle", "id", column)
    n = queries.count()
    if n <= block_rows:
        block = spark.sparkContext.broadcast(queries.toArrow())               # at most block_rows rows

        def run(batches):
            yield from make(block.value)(batches)

        return data.mapInArrow(trimmed(run), out)
    nq, np_ = -(-n // block_rows), max(1, -(-data.count() // point_block_rows))

    def both(points, asked):
        got = list(make(asked)(points.to_batches())) if points.num_rows and asked.num_rows else []
        return pa.Table.from_batches(got, schema=pa.schema([("qid", pa.int64()), ("id", pa.int64()), ("raw", pa.float64())]))

    left = data.withColumn("pb", F.pmod(F.xxhash64("id"), F.lit(np_))).withColumn(
        "qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(nq - 1).cast("long"))))
    right = queries.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(nq))).withColumn(
        "pb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(np_ - 1).cast("long"))))
    return left.groupBy("pb", "qb").cogroup(right.groupBy("pb", "qb")).applyInArrow(both, out)


def _queries(queries: DataFrame, model: CellModel, qid_col: str, qvector: str) -> DataFrame:
    v = F.col(qvector)
    return queries.select(F.col(qid_col).cast("long").alias("qid"), v.alias("qv")).where(
        (F.size(v) == model.dim) & F.forall(v, lambda e: e.isNotNull()) & F.exists(v, lambda e: e != 0))


def _asked(table, dim):
    """(qids, unit vectors) of a block of queries."""
    good, unit, _ = _matrix(table["qv"], dim)
    return table["qid"].to_numpy()[good], unit


def _top(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.col("score").desc(), F.col("id").asc())
    return (scored.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
            .select("qid", "rank", "id", "score"))


def _hits(partial: DataFrame, k: int) -> DataFrame:
    return _top(partial.where("id IS NOT NULL").select("qid", "id", F.round("raw", SCORE_DIGITS).alias("score")), k)


def points_scored(partial: DataFrame) -> DataFrame:
    """``(qid, scored)``: points scored for each query of a scan."""
    return partial.where("id IS NULL").groupBy("qid").agg(F.sum("raw").cast("long").alias("scored"))


def scan_approximate(index: DataFrame, model: CellModel, queries: DataFrame, *, keep: int, share: float, codes: bool,
                     sizes=None, qid_col: str = "qid", qvector: str = "vector", block_rows: int = BLOCK_ROWS,
                     point_block_rows: int = POINT_BLOCK_ROWS) -> DataFrame:
    """Partial lists ``(qid, id, raw)`` of every task over the probed cells, from codes or from vectors."""
    if not 0 < share <= 1:
        raise ValueError(f"share={share} out of range (0, 1]")
    spark, dim, sub = index.sparkSession, model.dim, model.parts.shape[2]
    n = cell_sizes(index, model)[0] if sizes is None else sizes[0]
    block = spark.sparkContext.broadcast((model.centroids, model.parts if codes else None, n))
    slack = 0.0 if codes else 10.0 ** -SCORE_DIGITS

    def make(asked):
        def run(batches):
            cents, parts, size = block.value
            qids, unit = _asked(asked, dim)
            probe = _probed(np.arccos(np.clip(unit @ cents.T, -1.0, 1.0)), size, share * size.sum())
            if codes:
                tables = np.empty((len(unit), len(parts), parts.shape[1]), np.float32)
                for p in range(len(parts)):
                    tables[:, p] = unit[:, p * sub:(p + 1) * sub] @ parts[p].T

                def prepare(col):
                    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(len(col), len(parts))

                def evaluate(x, who):
                    s = np.zeros((len(x), len(who)), np.float32)
                    for p in range(len(parts)):
                        s += tables[who, p, :].T[x[:, p]]
                    return s
            else:
                def prepare(col):
                    return _matrix(col, dim)[1]

                def evaluate(x, who):
                    return x @ unit[who].T
            yield from _scan(qids, cents, batches, probe, prepare, evaluate, keep, slack)
        return run

    return _against(index, "codes" if codes else "vector", _queries(queries, model, qid_col, qvector), block_rows,
                    point_block_rows, make)


def search(index: DataFrame, model: CellModel, queries: DataFrame, *, k: int = 10, share: float = 0.25, rerank: int = 200,
           codes: bool = True, sizes=None, qid_col: str = "qid", qvector: str = "vector", **blocks) -> DataFrame:
    """Approximate cosine top-k of every query: ``(qid, rank, id, score)``; scores are exact."""
    if codes and rerank < k:
        raise ValueError("rerank must be at least k")
    partial = scan_approximate(index, model, queries, keep=rerank if codes else k, share=share, codes=codes, sizes=sizes,
                               qid_col=qid_col, qvector=qvector, **blocks)
    if not codes:
        return _hits(partial, k)
    w = Window.partitionBy("qid").orderBy(F.col("raw").desc(), F.col("id").asc())
    near = (partial.where("id IS NOT NULL").withColumn("n", F.row_number().over(w)).where(F.col("n") <= rerank)
            .select("qid", "id").distinct())
    asked = _queries(queries, model, qid_col, qvector)
    scored = near.join(index.select("id", "vector"), "id").join(asked, "qid").select(
        "qid", "id", score("vector", "qv", COSINE).alias("score"))
    return _top(scored, k)


def scan_exact(index: DataFrame, model: CellModel, queries: DataFrame, *, k: int, sizes=None, qid_col: str = "qid",
               qvector: str = "vector", block_rows: int = BLOCK_ROWS, point_block_rows: int = POINT_BLOCK_ROWS) -> DataFrame:
    """Partial lists ``(qid, id, raw)`` that hold the exact answer, with the points scored for it."""
    spark, dim, slack = index.sparkSession, model.dim, 10.0 ** -SCORE_DIGITS
    n, radius = cell_sizes(index, model) if sizes is None else sizes
    block = spark.sparkContext.broadcast((model.centroids, n, radius))
    asked = _queries(queries, model, qid_col, qvector)

    def exact(least_of, qids, unit, batches, first):
        cents, size, far = block.value
        t = np.arccos(np.clip(unit @ cents.T, -1.0, 1.0))
        if first:
            probe, prune = _probed(t, size, k), None
        else:
            reach = np.arccos(np.clip(least_of, -1.0, 1.0)) + ANGLE_SLACK
            probe, prune = (t - far <= reach[:, None]) & (size > 0), (least_of, t)
        yield from _scan(qids, cents, batches, probe, lambda col: _matrix(col, dim)[1], lambda x, who: x @ unit[who].T,
                         k, slack, prune)

    def begin(table):
        return lambda batches: exact(None, *_asked(table, dim), batches, True)

    def finish(table):
        def run(batches):
            qids, unit = _asked(table, dim)
            yield from exact(np.array(table["least"].to_pylist(), np.float64), qids, unit, batches, False)
        return run

    near = _hits(_against(index, "vector", asked, block_rows, point_block_rows, begin), k)
    # fewer than k hits in all: nothing can be ruled out
    least = near.groupBy("qid").agg(F.when(F.count(F.lit(1)) >= k, F.min("score") - F.lit(2 * slack)).otherwise(F.lit(-1.0)).alias("least"))
    bounded = asked.join(least, "qid", "left").select("qid", "qv", F.coalesce("least", F.lit(-1.0)).alias("least"))
    return _against(index, "vector", bounded, block_rows, point_block_rows, finish)


def search_exact(index: DataFrame, model: CellModel, queries: DataFrame, *, k: int = 10, **given) -> DataFrame:
    """Exact cosine top-k of every query, with pruning: ``(qid, rank, id, score)``."""
    return _hits(scan_exact(index, model, queries, k=k, **given), k)
