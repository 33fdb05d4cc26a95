"""Idempotent loads: upsert by id, completeness by anti-join, vector profile (SNK-1/5/7/9).

Upsert contract: per id the row with the highest ``seq`` wins and replaces the
whole row; identical repeats collapse (a replayed batch changes nothing); two
*different* rows with the same ``(id, seq)`` are a conflict and are rejected.

Winners are decided on narrow rows ``(id, seq, h)`` with ``h`` the hash of the
row: two hash aggregates with map-side partial aggregation, so an id holding a
third of all updates is collapsed inside every map task. Only then the winning
rows themselves are picked by a join on the three, and exact repeats of a winner
(counted on the way) are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class UpsertConflict(ValueError):
    pass


def _hashed(rows: DataFrame, id_col: str, seq_col: str) -> DataFrame:
    return rows.withColumn("_h", F.xxhash64(*[F.col(c) for c in rows.columns]))


def _winners(rows: DataFrame, id_col: str, seq_col: str) -> DataFrame:
    """Narrow ``(_id, _seq, _lo, _hi, _n)``: per id its top seq, the hash range and number of rows there."""
    per_seq = _hashed(rows, id_col, seq_col).groupBy(F.col(id_col).alias("_id"), F.col(seq_col).alias("_seq")).agg(
        F.min("_h").alias("_lo"), F.max("_h").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    top = per_seq.groupBy(F.col("_id").alias("_top_id")).agg(F.max("_seq").alias("_top_seq"))
    return per_seq.join(top, F.col("_id").eqNullSafe(F.col("_top_id")) & F.col("_seq").eqNullSafe(F.col("_top_seq"))) \
        .select("_id", "_seq", "_lo", "_hi", "_n")


def _conflict() -> Column:
    return F.col("_lo") != F.col("_hi")


def upsert(old: DataFrame | None, new: DataFrame, *, id_col: str = "id", seq_col: str = "seq",
           check: bool | str = True) -> DataFrame:
    """Merged table: latest row per id.

    ``check=True`` runs the conflict check eagerly (one extra job) and raises
    ``UpsertConflict``; ``check="lazy"`` folds it into the result: the id column
    is ``raise_error`` on a conflicting row, so whatever consumes the result
    (e.g. the versioned commit) fails in the same single pass, before any
    switch; ``check=False`` skips it.
    """
    rows = new if old is None else old.unionByName(new, allowMissingColumns=True)
    win = _winners(rows, id_col, seq_col)
    if check is True:
        bad = win.where(_conflict()).select("_id").limit(5).collect()
        if bad:
            raise UpsertConflict(f"different rows share (id, seq) for ids {[b[0] for b in bad]}")
    if check == "lazy":
        win = win.withColumn("_hi", F.when(_conflict(), F.raise_error(F.concat(
            F.lit("upsert conflict: different rows share (id, seq) for id "), F.col("_id").cast("string"))).cast("long"))
            .otherwise(F.col("_hi")))
    best = _hashed(rows, id_col, seq_col).join(
        win, F.col(id_col).eqNullSafe(F.col("_id")) & F.col(seq_col).eqNullSafe(F.col("_seq"))
        & (F.col("_h") == F.col("_hi")))
    once = best.where(F.col("_n") == 1).select(*rows.columns)
    repeated = best.where(F.col("_n") > 1).dropDuplicates([id_col]).select(*rows.columns)
    return once.unionByName(repeated)


def conflicts(old: DataFrame | None, new: DataFrame, *, id_col: str = "id", seq_col: str = "seq") -> DataFrame:
    rows = new if old is None else old.unionByName(new, allowMissingColumns=True)
    return _winners(rows, id_col, seq_col).where(_conflict()).select(F.col("_id").alias(id_col), F.col("_seq").alias(seq_col))


def one_row_per_id(rows: DataFrame, *, id_col: str = "id") -> DataFrame:
    """Identical repeats collapse; two different rows for one id fail whatever consumes the result."""
    return upsert(None, rows.withColumn("_one", F.lit(0).cast("long")), id_col=id_col, seq_col="_one",
                  check="lazy").drop("_one")


def load_missing(new: DataFrame, existing: DataFrame, *, id_col: str = "id") -> DataFrame:
    """SNK-5: rows of ``new`` whose id is absent from ``existing`` (crash-safe resume)."""
    return new.join(existing.select(id_col), on=id_col, how="left_anti")


def vector_profile(df: DataFrame, vectors: Sequence[str], *, digits: int = 6) -> DataFrame:
    """SNK-9/FLT-7: per vector column rows, nulls, dim range, zero norms, norm range.

    The vector columns are stacked into a long ``(vector, v)`` form so one
    aggregation profiles all of them.
    """
    from simsift.functions.vectors import norm

    arms = F.array(*[F.struct(F.lit(v).alias("vector"), F.col(v).cast("array<double>").alias("v"))
                     for v in vectors])
    long = df.select(F.inline(arms)).withColumn("_n", norm("v"))
    return long.groupBy("vector").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("v").isNull()).alias("nulls"),
        F.min(F.size("v")).alias("min_dim"),
        F.max(F.size("v")).alias("max_dim"),
        F.count_if(F.col("_n") == 0).alias("zero_norm"),
        F.round(F.min("_n"), digits).alias("min_norm"),
        F.round(F.max("_n"), digits).alias("max_norm"))
