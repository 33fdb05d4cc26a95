"""Timing tables and their summary (AGG-1/2).

A timings table is ``(variant, run, ms)``. ``timing_summary`` gives per-variant
run count, mean, min and max (one aggregate, partial before the shuffle;
no per-variant list is collected). ``variant_summary`` pivots three named
variants into one row with the speed-up of the indexed variant over the
unindexed one and each filter overhead over the baseline, all 0 unless both
filtered means are positive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def timing_summary(timings: DataFrame, *, variant: str = "variant", ms: str = "ms") -> DataFrame:
    return timings.groupBy(variant).agg(
        F.count(F.lit(1)).alias("runs"), F.round(F.avg(ms), 6).alias("mean_ms"),
        F.min(ms).alias("min_ms"), F.max(ms).alias("max_ms"))


def variant_summary(timings: DataFrame, *, baseline: str, unindexed: str, indexed: str,
                    variant: str = "variant", ms: str = "ms") -> DataFrame:
    names = [baseline, unindexed, indexed]
    p = timings.where(F.col(variant).isin(names)).groupBy().pivot(variant, names).agg(F.avg(ms))
    b, u, i = F.col(f"`{baseline}`"), F.col(f"`{unindexed}`"), F.col(f"`{indexed}`")
    ok = (u > 0) & (i > 0)
    return p.select(
        F.round(b, 6).alias("baseline_ms"), F.round(u, 6).alias("unindexed_ms"), F.round(i, 6).alias("indexed_ms"),
        F.round(F.when(ok, u / i).otherwise(F.lit(0.0)), 6).alias("index_speedup"),
        F.round(F.when(ok, u - b).otherwise(F.lit(0.0)), 6).alias("overhead_unindexed_ms"),
        F.round(F.when(ok, i - b).otherwise(F.lit(0.0)), 6).alias("overhead_indexed_ms"))
