"""Sequential ids in a total order (PRJ-3) without a single-partition window.

Two passes over a range-partitioned, locally sorted copy of the input:
1. every partition is sorted by the key and numbered locally
   (``monotonically_increasing_id`` is consecutive inside a partition);
2. rows per partition (one row per partition) give prefix offsets, broadcast
   back (the offsets table has as many rows as partitions).

The ranged copy is checkpointed to the cluster's checkpoint folder first: range
bounds come from sampling, so recomputing the copy for the second pass could
move rows between partitions. The checkpoint also makes the job restartable.
Prefer stable content ids (``functions.text.point_id``) wherever order is not
the point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from simsift.session import checkpoint_dir


def sequential_ids(df: DataFrame, order_by: list[str], *, name: str = "row_id",
                   start: int = 0, partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    checkpoint_dir(spark)
    count = [partitions] if partitions else []            # unset: sized by Spark
    ranged = (df.repartitionByRange(*count, *order_by).sortWithinPartitions(*order_by)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_local", F.monotonically_increasing_id()
                            - F.shiftleft(F.spark_partition_id().cast("long"), 33))
                .checkpoint(eager=True))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
                     .select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off")))
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, F.col("_off") + F.col("_local") + F.lit(start))
                  .drop("_pid", "_local", "_off"))
