"""Shards along a Hilbert curve through several metadata dimensions.

Every dimension is quantised linearly between its smallest and largest value
(one aggregate for all), the cell of a row gives its index on a Hilbert curve,
and the rows in curve order are cut into runs. Neighbouring rows are close in
every dimension, so the minima and maxima of a file exclude it for range
filters on any of them.

Runs are cut by row count: shard sizes differ by one row at most (law ``rows``).
Equal cells are ordered by text checksum and id, so equal texts with equal
metadata lie next to each other; a hot cell is simply cut like any other run.

Defined results: NULL metadata takes the lowest cell of its dimension, NULL
text counts 0 bytes and checksum 0; rows that agree in every key are
interchangeable; fewer rows than shards leave shards empty; an empty table
gives no rows; further columns are carried only when named.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from simsift.llm.common import cut

BITS = 10
LOW33 = (1 << 33) - 1           # row part of monotonically_increasing_id


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points (rows of ``coords``), vectorised transpose form."""
    x = [c.astype(np.uint64) for c in coords.T]
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint64(q - 1)
        for i in range(dims):
            high = (x[i] & np.uint64(q)) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, dims):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & np.uint64(q)) != 0, t ^ np.uint64(q - 1), t)
        q >>= 1
    x = [v ^ t for v in x]
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = (out << np.uint64(1)) | ((v >> np.uint64(b)) & np.uint64(1))
    return out


def prefix_number(col: Column) -> Column:
    """Order-preserving number of a string: its first six bytes, big endian."""
    return F.conv(F.rpad(F.hex(F.substring(col.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 16 for the record."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 16


def default_dimensions(text: str = "text", key: str = "doc_id", source: str = "source", lang: str = "lang") -> dict[str, Column]:
    return {"source": prefix_number(F.col(source)), "lang": prefix_number(F.col(lang)),
            "size": F.log2(text_size(F.col(text))), "id": F.col(key).cast("double")}


def assign_shards(df: DataFrame, shards: int, dimensions: dict[str, Column] | None = None, text: str = "text",
                  key: str = "doc_id", carry: tuple[str, ...] = (), bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, curve) plus the carried columns."""
    dimensions = dimensions or default_dimensions(text, key)
    names = [f"__d{i}" for i in range(len(dimensions))]
    kept = [F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)]
    src = df.select(F.col(key).cast("bigint").alias("doc_id"), text_size(F.col(text)).alias("size"),
                    F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
                    *[F.coalesce(F.when(~F.isnan(c), c)).alias(n) for n, c in zip(names, dimensions.values())], *kept)
    ends = src.agg(*[f(n).alias(f"{n}{s}") for n in names for f, s in ((F.min, "lo"), (F.max, "hi"))]).collect()[0]
    cells = 1 << bits
    for n in names:
        lo, hi = ends[f"{n}lo"], ends[f"{n}hi"]
        if lo is None or hi <= lo:
            src = src.withColumn(n, F.lit(0))
        else:
            cell = F.floor((F.col(n) - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(cells)))
            src = src.withColumn(n, F.least(F.coalesce(cell, F.lit(0)), F.lit(cells - 1)).cast("int"))

    width = len(names)
    fixed = ["doc_id", "size", "text_crc32"]
    src = src.select(*fixed, *[F.col(n).cast("int").alias(n) for n in names], *[f"__c{i}" for i in range(len(carry))])
    out_schema = T.StructType([src.schema[c] for c in fixed] + [src.schema[f"__c{i}"] for i in range(len(carry))]
                              + [T.StructField("curve", T.LongType())])

    def curve(batches):
        for b in batches:
            coords = np.stack([b.column(3 + i).to_numpy(zero_copy_only=False) for i in range(width)], axis=1)
            h = hilbert_index(coords, bits).astype(np.int64)
            cols = [b.column(i) for i in range(3)] + [b.column(i) for i in range(3 + width, b.num_columns)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(h, pa.int64())], out_schema.names)

    order = ["curve", "text_crc32", "size", "doc_id"]
    placed = cut(src.mapInArrow(curve, out_schema).repartitionByRange(*order).sortWithinPartitions(*order))
    # one row per partition reaches the driver
    counts = {r["p"]: r["n"] for r in
              placed.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    base, total = [], 0
    for p in sorted(counts):
        base.append((p, total))
        total += counts[p]
    offsets = df.sparkSession.createDataFrame(base, "__p int, __base bigint")
    at = (placed.withColumn("__p", F.spark_partition_id())
          .withColumn("__i", F.monotonically_increasing_id().bitwiseAND(F.lit(LOW33)))
          .join(F.broadcast(offsets), "__p").withColumn("__i", F.col("__i") + F.col("__base")))
    shard = F.expr(f"cast(__i * {shards} div {max(total, 1)} as int)")
    first = F.expr(f"(shard * {max(total, 1)} + {shards - 1}) div {shards}")
    return at.withColumn("shard", shard).withColumn("slot", F.col("__i") - first).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)])


def write_shards(df: DataFrame, path: str, shards: int, **options) -> None:
    """Write one directory per shard, rows in curve order, with every column of ``df`` but clashing ones."""
    made = {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve"}
    carry = tuple(c for c in df.columns if c not in made)
    out = assign_shards(df, shards, carry=carry, **options).drop("law", "grown_shard")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").mode("overwrite").parquet(path)
