"""Positions and chained digests of rows within a key, for keys of any size.

Rows are sorted over the whole cluster by key and order, so that a key may span
many partitions; each partition numbers and chains its rows as they stream by,
and only the first key of a partition can need what came before it. The driver
sees one row per partition (its first and last key with their last number), never
a row per key.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.llm.common import fresh_path

#: Digests are chained as a polynomial over the field of this prime: pieces of a chain can be joined.
PRIME, BASE = (1 << 127) - 1, 0x5D1E_9C3B_A7F4_2268_B391_07D6_4C85_EF13 % ((1 << 127) - 1)


def _numbering(key: str, digest: str | None):
    """Arrow function that adds ``_i`` (number within the key in this partition), ``_first`` and the chain."""

    def chain(values, state, up, out):
        for v in values:
            up.append(format(state, "032x"))
            state = (state * BASE + int(v[:32], 16) + 1) % PRIME
            out.append(format(state, "032x"))
        return state

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        last, n, state, first_over, begun = None, 0, 0, False, False
        for rb in batches:
            if not rb.num_rows:
                continue
            keys = rb.column(rb.schema.get_field_index(key))
            codes = keys.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(codes)) + 1
            index, first = np.empty(rb.num_rows, np.int64), np.zeros(rb.num_rows, bool)
            values = rb.column(rb.schema.get_field_index(digest)).to_pylist() if digest else None
            up, out = [], []
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, rb.num_rows]):
                k = keys[int(a)].as_py()
                if not begun or k != last:
                    first_over, n, state = begun, 0, 0
                    last, begun = k, True
                index[a:b] = np.arange(n, n + b - a)
                first[a:b] = not first_over
                n += int(b - a)
                if digest:
                    state = chain(values[a:b], state, up, out)
            extra = [pa.array(np.full(rb.num_rows, pid, np.int32)), pa.array(index), pa.array(first)]
            names = [*rb.schema.names, "_pid", "_i", "_first"]
            if digest:
                extra += [pa.array(up, pa.string()), pa.array(out, pa.string())]
                names += ["_up", "_chain"]
            yield pa.RecordBatch.from_arrays([*rb.columns, *extra], names=names)

    return run


def _carry(edges, digest: bool) -> dict[int, tuple[int, int]]:
    """Per partition whose first key began before it: rows and chain of that key so far."""
    out, held = {}, None
    for e in sorted(edges, key=lambda e: e["_pid"]):
        n, state = e["head"]["_i"] + 1, int(e["head"]["_chain"], 16) if digest else 0
        if held is not None and held[0] == e["first_key"]:
            out[e["_pid"]] = held[1:]
            n, state = n + held[1], (held[2] * pow(BASE, n, PRIME) + state) % PRIME
        if e["all_first"]:
            held = (e["first_key"], n, state)
        else:
            held = (e["tail"]["key"], e["tail"]["_i"] + 1, int(e["tail"]["_chain"], 16) if digest else 0)
    return out


def _moved(carry, digest: str):
    """Arrow function that joins the pieces of chains begun in earlier partitions."""

    def run(batches):
        for rb in batches:
            table = rb.to_pydict()
            for r, (pid, i) in enumerate(zip(table["_pid"], table["_i"])):
                n, state = carry.value[pid]
                table["_i"][r] = n + i
                for name, k in (("_up", i), ("_chain", i + 1)):
                    table[name][r] = format((state * pow(BASE, k, PRIME) + int(table[name][r], 16)) % PRIME, "032x")
            yield pa.RecordBatch.from_pydict(table, schema=rb.schema)

    return run


def numbered(rows: DataFrame, key: str, order: list, *, digest: str | None = None, label: str = "ordered",
             partitions: int | None = None) -> tuple[DataFrame, str]:
    """``rows`` with ``pos`` (from 0 within ``key``, by ``order``) in a written table, and that table's path.

    With ``digest`` (a column of at least 32 hex digits) also ``chain``, which is equal
    for equal sequences of digests up to a row and, in practice, only for these, and
    ``up``, the chain before the row; columns of these names are replaced. NULL is a key of its own and comes first. Rows
    that tie in ``order`` get numbers in any sequence. A lost executor changes
    nothing: the written table fixes which rows a partition holds.
    """
    spark = rows.sparkSession
    by = [F.col(key).asc_nulls_first(), *order]
    dealt = rows.repartitionByRange(partitions, *by) if partitions else rows.repartitionByRange(*by)
    dealt = dealt.sortWithinPartitions(*by)
    extra = "_pid int, _i bigint, _first boolean" + (", _up string, _chain string" if digest else "")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", " + extra
    path = fresh_path(spark, label)
    dealt.mapInArrow(_numbering(key, digest), schema).write.parquet(path)
    done = spark.read.parquet(path)
    chain = F.col("_chain") if digest else F.lit("")
    number = F.struct("_i", chain.alias("_chain"))
    rest = ~F.col("_first")
    edges = done.groupBy("_pid").agg(
        F.min_by(F.struct(F.col(key).alias("key")), F.struct(~F.col("_first"), F.col("_i")))["key"].alias("first_key"),
        F.max(F.when(F.col("_first"), number)).alias("head"),
        F.min("_first").alias("all_first"),
        F.max(F.when(rest, F.struct(F.col(key).alias("key"), F.col("_i"), chain.alias("_chain")))).alias("tail"))
    carry = _carry(edges.collect(), digest is not None)               # one row per partition
    if carry and digest:
        late = F.col("_first") & F.col("_pid").isin(list(carry))
        done = done.where(~late).unionByName(
            done.where(late).mapInArrow(_moved(spark.sparkContext.broadcast(carry), digest), schema))
    elif carry:
        before = spark.createDataFrame([(p, c[0]) for p, c in carry.items()], "_pid int, _n bigint")
        done = done.join(F.broadcast(before), "_pid", "left").withColumn(      # one row per partition at most
            "_i", F.col("_i") + F.when(F.col("_first"), F.coalesce("_n", F.lit(0))).otherwise(F.lit(0)))
    added = ("pos", "up", "chain") if digest else ("pos",)
    names = [F.col(c) for c in rows.columns if c not in added] + [F.col("_i").alias("pos")]
    if digest:
        names += [F.col("_up").alias("up"), F.col("_chain").alias("chain")]
    return done.select(*names), path
