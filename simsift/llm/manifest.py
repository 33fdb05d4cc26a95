"""Merkle manifest of a data set, by butterfly exchange.

Rows of a group in their order are the leaves of a tree of fan-out 8; the roots of
all groups in their order are the leaves of a second one. A group is cut into
aligned blocks of 8^4 leaves, and each block hashes its own subtree once. The
blocks then exchange roots round by round like a butterfly: in round r a block
meets the blocks that differ from it in the r-th base-8 digit of its number, takes
their roots, and hashes the common ancestor itself. Ancestors are so hashed once
by every block below them; after the last round each block holds the siblings of
its whole path to the root, and no pass goes down the tree.

Where a block's counterpart lies beyond the ragged end of a group, another block
of the same aligned run stands in (its number within the run modulo the run's
length), so that no block serves more than its share.

Every digest is lowercase hex sha256 of the concatenated inputs, digests as hex
text. A run of one node is hashed too, as long as its level has more than one node.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsift.llm.common import cut, drop_path, fresh_path, sized_broadcast
from simsift.llm.ordered import numbered

FANOUT = 8
# Levels of one block: a block has FANOUT ** BLOCK_LEVELS leaves.
BLOCK_LEVELS = 4
_STEP = pa.struct([("at", pa.int32()), ("run", pa.list_(pa.string()))])
_STEPS = "array<struct<at:int,run:array<string>>>"


def encoded(value: Column) -> Column:
    """``-`` for NULL, else UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """Digest of the encoded values of a row, one after another."""
    return F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256)


def _hash(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(hashes, levels):
    """All levels of a subtree, the leaves first: ``levels`` times every run of 8 becomes its digest."""
    tree = [hashes]
    for _ in range(levels):
        below = tree[-1]
        tree.append([_hash(below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return tree


def _height(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    h = 0
    while n > 1:
        n, h = -(-n // FANOUT), h + 1
    return h


def _path(tree, i):
    """``(place in its run, digests of the run)`` from leaf ``i`` up to the subtree's root."""
    out = []
    for level in tree[:-1]:
        out.append((i % FANOUT, level[i - i % FANOUT:i - i % FANOUT + FANOUT]))
        i //= FANOUT
    return out


def _fold(node, path):
    """What ``node`` in the place of its path's first digest makes of the root."""
    for at, run in path:
        node = _hash([*run[:at], node, *run[at + 1:]])
    return node


def _subtree(rows, levels):
    """Rows of one block in order, and all levels of its subtree."""
    rows = rows.sort_by("pos")
    return rows, _levels(rows["leaf"].to_pylist(), min(levels, _height(rows["n"][0].as_py())))


def _root(levels):
    def run(rows):
        rows, tree = _subtree(rows, levels)
        return pa.table({"g": rows["g"][:1], "block": rows["block"][:1], "n": rows["n"][:1],
                         "node": pa.array([tree[-1][0]], pa.string())})

    return run


def _above(state):
    return [(u["at"], u["run"]) for u in state["upper"][0].as_py()]


def exchange(blocks: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Rounds of the butterfly: (g, block, n, node) of block roots gain ``root`` and ``upper``.

    ``n`` is the number of leaves of the group. ``upper`` lists, level by level, the
    place of the block's ancestor in its run and all digests of that run. Each round is one join on (g, sender) of at most
    8 requests a block, and one grouping of at most 8 rows a block; rounds grow with
    the logarithm of the blocks of the largest group. The driver sees one number.
    """
    state = blocks.select("g", "block", F.ceil(F.col("n") / F.lit(FANOUT ** levels)).cast("bigint").alias("m"), "node",
                          F.array().cast(_STEPS).alias("upper"))
    largest = state.agg(F.max("m")).first()[0] or 0
    for r in range(_height(largest)):
        below = F.lit(FANOUT ** r).cast("bigint")                     # blocks under one node of this level
        node = F.floor(F.col("block") / below)
        base = F.floor(node / FANOUT) * FANOUT                       # first node of the aligned run
        live = state.where(F.col("m") > below)
        start = F.col("other") * below
        width = F.least(below, F.col("m") - start)                   # blocks under the other node
        asked = (live.select("g", "block", "m", F.explode(F.sequence(
                     base, F.least(base + F.lit(FANOUT - 1), F.floor((F.col("m") - 1) / below)))).alias("other"))
                 .select("g", "block", "other", (start + F.col("block") % width).alias("sender")))
        got = (asked.join(live.select("g", F.col("block").alias("sender"), "node"), ["g", "sender"])
               .groupBy("g", "block").agg(F.array_sort(F.collect_list(F.struct("other", "node"))).alias("run")))   # at most 8
        run = F.transform("run", lambda x: x["node"])
        met = live.join(got, ["g", "block"]).select(
            "g", "block", "m", F.sha2(F.concat_ws("", run).cast("binary"), 256).alias("node"),
            F.array_append("upper", F.struct((node - base).cast("int").alias("at"), run.alias("run"))).alias("upper"))
        state = cut(state.where(F.col("m") <= below).unionByName(met))
    return state.select("g", "block", F.col("node").alias("root"), "upper")


def _paths(levels):
    """Cogrouped function: the whole path of every leaf of a block, with its root."""

    def run(rows, state):
        rows, tree = _subtree(rows, levels)
        above = _above(state)
        paths = [[{"at": at, "run": r} for at, r in _path(tree, i) + above] for i in range(rows.num_rows)]
        return pa.table({"pos": rows["pos"], "leaf": rows["leaf"],
                         "root": pa.array([state["root"][0].as_py()] * rows.num_rows, pa.string()),
                         "path": pa.array(paths, pa.list_(_STEP))})

    return run


def _proofs(levels):
    """Cogrouped function: proof digest and folded root of every row of a block."""

    def run(rows, state):
        rows, tree = _subtree(rows, levels)
        above = _above(state)
        upper = "".join("".join(r[:at] + r[at + 1:]) for at, r in above)
        proofs, folded = [], []
        for i, claimed in enumerate(rows["claimed"].to_pylist()):
            path = _path(tree, i)
            proofs.append(_hash(["".join(r[:at] + r[at + 1:]) for at, r in path] + [upper]))
            folded.append(_fold(claimed, path + above))
        same = [pa.array([state[c][0].as_py()] * rows.num_rows, pa.string()) for c in ("subroot", "root")]
        return pa.table([rows["id"], rows["leaf"], *same, pa.array(proofs, pa.string()), pa.array(folded, pa.string())],
                        names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    return run


def _climb(leaves: DataFrame, levels: int) -> tuple[DataFrame, DataFrame]:
    """(g, pos, n, leaf, ...) with its ``block``, and (g, block, root, upper) of every block."""
    dealt = leaves.withColumn("block", F.floor(F.col("pos") / F.lit(FANOUT ** levels)))
    roots = dealt.select("g", "block", "n", "pos", "leaf").groupBy("g", "block").applyInArrow(
        _root(levels), "g bigint, block bigint, n bigint, node string")
    return dealt, exchange(cut(roots), levels)


def manifest(rows: DataFrame, group: Column, hashed: Column, claimed: Column, *,
             id_col: str = "doc_id", levels: int = BLOCK_LEVELS) -> DataFrame:
    """Manifest of all rows: (id, leaf, subroot, root, proof_sha256, folded_root, verified).

    ``group`` names a row's subtree (NULL is a group of its own, the first; others in
    byte order); in it leaves ascend by id (NULL first), then by digest. ``hashed`` is a
    row's digest and ``claimed`` the one that is checked against its siblings:
    ``proof_sha256`` is the digest of all siblings from the leaf to the root,
    ``folded_root`` what ``claimed`` makes of the root.

    Every input row is a leaf: repeated rows and ids, NULL ids, NULL, empty and very
    long texts included. Rows that tie in id and digest are equal leaves and differ in
    their proofs only. An empty table has no rows. Texts are hashed where they are
    read; only digests and ids are shuffled, and no task holds more than a block.
    Columns of the input other than those named are ignored.
    """
    lean = rows.select(F.col(id_col).cast("bigint").alias("id"), F.hex(group.cast("string").cast("binary")).alias("grp"),
                       hashed.alias("leaf"), claimed.alias("claimed"))       # hex digits sort like bytes
    held = fresh_path(rows.sparkSession, "manifest-leaves")
    lean.write.parquet(held)                                     # the sort samples its input; texts are hashed once
    at, _ = numbered(rows.sparkSession.read.parquet(held), "grp", [F.col("id").asc_nulls_first(), F.col("leaf"), F.col("claimed")],
                     label="manifest")
    drop_path(rows.sparkSession, held)
    sizes = at.groupBy("grp").agg((F.max("pos") + 1).alias("n")).withColumn("all", F.lit(0))
    groups, path = numbered(sizes, "all", [F.col("grp").asc_nulls_first()], label="manifest-groups")
    groups = cut(groups.select(F.col("pos").alias("g"), F.col("grp").alias("name"), "n"))
    drop_path(rows.sparkSession, path)
    leaves = at.join(sized_broadcast(groups, 300), F.col("grp").eqNullSafe(F.col("name"))).drop("grp", "name")
    dealt, state = _climb(leaves, levels)

    # the roots of the groups are the leaves of one more tree
    count = F.lit(groups.count()).cast("bigint")
    tops, met = _climb(state.where("block = 0").select(F.lit(0).cast("bigint").alias("g"), F.col("g").alias("pos"), count.alias("n"),
                                                       F.col("root").alias("leaf")), levels)
    paths = cut(tops.groupBy("g", "block").cogroup(met.groupBy("g", "block")).applyInArrow(
        _paths(levels), f"pos bigint, leaf string, root string, path {_STEPS}")
        .select(F.col("pos").alias("g"), F.col("leaf").alias("subroot"), "root", "path"))
    # each block adds the path above its group to its own
    state = state.drop("root").join(sized_broadcast(paths, 4096), "g").select(
        "g", "block", "subroot", "root", F.concat("upper", "path").alias("upper"))
    return (dealt.groupBy("g", "block").cogroup(state.groupBy("g", "block")).applyInArrow(
        _proofs(levels), "id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
        .withColumnRenamed("id", id_col).withColumn("verified", F.col("folded_root") == F.col("root")))
