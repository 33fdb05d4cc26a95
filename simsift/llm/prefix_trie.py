"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns. Turns are digested where they are
read; a sequence is named by its depth and the chain of its turns' digests
(:mod:`simsift.llm.ordered`), so nodes are found by one aggregate whatever the
length of a conversation, and a parent is named by the chain before a turn.

Sums over subtrees come from a centroid decomposition of the parent edges. The
mass of a node, the number of (conversation, turn) rows at or below it, is known
from the same aggregate. In each component the nodes with at least half of its
mass form the path from its top down to a centroid: what lies at or below the
centroid is summed once and added along that path, then the centroid is taken out
and every part goes on by itself. A component loses at least half of its mass in
each part below the centroid and above it, so the rounds grow with the logarithm
of the rows, not with the depth. Which part a node falls into follows from the
prefix of its own smallest conversation at the depth below the centroid. Components
of at most ``LOCAL_MASS`` rows are finished by the same steps within a task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsift.llm.common import cut, drop_path, sized_broadcast
from simsift.llm.ordered import numbered

# Mass up to which a component is finished within one task.
LOCAL_MASS = 1 << 15
# Turns of a conversation that share one salt.
TURN_BLOCK = 1 << 16
# Bytes of joined ids that one row carries to its digest.
JOINED_BYTES = 1 << 20
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def turn_digest(*values: Column) -> Column:
    """Digest of a turn's values; NULL reads as empty."""
    parts = [F.coalesce(v.cast("string"), F.lit("")) for v in values]
    return F.sha2(F.concat(*[x for p in parts for x in (F.octet_length(p).cast("string"), F.lit(":"), p)]).cast("binary"), 256)


def _id(depth: Column, chain: Column) -> Column:
    return F.concat(depth.cast("string"), F.lit("-"), chain)


def prefixes(turns: DataFrame, order: list[Column], *, conv_col: str = "conv_id") -> tuple[DataFrame, str]:
    """(conv_id, depth, words, id, up): every prefix of every conversation, in a written table, and its path.

    ``turns`` has the conversation, a ``digest`` and ``words`` of each turn, and what
    ``order`` needs. ``id`` names the sequence of the first ``depth`` turns, ``up`` the one
    before; equal sequences have equal names.
    """
    rows, path = numbered(turns, conv_col, order, digest="digest", label="trie-turns")
    depth = F.col("pos") + 1
    rows = rows.select(F.col(conv_col).alias("conv_id"), depth.alias("depth"), "words",
                       _id(depth, F.col("chain")).alias("id"), _id(F.col("pos"), F.col("up")).alias("up"))
    return rows, path


ROOT = "0-" + "0" * 32


def trie(steps: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie.

    ``steps`` comes from :func:`prefixes`, ``convs`` lists every conv_id once, turnless
    ones too. Nodes: (id, up, depth, conv_id, n_convs, mass, words, n_children); ends:
    (conv_id, id), the node where a conversation ends.
    """
    last = steps.groupBy("conv_id").agg(F.max("depth").alias("length"), F.max_by("id", "depth").alias("id"))
    last = cut(convs.select("conv_id").join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("length", F.lit(0)).alias("length"), F.coalesce("id", F.lit(ROOT)).alias("id")))
    block = F.floor(F.col("depth") / TURN_BLOCK)
    blocks = last.where("length > 0").select("conv_id", "length", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("length") / TURN_BLOCK))).alias("block"))
    below = F.col("length") - F.col("depth") + 1
    nodes = (steps.withColumn("block", block).join(blocks, ["conv_id", "block"])
             .groupBy("id", "up", "depth").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                                               F.sum(below).alias("mass"), F.max("words").alias("words")))
    root = last.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
                    (F.sum("length") + F.count(F.lit(1))).alias("mass")).where("n_convs > 0").select(
        F.lit(ROOT).alias("id"), F.lit(None).cast("string").alias("up"), F.lit(0).cast("bigint").alias("depth"),
        "conv_id", "n_convs", "mass", F.lit(0).cast("bigint").alias("words"))
    nodes = cut(nodes.unionByName(root))
    children = nodes.groupBy(F.col("up").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = cut(nodes.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    return nodes, last.select("conv_id", "id")


def _finish(columns):
    """Arrow function: centroid decomposition of every component of a partition sorted by component and depth."""
    k = len(columns)

    def solve(ids, ups, mass, sums):
        """Adds to ``sums`` what lies below each node; the first node is the top."""
        place = {v: i for i, v in enumerate(ids)}
        parent = [place.get(u, -1) for u in ups]
        parent[0] = -1
        children = [set() for _ in ids]
        for i, p in enumerate(parent):
            if p >= 0:
                children[p].add(i)
        own = [list(s) for s in sums]
        todo = [0]
        while todo:
            top = todo.pop()
            path, at = [], top
            while True:                                  # down the nodes with at least half of the mass
                heavy = next((c for c in children[at] if 2 * mass[c] >= mass[top]), None)
                if heavy is None:
                    break
                path.append(at)
                at = heavy
            total, below = [0] * k, list(children[at])
            for v in below:
                below.extend(children[v])
                for j in range(k):
                    total[j] += own[v][j]
            for j in range(k):
                sums[at][j] += total[j]
                total[j] += own[at][j]
            for v in path:
                mass[v] -= mass[at]
                for j in range(k):
                    sums[v][j] += total[j]
            todo.extend(children[at])
            if path:
                children[parent[at]].discard(at)
                todo.append(top)
            children[at] = set()
        return sums

    def run(batches):
        held = None

        def done(held):
            out = solve(held["id"], held["up"], held["mass"], [list(s) for s in zip(*(held[c] for c in columns))])
            arrays = [pa.array(held["id"], pa.string())]
            for j, c in enumerate(columns):
                arrays.append(pa.array([a + s[j] for a, s in zip(held["_" + c], out)], pa.int64()))
            return pa.RecordBatch.from_arrays(arrays, names=["id", *columns])

        names = ["id", "up", "mass", *columns, *["_" + c for c in columns]]
        for rb in batches:
            rows = rb.to_pydict()
            for r, comp in enumerate(rows["comp"]):
                if held is None or held["comp"] != comp:
                    if held is not None:
                        yield done(held)
                    held = {"comp": comp, **{c: [] for c in names}}
                for c in names:
                    held[c].append(rows[c][r])
        if held is not None:
            yield done(held)

    return run


def rollup(nodes: DataFrame, steps: DataFrame, columns: list[str], *, local_mass: int = LOCAL_MASS) -> DataFrame:
    """(id, columns...): each of ``columns`` summed over the subtree of every node.

    ``nodes`` has id, up, depth, conv_id and mass (see :func:`trie`); ``steps`` finds the
    ancestor of a node at a depth through its conversation. Each round handles all
    components above ``local_mass`` at once, with a few joins and pre-aggregated
    sums; the driver sees one number a round.
    """
    extra = ["_" + c for c in columns]                  # what is added from below: path sums
    lean = nodes.select("id", "up", "depth", "conv_id", "mass", *columns, *[F.lit(0).cast("bigint").alias(e) for e in extra],
                        F.lit(ROOT).alias("comp"))
    settled, small, live = [], [], lean
    ancestors = steps.select("conv_id", "depth", F.col("id").alias("part"), F.col("up").alias("over"))
    while True:
        live = _with_total(live)
        here = cut(live)
        small.append(here.where(F.col("total") <= local_mass).drop("total"))
        large = here.where(F.col("total") > local_mass)
        if large.limit(1).count() == 0:
            break
        heavy = F.col("mass") * 2 >= F.col("total")
        centroid = (large.where(heavy).groupBy("comp").agg(
            F.min_by(F.struct("id", "depth", "mass"), F.col("mass")).alias("c"))
            .select("comp", F.col("c.id").alias("c_id"), F.col("c.depth").alias("c_depth"), F.col("c.mass").alias("c_mass")))
        at = cut(large.join(sized_broadcast(cut(centroid), 300), "comp"))
        # the part of a node below the centroid: its ancestor just below it
        deeper = at.where(F.col("depth") > F.col("c_depth"))
        asked = deeper.select("conv_id", (F.col("c_depth") + 1).alias("depth"), "c_id").distinct()
        parts = (asked.join(ancestors, ["conv_id", "depth"]).where(F.col("over") == F.col("c_id"))
                 .select(F.col("conv_id").alias("p_conv"), F.col("c_id").alias("p_id"), "part"))
        deeper = deeper.join(parts, (F.col("conv_id") == F.col("p_conv")) & (F.col("c_id") == F.col("p_id")),
                             "left").drop("p_conv", "p_id")
        split = cut(deeper.unionByName(at.where(F.col("depth") <= F.col("c_depth")).withColumn("part", F.lit(None).cast("string"))))
        is_centroid = F.col("id") == F.col("c_id")
        below = F.col("part").isNotNull()
        sums = (split.where(below | is_centroid).groupBy("comp").agg(
            *[F.sum(F.when(below, F.col(c)).otherwise(F.lit(0))).alias("t" + c) for c in columns],
            *[F.sum(F.when(is_centroid, F.col(c)).otherwise(F.lit(0))).alias("o" + c) for c in columns]))
        known = split.join(sized_broadcast(cut(sums), 200), "comp")
        settled.append(known.where(is_centroid).select("id", *[(F.col(c) + F.col("_" + c) + F.col("t" + c)).alias(c) for c in columns]))
        on_path = (F.col("mass") * 2 >= F.col("total")) & ~below
        added = [F.when(on_path, F.col("_" + c) + F.col("t" + c) + F.col("o" + c)).otherwise(F.col("_" + c)).alias("_" + c)
                 for c in columns]
        live = known.where(~is_centroid).select(
            "id", "up", "depth", "conv_id", F.when(on_path, F.col("mass") - F.col("c_mass")).otherwise(F.col("mass")).alias("mass"),
            *columns, *added, F.coalesce("part", "comp").alias("comp"))
    rest = small[0]
    for s in small[1:]:
        rest = rest.unionByName(s)
    names = ["comp", "id", "up", "mass", *columns, *extra]
    out = (rest.select(*names, "depth").repartition("comp").sortWithinPartitions("comp", "depth").select(*names)
           .mapInArrow(_finish(columns), "id string, " + ", ".join(f"{c} bigint" for c in columns)))
    for s in settled:
        out = out.unionByName(s)
    return out


def _with_total(live: DataFrame) -> DataFrame:
    """Nodes with the mass of their component (that of its top, the largest in it)."""
    totals = cut(live.groupBy("comp").agg(F.max("mass").alias("total")))
    return live.join(sized_broadcast(totals, 150), "comp")


def _joined(batches):
    """Ids of a node in order, joined by commas into rows of about ``JOINED_BYTES``."""
    held, n, first, at = [], 0, None, None

    def row():
        return pa.RecordBatch.from_pydict({"id": [at], "first": [first], "ids": [",".join(held)]},
                                          schema=pa.schema([("id", pa.string()), ("first", pa.int64()), ("ids", pa.string())]))

    for rb in batches:
        for node, conv in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
            if node != at or n > JOINED_BYTES:
                if held:
                    yield row()
                held, n, first, at = [], 0, conv, node
            held.append(str(conv))
            n += len(held[-1]) + 1
    if held:
        yield row()


def _digests(batches):
    """sha256 of the pieces of each node, streamed in order."""
    at, state, out = None, None, ([], [])

    def close():
        if state is not None:
            out[0].append(at)
            out[1].append(state.hexdigest())

    for rb in batches:
        for node, ids in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
            if node != at:
                close()
                at, state = node, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string())], names=["id", "ends_sha256"])
        out = ([], [])
    close()
    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string())], names=["id", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(id, ends_sha256) of every node where conversations end: their ids, ascending, comma-joined.

    Ids are sorted over the cluster, so those of a hot node lie in many partitions;
    each joins its own to pieces of about a megabyte, and the task that digests a node
    streams its pieces.
    """
    pieces = (ends.select("id", "conv_id").repartitionByRange("id", "conv_id").sortWithinPartitions("id", "conv_id")
              .mapInArrow(_joined, "id string, first bigint, ids string"))
    return (pieces.repartition("id").sortWithinPartitions("id", "first").select("id", "ids")
            .mapInArrow(_digests, "id string, ends_sha256 string"))


def prefix_trie(turns: DataFrame, order: list[Column], convs: DataFrame, *, local_mass: int = LOCAL_MASS) -> DataFrame:
    """Every node of the trie of the conversations ``convs`` with their ``turns``.

    ``turns``: (conv_id, digest, words, ...), ordered within a conversation by ``order``.
    Result: id, up (the parent's id), conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256. (conv_id, depth) names the
    conversation and the turn that hold a node's last text.

    Turnless conversations belong to the root only; no conversations give no rows. Turns
    that tie in ``order`` follow in any sequence, so order by all that matters. Equal
    conversations share all nodes. A conversation of any length and a turn shared by any
    number of conversations are spread over tasks.
    """
    steps, path = prefixes(turns, order)
    nodes, ends = trie(steps, convs)
    weighed = nodes.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint")) \
        .withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words"))
    sums = rollup(weighed, steps, ["n_leaves", "saved_tokens"], local_mass=local_mass)
    drop_path(convs.sparkSession, path)
    over = nodes.select(F.col("id").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(over, "up", "left").join(sums, "id").join(end_digests(ends), "id", "left")
            .select("id", "up", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256")))
