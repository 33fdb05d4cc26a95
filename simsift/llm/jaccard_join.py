"""Similarity join of documents on word shingles with a MinHash LSH forest.

A text is the set of its runs of five lower-cased words. Texts with the same set
are one class member, however many copies there are. The forest has ``TREES``
prefix tries; a set's label in a tree is a row of MinHash values, and two sets
are candidates when their labels share a prefix in some tree. The forest is
reduced to one prefix depth, the deepest at which a pair at the threshold is found
with the target recall; it follows from the constants, and only these values of
a label are computed (banding of 16 x 4 values). Members of one trie node meet in a task and are
verified on their exact shingle sets; a pair that meets in several trees counts
in the first one only.

A node with many members is cut into blocks, and each pair of blocks is a task
of its own, so that no node has to fit in one task. Tasks return one row per
member, the number of its links and a link to the smallest member it is
connected with; pairs are never written out. Classes are the connected
components of the links.

Defined results: NULL texts and texts without words have no links and are
their own class; texts of one to four words are one shingle; texts with equal
sets are linked; NULL ids count as smaller than any other; a class is named by its
smallest id, but its members are named by their sets, so rows that share an id or
have none are told apart by their texts; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simsift.llm.common import cut, fresh_path, sized_broadcast, slices, trimmed, utf8
from simsift.llm.graph import components

WORDS = 5
SIMILARITY = 0.8
TREES = 16
DEPTH = 8                       # full length of a label
RECALL = 0.999                  # of pairs at the threshold
BLOCK_SHINGLES = 1_000_000      # of one block of a large trie node
CACHE_WORDS = 100_000
ROWS = 256                      # of a batch that are Python objects at a time
NO_ID = -(1 << 63)


def prefix_length(similarity: float = SIMILARITY, recall: float = RECALL, trees: int = TREES, depth: int = DEPTH) -> int:
    """Shorten the matched prefix until a pair at the threshold is found with the target recall."""
    while depth > 1 and 1 - (1 - similarity ** depth) ** trees < recall:
        depth -= 1
    return depth


class WordHashes(dict):
    """Hash of each word, remembered."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: str | None, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words."""
    parts = (text or "").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    n = max(1, len(w) - words + 1)
    h = np.full(n, len(w) if len(w) < words else words, np.uint64)
    for i in range(min(words, len(w))):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += w[i:i + n]
        h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(31)
    return np.unique(h)


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def trie_keys(sets: list[np.ndarray], prefix: int, trees: int = TREES, seed: int = 5) -> np.ndarray:
    """Key of the trie node at depth ``prefix`` in each tree, (sets, trees); sets must not be empty."""
    rng = np.random.default_rng(seed)
    mul = rng.integers(0, 1 << 32, (trees, prefix), dtype=np.uint32) | np.uint32(1)
    add = rng.integers(0, 1 << 32, (trees, prefix), dtype=np.uint32)
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    start = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    keys = np.empty((len(sets), trees), np.uint64)
    for t in range(trees):
        k = np.full(len(sets), t + 1, np.uint64)
        for d in range(prefix):
            low = np.minimum.reduceat(x * mul[t, d] + add[t, d], start)
            k = (k ^ low) * np.uint64(0x9E3779B97F4A7C15)
            k ^= k >> np.uint64(29)
        keys[:, t] = k
    return keys


def identity(key: str) -> Column:
    return F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID).cast("bigint"))


def text_key(text: str) -> Column:
    """Digest of the text, which tells rows under one id (or none) apart."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def features(docs: DataFrame, prefix: int) -> DataFrame:
    """(id, th, set_key, n, nodes) of every text; without words the key is NULL and there is no node."""
    def run(batches):
        hashes = WordHashes()
        for b in batches:
            _, off = utf8(b.column(2))
            for lo, hi in slices(off, 1 << 20):
                part = b.slice(lo, hi - lo)
                sets = [shingle_set(t, hashes) for t in part.column(2).to_pylist()]
                full = [s for s in sets if len(s)]
                nodes = trie_keys(full, prefix).view(np.int64).ravel() if full else np.zeros(0, np.int64)
                ends = np.concatenate([[0], np.cumsum([TREES * (len(s) > 0) for s in sets])])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1),
                     pa.array([set_digest(s) if len(s) else None for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(nodes))],
                    ["id", "th", "set_key", "n", "nodes"])

    return docs.select("id", "th", "t").mapInArrow(trimmed(run), "id bigint, th binary, set_key binary, n int, nodes array<bigint>")


def linked(a: list[np.ndarray], b: list[np.ndarray], keys_a: np.ndarray, keys_b: np.ndarray, tree: int,
           within: bool, similarity: float) -> list[tuple[int, int]]:
    """Verified links (i, j) between two blocks of one trie node of ``tree``, exact on the sets.

    Pairs that share a node of an earlier tree are left to that tree.
    """
    flat = np.concatenate(b)
    size_b = np.array([len(s) for s in b])
    start = np.cumsum(size_b) - size_b
    universe, at = np.unique(flat, return_inverse=True)
    out = []
    for i, s in enumerate(a):
        ok = np.ones(len(b), bool)
        if within:
            ok[:i + 1] = False
        if tree:
            ok &= ~(keys_b[:, :tree] == keys_a[i, :tree]).any(axis=1)
        low, high = similarity * len(s), len(s) / similarity
        ok &= (size_b >= low - 1e-9) & (size_b <= high + 1e-9)
        if not ok.any():
            continue
        mark = np.zeros(len(universe) + 1, np.int32)
        where = np.searchsorted(universe, s)
        hit = where < len(universe)
        where = where[hit]
        mark[where[universe[where] == s[hit]]] = 1
        js = np.flatnonzero(ok)
        if len(js) * 4 > len(b):
            common = np.add.reduceat(mark[at], start)[js]
        else:
            common = np.array([mark[at[start[j]:start[j] + size_b[j]]].sum() for j in js])
        union = len(s) + size_b[js] - common
        out += [(i, int(j)) for j in js[common >= similarity * union - 1e-9]]
    return out


def roots(n: int, pairs: list[tuple[int, int]]) -> list[int]:
    """Smallest connected number of each of ``n`` members."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in pairs:
        i, j = find(i), find(j)
        if i != j:
            parent[max(i, j)] = min(i, j)
    return [find(x) for x in range(n)]


def verify(cells: DataFrame, similarity: float) -> DataFrame:
    """(id, set_key, root_id, root_key, links): per cell and linked member, its links and the smallest member it is connected with.

    ``cells`` holds (node, tree, i, j, side, id, copies, set_key, nodes, t), a cell being
    the pair of blocks ``i``, ``j`` of a trie node, with one row per member and side.
    Members are named by their sets; ids only order them.
    """
    def solve(cell):
        tree, i, j = cell["tree"], cell["i"], cell["j"]
        order = sorted(cell["rows"], key=lambda r: r[:2])             # side, (id, set_key)
        side_a = [r for r in order if r[0] == 0]
        side_b = side_a if i == j else [r for r in order if r[0] == 1]
        if not side_a or not side_b:
            return []
        keys_a, keys_b = (np.stack([r[3] for r in s]) for s in (side_a, side_b))
        pairs = linked([r[4] for r in side_a], [r[4] for r in side_b], keys_a, keys_b, tree, i == j, similarity)
        shift = 0 if i == j else len(side_a)
        both = side_a if i == j else side_a + side_b
        rank = sorted(range(len(both)), key=lambda x: both[x][1])     # number members by (id, set_key)
        at = {x: k for k, x in enumerate(rank)}
        links = [0] * len(both)
        joined = []
        for x, y in pairs:
            y += shift
            links[x] += both[y][2]
            links[y] += both[x][2]
            joined.append((at[x], at[y]))
        root = roots(len(both), joined)
        return [(*both[x][1], *both[rank[root[at[x]]]][1], links[x]) for x in range(len(both)) if links[x]]

    def run(batches):
        hashes, cell = WordHashes(), None
        types = {"id": pa.int64(), "set_key": pa.binary(), "root_id": pa.int64(), "root_key": pa.binary(), "links": pa.int64()}

        def pack(rows):
            cols = list(zip(*rows)) if rows else [()] * len(types)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types.values())], list(types))

        for b in batches:
            out = []
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                for node, tree, i, j, side, ident, copies, set_key, nodes, text in zip(
                        *(part.column(k).to_pylist() for k in range(10))):
                    if cell is None or cell["key"] != (node, i, j):
                        if cell is not None:
                            out += solve(cell)
                        cell = {"key": (node, i, j), "tree": tree, "i": i, "j": j, "rows": []}
                    cell["rows"].append((side, (ident, set_key), copies, np.array(nodes, np.int64), shingle_set(text, hashes)))
            yield pack(out)
        if cell is not None:
            yield pack(solve(cell))

    dealt = cells.repartition("node", "i", "j").sortWithinPartitions("node", "i", "j")
    return dealt.mapInArrow(trimmed(run), "id bigint, set_key binary, root_id bigint, root_key binary, links bigint")


def member(key: str, set_key: str) -> Column:
    """Name of a member: its set, ordered by its smallest id."""
    return F.struct(F.col(key).alias("rep"), F.col(set_key).alias("set_key"))


def classes(df: DataFrame, text: str, key: str, similarity: float = SIMILARITY, recall: float = RECALL,
            block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(id, th, class, n_links) of every row; ``class`` is the smallest member, NULL for a text without words."""
    spark = df.sparkSession
    docs = df.select(identity(key).alias("id"), text_key(text).alias("th"), F.col(text).alias("t"))
    path = fresh_path(spark, "shingles")
    features(docs, prefix_length(similarity, recall)).write.parquet(path)
    stored = spark.read.parquet(path)
    found = stored.where(F.col("set_key").isNotNull())
    # one member per set; the rest of a set's rows are copies, ``again`` of them under the same id
    sets = cut(found.groupBy("set_key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    members = (found.join(sets, "set_key").where(F.col("id") == F.col("rep")).groupBy("set_key")
               .agg(F.first("id").alias("id"), F.first("th").alias("th"), F.first("n").alias("n"),
                    F.first("nodes").alias("nodes"), F.first("copies").alias("copies"), F.count(F.lit(1)).alias("again")))
    placed = members.select("set_key", "n", F.posexplode("nodes").alias("tree", "node"))
    busy = (placed.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("weight"))
            .where(F.col("size") > 1).select("node", F.ceil(F.col("weight") / F.lit(block_shingles)).cast("int").alias("blocks")))
    met = cut(placed.select("set_key", "tree", "node").join(busy, "node"))
    block = F.pmod(F.xxhash64("set_key", "node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cells = (met.withColumn("block", block).withColumn("other", other)
             .select("set_key", "tree", "node", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     (F.col("block") > F.col("other")).cast("int").alias("side")))
    wanted = cut(members.join(met.select("set_key").distinct(), "set_key", "left_semi"))
    texts = docs.join(sized_broadcast(wanted.drop("n"), 320), ["id", "th"])
    if not wanted.where(F.col("again") > 1).isEmpty():
        # rows that repeat both id and text: one of them shows the member's text
        texts = texts.where(F.col("again") == 1).unionByName(texts.where(F.col("again") > 1).dropDuplicates(["set_key"]))
    full = texts.join(sized_broadcast(cells, 80), "set_key") \
        .select("node", "tree", "i", "j", "side", "id", "copies", "set_key", "nodes", "t")
    links = cut(verify(full, similarity))
    total = links.groupBy("set_key").agg(F.sum("links").alias("links"))
    named = components(links.select(member("id", "set_key").alias("a"), member("root_id", "root_key").alias("b"))) \
        .select(F.col("id.set_key").alias("set_key"), F.col("component").alias("class"))
    by_set = (sets.join(total, "set_key", "left").join(named, "set_key", "left")
              .select("set_key", "copies", F.coalesce("links", F.lit(0)).alias("links"),
                      F.coalesce("class", member("rep", "set_key")).alias("class")))
    linked_rows = found.select("id", "th", "set_key").join(by_set, "set_key").select(
        "id", "th", "class", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    alone = stored.where(F.col("set_key").isNull()).select(
        "id", "th", F.lit(None).cast("struct<rep: bigint, set_key: binary>").alias("class"), F.lit(0).cast("bigint").alias("n_links"))
    return linked_rows.unionByName(alone)


def jaccard_join(df: DataFrame, text: str = "text", key: str = "doc_id", similarity: float = SIMILARITY,
                 recall: float = RECALL, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, class_id, n_links): one row per row of ``df``.

    ``class_id`` is the smallest id of the class; ``n_links`` counts the other
    documents with a similarity of at least ``similarity``, copies included.
    """
    known = lambda c: F.when(c != F.lit(NO_ID).cast("bigint"), c)
    return classes(df, text, key, similarity, recall, block_shingles).select(
        known(F.col("id")).alias("doc_id"), known(F.coalesce(F.col("class.rep"), F.col("id"))).alias("class_id"), "n_links")


def keep_classes(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df`` without near copies: of each class the row with the smallest (id, text digest) stays.

    Rows of different classes all stay, also under one id or without an id; so do
    texts without words. Of rows that repeat both id and text one stays.
    """
    crowd = cut(classes(df, text, key, **options).where(F.col("n_links") > 0).select("id", "th", "class"))
    best = cut(crowd.groupBy("class").agg(F.min(F.struct("id", "th")).alias("best")))
    judged = crowd.join(sized_broadcast(best, 96), "class").select("id", "th", (F.struct("id", "th") == F.col("best")).alias("stays"))
    name = [F.col("id").alias("__id"), F.col("th").alias("__th")]
    gone = cut(judged.where(~F.col("stays")).select(*name).distinct())
    again = cut(judged.where("stays").groupBy("id", "th").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1).select(*name))
    rows = df.select(F.struct(*df.columns).alias("__row"), identity(key).alias("__id"), text_key(text).alias("__th"),
                     F.xxhash64(*df.columns).alias("__hash"))
    kept = rows.join(sized_broadcast(gone, 40), ["__id", "__th"], "left_anti")
    if again.isEmpty():
        return kept.select("__row.*")
    again = sized_broadcast(again, 40)
    once = kept.join(again, ["__id", "__th"], "left_semi").groupBy("__id", "__th").agg(F.min_by("__row", "__hash").alias("__row"))
    return kept.join(again, ["__id", "__th"], "left_anti").select("__row").unionByName(once.select("__row")).select("__row.*")


def keep_one(df: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``keep_classes`` for tables that hold one row per id: of rows that repeat an id, the one with the smallest text hash stands for all.

    It drops texts that are no copies where ids repeat or are missing; the pipeline uses ``keep_classes``.
    """
    rows = keep_classes(df, text, key, **options).select(
        F.struct(*df.columns).alias("__row"), F.col(key).cast("bigint").alias("__key"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__hash"))
    nth = F.row_number().over(Window.partitionBy("__key").orderBy("__hash"))
    return rows.withColumn("__r", nth).where(F.col("__r") == 1).select("__row.*")
