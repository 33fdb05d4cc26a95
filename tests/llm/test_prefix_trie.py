"""Prefix trie against dictionaries of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from simsift.llm import prefix_trie, queries, registry  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(convs):
    """``convs``: id -> list of (role, text)."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        cost = (len(members[p]) - 1) * len(WORD.findall(p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += cost
            leaves[p[:d]] += p not in children
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(str, out))


def told(df):
    return sorted(str(tuple(r[c] for c in COLS)) for r in df.select(*COLS).collect())


def rebuilt(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    plain = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, turns in plain.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = plain.get(c - c % 20, [])[:h] + turns[h:]
    return out


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert told(registry.QUERIES["op12_prefix_trie"](spark, SF_SMALL)) == brute(rebuilt(rows))


def random_convs(seed, n=120):
    rng = random.Random(seed)
    text = lambda: (rng.choice(["user", "bot"]), rng.choice(["", "a", "a b", "c d e"]))
    convs, made = {}, []
    for c in range(n):
        start = rng.choice(made)[:rng.randint(0, 30)] if made and rng.random() < 0.7 else []
        made.append([*start, *[text() for _ in range(rng.choice([0, 1, 3, 40]))]])
        convs[c * 3 - 20] = made[-1]
    convs[1000] = [("user", "x")] * 300                                # one long path
    convs[1001] = [("user", "x")] * 150 + [("bot", "y")] * 5
    return convs


def frames(spark, convs, partitions=5):
    rows = [(c, i, role, text, len(WORD.findall(text))) for c, v in convs.items() for i, (role, text) in enumerate(v)]
    turns = spark.createDataFrame(rows, "conv_id bigint, pos int, role string, text string, words bigint").repartition(partitions)
    turns = turns.withColumn("digest", prefix_trie.turn_digest(F.col("role"), F.col("text")))
    return turns, spark.createDataFrame([(c,) for c in convs], "conv_id bigint")


@pytest.mark.parametrize("seed,mass", [(1, 300), (2, 900), (3, 10**9)])
def test_rounds_of_centroids(spark, seed, mass):
    """Small components make many distributed rounds, also on long paths."""
    convs = random_convs(seed)
    turns, ids = frames(spark, convs)
    got = prefix_trie.prefix_trie(turns, [F.col("pos")], ids, local_mass=mass)
    assert told(got) == brute(convs)


def test_hot_conversation_and_hot_first_turn(spark):
    """Many equal conversations, whose ids are joined in pieces, and one over several sorted partitions."""
    convs = {c: [("user", "hello there"), ("bot", "hi")] for c in range(4000)}
    convs |= {c: [("user", "hello there"), ("bot", f"no {c}")] for c in range(4000, 4400)}
    convs[5000] = [("user", f"t{i}") for i in range(250)]
    turns, ids = frames(spark, convs)
    old = prefix_trie.JOINED_BYTES
    prefix_trie.JOINED_BYTES = 500
    try:
        assert told(prefix_trie.prefix_trie(turns, [F.col("pos")], ids)) == brute(convs)
    finally:
        prefix_trie.JOINED_BYTES = old


def test_awkward_rows(spark, tmp_path):
    """NULL ids, turns, roles and texts, repeated rows, absent and short bases, negative ids, further columns."""
    rows = [(0, 0, "user", "a"), (0, 1, "bot", None), (1, 0, None, "x y"), (1, None, "user", "first"), (1, 2, "bot", ""),
            (1, 2, "bot", ""), (2, 0, "user", "a"), (3, 0, "user", "z" * 30000), (4, None, None, None),
            (25, 0, "user", "no base"), (25, 1, "user", "a"), (-3, 0, "user", "a"), (-3, 1, "user", "b"), (None, 0, "user", "lost")]
    df = spark.createDataFrame([(*r, 1, "q") for r in rows],
                               "conv_id bigint, turn bigint, role string, text string, depth int, id string").repartition(3)
    path = str(tmp_path)
    df.write.parquet(f"{path}/conversations.parquet")
    convs = rebuilt([r for r in rows if r[0] is None or r[0] >= 0])
    plain = [("user", "a"), ("user", "b")]
    h = zlib.crc32(b"-3") % 4
    convs[-3] = [("user", "a"), ("bot", "")][:h] + plain[h:]             # the remainder of a negative id is negative
    assert told(registry.QUERIES["op12_prefix_trie"](spark, path)) == brute(convs)
    empty = f"{path}/none"
    df.where("false").write.parquet(f"{empty}/conversations.parquet")
    assert registry.QUERIES["op12_prefix_trie"](spark, empty).collect() == []
