"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers_llm import awkward, awkward_rows, empty, prose
from simsift.llm import exact_dedup, jaccard_join, substring_dedup
from simsift.llm.graph import components

NO_ID = -(1 << 63)


# --- exact ---------------------------------------------------------------------

def fold(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (t or ""))


def exact_brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[fold(r[1])].append(r[0])
    out = []
    for d, t, *_ in rows:
        ids = groups[fold(t)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((d, keep, len(ids), d == keep, hashlib.sha256(fold(t).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.substring(exact_dedup.sha256(c), 1, 1)],
                         ids=["sha256", "colliding"])
def test_exact_dedup(spark, scratch, digest):
    df = awkward(spark)
    df.write.parquet(f"{scratch}/docs")
    got = exact_dedup.exact_dedup(spark, f"{scratch}/docs", f"{scratch}/ckpt", digest=digest)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == exact_brute(awkward_rows())


def test_state_goes_on_from_its_checkpoint(spark, scratch):
    rows = awkward_rows()
    first = spark.createDataFrame([(r[0], r[1]) for r in rows[:20]], "doc_id bigint, text string")
    later = spark.createDataFrame([(r[0], r[1]) for r in rows[20:]], "doc_id bigint, text string")
    first.coalesce(1).write.parquet(f"{scratch}/docs")
    for part in (None, later):
        if part is not None:
            part.coalesce(1).write.mode("append").parquet(f"{scratch}/docs")
        state = exact_dedup.update_state(exact_dedup.read_stream(spark, f"{scratch}/docs"), f"{scratch}/ckpt")
    got = {r.digest: (r.keep_id, r.group_size) for r in state.collect()}
    want = {h: (k, n) for _, k, n, _, h in exact_brute(rows)}
    assert got == want
    assert state.where("location is null").count() == 0


def test_exact_dedup_of_nothing(spark, scratch):
    empty(spark).write.parquet(f"{scratch}/docs")
    assert exact_dedup.exact_dedup(spark, f"{scratch}/docs", f"{scratch}/ckpt").collect() == []


def test_only_hits_are_shuffled_with_their_texts(spark):
    """While the digests of the hits fit a broadcast, other texts are left out where they are read."""
    docs = spark.createDataFrame([(i, f"text {i % 7}", f"d{i % 7}") for i in range(9)], "doc_id bigint, normal string, digest string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = exact_dedup.hit_texts(docs, docs.where("doc_id >= 7").select("digest"))
        got = sorted(tuple(r) for r in found.collect())
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [("d0", "text 0", 7, 2), ("d1", "text 1", 8, 2)]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_hits_beyond_a_broadcast(spark, scratch, monkeypatch):
    monkeypatch.setattr(exact_dedup, "DIGEST_BYTES", 1 << 40)
    awkward(spark).write.parquet(f"{scratch}/docs")
    got = exact_dedup.exact_dedup(spark, f"{scratch}/docs", f"{scratch}/ckpt")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == exact_brute(awkward_rows())


# --- Jaccard join --------------------------------------------------------------

def shingles(t):
    w = (t or "").lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def join_brute(rows, similarity=0.8):
    sets = [(NO_ID if r[0] is None else r[0], shingles(r[1])) for r in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = Counter()
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets):
            if i != j and a and len(a & b) >= similarity * len(a | b):
                links[i] += 1
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, low[find(i)], links[i]) for i, (d, _) in enumerate(sets))


def near_rows(seed, families=12, size=9):
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        base = prose(rng, rng.randint(5, 90)).split()
        for _ in range(rng.randint(1, size)):
            w = list(base)
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = prose(rng, 1)
            rows.append((len(rows) * 2, " ".join(w)))
    return rows


def joined(df, **options):
    return sorted((NO_ID if r.doc_id is None else r.doc_id, NO_ID if r.class_id is None else r.class_id, r.n_links)
                  for r in jaccard_join.jaccard_join(df, **options).collect())


@pytest.mark.parametrize("block", [jaccard_join.BLOCK_SHINGLES, 60])
def test_join_equals_brute_force(spark, block):
    rows = near_rows(4, families=25)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert joined(df, block_shingles=block) == join_brute(rows)


def test_join_of_awkward_rows(spark):
    rows = awkward_rows()
    assert joined(awkward(spark)) == join_brute(rows)
    assert joined(empty(spark)) == []


def test_large_groups_write_no_pairs(spark):
    """A group of distinct near copies and one of equal copies: rows stay in proportion."""
    rng = random.Random(8)
    base = prose(rng, 300).split()
    rows = []
    for i in range(220):
        w = list(base)
        w[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, rows[0][1]) for i in range(150)]
    got = joined(spark.createDataFrame(rows, "doc_id bigint, text string"), block_shingles=20_000)
    assert {(c, n) for _, c, n in got} == {(0, len(rows) - 1)}


def test_recall_of_the_shortened_prefix():
    p = jaccard_join.prefix_length()
    assert 1 - (1 - 0.8 ** p) ** jaccard_join.TREES >= jaccard_join.RECALL
    assert 1 - (1 - 0.8 ** (p + 1)) ** jaccard_join.TREES < jaccard_join.RECALL
    assert jaccard_join.prefix_length(recall=0.5) > p


def test_keep_one(spark):
    df = awkward(spark).withColumn("__k", F.lit(1)).withColumn("__row", F.lit(2))
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns
    classes = {c for _, c, _ in join_brute(awkward_rows())}
    got = [NO_ID if r.doc_id is None else r.doc_id for r in kept.collect()]
    assert len(got) == len(set(got))
    assert set(got) == {d for d, c, _ in join_brute(awkward_rows()) if d == c} & classes
    assert jaccard_join.keep_one(empty(spark)).count() == 0


def test_texts_under_one_id_or_none_are_told_apart(spark):
    rng = random.Random(21)
    texts = [prose(rng, 30) for _ in range(6)]
    near = texts[0].split()
    near[3] = "other"
    near = " ".join(near)                                             # 5 of 26 shingles differ: no link
    long = prose(rng, 200).split()
    edited = " ".join(long[:100] + ["changed"] + long[101:])
    long = " ".join(long)
    rows = [(None, t) for t in texts] + [(7, texts[0].upper()), (7, long), (9, edited), (9, near), (9, "alone"),
                                         (None, ""), (None, None), (5, edited), (None, texts[1]), (7, long)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    for block in (jaccard_join.BLOCK_SHINGLES, 60):
        assert joined(df, block_shingles=block) == join_brute(rows)
    got = sorted((tuple(r) for r in jaccard_join.keep_classes(df).collect()), key=repr)
    want = [(None, t) for t in texts] + [(5, edited), (9, near), (9, "alone"), (None, ""), (None, None)]
    assert got == sorted(want, key=repr)


def test_pipeline_stage_keeps_clean_texts_without_id(spark):
    import corpus_pipeline

    rng = random.Random(22)
    rows = [(None, prose(rng, 20)) for _ in range(40)] + [(1, prose(rng, 20)) for _ in range(5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.drop_near_copies(spark, df, "")
    assert sorted((tuple(r) for r in kept.collect()), key=repr) == sorted(rows, key=repr)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(25)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    assert got == {x: p for x, p in parent.items() if any(x in e and e[0] != e[1] for e in edges)}


# --- substrings ----------------------------------------------------------------

def cut_brute(rows, length=50):
    key = lambda d: NO_ID if d is None else d
    first = {}
    for d, t, *_ in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            first[w] = min(first.get(w, key(d)), key(d))
    out = []
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, np.int8)
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < key(d):
                gone[i + 1:i + 1 + length] = 1
        kept = bytes(x for x, g in zip(b, gone[1:]) if not g)
        out.append((d, len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed, docs=60):
    rng = random.Random(seed)
    shared = [prose(rng, rng.randint(8, 60)) for _ in range(6)] + ["na" * 45, "x" * 70]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randint(1, 5)):
            parts.append(prose(rng, rng.randint(0, 12)))
            p = rng.choice(shared)
            a = rng.randrange(len(p))
            parts.append(p[a // 3:] if rng.random() < 0.6 else p)
        rows.append((rng.randrange(10_000), rng.choice(["", " ", "\n"]).join(parts)))
    return rows


@pytest.mark.parametrize("group", [substring_dedup.GROUP_ROWS, 4])
@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_equal_brute_force(spark, seed, group):
    rows = passages(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = substring_dedup.dedup_substrings(df, group_rows=group).collect()
    assert sorted((tuple(r) for r in got), key=repr) == cut_brute(rows)


def test_substrings_of_awkward_rows(spark):
    got = substring_dedup.dedup_substrings(awkward(spark)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == cut_brute(awkward_rows())
    assert substring_dedup.dedup_substrings(empty(spark)).collect() == []


def test_kept_bytes(spark):
    rows = passages(3, 20)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for r in substring_dedup.dedup_substrings(df, keep_bytes=True).collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
        assert len(r.kept) == r.n_bytes - r.n_removed


def test_anchor_shared_by_many_passes_whole(spark):
    rows = passages(5, 40)
    docs = spark.createDataFrame(rows, "id bigint, t string")
    some = {tuple(r) for r in substring_dedup.shared_anchors(substring_dedup.anchors(docs)).collect()}
    more = {tuple(r) for r in substring_dedup.shared_anchors(substring_dedup.anchors(docs), hold=2).collect()}
    assert some <= more


def test_texts_without_id_carry_their_own_anchors(spark):
    rows = [(None if i % 3 else 5 if i % 2 else d, t) for i, (d, t) in enumerate(passages(6, 60))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    docs = df.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("th"), F.col("text").alias("t"))
    found = substring_dedup.anchors(docs)
    own = {(r.id, r.th): r.n for r in found.groupBy("id", "th").agg(F.countDistinct("h").alias("n")).collect()}
    sets = substring_dedup.anchor_sets(substring_dedup.shared_anchors(found)).collect()
    assert len(sets) > 30 and all(len(r.hs) <= own[r.id, r.th] for r in sets)
    assert sorted((tuple(r) for r in substring_dedup.dedup_substrings(df).collect()), key=repr) == cut_brute(rows)


@pytest.mark.parametrize("shard", [40, 700, 10 ** 6])
def test_merged_transform_is_the_sorted_order(shard):
    rng = np.random.default_rng(shard)
    segs = [bytes(rng.integers(97, 99, int(rng.integers(50, 81))).astype(np.uint8)) for _ in range(60)]
    segs += [segs[0][:55], segs[0][3:53], b"a" * 60, b"a" * 70, bytes(60), bytes([0, 1] * 30)]
    seg, off, block, prefix = substring_dedup.merge_transforms(segs, shard)
    shift = [bytes(b + 1 for b in s) for s in segs]                   # the end sorts before every byte
    context = [shift[a][o:o + 50] for a, o in zip(seg, off)]
    assert sorted(zip(seg, off)) == [(i, j) for i, s in enumerate(segs) for j in range(len(s))]
    assert context == sorted(context)
    for i in range(1, len(context)):
        assert (context[i] == context[i - 1]) == (block[i] == block[i - 1])
