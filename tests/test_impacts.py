"""Sparse top-k by impact-ordered blocks equals the full scan and reads less."""

import random

import pytest

from simsift.operators import impacts, sparse


def vectors(seed, n=1500, negative=False):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = {rng.choice([1, 2, 3]): float(rng.randint(1, 3))}              # hot indices, many ties
        for _ in range(rng.randint(0, 6)):
            v[rng.randint(1, 40)] = round(rng.paretovariate(1.2), 3) * (rng.choice([1, -1]) if negative else 1)
        out.append((i, sorted(v), [v[j] for j in sorted(v)]))
    return out


def frames(spark, rows, block_rows=16):
    pts = spark.createDataFrame([(i, (a, b)) for i, a, b in rows],
                                "id bigint, sp struct<indices:array<bigint>,values:array<float>>").repartition(4)
    return pts, impacts.posting_blocks(sparse.to_long(pts, "sp"), block_rows=block_rows)


def told(df):
    return [tuple(r) for r in df.orderBy("rank").collect()]


@pytest.mark.parametrize("seed,negative", [(1, False), (2, True)])
def test_equals_scan(spark, scratch, seed, negative):
    pts, blocks = frames(spark, vectors(seed, negative=negative))
    impacts.write_blocks(blocks, f"{scratch}/b")
    blocks = spark.read.parquet(f"{scratch}/b")
    rng = random.Random(seed)
    queries = [([1, 2, 3], [1.0, 1.0, 1.0]), ([5], [2.0]), ([1, 7, 9], [0.1, -1.0, 3.0]), ([999], [1.0]), ([], [])]
    queries += [(sorted(rng.sample(range(1, 41), 4)), [rng.choice([0.5, 1.0, 2.5]) for _ in range(4)]) for _ in range(1)]
    for qi, qv in queries:
        for k in (10,):
            got, _ = impacts.knn_block_max(blocks, pts, qi, qv, k=k, first_depth=1)
            assert told(got) == told(sparse.knn_scan(pts, "sp", qi, qv, k=k)), (qi, qv, k)


def test_skips_blocks_and_counts_them(spark):
    rows = [(i, [1, 2], [float(1 + (i % 997 == 0) * 100), 1.0]) for i in range(5000)]
    pts, blocks = frames(spark, rows)
    got, report = impacts.knn_block_max(blocks, pts, [1], [1.0], k=3, first_depth=1)
    assert told(got) == told(sparse.knn_scan(pts, "sp", [1], [1.0], k=3))
    assert report.blocks >= 5000 // 16 and report.read == 1 and report.candidates < 100


def test_fewer_hits_than_k_and_all_ties(spark):
    pts, blocks = frames(spark, [(i, [4], [1.0]) for i in range(200)])
    assert told(impacts.knn_block_max(blocks, pts, [4], [1.0], k=500, first_depth=1)[0]) == told(sparse.knn_scan(pts, "sp", [4], [1.0], k=500))
    got, report = impacts.knn_block_max(blocks, pts, [4], [1.0], k=5, first_depth=1)
    assert told(got) == told(sparse.knn_scan(pts, "sp", [4], [1.0], k=5)) and report.read == report.blocks
    with pytest.raises(ValueError):
        impacts.posting_blocks(blocks, block_rows=0)
