"""Merkle manifest against a plain recursive construction."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers_llm import awkward_rows, SCHEMA, empty
from simsift.llm import manifest, queries  # noqa: F401  (registers the queries)
from simsift.llm import registry


def H(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(row, text):
    vals = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))


def climb(nodes):
    """(root, siblings of each node bottom up, runs of each node bottom up)."""
    paths, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, over = [], []
        for a in range(0, len(nodes), 8):
            run = nodes[a:a + 8]
            for k in range(len(run)):
                for i in spans[a + k]:
                    paths[i].append((k, run))
            above.append(H("".join(run)))
            over.append([i for s in spans[a:a + 8] for i in s])
        nodes, spans = above, over
    return nodes[0], paths


def lowered(t):
    return None if t is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r.lang].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    built = {}
    for g in names:
        built[g] = sorted(((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)), r) for r in groups[g])
    trees = {g: climb([k[2] for k, _ in built[g]]) for g in names}
    root, tops = climb([trees[g][0] for g in names])
    out = []
    for j, g in enumerate(names):
        for i, (k, r) in enumerate(built[g]):
            path = trees[g][1][i] + tops[j]
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0
            node = leaf(r, lowered(r.text) if hit else r.text)
            for at, run in path:
                node = H("".join([*run[:at], node, *run[at + 1:]]))
            out.append((r.doc_id, k[2], trees[g][0], root, H("".join("".join(run[:at] + run[at + 1:]) for at, run in path)),
                        node, node == root))
    return sorted(map(str, out))


def told(df):
    cols = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(str(tuple(r[c] for c in cols)) for r in df.select(*cols).collect())


def op13(spark, df, levels):
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    shown = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0,
                   F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    return manifest.manifest(df, F.col("lang"), manifest.leaf(*fields, F.col("text")), manifest.leaf(*fields, shown), levels=levels)


def test_query_equals_brute_force(spark):
    got = told(registry.QUERIES["op13_manifest"](spark, SF_SMALL))
    assert got == brute(spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())


@pytest.mark.parametrize("n,langs", [(1, 1), (9, 1), (700, 2), (531, 20)])
def test_many_rounds(spark, n, langs):
    """Blocks of 8 leaves: the butterfly runs several rounds, with ragged ends, in both trees."""
    rows = [(i * 7 % n, f"Text {i}", f"l{i % langs if i % 3 else 0:02d}", "s", i) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    assert told(op13(spark, df, 1)) == brute(df.collect())


def test_awkward_rows(spark):
    df = spark.createDataFrame(awkward_rows(), SCHEMA).repartition(4)
    odd = spark.createDataFrame([(None, None, None, None, None, 1, "x", 1, 0.0)] * 3, SCHEMA)
    df = df.unionByName(odd)
    assert told(op13(spark, df, 1)) == brute(df.collect())
    assert told(op13(spark, df, 4)) == brute(df.collect())
    assert op13(spark, empty(spark), 4).collect() == []
