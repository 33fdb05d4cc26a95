"""The passes over chunks and sentences hold a slice of their batch, with the answers of the whole."""

import tracemalloc

import pyarrow as pa

from simsift.operators import chunking
from simsift.operators.embed import embed_query, hashed_vector_udf


def peak_mb(work):
    tracemalloc.start()
    try:
        out = work()
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_semantic_pass_works_in_slices():
    rows = [[[f"w{i % 900}", "x", f"w{(i * j) % 700}."] for j in range(40)] for i in range(3000)] + [None, []]
    batch = pa.record_batch([pa.array(range(len(rows))), pa.array(rows, pa.list_(pa.list_(pa.string())))], names=["id", "s"])
    run = chunking._semantic_pass(0.95, 64)
    peak, out = peak_mb(lambda: list(run([batch])))
    assert peak < 20
    whole = pa.Table.from_batches(out)
    assert whole["id"].to_pylist() == list(range(len(rows)))
    one = pa.Table.from_batches([b for i in range(0, len(rows), 501) for b in run([batch.slice(i, 501)])])
    assert whole["_chunks"].to_pylist() == one["_chunks"].to_pylist() and whole["_chunks"].to_pylist()[-2:] == [[], []]


def test_embedder_works_in_slices():
    import pandas as pd

    texts = [" ".join(f"T{(i * j) % 5000}" for j in range(200)) for i in range(2500)] + [None, "", " a  B ", "\x0b x\x1cy\u00a0z\r"]
    fn = hashed_vector_udf(32).func
    peak, out = peak_mb(lambda: list(fn(iter([pd.Series(texts)])))[0])
    assert peak < 20 and len(out) == len(texts)
    for i in (0, 7, 2499, len(texts) - 3, len(texts) - 2, len(texts) - 1):
        assert out[i].tolist() == embed_query(None, texts[i], dim=32)
    assert out[2500].tolist() == [0.0] * 32
