"""Arrow tasks hold a bounded part of their batches."""

import tracemalloc

import numpy as np
import pyarrow as pa
from simsift.operators import cells
from simsift.operators import knn_join as kj


def peak_mb(work):
    tracemalloc.start()
    try:
        out = work()
        return tracemalloc.get_traced_memory()[1] / 1e6, out
    finally:
        tracemalloc.stop()


def test_kernel_memory_is_bounded_and_copies_are_cut():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(12_000, 16)).astype(np.float32)
    x[1000:9000] = x[0]                                                # one very common vector
    ids, qids = np.arange(len(x)), np.arange(0, len(x), 24)
    q = x[qids].astype(np.float64)

    class Block:
        value = (qids, q)

    batches = [pa.record_batch([pa.array(ids[a:a + 6000]), pa.array(list(x[a:a + 6000]), pa.list_(pa.float32()))],
                               names=["id", "v"]) for a in (0, 6000)]
    run = kj._functions(10, "cosine")[0](Block)
    peak, out = peak_mb(lambda: pa.Table.from_batches(list(run(iter(batches)))))
    assert peak < 100 and out.num_rows < 30 * len(qids)
    got = out.to_pandas()
    y = x.astype(np.float64)
    for j in (0, 3, 100, 499):
        s = np.round(y @ q[j] / np.linalg.norm(y, axis=1) / np.linalg.norm(q[j]), 6)
        mine = got[got.qid == qids[j]]
        assert [i for _, i in sorted(zip(-mine.raw_score.round(6), mine.id))[:10]] == np.lexsort((ids, -s))[:10].tolist()


def test_cell_scan_holds_no_more_copies_than_it_keeps():
    n, nq, keep = 6000, 300, 5
    batch = pa.record_batch([pa.array(np.zeros(n, np.int32)), pa.array(np.zeros(n)), pa.array(np.arange(n)[::-1].copy()),
                             pa.array(np.ones(n))], names=["cell", "angle", "id", "v"])
    asked = np.ones(nq)
    peak, out = peak_mb(lambda: list(cells._scan(
        np.arange(nq), None, [batch, batch], np.ones((nq, 1), bool), lambda c: c.to_numpy(), lambda v, who: np.outer(v, asked[who]),
        keep, 0.0)))
    hits = pa.Table.from_batches(out).to_pandas()
    told = hits[hits.id.isna()]
    assert (told.raw == 2 * n).all() and len(told) == nq
    hits = hits[hits.id.notna()]
    assert peak < 120 and len(hits) == keep * nq and sorted(hits[hits.qid == 7].id) == [0, 0, 1, 1, 2]
