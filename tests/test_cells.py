"""Inverted-file index: recall against brute force, and exact answers under pruning."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from simsift.operators import cells
from simsift.operators.knn_join import knn_join
from simsift.plans import QUERIES
from simsift.plans.cell_queries import cell_recall

PARAMS = cells.CellParams(cells=40, rounds=4, part_dims=2)


def points(spark, n, dim=16, seed=1, clusters=12):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(clusters, dim)) * 2
    x = (centers[rng.integers(0, clusters, n)] + rng.normal(size=(n, dim))).astype(np.float32)
    rows = [(i, [float(a) for a in v]) for i, v in enumerate(x)]
    rows += [(n, [0.0] * dim), (n + 1, None), (n + 2, [1.0]), (n + 3, [None] * dim), (n + 4, rows[3][1])]
    return spark.createDataFrame(rows, "id bigint, vector array<float>").repartition(4)


def told(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    pts = points(spark, 3000)
    model = cells.train(pts, PARAMS)
    path = str(tmp_path_factory.mktemp("cells") / "index")
    cells.write_index(cells.build(pts, model), path)
    return pts, spark.read.parquet(path), model


def queries(pts, every=20):
    return pts.where(F.col("id") % every == 0).withColumnRenamed("id", "qid")


def test_index_holds_every_usable_point(spark, built):
    pts, index, model = built
    assert index.count() == 3001                                   # all but zero, NULL, short and NULL-filled vectors
    assert model.centroids.shape == (40, 16) and model.parts.shape == (8, 256, 2)
    x = {r.id: r for r in index.collect()}
    for r in list(x.values())[:200]:
        v = np.array(r.vector) / np.linalg.norm(r.vector)
        s = model.centroids @ v
        assert s[r.cell] == pytest.approx(s.max()) and np.cos(r.angle) == pytest.approx(s.max(), abs=1e-9)
    n, radius = cells.cell_sizes(index, model)
    assert n.sum() == 3001 and radius.max() == pytest.approx(max(r.angle for r in x.values()))


def test_model_round_trip(spark, built, scratch):
    _, _, model = built
    cells.write_model(spark, model, f"{scratch}/model")
    back = cells.read_model(spark, f"{scratch}/model")
    assert np.array_equal(back.centroids, model.centroids) and np.array_equal(back.parts, model.parts)


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 40, "point_block_rows": 900}])
def test_pruned_search_is_exact(spark, built, blocks):
    """Ties (a copied vector), one broadcast block and cogrouped blocks."""
    pts, index, model = built
    asked = queries(pts)
    assert told(cells.search_exact(index, model, asked, k=7, **blocks)) == told(knn_join(pts, asked, k=7))
    scored = cells.points_scored(cells.scan_exact(index, model, asked, k=7, **blocks)).collect()
    assert sum(r.scored for r in scored) < 0.5 * 3001 * asked.where("qid < 3000").count()


def test_more_hits_than_points(spark, built):
    pts, index, model = built
    asked = queries(pts, 500)
    assert told(cells.search_exact(index, model, asked, k=4000)) == told(knn_join(pts, asked, k=4000))


@pytest.mark.parametrize("codes", [True, False])
def test_recall_and_share(spark, built, codes):
    pts, index, model = built
    asked = queries(pts)
    exact = {(q, i) for q, _, i, _ in told(knn_join(pts, asked, k=10))}
    got = told(cells.search(index, model, asked, k=10, share=0.2, codes=codes))
    assert len(exact & {(q, i) for q, _, i, _ in got}) >= 0.95 * len(exact)
    true = {(r.qid, r.id): r.score for r in knn_join(pts, asked, k=4000).collect()}
    assert all(true[q, i] == s for q, _, i, s in got)
    blocks = told(cells.search(index, model, asked, k=10, share=0.2, codes=codes, block_rows=50, point_block_rows=800))
    assert blocks == got
    scan = cells.scan_approximate(index, model, asked, keep=10, share=0.2, codes=codes)
    assert all(r.scored < 0.35 * 3001 for r in cells.points_scored(scan).collect())


def test_full_share_without_codes_is_exact(spark, built):
    pts, index, model = built
    asked = queries(pts, 100)
    assert told(cells.search(index, model, asked, k=5, share=1.0, codes=False)) == told(knn_join(pts, asked, k=5))


def test_no_queries_and_wrong_parameters(spark, built):
    pts, index, model = built
    none = queries(pts).where("false")
    assert cells.search(index, model, none).count() == cells.search_exact(index, model, none).count() == 0
    odd = spark.createDataFrame([(1, [0.0] * 16), (2, None), (3, [1.0])], "qid bigint, vector array<float>")
    assert cells.search_exact(index, model, odd).count() == 0
    for bad in (dict(cells=0), dict(cells=cells.MAX_CELLS + 1), dict(part_dims=0), dict(rounds=-1)):
        with pytest.raises(ValueError):
            cells.CellParams(**bad)
    with pytest.raises(ValueError):
        cells.search(index, model, none, share=0.0)
    with pytest.raises(ValueError):
        cells.train(pts.where("id >= 3000 AND id <= 3001"), PARAMS)
    few = cells.train(pts.where("id < 9"), PARAMS)
    assert len(few.centroids) == 9


def test_registered_queries(spark):
    assert told(QUERIES["knn_pruned"](spark, SF_SMALL)) == told(QUERIES["knn_batch"](spark, SF_SMALL))
    rows = cell_recall(spark, SF_SMALL).collect()
    assert sum(r.recall for r in rows) / len(rows) >= 0.9
    hits = QUERIES["ann_cells"](spark, SF_SMALL).collect()
    true = {(r.qid, r.id, r.score) for r in QUERIES["knn_batch"](spark, SF_SMALL).collect()}
    assert len(true & {(r.qid, r.id, r.score) for r in hits}) >= 0.9 * len(true) and len(hits) == len(true)
