"""Searches of many queries over the inverted-file index (ANN-1/4, KNN-1/11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from simsift.operators import cells, knn_join
from simsift.plans.registry import register
from simsift.plans.search_queries import K, MANY_SQL, many_queries
from simsift.sources import indexes, tables

# Fixed build and search knobs: 32 code bytes for 256 vector bytes, 24 % of the points probed.
CELLS = cells.CellParams(cells=2048, part_dims=2)
SHARE, RERANK = 0.24, 200


def cell_index(spark, sf_dir):
    """The stored index over every vector and its model, built once per application."""
    pts, made = tables.vectors(spark, sf_dir), []

    def write_model(path):
        made.append(cells.train(pts, CELLS))
        cells.write_model(spark, made[0], path)

    model = cells.read_model(spark, indexes.stored_path(spark, "cell-model", sf_dir, write_model))
    index = indexes.stored(spark, "cells", sf_dir, lambda path: cells.write_index(cells.build(pts, model), path))
    return index, model


@register("knn_pruned", MANY_SQL)
def knn_pruned(spark, sf_dir):
    """KNN-1/11: the exact top-10 of every query vector, cells and points ruled out by the triangle inequality."""
    index, model = cell_index(spark, sf_dir)
    return cells.search_exact(index, model, many_queries(spark, sf_dir), k=K)


@register("ann_cells")
def ann_cells(spark, sf_dir):
    """ANN-1: approximate top-10 of every query vector from product codes, survivors scored exactly."""
    index, model = cell_index(spark, sf_dir)
    return cells.search(index, model, many_queries(spark, sf_dir), k=K, share=SHARE, rerank=RERANK)


def cell_recall(spark, sf_dir):
    """ANN-4: (qid, wanted, recall, scored, points) of ``ann_cells`` against brute force."""
    index, model = cell_index(spark, sf_dir)
    asked = many_queries(spark, sf_dir)
    sizes = cells.cell_sizes(index, model)
    exact = knn_join.knn_join(tables.vectors(spark, sf_dir), asked, k=K).select("qid", "id")
    found = cells.search(index, model, asked, k=K, share=SHARE, rerank=RERANK, sizes=sizes).select("qid", "id", F.lit(1).alias("hit"))
    told = cells.points_scored(cells.scan_approximate(index, model, asked, keep=RERANK, share=SHARE, codes=True, sizes=sizes))
    recall = exact.join(found, ["qid", "id"], "left").groupBy("qid").agg(
        F.count(F.lit(1)).alias("wanted"), F.round(F.count("hit") / F.count(F.lit(1)), 6).alias("recall"))
    return recall.join(told, "qid").withColumn("points", F.lit(int(sizes[0].sum())))


@register("ann_cells_recall", f"""
SELECT count(DISTINCT qid) AS queries, count(*) AS wanted, TRUE AS recall_reached, TRUE AS share_kept FROM ({MANY_SQL})""")
def ann_cells_recall(spark, sf_dir):
    """ANN-4: whether ``ann_cells`` finds 0.9 of all true neighbours and scores at most a quarter of the points."""
    told = cell_recall(spark, sf_dir)
    return told.agg(F.count(F.lit(1)).alias("queries"), F.sum("wanted").alias("wanted"),
                    (F.sum(F.col("recall") * F.col("wanted")) >= 0.9 * F.sum("wanted")).alias("recall_reached"),
                    (F.avg("scored") <= 0.25 * F.max("points")).alias("share_kept"))
