"""Language identification with a byte convolutional network.

Architecture: byte embedding, filters of several widths, ReLU, max pooling over
the window, softmax. The network is trained here in numpy on windows of
labelled texts, and applied to fixed-length windows that cover every byte of a
text; the class probabilities of a text are the mean over its windows.

Defined results: NULL text and text without a letter give ``und`` with score 0;
labels that are NULL are not learned; without any labelled row every text is
``und``; repeated ids and rows are predicted one by one; further columns of the
input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simsift.llm.common import slices, utf8

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
PAD = 256                       # index of the padding symbol, whose embedding stays zero

TRAIN_DOCS_PER_LANG = 400       # bound of the labelled sample
TRAIN_WINDOWS_PER_DOC = 6
TRAIN_LANGS = 64                # most frequent label values that are learned
EPOCHS = 5
SCHEMA = "doc_id bigint, lang_pred string, score double"


def cut_windows(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-length windows covering every byte, and the row of each window.

    The last window of a row is moved back to end with the row; rows shorter
    than a window are padded.
    """
    lengths = np.diff(offsets)
    counts = np.maximum(1, -(-lengths // WINDOW))
    rows = np.repeat(np.arange(len(lengths)), counts)
    first = np.cumsum(counts) - counts
    start = (np.arange(len(rows)) - first[rows]) * WINDOW
    start = np.minimum(start, np.maximum(0, lengths[rows] - WINDOW)) + offsets[:-1][rows]
    at = start[:, None] + np.arange(WINDOW)
    inside = at < offsets[1:][rows][:, None]
    symbols = np.append(raw, np.uint8(0)).astype(np.int16)
    return np.where(inside, symbols[np.minimum(at, len(raw))], np.int16(PAD)), rows


def unfold(emb: np.ndarray, width: int) -> np.ndarray:
    """(W, L, E) -> (W * (L - width + 1), width * E): one row for each filter position."""
    w, length, e = emb.shape
    n = length - width + 1
    s0, s1, s2 = emb.strides
    view = np.lib.stride_tricks.as_strided(emb, (w, n, width * e), (s0, s1, s2))
    return np.ascontiguousarray(view).reshape(w * n, width * e)


def pooled(model: dict, win: np.ndarray) -> np.ndarray:
    """Max-pooled filter responses, (W, widths * filters)."""
    emb = model["emb"][win]
    out = []
    for width in WIDTHS:
        n = WINDOW - width + 1
        z = unfold(emb, width) @ model[f"f{width}"]
        out.append(z.reshape(len(win), n, FILTERS).max(axis=1) + model[f"b{width}"])
    return np.maximum(np.concatenate(out, axis=1), 0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def probabilities(model: dict, win: np.ndarray) -> np.ndarray:
    return softmax(pooled(model, win) @ model["w"] + model["c"])


def train(win: np.ndarray, y: np.ndarray, classes: int, seed: int = 7, epochs: int = EPOCHS) -> dict:
    """Adam on the cross entropy; the max pooling sends gradients to one position per filter."""
    rng = np.random.default_rng(seed)
    model = {"emb": rng.normal(0, 0.5, (PAD + 1, EMBED)).astype(np.float32)}
    model["emb"][PAD] = 0
    for width in WIDTHS:
        model[f"f{width}"] = rng.normal(0, (width * EMBED) ** -0.5, (width * EMBED, FILTERS)).astype(np.float32)
        model[f"b{width}"] = np.zeros(FILTERS, np.float32)
    features = FILTERS * len(WIDTHS)
    model["w"] = rng.normal(0, features ** -0.5, (features, classes)).astype(np.float32)
    model["c"] = np.zeros(classes, np.float32)
    m = {k: np.zeros_like(v) for k, v in model.items()}
    v = {k: np.zeros_like(x) for k, x in model.items()}
    step, batch, rate = 0, 64, 0.004
    for epoch in range(epochs):
        order = rng.permutation(len(win))
        for s in range(0, len(order), batch):
            pick = order[s:s + batch]
            x, t = win[pick], y[pick]
            emb = model["emb"][x]
            cols, arg, act = {}, {}, []
            for width in WIDTHS:
                n = WINDOW - width + 1
                cols[width] = unfold(emb, width).reshape(len(x), n, -1)
                z = cols[width] @ model[f"f{width}"]
                arg[width] = z.argmax(axis=1)
                act.append(z.max(axis=1) + model[f"b{width}"])
            pre = np.concatenate(act, axis=1)
            h = np.maximum(pre, 0)
            p = softmax(h @ model["w"] + model["c"])
            p[np.arange(len(t)), t] -= 1
            p /= len(t)
            grad = {"w": h.T @ p, "c": p.sum(axis=0), "emb": np.zeros_like(model["emb"])}
            dh = (p @ model["w"].T) * (pre > 0)
            for i, width in enumerate(WIDTHS):
                d = dh[:, i * FILTERS:(i + 1) * FILTERS]
                at = arg[width]
                picked = np.take_along_axis(cols[width], at[:, :, None], axis=1)      # (B, F, width * E)
                grad[f"f{width}"] = np.einsum("bf,bfe->ef", d, picked)
                grad[f"b{width}"] = d.sum(axis=0)
                de = (d[:, :, None] * model[f"f{width}"].T[None]).reshape(len(x), FILTERS, width, EMBED)
                sym = np.take_along_axis(x, (at[:, :, None] + np.arange(width)).reshape(len(x), -1), axis=1)
                np.add.at(grad["emb"], sym.ravel(), de.reshape(-1, EMBED))
            grad["emb"][PAD] = 0
            step += 1
            for k in model:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                model[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        rate *= 0.6
    return model


def training_windows(df: DataFrame, text: str, label: str, key: str, learn: Column,
                     docs_per_label: int = TRAIN_DOCS_PER_LANG,
                     windows_per_doc: int = TRAIN_WINDOWS_PER_DOC) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """A bounded, repeatable sample of labelled windows.

    At most ``TRAIN_LANGS * docs_per_label * windows_per_doc`` windows of 256
    bytes reach the driver. Rows are chosen by the hash of their id.
    """
    labelled = df.where(learn & F.col(label).isNotNull() & F.col(text).isNotNull())
    top = labelled.groupBy(label).count().orderBy(F.desc("count"), F.asc(label)).limit(TRAIN_LANGS)
    counts = {r[label]: r["count"] for r in top.collect()}       # at most TRAIN_LANGS rows
    classes = sorted(counts)
    if not classes:
        return np.zeros((0, WINDOW), np.int16), np.zeros(0, np.int64), []
    # a hash range that holds about four times the bound, so that no label is ranked as a whole
    span = F.lit(0.0)
    for c in classes:
        span = F.when(F.col(label) == c, F.lit(min(1.0, 4.0 * docs_per_label / counts[c]))).otherwise(span)
    near = F.pmod(F.xxhash64(F.lit(3), F.col(key)), F.lit(1 << 20)) < span * (1 << 20)
    ranked = (labelled.where(F.col(label).isin(classes) & near)
              .select(F.col(key).alias("__k"), F.col(label).alias("__l"), F.xxhash64(F.col(key)).alias("__h"))
              .withColumn("__r", F.row_number().over(Window.partitionBy("__l").orderBy("__h", "__k")))
              .where(F.col("__r") <= docs_per_label).select("__k").distinct())
    chosen = (labelled.where(F.col(label).isin(classes))
              .join(F.broadcast(ranked), F.col(key) == F.col("__k"), "left_semi")      # bounded by the sample
              .groupBy(F.col(key).alias("k")).agg(F.min(F.struct(F.col(label).alias("l"), F.col(text).alias("t"))).alias("r"))
              .select("k", "r.l", "r.t"))

    def windows(batches):
        for b in batches:
            raw, off = utf8(b.column(2))
            keys, labels = b.column(0).to_pylist(), b.column(1).to_pylist()
            out_l, out_w, out_k = [], [], []
            for i in range(len(keys)):
                lo, hi = int(off[i]), int(off[i + 1])
                rng = np.random.default_rng(abs(hash((keys[i], hi - lo))) & 0xFFFFFFFF)
                n = 1 if hi - lo <= WINDOW else windows_per_doc
                for j in range(n):
                    s = lo if n == 1 else int(rng.integers(lo, hi - WINDOW + 1))
                    size = WINDOW if j else int(rng.integers(WINDOW // 8, WINDOW + 1))
                    out_k.append(keys[i])
                    out_l.append(labels[i])
                    out_w.append(raw[s:min(hi, s + size)].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(out_k, pa.int64()), pa.array(out_l, pa.string()),
                                              pa.array(out_w, pa.binary())], ["k", "l", "w"])

    rows = chosen.mapInArrow(windows, "k bigint, l string, w binary").toPandas()
    rows = rows.sort_values(["k", "l", "w"], kind="stable") if len(rows) else rows
    win = np.full((len(rows), WINDOW), PAD, np.int16)
    for i, w in enumerate(rows["w"]):
        win[i, :len(w)] = np.frombuffer(w, np.uint8)
    y = np.array([classes.index(x) for x in rows["l"]], np.int64)
    return win, y, classes


def predict(df: DataFrame, model: dict | None, classes: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """Language of every row: (doc_id, lang_pred, score)."""
    src = df.select(F.col(key).cast("bigint").alias("doc_id"),
                    F.when(F.col(text).rlike("\\p{L}"), F.col(text)).alias("t"))
    if model is None or not classes:
        return src.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = src.sparkSession.sparkContext.broadcast(model)      # a few tens of kB, fixed by the architecture

    def run(batches):
        net = shared.value
        names = np.array([*classes, "und"], dtype=object)
        for b in batches:
            raw, off = utf8(b.column(1))
            empty = np.asarray(b.column(1).is_null())
            total = np.zeros((b.num_rows, len(classes)))
            count = np.zeros(b.num_rows)
            for lo, hi in slices(off, 1 << 20):
                for a, z, win, rows in window_blocks(raw, off, lo, hi):
                    p = probabilities(net, win)
                    np.add.at(total, rows, p)
                    np.add.at(count, rows, 1)
            mean = total / np.maximum(count, 1)[:, None]
            best = mean.argmax(axis=1)
            score = np.clip(mean[np.arange(len(best)), best], 0, 1)
            best[empty] = len(classes)
            score[empty] = 0.0
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names[best].tolist(), pa.string()),
                                              pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return src.mapInArrow(run, SCHEMA)


def window_blocks(raw: np.ndarray, off: np.ndarray, lo: int, hi: int, block: int = 128):
    """Windows of the rows ``lo..hi`` in blocks that stay in cache: (first, last, windows, rows)."""
    o = off[lo:hi + 1]
    win, rows = cut_windows(raw[o[0]:o[-1]], o - o[0])
    for a in range(0, len(win), block):
        z = min(len(win), a + block)
        yield a, z, win[a:z], rows[a:z] + lo


def detect_languages(df: DataFrame, learn: Column, text: str = "text", label: str = "lang",
                     key: str = "doc_id") -> DataFrame:
    """Train on the labelled rows that satisfy ``learn`` and predict every row."""
    win, y, classes = training_windows(df, text, label, key, learn)
    model = train(win, y, len(classes)) if len(win) else None
    return predict(df, model, classes, text, key)
