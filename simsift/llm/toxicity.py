"""Toxicity scores from a subsequence string-kernel SVM with Nyström landmarks.

A word is described by its subsequences of three symbols, which may skip
symbols inside a span of at most six; every skipped or covered symbol costs a
factor ``DECAY``. Inserted characters ("id.iot") and left-out ones keep most of
these subsequences. The kernel of two words is the inner product of these
weighted counts, each side divided by the norm of a repeat-free word of its
length. Landmarks (the labelled words that tell the classes apart best and the
most common clean words) give the Nyström features in which a linear SVM is
trained. As the kernel has an explicit feature space, the trained machine folds
into one weight per subsequence, so that a text is scored by table lookups.

Labels exist per text, so training alternates between picking the most toxic
word of each toxic text (first by the log odds of its grams; never a word about
as frequent in clean texts) and refitting against the worst words of clean texts.
A word can be picked only for a gram that more toxic texts hold than random
labels would explain, however many grams there are; a toxic text without one is
not learned from. Picked words are also learned with one sign put between their
symbols. A text's score is the calibrated maximum over its words; the cut is set
so that false alarms weigh more than misses.

Symbols: letters are folded to lower case; blanks end a word; single letters
parted by blanks count as one word ("i d i o t"); words longer than 24 symbols
are scored in pieces that overlap, so that what lies across a cut stands whole in
another piece; only the ends of the word itself count as word ends.

Defined results: NULL and empty texts have no word and take the score of a text
without evidence (below 0.5); without labelled rows of both classes, or without a
gram that tells them apart, every text scores 0; repeated rows are scored one by one; ties need no order; further
columns of the input are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsift.llm.common import slices, trimmed, utf8

TRAIN_DOCS = (2500, 1200)       # bound of the labelled sample: clean, toxic
CALIBRATE = 4                   # one sampled text in four sets the cut and is not fitted
TRAIN_DOC_BYTES = 8_000         # longer texts are scored but not learned from
LANDMARKS = 96                  # per class
DECAY = 0.75
SPAN = 6
SYMBOLS = 64
PIECE = 24
STEP = 6                        # between the pieces of a longer word: they share 20 symbols, an insult of 14 and SPAN
ROUNDS = 3
TELLING = 8                     # times more frequent in toxic texts, a word and its gram
STRONG = 0.02                   # share of toxic texts
CHANCE = 1e-2                   # of calling any gram telling when labels were drawn at random
ALARM = 10.0                    # misses that one false alarm outweighs where the cut is set (as shares of their class)
BLANK, MARK = 0, 27             # word end; any other ASCII sign or digit
CUT = b"\xff"                   # stands for a side of a piece that is not a word end
SCHEMA = "doc_id bigint, score double, predicted int"

PAIRS = [(j, k) for k in range(2, SPAN) for j in range(1, k)]       # offsets of the 2nd and 3rd symbol


def symbol_table() -> np.ndarray:
    """Byte -> symbol: blanks 0, letters 1..26, other ASCII 27, other bytes 28..63."""
    t = np.full(256, MARK, np.uint8)
    for c in b" \t\n\r\x0b\x0c":
        t[c] = BLANK
    for i in range(26):
        t[97 + i] = t[65 + i] = 1 + i
    for c in range(128, 256):
        t[c] = 28 + c % 36
    return t


def fold(raw: np.ndarray) -> np.ndarray:
    """Lower-case accented Latin letters (U+00C0..U+00DE) written in UTF-8."""
    out = raw.copy()
    cap = np.zeros(len(raw), bool)
    if len(raw) > 1:
        cap[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
        out[cap] += 0x20
    return out


def word_symbols(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words, each framed by BLANK: (symbols, word starts, row of each word).

    ``starts`` has one more entry than there are words; word ``i`` occupies
    ``symbols[starts[i]:starts[i + 1]]`` with its frame. A word beyond ``PIECE``
    symbols gives overlapping pieces, framed at the ends of the word only.
    """
    table = symbol_table()
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.int64)
    sym = table[fold(raw)]
    is_first = np.zeros(n + 1, bool)
    is_first[offsets[:-1][np.diff(offsets) > 0]] = True
    blank = sym == BLANK
    begins = ~blank.copy()
    begins[1:] &= blank[:-1] | is_first[1:n]
    b = np.flatnonzero(begins)
    if len(b) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, np.int64)
    after = np.append(blank[1:], True) | is_first[1:]
    e = np.flatnonzero(~blank & after) + 1
    row = np.searchsorted(offsets, b, side="right") - 1
    single = (e - b) == 1
    joins = np.zeros(len(b), bool)                         # word goes on in the one before it
    joins[1:] = single[1:] & single[:-1] & (row[1:] == row[:-1])
    length = e - b
    head = np.flatnonzero(~joins)
    body = sym[~blank]
    word_len = np.add.reduceat(length, head)
    word_row = row[head]
    starts = np.concatenate([[0], np.cumsum(word_len + 2)])
    out = np.zeros(starts[-1], np.uint8)
    inside = np.ones(starts[-1], bool)
    inside[starts[:-1]] = False
    inside[starts[1:] - 1] = False
    out[inside] = body
    if word_len.max() <= PIECE:
        return out, starts, word_row
    pieces = 1 + -(-np.maximum(word_len - PIECE, 0) // STEP)
    first = np.cumsum(pieces) - pieces
    idx = np.repeat(np.arange(len(head)), pieces)
    begin = starts[idx] + (np.arange(len(idx)) - first[idx]) * STEP
    piece_len = np.minimum(PIECE + 2, starts[idx + 1] - begin)
    ends = np.cumsum(piece_len)
    take = np.arange(ends[-1]) + np.repeat(begin - (ends - piece_len), piece_len)
    return out[take], np.concatenate([[0], ends]), word_row[idx]


def norms() -> np.ndarray:
    """Kernel norm of a repeat-free word by framed length."""
    out = np.ones(PIECE + 3)
    for n in range(3, PIECE + 3):
        out[n] = np.sqrt(sum(DECAY ** (2 * (k + 1)) * (n - k) for _, k in PAIRS if n > k))
    return out


def word_sums(sym: np.ndarray, starts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Sum of the weighted subsequences of each word, divided by its norm."""
    n = len(sym)
    if len(starts) == 1:
        return np.zeros(0)
    s = np.concatenate([sym, np.zeros(SPAN, np.uint8)]).astype(np.int32)
    ends = np.repeat(starts[1:], np.diff(starts)).astype(np.int32)
    room = ends - np.arange(n, dtype=np.int32)              # symbols left in the word
    total = np.zeros(n, np.float32)
    first = s[:n] * (SYMBOLS * SYMBOLS)
    for k in range(2, SPAN):
        last = first + s[k:n + k]
        part = np.zeros(n, np.float32)
        for j in range(1, k):
            part += weight[last + s[j:n + j] * SYMBOLS]
        part *= np.float32(DECAY ** (k + 1))
        part[room <= k] = 0
        total += part
    return np.add.reduceat(total, starts[:-1]) / norms()[np.diff(starts)]


def features(sym: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All subsequences with their words: (subsequence index, weight, word), ordered by word."""
    idx, val, word = [], [], []
    s = np.concatenate([sym, np.zeros(SPAN, np.uint8)]).astype(np.int64)
    n = len(sym)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    room = np.repeat(starts[1:], np.diff(starts)) - np.arange(n)
    norm = norms()[np.diff(starts)]
    for j, k in PAIRS:
        ok = room > k
        idx.append((s[:n] * SYMBOLS * SYMBOLS + s[j:n + j] * SYMBOLS + s[k:n + k])[ok])
        word.append(owner[ok])
        val.append(np.full(int(ok.sum()), DECAY ** (k + 1)) / norm[owner[ok]])
    word = np.concatenate(word)
    order = np.argsort(word, kind="stable")
    return np.concatenate(idx)[order], np.concatenate(val)[order], word[order]


def framed(word: bytes) -> bytes:
    """The word between blanks; a side marked ``CUT`` gets none."""
    left, right = word[:1] == CUT, word[-1:] == CUT
    return b"\0" * (not left) + word[left:len(word) - right] + b"\0" * (not right)


def unframed(piece: bytes) -> bytes:
    """Inverse of ``framed``: frames go, a side without one is marked ``CUT``."""
    return CUT * (piece[0] != BLANK) + piece.strip(b"\0") + CUT * (piece[-1] != BLANK)


def frame(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    whole = [framed(w) for w in words]
    starts = np.concatenate([[0], np.cumsum([len(w) for w in whole])]).astype(np.int64)
    return np.frombuffer(b"".join(whole), np.uint8), starts


def kernel_rows(words: list[bytes], lookup: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Kernel of each word with each landmark."""
    out = np.zeros((len(words), table.shape[1]), np.float32)
    for a in range(0, len(words), 256):
        sym, starts = frame(words[a:a + 256])
        idx, val, word = features(sym, starts)
        at = lookup[idx]
        hit = at >= 0
        if hit.any():
            w, rows = word[hit], table[at[hit]] * val[hit, None].astype(np.float32)
            heads = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            out[a + w[heads]] = np.add.reduceat(rows, heads, axis=0)
    return out


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 100.0, steps: int = 400) -> np.ndarray:
    """Squared-hinge linear SVM by conjugate Newton steps on the active rows."""
    x1 = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w = np.zeros(x1.shape[1])
    reg = np.ones(len(w))
    reg[-1] = 1e-3
    for _ in range(30):
        active = y * (x1 @ w) < 1
        xa, ca = x1[active], c * weight[active]
        h = np.diag(reg) + (xa * ca[:, None]).T @ xa
        new = np.linalg.solve(h, xa.T @ (ca * y[active]))
        if np.abs(new - w).max() < 1e-6:
            return new
        w = w + 0.8 * (new - w)
    return w


def grams(word: bytes) -> list[bytes]:
    """Runs of four symbols of the framed word (the whole word when it is shorter)."""
    w = framed(word)
    return [w[i:i + 4] for i in range(max(1, len(w) - 3))]


def marked(word: bytes) -> list[bytes]:
    """The word with one sign put before, between or after its symbols, at each place."""
    return [word[:i] + bytes([MARK]) + word[i:] for i in range(len(word) + 1) if CUT not in (word[:1], word[-1:])]


def gram_counts(docs: list[list[bytes]], y: np.ndarray) -> list[dict[bytes, int]]:
    """In how many clean and toxic texts each gram of the toxic texts occurs."""
    out: list[dict[bytes, int]] = [{}, {}]
    for label in (1, 0):
        d = out[label]
        for words in (w for w, c in zip(docs, y) if c == label):
            for g in {g for w in words for g in grams(w)}:
                if label or g in out[1]:
                    d[g] = d.get(g, 0) + 1
    return out


def chance(a: int, b: int, p: float) -> float:
    """Probability that at least ``a`` of ``a + b`` texts are toxic when each is with probability ``p``."""
    n = a + b
    log_fact = [math.lgamma(i + 1) for i in (n, a, b)]
    term = math.exp(log_fact[0] - log_fact[1] - log_fact[2] + a * math.log(p) + b * math.log1p(-p))
    total = 0.0
    for k in range(a, n + 1):
        total += term
        if k > n * p and term < 1e-9 * total:
            break
        term *= (n - k) / (k + 1) * p / (1 - p)
    return total


def distinct_texts(docs: list[list[bytes]], y: np.ndarray) -> tuple[list[list[bytes]], np.ndarray]:
    """One of the texts with the same words and label: copies are no further evidence."""
    first = sorted({(tuple(d), int(c)): i for i, (d, c) in reversed(list(enumerate(zip(docs, y))))}.values())
    return [docs[i] for i in first], y[first]


def train(docs: list[list[bytes]], y: np.ndarray, rounds: int = ROUNDS) -> dict | None:
    """Fit on texts given as lists of words (symbol strings) with labels 0/1.

    None when no gram stands in more toxic texts than chance explains (a binomial
    test for each gram, ``CHANCE`` shared among all of them). A toxic text without
    such a gram cannot be told from its words and is left out.
    """
    y = np.asarray(y)
    if len(docs) == 0 or y.min() == y.max():
        return None
    df = [{}, {}]
    for words, label in zip(docs, y):
        d = df[label]
        for w in set(words):
            d[w] = d.get(w, 0) + 1
    nt, nc = int(y.sum()), int((1 - y).sum())
    gram_df = gram_counts(docs, y)

    def odds(g):
        a, b = gram_df[1].get(g, 0), gram_df[0].get(g, 0)
        return a / nt * np.log((a + 0.01) / nt / ((b + 0.5) / nc))

    def evidence(w):                                        # a word is as telling as its most telling gram
        return max((odds(g), g) for g in grams(w))

    level = CHANCE / max(1, len(gram_df[1]))
    sure = {g for g, a in gram_df[1].items() if a / nt >= TELLING * gram_df[0].get(g, 0) / nc
            and chance(a, gram_df[0].get(g, 0), nt / (nt + nc)) < level}
    # words that clean texts use nearly as often are no evidence
    telling = {w: evidence(w) for w, n in df[1].items() if n / nt >= TELLING * df[0].get(w, 0) / nc}
    telling = {w: e for w, e in telling.items() if e[1] in sure}
    if not telling:
        return None
    toxic_marks, per_gram = [], {}
    for w in sorted(telling, key=lambda w: (-telling[w][0], -df[1][w], w)):
        g = telling[w][1]
        if per_gram.get(g, 0) < 3:
            per_gram[g] = per_gram.get(g, 0) + 1
            toxic_marks.append(w)
        if len(toxic_marks) == LANDMARKS:
            break
    clean_marks = sorted(df[0], key=lambda w: (-df[0][w], w))[:LANDMARKS]
    marks = list(dict.fromkeys(toxic_marks + clean_marks))
    sym, starts = frame(marks)
    idx, val, word = features(sym, starts)
    used, at = np.unique(idx, return_inverse=True)
    table = np.zeros((len(used), len(marks)), np.float32)
    np.add.at(table, (at, word), val)
    lookup = np.full(SYMBOLS ** 3, -1, np.int32)
    lookup[used] = np.arange(len(used))
    kmm = table.T.astype(np.float64) @ table
    vals, vecs = np.linalg.eigh(kmm)
    keep = vals > 1e-6 * vals.max()
    whiten = vecs[:, keep] / np.sqrt(vals[keep])            # Nyström map

    vocab = sorted(set(df[0]) | set(df[1]))
    pos_of = {w: i for i, w in enumerate(vocab)}
    suspects = {i: np.array(sorted({pos_of[w] for w in d if w in telling}), np.int64)
                for i, d in enumerate(docs) if y[i] == 1 and any(w in telling for w in d)}
    if not suspects:
        return None
    rank = np.array([telling[w][0] if w in telling else -np.inf for w in vocab])
    wit = {i: int(d[rank[d].argmax()]) for i, d in suspects.items()}
    # a telling word that many toxic texts use counts even where a worse one stands beside it
    strong = [j for j, w in enumerate(vocab) if w in telling and df[1][w] >= STRONG * nt for _ in range(df[1][w] // 4)]
    clean_vocab = sorted(pos_of[w] for w in df[0])
    rng = np.random.default_rng(11)
    neg = set(sorted(clean_vocab, key=lambda i: -df[0][vocab[i]])[:2000])
    neg |= set(int(i) for i in rng.permutation(clean_vocab)[:4000])
    beta, bias, f = None, 0.0, None
    for _ in range(rounds):
        pos_words, pos_n = np.unique([*wit.values(), *strong], return_counts=True)
        negs = np.array(sorted(neg - set(pos_words.tolist())), np.int64)
        rows = np.concatenate([pos_words, negs])
        cost = np.concatenate([pos_n / pos_n.mean(), np.ones(len(negs))])
        broken = [(v, c / len(vs)) for i, c in zip(pos_words, cost) if (vs := marked(vocab[i])) for v in vs]
        x = kernel_rows([vocab[i] for i in rows] + [v for v, _ in broken], lookup, table) @ whiten
        t = np.concatenate([np.ones(len(pos_words)), -np.ones(len(negs)), np.ones(len(broken))])
        cost = np.concatenate([cost, [c for _, c in broken]])
        w = svm(x, t, cost)
        beta = np.zeros(SYMBOLS ** 3, np.float32)
        beta[used] = table @ (whiten @ w[:-1])
        bias = float(w[-1])
        f = np.concatenate([word_sums(*frame(vocab[a:a + 20_000]), beta) for a in range(0, len(vocab), 20_000)]) + bias
        wit = {i: int(d[f[d].argmax()]) for i, d in suspects.items()}
        worst = np.array(clean_vocab)[np.argsort(-f[clean_vocab])[:3000]]
        neg |= set(int(i) for i in worst)
    return {"beta": beta, "bias": bias, "a": 4.0, "b": 0.0}


def calibrate(model: dict, docs: list[list[bytes]], y: np.ndarray) -> dict:
    """Set the cut on texts that were not fitted.

    The cut loses as few toxic texts as possible where one share of false alarms
    counts as ``ALARM`` such shares of misses: labels that the words do not bear
    out then cost recall, not clean texts. Of the cuts within one miss of the best
    the one in the widest gap between two scores is taken, a third of the way up
    (distorted insults score lower than those that the sample holds).
    """
    def top(words):
        sym, starts = frame(words)
        return float((word_sums(sym, starts, model["beta"]) + model["bias"]).max()) if words else -3.0

    f = np.array([top(d) for d in docs])
    if len(f) == 0 or y.min() == y.max():
        return model
    order = np.argsort(f, kind="stable")
    fs, ys = f[order], y[order]
    pos, neg = ys.sum(), len(ys) - ys.sum()
    missed = np.concatenate([[0], np.cumsum(ys)]) / pos              # the cut below score i, above all others
    alarms = (neg - np.concatenate([[0], np.cumsum(1 - ys)])) / neg
    loss = missed + ALARM * alarms
    edges = np.concatenate([[fs[0] - 1e-3], fs, [fs[-1] + 1e-3]])
    width = np.where(loss <= loss.min() + 1.001 / pos, np.diff(edges), -1.0)
    at = int(width.argmax())
    return model | {"b": float((2 * edges[at] + edges[at + 1]) / 3)}


def labelled_words(df: DataFrame, labels: DataFrame, learn: Column, text: str, key: str, label: str,
                   bound: tuple[int, int] = TRAIN_DOCS) -> tuple[list[list[bytes]], np.ndarray]:
    """Words of a bounded, repeatable sample of labelled texts (by hash of the id)."""
    known = (labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("__k"), F.col(label).cast("int").alias("__y"))
             .groupBy("__k").agg(F.max("__y").alias("__y")))
    ids = (df.where(learn & (F.octet_length(text) <= TRAIN_DOC_BYTES)).select(F.col(key).alias("__k")).distinct()
           .join(known, "__k"))
    picked = [ids.where(F.col("__y") == c).orderBy(F.xxhash64("__k"), "__k").limit(bound[c]) for c in (0, 1)]
    rows = picked[0].unionByName(picked[1]).collect()            # at most sum(bound) ids
    if not rows:
        return [], np.zeros(0, np.int64)
    y_of = {r["__k"]: r["__y"] for r in rows}
    sample = df.where(F.col(key).isin(list(y_of)) & (F.octet_length(text) <= TRAIN_DOC_BYTES)) \
        .groupBy(F.col(key).alias("k")).agg(F.max(text).alias("t"))

    def words(batches):
        for b in batches:
            raw, off = utf8(b.column(1))
            out = []
            for i in range(b.num_rows):
                sym, starts, _ = word_symbols(raw[off[i]:off[i + 1]], np.array([0, off[i + 1] - off[i]]))
                blob = sym.tobytes()
                out.append(sorted({unframed(blob[s:e]) for s, e in zip(starts[:-1], starts[1:])}))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.binary()))], ["k", "w"])

    got = sorted(((r["k"], r["w"]) for r in sample.mapInArrow(trimmed(words), "k bigint, w array<binary>").toLocalIterator()),
                 key=lambda r: r[0])
    return [[bytes(w) for w in ws] for _, ws in got], np.array([y_of[k] for k, _ in got], np.int64)


def score(df: DataFrame, model: dict | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, score, predicted) for every row."""
    src = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("t"))
    if model is None:
        return src.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = src.sparkSession.sparkContext.broadcast(model)       # 64^3 weights: 1 MB, fixed

    def run(batches):
        net = shared.value
        for b in batches:
            raw, off = utf8(b.column(1))
            best = worst_words(net, raw, off)
            p = 1 / (1 + np.exp(-np.clip(net["a"] * (best - net["b"]), -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p, pa.float64()),
                                              pa.array((p >= 0.5).astype(np.int32), pa.int32())],
                                             ["doc_id", "score", "predicted"])

    return src.mapInArrow(trimmed(run), SCHEMA)


def drop_toxic(df: DataFrame, model: dict | None, text: str = "text") -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, filtered in place with all their columns."""
    if model is None:
        return df
    at = df.columns.index(text)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        net = shared.value
        for b in batches:
            raw, off = utf8(b.column(at))
            yield b.filter(pa.array(net["a"] * (worst_words(net, raw, off) - net["b"]) < 0))

    return df.mapInArrow(trimmed(run), df.schema)


def worst_words(net: dict, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The largest decision value over the words of each row."""
    best = np.full(len(off) - 1, min(-3.0, net["b"] - 1.0))
    for lo, hi in slices(off, 1 << 18):
        o = off[lo:hi + 1]
        sym, starts, row = word_symbols(raw[o[0]:o[-1]], o - o[0])
        if len(row):
            np.maximum.at(best, row + lo, word_sums(sym, starts, net["beta"]) + net["bias"])
    return best


def fit(df: DataFrame, labels: DataFrame, learn: Column, text: str = "text", key: str = "doc_id",
        label: str = "toxic") -> dict | None:
    """Train on the labelled rows of ``df`` that satisfy ``learn``."""
    docs, y = labelled_words(df, labels, learn, text, key, label)
    return fit_sample(docs, y)


def fit_sample(docs: list[list[bytes]], y: np.ndarray) -> dict | None:
    """Fit on three parts of the sample and set the cut on the fourth (on all when it is tiny).

    Copies are no further evidence and count once, unless hardly any text would be left.
    """
    once = distinct_texts(docs, y)
    if len(once[0]) >= 40:
        docs, y = once
    if len(docs) < 40:
        model = train(docs, y)
        return model and calibrate(model, docs, y)
    held = np.arange(len(docs)) % CALIBRATE == 0
    model = train([d for d, h in zip(docs, held) if not h], y[~held]) or train(docs, y)
    return model and calibrate(model, [d for d, h in zip(docs, held) if h], y[held])
