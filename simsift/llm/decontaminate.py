"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared as lower-cased words with single blanks. A test item is
covered by probes of 64 characters that start every 16 (a shorter item is one
probe), so a passage of 79 characters holds a probe wherever it is cut. A probe
of ``m`` characters may differ by ``k = 5 % of m`` edits; cut into ``k + 1``
pieces, at least one piece must occur unchanged (pigeonhole). One automaton
finds all piece hits of a text, and every hit is verified with Myers'
bit-parallel edit distance, vectorised over the hits of a batch.

The test items are taken in blocks of bounded size; each block is one broadcast
and one pass over the documents, so any number of items works.

With ``word_borders`` an item too short for an edit (19 characters or fewer) must
stand between word borders, as the registered query and the pipeline ask.

Defined results: NULL and empty texts and items match nothing; an item that
occurs twice is reported under each of its ids; a hit is reported once per
document row and item, with its smallest distance and the span in the
normalised text; empty tables give no hits; further columns stay in
:func:`drop_hits` and are ignored by :func:`find_hits`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.llm.common import slices, trimmed, utf8

PROBE = 64                      # characters of a probe: one machine word
STEP = 16                       # the pieces of neighbouring probes coincide
ERROR_PERCENT = 5
SLICE_BYTES = 1 << 20          # bytes of text searched at once
BLOCK_CHARS = 1 << 19           # normalised test-item characters per pass
WORDS = re.compile(r"\w+")
HITS = ("doc_id bigint, item_id bigint, distance int, start int, end int")


def normal(text: str) -> str:
    return " ".join(WORDS.findall(text.lower()))


def budget(m: int) -> int:
    """Edits that a probe of ``m`` characters may differ by."""
    return m * ERROR_PERCENT // 100


def probes(item: str) -> list[str]:
    """Probes that cover a normalised item."""
    if len(item) <= PROBE:
        return [item] if item else []
    starts = list(range(0, len(item) - PROBE, STEP)) + [len(item) - PROBE]
    return [item[s:s + PROBE] for s in starts]


def pieces(probe: str) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length with their offsets."""
    n = budget(len(probe)) + 1
    edges = [len(probe) * i // n for i in range(n + 1)]
    return [(a, probe[a:b]) for a, b in zip(edges, edges[1:])]


def myers(patterns: np.ndarray, lengths: np.ndarray, which: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest edit distance of each pattern to a substring of its window, and where that substring ends.

    ``patterns`` holds the match masks (pattern, symbol); ``windows`` the
    symbols, 0 for none.
    """
    m = lengths[which].astype(np.uint64)
    top = m - np.uint64(1)
    pv = np.full(len(which), np.uint64(0xFFFFFFFFFFFFFFFF))
    mv = np.zeros(len(which), np.uint64)
    score = lengths[which].astype(np.int64)
    best, end = score.copy(), np.zeros(len(which), np.int64)
    one = np.uint64(1)
    for c in range(windows.shape[1]):
        eq = patterns[which, windows[:, c]]
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        score += ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64)
        ph <<= one
        mh <<= one
        pv = mh | ~(xv | ph)
        mv = ph & xv
        better = score < best
        best[better] = score[better]
        end[better] = c + 1
    return best, end


class Matcher:
    """Piece automaton and match masks of one block of test items."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.owner, texts = [], []
        for item, text in items:
            for p in probes(text):
                self.owner.append(item)
                texts.append(p)
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.budgets = np.array([budget(len(t)) for t in texts], np.int64)
        symbols = {c: i + 1 for i, c in enumerate(sorted(set("".join(texts))))}
        self.masks = np.zeros((len(texts), len(symbols) + 1), np.uint64)
        found: dict[str, list[tuple[int, int]]] = {}
        for i, t in enumerate(texts):
            for j, c in enumerate(t):
                self.masks[i, symbols[c]] |= np.uint64(1) << np.uint64(j)
            for offset, piece in pieces(t):
                found.setdefault(piece, []).append((i, offset + len(piece) - 1))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, where)
        if found:
            self.automaton.make_automaton()
        points = np.zeros(max(map(ord, symbols), default=0) + 1, np.int64)
        for c, i in symbols.items():
            points[ord(c)] = i
        self.points = points

    def search(self, texts: list[str], word_borders: bool = False) -> Iterator[tuple[int, int, int, int, int]]:
        """(text number, item, distance, start, end) for every item found in normalised texts."""
        if not self.owner:
            return
        at: dict[tuple[int, int, int], None] = {}
        for n, text in enumerate(texts):
            for end, where in self.automaton.iter(text):
                for probe, offset in where:
                    at[(n, probe, end - offset)] = None
        if not at:
            return
        hit = np.array(list(at), np.int64)
        best: dict[tuple[int, int], list[int]] = {}
        width = PROBE + 2 * int(self.budgets.max())
        codes = {n: np.frombuffer(texts[n].encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
                 for n in np.unique(hit[:, 0]).tolist()}
        for a in range(0, len(hit), 1 << 13):
            part = hit[a:a + (1 << 13)]
            k = self.budgets[part[:, 1]]
            windows = np.zeros((len(part), width), np.int64)
            first = np.maximum(0, part[:, 2] - k)
            last = part[:, 2] + self.lengths[part[:, 1]] + k
            for i, (n, lo, hi) in enumerate(zip(part[:, 0].tolist(), first.tolist(), last.tolist())):
                c = codes[n][lo:hi]
                windows[i, :len(c)] = np.where(c < len(self.points), self.points[np.minimum(c, len(self.points) - 1)], 0)
            distance, end = myers(self.masks, self.lengths, part[:, 1], windows)
            for i in np.flatnonzero(distance <= k):
                n, probe = int(part[i, 0]), int(part[i, 1])
                stop = int(first[i] + end[i])
                start = max(0, stop - int(self.lengths[probe]))
                if word_borders and k[i] == 0 and (texts[n][max(0, start - 1):start].strip() or texts[n][stop:stop + 1].strip()):
                    continue                                # an exact item inside longer words
                row = best.setdefault((n, self.owner[probe]), [int(distance[i]), start, stop])
                row[:] = min(row[0], int(distance[i])), min(row[1], start), max(row[2], stop)
        for (n, item), (d, s, e) in best.items():
            yield n, item, d, s, e


def item_blocks(items: DataFrame, text: str, key: str, limit: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Normalised items in blocks of bounded size; one block at a time is on the driver."""
    block, size = [], 0
    for r in items.select(key, text).where(F.col(text).isNotNull()).toLocalIterator():
        t = normal(r[text])
        if not t:
            continue
        if block and size + len(t) > limit:
            yield block
            block, size = [], 0
        block.append((r[key], t))
        size += len(t)
    if block:
        yield block


def matches(shared, b: pa.RecordBatch, column: int, word_borders: bool) -> Iterator[tuple[int, int, int, int, int]]:
    """Hits of one Arrow batch as (row, item, distance, start, end)."""
    matcher = Matcher(shared.value) if not hasattr(shared, "_matcher") else shared._matcher
    shared._matcher = matcher
    _, off = utf8(b.column(column))
    for lo, hi in slices(off, SLICE_BYTES):
        texts = [normal(t) if t else "" for t in b.column(column).slice(lo, hi - lo).to_pylist()]
        for n, *rest in matcher.search(texts, word_borders):
            yield lo + n, *rest


def find_hits(df: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id",
              item_text: str = "text", item_key: str = "item_id", word_borders: bool = False) -> DataFrame:
    """(doc_id, item_id, distance, start, end): every test item found in every document."""
    spark = df.sparkSession
    src = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("t"))
    out = None
    for block in item_blocks(items, item_text, item_key):
        shared = spark.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for b in batches:
                rows = list(matches(shared, b, 1, word_borders))
                ids = b.column(0).take(pa.array([r[0] for r in rows], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([r[1] for r in rows], pa.int64()),
                     *[pa.array([r[i] for r in rows], pa.int32()) for i in (2, 3, 4)]],
                    ["doc_id", "item_id", "distance", "start", "end"])

        found = src.mapInArrow(trimmed(run), HITS)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], HITS)


def drop_hits(df: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text",
              item_key: str = "item_id", word_borders: bool = False) -> DataFrame:
    """The rows of ``df`` that hold no test item, filtered in place with all their columns."""
    at = df.columns.index(text)
    out = df
    for block in item_blocks(items, item_text, item_key):
        shared = df.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                clean[[r[0] for r in matches(shared, b, at, word_borders)]] = False
                yield b.filter(pa.array(clean))

        out = out.mapInArrow(trimmed(run), df.schema)
    return out
