"""Removal of repeated byte strings with merged Burrows-Wheeler transforms.

A byte is removed when it lies in a string of ``LENGTH`` bytes that also starts
in a document with a smaller id. Of equal texts only the smallest id goes
through the three steps below; the others lose everything (when long enough).

1. *Anchors.* In every window of ``LENGTH`` bytes the gram of ``GRAM`` bytes with
   the smallest hash is its anchor; equal windows have equal anchors, and agree
   on 15 bytes on one side of them at least. Anchors that no other document
   shares in this way cannot belong to a repeat; this takes one narrow shuffle,
   sorted so that a hot anchor streams through.
2. *Merged transforms.* The byte runs around the shared anchors (80 bytes at
   most) are grouped by anchor. A task cuts them into shards, sorts the
   suffixes of each shard, and merges the shard transforms by refining one
   interleave: starting from the order by two bytes, each round moves every
   suffix to its predecessor eight bytes earlier by a stable sort on the symbol
   between them (the transform's LF step with a symbol of eight bytes), so the
   order by ``h`` bytes becomes the order by ``h + 8``. Boundaries that appear
   in a round give the common prefix lengths; after six rounds the intervals
   without a boundary are exactly the repeated strings of 50 bytes, and the
   smallest id of each interval decides. The suffixes of all shards are never
   sorted together.
3. *Cutting.* The removed ranges are joined to the texts.

Equal runs enter a transform once, with the smallest id that has them, and only
runs that share 15 bytes beside the anchor with another run do. A group
of runs too large for a task is resolved by grouping its windows themselves
(pre-aggregated, so it does not meet in one task): the exact way for hot groups.

Defined results: NULL text is empty; texts shorter than ``LENGTH`` keep all bytes;
a NULL id counts as smaller than any other; rows with equal ids do not remove
from each other, and rows equal in id and text have equal results; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsift.llm.common import cut, fresh_path, release, sized_broadcast, slices, utf8

LENGTH = 50
GRAM = 20
HALF = (LENGTH - GRAM) // 2     # two equal windows share this much on one side of their anchor
SPAN = LENGTH - GRAM + 1        # grams of a window, and windows of a run
SHARD = 1 << 13                 # suffixes of a shard
BLOCK = 60_000                  # suffixes merged at a time (fits 16-bit symbols)
GROUP_ROWS = 1 << 19            # a larger group goes the exact way for hot groups
ROWS = 1 << 16                  # rows whose groups are resolved together
SYMBOL = 8
NO_ID = -(1 << 63)              # NULL ids
PLACE = 24                      # bits for positions while anchors are looked up
HOLD = 1 << 18                  # rows of one anchor that are held


# --- anchors -----------------------------------------------------------------

def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the gram at every position (from overlapping 8-byte words)."""
    n = len(raw) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    words = np.ndarray((len(raw),), "<u8", padded, strides=(1,))
    a = words[:n] * np.uint64(0x9E3779B97F4A7C15)
    for o in [*range(8, GRAM - 8, 8), GRAM - 8]:
        a ^= a >> np.uint64(29)
        a += words[o:n + o]
        a *= np.uint64(0xBF58476D1CE4E5B9)
    a ^= a >> np.uint64(32)
    return a


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    m, k = a, 1
    while 2 * k <= width:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    return np.minimum(m[:len(m) - (width - k)], m[width - k:]) if k < width else m


def runs(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: (row, first window, windows, anchor position, anchor hash).

    Positions are absolute in ``raw``; a run has ``SPAN`` windows at most. Of
    equal smallest hashes (compared on their upper 40 bits) the leftmost gram
    is the anchor.
    """
    parts = []
    for c in range(0, max(len(raw) - LENGTH + 1, 0), 1 << (PLACE - 1)):
        piece = raw[c:c + (1 << (PLACE - 1)) + LENGTH - 1]
        hashes = gram_hashes(piece)
        low = (1 << PLACE) - 1
        packed = (hashes & np.uint64(~low & 0xFFFFFFFFFFFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
        place = (sliding_min(packed, SPAN) & np.uint64(low)).astype(np.int64)
        start = np.arange(len(place)) + c
        row = np.repeat(np.arange(len(off) - 1), np.diff(np.clip(off, c, c + len(start))))
        inside = start + LENGTH <= off[1:][row]
        row, start, place = row[inside], start[inside], place[inside]
        if not len(row):
            continue
        head = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])))
        parts.append((row[head], start[head], np.diff(np.append(head, len(row))), place[head] + c, hashes[place[head]]))
    if not parts:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty, empty.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def side_marks(raw: np.ndarray, off: np.ndarray, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """16-bit hashes of the ``HALF`` bytes before (upper) and after (lower) each anchor; 0 where the text ends."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    words = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))

    def mark(at, ok):
        at = np.where(ok, at, 0)
        x = words[at] * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x += words[np.minimum(at + HALF - 8, len(raw))]
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return np.where(ok, (x >> np.uint64(48)) | np.uint64(1), np.uint64(0)).astype(np.int64)

    left = mark(place - HALF, place - HALF >= off[:-1][row])
    right = mark(place + GRAM, place + GRAM + HALF <= off[1:][row])
    return (left << 16 | right).astype(np.uint32).view(np.int32)


def anchors(df: DataFrame) -> DataFrame:
    """(h, id, sides, th): the anchors of every text with the marks of their surroundings; ``th`` is its hash."""
    def run(batches):
        for b in batches:
            raw, off = utf8(b.column(2))
            ids, th = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, hi in slices(off, 1 << 18):
                o = off[lo:hi + 1]
                part, o = raw[o[0]:o[-1]], o - o[0]
                row, _, _, place, value = runs(part, o)
                sides = side_marks(part, o, row, place)
                # repeats inside a text say nothing about other texts
                order = np.lexsort((sides, value, row))
                row, value, sides = row[order], value[order], sides[order]
                keep = np.ones(len(row), bool)
                keep[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1]) | (sides[1:] != sides[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value[keep].view(np.int64)), pa.array(ids[lo + row[keep]], pa.int64()),
                     pa.array(sides[keep]), pa.array(th[lo + row[keep]], pa.int64())], ["h", "id", "sides", "th"])

    return df.select("id", F.xxhash64("t").alias("th"), "t").mapInArrow(run, "h bigint, id bigint, sides int, th bigint")


def met_twice(h: np.ndarray, d: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """Rows, sorted by ``h``, that share the anchor and one of its sides with another id."""
    found = np.zeros(len(h), bool)
    new = np.append(True, h[1:] != h[:-1])
    size = np.diff(np.append(np.flatnonzero(new), len(h)))
    several = np.flatnonzero(np.repeat(size > 1, size))
    if not len(several):
        return found
    group = np.cumsum(new)[several].astype(np.int64)
    s, d = sides[several].view(np.uint32).astype(np.int64), d[several]
    for side in (s >> 16, s & 0xFFFF):
        keep = np.flatnonzero(side > 0)
        if not len(keep):
            continue
        key = group[keep] << 16 | side[keep]
        order = np.argsort(key, kind="stable")
        k, ids = key[order], d[keep][order]
        head = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
        many = np.minimum.reduceat(ids, head) != np.maximum.reduceat(ids, head)
        found[several[keep[order[np.repeat(many, np.diff(np.append(head, len(k))))]]]] = True
    return found


def shared_anchors(found: DataFrame, hold: int = HOLD) -> DataFrame:
    """(id, th, h) of the anchors that may belong to a repeat.

    Two equal windows agree on their anchor and on ``HALF`` bytes on one side of
    it. Rows arrive sorted by anchor, and the current anchor's rows are held; an
    anchor with more than ``hold`` rows passes without the test of its sides.
    """
    def run(batches):
        held = [np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int64)]
        passing = None

        def pack(ids, th, hs):
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, th, hs)], ["id", "th", "h"])

        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if not len(cols[0]):
                continue
            if passing is not None:
                n = int(np.searchsorted(cols[0], passing, side="right"))
                yield pack(cols[1][:n], cols[3][:n], cols[0][:n])
                cols = [c[n:] for c in cols]
                if not len(cols[0]):
                    continue
                passing = None
            h, d, s, th = (np.concatenate([a, c]) for a, c in zip(held, cols))
            last = int(np.searchsorted(h, h[-1], side="left"))
            hit = met_twice(h[:last], d[:last], s[:last])
            yield pack(d[:last][hit], th[:last][hit], h[:last][hit])
            held = [h[last:], d[last:], s[last:], th[last:]]
            if len(held[0]) > hold:
                passing = int(h[-1])
                yield pack(held[1], held[3], held[0])
                held = [x[:0] for x in held]
        hit = met_twice(*held[:3])
        yield pack(held[1][hit], held[3][hit], held[0][hit])

    return found.repartition("h").sortWithinPartitions("h").mapInArrow(run, "id bigint, th bigint, h bigint")


def anchor_sets(hits: DataFrame) -> DataFrame:
    """(id, th, hs): the shared anchors of each text, bounded by the text also where ids repeat or are missing."""
    return hits.groupBy("id", "th").agg(F.collect_set("h").alias("hs"))


def shared_runs(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """(h, seg, id, th, start, anchor): the byte runs around shared anchors; ``anchor`` is its offset in the run."""
    def run(batches):
        for b in batches:
            raw, off = utf8(b.column(2))
            lists = b.column(3)
            hit_off = lists.offsets.to_numpy().astype(np.int64)
            hit_val = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)
            ids, th = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, hi in slices(off, 1 << 18):
                o = off[lo:hi + 1]
                part, o = raw[o[0]:o[-1]], o - o[0]
                row, start, n, place, value = runs(part, o)
                mix = np.uint64(0xD6E8FEB86659FD93)
                wanted = np.repeat(np.arange(hi - lo, dtype=np.uint64), np.diff(hit_off[lo:hi + 1])) * mix
                known = np.isin(value ^ (row.astype(np.uint64) * mix), hit_val[hit_off[lo]:hit_off[hi]] ^ wanted)
                row, start, n, place, value = row[known], start[known], n[known], place[known], value[known]
                if not len(row):
                    continue
                size = n + LENGTH - 1
                ends = np.cumsum(size)
                take = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
                seg = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(
                    np.concatenate([[0], ends]).astype(np.int32).tobytes()), pa.py_buffer(part[take].tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(value.view(np.int64)), seg, pa.array(ids[lo + row], pa.int64()),
                     pa.array(th[lo + row], pa.int64()), pa.array((start - o[row]).astype(np.int32)),
                     pa.array((place - start).astype(np.int32))], ["h", "seg", "id", "th", "start", "anchor"])

    return docs.join(anchor_sets(hits), ["id", "th"]).select("id", "th", "t", "hs").mapInArrow(
        run, "h bigint, seg binary, id bigint, th bigint, start int, anchor int")


# --- merged transforms --------------------------------------------------------

def suffix_rows(segs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All suffixes, zero padded with symbols byte + 1: (rows, segment, offset).

    No byte of UTF-8 is 255, so the shifted symbol fits a byte and 0 marks the end.
    """
    sizes = np.array([len(s) for s in segs], np.int64)
    width = -(-int(sizes.max()) // SYMBOL) * SYMBOL + SYMBOL
    data = np.frombuffer(b"".join(segs), np.uint8) + np.uint8(1)
    seg = np.repeat(np.arange(len(segs)), sizes)
    base = np.cumsum(sizes) - sizes
    offset = np.arange(len(seg)) - base[seg]
    flat = np.zeros(len(segs) * width * 2, np.uint8)
    flat[seg * width * 2 + offset] = data
    rows = np.lib.stride_tricks.as_strided(flat, (len(segs) * width * 2 - width + 1, width), (1, 1))
    return np.ascontiguousarray(rows[seg * width * 2 + offset]), seg, offset


def shard_transform(rows: np.ndarray) -> np.ndarray:
    """Suffix order of one shard (whole suffixes; equal ones by segment)."""
    return np.argsort(rows.view(f"V{rows.shape[1]}").ravel(), kind="stable")


def dense(keys: np.ndarray) -> np.ndarray:
    """Order-preserving small symbols for big-endian keys."""
    found, at = np.unique(keys, return_inverse=True)
    return at.astype(np.uint16 if len(found) <= 1 << 16 else np.uint32)


def merge_transforms(segs: list[bytes], shard: int = SHARD) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge the transforms of the shards of ``segs`` up to a context of ``LENGTH`` bytes.

    Returns, in merged order, the segment and offset of every suffix and its
    interval number, and the common prefix with the suffix before it (rounded
    down to 2 + 8 * i, capped at ``LENGTH``).
    """
    rows, seg, offset = suffix_rows(segs)
    n = len(rows)
    word8 = dense(rows[:, :SYMBOL].copy().view(">u8").ravel().astype(np.uint64))
    word2 = dense(rows[:, :2].copy().view(">u2").ravel().astype(np.uint64))
    cuts = [0]
    ends = np.flatnonzero(np.append(seg[1:] != seg[:-1], True)) + 1
    for e in ends:
        if e - cuts[-1] >= shard:
            cuts.append(int(e))
    if cuts[-1] != n:
        cuts.append(n)
    order = np.concatenate([a + shard_transform(rows[a:z]) for a, z in zip(cuts, cuts[1:])])
    which = np.repeat(np.arange(len(cuts) - 1, dtype=np.uint16), np.diff(cuts))
    has = offset[order] >= SYMBOL                           # suffix has a predecessor eight bytes earlier
    symbol = np.where(has, word8[order - np.minimum(SYMBOL, offset[order])], 0).astype(word8.dtype)
    size = np.bincount(seg)
    last = np.flatnonzero(offset + SYMBOL >= size[seg])     # suffixes whose next symbol holds the end
    last_which = np.searchsorted(np.array(cuts), last, side="right").astype(np.uint16) - np.uint16(1)

    first = np.argsort(word2[order], kind="stable")
    z = which[first]
    new = np.ones(n, bool)
    new[1:] = word2[order][first][1:] != word2[order][first][:-1]
    block = np.cumsum(new) - 1
    prefix = np.where(new, 0, LENGTH).astype(np.int16)
    for h in range(2 + SYMBOL, LENGTH + 1, SYMBOL):
        place = np.argsort(z, kind="stable")                # merged position of each shard's suffixes in turn
        sym, ok = np.empty(n, symbol.dtype), np.empty(n, bool)
        sym[place], ok[place] = symbol, has
        syms = np.concatenate([word8[last], sym[ok]])
        shards = np.concatenate([last_which, z[ok]])
        blocks = np.concatenate([np.full(len(last), -1), block[ok]])
        step = np.argsort(syms, kind="stable")
        z, s, bl = shards[step], syms[step], blocks[step]
        new = np.ones(n, bool)
        new[1:] = (s[1:] != s[:-1]) | (bl[1:] != bl[:-1])
        block = np.cumsum(new) - 1
        prefix = np.where(new, h - SYMBOL, LENGTH).astype(np.int16)
    place = np.argsort(z, kind="stable")
    merged = np.empty(n, np.int64)
    merged[place] = order
    return seg[merged], offset[merged], block, prefix


def first_owner(segs: list[bytes], owners: np.ndarray) -> np.ndarray:
    """For every window of every run, run by run, the smallest id that has these ``LENGTH`` bytes."""
    sizes = np.array([len(s) for s in segs])
    seg, offset, block, _ = merge_transforms(segs)
    whole = offset + LENGTH <= sizes[seg]
    seg, offset, block = seg[whole], offset[whole], block[whole]
    head = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    low = np.minimum.reduceat(owners[seg], head)
    base = np.concatenate([[0], np.cumsum(sizes - LENGTH + 1)])
    flat = np.empty(base[-1], np.int64)
    flat[base[seg] + offset] = np.repeat(low, np.diff(np.append(head, len(seg))))
    return flat


def shared_sides(padded: np.ndarray, size: np.ndarray, anchor: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Runs that share the ``HALF`` bytes on one side of the anchor, and the anchor, with another run of their group."""
    found = np.zeros(len(size), bool)
    width = HALF + GRAM
    for first, ok in ((anchor - HALF, anchor >= HALF), (anchor, size - anchor >= width)):
        at = np.flatnonzero(ok)
        if not len(at):
            continue
        key = np.zeros((len(at), 8 + width), np.uint8)
        key[:, :8] = group[at].astype(">i8").view(np.uint8).reshape(-1, 8)
        key[:, 8:] = np.take_along_axis(padded[at], first[at][:, None] + np.arange(width), axis=1)
        _, which, count = np.unique(key.view(f"V{8 + width}").ravel(), return_inverse=True, return_counts=True)
        found[at[count[which] > 1]] = True
    return found


def resolve(h: np.ndarray, padded: np.ndarray, size: np.ndarray, ident: np.ndarray, start: np.ndarray,
            anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Removed ranges (row, start, end) of complete groups; rows are sorted by anchor hash, bytes and id."""
    n = len(h)
    new_group = np.append(True, h[1:] != h[:-1])
    new_seg = new_group.copy()
    new_seg[1:] |= (size[1:] != size[:-1]) | (padded[1:] != padded[:-1]).any(axis=1)
    head = np.flatnonzero(new_seg)
    seg_of = np.cumsum(new_seg) - 1
    owner = np.minimum.reduceat(ident, head)
    group = (np.cumsum(new_group) - 1)[head]
    alone = np.bincount(group)[group] == 1
    pick = np.zeros(len(head), bool)
    some = np.flatnonzero(~alone)
    if len(some):
        at = head[some]
        pick[some[shared_sides(padded[at], size[at], anchor[at], group[some])]] = True
    plain = ~pick[seg_of] & (owner[seg_of] < ident)         # an equal run with a smaller id, and no other link
    rows = [np.flatnonzero(plain)]
    begin, end = [start[rows[0]]], [start[rows[0]] + size[rows[0]]]
    picked = np.flatnonzero(pick)
    if len(picked):
        windows = size[head[picked]] - LENGTH + 1
        first, base, lo = [], np.concatenate([[0], np.cumsum(windows)]), 0
        bytes_until = np.cumsum(size[head[picked]])
        while lo < len(picked):                             # blocks of whole groups
            hi = int(np.searchsorted(bytes_until, (bytes_until[lo - 1] if lo else 0) + BLOCK, side="right"))
            hi = max(hi, lo + 1)
            while hi < len(picked) and group[picked[hi]] == group[picked[hi - 1]]:
                hi += 1
            part = picked[lo:hi]
            first.append(first_owner([padded[i, :k].tobytes() for i, k in zip(head[part], size[head[part]])], owner[part]))
            lo = hi
        first = np.concatenate(first)
        number = np.full(len(head), -1)
        number[picked] = np.arange(len(picked))
        held = np.flatnonzero(pick[seg_of])
        count = windows[number[seg_of[held]]]
        ends = np.cumsum(count)
        offset = np.arange(ends[-1]) - np.repeat(ends - count, count)
        gone = first[np.repeat(base[number[seg_of[held]]], count) + offset] < np.repeat(ident[held], count)
        edge = np.append(True, np.diff(np.repeat(held, count)) != 0)
        rise = np.flatnonzero(gone & (edge | ~np.append(False, gone[:-1])))
        fall = np.flatnonzero(gone & (np.append(edge[1:], True) | ~np.append(gone[1:], False)))
        owner_row = np.repeat(held, count)
        rows.append(owner_row[rise])
        begin.append(start[owner_row[rise]] + offset[rise])
        end.append(start[owner_row[fall]] + offset[fall] + LENGTH)
    return tuple(np.concatenate(x) for x in (rows, begin, end))


def repeats(found: DataFrame, group_rows: int = GROUP_ROWS, rows_at_once: int = ROWS) -> DataFrame:
    """(id, th, start, end, seg): removed ranges; rows with ``seg`` belong to groups left to :func:`hot_repeats`."""
    names, width = ["id", "th", "start", "end", "seg"], SPAN + LENGTH - 1

    def run(batches):
        def pack(ident, th, begin, end, segs=None):
            return pa.RecordBatch.from_arrays(
                [pa.array(ident, pa.int64()), pa.array(th, pa.int64()), pa.array(begin, pa.int32()),
                 pa.array(end, pa.int32()), pa.array(segs if segs is not None else [None] * len(ident), pa.binary())], names)

        def unpack(b):
            raw, off = utf8(b.column(1))
            size = np.diff(off)
            padded = np.zeros((b.num_rows, width), np.uint8)
            padded[np.arange(width) < size[:, None]] = raw
            h, ident, th, start, anchor = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4, 5))
            return [h, padded, size, ident, th, start.astype(np.int64), anchor.astype(np.int64)]

        def emit(cols):
            h, padded, size, ident, th, start, anchor = cols
            if len(h):
                row, begin, end = resolve(h, padded, size, ident, start, anchor)
                yield pack(ident[row], th[row], begin, end)

        held, passing = None, None
        for b in batches:
            if not b.num_rows:
                continue
            cols = unpack(b)
            if passing is not None:
                n = int(np.searchsorted(cols[0], passing, side="right"))
                segs = [cols[1][i, :cols[2][i]].tobytes() for i in range(n)]
                yield pack(cols[3][:n], cols[4][:n], cols[5][:n], cols[5][:n] + cols[2][:n], segs)
                cols = [c[n:] for c in cols]
                if not len(cols[0]):
                    continue
                passing = None
            held = cols if held is None else [np.concatenate([a, c]) for a, c in zip(held, cols)]
            last = int(np.searchsorted(held[0], held[0][-1], side="left"))
            if last >= rows_at_once:
                yield from emit([c[:last] for c in held])
                held = [c[last:] for c in held]
                last = 0
            if len(held[0]) - last > group_rows:
                yield from emit([c[:last] for c in held])
                h, padded, size, ident, th, start, _ = [c[last:] for c in held]
                passing = int(h[-1])
                yield pack(ident, th, start, start + size, [padded[i, :k].tobytes() for i, k in enumerate(size)])
                held = None
        if held is not None:
            yield from emit(held)

    ordered = found.repartition("h").sortWithinPartitions("h", "seg", "id")
    return ordered.mapInArrow(run, "id bigint, th bigint, start int, end int, seg binary")


def hot_repeats(left: DataFrame) -> DataFrame:
    """(id, th, start, end) for runs of very large groups: every window by itself."""
    windows = left.select("id", "th", "start", "seg",
                          F.explode(F.sequence(F.lit(0), F.octet_length("seg") - LENGTH)).alias("w")) \
        .select("id", "th", (F.col("start") + F.col("w")).alias("start"),
                F.expr(f"substring(seg, w + 1, {LENGTH})").alias("window"))
    first = windows.groupBy("window").agg(F.min("id").alias("first"), F.max("id").alias("last")) \
        .where(F.col("first") < F.col("last")).drop("last")
    return windows.join(first, "window").where(F.col("first") < F.col("id")).select(
        "id", "th", "start", (F.col("start") + LENGTH).alias("end"))


# --- cutting -----------------------------------------------------------------

def joined(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of sorted ranges that touch or overlap."""
    out: list[list[int]] = []
    for a, b in pairs:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def dedup_substrings(df: DataFrame, text: str = "text", key: str = "doc_id", group_rows: int = GROUP_ROWS,
                     keep_bytes: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]): one row per row of ``df``."""
    spark = df.sparkSession
    docs = df.select(F.coalesce(F.col(key).cast("bigint"), F.lit(NO_ID).cast("bigint")).alias("id"),
                     F.xxhash64(F.col(text)).alias("th"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # whole copies: of equal texts only the smallest id goes on, the others lose everything (if long enough)
    marked = docs.select("id", "th", F.sha2(F.col("t").cast("binary"), 256).alias("digest"))
    first = marked.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")) \
        .where(F.col("first") < F.col("last"))
    copies = cut(marked.join(first, "digest").where(F.col("id") > F.col("first")).select("id", "th").distinct())
    copies = sized_broadcast(copies, 32)
    distinct = docs.join(copies, ["id", "th"], "left_anti")
    hits_at, ranges_at = fresh_path(spark, "anchors"), fresh_path(spark, "ranges")
    shared_anchors(anchors(distinct)).write.parquet(hits_at)
    release(spark)                                          # shuffle files of a finished step
    repeats(shared_runs(distinct, spark.read.parquet(hits_at)), group_rows).write.parquet(ranges_at)
    release(spark)
    found = spark.read.schema("id bigint, th bigint, start int, end int, seg binary").parquet(ranges_at)
    ranges = found.where(F.col("seg").isNull()).drop("seg")
    if not found.where(F.col("seg").isNotNull()).isEmpty():
        ranges = ranges.unionByName(hot_repeats(found.where(F.col("seg").isNotNull())))
    # as many ranges as a text has windows at most
    per_text = ranges.groupBy("id", "th").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("cuts"))
    whole = copies.withColumn("copy", F.lit(True))

    def cut_texts(batches):
        for b in batches:
            raw, off = utf8(b.column(1))
            rows = []
            for i, (cuts, copy) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                body = raw[off[i]:off[i + 1]]
                gone = joined([(c["start"], c["end"]) for c in cuts]) if cuts else []
                if copy:
                    gone = [(0, len(body))] if len(body) >= LENGTH else []
                digest, kept, at = hashlib.sha256(), [], 0
                for a, z in [*gone, (len(body), len(body))]:
                    digest.update(body[at:a].tobytes())
                    if keep_bytes:
                        kept.append(body[at:a].tobytes())
                    at = z
                rows.append((len(body), sum(z - a for a, z in gone), len(gone), digest.hexdigest(), b"".join(kept)))
            cols = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(cols, types)]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays[:4 + keep_bytes]], names[:5 + keep_bytes])

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * keep_bytes
    return (docs.join(whole, ["id", "th"], "left").join(per_text, ["id", "th"], "left")
            .select(F.when(F.col("id") != F.lit(NO_ID).cast("bigint"), F.col("id")).alias("doc_id"), "t", "cuts", "copy")
            .mapInArrow(cut_texts, schema))
