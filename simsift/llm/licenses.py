"""License scan by template markup.

A template is license wording in a small markup: ``<<beginOptional>>`` ...
``<<endOptional>>`` around wording that may be absent (nested as needed),
``<<var;name="x";words="1-12">>`` for replaceable wording of so many words, and
``<<var;name="x";match="2|3">>`` for one of a few literal words. Everything else
is mandatory. All templates are compiled into one automaton over word numbers,
whose deterministic states are made when first met; a place is accepted when its
mandatory words stand there exactly and consecutively, apart from the optional
and replaceable regions. A template must not begin with replaceable wording.

Texts are lower-cased (A-Z) and read as words ``[0-9a-z]`` and bytes from 0x80
on, so any template can be compared with any layout and punctuation. Words are
numbered by a rolling hash of a whole Arrow batch; the automaton starts only at
pairs of words with which some template can begin, and an accepted place is
read again word by word, so a hash never decides.

Result of :func:`scan`: one row per input row with the words of its text and
every accepted place. NULL and empty texts have no words and no places; NULL or
repeated ids, ties and repeated rows stay as they are; texts of any length are
read to their end; other columns of the input are ignored. For each template
the longest place from a start counts, and a place inside another one of the
same template does not.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsift.llm.common import slices, utf8

# Bytes of text handled at once, and of one block of the rolling hash.
SLICE_BYTES = 2 << 20
HASH_BYTES = 1 << 20

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"<<(.*?)>>", re.S)


@dataclass(frozen=True)
class Template:
    """License wording in markup; ``base`` marks plain phrases that are also counted by themselves."""

    label: str
    markup: str
    base: bool = False


# The phrases of the task.
BASE = [
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
]

# Wording of public license notices, in their usual order.
NOTICES = [
    Template("mit", """<<beginOptional>>Copyright <<beginOptional>>(c)<<endOptional>> <<var;name="holder";words="1-12">><<endOptional>>
        <<beginOptional>>All rights reserved.<<endOptional>>
        Permission is hereby granted, free of charge, to any person obtaining a copy of
        <<var;name="work";match="this|the">> software and associated documentation files (the "Software"), to deal in
        the Software without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
        Software is furnished to do so, subject to the following conditions"""),
    Template("mit", "<<var;name=\"verb\";match=\"released|licensed|distributed|available\">> under the "
                    "<<beginOptional>>terms of the<<endOptional>> MIT <<beginOptional>>Expat<<endOptional>> License"),
    Template("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted"""),
    Template("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met"""),
    Template("bsd-3-clause", """Neither the name of <<var;name="holder";words="1-12">> nor the names of
        <<var;name="whose";match="its|their">> contributors may be used to endorse or promote products derived from
        this software without specific prior written permission"""),
    Template("apache-2", """Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License"); you may not
        use <<var;name="object";words="1-4">> except in compliance with the License<<endOptional>>"""),
    Template("gpl", """<<beginOptional>>This <<var;name="work";match="work|program|software|file">> is<<endOptional>>
        <<var;name="verb";match="licensed|released|distributed">> under
        <<beginOptional>>the terms of<<endOptional>> the GNU General Public License
        <<beginOptional>>as published by the Free Software Foundation<<endOptional>>
        <<beginOptional>>either<<endOptional>>
        <<beginOptional>>version <<var;name="version";match="1|2|3">>
        <<beginOptional>>of the License<<endOptional>>
        <<beginOptional>>or (at your option) any later version<<endOptional>><<endOptional>>"""),
    Template("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version
        <<var;name="version";match="2|3">> of the License, or (at your option) any later version"""),
    Template("gpl-3", """GNU General Public License <<beginOptional>>as published by the Free Software Foundation
        <<beginOptional>>either<<endOptional>><<endOptional>> version 3"""),
    Template("gpl-2", """GNU General Public License <<beginOptional>>as published by the Free Software Foundation
        <<beginOptional>>either<<endOptional>><<endOptional>> version 2"""),
    Template("lgpl", """GNU <<var;name="kind";match="lesser|library">> General Public License
        <<beginOptional>>version <<var;name="version";match="2|3">><<endOptional>>"""),
    Template("agpl", "GNU Affero General Public License <<beginOptional>>version 3<<endOptional>>"),
    Template("mpl-2", """subject to the terms of the Mozilla Public License,
        <<var;name="word";match="v|version">> <<beginOptional>>.<<endOptional>> 2.0"""),
    Template("cc-by", "<<beginOptional>>licensed under<<endOptional>> CC BY <<var;name=\"version\";match=\"1|2|3|4\">>"),
    Template("cc-by", """Creative Commons Attribution <<beginOptional>><<var;name="version";match="1|2|3|4">>
        <<var;name="minor";match="0|5">><<endOptional>>
        <<var;name="port";match="international|unported|generic|license">>"""),
    Template("cc-by-sa", "<<beginOptional>>licensed under<<endOptional>> CC BY-SA"),
    Template("cc-by-sa", "Creative Commons Attribution-ShareAlike"),
    Template("cc-by-nc", """<<beginOptional>>licensed under<<endOptional>> CC BY-NC <<beginOptional>>
        <<var;name="version";match="1|2|3|4">> <<var;name="minor";match="0|5">><<endOptional>>"""),
    Template("cc-by-nc", "Creative Commons Attribution-NonCommercial"),
    Template("cc0", "CC0 <<beginOptional>>1.0<<endOptional>> Universal"),
    Template("unlicense", """This is free and unencumbered software released into the public domain"""),
    Template("all-rights-reserved", """Copyright <<beginOptional>>(c)<<endOptional>> <<var;name="holder";words="1-12">>
        All rights reserved"""),
]


def words_of(text: str) -> list[str]:
    """The words of a text in order, after lower-casing A-Z only."""
    return _WORD.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text))


def _parse(markup: str):
    """Nested list of ``("word", {words})``, ``("any", least, most)`` and ``("optional", [...])``."""
    stack, at = [[]], 0

    def literal(piece):
        stack[-1].extend(("word", frozenset([w])) for w in words_of(piece))

    for m in _MARK.finditer(markup):
        literal(markup[at:m.start()])
        at, tag = m.end(), m.group(1).strip()
        if tag == "beginOptional":
            stack.append([])
        elif tag == "endOptional":
            if len(stack) == 1:
                raise ValueError("endOptional without beginOptional")
            inner = stack.pop()
            stack[-1].append(("optional", inner))
        elif tag.startswith("var;"):
            given = dict(re.findall(r'(\w+)="(.*?)"', tag, re.S))
            if "match" in given:
                stack[-1].append(("word", frozenset(w for x in given["match"].split("|") for w in words_of(x))))
            else:
                least, most = (int(x) for x in given["words"].split("-"))
                if not 0 <= least <= most:
                    raise ValueError(f"words of a region: {least}-{most}")
                stack[-1].append(("any", least, most))
        else:
            raise ValueError(f"unknown mark <<{tag}>>")
    literal(markup[at:])
    if len(stack) != 1:
        raise ValueError("beginOptional without endOptional")
    return stack[0]


class Automaton:
    """One automaton for all templates over word numbers (0: any word that no template names).

    ``step(state, word)`` makes deterministic states when first met; state -1 is dead.
    """

    def __init__(self, templates):
        self.labels = [(t.label, t.base) for t in templates]
        self.words, self.edges, self.skips, self.accepts = {}, [], [], {}
        starts = []
        for k, t in enumerate(templates):
            first = self._state()
            last = self._build(_parse(t.markup), first)
            if last in self._closure([first]):
                raise ValueError(f"a template without mandatory words: {t.label}")
            if any(known is None for s in self._closure([first]) for known, _ in self.edges[s]):
                raise ValueError(f"a template begins with replaceable wording: {t.label}")
            self.accepts[last] = k
            starts.append(first)
        self.sets, self.numbers, self.moves = [], {}, {}
        self.start = self._number(self._closure(starts))

    def _state(self):
        self.edges.append([])
        self.skips.append([])
        return len(self.edges) - 1

    def _build(self, parts, at):
        for part in parts:
            if part[0] == "word":
                after = self._state()
                known = {self.words.setdefault(w, len(self.words) + 1) for w in part[1]}
                self.edges[at].append((known, after))
                at = after
            elif part[0] == "any":
                after, exits = at, [at] if part[1] == 0 else []
                for i in range(part[2]):
                    nxt = self._state()
                    self.edges[after].append((None, nxt))
                    after = nxt
                    if i + 1 >= part[1]:
                        exits.append(after)
                at = self._state()
                for e in exits:
                    self.skips[e].append(at)
            else:
                inner, after = self._state(), self._state()
                self.skips[at] += [inner, after]
                self.skips[self._build(part[1], inner)].append(after)
                at = after
        return at

    def _closure(self, states):
        seen, todo = set(states), list(states)
        while todo:
            for s in self.skips[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)

    def _number(self, states):
        if not states:
            return -1
        if states not in self.numbers:
            self.numbers[states] = len(self.sets)
            self.sets.append((states, [self.accepts[s] for s in states if s in self.accepts]))
        return self.numbers[states]

    def step(self, state, word):
        key = (state, word)
        if key not in self.moves:
            after = [b for s in self.sets[state][0] for known, b in self.edges[s] if known is None or word in known]
            self.moves[key] = self._number(self._closure(after))
        return self.moves[key]

    def pairs(self) -> np.ndarray:
        """``[a, b]``: some template can begin with the words a, b (the last number: the end of a text)."""
        n = len(self.words) + 1
        out = np.zeros((n + 1, n + 1), bool)
        for a in range(n):
            s = self.step(self.start, a)
            if s >= 0:
                out[a] = [bool(self.sets[s][1]) or (b < n and self.step(s, b) >= 0) for b in range(n + 1)]
        return out

    def places(self, ids, starts):
        """``(template, start, stop)`` from each start: per template the longest; none inside another of its kind."""
        found = {}
        for i in starts:
            state, j = self.step(self.start, ids[i]), i + 1
            while state >= 0:
                for t in self.sets[state][1]:
                    found[(t, i)] = j
                if j == len(ids) or ids[j] < 0:
                    break
                state, j = self.step(state, ids[j]), j + 1
        far = {}
        for (t, i), j in sorted(found.items()):
            if j > far.get(t, -1):
                far[t] = j
                yield t, i, j


def _scanner(templates):
    """``run(batches)`` over (id, text) batches; the automaton is compiled once per task."""

    def run(batches):
        auto = Automaton(templates)
        vocabulary = [w.encode() for w in auto.words]
        longest = max(map(len, vocabulary))
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        is_word = np.zeros(256, bool)
        is_word[48:58] = is_word[97:123] = is_word[128:] = True
        base = pow(3, 41, 1 << 64)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.r_[np.uint64(1), np.full(HASH_BYTES, base, np.uint64)])
            inverse = np.cumprod(np.r_[np.uint64(1), np.full(HASH_BYTES, pow(base, -1, 1 << 64), np.uint64)])

            def digest(raw, a, b):
                """Rolling hashes of the words ``raw[a:b]``, which lie within one block."""
                lo = a[0]
                part = raw[lo:b[-1]].astype(np.uint64) + np.uint64(1)
                total = np.r_[np.uint64(0), np.cumsum(part * power[:len(part)])]
                return (total[b - lo] - total[a - lo]) * inverse[a - lo]

            hashes = np.array([digest(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in vocabulary])
        order = np.argsort(hashes)
        ranked = hashes[order]
        number = (order + 1).astype(np.int32)
        pair, gap = auto.pairs(), len(vocabulary) + 1

        def numbered(raw, a, b):
            """Template word numbers of the words ``raw[a:b]``."""
            ids = np.zeros(len(a), np.int32)
            short = np.flatnonzero(b - a <= longest)
            i = 0
            while i < len(short):
                j = int(np.searchsorted(a[short], a[short[i]] + HASH_BYTES - longest, side="right"))
                k = short[i:j]
                with np.errstate(over="ignore"):
                    h = digest(raw, a[k], b[k])
                at = np.minimum(np.searchsorted(ranked, h), len(ranked) - 1)
                ids[k] = np.where(ranked[at] == h, number[at], 0)
                i = j
            return ids

        def scanned(raw, offsets):
            """Words of each text, and its places ``(template, start, stop, first byte, end byte)``."""
            raw, n = lower[raw], len(offsets) - 1
            mask = is_word[raw]
            begins = mask.copy()
            begins[1:] &= ~mask[:-1]
            ends = mask.copy()
            ends[:-1] &= ~mask[1:]
            inner = offsets[:-1][(offsets[:-1] < offsets[1:]) & (offsets[:-1] > 0)]
            begins[inner] = mask[inner]
            ends[inner - 1] = mask[inner - 1]
            a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
            first = np.searchsorted(a, offsets)                       # words before each text
            ids = numbered(raw, a, b)
            ahead = np.append(ids[1:], gap).astype(np.int32)
            ahead[first[1:][first[1:] > 0] - 1] = gap                 # the last word of a text has no next one
            starts = np.flatnonzero(pair[ids, ahead]) if len(ids) else ids
            places = [[] for _ in range(n)]
            doc = np.searchsorted(first, starts, side="right") - 1
            for d in np.unique(doc):
                w0, w1 = int(first[d]), int(first[d + 1])
                mine = ids[w0:w1].tolist()
                for t, i, j in auto.places(mine, (starts[doc == d] - w0).tolist()):
                    told = [auto.words.get(raw[x:y].tobytes().decode("utf-8", "replace"), 0)
                            for x, y in zip(a[w0 + i:w0 + j], b[w0 + i:w0 + j])]
                    if told == mine[i:j]:
                        places[d].append((t, i, j, int(a[w0 + i] - offsets[d]), int(b[w0 + j - 1] - offsets[d])))
            return np.diff(first), places

        for rb in batches:
            raw, offsets = utf8(rb.column(1))
            for lo, hi in slices(offsets, SLICE_BYTES):
                counts, places = scanned(raw[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                flat = [p for one in places for p in sorted(one, key=lambda p: (p[1], p[2], p[0]))]
                cols = list(zip(*flat)) if flat else [()] * 5
                told = pa.StructArray.from_arrays(
                    [pa.array([auto.labels[t][0] for t in cols[0]], pa.string()),
                     pa.array([auto.labels[t][1] for t in cols[0]], pa.bool_()),
                     *[pa.array(c, pa.int64()) for c in cols[1:]]],
                    names=["label", "base", "start", "stop", "from_byte", "to_byte"])
                bounds = np.cumsum([0] + [len(p) for p in places]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rb.column(0).slice(lo, hi - lo), pa.array(counts.astype(np.int64)),
                     pa.ListArray.from_arrays(pa.array(bounds), told)], names=["doc_id", "n_words", "places"])

    return run


def scan(docs: DataFrame, templates=None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, places) of every row; a place has label, base, start and stop word, from and to byte."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _scanner(list(BASE + NOTICES if templates is None else templates)),
        f"doc_id {id_type}, n_words bigint, places array<struct<label:string,base:boolean,start:bigint,stop:bigint,"
        "from_byte:bigint,to_byte:bigint>>")


def names(places: Column) -> Column:
    """The labels of places: distinct, sorted, comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")


def coverage(places: Column, n_words: Column) -> Column:
    """Share of the words of a text that lie in a place (0 for a text without words).

    Places are ordered by start, so each adds what lies beyond the furthest stop so far.
    """
    seen = F.struct(F.lit(0).cast("bigint").alias("far"), F.lit(0).cast("bigint").alias("covered"))
    swept = F.aggregate(places, seen, lambda s, p: F.struct(
        F.greatest(s["far"], p["stop"]).alias("far"),
        (s["covered"] + F.greatest(F.lit(0).cast("bigint"), p["stop"] - F.greatest(s["far"], p["start"]))).alias("covered")))
    return F.when(n_words > 0, swept["covered"] / n_words).otherwise(F.lit(0.0))
