"""License scan against a plain search, and its markup against an enumeration of all admitted wordings."""

import random

import pytest

from helpers_llm import awkward, awkward_rows, empty, prose
from conftest import SF_SMALL
from simsift.llm import licenses, queries  # noqa: F401  (registers the queries)
from simsift.llm import registry
from simsift.llm.licenses import Automaton, Template, words_of

PHRASES = {"mit": "under the mit license".split(), "apache-2": "apache license version 2".split(),
           "cc-by-nc": "cc by nc".split()}


def base_brute(text):
    w = words_of(text or "")
    hits = sorted((i, label) for label, p in PHRASES.items() for i in range(len(w)) if w[i:i + len(p)] == p)
    return (len(w), len(hits), hits[0][0] if hits else None, hits[-1][0] if hits else None,
            ",".join(sorted({label for _, label in hits})))


def admitted(parts):
    """Every word sequence of parsed markup; a replaceable word is written ``*``."""
    if not parts:
        return {()}
    head, rest = parts[0], admitted(parts[1:])
    if head[0] == "word":
        first = {(w,) for w in head[1]}
    elif head[0] == "any":
        first = {("*",) * n for n in range(head[1], head[2] + 1)}
    else:
        first = {()} | admitted(head[1])
    return {a + b for a in first for b in rest}


def places_brute(words, templates):
    out = []
    for label, markup in templates:
        found = {}
        for seq in admitted(licenses._parse(markup)):
            for i in range(len(words) - len(seq) + 1):
                if seq and all(a in ("*", b) for a, b in zip(seq, words[i:])):
                    found[i] = max(found.get(i, 0), i + len(seq))
        far = -1
        for i, j in sorted(found.items()):
            if j > far:
                far = j
                out.append((label, i, j))
    return sorted(out)


MARKUPS = [
    ("a", "la <<beginOptional>>lo <<beginOptional>>li<<endOptional>><<endOptional>> le"),
    ("b", "<<beginOptional>>le<<endOptional>> li <<var;name=\"x\";words=\"0-2\">> lo"),
    ("c", "lo <<var;name=\"x\";match=\"la|li\">> <<beginOptional>>le<<endOptional>>"),
    ("d", "li le li"),
]


def test_places_equal_all_admitted_wordings(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["la", "le", "li", "lo", "xx"]) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in licenses.scan(df, [Template(a, b) for a, b in MARKUPS]).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert sorted((p.label, p.start, p.stop) for p in got[i].places) == places_brute(t.split(), MARKUPS)
        for p in got[i].places:
            assert t.encode()[p.from_byte:p.to_byte].decode().split() == t.split()[p.start:p.stop]


def test_notices(spark):
    texts = [
        "Copyright (c) 2020 Ann Example\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:",
        "Permission is hereby granted, free of cost, to any person",
        "This work is licensed under the GNU General Public License, version 3.",
        "# Licensed under the\n# Apache License,\n# Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.",
        "Licensed under CC BY-NC 4.0.",
        "under the MIT-License UNDER THE MIT LICENSE",
        "the mit licenses",
        "Under the K MIT License",                    # a letter that is no A-Z
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = {r.doc_id: r for r in licenses.scan(df).collect()}
    labels = [sorted({p.label for p in rows[i].places}) for i in range(len(texts))]
    assert labels == [["mit"], [], ["gpl", "gpl-3"], ["apache-2"], ["cc-by-nc"], ["mit"], [], []]
    assert (rows[0].places[0].start, rows[0].places[0].stop) == (0, len(words_of(texts[0])))
    assert [p.start for p in rows[5].places if p.base] == [0, 4]


def check(rows, got):
    assert sorted(r.n_words for r in got) == sorted(len(words_of(t or "")) for t in rows)
    want = sorted(map(str, (base_brute(t) for t in rows)))
    assert sorted(str((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got) == want
    for r in got:
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_query_equals_plain_search(spark):
    got = registry.QUERIES["op11_licenses"](spark, SF_SMALL).collect()
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()]
    check(texts, got)


def test_awkward_rows_and_long_texts(spark, tmp_path):
    rng = random.Random(2)
    long = prose(rng, 400_000) + " under the MIT license"            # several slices and hash blocks
    rows = [*awkward_rows(), (900, long, "en", "s", 1, 1, "x", 1, 0.0),
            (901, "x" * 3_000_000 + " cc by nc", "en", "s", 1, 1, "x", 1, 0.0)]
    path = str(tmp_path)
    spark.createDataFrame(rows, awkward(spark).schema).repartition(2).write.parquet(f"{path}/documents.parquet")
    got = registry.QUERIES["op11_licenses"](spark, path).collect()
    check([r[1] for r in rows], got)
    assert {r.doc_id: r.labels for r in got}[900] == "mit"
    assert licenses.scan(empty(spark)).collect() == []


def test_wrong_markup_fails():
    for markup in ("<<beginOptional>>a", "a<<endOptional>>", "<<beginOptional>>a<<endOptional>>", "<<odd>> a",
                   "<<var;name=\"x\";words=\"1-2\">> a"):
        with pytest.raises(ValueError):
            Automaton([Template("x", markup)])
