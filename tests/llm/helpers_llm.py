"""Small frames with awkward rows for the corpus operators."""

import random

SYLLABLES = "ba de ki lo mu ra se ti vo zu".split()


def prose(rng, words):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def awkward_rows(seed=3):
    """(doc_id, text, lang, source, n_chars, id, t, size, score): NULLs, empty, long, repeated and copied rows."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(24)]
    near = base[20].split()
    texts = [*base, base[3], base[3].upper(), "", "   \n\t ", None, prose(rng, 6000), "one two", "É ß 日本語 \U0001F600 x",
             base[20] + " " + base[21], " ".join(near[:len(near) // 2] + ["zz"] + near[len(near) // 2:]), "a" * 400, "a" * 500]
    rows = []
    for i, t in enumerate(texts):
        rows.append((i * 3, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s2", "s3", None]), len(t or ""), i, "x", 7, 0.5))
    rows.append(rows[5])                                            # a row twice
    rows.append((rows[7][0], "same id other text entirely", *rows[7][2:]))
    rows.append((None, base[9], "en", "s1", 1, 1, "x", 7, 0.5))
    return rows


SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, id int, t string, size int, "
          "score double")


def awkward(spark, seed=3):
    return spark.createDataFrame(awkward_rows(seed), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
