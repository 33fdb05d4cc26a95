"""Mixing sources to target weights by pivotal dependent rounding.

A source with ``size`` words and target ``t`` gives each of its documents
``t / size`` expected copies; the whole part is certain, the fractional part is
a copy probability. Pairs of documents duel: mass (probability times words)
moves from one to the other, in a random direction whose odds keep both
expectations, until one of the two probabilities is 0 or 1. The expected words
of a source are therefore kept by every duel, and only the last document of a
source is rounded by itself, to the nearer count. As mass is probability times
words, a duel mostly decides the shorter document, so the last one is long and
leaves its source up to half its words off. ``settle`` spreads that residue over
whole copies of other documents of the source, the longest that fit first, down
to its short ones: the words taken then miss the target by at most half of the
shortest document that can still move towards it, and by less where shorter ones
can move the other way.

Duels run inside buckets of about 64 documents of one source (an ordered fold
over a bounded array); the one undecided document of each bucket goes on to the
next level, 64 buckets to one, up to a single bucket: a reduction tree whose
depth is the logarithm of the largest source. A hot source has many buckets.

Everything is DataFrame and SQL functions. Randomness is a hash of seed, level
and ids, so reruns agree.

Defined results: NULL text has 0 words; documents without words are taken with
0 words; NULL source is a source of its own and comes last; rows that repeat id,
source and size are one unit whose copies are spread evenly; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from simsift.llm.common import cut, sized_broadcast

WEIGHTS = (5, 2, 1)
CAP = 3                          # no document is repeated more often
FAN = 64
WORD = r"[^\x20\x09-\x0D]+"
UNIT = "o bigint, h bigint, doc_id bigint, size bigint, m bigint, k bigint, x double"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, n) -> with target: shares by weight, capped, the excess reshared by weight.

    The fixed point of resharing is ``min(cap * size, level * weight)`` with one
    level for all sources. With sources in ascending order of ``cap * size /
    weight`` the capped ones come first, and the level of the others follows
    from what is left. The table has one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = sizes.withColumn("w", w).withColumn("top", F.col("source_size") * F.lit(float(cap)))
    by_ratio = Window.orderBy(F.col("top") / F.col("w"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    t = (t.withColumn("total", F.sum("source_size").over(everything).cast("double"))
         .withColumn("before", F.coalesce(F.sum("top").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("rest", F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("pos", F.row_number().over(by_ratio))
         .withColumn("level", (F.col("total") - F.col("before")) / F.col("rest")))
    fits = F.when(F.col("level") <= F.col("top") / F.col("w"), F.struct("pos", "level"))
    t = t.withColumn("level", F.min(fits).over(everything)["level"])
    return t.select("source", "source_size", "n",
                    F.coalesce(F.least(F.col("top"), F.col("level") * F.col("w")), F.col("top")).alias("target"))


def uniform(*parts: str) -> str:
    """SQL for a repeatable number in [0, 1) from the given expressions."""
    return f"(pmod(xxhash64({', '.join(parts)}), 9007199254740992L) / 9007199254740992D)"


def duel(level: int, seed: int) -> str:
    """SQL of one fold step: the undecided document ``acc.cur`` against the next one ``e``."""
    i, j = "acc.cur", "e"
    ratio = f"({i}.size / {j}.size)"
    up, down = f"least(1 - {i}.x, {j}.x / {ratio})", f"least({i}.x, (1 - {j}.x) / {ratio})"
    rises = f"({uniform(f'{seed}', f'{level}', f'{i}.h', f'{j}.h')} * ({up} + {down}) < {down})"

    def step(gone, extra, stays, x):
        return (f"named_struct('cur', named_struct('o', {stays}.o, 'h', {stays}.h, 'doc_id', {stays}.doc_id, 'size', {stays}.size, "
                f"'m', {stays}.m, 'k', {stays}.k, 'x', least(greatest({x}, 0D), 1D)), 'done', concat(acc.done, "
                f"array(named_struct('doc_id', {gone}.doc_id, 'size', {gone}.size, 'm', {gone}.m, 'k', {gone}.k + {extra}L))))")

    return (f"CASE WHEN acc.cur IS NULL THEN named_struct('cur', e, 'done', acc.done) "
            f"WHEN {rises} AND 1 - {i}.x <= {j}.x / {ratio} THEN {step(i, 1, j, f'{j}.x - (1 - {i}.x) * {ratio}')} "
            f"WHEN {rises} THEN {step(j, 0, i, f'{i}.x + {j}.x / {ratio}')} "
            f"WHEN {i}.x <= (1 - {j}.x) / {ratio} THEN {step(i, 0, j, f'{j}.x + {i}.x * {ratio}')} "
            f"ELSE {step(j, 1, i, f'{i}.x - (1 - {j}.x) / {ratio}')} END")


def play(units: DataFrame, level: int, seed: int) -> DataFrame:
    """One level: (source, bucket, unit) -> (source, bucket, done, cur)."""
    start = (f"named_struct('cur', cast(null as struct<{UNIT.replace(' ', ':').replace(',:', ',')}>), "
             "'done', cast(array() as array<struct<doc_id:bigint,size:bigint,m:bigint,k:bigint>>))")
    folded = units.groupBy("source", "bucket").agg(F.sort_array(F.collect_list("unit")).alias("us")).select(
        "source", "bucket", F.expr(f"aggregate(us, {start}, (acc, e) -> {duel(level, seed)})").alias("r"))
    return cut(folded.select("source", "bucket", "r.done", "r.cur"))


def settle(decided: DataFrame, per_source: DataFrame, seed: int) -> DataFrame:
    """``decided`` with single copies added or dropped so that each source comes nearer its target.

    Only a document rounded down can gain a copy and only one rounded up can lose one.
    Per source the sizes of the documents that can move the right way are counted; a
    fold over the distinct sizes, longest first, says how many of each size move, and
    the documents with the smallest hash of a size are the ones. Where shorter
    documents can move the other way, one more moves and the next call, the other way
    round, takes back what was too much. What reaches one task is a source's distinct
    sizes and the documents that move.
    """
    shares = per_source.select(F.col("source").alias("s"), "target",
                               F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).alias("share"))
    moves = decided.join(sized_broadcast(shares, 64), F.col("source").eqNullSafe(F.col("s"))).drop("s") \
        .withColumn("gap", F.when(F.col("size") > 0, F.col("m") * F.col("share") - F.col("k")))
    off = cut(moves.groupBy(F.col("source").alias("s")).agg(
        (F.max("target") - F.sum(F.col("size") * F.col("k"))).alias("miss"),
        F.min(F.when(F.col("gap") > 1e-9, F.col("size"))).alias("up"),
        F.min(F.when(F.col("gap") < -1e-9, F.col("size"))).alias("down"))
        .select("s", F.abs("miss").alias("need"), F.when(F.col("miss") > 0, 1).otherwise(-1).cast("bigint").alias("sign"),
                F.when(F.col("miss") > 0, F.col("down")).otherwise(F.col("up")).alias("back")))
    free = moves.join(sized_broadcast(off, 64), F.col("source").eqNullSafe(F.col("s"))) \
        .where((F.col("sign") * F.col("gap") > 1e-9)
               & ((F.col("size") < 2 * F.col("need")) | (F.col("back") < 2 * F.col("need"))))
    by_size = free.groupBy("source", "need", "back", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = by_size.groupBy("source", "need", "back").agg(F.sort_array(F.collect_list(F.struct("size", "n")), asc=False).alias("hist"))
    q = "least(e.n, cast(floor(acc.rest / e.size) AS bigint))"
    fold = ("aggregate(hist, named_struct('rest', need, 'took', cast(array() AS array<struct<size:bigint,q:bigint>>), "
            "'spare', cast(null AS bigint)), (acc, e) -> named_struct("
            f"'rest', acc.rest - {q} * e.size, "
            f"'took', IF({q} > 0, concat(acc.took, array(named_struct('size', e.size, 'q', {q}))), acc.took), "
            f"'spare', IF({q} < e.n, e.size, acc.spare)))")              # the least size with a document left
    picks = sizes.select("source", "back", F.expr(fold).alias("f"))
    last = ("IF(f.spare < 2 * f.rest OR (f.spare IS NOT NULL AND back < 2 * f.rest), array(named_struct('size', f.spare, 'q', 1L)), "
            "cast(array() AS array<struct<size:bigint,q:bigint>>))")
    quota = cut(picks.select("source", F.expr(f"explode(concat(f.took, {last}))").alias("c"))
                .groupBy("source", "c.size").agg(F.sum("c.q").alias("q"))
                .select(F.col("source").alias("qs"), F.col("size").alias("qn"), "q"))
    most = quota.agg(F.max("q")).collect()[0][0] or 0
    hashed = Window.partitionBy("source", "size").orderBy(F.xxhash64(F.lit(seed + 2), "doc_id"), "doc_id")
    chosen = free.join(sized_broadcast(quota, 48), F.col("source").eqNullSafe(F.col("qs")) & (F.col("size") == F.col("qn"))) \
        .withColumn("rn", F.row_number().over(hashed)).where(F.col("rn") <= most).where(F.col("rn") <= F.col("q"))
    chosen = cut(chosen.select(F.col("source").alias("cs"), F.col("doc_id").alias("cd"), F.col("size").alias("cn"), "sign"))
    return decided.join(sized_broadcast(chosen, 64), F.col("source").eqNullSafe(F.col("cs"))
                        & F.col("doc_id").eqNullSafe(F.col("cd")) & (F.col("size") == F.col("cn")), "left") \
        .select("source", "doc_id", "size", "m", (F.col("k") + F.coalesce("sign", F.lit(0))).alias("k"))


def decide(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 20, text: str = "text",
           key: str = "doc_id", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """Units (source, doc_id, size, m, k), ``m`` equal rows taken ``k`` times in all, and the table of sources."""
    rows = df.select(F.col(key).cast("bigint").alias("doc_id"), F.col(source).alias("source"),
                     word_count(F.col(text)).alias("size"))
    units = cut(rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("m")))
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"),
                                        F.count(F.lit(1)).alias("n"))
    per_source = cut(targets(sizes, weights, cap))
    largest = per_source.agg(F.max("n")).collect()[0][0] or 0

    whole = F.when(F.col("source_size") > 0, F.col("m") * F.col("target") / F.col("source_size")).otherwise(0.0)
    near = F.abs(F.col("all") - F.round("all")) < 1e-9
    placed = (units.join(per_source, units["source"].eqNullSafe(per_source["source"]), "inner").drop(per_source["source"])
              .withColumn("all", whole)
              .withColumn("k", F.when(near, F.round("all")).otherwise(F.floor("all")).cast("bigint"))
              .withColumn("x", F.when(near | (F.col("size") == 0), 0.0).otherwise(F.col("all") - F.col("k"))))
    placed = cut(placed.select("source", "doc_id", "size", "m", "k", "x", "n"))
    unit = F.struct((-F.col("size")).alias("o"), F.xxhash64(F.lit(seed), "doc_id", "size").alias("h"), "doc_id", "size", "m", "k", "x").cast(
        f"struct<{UNIT.replace(' ', ':').replace(',:', ',')}>")
    buckets = F.ceil(F.col("n") / F.lit(float(FAN)))
    undecided = placed.where(F.col("x") > 0).select(
        "source", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "size"), buckets).alias("bucket"), unit.alias("unit"))

    parts = [placed.where(F.col("x") == 0).select("source", "doc_id", "size", "m", "k")]
    count, level = max(1, math.ceil(largest / FAN)), 0
    while True:
        played = play(undecided, level, seed)
        parts.append(played.select("source", F.explode("done").alias("d")).select("source", "d.*"))
        left = played.where(F.col("cur").isNotNull())
        if count == 1:
            nearer = (F.col("cur.x") >= 0.5).cast("bigint")
            parts.append(left.select("source", "cur.doc_id", "cur.size", "cur.m", (F.col("cur.k") + nearer).alias("k")))
            break
        undecided = left.select("source", F.expr(f"bucket div {FAN}").alias("bucket"), F.col("cur").alias("unit"))
        count, level = math.ceil(count / FAN), level + 1

    decided = parts[0]
    for p in parts[1:]:
        decided = decided.unionByName(p)
    for _ in range(2):                                     # there and back
        decided = settle(decided, per_source, seed)
    return decided, per_source


def mix(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 20, text: str = "text",
        key: str = "doc_id", source: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): one row per row of ``df``."""
    decided, per_source = decide(df, weights, cap, seed, text, key, source)
    spread = decided.select("source", "doc_id", "size", "m", "k",
                            F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("m"))).alias("r"))
    copies = F.expr("k div m") + (F.col("r") <= F.col("k") % F.col("m")).cast("bigint")
    named = per_source.select(F.col("source").alias("s"), "source_size", "target")
    return spread.join(named, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * copies).alias("taken"))


def take(df: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: int = 20, text: str = "text",
         key: str = "doc_id", source: str = "source") -> DataFrame:
    """The mixed rows themselves: every row of ``df`` as often as the mix takes it, with its columns."""
    decided, _ = decide(df, weights, cap, seed, text, key, source)
    units = decided.select(F.col("source").alias("__s"), F.col("doc_id").alias("__d"), F.col("size").alias("__n"),
                           F.col("m").alias("__m"), F.col("k").alias("__k"))
    rows = df.select(F.struct(*df.columns).alias("__row"), F.col(source).alias("__source"),
                     F.col(key).cast("bigint").alias("__key"), word_count(F.col(text)).alias("__size"),
                     F.xxhash64(F.col(text)).alias("__hash"))
    met = rows.join(sized_broadcast(units, 64), F.col("__source").eqNullSafe(F.col("__s"))
                    & F.col("__key").eqNullSafe(F.col("__d")) & (F.col("__size") == F.col("__n")))
    once = met.where(F.col("__m") == 1).withColumn("__c", F.col("__k"))
    nth = F.row_number().over(Window.partitionBy("__s", "__d", "__n").orderBy("__hash"))
    again = met.where(F.col("__m") > 1).withColumn(
        "__c", F.expr("__k div __m") + (nth <= F.col("__k") % F.col("__m")).cast("bigint"))
    copies = once.unionByName(again).where(F.col("__c") > 0)
    return copies.withColumn("__r", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__c")))).select("__row.*")
