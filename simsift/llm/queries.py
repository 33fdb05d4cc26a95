"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from simsift.llm import chat, decontaminate, exact_dedup, jaccard_join, langid, licenses, manifest, mixing, \
    prefix_trie, sharding, substring_dedup, tokens, toxicity
from simsift.llm.common import crc_bucket, drop_path, fresh_path, table
from simsift.llm.ordered import numbered
from simsift.llm.registry import register


@register("op1_langid")
def op1_langid(spark, sf_dir):
    """Language of every document, learned from documents whose id hash is not 2 modulo 4."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = crc_bucket(F.col("doc_id"), 4) == 2
    return langid.detect_languages(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score")


def vocabulary() -> str:
    """The public vocabulary file of the contract, read on the driver and broadcast."""
    import public_tokenizers

    return Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")


@register("op5_token_files")
def op5_token_files(spark, sf_dir):
    """Write the token files of all documents and read them back."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    files = tokens.write_token_files(docs, vocabulary(), fresh_path(spark, "token-files"))
    return tokens.read_token_files(spark, files)


@register("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    """Toxicity of every document, learned from labels whose id hash is not 0 modulo 5."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = crc_bucket(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), ~held_out)
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


@register("op2_exact_dedup", """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM d
""")
def op2_exact_dedup(spark, sf_dir):
    """Stateful streaming deduplication of all documents; the largest id of equal texts stays."""
    return exact_dedup.exact_dedup(spark, f"{sf_dir.rstrip('/')}/documents.parquet", max_bytes=64 << 30)


@register("op3_mixing")
def op3_mixing(spark, sf_dir):
    """Mix of all documents with the source weights 5, 2, 1."""
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source")).drop("source")


@register("op7_decontamination")
def op7_decontamination(spark, sf_dir):
    """Every benchmark item found in every document."""
    return decontaminate.find_hits(table(spark, sf_dir, "documents", "doc_id", "text"),
                                   table(spark, sf_dir, "benchmark", "item_id", "text"), word_borders=True)


@register("op9_sharding")
def op9_sharding(spark, sf_dir):
    """40 shards of all documents along a Hilbert curve."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return sharding.assign_shards(docs, 40).drop("curve")


@register("op6_chat_formatting")
def op6_chat_formatting(spark, sf_dir):
    """Recover the turns of all conversations from raw transcripts; learned where the id hash is not 0 modulo 5."""
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    raw = turns.withColumn("text", chat.raw_transcripts(turns))
    model = chat.learn(raw.where(crc_bucket(F.col("conv_id"), 5) != 0), "conv_id", "turn", "text", "role")
    return chat.parse(raw.drop("role"), model)


@register("op10_suffix_dedup")
def op10_suffix_dedup(spark, sf_dir):
    """Remove repeated strings of 50 bytes from all documents."""
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op4_jaccard_join")
def op4_jaccard_join(spark, sf_dir):
    """Classes and numbers of links of all documents at a similarity of 0.8 on five-word shingles."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op11_licenses")
def op11_licenses(spark, sf_dir):
    """Base phrases and license templates in all documents; ``score`` is the share of words in such places."""
    found = licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("places", lambda p: p["base"])
    at = F.transform(base, lambda p: p["start"])
    return found.select("doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
                        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
                        licenses.names(base).alias("base_labels"), licenses.names(F.col("places")).alias("labels"),
                        licenses.coverage(F.col("places"), F.col("n_words")).alias("score"))


@register("op13_manifest")
def op13_manifest(spark, sf_dir):
    """Merkle manifest of all documents by language; every third id hash presents a lower-cased text."""
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "n_chars", "text")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    shown = F.when(crc_bucket(F.col("doc_id"), 3) == 0, F.translate("text", upper, lower)).otherwise(F.col("text"))
    return manifest.manifest(docs, F.col("lang"), manifest.leaf(*fields, F.col("text")), manifest.leaf(*fields, shown))


@register("op12_prefix_trie")
def op12_prefix_trie(spark, sf_dir):
    """Trie of all conversations, each rebuilt on the first turns of the conversation that opens its twenty.

    Rows without a conv_id belong to no conversation; turns of one number follow by digest.
    """
    given = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    turns, path = numbered(given.select("conv_id", "turn", prefix_trie.turn_digest(F.col("role"), F.col("text")).alias("digest"),
                                        mixing.word_count(F.col("text")).alias("words")),
                           "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest")], label="conversations")
    shared = crc_bucket(F.col("conv_id"), 4)
    convs = turns.select("conv_id").distinct()
    heads = turns.where((F.col("pos") < 3) & (F.col("conv_id") % 20 == 0)).select(
        F.col("conv_id").alias("base"), "pos", "digest", "words")                        # at most 3 turns are shared
    taken = (convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % 20).join(heads, "base")
             .where(F.col("pos") < shared).select("conv_id", F.lit(0).alias("part"), "pos", "digest", "words"))
    own = turns.where(F.col("pos") >= shared).select("conv_id", F.lit(1).alias("part"), "pos", "digest", "words")
    nodes = prefix_trie.prefix_trie(taken.unionByName(own), [F.col("part"), F.col("pos")], convs)
    drop_path(spark, path)
    return nodes.drop("id", "up")
