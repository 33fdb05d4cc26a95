"""Token ids in a byte-aligned variable-length format.

Ids are replaced by their frequency rank over the whole corpus, so that the
most frequent 256 take one byte. A block holds the ranks of consecutive
documents in the layout of byte-aligned variable-length codes with separate
control bytes: one control byte describes four values (two bits each: bytes
minus one), the data bytes follow in a stream of their own, little endian. The
decoder reads the four lengths of a control byte from a table of 256 rows and
gathers the data bytes with numpy.

Files are parquet parts with one row per block (``part, block, before,
first_doc, n_docs, n_tokens, doc_ids, known, lengths, control, data``) and one small table with the
frequency ranks; Spark's commit protocol keeps them whole when executors are
lost, and they can live in any store that Spark writes to.

Defined results: NULL and empty texts hold the end id alone; documents are
ordered by id, repeated ids by a hash of their text (equal rows are alike); NULL
ids come first; an empty table gives empty files; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from simsift.llm.common import drop_path, fresh_path, slices, trimmed, utf8, worker_memo

END_ID = 1
BLOCK_TOKENS = 1 << 16          # a block closes once it holds this many ids
BATCH_BYTES = 1 << 20
CACHE_WORDS = 200_000           # words of one generation that a worker remembers; there are two
CACHE_LETTERS = 100             # of the longest word that is remembered
SEEN_BYTES = 1 << 22            # marks of the words met in a generation, a byte each
ENCODER = "token encoder"       # what a worker keeps between the tasks that encode
LETTERS, DIGITS = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"       # of Latin-1, lower case
#: How the vocabulary splits a text.
UNITS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\\s{LETTERS}{DIGITS}]+")


ENCODED = "doc_id bigint, ids binary, n bigint, h bigint"
BLOCKS = ("block bigint, before bigint, first_doc bigint, n_docs bigint, n_tokens bigint, doc_ids binary, known binary, "
          "lengths binary, control binary, data binary")
DECODED = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def byte_symbols() -> list[str]:
    """The printable character by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + other.index(b)) for b in range(256)]


def latin_1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Remembered(dict):
    """Word -> ids; a word that is not held is asked of the encoder."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, part: str) -> bytes:
        return self.encode(part)


class WordEncoder:
    """Ids (as bytes) of blank-separated parts of a text, remembered once they come up again.

    Most distinct words of a corpus come up once only. A word is therefore
    remembered when its mark is already there, so that the bounded memory holds
    words that repeat; a mark that two words share only makes one of them
    remembered early.

    The vocabulary drops white space and no token crosses it, so the ids of a
    text are the ids of its parts between ASCII spaces and line feeds in a row.
    A printable lower-case Latin-1 part is split here as the vocabulary splits
    it, and its units go to the library's model directly; any other part goes
    through the library's whole chain. Lower-casing beforehand is the chain's
    own folding for Latin-1 texts, and is left to it otherwise.
    """

    def __init__(self, spec: str, dtype: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        self.symbols = byte_symbols()
        self.code = "H" if dtype == "<u2" else "I"      # native order: little endian on the supported machines
        self.older: dict[str, bytes] = {}
        self.forget()

    def forget(self) -> None:
        """A new generation of words without any."""
        self.words, self.seen, self.room = Remembered(self.ids), bytearray(SEEN_BYTES), CACHE_WORDS

    def pack(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def unit(self, part: str) -> bytes:
        if not part.isascii():
            part = "".join([self.symbols[b] for b in part.encode()])
        return self.pack([t.id for t in self.model.tokenize(part)])

    def ids(self, part: str) -> bytes:
        found = self.older.get(part)
        mark = hash(part) % SEEN_BYTES
        again = found is not None or self.seen[mark]
        if found is not None:
            pass
        elif part.isprintable() and latin_1(part) and part == part.lower() and "<|" not in part:
            units = UNITS.findall(part)
            found = self.unit(part) if units == [part] else b"".join([self.words[u] for u in units])
        else:
            found = self.pack(self.tokenizer.encode(part, add_special_tokens=False).ids)
        if not again:
            self.seen[mark] = 1
        elif self.room and len(part) <= CACHE_LETTERS:
            self.room -= 1
            self.words[part] = found
        return found

    def encode(self, text: str) -> bytes:
        if latin_1(text):
            text = text.lower()
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))

    def tidy(self) -> None:
        """Once the memory is full, start a new one; words that come up again are taken over from the old."""
        if not self.room:
            self.older = self.words
            self.forget()


def process_encoder(spec: str, dtype: str) -> WordEncoder:
    """The encoder of this Python worker, which Spark reuses for later tasks."""
    memo = worker_memo()
    key = (zlib.crc32(spec.encode()), dtype)
    if getattr(memo, "key", None) != key:
        memo.key, memo.encoder = key, WordEncoder(spec, dtype)
    return memo.encoder


def id_type(spec: str) -> str:
    """Two bytes per stored id where the vocabulary allows it, else four."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_str(spec).get_vocab_size() <= 1 << 16 else "<u4"


def encode_documents(df: DataFrame, spec: str, text: str = "text", key: str = "doc_id", end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids, n, h): little-endian ids of every whole text with the end id, and a text hash."""
    src = df.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"),
                    F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
    shared = src.sparkSession.sparkContext.broadcast(spec)        # the vocabulary file: a fixed 2 MB
    dtype = id_type(spec)
    tail, width = np.array([end_id], dtype).tobytes(), int(dtype[-1])

    def run(batches):
        encoder = process_encoder(shared.value, dtype)
        for b in batches:
            _, off = utf8(b.column(1))
            for lo, hi in slices(off, BATCH_BYTES):
                part = b.slice(lo, hi - lo)
                ids = [encoder.encode(t) + tail for t in part.column(1).to_pylist()]
                encoder.tidy()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.binary()),
                     pa.array([len(x) // width for x in ids], pa.int64()), part.column(2)],
                    ["doc_id", "ids", "n", "h"])

    return src.mapInArrow(trimmed(run, ENCODER), ENCODED)


def id_counts(encoded: DataFrame, dtype: str) -> DataFrame:
    """(id, n) over the whole corpus; each task sends one count per id of the vocabulary."""
    def run(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            raw, _ = utf8(b.column(0))
            c = np.bincount(raw.view(dtype), minlength=len(total)) if len(raw) else np.zeros(0, np.int64)
            c[:len(total)] += total
            total = c
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["id", "n"])

    return encoded.select("ids").mapInArrow(trimmed(run), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def length_table() -> np.ndarray:
    """Control byte -> the byte lengths of its four values."""
    c = np.arange(256)
    return np.stack([(c >> (2 * i) & 3) + 1 for i in range(4)], axis=1).astype(np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    quad = np.ones(-(-len(v) // 4) * 4, np.uint8)
    quad[:len(v)] = size
    q = (quad - 1).reshape(-1, 4)
    control = (q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6).astype(np.uint8)
    used = np.arange(4) < size[:, None]
    return control.tobytes(), v.view(np.uint8).reshape(-1, 4)[used].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values written by :func:`pack`."""
    size = length_table()[np.frombuffer(control, np.uint8)].ravel()[:n]
    out = np.zeros((n, 4), np.uint8)
    out[np.arange(4) < size[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").ravel()


@dataclass(frozen=True)
class TokenFiles:
    """Paths of one written corpus."""

    blocks: str
    ranks: str


def load_ranks(spark: SparkSession, path: str) -> np.ndarray:
    """Ids in rank order (one entry per id of the vocabulary that occurs)."""
    rows = spark.read.parquet(path).toPandas()
    out = np.zeros(len(rows), np.uint32)
    out[rows["rank"].to_numpy()] = rows["id"].to_numpy()
    return out


def write_token_files(df: DataFrame, spec: str, path: str, text: str = "text", key: str = "doc_id",
                      end_id: int = END_ID, partitions: int | None = None) -> TokenFiles:
    """Encode every text and write the files; ids go out in ascending document order."""
    spark = df.sparkSession
    raw_path, dtype = fresh_path(spark, "token-ids"), id_type(spec)
    width = int(dtype[-1])
    encode_documents(df, spec, text, key, end_id).write.mode("overwrite").parquet(raw_path)
    encoded = spark.read.parquet(raw_path)
    # the vocabulary bounds this table: 49,408 rows at most
    counts = id_counts(encoded, dtype).toPandas().sort_values(["n", "id"], ascending=[False, True], kind="stable")
    files = TokenFiles(f"{path}/blocks", f"{path}/ranks")
    spark.createDataFrame([(i, int(x), int(n)) for i, (x, n) in enumerate(zip(counts["id"], counts["n"]))],
                          "rank bigint, id bigint, n bigint").coalesce(1).write.mode("overwrite").parquet(files.ranks)
    rank = np.zeros(int(counts["id"].max()) + 1 if len(counts) else 1, np.uint32)
    rank[counts["id"].to_numpy()] = np.arange(len(counts), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank)

    def blocks(batches):
        ranks, state = shared.value, {"block": 0, "before": 0, "docs": [], "sizes": [], "ids": [], "n": 0}

        def flush():
            ids = np.frombuffer(b"".join(state["ids"]), dtype)
            control, data = pack(ranks[ids])
            docs = state["docs"]
            row = [state["block"], state["before"], docs[0], len(docs), len(ids),
                   np.array([d or 0 for d in docs], "<i8").tobytes(), np.array([d is not None for d in docs], np.uint8).tobytes(),
                   b"".join(pack(np.array(state["sizes"], np.uint32))), control, data]
            state.update(block=state["block"] + 1, before=state["before"] + len(ids), docs=[], sizes=[], ids=[], n=0)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, [pa.int64()] * 5 + [pa.binary()] * 5)],
                ["block", "before", "first_doc", "n_docs", "n_tokens", "doc_ids", "known", "lengths", "control", "data"])

        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1)):
                raw = x.as_py()
                state["docs"].append(d)
                state["sizes"].append(len(raw) // width)
                state["ids"].append(raw)
                state["n"] += len(raw) // width
                if state["n"] >= BLOCK_TOKENS:
                    yield flush()
        if state["docs"]:
            yield flush()

    count = [partitions] if partitions else []
    ordered = encoded.repartitionByRange(*count, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "ids")
    placed = ordered.mapInArrow(trimmed(blocks), BLOCKS).select(F.spark_partition_id().cast("bigint").alias("part"), "*")
    placed.write.mode("overwrite").parquet(files.blocks)
    drop_path(spark, raw_path)
    return files


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """Decode the files: (doc_id, start, n_tokens, ids_crc32), one row per document."""
    ids = spark.sparkContext.broadcast(load_ranks(spark, files.ranks))
    stored = spark.read.parquet(files.blocks)
    # one number per written part reaches the driver, from the small columns of the files
    sizes = {r["part"]: r["n"] for r in stored.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}
    total, base = 0, {}
    for part in sorted(sizes):
        base[part] = total
        total += sizes[part]

    def run(batches):
        table = ids.value
        for b in batches:
            for at in range(b.num_rows):
                r = b.slice(at, 1).to_pylist()[0]
                n_docs, n = r["n_docs"], r["n_tokens"]
                quads = -(-n_docs // 4)
                sizes_of = unpack(r["lengths"][:quads], r["lengths"][quads:], n_docs).astype(np.int64)
                values = np.ascontiguousarray(table[unpack(r["control"], r["data"], n)], "<u4").tobytes()
                ends = np.cumsum(sizes_of)
                starts = ends - sizes_of
                crc = [zlib.crc32(values[4 * s:4 * e]) for s, e in zip(starts.tolist(), ends.tolist())]
                docs = np.frombuffer(r["doc_ids"], "<i8")
                known = np.frombuffer(r["known"], np.uint8).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64(), mask=~known),
                     pa.array(starts + base[r["part"]] + r["before"], pa.int64()),
                     pa.array(sizes_of, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"])

    return stored.select("part", "before", "n_docs", "n_tokens", "doc_ids", "known", "lengths", "control", "data") \
        .mapInArrow(trimmed(run), DECODED)
