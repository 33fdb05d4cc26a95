"""Chat transcripts to canonical turns with a hidden Markov model.

Input rows are pieces of raw transcripts in order (a piece may hold any number
of lines; piece borders carry no meaning). Hidden states are a role and whether
a line begins or goes on in a turn. A line is observed through its speaker
marker, whether a blank line came before it, its length class and a closing
question mark. Start, transition and emission probabilities are counted on
labelled conversations; Viterbi finds the most likely states, and every run of
lines of one turn is rendered under a canonical header. The marker of the line that
begins a turn is removed; other lines that look like markers, and blank lines inside
a turn, stay as they are.

All pieces are sorted by conversation, number and text over ranges of that order, and
each sorted partition is cut into chunks of at most 64 pieces and about a megabyte, so
that no conversation has to fit in one task, whatever its numbers. A chunk of a longer
conversation first gives its max-plus matrix (best log probability from each state
before it to each state at its end), 36 numbers. The matrices are multiplied up a
tree, 64 at a time; going down again gives the states at the chunk borders, and the
chunks are then decoded between known borders. The result is the exact Viterbi path
of the whole conversation.

Defined results: NULL or empty pieces add a blank line; blank lines around a turn
are dropped (and, inside a turn, those that fill a whole sorted partition); conversations without any
text give no turn; pieces with the same number are ordered by their text; a NULL
conversation id is a conversation of its own; roles outside the learned set are
not learned; without labelled rows every line continues one ``user`` turn; further
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from simsift.llm.common import cut, fresh_path, sized_broadcast

ROLES = ("system", "user", "assistant")
CHUNK = 64                      # pieces decoded at a time
CHUNK_BYTES = 1 << 20           # a chunk takes no further piece beyond
FAN_IN = 64                     # matrices multiplied at a time
MARKS = {
    "system": ("system", "context", "instructions"),
    "user": ("user", "human", "q", "question", "prompt", "instruction"),
    "assistant": ("assistant", "ai", "bot", "a", "answer", "response"),
}
MARKER = re.compile(
    r"^\s*(?:#{1,4}\s*|\*\*|\[|<\|?)?(" + "|".join(w for ws in MARKS.values() for w in ws)
    + r")(?:\*\*)?\s*(?:\|?>|\]|:)\s*:?\s*", re.IGNORECASE)
ROLE_OF = {w: r for r, ws in MARKS.items() for w in ws}
SYMBOLS = 4 * 2 * 6 * 2         # marker, after blank, length class, question mark
STATES = 2 * len(ROLES)         # role * 2 + (0 begins a turn, 1 goes on)
START = STATES                  # row of the transition matrix before the first line


def observe(line: str, after_blank: bool) -> tuple[int, str]:
    """(observation symbol, line without its marker)."""
    m = MARKER.match(line)
    rest = line[m.end():] if m else line
    mark = 1 + ROLES.index(ROLE_OF[m.group(1).lower()]) if m else 0
    size = min(5, max(0, len(rest) // 24).bit_length())
    return ((mark * 2 + after_blank) * 6 + size) * 2 + rest.rstrip().endswith("?"), rest


def lines_of(pieces: list[str | None], after_blank: bool, blanks: int = 0) -> list[tuple[int, int, int, str, str, int]]:
    """(piece, line, symbol, text without a marker, whole line, blank lines before it) of the lines with content.

    ``blanks`` blank lines stand before the pieces; ``after_blank`` also holds at the start of a conversation.
    """
    out = []
    for p, piece in enumerate(pieces):
        for n, line in enumerate((piece or "").split("\n")):
            if not line.strip():
                blanks += 1
                continue
            symbol, rest = observe(line, after_blank if not out and not blanks else blanks > 0)
            out.append((p, n, symbol, rest, line, blanks))
            blanks = 0
    return out


def blank_tail(pieces: list[str | None]) -> int:
    """Blank lines at the end of the pieces (of all their lines when none has content)."""
    n = 0
    for piece in reversed(pieces):
        for line in reversed((piece or "").split("\n")):
            if line.strip():
                return n
            n += 1
    return n


def estimate(transitions: dict[tuple[int, int], int], emissions: dict[tuple[int, int], int]) -> dict:
    """Log probabilities from counts, smoothed; a turn goes on only in its own role.

    Given the state, the marker (with the blank before it), the length class and
    the question mark are taken as independent, so unseen combinations stay likely.
    """
    t = np.full((STATES + 1, STATES), 0.0)
    for (a, b), n in transitions.items():
        t[a, b] += n
    allowed = np.ones((STATES + 1, STATES), bool)
    for a in range(STATES + 1):
        for b in range(1, STATES, 2):
            allowed[a, b] = a < STATES and a // 2 == b // 2
    t = np.where(allowed, t + 1.0, 0.0)
    e = np.zeros((STATES, SYMBOLS))
    for (s, o), n in emissions.items():
        e[s, o] += n
    parts = e.reshape(STATES, 8, 6, 2)                      # marker and blank, length class, question mark
    mark, size, asks = (parts.sum(axis=x) + a for x, a in (((2, 3), 0.01), ((1, 3), 1.0), ((1, 2), 1.0)))
    mark, size, asks = (p / p.sum(axis=1, keepdims=True) for p in (mark, size, asks))
    joint = mark[:, :, None, None] * size[:, None, :, None] * asks[:, None, None, :]
    with np.errstate(divide="ignore"):
        return {"t": np.log(t / t.sum(axis=1, keepdims=True)), "e": np.log(joint.reshape(STATES, SYMBOLS))}


def matrix(model: dict, symbols: list[int], first: bool) -> np.ndarray:
    """Max-plus product over the lines: best score from each state before to each state at the end."""
    m = None
    for o in symbols:
        step = model["t"][:STATES] + model["e"][:, o]
        if m is None:
            m = np.repeat(model["t"][START:] + model["e"][:, o], STATES, axis=0) if first else step
        else:
            m = (m[:, :, None] + step[None]).max(axis=1)
    return np.where(np.eye(STATES, dtype=bool), 0.0, -np.inf) if m is None else m


def viterbi(model: dict, symbols: list[int], before: int | None, end: int | None) -> list[int]:
    """The best states between an optional state before the lines and an optional last state."""
    if not symbols:
        return []
    score = model["t"][START if before is None else before] + model["e"][:, symbols[0]]
    back = []
    for o in symbols[1:]:
        s = score[:, None] + model["t"][:STATES]
        arg = s.argmax(axis=0)
        back.append(arg)
        score = s[arg, np.arange(STATES)] + model["e"][:, o]
    state = int(score.argmax()) if end is None else end
    path = [state]
    for arg in reversed(back):
        state = int(arg[state])
        path.append(state)
    return path[::-1]


def product(matrices: list[np.ndarray]) -> np.ndarray:
    """Max-plus product."""
    m = matrices[0]
    for step in matrices[1:]:
        m = (m[:, :, None] + step[None]).max(axis=1)
    return m


def borders(matrices: list[np.ndarray], before: int | None = None, end: int | None = None) -> list[int]:
    """State at the end of each chunk on the best path between an optional state before and an optional last state."""
    score, back = matrices[0][before or 0], []
    for m in matrices[1:]:
        s = score[:, None] + m
        back.append(s.argmax(axis=0))
        score = s.max(axis=0)
    state = int(score.argmax()) if end is None else end
    out = [state]
    for arg in reversed(back):
        state = int(arg[state])
        out.append(state)
    return out[::-1]


def turns(lines: list[tuple[int, int, int, str, str, int]], states: list[int]) -> list[tuple[int, int, str, bool, str]]:
    """(piece, line, role, begins, text) of each run of lines of one turn.

    Only the line that begins a turn loses its marker; the others, and the blank
    lines between them, stay as they are.
    """
    out: list[list] = []
    for (p, n, _, rest, line, blanks), s in zip(lines, states):
        if s % 2 == 0:
            out.append([p, n, ROLES[s // 2], True, [rest] if rest.strip() else []])
        elif not out:
            out.append([p, n, ROLES[s // 2], False, [""] * blanks + [line]])
        else:
            out[-1][4].extend([""] * (blanks if out[-1][4] else 0) + [line])
    return [(p, n, r, b, "\n".join(x)) for p, n, r, b, x in out]


def render(role: str, begins: bool, text: str) -> str:
    """Canonical form: a header line for a turn, then its text."""
    return (f"<|{role}|>\n" if begins else "") + text + "\n"


def learn(df: DataFrame, conv: str, order: str, text: str, role: str) -> dict:
    """Count the model on labelled rows, where a row is one turn.

    The turn before is found by joining on (conversation, number), which spreads
    even one long conversation. The counts are bounded by the model's size.
    """
    known = df.where(F.col(role).isin(*ROLES)).select(
        F.col(conv).alias("c"), F.col(order).alias("o"), F.col(text).alias("t"), F.col(role).alias("r"))
    last = known.groupBy("c", (F.col("o") + 1).alias("o")).agg(F.max("r").alias("before"))
    rows = known.join(last, ["c", "o"], "left").select("r", "before", "t")

    def count(batches):
        trans: dict[tuple[int, int], int] = {}
        emit: dict[tuple[int, int], int] = {}
        for b in batches:
            for r, before, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                got = lines_of([t], False)
                if not got:
                    continue
                begin = 2 * ROLES.index(r)
                prev = START if before is None else 2 * ROLES.index(before) + 1
                for i, (_, _, o, *_) in enumerate(got):
                    s = begin if i == 0 else begin + 1
                    # a turn of one line ends in its first state: both forms lead to the next turn
                    for a in ((prev, prev - 1) if i == 0 and prev != START else (prev,)):
                        trans[a, s] = trans.get((a, s), 0) + 1
                    emit[s, o] = emit.get((s, o), 0) + 1
                    prev = s
        rows_out = [("t", a, b, n) for (a, b), n in trans.items()] + [("e", a, b, n) for (a, b), n in emit.items()]
        cols = list(zip(*rows_out)) if rows_out else [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), *[pa.array(c, pa.int64()) for c in cols[1:]]], ["kind", "a", "b", "n"])

    counts = (rows.mapInArrow(count, "kind string, a bigint, b bigint, n bigint")
              .groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect())
    return estimate({(r["a"], r["b"]): r["n"] for r in counts if r["kind"] == "t"},
                    {(r["a"], r["b"]): r["n"] for r in counts if r["kind"] == "e"})


def chunked(df: DataFrame, conv: str, order: str, text: str) -> DataFrame:
    """(conv_id, part, seq, first, blank, last, tail, ps): chunks of pieces in order, written and read again.

    ``(part, seq)`` orders the chunks. ``first`` and ``last`` say whether the conversation begins and
    ends with the chunk as far as its partition shows, ``blank`` and ``tail`` how many blank lines
    stand before it and at its end. Blank pieces before the first line of a chunk are only counted,
    so every chunk holds a line.
    """
    src = df.select(F.col(conv).alias("conv_id"), F.col(order).cast("bigint").alias("o"), F.col(text).alias("t"))
    conv_type = src.schema["conv_id"].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        part, seq, ps, size, c, first, blank = TaskContext.get().partitionId(), 0, [], 0, None, True, 0
        names = ["conv_id", "part", "seq", "first", "blank", "last", "tail", "ps"]
        conv_arrow = None

        def close(last):
            nonlocal seq, ps, size, first, blank
            tail = blank_tail([p["t"] for p in ps])
            row = (c, part, seq, first, blank, last, tail, ps)
            seq, ps, size, first, blank = seq + 1, [], 0, last, 0 if last else tail
            return row

        def pack(rows):
            types = [conv_arrow, pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.list_(pa.struct([("o", pa.int64()), ("t", pa.string())]))]
            cols = list(zip(*rows)) if rows else [()] * 8
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], names)

        for b in batches:
            out, conv_arrow = [], b.column(0).type
            for ident, o, t in zip(*(b.column(i).to_pylist() for i in range(3))):
                if ps and (ident != c or len(ps) == CHUNK or size >= CHUNK_BYTES):
                    out.append(close(ident != c))
                elif not ps and ident != c:
                    first, blank = True, 0
                c = ident
                if not ps and not (t or "").strip():
                    blank += (t or "").count("\n") + 1
                    continue
                ps.append({"o": o, "t": t})
                size += len(t or "")
            yield pack(out)
        if ps:
            yield pack([close(True)])

    at = fresh_path(df.sparkSession, "chat-chunks")
    # rows equal in all columns may lie in any order: the last column only spreads them
    (src.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange("conv_id", "o", "t", "spread")
     .sortWithinPartitions("conv_id", "o", "t").select("conv_id", "o", "t")
     .mapInArrow(run, f"conv_id {conv_type}, part bigint, seq bigint, first boolean, blank bigint, last boolean, "
                      "tail bigint, ps array<struct<o: bigint, t: string>>").write.parquet(at))
    return df.sparkSession.read.parquet(at)


def crossings(chunks: DataFrame) -> tuple[dict[int, bool], set[tuple[int, int]], int, int]:
    """What no partition sees by itself, from one narrow row per partition.

    The partitions that begin inside a conversation (with the blank line before them), the chunks (part, seq) that
    it goes on from, the number of parts and the most chunks of one.
    """
    edges = (chunks.groupBy("part").agg(F.min_by("conv_id", "seq").alias("head"), F.max_by("conv_id", "seq").alias("end"),
                                        F.max_by("tail", "seq").alias("tail"), F.max("seq").alias("seq"))
             .orderBy("part").collect())
    inside, left = {}, set()
    for a, b in zip(edges, edges[1:]):
        if a["end"] == b["head"]:
            inside[b["part"]] = a["tail"]
            left.add((a["part"], a["seq"]))
    return inside, left, max((e["part"] for e in edges), default=-1) + 1, max((e["seq"] for e in edges), default=-1) + 1


def border_states(ms: DataFrame, conv_type: str, count: int, fan_in: int = FAN_IN) -> DataFrame:
    """(n, before, last) of the chunks ``ms`` (conv_id, n, m), ``n`` below ``count``: up a tree of products and down again."""
    square = lambda x: np.array(x).reshape(STATES, STATES)

    def multiply(batches):
        for b in batches:
            got = [product([square(x["m"]) for x in kids.as_py()]).ravel().tolist() for kids in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got, pa.list_(pa.float64()))],
                                             ["conv_id", "n", "m"])

    def descend(batches):
        for b in batches:
            rows = []
            for c, kids, before, last in zip(*(b.column(i).to_pylist() for i in range(4))):
                end = borders([square(x["m"]) for x in kids], before, last)
                rows += [(c, x["n"], end[i - 1] if i else before, e) for i, (x, e) in enumerate(zip(kids, end))]
            cols = list(zip(*rows)) if rows else [()] * 4
            types = [b.column(0).type, pa.int64(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], ["conv_id", "n", "before", "last"])

    levels = []
    while count > 1 or not levels:
        kids = cut(ms.groupBy("conv_id", F.expr(f"n div {fan_in}").alias("up"))
                   .agg(F.sort_array(F.collect_list(F.struct("n", "m"))).alias("kids")))
        levels.append(kids)
        ms = kids.mapInArrow(multiply, f"conv_id {conv_type}, n bigint, m array<double>")
        count = -(-count // fan_in)
    none = F.lit(None).cast("int")
    ready = levels[-1].select("conv_id", "kids", none.alias("before"), none.alias("last"))
    for i in range(len(levels) - 1, -1, -1):
        states = ready.mapInArrow(descend, f"conv_id {conv_type}, n bigint, before int, last int")
        if i:
            x, s = levels[i - 1].alias("x"), states.alias("s")
            ready = x.join(s, F.col("x.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("x.up") == F.col("s.n"))) \
                .select("x.conv_id", "x.kids", "s.before", "s.last")
    return states.drop("conv_id")


def parse(df: DataFrame, model: dict, conv: str = "conv_id", order: str = "turn", text: str = "text") -> DataFrame:
    """(conv_id, piece, line, role, begins, text, rendered): one row per run of lines of one turn.

    ``piece`` and ``line`` say where the run starts; a run that does not begin a
    turn goes on from the chunk before. The rendered runs in order are the
    canonical transcript.
    """
    model_of = df.sparkSession.sparkContext.broadcast(model)
    chunks = chunked(df, conv, order, text)
    conv_type = chunks.schema["conv_id"].dataType.simpleString()
    inside, left, parts, most = crossings(chunks)

    def matrices(batches):
        m = model_of.value
        for b in batches:
            ids, nums, out = [], [], []
            for i, (c, part, seq, first, blank, last) in enumerate(zip(*(b.column(k).to_pylist() for k in range(6)))):
                if seq == 0 and part in inside:
                    first, blank = False, blank + inside[part]
                if first and last and (part, seq) not in left:
                    continue                                # a whole conversation
                symbols = [x[2] for x in lines_of([p["t"] for p in b.column(6)[i].as_py()], first or blank > 0, blank)]
                ids.append(c)
                nums.append(part * most + seq)
                out.append(matrix(m, symbols, first).ravel().tolist())
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), pa.array(nums, pa.int64()),
                                              pa.array(out, pa.list_(pa.float64()))], ["conv_id", "n", "m"])

    ms = cut(chunks.select("conv_id", "part", "seq", "first", "blank", "last", "ps")
             .mapInArrow(matrices, f"conv_id {conv_type}, n bigint, m array<double>"))
    known = cut(border_states(ms, conv_type, parts * most))
    ready = chunks.withColumn("n", F.col("part") * most + F.col("seq")).drop("last") \
        .join(sized_broadcast(known, 40), "n", "left").select("conv_id", "ps", "before", "last", "part", "seq", "first", "blank")

    def decode(batches):
        m = model_of.value
        for b in batches:
            rows = []
            for c, ps, before, last, part, seq, first, blank in zip(*(b.column(i).to_pylist() for i in range(8))):
                if seq == 0 and part in inside:
                    first, blank = False, blank + inside[part]
                lines = lines_of([p["t"] for p in ps], first or blank > 0, blank)
                for p, n, role, begins, text_ in turns(lines, viterbi(m, [x[2] for x in lines], before, last)):
                    rows.append((c, ps[p]["o"], n, role, begins, text_, render(role, begins, text_)))
            cols = list(zip(*rows)) if rows else [()] * 7
            types = [b.column(0).type, pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)],
                                             ["conv_id", "piece", "line", "role", "begins", "text", "rendered"])

    return ready.mapInArrow(decode, f"conv_id {conv_type}, piece bigint, line int, role string, begins boolean, "
                                    "text string, rendered string")


#: Speaker markers of raw transcripts, by style: system, user, assistant.
STYLES = (("System: ", "User: ", "Assistant: "), ("System: ", "Human: ", "AI: "),
          ("### Context:\n", "### Instruction:\n", "### Response:\n"), ("Context: ", "Q: ", "A: "),
          ("<system> ", "<user> ", "<assistant> "))


def raw_transcripts(df: DataFrame, conv: str = "conv_id", order: str = "turn", text: str = "text",
                    role: str = "role") -> Column:
    """SQL column: a turn as it stands in a raw transcript of its conversation's style, one marker in seven missing."""
    style = F.pmod(F.xxhash64(F.col(conv)), F.lit(len(STYLES)))
    mark = F.lit("")
    for i, marks in enumerate(STYLES):
        for r, m in zip(ROLES, marks):
            mark = F.when((style == i) & (F.col(role) == r), F.lit(m)).otherwise(mark)
    kept = F.pmod(F.xxhash64(F.col(conv), F.col(order)), F.lit(7)) != 0
    return F.concat(F.lit("\n"), F.when(kept, mark).otherwise(F.lit("")), F.coalesce(F.col(text), F.lit("")))
