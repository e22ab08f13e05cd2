"""Chat formatting with minimum-cost role repair.

A conversation is legal if an automaton over turns accepts its roles: an optional system turn, then user and assistant
turns in alternation, user first. Each turn is kept, relabelled or merged into the one before it, and an empty turn may be
inserted before it; dynamic programming over the automaton's states finds the cheapest repair. Costs add up and states
are four, so a chunk of turns is a 4 x 4 matrix in the (min, +) algebra: long conversations are cut into chunks whose
matrices are chained, and each chunk is then repaired on its own between known states.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import fresh, shuffle_partitions, staged

ROLES = ("system", "user", "assistant")
#: State 0: nothing yet; state i: the last turn is ROLES[i - 1]. What may follow each state.
FOLLOW = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
#: A conversation may end in these states (a closing user turn is an open prompt); 0: it has no turns.
FINAL = (0, 2, 3)
MERGE_SAME, MERGE_OTHER, RELABEL, RELABEL_SYSTEM, INSERT = 1, 5, 4, 6, 3
FAR = 1 << 40
CHUNK_TURNS = 512
HEAD, TAIL, JOINT = "<|{role}|>\n", "<|end|>\n", "\n\n"


def moves(role: int) -> list[tuple[int, int, int, str, int]]:
    """(from, to, cost, action, inserted role or 0) for a turn with role 1 to 3, or 0 for an unknown one; cheapest first."""
    out = []
    for s in range(4):
        for between in (0, *FOLLOW[s]):
            mid, price = (between, INSERT) if between else (s, 0)
            for q in FOLLOW[mid]:
                if q == role:
                    out.append((s, q, price, "keep", between))
                else:
                    out.append((s, q, price + (RELABEL_SYSTEM if 1 in (q, role) else RELABEL), "relabel", between))
        if s:
            out.append((s, s, MERGE_SAME if s == role else MERGE_OTHER, "merge", 0))
    best: dict[tuple[int, int], tuple[int, int, int, str, int]] = {}
    rank = {"keep": 0, "merge": 1, "relabel": 2}
    for m in sorted(out, key=lambda m: (m[2], rank[m[3]], m[4])):
        best.setdefault(m[:2], m)
    return list(best.values())


MOVES = {r: {(m[0], m[1]): m for m in moves(r)} for r in range(4)}
MATRIX = {r: np.array([[MOVES[r][s, t][2] if (s, t) in MOVES[r] else FAR for t in range(4)] for s in range(4)]) for r in range(4)}


def role_number(role: str | None) -> int:
    named = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant"}
    name = (role or "").strip().lower()
    name = named.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else 0


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


def transfer(roles: list[int]) -> np.ndarray:
    m = np.where(np.eye(4, dtype=bool), 0, FAR)
    for r in roles:
        m = chain(m, MATRIX[r])
    return m


def repair(roles: list[int], start: int = 0, after: list[int] | None = None) -> tuple[list[tuple[int, int, int, str, int]], int]:
    """The cheapest moves for a run of turns from state `start`, given what each state costs after it; and their cost.

    Ties go to the smaller next state at the earliest turn."""
    togo = [list(after) if after is not None else [0 if s in FINAL else FAR for s in range(4)]]
    for r in reversed(roles):
        m = MATRIX[r]
        togo.append([min(int(m[s, t]) + togo[-1][t] for t in range(4)) for s in range(4)])
    togo.reverse()
    out, s = [], start
    for k, r in enumerate(roles):
        t = min(range(4), key=lambda t: (int(MATRIX[r][s, t]) + togo[k + 1][t], t))
        out.append(MOVES[r][s, t])
        s = t
    return out, togo[0][start]


def pieces(moves_made: list[tuple[int, int, int, str, int]], texts: list[str | None], last: bool) -> list[list[tuple[int, str, str, int, str]]]:
    """For each turn, its output rows (part, role, action, cost, rendered): an inserted turn is part 0, the turn itself part 1.

    Rendered rows in order make up the conversation: a turn is closed by what follows it. `<|` in a text is spaced out."""
    out = []
    for k, ((s, t, cost, action, between), text) in enumerate(zip(moves_made, texts, strict=True)):
        rows = []
        clean = (text or "").replace("<|", "< |")
        if between:
            rows.append((0, ROLES[between - 1], "insert", INSERT, (TAIL if s else "") + HEAD.format(role=ROLES[between - 1])))
            cost -= INSERT
        if action == "merge":
            shown = JOINT + clean
        else:
            shown = (TAIL if s or between else "") + HEAD.format(role=ROLES[t - 1]) + clean
        rows.append((1, ROLES[t - 1], action, cost, shown + (TAIL if last and k == len(texts) - 1 else "")))
        out.append(rows)
    return out


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """(conv, turn, part, role, action, cost, rendered), one row per output turn or merged part.

    Turns go by number, null numbers last, ties by the SHA-1 of role and text. A task holds the turns of one chunk: of
    `chunk_turns` numbers, so more only where numbers repeat, or a 64th of a conversation's turns without a number. Unknown and null roles are relabelled, null texts are
    empty, repeated turns are turns. A null conversation is one conversation. An empty table gives no rows. Further columns aren't read.
    """
    spark = turns.sparkSession
    at = F.col(turn).cast("long")
    h = F.xxhash64(F.col(role), F.col(text))
    chunk = F.when(at.isNull(), F.lit(1 << 50) + F.pmod(F.shiftrightunsigned(h, 1), F.lit(64))).otherwise(F.floor(at / chunk_turns))
    rows = turns.select(F.col(conv).cast("string").alias("conv"), at.alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"), chunk.cast("long").alias("chunk"), F.sha1(F.concat_ws("\x00", F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit("")))).alias("tie"))
    n = shuffle_partitions(spark)
    order = ["conv", "chunk", "turn", "tie"]
    matrices = pa.schema([("conv", pa.string()), ("chunk", pa.int64()), ("m", pa.list_(pa.int64()))])

    def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
        key, held = None, []
        for b in batches:
            for r in zip(*(b.column(c).to_pylist() for c in names), strict=True):
                if held and r[:2] != key:
                    yield key, held
                    held = []
                key = r[:2]
                held.append(r)
        if held:
            yield key, held

    def batch_of(made: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*made, strict=True), schema, strict=True)], schema=schema)

    def grouped(made: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
        held = []
        for r in made:
            held.append(r)
            if len(held) >= size:
                yield batch_of(held, schema)
                held = []
        if held:
            yield batch_of(held, schema)

    def to_matrix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from grouped(((k[0], k[1], transfer([role_number(r[2]) for r in g]).ravel().tolist()) for k, g in runs(batches, ["conv", "chunk", "role"])), matrices)

    few = rows.drop("text").repartition(n, "conv", "chunk").sortWithinPartitions(*order)
    chunks = staged(few.mapInArrow(to_matrix, "conv string, chunk long, m array<long>"), "chat-chunks")
    costs = pa.schema([*matrices, ("togo", pa.list_(pa.int64())), ("last", pa.bool_())])
    ends = pa.schema([("conv", pa.string()), ("chunk", pa.int64()), ("start", pa.int32()), ("togo", pa.list_(pa.int64())), ("last", pa.bool_())])

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def go():
            begun, conv_now, togo = False, None, []
            for b in batches:
                for c, k, m in zip(*(b.column(x).to_pylist() for x in ("conv", "chunk", "m")), strict=True):
                    first = not begun or c != conv_now
                    if first:
                        begun, conv_now, togo = True, c, [0 if s in FINAL else FAR for s in range(4)]
                    yield c, k, m, togo, first
                    togo = (np.array(m).reshape(4, 4) + np.array(togo)[None, :]).min(axis=1).tolist()

        yield from grouped(go(), costs)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def go():
            begun, conv_now, state = False, None, 0
            for b in batches:
                for c, k, m, togo, last in zip(*(b.column(x).to_pylist() for x in ("conv", "chunk", "m", "togo", "last")), strict=True):
                    if not begun or c != conv_now:
                        begun, conv_now, state = True, c, 0
                    begin, state = state, min(range(4), key=lambda t: (m[4 * state + t] + togo[t], t))
                    yield c, k, begin, [0 if t == state else FAR for t in range(4)], last  # ties: the chunk must end where the next begins

        yield from grouped(go(), ends)

    down = chunks.repartition(n, "conv").sortWithinPartitions("conv", F.desc("chunk")).mapInArrow(backward, "conv string, chunk long, m array<long>, togo array<long>, last boolean")
    up = down.repartition(n, "conv").sortWithinPartitions("conv", "chunk").mapInArrow(forward, "conv string, chunk long, start int, togo array<long>, last boolean")
    bounds = up.withColumnRenamed("conv", "c").withColumnRenamed("chunk", "k")
    both = rows.join(bounds, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k"))).drop("c", "k").repartition(n, "conv", "chunk").sortWithinPartitions(*order)
    out = pa.schema([("conv", pa.string()), ("turn", pa.int64()), ("part", pa.int32()), ("role", pa.string()), ("action", pa.string()), ("cost", pa.int64()), ("rendered", pa.string())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def go():
            for (c, _), g in runs(batches, ["conv", "chunk", "turn", "role", "text", "start", "togo", "last"]):
                made, _cost = repair([role_number(r[3]) for r in g], g[0][5], g[0][6])
                for r, parts in zip(g, pieces(made, [r[4] for r in g], g[0][7]), strict=True):
                    for p in parts:
                        yield c, r[2], *p

        yield from grouped(go(), out)

    made = both.mapInArrow(decode, "conv string, turn long, part int, role string, action string, cost long, rendered string")
    name = fresh(turns, conv) if conv not in turns.columns else conv
    return made.withColumn("conv", F.col("conv").cast(dict(turns.dtypes)[conv])).withColumnRenamed("conv", name)
