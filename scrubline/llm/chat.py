"""Chat conversations repaired at minimum cost into legal turns, and rendered.

Legal turns are an automaton: an optional system turn, then user and assistant in turn, ending with
the assistant. Every source turn is kept, given another role, or merged into the turn before it, and
empty turns may be put in between; a dynamic program over the automaton's states finds the cheapest
way. Conversations are cut into blocks of a bounded number of turns. The costs of a block form a small
matrix between states, so the cost to the end is known at every block boundary by multiplying
matrices (in two levels), and a conversation of any length is repaired block by block, with the same
result as in one piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.tables import is_empty, map_slices
from scrubline.llm.vectors import packed
from scrubline.workspace import written

SYSTEM, USER, ASSISTANT = range(3)
ROLES = ("system", "user", "assistant")
# Other names of the roles that cost nothing.
ALIASES = {"human": "user", "bot": "assistant", "model": "assistant", "gpt": "assistant"}

# What a step costs.
MERGE, INSERT, RELABEL, NAME_UNKNOWN = 2, 3, 5, 1

# Turns of a conversation that one task repairs at a time.
BLOCK_TURNS = 64

# States: nothing yet, or the role of the open turn.
STATES, START = 4, 3
# Empty turns that must come before a turn of a role, from each state; None where it cannot come.
BEFORE = {
    START: {SYSTEM: (), USER: (), ASSISTANT: (USER,)},
    SYSTEM: {SYSTEM: None, USER: (), ASSISTANT: (USER,)},
    USER: {SYSTEM: None, USER: (ASSISTANT,), ASSISTANT: ()},
    ASSISTANT: {SYSTEM: None, USER: (), ASSISTANT: (USER,)},
}
# Empty turns that end a conversation from each state.
CLOSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
FINAL = np.array([INSERT * len(CLOSING[s]) for s in range(STATES)], float)

_ENDED, _JOINED = "<|end|>\n", "\n\n"


def role_of(name: str | None) -> int | None:
    name = (name or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else None


def steps(state: int, role: int | None) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """(cost, next state, action, empty turns before) of a turn, in the order that settles ties."""
    found = []
    for new in (USER, ASSISTANT, SYSTEM):
        cost = 0 if role == new else NAME_UNKNOWN if role is None else RELABEL
        before = BEFORE[state][new]
        if before is not None:
            found.append((cost + INSERT * len(before), new, "keep", before))
        if state == new:
            found.append((cost + MERGE, new, "merge", ()))
    return sorted(found, key=lambda s: (s[0], s[2] == "merge", role != s[1]))


_STEPS = {(s, r): steps(s, r) for s in range(STATES) for r in (None, SYSTEM, USER, ASSISTANT)}


def costs_back(roles: list[int | None], after: np.ndarray) -> list[np.ndarray]:
    """Cheapest cost from each state before each turn to the end, and ``after`` as the last."""
    found = [after]
    for role in reversed(roles):
        then = found[-1]
        found.append(
            np.array([min(cost + then[to] for cost, to, _, _ in _STEPS[s, role]) for s in range(STATES)])
        )
    return found[::-1]


def chosen(roles: list[int | None], after: np.ndarray, state: int) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """The steps of the cheapest way from ``state``; of equal ways the first step that is listed."""
    ahead, path = costs_back(roles, after), []
    for i, role in enumerate(roles):
        step = next(s for s in _STEPS[state, role] if s[0] + ahead[i + 1][s[1]] == ahead[i][state])
        path.append(step)
        state = step[1]
    return path


def matrix_of(roles: list[int | None]) -> np.ndarray:
    """Cheapest cost of a block from each state to each state."""
    ends = np.where(np.eye(STATES, dtype=bool), 0.0, np.inf)
    return np.column_stack([costs_back(roles, end)[0] for end in ends])


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def _rendered(role: int, text: str, first: bool, merged: bool) -> str:
    # Markers inside a text are taken apart, so that only the renderer makes turns.
    safe = text.replace("<|", "< |")
    return f"{_JOINED}{safe}" if merged else f"{'' if first else _ENDED}<|{ROLES[role]}|>\n{safe}"


def repaired(
    roles: list[int | None],
    names: list[str | None],
    texts: list[str | None],
    turns: list[int | None],
    after: np.ndarray | None = None,
    state: int = START,
    turn: int = 0,
    seq: int = 0,
    last: bool = True,
) -> Iterator[tuple]:
    """(seq, out_turn, role, action, cost, source_turn, source_role, text, rendered) per output row.

    ``state``, ``turn`` and ``seq`` say where the block stands in its conversation.
    """
    path = chosen(roles, FINAL if after is None else after, state)
    closing = CLOSING[path[-1][1] if path else state] if last else ()
    total = sum(len(p[3]) + 1 for p in path) + len(closing)
    made = 0

    def row(role: int, action: str, cost: int, source_turn, source_role, text: str) -> tuple:
        nonlocal turn, made
        merged = action == "merge"
        fragment = _rendered(role, text, turn == 0, merged)
        turn += not merged
        made += 1
        if last and made == total:
            fragment += _ENDED
        return (seq + made - 1, turn - 1, ROLES[role], action, cost, source_turn, source_role, text, fragment)

    for (cost, role, action, before), name, text, at in zip(path, names, texts, turns, strict=True):
        for empty in before:
            yield row(empty, "insert", INSERT, None, None, "")
        own = cost - INSERT * len(before)
        relabelled = action == "keep" and role_of(name) != role
        yield row(role, "relabel" if relabelled else action, own, at, name, text or "")
    for empty in closing:
        yield row(empty, "insert", INSERT, None, None, "")


# --- over blocks of long conversations ---------------------------------------------

_KEYS = ["no_conv", "conv"]


def _listed(values: np.ndarray) -> list[float]:
    return [float(v) for v in np.asarray(values, float).ravel()]


def _costs_after(blocks: DataFrame) -> DataFrame:
    """``block``, ``after``: the costs to the end from each state behind each block."""
    width = f"{', '.join(f'{k} {t}' for k, t in zip(_KEYS, ('boolean', 'long'), strict=True))}"

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [_listed(matrix_of([role_of(n) for n in names])) for names in batch.column(3).to_pylist()]
        columns = [*batch.columns[:3], pa.array(made, pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(columns, [*_KEYS, "block", "costs"])

    costs = map_slices(blocks.select(*_KEYS, "block", "role"), rule, f"{width}, block long, costs array<double>")
    costs = written(costs.withColumn("part", F.shiftright("block", 32)), "costs")

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        total = np.where(np.eye(STATES, dtype=bool), 0.0, np.inf)
        for cell in rows["costs"]:
            total = product(total, np.asarray(cell).reshape(STATES, STATES))
        return rows.iloc[:1].assign(costs=[_listed(total)])[[*_KEYS, "part", "costs"]]

    def backward(rows: pd.DataFrame, order: str) -> pd.DataFrame:
        rows = rows.sort_values(order, ascending=False)
        after = np.asarray(rows["end"].iloc[0]) if "end" in rows else FINAL
        found = []
        for cell in rows["costs"]:
            found.append(_listed(after))
            after = (np.asarray(cell).reshape(STATES, STATES) + after[None, :]).min(axis=1)
        return rows.assign(after=found)

    # A part is what one range of the sort holds, so both levels have bounded groups.
    parts = costs.groupBy(*_KEYS, "part").applyInPandas(whole, f"{width}, part long, costs array<double>")
    ends = parts.groupBy(*_KEYS).applyInPandas(
        lambda rows: backward(rows, "part")[[*_KEYS, "part", "after"]], f"{width}, part long, after array<double>"
    )
    ends = written(ends.withColumnRenamed("after", "end"), "ends")
    return costs.join(ends, [*_KEYS, "part"]).groupBy(*_KEYS, "part").applyInPandas(
        lambda rows: backward(rows, "block")[["block", "after"]], "block long, after array<double>"
    )


def _starts(blocks: DataFrame) -> DataFrame:
    """``block``, ``state``, ``turn``, ``seq``: where each block with known ``after`` begins."""
    width = f"{', '.join(f'{k} {t}' for k, t in zip(_KEYS, ('boolean', 'long'), strict=True))}"

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for names, after in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
            roles = [role_of(n) for n in names]
            ways = [chosen(roles, np.array(after), s) for s in range(STATES)]
            ends = [w[-1][1] for w in ways]
            turns = [sum(len(p[3]) + (p[2] == "keep") for p in w) for w in ways]
            rows = [sum(len(p[3]) + 1 for p in w) for w in ways]
            made.append([*ends, *turns, *rows])
        columns = [*batch.columns[:3], pa.array(made, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, [*_KEYS, "block", "moves"])

    rows = blocks.select(*_KEYS, "block", "role", "after")
    moves = map_slices(rows, rule, f"{width}, block long, moves array<long>")
    moves = written(moves.withColumn("part", F.shiftright("block", 32)), "moves")

    def then(one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return np.concatenate([two[0][one[0]], one[1] + two[1][one[0]], one[2] + two[2][one[0]]]).reshape(3, -1)

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block")
        total = np.array([range(STATES), [0] * STATES, [0] * STATES])
        for cell in rows["moves"]:
            total = then(total, np.asarray(cell).reshape(3, -1))
        return rows.iloc[:1].assign(moves=[total.ravel().tolist()])[[*_KEYS, "part", "moves"]]

    def forward(rows: pd.DataFrame, order: str) -> pd.DataFrame:
        rows = rows.sort_values(order)
        at = tuple(rows["start"].iloc[0]) if "start" in rows else (START, 0, 0)
        found = []
        for cell in rows["moves"]:
            found.append([int(v) for v in at])
            move = np.asarray(cell).reshape(3, -1)
            state = int(at[0])
            at = (move[0][state], at[1] + move[1][state], at[2] + move[2][state])
        return rows.assign(at=found)

    parts = moves.groupBy(*_KEYS, "part").applyInPandas(whole, f"{width}, part long, moves array<long>")
    starts = parts.groupBy(*_KEYS).applyInPandas(
        lambda rows: forward(rows, "part")[[*_KEYS, "part", "at"]], f"{width}, part long, at array<long>"
    )
    starts = written(starts.withColumnRenamed("at", "start"), "starts")
    found = moves.join(starts, [*_KEYS, "part"]).groupBy(*_KEYS, "part").applyInPandas(
        lambda rows: forward(rows, "block")[["block", "at"]], "block long, at array<long>"
    )
    return found.select(
        "block", F.col("at")[0].alias("state"), F.col("at")[1].alias("turn"), F.col("at")[2].alias("seq")
    )


def repair(conversations: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The repaired turns of every conversation, a row per source turn and per empty turn put in.

    ``conv_id``, ``seq`` (from 0), ``out_turn`` (the repaired turn it belongs to), ``role``,
    ``action`` (keep, relabel, merge, insert), ``cost``, ``source_turn``, ``source_role``, ``text``,
    ``rendered``. The rendered pieces of a conversation in the order of ``seq`` make its chat text.

    Turns come in the order of ``turn`` (nulls first; ties by role, then by a hash of the text), and
    repeated rows are turns of their own. Unknown and null roles take the role that fits best. Null
    texts are empty. Rows with a null ``conv_id`` are one conversation. Other columns are ignored, an
    empty table gives no rows.
    """
    rows = conversations.select(
        F.col("conv_id").isNull().alias("no_conv"),
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.xxhash64(F.col("text").cast("string")).alias("dice"),
        F.col("text").cast("string").alias("text"),
    )
    blocks = written(packed(rows, _KEYS, ["turn", "role", "dice"], block_turns), "blocks")
    ends = blocks.groupBy(*_KEYS).agg(F.max("block").alias("last_block"), F.count("*").alias("blocks"))
    ends = written(ends, "ends")
    several = written(
        blocks.select(*_KEYS, "block", "role").join(ends.where("blocks > 1").select(*_KEYS), _KEYS), "several"
    )
    final = F.array(*[F.lit(float(v)) for v in FINAL])
    if is_empty(several):
        none = F.lit(0).cast("long")
        begin = {"after": final, "state": F.lit(START).cast("long"), "turn_at": none, "seq_at": none}
        placed = blocks.withColumns(begin)
    else:
        after = written(_costs_after(several), "after")
        starts = written(_starts(several.join(after, "block")), "starts")
        known = after.join(starts, "block").select(
            "block", "after", "state", F.col("turn").alias("turn_at"), F.col("seq").alias("seq_at")
        )
        placed = blocks.join(known, "block", "left").select(
            *blocks.columns,
            F.coalesce("after", final).alias("after"),
            F.coalesce("state", F.lit(START)).alias("state"),
            F.coalesce("turn_at", F.lit(0)).alias("turn_at"),
            F.coalesce("seq_at", F.lit(0)).alias("seq_at"),
        )
    last = ends.select(F.col("last_block").alias("block"), F.lit(True).alias("closes"))
    placed = placed.join(last, "block", "left")

    def rule(batch: pa.RecordBatch) -> pa.RecordBatch:
        made, convs = [], []
        cells = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for no_conv, conv, names, texts, turns, after_, state, turn, seq, closes in zip(*cells, strict=True):
            roles = [role_of(n) for n in names]
            found = list(
                repaired(roles, names, texts, turns, np.array(after_), state, turn, seq, bool(closes))
            )
            made += found
            convs += [None if no_conv else conv] * len(found)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()] + [pa.string()] * 3
        columns = list(zip(*made, strict=True)) if made else [()] * 9
        arrays = [pa.array(convs, pa.int64())]
        arrays += [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names_out)

    schema = (
        "conv_id long, seq long, out_turn long, role string, action string, cost long,"
        " source_turn long, source_role string, text string, rendered string"
    )
    names_out = [part.split()[0] for part in schema.split(",")]
    wanted = placed.select(*_KEYS, "role", "text", "turn", "after", "state", "turn_at", "seq_at", "closes")
    return map_slices(wanted, rule, schema, 64)
