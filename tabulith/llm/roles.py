"""Chat formatting with minimum-cost role repair.

A conversation is legal if it is an optional system turn, then user and assistant turns in alternation that begin
with a user. Every turn is either kept with its role, relabelled, or merged into the turn before it; an empty turn may
be inserted before any turn, and at the end so that the conversation closes with the assistant. Dynamic programming over the automaton
of legal turns finds the cheapest repair; rendering joins what it yields.

Turns are ordered by conversation and turn over the whole table by range, so a conversation of any length
spreads over partitions. A partition's pieces of conversations are first summed up as cost matrices from state to
state; only the pieces at a partition's two ends are chained on the driver (two small matrices per partition),
which tells each partition the states its pieces begin and end in.

A role that is null or unknown can only be relabelled or merged. A null text is empty. Ties prefer keeping,
then relabelling, then merging, then insertion, and the first role in ROLES. Turns with the same number are ordered by
role and text; null turns come first. Rows with a null conversation form one conversation.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.runtime import write_out

from .words import bound_batches

ROLES = ("system", "user", "assistant")
# states: what the last turn was; START before any turn
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
RELABEL, MERGE, MERGE_OTHER, INSERT, INSERT_LAST = 3, 1, 4, 5, 2
FAR = 1 << 40
KEEP, CHANGE, JOIN = 0, 1, 2

# one turn's choices: (from state, inserted states, action, to state)
_PATHS = [(a, (), b) for a in LEGAL for b in LEGAL[a]] + [(a, (b,), c) for a in LEGAL for b in LEGAL[a] for c in LEGAL[b]]


def _choices(role: str | None) -> dict[tuple[int, int], tuple[int, tuple]]:
    """Cheapest way of taking a turn of this role from one state to another: {(from, to): (cost, how)}."""
    own = ROLES.index(role) + 1 if role in ROLES else None
    best: dict[tuple[int, int], tuple] = {}

    def offer(a: int, b: int, cost: int, how: tuple) -> None:
        if (a, b) not in best or (cost, how) < best[a, b]:
            best[a, b] = (cost, how)
    for a, inserted, b in _PATHS:
        kept = b == own
        offer(a, b, INSERT * len(inserted) + (0 if kept else RELABEL), (KEEP if kept else CHANGE, inserted))
    for a in (SYSTEM, USER, ASSISTANT):
        offer(a, a, MERGE if a == own else MERGE_OTHER, (JOIN, ()))
    return best


_CHOICES = {r: _choices(r) for r in (*ROLES, None)}


def _matrix(role: str | None) -> np.ndarray:
    out = np.full((4, 4), FAR, np.int64)
    for (a, b), (cost, _) in _CHOICES[role].items():
        out[a, b] = cost
    return out


_MATRICES = {r: _matrix(r) for r in _CHOICES}
# after the last turn: a user or system turn needs an assistant's empty reply
_CLOSE = np.array([0, INSERT_LAST + INSERT, INSERT_LAST, 0], np.int64)
_TAIL = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}


def _known(role: str | None) -> str | None:
    role = role.strip().lower() if role else None
    return role if role in ROLES else None


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cheapest cost from state to state through two pieces in turn."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(1), FAR)


def piece_matrix(roles: list[str | None]) -> np.ndarray:
    """Costs from state to state over a run of turns."""
    out = np.where(np.eye(4, dtype=bool), 0, FAR)
    for r in roles:
        out = chain(out, _MATRICES[r])
    return out


def repair(roles: list[str | None], begin: int = START, end: int | None = None) -> tuple[int, int, list[tuple]]:
    """(cost, end state, how per turn with its state after) of the cheapest legal reading of the turns.

    ``end`` fixes the state after the last turn; without it, the closing insertions count too.
    """
    cost = np.full(4, FAR, np.int64)
    cost[begin] = 0
    steps = []
    for r in roles:
        through = cost[:, None] + _MATRICES[r]
        steps.append(through.argmin(0))
        cost = np.minimum(through.min(0), FAR)
    last = int((cost + _CLOSE).argmin()) if end is None else end
    total = int(cost[last] + (_CLOSE[last] if end is None else 0))
    state, how = last, []
    for r, came in zip(reversed(roles), reversed(steps)):
        before = int(came[state])
        how.append((_CHOICES[r][before, state][1], state))
        state = before
    return total, last, how[::-1]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str | None, list[tuple]]]:
    """(part, conversation, its (turn, role, text) rows) of each run of rows."""
    at, rows = None, []
    for batch in batches:
        for part, conv, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (part, conv) != at:
                if rows:
                    yield *at, rows
                at, rows = (part, conv), []
            rows.append((turn, role, text))
    if rows:
        yield *at, rows


def _end_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, place, conv, costs): the first and the last piece of each part; those between are whole conversations."""
    def given(ends: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([e[0] for e in ends], pa.int32()), pa.array(range(len(ends)), pa.int32()),
             pa.array([e[1] for e in ends], pa.string()),
             pa.array([piece_matrix([_known(r) for _, r, _ in e[2]]).ravel().tolist() for e in ends], pa.list_(pa.int64()))],
            ["part", "place", "conv", "costs"])
    ends = []
    for piece in _pieces(batches):
        if ends and ends[0][0] != piece[0]:
            yield given(ends)
            ends = []
        ends = [*ends[:1], piece]
    if ends:
        yield given(ends)


def _borders(ends: list[tuple]) -> dict[tuple[int, str | None], tuple[int, int | None]]:
    """{(part, conv): (state before, state after or None at the conversation's end)} of the pieces at part ends."""
    out = {}
    pieces: dict[str | None, list[tuple]] = {}
    for part, place, conv, costs in sorted(ends, key=lambda e: e[:2]):
        pieces.setdefault(conv, []).append((part, np.array(costs, np.int64).reshape(4, 4)))
    for conv, own in pieces.items():
        cost = np.full(4, FAR, np.int64)
        cost[START] = 0
        came = []
        for _, m in own:
            came.append((cost[:, None] + m).argmin(0))
            cost = np.minimum((cost[:, None] + m).min(0), FAR)
        state, after = int((cost + _CLOSE).argmin()), None
        for (part, _), back in zip(reversed(own), reversed(came)):
            before = int(back[state])
            out[part, conv] = (before, after)
            state = after = before
    return out


def _rendered(conv: str | None, rows: list[tuple], begin: int, end: int | None) -> Iterator[tuple]:
    """(conv, turn, step, role, action, cost, segment) of each repaired turn of a piece."""
    _, last, how = repair([_known(r) for _, r, _ in rows], begin, end)
    step, at = 0, object()
    for (turn, role, text), ((action, inserted), state) in zip(rows, how):
        step, at = (step, at) if turn == at else (0, turn)
        for s in inserted:
            yield conv, turn, step, ROLES[s - 1], "insert", INSERT, render(ROLES[s - 1], "")
            step += 1
        name = ROLES[state - 1]
        own = _known(role) == name
        if action == JOIN:
            yield conv, turn, step, name, "merge", MERGE if own else MERGE_OTHER, "\n" + (text or "")
        else:
            yield conv, turn, step, name, "keep" if own else "relabel", 0 if own else RELABEL, render(name, text or "")
        step += 1
    if end is None:
        for i, s in enumerate(_TAIL[last]):
            yield (conv, rows[-1][0], step + i, ROLES[s - 1], "insert",
                   INSERT_LAST if i == len(_TAIL[last]) - 1 else INSERT, render(ROLES[s - 1], ""))


def render(role: str, text: str) -> str:
    return f"<|{role}|>\n{text}"


def repair_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """One row per turn of the repaired conversations: conv_id (as text), turn, step (order among rows of one turn number),
    role, action (keep, relabel, merge, insert), cost and segment (what the turn adds to the rendered conversation).

    A conversation's cost is the sum over its rows, and its rendering the segments joined by turn and step,
    each but a merged one on a new line.
    """
    spark = turns.sparkSession
    bound_batches(spark)
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    ordered = turns.select(F.col(conv).cast("string").alias("conv"), F.col(turn).cast("bigint").alias("turn"),
                           F.col(role).alias("role"), F.col(text).alias("text")).repartitionByRange(*keys)
    # the parts are written, so that both passes see the same borders
    parts = write_out(ordered.select(F.spark_partition_id().alias("part"), "conv", "turn", "role", "text"), "turn-ranges")
    runs = parts.repartition("part").sortWithinPartitions("part", *keys)
    ends = [tuple(r) for r in runs.mapInArrow(
        _end_pieces, "part int, place int, conv string, costs array<bigint>").collect()]  # two rows per part
    borders = spark.sparkContext.broadcast(_borders(ends))

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for part, conv_, rows in _pieces(batches):
            held += _rendered(conv_, rows, *borders.value.get((part, conv_), (START, None)))
            if len(held) > 2000:
                yield _batch(held)
                held = []
        yield _batch(held)
    return runs.mapInArrow(repaired, "conv_id string, turn bigint, step int, role string, action string, cost int, "
                                     "segment string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "turn", "step", "role", "action", "cost", "segment"]
    types = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string()]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
