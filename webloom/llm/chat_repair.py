"""Chat formatting: cheapest repair of a conversation's roles, then rendering.

A legal conversation is an optional system turn, then user and assistant turns by
turns, the last one the assistant's. Dynamic programming over this automaton (states:
nothing yet, after system, after user, after assistant) picks for every given turn

* its final role, for ``RELABEL`` if it had another known role (unknown ones: ``NAME``),
* whether it continues the turn before it, of equal role, for ``MERGE``, or opens one,
* empty turns to insert before it, for ``INSERT`` each,

and empty turns at the end, such that the sum is least. Of equally cheap repairs the
one that ends in and comes from the lower state is taken.

A turn's effect is a 4 x 4 matrix of costs under (min, +), which only depends on its
role, so a stretch of turns is a product of matrices. The table is sorted by
conversation and turn into parts of even size, wherever that cuts a conversation.
Each part tells the matrix of its first and last conversation; from these few
rows (two per part) the driver works out in which states the conversations that cross
borders enter and leave each part, and then every part repairs its own turns. So no
conversation, however long, has to fit into one task. The result is one row per
given turn, whose ``rendered`` pieces in order are the formatted conversation.

Defined results: turns come in the order of turn, then role, then text; null or unknown
roles are named by the repair; null texts are empty ones; rows without a conversation
id are one conversation; repeated rows are turns of their own; texts are escaped so
that they cannot hold a tag. Only the four named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.session import stage_table

ROLES = ("system", "user", "assistant")
ALIASES = {
    "human": "user", "prompter": "user", "customer": "user",
    "bot": "assistant", "gpt": "assistant", "model": "assistant", "ai": "assistant",
    "developer": "system", "instruction": "system",
}
RELABEL, NAME, MERGE, INSERT = 3, 1, 1, 2
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
FAR = 1 << 40
UNKNOWN = 0


def role_code(role: str | None) -> int:
    """1 to 3 for a known role or one of its other names, else 0."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else UNKNOWN


@cache
def inserted(state: int, to: int) -> tuple[int, ...] | None:
    """Fewest empty turns that lead from ``state`` to a new turn of state ``to``."""
    for n in range(3):
        for path in product((SYSTEM, USER, ASSISTANT), repeat=n):
            steps = (state, *path, to)
            if all(pair in LEGAL for pair in zip(steps, steps[1:])):
                return path
    return None


@cache
def move(role: int, state: int, to: int) -> tuple[int, bool, tuple[int, ...]]:
    """(cost, merged, inserted) of a turn of ``role`` that leads from one state to another."""
    if to == START:
        return FAR, False, ()
    label = 0 if role == to else NAME if role == UNKNOWN else RELABEL
    path = inserted(state, to)
    fresh = FAR if path is None else label + INSERT * len(path)
    if state == to and label + MERGE <= fresh:
        return label + MERGE, True, ()
    return fresh, False, path or ()


@cache
def matrix(role: int) -> np.ndarray:
    return np.array([[move(role, a, b)[0] for b in range(4)] for a in range(4)])


@cache
def closing(state: int) -> tuple[int, ...] | None:
    """Empty turns that end a conversation; a conversation of no turn needs none."""
    if state in (START, ASSISTANT):
        return ()
    return (ASSISTANT,) if state == USER else (USER, ASSISTANT)


def end_cost(state: int) -> int:
    return INSERT * len(closing(state))


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product under (min, +)."""
    return np.minimum((a[:, :, None] + b[None]).min(1), FAR)


def stretch(roles: list[int]) -> np.ndarray:
    """Matrix of a stretch of turns."""
    out = np.where(np.eye(4, dtype=bool), 0, FAR)
    for role in roles:
        out = times(out, matrix(role))
    return out


def walk(roles: list[int], enter: int, leave: int | None) -> list[int]:
    """States after each turn on the cheapest way from ``enter`` to ``leave``, or to the
    cheapest end if that is None."""
    costs = [FAR] * 4
    costs[enter] = 0
    back: list[list[int]] = []
    for role in roles:
        m = matrix(role)
        origin = [min(range(4), key=lambda a: (costs[a] + m[a, b], a)) for b in range(4)]
        costs = [min(FAR, costs[origin[b]] + int(m[origin[b], b])) for b in range(4)]
        back.append(origin)
    if leave is None:
        leave = min(range(4), key=lambda b: (costs[b] + end_cost(b), b))
    states = [leave]
    for origin in reversed(back[1:]):
        states.append(origin[states[-1]])
    return states[::-1]


def border_states(parts: list[np.ndarray]) -> list[tuple[int, int]]:
    """(enter, leave) of each part of one conversation, in order."""
    costs = np.array([0, FAR, FAR, FAR])
    forward = [costs]
    for m in parts:
        costs = np.minimum((costs[:, None] + m).min(0), FAR)
        forward.append(costs)
    leave = min(range(4), key=lambda b: (int(costs[b]) + end_cost(b), b))
    out = []
    for m, before in zip(reversed(parts), reversed(forward[:-1])):
        enter = min(range(4), key=lambda a: (int(before[a]) + int(m[a, leave]), a))
        out.append((enter, leave))
        leave = enter
    return out[::-1]


@dataclass(frozen=True)
class Template:
    """What is written around a turn."""

    opening: str = "<|{role}|>\n"
    closing: str = "<|end|>\n"
    joint: str = "\n"

    def empty(self, states: tuple[int, ...]) -> str:
        return "".join(self.opening.format(role=ROLES[s - 1]) + self.closing for s in states)

    def piece(self, text: str, enter: int, merged: bool, path: tuple[int, ...], to: int) -> str:
        """A turn, behind the end of the one before it."""
        text = text.replace("<|", "< |")
        if merged:
            return self.joint + text
        end = self.closing if enter != START else ""
        return end + self.empty(path) + self.opening.format(role=ROLES[to - 1]) + text


ROWS = (
    "conv_id {conv}, turn {turn}, role string, final_role string, merged boolean, "
    "inserted_before int, inserted_after int, cost int, position long, rendered string"
)
BORDERS = "part int, conv_id {conv}, first boolean, last boolean, cells array<long>"


def _sorted(table: pa.Table) -> pa.Table:
    # Within a part as between parts: nulls first.
    return table.sort_by("position")


def _segments(ids: pa.ChunkedArray) -> list[tuple[int, int]]:
    """Rows of each conversation of a sorted part."""
    codes = ids.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
    return list(zip(cuts, cuts[1:]))


def _border_rows(table: pa.Table) -> pa.Table:
    table = _sorted(table)
    found = _segments(table["conv_id"])
    roles = [role_code(r) for r in table["role"].to_pylist()]
    ends = sorted({0, len(found) - 1})
    cells = [stretch(roles[slice(*found[k])]).ravel().tolist() for k in ends]
    at = pa.array([found[k][0] for k in ends])
    return pa.table(
        {
            "part": table["part"].take(at),
            "conv_id": table["conv_id"].take(at),
            "first": [k == 0 for k in ends],
            "last": [k == len(found) - 1 for k in ends],
            "cells": pa.array(cells, pa.list_(pa.int64())),
        }
    )


def _repair(states: dict[tuple[int, bool], tuple[int, int, bool]], template: Template):
    """``states``: (part, is the part's last segment) -> (enter, leave, ends here)."""

    def run(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        part = table["part"][0].as_py()
        given = table["role"].to_pylist()
        texts = table["text"].to_pylist()
        columns: dict[str, list] = {
            n: [] for n in ("final_role", "merged", "before", "after", "cost", "rendered")
        }
        found = _segments(table["conv_id"])
        for k, (low, high) in enumerate(found):
            enter, leave, ends = START, None, True
            if k == len(found) - 1 and (part, True) in states:
                enter, leave, ends = states[part, True]
            elif k == 0 and (part, False) in states:
                enter, leave, ends = states[part, False]
            roles = [role_code(r) for r in given[low:high]]
            after = walk(roles, enter, leave)
            state = enter
            for row, role, to in zip(range(low, high), roles, after):
                cost, merged, path = move(role, state, to)
                piece = template.piece(texts[row] or "", state, merged, path, to)
                tail: tuple[int, ...] = ()
                if ends and row == high - 1:
                    tail = closing(to)
                    piece += template.closing + template.empty(tail)
                    cost += INSERT * len(tail)
                columns["final_role"].append(ROLES[to - 1])
                columns["merged"].append(merged)
                columns["before"].append(len(path))
                columns["after"].append(len(tail))
                columns["cost"].append(cost)
                columns["rendered"].append(piece)
                state = to
        return pa.table(
            {
                "conv_id": table["conv_id"],
                "turn": table["turn"],
                "role": table["role"],
                "final_role": pa.array(columns["final_role"], pa.string()),
                "merged": pa.array(columns["merged"], pa.bool_()),
                "inserted_before": pa.array(columns["before"], pa.int32()),
                "inserted_after": pa.array(columns["after"], pa.int32()),
                "cost": pa.array(columns["cost"], pa.int32()),
                "position": table["position"],
                "rendered": pa.array(columns["rendered"], pa.string()),
            }
        )

    return run


def _crossing(rows: list) -> dict[tuple[int, bool], tuple[int, int, bool]]:
    """Border states of the conversations that lie in several parts."""
    pieces: dict[object, list] = {}
    for r in sorted(rows, key=lambda r: (r["part"], r["last"], not r["first"])):
        pieces.setdefault(r["conv_id"], []).append(r)
    out = {}
    for found in pieces.values():
        if len(found) > 1:
            states = border_states([np.array(r["cells"]).reshape(4, 4) for r in found])
            for r, (enter, leave) in zip(found, states):
                out[r["part"], r["last"]] = (enter, leave, r is found[-1])
    return out


def repair(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    template: Template | None = None,
) -> DataFrame:
    """One row per turn; ``position`` orders the rows of a conversation."""
    read = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"),
        F.col(text_col).alias("text"),
    )
    order = ["conv_id", "turn", "role", "text"]
    rows = stage_table(
        read.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("position", F.monotonically_increasing_id()),
        "conversation-parts",
    )
    kinds = {"conv": rows.schema["conv_id"].dataType.simpleString(),
             "turn": rows.schema["turn"].dataType.simpleString()}
    # Two rows of sixteen numbers per part at most.
    borders = (
        rows.select("part", "position", "conv_id", "role")
        .groupBy("part")
        .applyInArrow(_border_rows, BORDERS.format(**kinds))
        .collect()
    )
    run = _repair(_crossing(borders), template or Template())
    return rows.groupBy("part").applyInArrow(run, ROWS.format(**kinds))
