"""Minimum-cost role repair of chats.

A legal chat is an optional system turn, then user and assistant turns in alternation from a user turn to an assistant
turn. A dynamic program over this automaton chooses for every turn to keep it, to relabel it, or to merge it into the
turn before, and where to insert an empty turn; the total cost is the least possible. The repaired turns are then
rendered.

The costs of a run of turns are a small matrix from automaton state to state, and such matrices multiply by (min, +).
So turns are range-partitioned and sorted by conversation and turn, every partition sums up its part of a conversation,
parts are chained, and each partition traces its own best path. One long conversation is spread over tasks.

Defined results: a null or unknown role has the relabelling cost into any role; a null text is the empty text; turns
with a null number come last; equal turn numbers go by role, then text; repeated rows are separate turns; a null
conversation id is a conversation. A conversation always has at least one row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelot.llm.common import saved, ship_package

ROLES = ["system", "user", "assistant"]
#: The role of the last turn so far; ``start`` is none.
STATES = ["start", *ROLES]
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
MERGE, RELABEL, INSERT = 1.0, 2.0, 3.0
NEVER = 1e18
#: Which roles may follow a state, and whether a turn has to be inserted between.
FOLLOWS = {
    _START: {_SYSTEM: None, _USER: None, _ASSISTANT: _USER},
    _SYSTEM: {_USER: None, _ASSISTANT: _USER},
    _USER: {_ASSISTANT: None, _USER: _ASSISTANT},
    _ASSISTANT: {_USER: None, _ASSISTANT: _USER},
}


def moves(role: int) -> list[tuple[int, int, float, str, int]]:
    """(state, next state, cost, action, inserted role or -1) for one turn; ``role`` is -1 where it is unknown."""
    found = []
    for state, following in FOLLOWS.items():
        for target, inserted in following.items():
            same = target + 0 == role
            cost = (0.0 if same else RELABEL) + (INSERT if inserted is not None else 0.0)
            found.append((state, target, cost, "keep" if same else "relabel", -1 if inserted is None else inserted))
        if state != _START:
            # A merge changes nothing but the border where the roles agree, else it also relabels.
            found.append((state, state, MERGE + (0.0 if state == role else RELABEL), "merge", -1))
    return sorted(found, key=lambda m: (m[0], m[1], m[2], m[3]))


MOVES = {role: moves(role) for role in (-1, _SYSTEM, _USER, _ASSISTANT)}
#: Closing a chat: an assistant turn ends it, a user turn needs an empty answer, anything else a whole empty exchange.
CLOSING = {_START: 2 * INSERT, _SYSTEM: 2 * INSERT, _USER: INSERT, _ASSISTANT: 0.0}


def role_numbers(roles: pd.Series) -> np.ndarray:
    return roles.str.strip().str.lower().map({r: i + 1 for i, r in enumerate(ROLES)}).fillna(-1).astype(int).to_numpy()


def _matrix(role: int) -> np.ndarray:
    out = np.full((4, 4), NEVER)
    for state, target, cost, _, _ in MOVES[role]:
        out[state, target] = min(out[state, target], cost)
    return out


MATRICES = {role: _matrix(role) for role in MOVES}


def step(costs: np.ndarray, role: int) -> np.ndarray:
    """Costs (entry state by state) after one more turn: the (min, +) product."""
    return (costs[:, :, None] + MATRICES[role]).min(axis=1)


def trace(roles: list[int], entry: int, leave: int) -> list[tuple[int, str, int]]:
    """(state after, action, inserted role) of every turn on the best path from ``entry`` to ``leave``.

    Of equal paths the first move in the order of :func:`moves` is taken, seen from the end.
    """
    costs, back = [NEVER] * 4, []
    costs[entry] = 0.0
    for role in roles:
        out, chosen = [NEVER] * 4, [0] * 4
        for n, (state, target, cost, _, _) in enumerate(MOVES[role]):
            if costs[state] + cost < out[target]:
                out[target], chosen[target] = costs[state] + cost, n
        costs = out
        back.append(chosen)
    path, at = [], leave
    for role, chosen in zip(reversed(roles), reversed(back), strict=True):
        state, target, _, action, inserted = MOVES[role][chosen[at]]
        path.append((target, action, inserted))
        at = state
    return path[::-1]


def _summaries(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The cost matrix of each part of a conversation; only roles are read, batch by batch."""
    key, matrix = None, np.zeros((4, 4))
    unit = np.where(np.eye(4, dtype=bool), 0.0, NEVER)

    def out() -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "seq": [key[1]], "costs": [matrix.ravel().tolist()]})

    for frame in frames:
        for part, seq, role in zip(frame["part"], frame["seq"], role_numbers(frame["role"]), strict=True):
            if (part, seq) != key:
                if key is not None:
                    yield out()
                key, matrix = (part, seq), unit
            matrix = step(matrix, role)
    if key is not None:
        yield out()


def _chained(parts: list[int], costs: list) -> tuple[list[int], list[int], float]:
    """Entry and exit state of each part of one conversation, and the least cost of the whole."""
    matrices = [np.array(c, float).reshape(4, 4) for c in costs]
    now, before = np.array([0.0, NEVER, NEVER, NEVER]), []
    for m in matrices:
        before.append(now)
        now = (now[:, None] + m).min(axis=0)
    ends = now + np.array([CLOSING[s] for s in range(4)])
    at = int(ends.argmin())
    entries, leaves = [], []
    for m, c in zip(matrices[::-1], before[::-1], strict=True):
        leaves.append(at)
        at = int((c + m[:, at]).argmin())
        entries.append(at)
    return entries[::-1], leaves[::-1], float(ends.min())


CHAINED = "part int, seq string, entry int, leave int, last boolean, cost double"


def _chains(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parts of whole conversations in order; a conversation has a row of a few numbers for each part."""
    key, parts, costs, out = None, [], [], []

    def flush() -> None:
        if parts:
            entries, leaves, least = _chained(parts, costs)
            lasts = [False] * (len(parts) - 1) + [True]
            out.extend(zip(parts, [key] * len(parts), entries, leaves, lasts, [least] * len(parts), strict=True))
            parts.clear()
            costs.clear()

    names = [c.split(" ")[0] for c in CHAINED.split(", ")]
    for frame in frames:
        for part, seq, cost in zip(frame["part"], frame["seq"], frame["costs"], strict=True):
            if seq != key:
                flush()
                key = seq
            parts.append(part)
            costs.append(cost)
        yield pd.DataFrame(out, columns=names)
        out.clear()
    flush()
    yield pd.DataFrame(out, columns=names)


OPEN, CLOSE = "<|{}|>\n", "\n<|end|>\n"
RENDERED = "part int, seq string, inner long, turn long, action string, role string, fragment string"
#: Rows given on at once.
ROWS_OUT = 2048


def _fragments(rows: list[tuple], entry: int, leave: int, last: bool) -> Iterator[tuple]:
    """(turn, action, role, fragment) of one part: its turns and the inserted ones."""
    out, state = [], entry

    def add(turn, action, role, text):
        closing = CLOSE if action != "merge" and (out or entry != _START) else ""
        out.append((turn, action, STATES[role], closing + (OPEN.format(STATES[role]) if action != "merge" else "\n") + text))

    for (turn, _, text), (state, action, inserted) in zip(rows, trace([r for _, r, _ in rows], entry, leave), strict=True):
        if inserted >= 0:
            add(None, "insert", inserted, "")
        add(turn, action, state, text)
    if last:
        for role in {_START: (_USER, _ASSISTANT), _SYSTEM: (_USER, _ASSISTANT), _USER: (_ASSISTANT,)}.get(state, ()):
            add(None, "insert", role, "")
        out[-1] = (*out[-1][:3], out[-1][3] + CLOSE)
    return iter(out)


def _rendered(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Original and inserted turns with their repaired role and the fragment they add to the rendered chat."""
    key, held, out = None, [], []

    def flush() -> None:
        if held:
            part, seq, *ends = key
            out.extend((part, seq, i, *row) for i, row in enumerate(_fragments(held, *ends)))
            held.clear()

    def given() -> pd.DataFrame:
        frame = pd.DataFrame(out, columns=[c.split(" ")[0] for c in RENDERED.split(", ")])
        out.clear()
        return frame.astype({"turn": "Int64"})

    for frame in frames:
        turns = [None if pd.isna(t) else int(t) for t in frame["turn"]]
        keys = zip(frame["part"], frame["seq"], frame["entry"], frame["leave"], frame["last"], strict=True)
        for mark, turn, role, text in zip(keys, turns, role_numbers(frame["role"]).tolist(), frame["text"], strict=True):
            if mark != key:
                flush()
                key = mark
                if len(out) >= ROWS_OUT:
                    yield given()
            held.append((turn, role, text))
    flush()
    yield given()


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           parts: int | None = None) -> DataFrame:
    """``(conv_id, place, turn, action, role, fragment, cost)``: the repaired chat as rows.

    ``place`` numbers the rows of a conversation from 0. ``action`` is keep, relabel, merge (the row goes on with the
    repaired turn before it) or insert (``turn`` is null). The fragments of a conversation, joined in this order,
    are its rendered text. ``cost`` is the whole conversation's.
    """
    spark = turns.sparkSession
    ship_package(spark)
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.col(role).cast("string").alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text")]
    # The row number keeps repeated rows apart, so that no range has to hold them all.
    rows = rows.withColumn("seq", F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))).withColumn(
        "nth", F.monotonically_increasing_id())
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartitionByRange(n, *order, "nth").withColumn("part", F.spark_partition_id())
    stored = saved(sorted_rows, "chat-turns")
    inside = lambda df: df.repartition(n, "part").sortWithinPartitions("part", *order, "nth")
    summaries = inside(stored.drop("text").withColumn("text", F.lit(""))).select("part", "seq", "role").mapInPandas(
        _summaries, "part int, seq string, costs array<double>")
    together = summaries.repartition(n, "seq").sortWithinPartitions("seq", "part")
    ends = saved(together.mapInPandas(_chains, CHAINED), "chat-ends")
    framed = inside(stored.join(ends.drop("cost"), ["part", "seq"]))
    shown = saved(framed.select("part", "seq", "turn", "role", "text", "entry", "leave", "last").mapInPandas(
        _rendered, RENDERED), "chat-rows")
    before = Window.partitionBy("seq").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = shown.groupBy("seq", "part").agg(F.count("*").alias("n")).withColumn(
        "moved", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return shown.join(moved.join(ends.select("seq", "part", "cost"), ["seq", "part"]), ["seq", "part"]).select(
        F.when(F.col("seq") != "none", F.col("seq")).cast("long").alias("conv_id"),
        (F.col("inner") + F.col("moved")).alias("place"), "turn", "action", "role", "fragment", "cost")
