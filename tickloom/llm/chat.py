"""Chat formatting: the cheapest repair of each conversation's roles, by dynamic programming over legal turns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.plans.scratch import stored

#: The roles; a legal conversation is an optional system turn, then user and assistant in turn.
ROLES = ("system", "user", "assistant")
#: Places of the automaton: before the first turn, and after a turn of each role.
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs: joining a turn to the one before, another role, an unknown or missing role, an empty turn put in.
MERGE, RELABEL, UNKNOWN, INSERT = 1.0, 3.0, 1.0, 2.0
#: Rows of a chunk that is solved in one piece.
CHUNK = 5_000
MARKS = {"system": "<|system|>\n", "user": "<|user|>\n", "assistant": "<|assistant|>\n"}
END = "<|end|>\n"


def choices(role: int) -> list[tuple[int, int, float, str, int]]:
    """(place before, place after, cost, action, role put in before or 0) for a turn of ``role`` (0: unknown).

    Cheaper and simpler choices come first, which settles ties.
    """
    out = []
    for before in range(4):
        for after in (SYSTEM, USER, ASSISTANT):
            change = 0.0 if role == after else (RELABEL if role else UNKNOWN)
            name = "keep" if role == after else "relabel"
            if after in LEGAL[before]:
                out.append((before, after, change, name, 0))
            else:
                for put in LEGAL[before]:
                    if after in LEGAL[put]:
                        out.append((before, after, change + INSERT, name, put))
            if before == after:
                out.append((before, after, change + MERGE, "merge", 0))
    return sorted(out, key=lambda c: (c[2], c[4], c[3], c[0], c[1]))


CHOICES = [choices(r) for r in range(4)]
_STEPS = np.full((4, 4, 4), np.inf)
for _r, _list in enumerate(CHOICES):
    for _b, _a, _c, _n, _p in _list:
        _STEPS[_r, _b, _a] = min(_STEPS[_r, _b, _a], _c)


def summary(roles: list[int]) -> np.ndarray:
    """Least cost from each place to each place over a run of turns."""
    total = np.full((4, 4), np.inf)
    np.fill_diagonal(total, 0.0)
    for r in roles:
        total = (total[:, :, None] + _STEPS[r][None, :, :]).min(axis=1)
    return total


def repair(roles: list[int], start: int = START, end: int | None = None) -> list[tuple[int, int, float, str, int]]:
    """The choice for each turn on the cheapest path from ``start`` to ``end``, or to the cheapest end."""
    costs = np.full(4, np.inf)
    costs[start] = 0.0
    back: list[list[tuple | None]] = []
    for r in roles:
        new, best = np.full(4, np.inf), [None] * 4
        for c in CHOICES[r]:
            if costs[c[0]] + c[2] < new[c[1]]:
                new[c[1]], best[c[1]] = costs[c[0]] + c[2], c
        costs = new
        back.append(best)
    at = int(costs.argmin()) if end is None else end
    out = []
    for best in reversed(back):
        out.append(best[at])
        at = best[at][0]
    return out[::-1]


def role_codes(roles) -> list[int]:
    names = {n: i + 1 for i, n in enumerate(ROLES)}
    return [names.get(r.strip().lower(), 0) if isinstance(r, str) else 0 for r in roles]


def boundaries(matrices: list[np.ndarray]) -> list[int]:
    """The place at the end of each chunk of a conversation on its cheapest path."""
    costs, back = np.array([0.0, np.inf, np.inf, np.inf]), []
    for m in matrices:
        step = costs[:, None] + m
        back.append(step.argmin(axis=0))
        costs = step.min(axis=0)
    at, ends = int(costs.argmin()), []
    for b in reversed(back):
        ends.append(at)
        at = int(b[at])
    return ends[::-1]


def chunked(turns: DataFrame, chunk: int) -> DataFrame:
    """Rows in order, each with its task, its chunk in the task and its place there.

    Rows are dealt by ranges of (conversation, turn), so a long conversation is spread over tasks.
    """
    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), 0
        for frame in frames:
            place = seen + np.arange(len(frame))
            seen += len(frame)
            yield frame.assign(task=task, chunk=place // chunk, place=place)

    order = ["conv_id", "turn", "role", "text", "tie"]
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
    kinds = "conv_id string, turn string, role string, text string, tie bigint, task int, chunk bigint, place bigint"
    ready = dealt.sortWithinPartitions(*order).select(
        F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role", "text", "tie")
    return ready.mapInPandas(number, kinds)


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """conv_id, turn, ordinal, role, new_role, action, inserted, cost, rendered of every row.

    A conversation is repaired to an optional system turn and then user and assistant in turn, at least
    cost: a turn is kept, relabelled, or merged into the one before, and an empty turn of role ``inserted`` may
    come before it. The ``rendered`` texts of a conversation, joined in the order of ``ordinal``, are the
    formatted chat; its last row closes it. Costs of chunks are min-plus matrices, so a conversation of any
    length is cut: only the matrices of those that span chunks meet.

    Turns go by turn number, then role and text; equal rows are turns of their own; a null turn comes first; rows
    with a null conversation are one conversation; an unknown or null role is relabelled at lower cost; a null
    text is empty; other columns are not read; no rows give no rows.
    """
    kind = {c: turns.schema[n].dataType.simpleString() for c, n in (("conv_id", conv_col), ("turn", turn_col))}
    rows = stored(chunked(turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")), chunk))

    def summarize(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        group = group.sort_values("place")
        key = group["conv_id"].where(group["conv_id"].notna(), None)
        run = (key.ne(key.shift()) & ~(key.isna() & key.shift().isna())).cumsum()
        for _, part in group.groupby(run.to_numpy(), sort=False):
            out.append((part["conv_id"].iloc[0], int(part["task"].iloc[0]), int(part["chunk"].iloc[0]), len(part),
                        summary(role_codes(part["role"])).ravel().tolist()))
        return pd.DataFrame(out, columns=["conv_id", "task", "chunk", "n", "matrix"])

    edges = rows.groupBy("task", "chunk").agg(F.min_by("conv_id", "place").alias("first"), F.max_by("conv_id", "place").alias("last"))
    ends = edges.select(F.col("first").alias("conv_id"), "task", "chunk").union(edges.select("last", "task", "chunk")).distinct()
    spread = ends.groupBy("conv_id").count().where("count > 1").select(F.col("conv_id").alias("long_id"))
    cut = rows.select("conv_id", "task", "chunk", "place", "role").join(
        spread, F.col("conv_id").eqNullSafe(F.col("long_id")), "left_semi")
    fragments = cut.groupBy("task", "chunk").applyInPandas(
        summarize, "conv_id string, task int, chunk bigint, n bigint, matrix array<double>")

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["task", "chunk"])
        matrices = [np.array(m).reshape(4, 4) for m in group["matrix"]]
        ends_ = boundaries(matrices)
        before = np.r_[0, np.cumsum(group["n"].to_numpy())[:-1]]
        last = np.arange(len(group)) == len(group) - 1
        return group[["conv_id", "task", "chunk"]].assign(
            base=before, enter=[START, *ends_[:-1]], leave=ends_, last=last)

    solved = stored(fragments.groupBy("conv_id").applyInPandas(
        solve, "conv_id string, task int, chunk bigint, base bigint, enter int, leave int, last boolean"))
    joined = rows.join(
        solved.withColumnsRenamed({"conv_id": "f_conv", "task": "f_task", "chunk": "f_chunk"}),
        (F.col("task") == F.col("f_task")) & (F.col("chunk") == F.col("f_chunk"))
        & F.col("conv_id").eqNullSafe(F.col("f_conv")), "left")

    def render(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place").reset_index(drop=True)
        key = group["conv_id"].where(group["conv_id"].notna(), None)
        run = (key.ne(key.shift()) & ~(key.isna() & key.shift().isna())).cumsum().to_numpy()
        out = []
        for _, part in group.groupby(run, sort=False):
            alone = pd.isna(part["enter"].iloc[0])
            base = 0 if alone else int(part["base"].iloc[0])
            enter, leave = (START, None) if alone else (int(part["enter"].iloc[0]), int(part["leave"].iloc[0]))
            closes = True if alone else bool(part["last"].iloc[0])
            chosen = repair(role_codes(part["role"]), enter, leave)
            for i, (r, c) in enumerate(zip(part.itertuples(index=False), chosen, strict=True)):
                new, put = ROLES[c[1] - 1], ROLES[c[4] - 1] if c[4] else None
                head = "" if c[3] == "merge" else (MARKS[put] + "\n" if put else "") + MARKS[new]
                tail = END if closes and i == len(part) - 1 else ""
                out.append((r.conv_id, r.turn, base + i, r.role, new, c[3], put, c[2], f"{head}{r.text}\n{tail}"))
        return pd.DataFrame(out, columns=["conv_id", "turn", "ordinal", "role", "new_role", "action", "inserted", "cost", "rendered"])

    done = joined.groupBy("task", "chunk").applyInPandas(
        render, "conv_id string, turn string, ordinal bigint, role string, new_role string, action string, "
                "inserted string, cost double, rendered string")
    return done.withColumns({c: F.col(c).cast(k) for c, k in kind.items()})
