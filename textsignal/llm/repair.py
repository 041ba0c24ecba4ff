"""Conversation structure repair: the cheapest edits that make roles alternate, by depth-first branch-and-bound."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

# The roles a conversation goes through: an optional system turn, then user and assistant in turns, ending on an
# assistant.  A state is what came last.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
OTHER = (USER, USER, ASSISTANT, USER)  # the state after a turn that is given the role due
CLOSED = (START, ASSISTANT)
NAMES = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

FINE, BLANK, DUPLICATE, CUT = range(4)  # first fault of a row
SPACES = " \t\n\x0b\x0c\r"
RESULTS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

Turns = list[tuple[str, int]]  # initial of the role, first fault


def moves(turn: tuple[str, int] | None, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(letter, rows used, next state, cost) of every edit at a row, letters in ASCII order."""
    if turn is not None:
        yield "D", 1, state, DELETE
    yield "I", 0, OTHER[state], INSERT
    if turn is not None and turn[1] in (FINE, CUT):
        extra = TRUNCATED if turn[1] == CUT else 0
        if (kept := AFTER.get(turn[0], {}).get(state)) is not None:
            yield "K", 1, kept, extra
        yield "R", 1, OTHER[state], REROLE + extra


def suffix_bounds(turns: Turns) -> list[list[int]]:
    """For each row and state the least cost of the rows from there on, if a conversation might end anywhere.

    Leaving the closing rule out never makes edits dearer, so no completion costs less than its bound.
    """
    bounds = [[0] * 4]
    for turn in reversed(turns):
        after = bounds[-1]
        here = [min(cost + after[to] for _, used, to, cost in moves(turn, state) if used) for state in range(4)]
        # One or two inserted turns may come first; more only repeat a state.
        for _ in range(2):
            here = [min(here[s], INSERT + here[OTHER[s]]) for s in range(4)]
        bounds.append(here)
    return bounds[::-1]


def _dive(turns: Turns, bounds: list[list[int]]) -> tuple[int, str]:
    """A first incumbent: at each row the edit of the least bound."""
    at, state, cost, audit = 0, START, 0, []
    while at < len(turns) or state not in CLOSED:
        turn = turns[at] if at < len(turns) else None
        choices = [(price + bounds[at + used][to], letter, used, to, price) for letter, used, to, price in moves(turn, state)]
        if not audit or audit[-1] != "I" or turn is None:
            best = min(choices)
        else:  # no second insertion in a row before a row is used up, so that the dive ends
            best = min(c for c in choices if c[2])
        _, letter, used, state, price = best
        at, cost = at + used, cost + price
        audit.append(letter)
    return cost, "".join(audit)


def cheapest(turns: Turns) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits of a conversation; of equally cheap ones the ASCII-least letters.

    Branches are taken depth-first from an explicit stack, letters in ASCII order.  A branch is cut if its cost and the
    suffix's lower bound exceed the incumbent, or if its node (rows used, last role) was met before at no higher
    cost: letters met earlier are ASCII-less, and edits of one cost that use as many rows are never each other's
    beginning, so equal cost is dominated too.  When the stack is empty the incumbent is proved to be the least.
    The bounds miss the closing rule only, so few costs per node are ever tried: steps grow with the rows.
    """
    bounds = suffix_bounds(turns)
    incumbent = _dive(turns, bounds)
    best = [[1 << 60] * 4 for _ in range(len(turns) + 1)]  # dominance tables, one per row
    path: list[str] = []
    stack = [(0, 0, START, 0, "")]
    while stack:
        depth, at, state, cost, letter = stack.pop()
        if cost + bounds[at][state] > incumbent[0] or cost >= best[at][state]:
            continue
        best[at][state] = cost
        del path[depth:]
        path.append(letter)
        done = at == len(turns)
        if done and state in CLOSED:
            incumbent = min(incumbent, (cost, "".join(path)))
        branches = [
            (depth + 1, at + used, to, cost + price, edit) for edit, used, to, price in moves(None if done else turns[at], state)
        ]
        stack.extend(reversed(branches))
    return incumbent


def apply_edits(roles: list[str], audit: str) -> list[tuple[str, int | None]]:
    """(role, row or None for an inserted turn) after the edits; the letters leave one role to each turn."""
    out, at, state = [], 0, START
    for letter in audit:
        if letter == "K":
            state = AFTER[roles[at][0]][state]
            out.append((roles[at], at))
        elif letter in "RI":
            state = OTHER[state]
            out.append((NAMES[state], at if letter == "R" else None))
        at += letter != "I"
    return out


class Conversation:
    """One conversation as its rows pass by in order."""

    def __init__(self):
        self.turns: Turns = []
        self.rows: list[tuple[str, str]] = []
        self.seen: set[tuple[str, str]] = set()
        self.numbers: set[int] = set()
        self.faults = [0] * 4

    def add(self, turn: int | None, role: str, text: str) -> None:
        shown = text.strip(SPACES)
        fault = BLANK if not shown else DUPLICATE if (role, text) in self.seen else CUT if shown[-1] not in ".!?" else FINE
        self.seen.add((role, text))
        self.faults[fault] += 1
        if turn is not None:
            self.numbers.add(turn)
        self.turns.append((role[:1], fault))
        self.rows.append((role, text))

    def result(self) -> tuple:
        initials = [t[0] for t in self.turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(self.numbers) - min(self.numbers) + 1 - len(self.numbers) if self.numbers else 0
        cost, audit = cheapest(self.turns)
        digest = hashlib.sha256()
        for n, (role, row) in enumerate(apply_edits([r for r, _ in self.rows], audit)):
            digest.update(("\n" * (n > 0) + role + ":" + ("" if row is None else self.rows[row][1])).encode())
        return gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT], illegal, cost, audit, digest.hexdigest()


def _repaired(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by conversation, a conversation's mark (no role) first; one conversation is held at a time."""
    open_id, conversation, names = None, None, [c.split()[0] for c in RESULTS.split(", ")]
    for batch in batches:
        out = []
        for conv_id, turn, role, text in zip(
            batch["conv_id"].astype(object), batch["turn"].astype(object), batch["role"], batch["text"], strict=True
        ):
            if role is None:  # the mark
                if conversation is not None:
                    out.append((open_id, *conversation.result()))
                open_id, conversation = None if pd.isna(conv_id) else int(conv_id), Conversation()
            else:
                conversation.add(None if pd.isna(turn) else int(turn), role, text)
        if out:
            yield _frame(out, names)
    if conversation is not None:
        yield _frame([(open_id, *conversation.result())], names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with a fault in a fifth of the rows, by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row, 1 empties its text, 2 removes the marks ``.!?``, 3 repeats it with the same turn, 4 makes it a
    user's.  A null counts as one space, in the key as in role and text; a null ``conv_id`` or ``turn`` stays null in
    its column.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    hurt = rows.filter("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))
    return hurt.drop("copy")


def repair(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text), and of ``every`` if given: faults, edits, digest.

    Rows are taken by turn, nulls first; rows that share a turn by role, then text.  A null role or text is one space.
    First faults are counted: ``blank`` (nothing but spaces), ``duplicate`` (role and text seen earlier in the
    conversation), ``truncated`` (not ending on ``.!?``).  ``gaps`` are turns missing between the least and
    the greatest, ``illegal`` the neighbours whose initials are not su, ua or au (initials are first characters,
    whatever the role; an empty role has none).  ``cost`` and ``audit`` are the least edits of ``cheapest``, and
    ``repaired_sha256`` the digest of the repaired ``role:text`` lines.

    Rows without a ``conv_id`` are one conversation, named null.  A conversation of ``every`` without rows has zeros, an
    empty audit and the digest of the empty string.  Repeated rows are duplicates.  An empty table gives
    an empty table.  Other columns are ignored; only the results are returned.

    One exchange: rows are placed by conversation and sorted there, so a task holds one conversation at a time,
    however many it gets.  A conversation is one sequence, and its audit one value, so its rows stay in one task.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    turns = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), filled("role"), filled("text"))
    ids = lambda df: df.select(F.col("conv_id").cast("long").alias("conv_id"))
    marks = (ids(rows) if every is None else ids(rows).union(ids(every))).distinct()
    blank = F.lit(None).cast("string")
    marked = marks.select("conv_id", F.lit(None).cast("long").alias("turn"), blank.alias("role"), blank.alias("text"))
    order = ["conv_id", F.col("role").isNotNull(), F.col("turn").asc_nulls_first(), "role", "text"]
    placed = turns.unionByName(marked).repartition("conv_id").sortWithinPartitions(*order)
    return placed.mapInPandas(_repaired, RESULTS)
