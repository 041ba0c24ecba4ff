import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from textsignal.llm import repair as R


def every_edit(turns):
    """(cost, audit) of the cheapest by trying all edits with up to two insertions at each place."""
    out = []

    def go(at, roles, cost, audit, inserted):
        if cost > 3 * len(turns) + 4:
            return
        if at == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            out.append((cost, audit))
        if inserted < 2:
            for r in "ua":
                go(at, roles + r, cost + 2, audit + "I", inserted + 1)
        if at < len(turns):
            role, fault = turns[at]
            go(at + 1, roles, cost + 3, audit + "D", 0)
            if fault in (R.FINE, R.CUT):
                extra = int(fault == R.CUT)
                go(at + 1, roles + (role or "?"), cost + extra, audit + "K", 0)
                for r in "ua":
                    go(at + 1, roles + r, cost + 2 + extra, audit + "R", 0)

    go(0, "", 0, "", 0)
    return min(out)


@pytest.mark.parametrize("n", range(5))
def test_search_against_all_edits(n):
    rnd = random.Random(n)
    for _ in range(150 if n < 4 else 30):
        turns = [(rnd.choice(["s", "u", "a", "u", "a", "x", ""]), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
        assert R.cheapest(turns) == every_edit(turns)


def test_bounds_never_exceed_the_cost():
    rnd = random.Random(7)
    for _ in range(300):
        turns = [(rnd.choice("suauaux"), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(rnd.randrange(12))]
        cost, audit = R.cheapest(turns)
        assert R.suffix_bounds(turns)[0][R.START] <= cost <= R._dive(turns, R.suffix_bounds(turns))[0]
        assert len(audit) - audit.count("I") == len(turns)


def test_long_conversations_end():
    rnd = random.Random(3)
    turns = [(("ua"[i % 2] if rnd.random() > 0.1 else rnd.choice("suax")), rnd.choice([0] * 15 + [1, 2, 3])) for i in range(20_000)]
    assert R.cheapest(turns)[0] > 0
    assert R.cheapest([("s", 0)] * 5000)[0] == 9999  # the first goes, the others become user and assistant in turns


def brute(rows):
    """All results from plain rows."""
    hurt, ids = {}, set()
    for c, turn, role, text in rows:
        ids.add(c)
        show = lambda x: " " if x is None else str(x)
        fault = zlib.crc32(f"{show(c)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        hurt.setdefault(c, []).extend([(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1))
    out = []
    for c in ids:
        mine = sorted(hurt.get(c, []), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, turns = set(), []
        for _, role, text in mine:
            blank, end = not re.search(r"[^\x20\x09-\x0D]", text), re.search(r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\Z", text)
            turns.append((role[:1], 1 if blank else 2 if (role, text) in seen else 0 if end[1] in ".!?" else 3))
            seen.add((role, text))
        cost, audit = R.cheapest(turns)
        lines = [
            f"{mine[at][1] if role is None else role}:{'' if at is None else mine[at][2]}"
            for role, at in R.apply_edits([r for _, r, _ in mine], audit)
        ]
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in lines))
        numbers = {t for t, _, _ in mine if t is not None}
        initials = [t[0] for t in turns]
        out.append(
            (
                c,
                max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
                *[sum(f == k for _, f in turns) for k in (1, 2, 3)],
                sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                cost,
                audit,
                hashlib.sha256("\n".join(lines).encode()).hexdigest(),
            )
        )
    return Counter(out)


SCHEMA = "conv_id long, turn long, role string, text string"


def run(df):
    return Counter(map(tuple, R.repair(R.damage(df), df).collect()))


def test_edges_against_brute_force(make):
    rows = [(1, t, ["user", "assistant"][t % 2], f"text {t}.") for t in range(40)]
    rows += [(None, None, None, None), (None, 1, "user", "no id."), (2, None, "user", None), (2, None, "assistant", "x"), (3, 5, "", "")]
    rows += [(4, 1, "system", "s."), (4, 2, "user", "u" * 200_000), (4, 2, "user", "tie."), (4, 2, "assistant", "tie."), (4, 9, "tool", "…")]
    rows += [rows[0], rows[0], (5, -3, "user", "a\n\t"), (5, 3, "system", "\x0b\x0c"), (6, 0, "User", "q?"), (7, 1, "umpire", "ok!")]
    rows += [(i, i % 7, ["user", "assistant", "system"][i % 3], "short." if i % 4 else " ") for i in range(100, 160)]
    assert run(make(rows, SCHEMA)) == brute(rows)


def test_a_conversation_without_rows_left(make):
    gone = next(c for c in range(10_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    found = R.repair(R.damage(make([(gone, 0, "user", "x.")], SCHEMA)), make([(gone, 0, "user", "x.")], SCHEMA)).collect()
    assert [tuple(r) for r in found] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_empty_tables_and_other_columns(make):
    assert R.repair(R.damage(make([], SCHEMA))).collect() == []
    rows = [(1, 0, "user", "a.", "x", 1), (1, 1, "assistant", "b.", "x", 1)]
    wide = make(rows, SCHEMA + ", cost string, audit int")
    assert R.repair(wide).first().audit == "KK"


def test_given_conversations(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert run(df) == brute([tuple(r) for r in df.collect()])
