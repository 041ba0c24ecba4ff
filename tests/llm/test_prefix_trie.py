import hashlib
import random
import zlib
from collections import Counter, defaultdict

from textsignal.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode(), role or "", text or ""))
    own = {c: [x[4:] for x in sorted(v, key=lambda x: x[:4])] for c, v in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100 if c >= 0 else c + -c % 100, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, out = {}, {}, []
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[x] for x in children[path]) if children[path] else 1
        chars = len(path[-1][1]) if path else 0
        saved[path] = (len(members[path]) - 1) * chars + sum(saved[x] for x in children[path])
        ends = ",".join(str(c) for c in members[path] if len(whole[c]) == len(path))
        parent = members[path[:-1]][0] if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((members[path][0], len(path), parent, len(members[path]), len(children[path]), leaves[path], saved[path], digest))
    return Counter(out)


def check(make, rows):
    found = Counter(map(tuple, P.prefix_trie(make(rows, SCHEMA)).collect()))
    assert found == brute(rows)
    return found


def test_shared_beginnings_against_brute_force(make, monkeypatch):
    monkeypatch.setattr(P, "SHARD_CONVERSATIONS", 16)  # several shards meet the same nodes
    rnd = random.Random(5)
    rows = [(c, t, "user" if t % 2 else "system", rnd.choice(["a", "bb", "ccc"])) for c in range(-150, 320) for t in range(rnd.randrange(1, 7))]
    check(make, rows)


def test_hot_beginning_and_long_conversation(make, monkeypatch):
    monkeypatch.setattr(P, "SHARD_CONVERSATIONS", 32)
    rows = [(c, t, "user", "same") for c in range(300) for t in range(3)] + [(7, t, "user", f"{t}") for t in range(3, 1500)]
    check(make, rows)


def test_edges(make):
    rows = [(None, 0, "user", "no id"), (1, None, None, None), (1, None, "a", None), (1, 2, "u", "x" * 100_000), (1, 2, "u", "tie")]
    rows += [(2, 1, "u", "twice"), (2, 1, "u", "twice"), (3, 1, "ab", "c"), (4, 1, "a", "bc"), (100, 0, "", ""), (100, 1, "é", "ü…")]
    rows += [(150, 0, "u", "x"), (-1, 0, "u", "x"), (-250, 3, "u", "x")]
    check(make, rows)
    turnless = next(c for c in range(5001, 6000) if zlib.crc32(str(c).encode()) % 6 > 0 and c % 100)
    assert sum(check(make, [(turnless, 0, "u", "gone")]).values()) == 1  # its only turn is replaced by an absent beginning


def test_empty_table_and_other_columns(make):
    assert P.prefix_trie(make([], SCHEMA)).collect() == []
    wide = make([(100, 0, "u", "x", 1, "p")], SCHEMA + ", place long, node string")
    assert P.prefix_trie(wide).count() == 2


def test_given_conversations(spark, make):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text")
    check(make, [tuple(r) for r in df.collect()])
