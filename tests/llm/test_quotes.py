import hashlib
import random
import re

from pyspark.sql import functions as F

from textsignal.llm.q_quotes import op8
from textsignal.llm.quotes import link_quotes, links, own_text, parsed
from textsignal.llm.registry import Source

SCHEMA = "conv_id long, turn long, role string, text string"


def norm(s):
    return re.sub(r"[\W_]+", " ", s.lower()).strip()


def brute(messages):
    """reply_to, levels, quotes, links and body of each (conv, turn), one message each."""
    own, runs = {}, {}
    for conv, turn, text in messages:
        found, body, last = [], [], None
        quotes = any(re.match(r"[ \t]*>", x) for x in text.split("\n"))
        for x in text.split("\n"):
            m = re.match(r"(?:[ \t]*>)+", x)
            level = m[0].count(">") if m else 0
            content = re.sub(r"^(?:[ \t]*>)+[ \t]?", "", x)
            if not level:
                if not re.match(r"^\s*On .{1,200} wrote:\s*$", x):
                    body.append(x)
            elif level == last:
                found[-1][1].append(content)
            else:
                found.append((level, [content]))
            last = level or None
        own[conv, turn] = "\n".join(body).strip("\n") if quotes else text
        runs[conv, turn] = found
    said = {}
    for (conv, turn), body in own.items():
        for part in [body, *re.split(r"\n\s*\n", body), *body.split("\n")]:
            if norm(part):
                said.setdefault(norm(part), []).append((conv, turn))
    out = {}
    for (conv, turn), found in runs.items():
        linked, near = 0, []
        for level, lines in found:
            here = far = None
            for part in ["\n".join(lines), *lines]:
                places = said.get(norm(part), []) if norm(part) else []
                if here is None:
                    here = min((t for c, t in places if c == conv and t < turn), default=None) if min(
                        (t for c, t in places if c == conv), default=turn) < turn else None
                if far is None and places and min(places)[0] != conv:
                    far = min(places)
            linked += here is not None or far is not None
            if here is not None:
                near.append((-level, here))
        out[conv, turn] = (own[conv, turn], max((x for x, _ in found), default=0), len(found), linked, max(near)[1] if near else None)
    return out


def test_replies_against_brute_force(make):
    rng = random.Random(9)
    words = "alpha beta gamma delta omega kappa".split()
    messages = []
    for conv in range(12):
        texts = []
        for turn in range(9):
            body = [" ".join(rng.choices(words, k=rng.randint(1, 3))) + rng.choice([".", "!", ""]) for _ in range(rng.randint(1, 3))]
            head = []
            if texts and rng.random() < 0.8:
                quoted = rng.choice(texts).split("\n")
                head = ["On Monday A wrote:"] * rng.randint(0, 1) + [">" + " " * rng.randint(0, 1) + x for x in quoted]
            texts.append("\n".join(head + body))
            messages.append((conv, turn, texts[-1]))
    want = brute(messages)
    got = link_quotes(make([(c, t, "r", x) for c, t, x in messages], SCHEMA)).collect()
    assert len(got) == len(messages)
    replies = {}
    for r in got:
        assert (r.body, r.quote_levels, r.n_quotes, r.n_linked, r.reply_to) == want[r.conv_id, r.turn], r
        replies[r.conv_id, r.turn] = r.reply_to
    for r in got:
        at, depth = r.turn, 0
        while replies[r.conv_id, at] is not None:
            at, depth = replies[r.conv_id, at], depth + 1
        assert (r.thread, r.depth) == (at, depth)
    assert any(r.depth > 2 for r in got)


def test_edges(make):
    rows = [
        (1, 0, "u", "Hello there.\nHow are you?"), (1, 1, "a", "> hello  THERE\n\nFine."), (1, 1, "a", "> hello  THERE\n\nFine."),
        (1, 1, "a", "another text at the turn"), (1, 2, "u", None), (1, 3, "u", ""), (None, 4, "u", "> Fine."), (1, None, "u", "> Fine."),
        (2, 0, "u", ">" * 5000 + " deep\n" + "> \n>"), (2, 1, "u", "line\n" * 20_000), (2, 2, None, "> line\n" * 3000),
    ]
    got = link_quotes(make(rows, SCHEMA).withColumn("DEPTH", F.lit("mine"))).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn, r.text): r for r in got}
    assert by[rows[1][0], 1, rows[1][3]].reply_to == 0 and by[1, 1, rows[3][3]].reply_to is None
    assert by[1, 2, None].body is None and by[1, 3, ""].body == "" and by[2, 0, rows[8][3]].quote_levels == 5000
    assert by[2, 2, rows[10][3]].reply_to == 1
    assert link_quotes(make([], SCHEMA)).count() == 0


def test_whole_table_keeps_every_message(spark):
    sf = "/root/testdata/sf0.01"
    got = {(r.conv_id, r.turn): r for r in op8(Source(spark, sf)).collect()}
    rows = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    want = brute([(r.conv_id, r.turn, r.text) for r in rows])
    assert len(got) == len(rows)
    for key, (body, levels, quotes, linked, reply_to) in want.items():
        r = got[key]
        assert (r.quote_levels, r.n_quotes, r.n_linked, r.reply_to) == (levels, quotes, linked, reply_to)
        assert r.body_sha256 == hashlib.sha256(body.encode()).hexdigest()


def test_original_elsewhere_although_the_conversation_repeats_it(make):
    line = "A line worth repeating."
    rows = [
        (1, 3, "u", f"> {line}\nIndeed."), (1, 4, "u", line), (9, 1, "u", line), (9, 2, "u", line), (12, 0, "u", line),
        (2, 0, "u", f"> {line}\n{line}"), (7, 0, "u", "> Indeed."), (8, 0, "u", "> said nowhere\nsaid nowhere"),
    ]
    messages = make(rows, SCHEMA)
    got = {(r.conv_id, r.turn): (r.n_quotes, r.n_linked, r.reply_to) for r in link_quotes(messages).collect()}
    assert got[1, 3] == got[2, 0] == got[7, 0] == (1, 1, None) and got[8, 0] == (1, 0, None)
    parts = messages.select("conv_id", "turn", "text", F.xxhash64("text").alias("key"), parsed(F.col("text")).alias("lines"))
    parts = parts.withColumn("body", own_text(F.col("text"), F.col("lines")))
    found = links(parts, parts.filter(F.col("text").contains(">"))).collect()
    assert {(r.conv_id, r.turn): (r.to_conv, r.to_turn) for r in found} == {
        (1, 3): (2, 0), (2, 0): (1, 4), (7, 0): (1, 3), (8, 0): (None, None)
    }
