import re

from pyspark.sql import functions as F

from textsignal.llm.decontaminate import compile_patterns, decontaminate, search, words_of


def brute(text, items, window=10):
    words = words_of(text)
    hit, found = set(), set()
    for item, item_text in items:
        w = words_of(item_text)
        m = min(window, len(w))
        for s in range(len(w) - m + 1 if m else 0):
            for i in range(len(words) - m + 1):
                if words[i : i + m] == w[s : s + m]:
                    hit.update(range(i, i + m))
                    found.add(item)
    return len(words), hit, found


def test_words():
    text = "Ab-c1 ÉÀ_x y ×7\t\n"
    plain = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", plain)
    assert [w.decode() for w in words_of(text)] == want
    assert words_of(None) == words_of("") == words_of("-. !") == []


def test_search_is_brute_force():
    import random

    rng = random.Random(3)
    for _ in range(300):
        items = [(str(i), " ".join(rng.choices("abc", k=rng.randint(0, 14)))) for i in range(4)]
        text = " ".join(rng.choices("abc", k=rng.randint(0, 60)))
        spans, found = search(words_of(text), compile_patterns(items, 5))
        n, hit, want = brute(text, items, 5)
        assert {p for s, e in spans for p in range(s, e)} == hit and found == want


def test_blocks_of_the_benchmark_add_up(spark, make):
    items = [(i, " ".join(f"w{i}x{j}" for j in range(14))) for i in range(8)]
    docs = make([(k, f"start {items[k][1]} mid {items[(k + 3) % 8][1][:40]}", "x") for k in range(8)], "doc_id long, text string, items string")
    bench = make(items, "item_id long, text string")
    one, many = decontaminate(docs, bench), decontaminate(docs, bench, block_words=20)
    assert many.columns == ["doc_id", "text", "n_words", "n_hit", "hit_spans", "items"]
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    assert one.filter("n_hit = 14").count() == 8


def test_a_long_item_is_cut_without_losing_windows(make):
    words = [f"w{j}" for j in range(500)]
    bench = make([(1, " ".join(words)), (2, "short item")], "item_id long, text string")
    texts = [" ".join(words[s : s + 10]) for s in range(491)] + ["x " + " ".join(words) + " y", None, "a short item", "w1 w2 w3"]
    docs = make(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.items) for r in decontaminate(docs, bench, block_words=60).collect()}
    assert got == {r.doc_id: (r.n_hit, r.items) for r in decontaminate(docs, bench).collect()}
    assert all(got[i] == (10, ["1"]) for i in range(491)) and got[491][0] == 500 and got[493] == (2, ["2"]) and got[494][0] == 0


def test_clashing_columns(make):
    docs = make([("w1 w2 w3", "f", 1, "r")], "text string, _foundation string, found int, row string")
    bench = make([(1, "w1 w2"), (2, "w2 w3")], "item_id long, text string")
    for block_words in (1, 100):
        assert list(map(tuple, decontaminate(docs, bench, block_words=block_words).collect())) == [("w1 w2 w3", "f", 1, "r", 3, 3, [(0, 3)], ["1", "2"])]


def test_edges(make, edge_docs, no_docs):
    bench = make([(1, None), (2, ""), (3, "a"), (None, "no id"), (5, "word " * 12), (5, "word " * 12)], "item_id long, text string")
    got = {(r.doc_id, r.text): r for r in decontaminate(edge_docs, bench).collect()}
    assert got[0, None].n_words == 0 and got[0, None].n_hit == 0
    assert got[3, "a"].items == ["3"] and got[None, "no id at all"].items == ["null"]
    assert got[7, "word " * 30_000].n_hit == 30_000
    assert decontaminate(edge_docs, bench).count() == edge_docs.count()
    assert decontaminate(no_docs, bench).count() == 0
    assert decontaminate(edge_docs, bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
