import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from textsignal.llm import fingerprints as fp
from textsignal.llm.q_fingerprints import op3
from textsignal.llm.registry import Source

SF = "/root/testdata/sf0.001"


def test_whole_query_against_brute_force(spark):
    """Edited texts by definition; a fingerprint's bits by a plain count of the same term hashes."""
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs.sort()
    edited = {}
    for i, (doc, text) in enumerate(docs):
        q, after = len(text) // 4, docs[(i + 1) % len(docs)][1]
        edited[doc] = text[: len(text) - q] + after[:q]
    got = {r.doc_id: r for r in op3(Source(spark, SF)).collect()}
    assert len(got) == len(docs)
    for doc, text in docs:
        assert got[doc].n_chars == len(text)
        assert got[doc].edited_sha256 == hashlib.sha256(edited[doc].encode()).hexdigest()
    terms = []
    for kind, texts in (("o", dict(docs)), ("e", edited)):
        for doc, text in texts.items():
            w = text.lower().split()
            terms += [(f"{kind}{doc}", a, b, len(a) + len(b or "")) for a, b in zip(w, [*w[1:], None])]
    hashed = spark.createDataFrame(terms, "k string, a string, b string, n long").select("k", F.xxhash64("a", "b").alias("h"), "n")
    votes = {}
    for r in hashed.collect():
        bits = np.array([(r.h >> j) & 1 for j in range(64)]) * 2 - 1
        votes[r.k] = votes.get(r.k, 0) + bits * r.n
    want = {k: sum(1 << j for j in range(64) if v[j] > 0) for k, v in votes.items()}
    for doc, _ in docs:
        assert int(got[doc].fingerprint, 16) == want.get(f"o{doc}", 0)
        assert int(got[doc].edited_fingerprint, 16) == want.get(f"e{doc}", 0)
    assert sum(r.near_edited > r.near_next for r in got.values()) > 0.95 * len(got)


def test_search_finds_all_within_the_radius(make):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    prints = {0, (1 << 64) - 1}
    for s in seeds:
        for n in range(6):
            x = s
            for b in rng.sample(range(64), n):
                x ^= 1 << b
            prints.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    table = make([(x,) for x in signed] * 2 + [(None,)], "fingerprint long")
    for radius, blocks in ((3, 6), (2, 4), (0, 3)):
        got = {(r.query, r.found, r.distance) for r in fp.within_radius(table, table, radius, blocks).collect()}
        want = {(a, b, d) for a in signed for b in signed if (d := bin((a ^ b) & ((1 << 64) - 1)).count("1")) <= radius}
        assert got == want
        assert fp.within_radius(table, table, radius, blocks).count() == len(want)


def test_successors(make):
    rng = random.Random(1)
    ids = sorted({rng.randrange(-(2**62), 2**62) >> rng.randrange(0, 62) for _ in range(3000)})
    got = dict(map(tuple, fp.successors(make([(i,) for i in [*ids, *ids[:5], None]], "id long"), "id").collect()))
    assert got == dict(zip(ids, [*ids[1:], ids[0]]))
    assert fp.successors(make([(7,)], "id long"), "id").collect()[0].next_id == 7


def test_edges(spark, edge_docs, no_docs, tmp_path):
    edge_docs.write.parquet(f"{tmp_path}/a/documents.parquet")
    no_docs.write.parquet(f"{tmp_path}/b/documents.parquet")
    rows = op3(Source(spark, f"{tmp_path}/a")).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].fingerprint == by_id[1].fingerprint == "0" * 16 and by_id[0].n_chars == 0
    assert by_id[10].fingerprint == by_id[11].fingerprint
    assert by_id[None].near_next == 0 and by_id[None].near_edited == 1.0
    assert all(0 <= r.near_edited <= 1 for r in rows)
    assert op3(Source(spark, f"{tmp_path}/b")).count() == 0
