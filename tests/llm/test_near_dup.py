import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from textsignal.llm.near_dup import anchors_of, components, fingerprint, links, near_duplicates, one_per_component

SF = "/root/testdata/sf0.01"


def plain(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(ids, prints, radius=4):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    p = np.array(prints, np.uint64)
    for i in range(len(ids)):
        near = np.flatnonzero(np.bitwise_count(p ^ p[i]) <= radius)
        for j in near:
            a, b = find(ids[i]), find(ids[j])
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_anchors_meet_all_pairs():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 3000, dtype=np.int64) * rng.choice([1, -1], 3000)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            y[i] = int(y[i]) ^ (int(1 << int(b)) - (1 << 64) if b == 63 else 1 << int(b))

    def roles(p):
        home, visits = [set() for _ in p], [set() for _ in p]
        for rows, anchor, at_home in anchors_of(p):
            for r, a, h in zip(rows.tolist(), anchor.tolist(), np.broadcast_to(at_home, len(rows)).tolist()):
                visits[r].add(a)
                if h:
                    home[r].add(a)
        return home, visits

    (hx, vx), (hy, vy) = roles(x), roles(y)
    assert all(len(h) == 3 for h in hx)
    assert all(h & v for h, v in zip(hx, vy)) and all(h & v for h, v in zip(hy, vx))


def test_fingerprint():
    for t in (None, "", "one", "A b C", "É b\tC d e\x0bf g h  i ", "x y z w v " * 40, "~ ".join("abcdefghij")):
        assert fingerprint(t) & (1 << 64) - 1 == plain(t)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = near_duplicates(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: plain(t) for i, t in texts.items()}
    assert {r.doc_id: r.fingerprint & (1 << 64) - 1 for r in got} == prints
    assert {r.doc_id: r.component_id for r in got} == brute(list(prints), list(prints.values()))
    assert len({r.component_id for r in got}) < len(got)


def test_dense_cluster_and_chains(spark, make):
    rng = random.Random(8)
    prints = set()
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(12):
            prints.add(x)
            for b in rng.sample(range(64), 4):
                x ^= 1 << b
    signed = [x - (1 << 64) if x >> 63 else x for x in prints]
    ids = list(range(len(signed)))
    rng.shuffle(ids)
    nodes = make(list(zip(signed, ids)), "fingerprint long, node long")
    found = {r.node: r.component for r in components(links(nodes)).collect()}
    want = brute(ids, [x & (1 << 64) - 1 for x in signed])
    assert {i: found.get(i, i) for i in ids} == want


def test_edges(edge_docs, no_docs):
    got = near_duplicates(edge_docs).collect()
    assert len(got) == edge_docs.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].component_id == by_id[1].component_id == by_id[2].component_id == 0 and by_id[0].fingerprint == 0
    assert by_id[10].component_id == by_id[11].component_id == 10 and by_id[None].component_id is None
    kept = one_per_component(edge_docs.withColumn("fingerprint", F.lit("mine"))).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(
        {r.component_id for r in got if r.component_id is not None}
    )
    assert sum(r.doc_id is None for r in kept) == 1
    assert near_duplicates(no_docs).count() == one_per_component(no_docs).count() == 0
