from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from textsignal.llm.packing import EXACT, best_boundaries, grain, pack, word_tokens


def padding(lengths, counts, ends):
    return sum(c * (min(e for e in ends if e >= n) - n) for n, c in zip(lengths, counts))


def test_boundaries_are_optimal():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(1, 11))
        lengths = np.sort(rng.choice(60, n, replace=False))
        counts = rng.integers(1, 30, n)
        for k in range(1, 6):
            got = best_boundaries(lengths, counts, k)
            assert got[-1] == lengths[-1] and got == sorted(set(got)) and len(got) <= k
            want = min(
                padding(lengths, counts, [*c, lengths[-1]]) for m in range(min(k, n)) for c in combinations(lengths[:-1], m)
            )
            assert padding(lengths, counts, got) == want
    assert best_boundaries(np.array([], np.int64), np.array([], np.int64), 4) == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack(docs, F.col("doc_id"), token_budget=4096, buckets=6).collect()
    assert len({r.doc_id for r in rows}) == docs.count() == len(rows)
    batches = {}
    for r in rows:
        assert r.n_tokens == len(r.text.split()) <= r.padded
        batches.setdefault((r.bucket, r.batch), []).append((r.place, r.padded))
    last = {b: max(n for k, n in batches if k == b) for b, _ in batches}
    for (bucket, n), found in batches.items():
        size = max(1, 4096 // max(1, found[0][1]))
        assert sorted(p for p, _ in found) == list(range(len(found)))
        assert len(found) == size or n == last[bucket] and len(found) < size
    lengths, counts = np.unique([r.n_tokens for r in rows], return_counts=True)
    small = lengths <= EXACT
    if small.all():
        assert sum(r.padded - r.n_tokens for r in rows) == padding(lengths, counts, best_boundaries(lengths, counts, 6))


def test_grain(spark):
    values = [0, 1, EXACT, EXACT + 1, 5000, 8191, 8192, 123_457, 10**9]
    got = spark.createDataFrame([(v,) for v in values], "n long").select("n", grain(F.col("n")).alias("g")).collect()
    assert all(r.g == r.n for r in got if r.n <= EXACT)
    assert all(r.n <= r.g <= r.n * 1.001 + 1 for r in got)


def test_edges(edge_docs, no_docs):
    got = pack(edge_docs.withColumn("Batch", F.lit("mine")), F.col("doc_id"), buckets=3, token_budget=10)
    assert got.columns == [*edge_docs.columns, "n_tokens", "bucket", "padded", "batch", "place"]
    rows = got.collect()
    assert len(rows) == edge_docs.count() and len({(r.bucket, r.batch, r.place) for r in rows}) == len(rows)
    assert {r.n_tokens for r in rows if r.text is None or not r.text.strip()} == {0}
    assert pack(no_docs, F.col("doc_id")).count() == 0
    assert [r[0] for r in edge_docs.select(word_tokens(F.col("text"))).collect()][7] == 30_000
