import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from textsignal.llm import line_dedup as L


def brute(texts, min_docs=10, min_chars=1):
    key = lambda x: x.strip(L.SPACES).translate(L.FOLD)
    held = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or held[key(x)] < min_docs]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def check(df, **args):
    texts = [r.text for r in df.collect()]
    found = L.drop_common_lines(df, **args)
    assert Counter((r.text, r.n_lines, r.n_dropped, r.kept) for r in found.collect()) == Counter(
        (t, *x) for t, x in zip(texts, brute(texts, **args), strict=True)
    )
    return found


def test_edges_against_brute_force(edge_docs):
    check(edge_docs, min_docs=2)
    check(edge_docs, min_docs=2, min_chars=0)


def test_hot_lines_long_texts_and_ties(make):
    rows = [(i, "\n".join([" Hot LINE\t", f"own {i}", *(["nine"] * (i < 9)), *(["TEN", "ten", ""] * (i < 10))])) for i in range(400)]
    rows.append((999, "\n".join(["hot line"] * 60_000 + [f"l{i}" for i in range(60_000)])))
    found = {r.doc_id: r for r in check(make(rows, "doc_id long, text string")).collect()}
    assert found[0].kept == "own 0\nnine\n" and found[0].n_dropped == 3  # ten documents reach the threshold, nine do not
    assert found[999].n_dropped == 60_000 and found[999].n_lines == 120_000


def test_empty_table_and_clashing_columns(make, no_docs):
    assert L.drop_common_lines(no_docs).collect() == []
    schema = "grp string, digest long, row string, n_lines string, kept long, found int, dropped int, shard int, text string, m map<string,int>"
    rows = [("g", i, "r", "x", 1, 2, 3, 4, "same\nother", {"a": i}) for i in range(12)]
    found = L.drop_common_lines(make(rows, schema))
    assert found.columns == ["grp", "digest", "row", "found", "dropped", "shard", "text", "m", "n_lines", "n_dropped", "kept"]
    assert {(r.n_lines, r.n_dropped, r.kept, r.row) for r in found.collect()} == {(2, 2, "", "r")}


@pytest.mark.parametrize("n", [0, 1, 2, 100, 20_000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, (n, 2), dtype=np.uint64)
    sizes, bits = L.perfect_hash(keys)
    assert sorted(L.slots(keys, sizes, bits)) == list(range(n))
    assert sum(sizes) <= 4 * n + 64 * len(sizes)
    strange = L.slots(keys[::-1] + np.uint64(1), sizes, bits)  # unknown keys get some slot or none
    assert len(strange) == n and (strange < n).all()


def test_equal_keys_are_refused():
    with pytest.raises(ValueError, match="must differ"):
        L.perfect_hash(np.zeros((2, 2), np.uint64))


def test_an_index_answers_other_tables(make):
    digest = lambda x: hashlib.md5(x.encode()).digest()
    asks = make([(digest(f"line {i % 300}"), 1) for i in range(900)], "digest binary, n long")
    index = L.line_index(asks, 4)
    assert index.agg(F.sum("n_keys")).first()[0] == 300
    other = make([(i, digest(f"line {i}")) for i in range(200, 600)], "grp long, digest binary")
    assert {r.grp for r in L.probe(index, other, 4, 3).collect()} == set(range(200, 300))
    assert L.probe(index, other, 4, 4).collect() == []
