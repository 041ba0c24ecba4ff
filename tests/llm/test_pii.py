import hashlib
import re

from pyspark.sql import functions as F

from textsignal.llm.pii import PATTERNS, find_personal_data, sanitise
from textsignal.llm.q_pii import op7
from textsignal.llm.registry import Source


def luhn(n):
    total = 0
    for i, c in enumerate(reversed(n)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    spans = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            n = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(n) <= 19 and luhn(n),
                "phone": 10 <= len(n) <= 15,
            }[kind]
            if ok:
                spans.append((m.start(), rank, kind, m.end()))
    return sorted(spans)


def test_whole_table_base_spans(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = 0
    for r in op7(Source(spark, sf)).collect():
        want = base(texts[r.doc_id])
        found += len(want)
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[2] == k for w in want) for k in PATTERNS]
        assert ",".join(s for s in r.spans.split(",") if not s.startswith("term")) == joined
    assert found > 50


def test_tricky_matches(make):
    cases = [
        "x@y.com_z@w.org a.@b-c.d.e @no.com q@r",
        "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 9.9.9 12345678901.1.1.1",
        "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1 23456789012345678901234",
        "+49 (0)30 123456-78 +1 2 +123456789012345678 ++491234567890 +4912345678.",
        "é😀 joe@ex.am 😀 10.0.0.1 +1 234 567 8901x",
        "a" * 20_000 + " z@" + "b" * 20_000 + ".c",
        "1" * 20_000 + " " + "1.1.1.1" * 300,
        "1 " * 9000,
    ]
    docs = make(list(enumerate(cases)), "doc_id long, text string")
    for r in find_personal_data(docs).collect():
        assert [(s.start, s.rank, s.kind, s.end) for s in r.spans] == base(cases[r.doc_id]), r.doc_id


def terms(docs, support=3, share=0.9):
    """The method by plain counting over whole texts."""
    import math
    from collections import Counter

    norm = lambda k, v: v.lower() if k == "email" else v if k == "ip" else re.sub("[^0-9]", "", v)
    joint, n_e, n_t, whole = Counter(), Counter(), Counter(), []
    for text in {t or "" for _, t in docs}:
        spans = base(text)
        rest = list(text)
        for s, _, _, e in spans:
            rest[s:e] = " " * (e - s)
        words = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W\d_]+", "".join(rest))]
        entities = {(k, norm(k, text[s:e])) for s, _, k, e in spans}
        whole.append((text, entities, words))
        held = {w for _, _, w in words}
        n_e.update(entities)
        n_t.update(held)
        joint.update((e, w) for e in entities for w in held)
    n = len(whole)

    def bad(e, t):
        content = math.log2(n / n_e[e])
        c = joint[e, t]
        return c >= support and content > 0 and math.log2(c * n / (n_e[e] * n_t[t])) >= share * content - 1e-12

    return {(text, a, b) for text, entities, words in whole for a, b, w in words if any(bad(e, w) for e in entities)}


def marked(docs, rows, **args):
    texts = dict(rows)
    got = find_personal_data(docs, **args).collect()
    return {(texts[r.doc_id] or "", s.start, s.end) for r in got for s in r.spans if s.kind == "term"}


def test_disclosing_terms_against_plain_counts(make):
    rows = []
    for i in range(60):
        rows.append((i, f"note {i}: write to the treasurer Quillfeather at q@club.org soon, number {i}"))
        rows.append((100 + i, f"the weather of day {i} was fine and the number {i} is a number"))
        rows.append((200 + i, f"mail to joe{i}@mail.com soon, number {i}"))
    rows += [(300, rows[0][1]), (301, None), (302, "")]
    docs, texts = make(rows, "doc_id long, text string"), dict(rows)
    found = marked(docs, rows)
    assert found == terms(rows)
    assert {t[a:b] for t, a, b in found} >= {"Quillfeather", "treasurer"} and "number" not in {t[a:b] for t, a, b in found}
    clean = {r.doc_id: r.text for r in sanitise(docs).collect()}
    assert "Quillfeather" not in clean[0] and "[EMAIL]" in clean[0] and "[TERM]" in clean[0]
    assert clean[100] == texts[100] and clean[301] is None and clean[302] == ""


def test_terms_far_from_their_entity(make):
    """The name always shares the text with the address, some hundred characters away; the filler words stand everywhere."""
    filler = "now note here some plain words that anybody may write in a letter about nothing at all, day after day"
    rows = [(i, f"Quillfeather, {filler} {i}. {filler}. q@club.org; ŒUVRE {i} {filler} Quillfeather") for i in range(60)]
    rows += [(100 + i, f"{filler} {i} and {filler} with joe{i}@mail.com") for i in range(60)]
    rows += [(300 + i, f"{filler} {i} and {filler}") for i in range(200)] + [(900 + i, rows[3][1]) for i in range(50)]
    docs = make(rows, "doc_id long, text string")
    found = marked(docs, rows)
    assert found == terms(rows)
    assert {t[a:b] for t, a, b in found} == {"Quillfeather", "ŒUVRE"}


def test_thresholds(make):
    rows = [(i, f"Ab z{'y' * (i % 4)} the q@club.org") for i in range(8)] + [(50 + i, f"the ab text {i}" if i < 2 else f"the text {i}") for i in range(40)]
    docs = make(rows, "doc_id long, text string")
    for support, share in ((1, 0.9), (2, 0.5), (3, 0.99), (9, 0.1)):
        assert marked(docs, rows, support=support, share=share) == terms(rows, support, share)


def test_given_documents_against_plain_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert marked(docs, rows) == terms(rows)


def test_clashing_columns(make):
    schema = "doc_id long, text string, id long, text_key string, spans int, row string, bad int, base string"
    rows = [(i, "mail joe@mail.com", 9, "k", 1, "r", 2, "b") for i in range(3)]
    assert {tuple(r)[1:] for r in sanitise(make(rows, schema)).collect()} == {("mail [EMAIL]", 9, "k", 1, "r", 2, "b")}


def test_edges(edge_docs, no_docs):
    assert find_personal_data(edge_docs).count() == edge_docs.count()
    clean = sanitise(edge_docs.withColumn("spans", F.lit(1)))
    assert clean.columns == [*edge_docs.columns, "spans"] and clean.exceptAll(edge_docs.withColumn("spans", F.lit(1))).count() == 0
    assert clean.count() == edge_docs.count()
    assert find_personal_data(no_docs).count() == sanitise(no_docs).count() == 0


def test_no_python_in_the_plan(spark):
    plan = op7(Source(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
