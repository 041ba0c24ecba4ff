import corpus_pipeline
from tests.llm.test_near_dup import brute, plain
from textsignal.llm.decontaminate import compile_patterns, search, words_of

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "packing"]
    texts = {r.doc_id: r.text for r in docs.collect()}

    known = stages["language_id"](spark, docs, SF)
    assert known.columns == docs.columns
    assert {r.doc_id for r in known.collect()} == {i for i, t in texts.items() if any(c.isalpha() for c in t)}

    single = stages["near_dedup"](spark, docs, SF)
    assert single.columns == docs.columns
    assert {r.doc_id for r in single.collect()} == set(brute(list(texts), [plain(t) for t in texts.values()]).values())

    clean = stages["decontamination"](spark, docs, SF)
    tables = compile_patterns(bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, t in texts.items() if not search(words_of(t), tables)[0]}

    private = stages["pii"](spark, docs, SF)
    assert private.columns == docs.columns and private.count() == docs.count()
    changed = [r for r in private.collect() if r.text != texts[r.doc_id]]
    assert changed and all("@" in texts[r.doc_id] or any(c.isdigit() for c in texts[r.doc_id]) for r in changed)

    packed = stages["packing"](spark, docs, SF).collect()
    assert sorted(r.doc_id for r in packed) == sorted(texts)


def test_run_and_edges(spark, edge_docs, no_docs):
    done = corpus_pipeline.run(spark, SF)
    assert 0 < done.count() <= spark.read.parquet(f"{SF}/documents.parquet").count()
    for docs in (edge_docs.withColumn("score", edge_docs.doc_id), no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= docs.count()
            if name != "packing":
                assert out.columns == docs.columns
