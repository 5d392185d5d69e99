import collections

import corpus_pipeline
from salescast.llm import bpe, exact, mixing, simhash, toxicity
from salescast.llm.queries import TOKENIZER
from tests.llm.conftest import SF
from tests.llm.test_bpe import want
from tests.llm.test_exact_and_mix import brute_targets
from tests.llm.test_simhash import brute_components, brute_print


def test_stages_in_order(spark, documents, labels):
    """Each stage against a plain rendition over what the one before it kept."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_dedup", "mix", "bpe"]
    library = bpe.tokenizer(TOKENIZER)
    docs, columns = documents, documents.columns
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        rows[name] = [r.asDict() for r in docs.collect()]
        docs = spark.createDataFrame([tuple(r.values()) for r in rows[name]], documents.schema)
    start = {r.doc_id: r.asDict() for r in documents.collect()}
    bad = {r.doc_id for r in toxicity.toxicity(documents, labels).where("predicted = 1").collect()}
    left = {i: r for i, r in start.items() if i not in bad}
    assert {r["doc_id"]: r for r in rows["toxicity"]} == left
    best = {}
    for i, r in left.items():
        best[r["text"]] = max(i, best.get(r["text"], -1))
    left = {i: left[i] for i in best.values()}
    assert {r["doc_id"]: r for r in rows["exact_dedup"]} == left
    groups = brute_components([(i, brute_print(r["text"])) for i, r in left.items()])
    left = {i: left[i] for i in set(groups.values())}
    assert {r["doc_id"]: r for r in rows["simhash_dedup"]} == left
    size = {i: len(r["text"].split()) for i, r in left.items()}
    by_source = collections.Counter()
    for i, r in left.items():
        by_source[r["source"]] += size[i]
    took = collections.Counter(r["doc_id"] for r in rows["mix"])
    assert set(took.values()) <= {1, 2} and all(r == left[r["doc_id"]] for r in rows["mix"])
    for s, target in brute_targets(by_source).items():
        own = [i for i in left if left[i]["source"] == s]
        assert abs(sum(took[i] * size[i] for i in own) - target) <= max(size[i] for i in own) / 2 + 1e-6
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(tuple(r) for r in last) == sorted((r["doc_id"], *want(library, r["text"])) for r in rows["mix"])


def test_run_is_the_stages(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) and out.count()


def test_stages_on_odd_rows(spark, odd, none):
    for frame in (odd, none):
        docs = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == frame.columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_operators_leave_other_columns_alone(odd):
    for f in (exact.drop_exact, simhash.drop_near, mixing.mix):
        assert f(odd).select("uid", "row", "key").distinct().collect() == [("<uid>", "<row>", "<key>")]
