import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.llm import quality, toxicity


def test_folding_undoes_disguises():
    assert toxicity.fold("ІDІ0T, Ｓｃｕｍ! l​оser") == " idiot scum loser "
    assert toxicity.fold("$cum cl0wn!! m@r!n %%% a$$$ b!") == " scum clown marin a b "
    assert toxicity.fold("") == "  "
    assert toxicity.fold("réeux\tÀ") == " réeux à "


def test_matches_take_the_longest_entry_and_spare_exceptions():
    lexicon = toxicity.Lexicon({" scun": 1.0, " scunthor ": 2.0, " bad": 3.0}, ("bad hair",))
    made = lexicon.automaton()
    assert [w for _, w in toxicity.matches(" scunthor scunt ", made)] == [2.0, 1.0]
    assert toxicity.matches(" a bad hair day ", made) == []
    assert [w for _, w in toxicity.matches(" a bad day ", made)] == [3.0]


def auc(scores, truth):
    order = np.argsort(np.argsort(scores, kind="stable")) + 1
    pos = sum(truth)
    return (order[np.array(truth, dtype=bool)].sum() - pos * (pos + 1) / 2) / (pos * (len(truth) - pos))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert auc([r.score for r in got], [r.toxic for r in got]) > 0.85
    assert sum(r.predicted for r in got if not r.toxic) <= 2
    assert sum(r.predicted for r in got if r.toxic) >= 0.6 * sum(r.toxic for r in got)
    assert all(r.predicted == (r.score >= 0.7) for r in got)


def test_disguised_words_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs, labels)
    clean = "the and attion to thanedble the anea eriner thanea of it is for"
    plain, odd = f"{clean} idiot scum moron {clean}", f"{clean} 1d10t ѕсum m0rоn {clean}"

    def score(text):
        folded = toxicity.fold(text)
        return model.score(toxicity.measures(folded, toxicity.matches(folded, model.lexicon.automaton())))

    assert score(plain) == score(odd) > 0.7 > score(clean)


def test_toxicity_on_odd_rows(spark, odd, odd_rows, none):
    marks = spark.createDataFrame([(4, 0, 1), (5, 1, 0), (None, 1, 1), (6, 1, None), (7, 0, 1), (7, 1, 0)], "doc_id long, quality int, toxic int")
    out = toxicity.toxicity(odd, marks).collect()
    assert len(out) == len(odd_rows) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.toxicity(odd, marks.limit(0)).where("predicted = 1").count() == 0
    assert toxicity.toxicity(none, marks).count() == 0
    assert toxicity.drop_toxic(odd, marks).columns == odd.columns


def test_rejected_documents_go(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    bad = {r.doc_id for r in toxicity.toxicity(docs, labels).where("predicted = 1").collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - bad and bad


def brute_kneser_ney(texts):
    """log p(gram) by the textbook recursion over dictionaries."""
    from collections import Counter, defaultdict

    n = quality.ORDER
    counts = {n: Counter()}
    for t in texts:
        padded = quality.EDGE * (n - 1) + t
        counts[n].update(padded[i:i + n] for i in range(len(t)))
    for k in range(n - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off = {k: quality.discounts(*(sum(c == i for c in counts[k].values()) for i in (1, 2, 3, 4))) for k in counts}
    totals, lefts = {}, {}
    for k in counts:
        totals[k], lefts[k] = defaultdict(int), defaultdict(float)
        for g, c in counts[k].items():
            totals[k][g[:-1]] += c
            lefts[k][g[:-1]] += off[k][min(c, 3) - 1]

    def p(g):
        k = len(g)
        if not k:
            return 1 / (len(counts[1]) + 1)
        total = totals[k].get(g[:-1], 0)
        if not total:
            return p(g[1:])
        c = counts[k].get(g, 0)
        return (c - off[k][min(c, 3) - 1] if c else 0) / total + lefts[k][g[:-1]] / total * p(g[1:])

    return p, counts


def test_model_is_the_textbook_recursion(spark):
    texts = ["the cat sat on the mat. the end", "a cat and a hat\nthat sat", "mat hat cat", "the then there"]
    p, counts = brute_kneser_ney(texts)
    frame = spark.createDataFrame([(t, True) for t in texts], "text string, trains boolean")
    grams = quality.corpus_counts(frame)
    assert {r.gram: r.trusted for r in grams.collect()} == dict(counts[quality.ORDER])
    model = quality.kneser_ney(grams.select("gram", F.col("trusted").alias("c")))
    asked = sorted(counts[quality.ORDER]) + ["zzzzz", "the z", "\n\n\n\nq", "he ca", "catca"]
    got = quality.log_probabilities(spark.createDataFrame([(g,) for g in asked], "gram string"), model).collect()
    assert len(got) == len(asked)
    for r in got:
        assert math.isclose(r.log_p, math.log(p(r.gram)), rel_tol=1e-9), r
    # Over all characters and one never seen, the probabilities after any context add up to 1.
    kinds = [*(g for g in counts[1]), "z"]
    for context in ("the ", "\n\n\n\n", "qqqq", "a ca"):
        rows = quality.log_probabilities(spark.createDataFrame([(context + c,) for c in kinds], "gram string"), model).collect()
        assert math.isclose(sum(math.exp(r.log_p) for r in rows), 1, rel_tol=1e-9)


def test_perplexity_of_whole_texts(spark, monkeypatch, documents, labels):
    trusted = [r.doc_id for r in labels.where("quality = 1").collect()]
    whole = quality.quality(documents, labels)
    a = {r.doc_id: r.perplexity for r in whole.collect()}
    assert len(a) == documents.count() and trusted
    monkeypatch.setattr(quality, "COMMON", 500)  # most n-grams then go through the join
    b = {r.doc_id: r.perplexity for r in quality.quality(documents, labels).collect()}
    assert a.keys() == b.keys() and all(math.isclose(a[i], b[i], rel_tol=1e-9) for i in a)


def test_bad_texts_stand_apart(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality(docs, labels).join(labels, "doc_id").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.35 * len(bad)


def test_quality_on_odd_rows(spark, odd, odd_rows, none, labels):
    marks = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (6, None, 1), (7, 1, 0), (7, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality(odd, marks).collect()
    assert len(rows) == len(odd_rows)
    empty = {r[0] for r in odd_rows if not r[1]}
    assert all((r.perplexity is None) == (r.doc_id in empty) for r in rows)
    assert not any(r.kept for r in rows if r.perplexity is None)
    assert {r.kept for r in quality.quality(odd, marks.limit(0)).where("perplexity is not null").collect()} == {True}
    assert quality.quality(none, labels).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_lookup(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
    values = rng.random(len(keys))
    found = quality.Lookup(keys, values)
    assert np.array_equal(found(keys), values)
    assert np.isnan(found(keys + np.uint64(1))).all()


def test_thresholds_use_all_trusted_documents_kept_apart(spark, monkeypatch):
    """A small sample for the model leaves the quantiles as they are over all others, rare languages included."""
    rng = np.random.default_rng(7)
    rows = [(i, " ".join("".join(rng.choice(list("aeioulnrst"), rng.integers(2, 7))) for _ in range(20)), "rare" if i % 40 == 0 else "en")
            for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    marks = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    monkeypatch.setattr(quality, "TRUSTED", 20)
    got = quality.quality(docs, marks).collect()
    for lang in ("rare", "en"):
        apart = sorted(r.perplexity for r in got if r.lang == lang and hashes[r.doc_id] % quality.APART == 0)
        threshold = {r.threshold for r in got if r.lang == lang}
        assert apart and threshold == {apart[max(math.ceil(quality.QUANTILE * len(apart)), 1) - 1]}


def test_all_trusted_documents_train(spark, monkeypatch):
    """More than 50,000 trusted documents: n-grams of each count, and ids joined by shuffle change nothing."""
    seen = []
    real = quality.kneser_ney
    monkeypatch.setattr(quality, "kneser_ney", lambda grams: seen.append(grams.agg(F.sum("c")).first()[0]) or real(grams))
    docs = spark.range(90_000).selectExpr("id AS doc_id", "'ab' AS text", "'en' AS lang")
    marks = docs.selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    apart = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(quality.APART)) == 0).count()
    for sent in (quality.SENT, 10):
        monkeypatch.setattr(quality, "SENT", sent)
        assert quality.quality(docs, marks).where("kept").count() == 90_000
    assert seen == [2 * (90_000 - apart)] * 2


@pytest.mark.parametrize("bits, held", [(12, 1_000_000), (12, 40), (3, 1_000_000), (4, 25)])
def test_counts_of_any_alphabet(monkeypatch, bits, held):
    """Few bits a character and little room: counts are handed on often, and long texts of many characters are cut."""
    from collections import Counter

    monkeypatch.setattr(quality.Counts, "BITS", bits)
    monkeypatch.setattr(quality, "HELD", held)
    rng = np.random.default_rng(bits)
    alphabet = "ab c\nd\U0001f600\u4e2d\u6587\u00e9xyzABC"[:None if bits > 3 else 6]
    made, want, trusted = quality.Counts(), Counter(), Counter()
    n, own = Counter(), Counter()
    for _ in range(6):
        texts = ["".join(rng.choice(list(alphabet), rng.integers(0, 60))) for _ in range(7)]
        marks = rng.random(len(texts)) < 0.4
        for t, m in zip(texts, marks, strict=True):
            padded = quality.EDGE * (quality.ORDER - 1) + t
            grams = [padded[i:i + quality.ORDER] for i in range(len(t))]
            want.update(grams)
            trusted.update(grams if m else [])
        for grams, sums in made.add(*quality._points(texts), np.repeat(marks, [len(t) for t in texts])):
            n.update(dict(zip(grams, sums[:, 0].tolist(), strict=True)))
            own.update(dict(zip(grams, sums[:, 1].tolist(), strict=True)))
    for grams, sums in made.take():
        n.update(dict(zip(grams, sums[:, 0].tolist(), strict=True)))
        own.update(dict(zip(grams, sums[:, 1].tolist(), strict=True)))
    assert n == want and +own == trusted and not list(made.take())
