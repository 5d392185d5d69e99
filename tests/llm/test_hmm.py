import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.llm import hmm


def small_model(seed=0, states=3, symbols=5):
    rng = np.random.default_rng(seed)

    def rows(a, b, axis):
        x = rng.random((a, b)) + 0.1
        return x / x.sum(axis=axis, keepdims=True)

    return hmm.Hmm(rows(1, states, 1)[0], rows(1, states, 1)[0], rows(states, states, 1), rows(symbols, states, 0))


def by_paths(model, symbols, start):
    """Probability, and expected counts, by a sum over all paths."""
    states = len(start)
    total, counts = 0.0, hmm.Hmm(np.zeros(states), np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit))
    for path in itertools.product(range(states), repeat=len(symbols)):
        p = start[path[0]] * math.prod(model.emit[s, h] for s, h in zip(symbols, path))
        p *= math.prod(model.move[a, b] for a, b in zip(path, path[1:]))
        total += p
        counts.start[path[0]] += p
        for a, b in zip(path, path[1:]):
            counts.move[a, b] += p
        for s, h in zip(symbols, path):
            counts.emit[s, h] += p
    for x in (counts.start, counts.move, counts.emit):
        x /= total
    return total, counts


def test_forward_is_the_sum_over_paths():
    model = small_model()
    rng = np.random.default_rng(1)
    sequences = [rng.integers(0, 5, n) for n in (1, 4, 6, 2, 6)]
    got = hmm.log_likelihood(model, sequences)
    for g, s in zip(got, sequences):
        assert math.isclose(g, math.log10(by_paths(model, s, model.start)[0]), rel_tol=1e-9)


def test_expected_counts_are_those_of_all_paths():
    model = small_model(2)
    rng = np.random.default_rng(3)
    sequences = [rng.integers(0, 5, n) for n in (5, 1, 6, 3)]
    opens = np.array([True, False, False, True])
    got = hmm.expected_counts(model, sequences, opens)
    want = [by_paths(model, s, model.start if o else model.later)[1] for s, o in zip(sequences, opens)]
    assert np.allclose(got.emit, sum(w.emit for w in want), atol=1e-5)
    assert np.allclose(got.move, sum(w.move for w in want), atol=1e-5)
    assert np.allclose(got.start, sum(w.start for w, o in zip(want, opens) if o), atol=1e-5)
    assert np.allclose(got.later, sum(w.start for w, o in zip(want, opens) if not o), atol=1e-5)


def test_very_long_sequences_stay_finite():
    model = small_model(4)
    symbols = np.random.default_rng(5).integers(0, 5, 50_000)
    whole = hmm.log_likelihood(model, [symbols])[0]
    assert np.isfinite(whole) and -1.5 < whole / len(symbols) < -0.3


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_base(rows):
    held = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, _ in rows}
    tokens = [(i, [*words_of(t), None]) for i, t in rows]
    c = Counter(w for i, ws in tokens if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, held[i], len(ws), sum(c[w] > 0 for w in ws), n,
             sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in tokens]


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    got, want = (sorted(rows, key=key) for rows in (got, want))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(got, want))


@pytest.mark.parametrize("common", [hmm.COMMON, 100])
def test_base_score_and_counts(documents, common, monkeypatch):
    monkeypatch.setattr(hmm, "COMMON", common)  # with few common words most counts come by the join
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = [tuple(r) for r in hmm.score(documents, rounds=1).collect()]
    same([g[:6] for g in got], brute_base(rows))
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)  # better than single words on texts not learned from


def test_probabilities_of_all_one_word_texts_add_up(spark):
    """All words and one unknown word of each class, then the end: no more than what the model gives to two tokens."""
    learn = [(1, "a b a c the theme scheme"), (2, "b c d a the"), (3, "a a b the dream"), (4, "c d e the cream")]
    known = sorted({w for _, t in learn for w in t.split()})
    free = (i for i in itertools.count(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    asked = [(next(free), w) for w in known]
    one = hmm.score(spark.createDataFrame(learn + asked, "doc_id long, text string"), rounds=1)
    total = sum(10 ** r.score for r in one.where("doc_id >= 100").collect())
    assert 0 < total <= 1


def test_odd_rows(odd, odd_rows, none):
    got = [tuple(r) for r in hmm.score(odd, rounds=1).collect()]
    same([g[:6] for g in got], brute_base([(r[0], r[1]) for r in odd_rows]))
    assert all(np.isfinite(g[6]) for g in got)
    assert hmm.score(none).count() == 0
    alone = hmm.score(odd.where(F.col("doc_id") == 1), rounds=1).collect()
    assert len(alone) == 1 and alone[0].n_tokens == 1


def test_start_values_come_from_all_training_documents(spark, monkeypatch):
    """More documents than any sample: the start counts each symbol of each, and tells the two kinds apart."""
    docs = spark.range(6000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'aa ab ac aa ad ae', 'ba bb bc ba bd be') AS text")
    learns = [i for i in range(6000) if zlib.crc32(str(i).encode()) % 10]
    seen = []
    real = hmm.grouped_counts
    monkeypatch.setattr(hmm, "grouped_counts", lambda *a: seen.append(real(*a)) or seen[-1].copy())
    got = {r.doc_id % 2: r.score for r in hmm.score(docs, rounds=1).collect()}
    assert {x.sum() for x in seen} == {7 * len(learns)} and len(seen) == 2 + hmm.WARM_ROUNDS
    assert {np.count_nonzero(row) for row in seen[-1]} <= {0, 6}  # five words of one kind and the end
    assert got[0] > -8 and got[1] > -8
