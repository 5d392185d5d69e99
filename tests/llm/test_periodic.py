import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salescast.llm import periodic


def brute_runs(words, least=6, times=4):
    """All runs from the definition: stretches of equal words at a distance, for every distance."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, times * q):
                found.setdefault((i, j + q - i), q)  # the smallest period of a stretch comes first
            i = j
    return sorted((s, size, q) for (s, size), q in found.items())


def brute_row(doc_id, text, plant):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and n and h % 10 == 0:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(words)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def found(symbols):
    return [tuple(map(int, r)) for r in zip(*periodic.find_runs(np.array(symbols, np.int64)), strict=True)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9)), max_size=8))
def test_runs_of_small_alphabets(parts):
    symbols = [x for part, times in parts for x in part * times]
    assert found(symbols) == brute_runs(symbols)


@pytest.mark.parametrize("symbols", [
    [], [1], [7] * 5, [7] * 6, [7] * 1000, [0, 1] * 4, [0, 1] * 3, ([0] * 11 + [1]) * 5, ([0, 0, 1, 0, 0, 1, 1] * 6 + [2]) * 5,
    [0, 1, 2] * 40 + [3] + [0, 1, 2] * 40, list(range(300)) * 4, list(range(300)) * 4 + [0], ([5] * 20 + [1, 2] * 20) * 4])
def test_runs_of_given_shapes(symbols):
    assert found(symbols) == brute_runs(symbols)


def test_wavelet_queries():
    rng = np.random.default_rng(1)
    values = rng.permutation(777)
    tree = periodic.Wavelet(values, 10)
    low = rng.integers(0, 777, 500)
    high = np.minimum(low + rng.integers(0, 300, 500), 777)
    least = rng.integers(0, 800, 500)
    got = tree.successor(low, high, least, -1)
    for g, a, b, x in zip(got, low, high, least, strict=True):
        assert g == min((v for v in values[a:b] if v >= x), default=-1)


def rows_of(frame, plant):
    return collections.Counter(tuple(r)[:8] for r in periodic.runs(frame, plant).collect())


def test_documents_against_brute_force(documents):
    short = documents.where("n_chars < 6000").select("doc_id", "text", "source")
    want = collections.Counter(brute_row(r.doc_id, r.text, True) for r in short.collect())
    assert rows_of(short, True) == want
    assert sum(1 for r in want if r[1]) > 10


def test_odd_rows(spark, odd, odd_rows, none):
    few = [(r[0], r[1]) for r in odd_rows if len(r[1] or "") < 10_000]
    many = [(i, t) for i, t in few] + [(30, "a b " * 500), (10, " ".join(["x"] * 7) + "\n" + "y " * 6), (10, "x " * 6)]
    frame = spark.createDataFrame(many, "doc_id long, text string")
    for plant in (False, True):
        assert rows_of(frame, plant) == collections.Counter(brute_row(*r, plant) for r in many)
    out = periodic.runs(odd, True)
    assert out.count() == len(odd_rows)
    assert periodic.runs(none).count() == 0


def test_long_text_and_batches_do_not_matter(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60))) + " u v w" * rng.randrange(9)) for i in range(400)]
    rows.append((500, " ".join(f"w{rng.randrange(900)}" for _ in range(60_000)) + " p q r" * 20_000))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = {r: n for r, n in rows_of(frame.coalesce(1), False).items()}
    assert rows_of(frame.repartition(7), False) == want
    long = next(r for r in want if r[0] == 500)
    assert long[1:6] == (1, 60_000, 60_000, 3, 20_000_000)
    assert {r for r in want if r[0] < 500} == {brute_row(*r, False) for r in rows[:-1]}


def test_least_exponent_is_checked():
    with pytest.raises(ValueError):
        periodic.find_runs(np.zeros(10, np.int64), times=3)
