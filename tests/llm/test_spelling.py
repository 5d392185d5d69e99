import collections
import random
import re
import zlib

import pytest

from salescast.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def low(run):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in run)


def brute_words(rows, every=199):
    found = collections.Counter()
    for doc_id, text in rows:
        for run in map(low, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words):
    linked = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, others in linked.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(linked[w]), form[w] and words[form[w]]) for w, n in words.items()}


def got(frame, every=199):
    out = [tuple(r) for r in spelling.variants(frame, every).collect()]
    assert len(out) == len(set(out))
    return set(out)


def check(spark, rows, every=199):
    want = brute_variants(brute_words(rows, every))
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), every) == want
    return want


@pytest.mark.parametrize("letters, sizes", [("ab", (6, 9)), ("aabé", (6, 8)), ("ththe", (6, 10)), ("a", (6, 30))])
def test_small_alphabets(spark, letters, sizes):
    """Grams that repeat within a word and words that share them all: many near pairs."""
    rng = random.Random(letters)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(*sizes))) for _ in range(250)]
    rows = [(i, " ".join(rng.choices(words, k=400))) for i in range(12)]
    rows.append((99, " ".join(w for w in words[:40] for _ in range(150))))
    want = check(spark, rows)
    assert sum(1 for w in want if w[4]) > 10


def test_planted_edits_and_chains(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("etaoinshrdluèÿ×") for _ in range(rng.randint(6, 14))) for _ in range(200)]

    def edited(w):
        i = rng.randrange(len(w) + 1)
        return rng.choice([w[:i] + "q" + w[i:], w[:i] + w[i + 1:], w[:i] + "q" + w[i + 1:]])

    words = [(w, 200) for w in base] + [(e := edited(w), 40) for w in base] + [(edited(e), 7) for _ in range(2)]
    words += [(edited(edited(w)), 6) for w in base]
    flat = [w for w, n in words for _ in range(n)]
    rng.shuffle(flat)
    want = check(spark, [(i, " ".join(flat[i::20]).upper() if i % 2 else "-".join(flat[i::20])) for i in range(20)])
    assert any(r[1] and r[2] != r[1] for r in want)


@pytest.mark.parametrize("every", [1, 2, 199])
def test_odd_rows(spark, odd, odd_rows, none, every):
    rows = [(r[0], r[1]) for r in odd_rows]
    assert got(odd, every) == brute_variants(brute_words(rows, every))
    if every == 199:
        assert got(none) == set()
        check(spark, [(1, "word12×÷word"), (None, "Straßen " * 9 + "x" * 5 + " ĀÀbcdef " * 6), (-5, "abcdef " * 5 + "İstanbul" * 5)])


def test_documents_against_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert got(documents) == brute_variants(brute_words(rows))


def test_crowded_keys_are_cut(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HOMES", 3)
    rng = random.Random(4)
    words = sorted({"zq" + "".join(rng.choice("ab") for _ in range(6)) for _ in range(200)})
    check(spark, [(i, " ".join(words)) for i in range(6)])


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(2)
    for _ in range(2000):
        n = rng.randint(5, 12)
        grams = [rng.randrange(8) for _ in range(n)]
        last, prefix, pivots = spelling.prefix_and_pivots(grams, grams)
        assert prefix == [i for i in range(n) if grams[i] <= sorted(grams)[2]] and last == sorted(grams)[2]
        pairs = [(i, j) for i in prefix for j in prefix if j - i >= 2]
        assert tuple(pivots) in pairs and sum(grams[i] for i in pivots) == min(grams[i] + grams[j] for i, j in pairs)


def test_words_one_edit_apart_share_a_key():
    """Whatever gram an edit leaves whole, the key of that gram is common."""
    rng = random.Random(6)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(6, 14)))
        at, kind = rng.randrange(len(a) + 1), rng.randrange(3)
        b = (a[:at] + "x" + a[at:], a[:at] + "x" + a[at + 1:], a[:at] + a[at + 1:])[kind]
        if at == len(a) and kind or len(b) < 6:
            continue
        for i in range(len(a) - 1):
            if i + 2 <= at:
                assert spelling.keys(a, [i]) & spelling.keys(b, [i])
            if i >= at + (kind > 0):
                assert spelling.keys(a, [i]) & spelling.keys(b, [i + len(b) - len(a)])
