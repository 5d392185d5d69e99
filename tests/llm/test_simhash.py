import random
import re

import numpy as np
import pytest
import xxhash

from salescast.llm import simhash


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, bits=4):
    """{id: smallest id}, from (id, fingerprint) rows."""
    ids = sorted({i for i, _ in prints})
    up = {i: i for i in ids}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in prints:
        for j, b in prints:
            if (a ^ b).bit_count() <= bits:
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def some_prints(n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        base = out[rng.randrange(len(out))] if out and rng.random() < 0.6 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randrange(7)):
            base ^= 1 << b
        out.append(base)
    return list(enumerate(out))


def test_fingerprints_and_components(documents):
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in simhash.simhash_groups(documents).collect()}
    prints = {i: brute_print(texts[i]) for i in list(texts)[:60]}
    assert all(got[i].fingerprint == f"{p:016x}" for i, p in prints.items())
    want = brute_components([(i, int(r.fingerprint, 16)) for i, r in got.items()])
    assert {i: r.component_id for i, r in got.items()} == want


@pytest.mark.parametrize("covering", range(4))
def test_every_covering_finds_every_link(spark, covering):
    rows = some_prints(160 if covering == 3 else 400, covering)
    least = {}
    for i, p in rows:
        least.setdefault(p, i)
    frame = spark.createDataFrame([(i, int(np.uint64(p).view(np.int64))) for p, i in least.items()], "id long, fp long")
    links = simhash.links(frame, len(least), covering=simhash.COVERINGS[covering][1], homes=8)
    got = {r.node: r.component for r in simhash.components(links).collect()}
    want = brute_components([(i, p) for p, i in least.items()])
    assert {i: got.get(i, i) for i in want} == want


def test_covering_codes_cover():
    rng = np.random.default_rng(0)
    for _, covering in simhash.COVERINGS:
        assert sum(b.width for b in covering) == 64
        for b in covering:
            masks, starts = b.near(b.radius)
            assert (np.diff(starts) > 0).all()  # every value has an anchor within the radius
            values = rng.integers(0, 1 << b.width, 50, dtype=np.uint64)
            anchors = values ^ masks[starts[b.checks(values)]]
            assert not b.checks(anchors).any()


def test_a_crowded_neighbourhood_is_cut(spark):
    base = random.Random(5).getrandbits(64)
    prints = [base ^ sum(1 << b for b in random.Random(i).sample(range(64), i % 4)) for i in range(500)]
    least = {}
    for i, p in enumerate(prints):
        least.setdefault(p, i)
    frame = spark.createDataFrame([(i, int(np.uint64(p).view(np.int64))) for p, i in least.items()], "id long, fp long")
    got = {r.node: r.component for r in simhash.components(simhash.links(frame, len(least), homes=16)).collect()}
    want = brute_components([(i, p) for p, i in least.items()])
    assert {i: got.get(i, i) for i in want} == want


def test_odd_rows(odd, odd_rows, none):
    rows = simhash.simhash_groups(odd).collect()
    assert len(rows) == len(odd_rows)
    by_text = {r[1]: brute_print(r[1]) for r in odd_rows}
    known = [(r[0], by_text[r[1]]) for r in odd_rows if r[0] is not None]
    want = brute_components(known)
    for r in rows:
        if r.doc_id is not None:
            assert r.component_id == want[r.doc_id]
    assert {r.component_id for r in rows if r.doc_id is None} == {5, None}
    out = simhash.drop_near(odd)
    assert out.columns == odd.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted([*map(str, set(want.values())), "None"])
    assert simhash.simhash_groups(none).count() == 0 and simhash.drop_near(none).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    got = {r.node: r.component for r in simhash.components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 300)}}


def test_different_texts_of_one_id_are_kept_apart(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(900)) for _ in range(60)) for _ in range(5)]
    rows = [(5, texts[0]), (5, texts[1]), (5, texts[1]), (6, texts[1]), (7, texts[2]), (7, texts[3]), (None, texts[4]), (None, texts[3]), (3, texts[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in simhash.drop_near(frame).collect() if r.doc_id is not None) == sorted(
        [(3, texts[0]), (5, texts[1]), (7, texts[2]), (7, texts[3])])
    assert [r.text for r in simhash.drop_near(frame).where("doc_id is null").collect()] == [texts[4]]
    got = sorted((str(r.doc_id), str(r.component_id)) for r in simhash.simhash_groups(frame).collect())
    assert got == sorted([("5", "3"), ("5", "5"), ("5", "5"), ("6", "5"), ("7", "7"), ("7", "7"), ("None", "None"), ("None", "7"), ("3", "3")])
