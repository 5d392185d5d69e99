import pyarrow as pa
import pytest

from salescast.llm import common

TEXTS = ["aé B\tc", None, "", "  x ", "É ÀB 中\x0b文\x0cy", "a\x1cb\x85c d", "one", "z" * 300 + " y"] * 5


def want(texts):
    return [[w.decode() for w in (t or "").encode().lower().split()] for t in texts]


@pytest.mark.parametrize("first, many", [(0, 40), (3, 5), (7, 20), (39, 1), (5, 0)])
def test_words_of_slices(first, many):
    got = common.words_of(pa.array(TEXTS, pa.string()).slice(first, many))
    assert got.to_pylist() == want(TEXTS[first:first + many])
    got.validate(full=True)


@pytest.mark.parametrize("most", [1, 7, 50, 10_000])
def test_batches_by_size_keep_all_rows_in_order(most):
    batches = [pa.record_batch([pa.array(TEXTS[i:i + 6], pa.string()), pa.array(range(i, min(i + 6, 40)))], names=["text", "i"])
               for i in range(0, 40, 6)]
    got = list(common.batches_by_size(iter(batches), "text", most))
    assert [i for b in got for i in b.column("i").to_pylist()] == list(range(40))
    assert [t for b in got for t in b.column("text").to_pylist()] == TEXTS
    assert [w for b in got for w in common.words_of(b.column("text")).to_pylist()] == want(TEXTS)
    assert all(b.num_rows == 1 or sum(len((t or "").encode()) for t in b.column("text").to_pylist()) <= most for b in got)


@pytest.mark.parametrize("most, want", [(0, []), (1, [9]), (2, [9]), (3, [9, 5, 5]), (5, [9, 5, 5, 2]), (100, [9, 5, 5, 2, 1, 1, 1])])
def test_frequent_rows(spark, most, want):
    rows = spark.createDataFrame([(x,) for x in (1, 5, 2, 1, 9, 5, 1)], "c long")
    assert sorted((r.c for r in common.frequent(rows, "c", most).collect()), reverse=True) == want
    assert common.frequent(rows.limit(0), "c", most).count() == 0
