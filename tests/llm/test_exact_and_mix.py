import collections
import hashlib

from pyspark.sql import functions as F

from salescast.llm import exact, mixing


def brute_groups(rows):
    by_text = collections.defaultdict(list)
    for r in rows:
        by_text[r[1] or ""].append(r[0])
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in by_text.items()}
    return collections.Counter((r[0], top[r[1] or ""], len(by_text[r[1] or ""]), hashlib.sha256((r[1] or "").encode()).hexdigest())
                               for r in rows)


def groups(frame, **kw):
    return collections.Counter(tuple(r) for r in exact.exact_groups(frame, **kw).select(
        "doc_id", "keep_id", "group_size", "text_sha256").collect())


def test_chunks_make_up_the_text(spark, documents, odd):
    for frame in (documents.select("text"), odd.select("text")):
        cut = frame.where("text is not null").select("text", exact.chunks(F.col("text")).alias("c"))
        assert cut.where(F.array_join("c", "") != F.col("text")).count() == 0
        assert cut.where(F.exists("c", lambda c: F.length(c) > 8192)).count() == 0


def test_groups_on_odd_rows(odd, odd_rows):
    assert groups(odd) == brute_groups(odd_rows)


def test_colliding_fingerprints_change_nothing(documents, odd, odd_rows):
    weak = lambda c: F.pmod(F.length(c), F.lit(3)).cast("long")
    assert groups(odd, fingerprint=weak) == brute_groups(odd_rows)
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert groups(documents, fingerprint=weak) == brute_groups(rows)


def test_one_row_of_each_group_stays(odd, odd_rows, documents, none):
    out = exact.drop_exact(odd)
    assert out.columns == odd.columns
    assert sorted(r.text or "" for r in out.collect()) == sorted({r[1] or "" for r in odd_rows})
    assert {r.doc_id for r in exact.drop_exact(documents).select("doc_id").collect()} == {
        r.doc_id for r in exact.exact_groups(documents).where("kept").collect()}
    assert exact.exact_groups(none).count() == 0 and exact.drop_exact(none).count() == 0
    flags = exact.exact_groups(odd).groupBy("text_sha256").agg(F.sum(F.col("kept").cast("int")).alias("k"))
    assert {r.k for r in flags.collect()} == {1}


def brute_targets(sizes, weights=mixing.WEIGHTS, share=mixing.SHARE):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if level * w[s] > 2 * sizes[s]]
        if not over:
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
            free.discard(s)
    return out | {s: level * w[s] for s in free}


def test_targets_and_words_taken(spark, documents):
    rows = documents.select("doc_id", "source").join(mixing.mix_counts(documents), "doc_id").collect()
    sizes = collections.Counter()
    taken = collections.Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    want = brute_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
    for s, target in want.items():
        largest = max(r.size for r in rows if r.source == s)
        assert abs(taken[s] - target) <= largest / 2 + 1e-6


def test_targets_reshare_until_none_is_above(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 300, None: 40}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    want = brute_targets(sizes)
    assert all(abs(got[s] - want[s]) < 1e-9 for s in want)
    assert got["c"] == 10.0 and got["a"] == 20.0


def test_draws_follow_the_inclusion_probabilities(spark):
    # Larger documents are taken more often, in proportion to their size, and the words come out right each time.
    frame = spark.createDataFrame([(i * i, "s", 10 if i % 2 else 20) for i in range(2000)], "key long, source string, size long")
    took = collections.Counter()
    for seed in range(3):
        plan = mixing.plan_mix(frame, share=0.3, seed=seed)
        now = collections.Counter()
        for r in mixing._counted(frame, plan, seed).select("size", "copies").collect():
            now[r.size] += r.copies
        assert abs(now[10] * 10 + now[20] * 20 - 9000) <= 10
        took += now
    assert 1.8 < took[20] / took[10] < 2.2


def test_mix_repeats_whole_rows(odd, odd_rows, none):
    counts = mixing.mix_counts(odd)
    assert counts.count() == len(odd_rows)
    out = mixing.mix(odd)
    assert out.columns == odd.columns
    assert out.count() == counts.agg(F.sum("copies")).first()[0]
    again = mixing.mix_counts(odd.repartition(5))
    assert sorted(map(str, counts.collect())) == sorted(map(str, again.collect()))
    assert mixing.mix_counts(none).count() == 0 and mixing.mix(none).count() == 0


def test_a_hot_source_among_small_ones(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", "w " * (1 + i * 37 % 90)) for i in range(3000)]
    out = mixing.mix_counts(spark.createDataFrame(rows, "doc_id long, source string, text string")).toPandas()
    out["source"] = [rows[i][1] for i in out.doc_id]
    by = out.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"))
    assert (abs(by.target - by.taken) <= 45).all()


def words_and_targets(frame, sources):
    out = mixing.mix_counts(frame).toPandas()
    assert len(out) == frame.count()
    by = out.groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"))
    assert len(by) == sources
    return [(r.target, r.taken) for r in by.itertuples()]


def test_rows_without_an_id_or_with_one_that_repeats_are_drawn_apart(spark):
    """A third of the rows without an id, a third with one and the same, and a fifth equal throughout: the mark is met to half a document."""
    def row(i):
        if i % 3 == 0:
            return None, "a", "w " * (1 + i % 50) + str(i)
        if i % 3 == 1:
            return 7, "a", "w " * (1 + i % 50) + str(i)
        return (i, "a", "x " * (1 + i % 40)) if i % 5 else (8, "a", "same words here again " * 5)

    rows = [row(i) for i in range(6000)] + [(i, f"s{i % 5}", "v " * (i % 60 + i % 5)) for i in range(10_000, 16_000)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for target, taken in words_and_targets(frame, 6):
        assert abs(target - taken) <= 33, (target, taken)


def test_many_equal_rows_are_numbered_in_chunks(spark, monkeypatch):
    rows = [(1, "a", "one two three", i % 3) for i in range(2000)] + [(i, "b", "w " * (i % 30), 0) for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string, extra int")
    want = sorted(map(tuple, mixing.mix_counts(frame).collect()))
    total = sum(r[-1] for r in want)
    monkeypatch.setattr(mixing, "CHUNK", 64)
    assert sorted(map(tuple, mixing.mix_counts(frame.repartition(9)).collect())) == want
    one, two = (sorted(map(tuple, mixing.mix(frame.repartition(n)).collect())) for n in (2, 7))
    assert one == two and sum(len(r[2].split()) for r in one) == total


def test_the_same_row_stays_however_rows_are_dealt(spark):
    rows = [(1, "a b c d e", f"s{i}") for i in range(12)] + [(None, "a b c d e f", f"t{i}") for i in range(9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    from salescast.llm import simhash

    for drop in (exact.drop_exact, simhash.drop_near):
        kept = {tuple(sorted(map(str, drop(frame.repartition(n)).collect()))) for n in (1, 3, 7)}
        assert len(kept) == 1


def test_exact_dedup_stays_in_the_jvm(documents):
    for df in (exact.exact_groups(documents), exact.drop_exact(documents)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "InPandas" not in text
