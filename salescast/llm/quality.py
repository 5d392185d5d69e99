"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of characters."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import batches_by_size, frequent, short_batches, text_of
from salescast.staging import materialize

#: Characters of an n-gram; what stands before the first character of a text.
ORDER, EDGE = 5, "\n"
#: Trusted documents the model is trained on at most (those with the least hash of the id), None for all; and the share
#: kept apart for the thresholds: one in so many.
TRUSTED, APART = None, 3
#: Ids that go to all tasks; more are joined by shuffle.
SENT = 2_000_000
#: Most frequent n-grams of the corpus whose probabilities go to all tasks. Those of the others are joined.
COMMON = 1 << 19
#: A text is kept up to this quantile of the perplexity of trusted texts in its language.
QUANTILE = 0.98
#: Bytes of text worked on at a time, and n-grams a task counts before it hands them on.
BATCH, HELD = 2 << 20, 1_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts, each after ORDER - 1 edges, and where in them each text's n-grams end."""
    pad = EDGE * (ORDER - 1)
    flat = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le"), dtype=np.uint32)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    starts = np.cumsum(lengths + ORDER - 1) - lengths
    at = np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return flat, at


def _keys(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit key of the n-gram that ends at each place."""
    ends = max(len(flat) - ORDER + 1, 0)
    key = np.zeros(ends, dtype=np.uint64)
    for first in range(ORDER):
        key = (key ^ flat[first:first + ends].astype(np.uint64)) * _MIX
        key ^= key >> np.uint64(29)
    return key[at - (ORDER - 1)]


def _grams(flat: np.ndarray, at: np.ndarray) -> list[str]:
    """The n-grams that end at these places."""
    rows = np.ascontiguousarray(flat[at[:, None] - np.arange(ORDER - 1, -1, -1)])
    joined = rows.tobytes().decode("utf-32-le")
    return [joined[i:i + ORDER] for i in range(0, len(joined), ORDER)]


def gram_keys(grams: list[str]) -> np.ndarray:
    """The key of each n-gram."""
    flat, at = _points(grams)
    # Only the last character of an n-gram ends one; its own characters stand in place of the edges.
    return _keys(flat, at.reshape(-1, ORDER)[:, -1]) if grams else np.zeros(0, dtype=np.uint64)


class Counts:
    """Numbers of n-grams, in all texts and in trusted ones, under exact keys: twelve bits a character.

    The characters are numbered as they come. Where they are more than twelve bits can number, what is counted so
    far is handed on and the numbering begins anew.
    """

    BITS = 12

    def __init__(self) -> None:
        self.numbers = np.full(0x110000, -1, dtype=np.int32)
        self.alphabet = np.zeros(0, dtype=np.uint32)
        self.runs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, flat: np.ndarray, at: np.ndarray, trains: np.ndarray) -> Iterator[tuple[list[str], np.ndarray]]:
        """Count the n-grams that end at these places; yields what has to be handed on before."""
        if not len(at):
            return
        flat = flat[at[0] - (ORDER - 1):at[-1] + 1]
        at = at - at[0] + (ORDER - 1)
        new = np.unique(flat[self.numbers[flat] < 0])
        if len(self.alphabet) + len(new) > 1 << self.BITS:
            yield from self.take()
            if len(at) > 1 and len(np.unique(flat)) > 1 << self.BITS:
                half = len(at) // 2
                for part in (slice(None, half), slice(half, None)):
                    yield from self.add(flat, at[part], trains[part])
                return
            new = np.unique(flat)
        self.numbers[new] = len(self.alphabet) + np.arange(len(new))
        self.alphabet = np.concatenate([self.alphabet, new])
        codes = self.numbers[flat].astype(np.uint64)
        ends = len(codes) - ORDER + 1
        key = np.zeros(ends, dtype=np.uint64)
        for first in range(ORDER):
            key = (key << np.uint64(self.BITS)) | codes[first:first + ends]
        key = key[at - (ORDER - 1)]
        keys, n = self._sums(np.sort(key))
        trusted = np.zeros(len(keys), dtype=np.int64)
        own, times = self._sums(np.sort(key[trains]))
        trusted[np.searchsorted(keys, own)] = times
        self.runs.append((keys, np.stack([n, trusted], 1)))
        if sum(len(k) for k, _ in self.runs) > HELD:
            self._merge()
            if len(self.runs[0][0]) > HELD // 2:
                yield from self.take()

    @staticmethod
    def _sums(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values of a sorted array, and how often each stands there."""
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
        return keys[first], np.diff(np.append(first, len(keys)))

    def _merge(self) -> None:
        keys, sums = np.concatenate([k for k, _ in self.runs]), np.concatenate([c for _, c in self.runs])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        self.runs = [(keys[first], np.add.reduceat(sums[order], first))]

    def take(self) -> Iterator[tuple[list[str], np.ndarray]]:
        """The n-grams counted so far and their numbers; the counts begin anew."""
        if self.runs:
            self._merge()
            keys, sums = self.runs[0]
            places = np.arange(ORDER - 1, -1, -1, dtype=np.uint64) * np.uint64(self.BITS)
            codes = (keys[:, None] >> places) & np.uint64((1 << self.BITS) - 1)
            joined = np.ascontiguousarray(self.alphabet[codes.astype(np.int64)]).tobytes().decode("utf-32-le")
            yield [joined[i:i + ORDER] for i in range(0, len(joined), ORDER)], sums
        self.runs = []
        self.numbers[self.alphabet] = -1
        self.alphabet = self.alphabet[:0]


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(gram, n, trusted): how often each n-gram stands in the rows, and in those with ``trains``.

    A task adds up sorted runs of keys, so that what it hands on is bounded by its distinct n-grams.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for batch in batches_by_size(batches, "text", BATCH):
            texts = batch.column("text").to_pylist()
            trains = np.repeat(batch.column("trains").to_numpy(zero_copy_only=False), [len(t) for t in texts]).astype(bool)
            for part in counts.add(*_points(texts), trains):
                yield out(*part)
        for part in counts.take():
            yield out(*part)

    def out(grams: list[str], sums: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(grams, pa.string()), pa.array(sums[:, 0]), pa.array(sums[:, 1])],
                               names=["gram", "n", "trusted"])

    got = docs.select("text", "trains").mapInArrow(each, "gram string, n long, trusted long")
    return got.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("trusted").alias("trusted"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """What is taken off counts of 1, 2, and 3 or more; fixed shares where the counts of counts give none."""
    n = [None, n1 or 0, n2 or 0, n3 or 0, n4 or 0]
    if not (n[1] and n[2]):
        return 0.5, 1.0, 1.5
    y = n[1] / (n[1] + 2 * n[2])
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] else 0.0
        out.append(d if 0 < d < k else k / 2)
    return tuple(out)


def kneser_ney(grams: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order from 1 to ORDER: (gram, p) of the seen n-grams, and (context, back), the share of what is left.

    ``grams`` has (gram, c) of the highest order. The count of a shorter n-gram is the number of characters seen before
    it. Every order is a count by n-gram and a count by context, joined to the order below.
    """
    counts = {ORDER: grams}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = materialize(
            counts[k + 1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("c")), f"grams-{k}")
    out: list[tuple[DataFrame, DataFrame]] = []
    for k in range(1, ORDER + 1):
        rows = counts[k]
        d = discounts(*rows.agg(*[F.sum((F.col("c") == i).cast("long")) for i in (1, 2, 3, 4)]).first())
        off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        named = rows.select("gram", "c", F.substring("gram", 1, k - 1).alias("context"), off.alias("off"))
        contexts = materialize(named.groupBy("context").agg(F.sum("c").alias("total"), F.sum("off").alias("off_all"))
                               .select("context", "total", (F.col("off_all") / F.col("total")).alias("back")), f"contexts-{k}")
        share = (F.col("c") - F.col("off")) / F.col("total")
        joined = named.join(contexts, "context")
        if k == 1:
            # Characters never seen share what is left with the seen ones, as one more character.
            kinds = rows.count() + 1
            probs = joined.select("gram", (share + F.col("back") / kinds).alias("p"))
        else:
            below = out[-1][0].select(F.col("gram").alias("short"), F.col("p").alias("p_short"))
            probs = joined.join(below, F.substring("gram", 2, k - 1) == F.col("short")).select(
                "gram", (share + F.col("back") * F.col("p_short")).alias("p"))
        out.append((materialize(probs, f"kneser-ney-{k}"), contexts.select("context", "back")))
    return out


def log_probabilities(grams: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """``grams`` (with gram) and ``log_p``, the natural logarithm of the last character given those before it.

    From the highest order down: the probability of the seen n-gram; else what its context leaves, where that was
    seen, times the probability one order lower.
    """
    least = model[0][1].first()
    kinds = model[0][0].count() + 1
    unseen = math.log((least["back"] if least else 1.0) / kinds)
    rows = grams.withColumn("log_p", F.lit(None).cast("double")).withColumn("left", F.lit(0.0))
    for k in range(ORDER, 0, -1):
        probs, contexts = model[k - 1]
        tail = F.substring("gram", ORDER - k + 1, k)
        rows = (rows.withColumn("tail", tail).withColumn("before", F.substring("tail", 1, k - 1))
                .join(probs.select(F.col("gram").alias("tail"), "p"), "tail", "left")
                .join(contexts.select(F.col("context").alias("before"), "back"), "before", "left"))
        hit = F.col("log_p").isNull() & F.col("p").isNotNull()
        rows = rows.withColumn("log_p", F.when(hit, F.col("left") + F.log("p")).otherwise(F.col("log_p")))
        rows = rows.withColumn("left", F.when(
            F.col("log_p").isNull() & F.col("back").isNotNull() & F.lit(k > 1), F.col("left") + F.log("back")).otherwise(F.col("left")))
        rows = rows.drop("tail", "before", "p", "back")
    return rows.withColumn("log_p", F.coalesce("log_p", F.col("left") + unseen)).drop("left")


class Lookup:
    """Values of 64-bit keys: a table with one place a key, and a sorted rest for keys whose place was taken."""

    BITS = 21

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys = np.zeros(1 << self.BITS, dtype=np.uint64)
        self.values = np.full(1 << self.BITS, np.nan)
        place = self._place(keys)
        _, first = np.unique(place, return_index=True)
        self.keys[place[first]], self.values[place[first]] = keys[first], values[first]
        rest = np.ones(len(keys), dtype=bool)
        rest[first] = False
        order = np.argsort(keys[rest])
        self.rest_keys, self.rest_values = keys[rest][order], values[rest][order]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.BITS)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Values, NaN for keys that are not there."""
        place = self._place(keys)
        out = np.where(self.keys[place] == keys, self.values[place], np.nan)
        lost = np.flatnonzero(np.isnan(out))
        if len(lost) and len(self.rest_keys):
            at = np.minimum(np.searchsorted(self.rest_keys, keys[lost]), len(self.rest_keys) - 1)
            out[lost] = np.where(self.rest_keys[at] == keys[lost], self.rest_values[at], np.nan)
        return out


_SUMS = "uid long, doc_id long, lang string, chars long, common double, rare array<string>, times array<int>"


def _score(batches: Iterator[pa.RecordBatch], held: Broadcast) -> Iterator[pa.RecordBatch]:
    """Log probability of each text's common n-grams, and its other n-grams with their number."""
    lookup = Lookup(*held.value)
    uid = TaskContext.get().partitionId() << 33
    for batch in batches_by_size(batches, "text", BATCH):
        texts = batch.column("text").to_pylist()
        flat, at = _points(texts)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        keys = _keys(flat, at)
        found = lookup(keys)
        doc = np.repeat(np.arange(len(texts)), lengths)
        lost = np.flatnonzero(np.isnan(found))
        common = np.bincount(doc, np.nan_to_num(found), len(texts)).astype(float)
        order = lost[np.lexsort((keys[lost], doc[lost]))]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (doc[order][1:] != doc[order][:-1]) | (keys[order][1:] != keys[order][:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(order)))
        ends = np.searchsorted(doc[order[first]], np.arange(len(texts) + 1))
        rare = pa.array(_grams(flat, at[order[first]]) if len(first) else [], pa.string())
        yield pa.record_batch([
            pa.array(uid + np.arange(len(texts))), batch.column("doc_id"), batch.column("lang"),
            pa.array(lengths), pa.array(common), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(times, pa.int32()))],
            names=["uid", "doc_id", "lang", "chars", "common", "rare", "times"])
        uid += len(texts)


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """One row a document: doc_id, lang, perplexity, threshold, kept.

    Documents labelled as good are trusted; a fixed share of them is kept apart, and the model learns from all
    others (unless ``TRUSTED`` bounds them). Perplexity
    is that of a character given the four before it, over the whole text; every n-gram of every text is scored, frequent ones from
    a table that goes to all tasks, the others by a join. A language's threshold is the given quantile of the perplexity of its
    trusted documents kept apart, however many they are, and that of all languages where it has none.

    A null or empty text has no perplexity and is not kept. A null lang is a language. Ids labelled both ways are not
    trusted; without trusted documents no threshold exists and every text with a character is kept. Rows that repeat a doc_id
    are scored each; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    short_batches(spark)
    trusted = materialize(
        labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").alias("l_id"))
        .agg(F.min("quality").alias("quality")).where("quality = 1").withColumn("h", F.xxhash64("l_id"))
        .select("l_id", "h", (F.pmod("h", F.lit(APART)) == 0).alias("apart")), "trusted-ids")
    picked = trusted.where("not apart")
    if TRUSTED is not None:
        picked = picked.orderBy("h", "l_id").limit(TRUSTED)
    picked = picked.select(F.col("l_id").alias("p_id"))
    if picked.count() <= SENT:
        picked = F.broadcast(picked)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", text_of().alias("text"))
    marked = given.join(picked, F.col("doc_id") == F.col("p_id"), "left").select("text", F.col("p_id").isNotNull().alias("trains"))
    counts = materialize(corpus_counts(marked), "corpus-grams")
    model = kneser_ney(materialize(counts.where("trusted > 0").select("gram", F.col("trusted").alias("c")), "trusted-grams"))
    scored = materialize(log_probabilities(counts.select("gram", "n"), model), "gram-scores")
    top = frequent(scored, "n", COMMON).select("gram", "log_p").toArrow()
    held = spark.sparkContext.broadcast((gram_keys(top.column("gram").to_pylist()), top.column("log_p").to_numpy()))
    sums = materialize(given.select("doc_id", "lang", "text").mapInArrow(lambda it: _score(it, held), _SUMS), "perplexity")
    rare = (
        sums.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("r"))
        .select("uid", F.col("r.rare").alias("r_gram"), F.col("r.times").alias("times"))
        .join(scored.select("gram", "log_p"), F.col("r_gram") == F.col("gram"))
        .groupBy(F.col("uid").alias("r_uid")).agg(F.sum(F.col("times") * F.col("log_p")).alias("rest")))
    whole = sums.drop("rare", "times").join(rare, F.col("uid") == F.col("r_uid"), "left")
    perplexity = F.when(F.col("chars") > 0, F.exp(-(F.col("common") + F.coalesce("rest", F.lit(0.0))) / F.col("chars")))
    each = materialize(whole.select("doc_id", "lang", perplexity.alias("perplexity")), "perplexities")
    held_back = each.where("perplexity is not null").join(
        trusted.where("apart").select("l_id"), F.col("doc_id") == F.col("l_id"), "left_semi")
    level = F.percentile_approx("perplexity", quantile, 10_000)
    by_lang = held_back.groupBy(F.col("lang").alias("t_lang")).agg(level.alias("own"))
    overall = held_back.agg(level).first()[0]
    return (each.join(by_lang, F.col("lang").eqNullSafe(F.col("t_lang")), "left")
            .withColumn("threshold", F.coalesce("own", F.lit(overall).cast("double")))
            .select("doc_id", "lang", "perplexity", "threshold", F.coalesce(
                F.col("perplexity") <= F.coalesce("threshold", F.lit(float("inf"))), F.lit(False)).alias("kept")))
