"""Toxicity by a weighted lexicon, matched with Aho-Corasick in texts whose disguises are folded."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.llm.common import crc_mod, short_batches, text_of

#: Labelled rows the classifier is fitted on at most, toxic and clean, those with the least hash of the id.
SAMPLE_TOXIC, SAMPLE_CLEAN = 6_000, 12_000
#: Lexicon entries, exception phrases, and the toxic documents an entry needs.
ENTRIES, EXCEPTIONS, SUPPORT = 4_000, 1_000, 3
#: Lengths of word beginnings that may be entries, beside whole words.
STEMS = range(4, 9)
#: Score from which a document counts as toxic.
THRESHOLD = 0.7

# Letters of other scripts, digits and signs that stand in for Latin letters.
LOOKALIKE = {
    "а": "a", "в": "b", "е": "e", "ё": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "һ": "h", "ӏ": "l", "ո": "n",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b",
}
#: Signs that stand for a letter inside a word, or at its beginning but for the exclamation mark. Elsewhere they are signs.
SIGNS = {"@": "a", "$": "s", "!": "i"}
_SIGN = re.compile(r"(?<=\w)[@$!](?=\w)|(?<!\S)[@$](?=\w)")


@lru_cache(maxsize=1)
def _folding() -> dict[int, str | None]:
    """Every code point that is not a letter of its own: compatibility forms, lookalikes, invisible marks, signs."""
    table: dict[int, str | None] = {}
    for point in (*range(0x80, 0x3100), *range(0xFB00, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F200)):
        char = chr(point)
        plain = unicodedata.normalize("NFKC", char).lower()
        kind = unicodedata.category(char)
        if kind in ("Mn", "Cf"):
            table[point] = None
        elif len(plain) == 1 and plain != char:
            table[point] = LOOKALIKE.get(plain, plain)
        elif kind[0] in "PSZC":
            table[point] = " "
    for point in range(0x80):
        char = chr(point)
        table[point] = char.lower() if char.isalnum() else " "
    table[ord("'")] = "'"
    return table | {ord(a): b for a, b in LOOKALIKE.items()}


def fold(text: str) -> str:
    """Words in lower case with lookalike letters and digits replaced, between single spaces."""
    if "$" in text or "!" in text or "@" in text:
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return f" {' '.join(text.translate(_folding()).split())} "


def features(folded: str) -> set[str]:
    """The entries that a text could match: its words and their beginnings."""
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in STEMS if len(word) >= n)
    return found


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()

    def automaton(self):
        """The entries and exceptions as an Aho-Corasick automaton; None without entries."""
        import ahocorasick

        if not self.weights:
            return None
        made = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            made.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            made.add_word(f" {phrase} ", (len(phrase) + 2, None))
        made.make_automaton()
        return made


def matches(folded: str, automaton) -> list[tuple[int, float]]:
    """(start, weight) of each word that matches: its longest entry counts, and none inside an exception phrase."""
    best: dict[int, tuple[int, float]] = {}
    spared: list[tuple[int, int]] = []
    if automaton is None:
        return []
    for end, (size, weight) in automaton.iter(folded):
        start = end - size + 1
        if weight is None:
            spared.append((start, end))
        elif size > best.get(start, (0, 0.0))[0]:
            best[start] = size, weight
    return [(s, w) for s, (_, w) in best.items() if not any(a <= s < b for a, b in spared)]


def measures(folded: str, hits: Sequence[tuple[int, float]]) -> list[float]:
    """Matched weight as it is, for each hundred words (both damped), and the heaviest match."""
    weight, length = sum(w for _, w in hits), folded.count(" ")
    return [math.log1p(weight), math.log1p(100 * weight / max(length, 20)), max((w for _, w in hits), default=0.0)]


@dataclass
class Model:
    lexicon: Lexicon
    intercept: float
    slopes: tuple[float, ...]

    def score(self, values: Sequence[float]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.intercept + sum(a * b for a, b in zip(self.slopes, values))))))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Intercept and slopes by Newton steps, with a slight pull to zero; slopes below zero are left out."""
    design = np.column_stack([np.ones(len(x)), x])
    used = np.ones(design.shape[1], dtype=bool)
    while True:
        beta, sub = np.zeros(int(used.sum())), design[:, used]
        pull = np.full(len(beta), 1.0)
        pull[0] = 1e-3
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(sub @ beta, -30, 30)))
            slope = sub.T @ (weight * (y - p)) - pull * beta
            curve = (sub * (weight * p * (1 - p))[:, None]).T @ sub + np.diag(pull)
            step = np.linalg.solve(curve, slope)
            beta += np.clip(step, -5, 5)
            if np.abs(step).max() < 1e-8:
                break
        wrong = np.flatnonzero(used)[1:][beta[1:] < 0]
        if not len(wrong):
            out = np.zeros(design.shape[1])
            out[used] = beta
            return out
        used[wrong] = False


def _count(rows: DataFrame) -> DataFrame:
    """(entry, t0, c0, t1, c1): toxic and clean documents with the entry, by half of the sample."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(4)]
        for batch in batches:
            for text, half, toxic in zip(*(batch.column(c).to_pylist() for c in ("text", "half", "toxic"))):
                counts[2 * half + (not toxic)].update(features(fold(text)))
            if sum(map(len, counts)) > 150_000:
                yield out(counts)
                counts = [Counter() for _ in range(4)]
        yield out(counts)

    def out(counts: list[Counter]) -> pa.RecordBatch:
        entries = sorted(set().union(*counts))
        return pa.record_batch([pa.array(entries, pa.string())] + [
            pa.array([c[e] for e in entries], pa.int64()) for c in counts], names=["entry", "t0", "c0", "t1", "c1"])

    got = rows.mapInArrow(each, "entry string, t0 long, c0 long, t1 long, c1 long")
    return got.groupBy("entry").agg(*[F.sum(c).alias(c) for c in ("t0", "c0", "t1", "c1")])


def _lexicon(counts: list, use: Sequence[int], toxic: int, clean: int) -> dict[str, float]:
    """Entries with their smoothed log odds, where toxic documents have them clearly more often."""
    out = {}
    for row in counts:
        t, c = (sum(row[f"{kind}{h}"] for h in use) for kind in "tc")
        if t >= SUPPORT:
            odds = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
            if odds - 1.0 / math.sqrt(t) >= 1.0:
                out[row["entry"]] = odds
    return out


def learn(docs: DataFrame, labels: DataFrame, exceptions: Sequence[str] = ()) -> Model:
    """Fit lexicon, exception phrases and calibration on labelled rows outside the held-out fold.

    A bounded sample of labelled rows is used (``SAMPLE_TOXIC``, ``SAMPLE_CLEAN``): the ids with the least hash.
    Entries and their weights come from all of it; the calibration sees each half through the entries
    of the other. Rows without label or document, and ids labelled both ways, say nothing. Without any
    label, no text is toxic.
    """
    short_batches(docs.sparkSession)
    known = (
        labels.where("toxic is not null and doc_id is not null").where(crc_mod("doc_id", 3) != 1)
        .groupBy(F.col("doc_id").alias("l_id")).agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
        .where("toxic = most").select("l_id", "toxic", F.xxhash64("l_id").alias("h")))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = known.where("toxic = 1").orderBy("h", "l_id").limit(SAMPLE_TOXIC).union(
        known.where("toxic = 0").orderBy("h", "l_id").limit(SAMPLE_CLEAN))
    sample = (
        docs.select("doc_id", text_of().alias("text")).join(F.broadcast(picked), F.col("doc_id") == F.col("l_id"))
        .select("text", "toxic", F.pmod("h", F.lit(2)).cast("int").alias("half")))
    sample = sample.persist()
    n = {(r["toxic"], r["half"]): r["count"] for r in sample.groupBy("toxic", "half").count().collect()}
    both = [n.get((1, h), 0) for h in (0, 1)], [n.get((0, h), 0) for h in (0, 1)]
    if not sum(both[0]) or not sum(both[1]):
        sample.unpersist()
        return Model(Lexicon({}, tuple(exceptions)), -30.0, (0.0, 0.0, 0.0))
    t, c = F.col("t0") + F.col("t1"), F.col("c0") + F.col("c1")
    lift = F.log((t + 0.5) / (sum(both[0]) + 1)) - F.log((c + 0.5) / (sum(both[1]) + 1))
    counts = (_count(sample).where(t >= SUPPORT).where(lift >= 1.0)
              .orderBy((lift * F.sqrt(t)).desc(), "entry").limit(ENTRIES).collect())
    halves = [Lexicon(_lexicon(counts, [1 - h], both[0][1 - h], both[1][1 - h])) for h in (0, 1)]

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Matches of each text by the other half's entries, and the phrases around them."""
        made = [x.automaton() for x in halves]
        for batch in batches:
            rows = []
            for text, toxic, half in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "half"))):
                folded = fold(text)
                hits = matches(folded, made[half])
                around = set()
                for start, _ in hits:
                    left = folded.rfind(" ", 0, start) if start else 0
                    stop = folded.find(" ", start + 1)
                    after = folded.find(" ", stop + 1)
                    around.add(folded[left:stop].strip())
                    around.add(folded[start:after if after > 0 else stop].strip())
                rows.append((toxic, measures(folded, hits), sorted(p for p in around if " " in p)))
            yield pa.record_batch([
                pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.float64())),
                pa.array([r[2] for r in rows], pa.list_(pa.string()))], names=["toxic", "x", "phrases"])

    seen = sample.mapInArrow(phrases, "toxic int, x array<double>, phrases array<string>").persist()
    # Phrases that clean documents share and toxic ones do not, though they hold an entry.
    spared = (
        seen.select("toxic", F.explode("phrases").alias("phrase")).groupBy("phrase")
        .agg(F.sum(F.col("toxic")).alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
        .where(f"c >= 5 and t * {sum(both[1])} * 4 < c * {sum(both[0])}").orderBy(F.desc("c"), "phrase").limit(EXCEPTIONS))
    learned = [r["phrase"] for r in spared.collect()]
    rows = seen.select("toxic", "x").collect()
    seen.unpersist()
    sample.unpersist()
    y = np.array([r["toxic"] for r in rows], dtype=float)
    # Each class counts as often as it is labelled, whatever the sample holds of it.
    weight = np.where(y == 1, sizes[1] / max(y.sum(), 1), sizes[0] / max((1 - y).sum(), 1))
    beta = fit_logistic(np.array([r["x"] for r in rows]), y, weight / weight.mean())
    lexicon = Lexicon(_lexicon(counts, [0, 1], sum(both[0]), sum(both[1])), (*exceptions, *learned))
    return Model(lexicon, float(beta[0]), tuple(map(float, beta[1:])))


def score_column(spark: SparkSession, model: Model, text: str = "text") -> Column:
    """The score of each row's text. A null text counts as empty and matches nothing."""
    short_batches(spark)
    held = spark.sparkContext.broadcast(model)  # bounded by ENTRIES and EXCEPTIONS

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = held.value
        automaton = own.lexicon.automaton()
        for texts in batches:
            folded = map(fold, (t.as_py() for t in texts))
            yield pa.array([own.score(measures(f, matches(f, automaton))) for f in folded], pa.float64())

    return score(text_of(text))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
             exceptions: Sequence[str] = ()) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted.

    The score reads the text alone. A null or empty text has the score of a text without matches. Rows that
    repeat a doc_id are scored each; an empty table gives no rows; other columns are not read.
    """
    score = score_column(docs.sparkSession, learn(docs, labels, exceptions))
    return docs.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text is predicted toxic, all columns as they are."""
    return docs.where(score_column(docs.sparkSession, learn(docs, labels)) < threshold)
