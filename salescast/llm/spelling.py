"""Spelling variants of words by pivotal grams."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import batches_by_size, short_batches
from salescast.llm.runs import split_homes
from salescast.staging import materialize

#: What a run of letters is, the least code points and occurrences of a word, how many times as
#: frequent a form is, and the divisor of the hash that takes a letter out of a run.
LETTERS, LENGTH, OCCURRENCES, TIMES, EVERY = "A-Za-zÀ-ÿ", 6, 5, 5, 199
#: One edit destroys at most two of a word's bigrams, so of three at least one is left, and of two that share no letter
#: at least one.
EDITS, GRAM = 1, 2
PREFIX, PIVOTS = GRAM * EDITS + 1, EDITS + 1
#: A context of fewer letters than this says little, so the other end of the word is added, of so many letters.
CONTEXT, END = 6, 3
#: Bytes of text that are counted together, and pivots in a part of a crowded key.
BATCH, HOMES = 8 << 20, 1_024


def count_words(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """(word, n): the words of all texts with enough letters and occurrences, after some runs have lost a letter.

    Each task adds up the words of a batch of texts before anything is shuffled.
    """
    short_batches(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(f"[{LETTERS}]{{{LENGTH},}}").findall  # a shorter run cannot become a word
        crc = zlib.crc32
        for batch in batches_by_size(batches, "text", BATCH):
            found: Counter[str] = Counter()
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, pc.ascii_lower(batch.column("text")).to_pylist(), strict=True):
                own = Counter(runs(text))
                start = crc(b":" if doc_id is None else b"%d:" % doc_id)
                for word, n in own.items():
                    h = crc(word.encode(), start)
                    if not h % every:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < LENGTH:
                            continue
                    found[word] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(each, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OCCURRENCES)


def prefix_and_pivots(ranks: list[int], costs: list[int]) -> tuple[int, list[int], list[int]]:
    """(largest rank of the prefix, places of its grams, places of the pivots) of a word's grams in order.

    The prefix holds the rarest grams, with all that equal its last one. The pivots are the grams of the prefix that share no letter and
    cost least in sum: ``best[k][i]`` is the least cost of k pivots among the grams before place i, and a gram at place i
    follows on the best choice of one pivot less that ends ``GRAM`` places before.
    """
    last = sorted(ranks)[PREFIX - 1]
    prefix = [i for i, r in enumerate(ranks) if r <= last]
    none = (float("inf"), ())
    best = [[(0, ())] * (len(ranks) + 1)] + [[none] for _ in range(PIVOTS)]
    for i, (r, cost) in enumerate(zip(ranks, costs, strict=True)):
        for k in range(1, PIVOTS + 1):
            now = best[k][i]
            if r <= last:
                before, places = best[k - 1][max(i + 1 - GRAM, 0)]
                now = min(now, (before + cost, (*places, i)))
            best[k].append(now)
    return last, prefix, list(best[PIVOTS][-1][1])


def keys(word: str, places: list[int]) -> set[str]:
    """What a word with grams at ``places`` is filed under, so that a word with one of them, one edit away, has a common key.

    An edit that leaves a gram whole is on its right or on its left. On the right, the word up to the gram is left as it
    is, so the gram keeps its place; on the left, the word from the gram on is left, so it keeps its place from the end. That context
    says more than a limit to the place. Where it is short, there are two more cases: the far end of the word is left
    as well and joins the key, or it is not, and then everything else is left: all but ``END`` letters of the shorter word.
    """
    out = set()
    lengths = [m for m in (len(word), len(word) - 1) if m >= LENGTH]  # of the shorter word
    for i in places:
        for side, context, whole, end in (("<", word[:i + GRAM], word, word[-END:]), (">", word[i:][::-1], word[::-1], word[:END])):
            if len(context) >= CONTEXT:
                out.add(side + context)
                continue
            out.add(f"{side}{context} {end}")
            out.update(f"{side}{m} {whole[:max(len(context), m - END)]}" for m in lengths)
    return out


def postings(words: DataFrame) -> DataFrame:
    """(cell, id, last, home): where each word is indexed, by its pivots (``home``), and looked up, by its whole prefix.

    Grams are ordered by the number of words that hold them, then by their letters. The table of grams has at most one
    row a pair of letters.
    """
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.char_length("word") - 1), lambda i: F.substr("word", i, F.lit(GRAM)))).alias("gram"))
    counted = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "gram").collect()
    order = words.sparkSession.sparkContext.broadcast({r.gram: (i, r.n) for i, r in enumerate(counted)})

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = order.value
        for batch in batches:
            cells, ids, lasts, homes = [], [], [], []
            for word in batch.column("word").to_pylist():
                found = [known[word[i:i + GRAM]] for i in range(len(word) - GRAM + 1)]
                last, prefix, pivots = prefix_and_pivots([r for r, _ in found], [n for _, n in found])
                own, looked_up = keys(word, pivots), keys(word, prefix)
                cells += looked_up
                homes += [c in own for c in looked_up]
                ids += [word] * len(looked_up)
                lasts += [last] * len(looked_up)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.string()), pa.array(ids, pa.string()), pa.array(lasts, pa.int32()),
                                              pa.array(homes, pa.bool_())], ["cell", "id", "last", "home"])

    rows = words.select("word").mapInArrow(each, "cell string, id string, last int, home boolean")
    return rows.withColumn("cell", F.xxhash64("cell"))


def near_words(words: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of words that one inserted, deleted or replaced code point makes equal.

    Of two such words, the one whose prefix ends at the smaller rank has a pivot that the other holds unchanged and that is
    no rarer than that one's prefix allows, so it is found there. Crowded keys are cut into a grid of
    bounded parts; every pair that meets is verified.
    """
    placed = materialize(postings(words), "spelling-postings")
    parts = materialize(split_homes(placed, HOMES, "id", "last"), "spelling-parts")
    home = parts.where("home").select("part", F.col("id").alias("u"), F.col("last").alias("u_last"))
    visit = parts.where("visit").select(F.col("part").alias("v_part"), F.col("id").alias("v"), F.col("last").alias("v_last"))
    met = home.join(visit, (F.col("part") == F.col("v_part")) & (F.col("u") != F.col("v")) & (F.col("u_last") <= F.col("v_last"))
                    & (F.abs(F.char_length("u") - F.char_length("v")) <= EDITS))
    near = met.where(F.levenshtein("u", "v", EDITS) == EDITS)
    return near.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the end of each word's chain, by pointer jumping.

    A form has several times the occurrences of its word, so chains end and the rounds are few.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("mid"), F.col("root").alias("end"))
        after = materialize(now.join(ahead, F.col("root") == F.col("mid"), "left").select(
            "word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "spelling-roots")
        now = after.select("word", "root")
        if after.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, every: int = EVERY) -> DataFrame:
    """One row a word of the corpus: word, form, root, n, n_near, form_n.

    A word is a maximal run of the letters A-Z, a-z and U+00C0 to U+00FF with A-Z lowered, of at least six code points and
    with at least five occurrences over all texts; a run whose checksum with the id is a multiple of ``every`` first loses
    a letter. Two words are near if one inserted, deleted or replaced code point makes them equal. The form is the near word with
    the most occurrences (ties: the smallest by code points) if it has at least five times those of the word, and the
    root is where forms lead to; without a form, ``form`` and ``form_n`` are null and the root is the word.

    Null, empty and blank texts have no words, a null id is an empty one in the checksum, rows that repeat an id are
    counted each, an empty table gives no rows, other columns are not read. Texts are read whole, once.
    """
    words = materialize(count_words(docs, every), "spelling-words")
    near = materialize(near_words(words), "spelling-near")
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("m"))
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other")).union(near.select("b", "a"))
    best = both.join(counts, "other").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    known = materialize(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.less") >= TIMES * F.col("n"), F.col("best")).alias("best")), "spelling-forms")
    known = known.select("word", "n", "n_near", F.col("best.other").alias("form"), (-F.col("best.less")).alias("form_n"))
    roots = follow(known.where("form is not null"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
