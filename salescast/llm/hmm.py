"""Scoring texts with a hidden Markov language model trained by Baum-Welch over the whole corpus."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import batches_by_size, crc_mod, frequent, short_batches, text_of, words_of
from salescast.staging import materialize

#: Latent states; words with an emission of their own; classes that the other words share, by their endings.
STATES, OWN, CLASSES, ENDING = 8, 8192, 2048, 4
#: Most frequent words whose counts go to all tasks. Counts of the others are joined by word.
COMMON = 1 << 18
#: Random directions; on which side of each a document lies gives the groups that the start values are found from. Rounds in which
#: all training documents then go to the state they fit best.
SIDES, WARM_ROUNDS = 6, 3
#: Baum-Welch rounds over all training documents, and tokens that one forward-backward run spans there.
ROUNDS, STRETCH = 2, 512
#: What a word, known or not, has beside its count; the same for a symbol in a state.
ADD = 0.1
#: Bytes of text, and tokens, worked on at a time.
BATCH, TOKENS = 8 << 20, 1 << 20


def ending_class(words: pa.Array) -> np.ndarray:
    """A class from 0 to CLASSES - 1 for each word, by its last ENDING bytes."""
    words = words.cast(pa.large_string())
    _, places, data = words.buffers()
    if not len(words) or data is None:
        return np.zeros(len(words), dtype=np.int64)
    places = np.frombuffer(places, dtype=np.int64)[words.offset:words.offset + len(words) + 1]
    letters = np.frombuffer(data, dtype=np.uint8)
    key = np.zeros(len(words), dtype=np.uint64)
    for back in range(1, ENDING + 1):
        there = places[1:] - back >= places[:-1]
        letter = np.where(there, letters[np.maximum(places[1:] - back, 0)].astype(np.uint64) + np.uint64(1), np.uint64(0))
        key = key * np.uint64(257) + letter
    key *= np.uint64(0x9E3779B97F4A7C15)
    return ((key >> np.uint64(32)) % np.uint64(CLASSES)).astype(np.int64)


@dataclass
class Vocabulary:
    """The most frequent words in order, what they count, and the totals of all training tokens.

    A word's symbol is its rank where that is below OWN, else OWN plus its class; the end has the last symbol.
    The probability of a word is that of its symbol times its share of its class, known words and one unknown
    word among them, as in the base score.
    """

    words: pa.Array
    counts: np.ndarray
    tokens: int
    distinct: int
    ends: int
    class_tokens: np.ndarray
    class_words: np.ndarray

    END = OWN + CLASSES
    SYMBOLS = OWN + CLASSES + 1

    @property
    def log_all(self) -> float:
        return float(np.log10(self.tokens + ADD * (self.distinct + 1)))

    def ranks(self, words: pa.Array) -> np.ndarray:
        """Rank of each word, -1 where it is not among the most frequent."""
        return pc.fill_null(pc.index_in(words, self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def symbols(self, words: pa.Array, ranks: np.ndarray) -> np.ndarray:
        return np.where((ranks >= 0) & (ranks < OWN), ranks, OWN + ending_class(words))

    def class_norm(self, symbols: np.ndarray) -> np.ndarray:
        """log10 of what a symbol's words add up to; 0 where a word has a symbol of its own."""
        norm = np.zeros(self.SYMBOLS)
        norm[OWN:OWN + CLASSES] = np.log10(self.class_tokens + ADD * (self.class_words + 1))
        return norm[symbols]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of all words of all rows; each batch is counted before rows leave the task."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_size(batches, "text", BATCH):
            found = pc.value_counts(words_of(batch.column("text")).flatten())
            yield pa.record_batch([found.field(0).cast(pa.string()), found.field(1)], names=["word", "c"])

    return docs.select("text").mapInArrow(each, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, ends: int) -> Vocabulary:
    """From stored word counts. Only the most frequent words and the totals of the classes come to the driver."""
    top = frequent(counts, "c", COMMON).select("word", "c").toArrow().sort_by([("c", "descending"), ("word", "ascending")])
    own = Vocabulary(pa.array(top.column("word").to_pylist(), pa.large_string()), top.column("c").to_numpy(), 0, 0, ends,
                     np.zeros(CLASSES), np.zeros(CLASSES))
    held = counts.sparkSession.sparkContext.broadcast(own)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, distinct = np.zeros(own_size := Vocabulary.SYMBOLS, dtype=np.int64), np.zeros(own_size, dtype=np.int64)
        for batch in batches:
            words, c = batch.column("word").cast(pa.large_string()), batch.column("c").to_numpy()
            symbols = held.value.symbols(words, held.value.ranks(words))
            total += np.bincount(symbols, c, own_size).astype(np.int64)
            distinct += np.bincount(symbols, minlength=own_size)
        used = np.flatnonzero(distinct)
        yield pa.record_batch([pa.array(used), pa.array(total[used]), pa.array(distinct[used])], names=["symbol", "n", "v"])

    rows = (counts.select("word", "c").mapInArrow(each, "symbol long, n long, v long").groupBy("symbol")
            .agg(F.sum("n").alias("n"), F.sum("v").alias("v")).toArrow())
    held.unpersist()
    symbol, n, v = (rows.column(c).to_numpy() for c in ("symbol", "n", "v"))
    own.tokens, own.distinct = int(n.sum()) + ends, int(v.sum()) + (ends > 0)
    shared = symbol >= OWN
    own.class_tokens[symbol[shared] - OWN] = n[shared]
    own.class_words[symbol[shared] - OWN] = v[shared]
    return own


_ENCODED = ("uid long, doc_id long, held_out boolean, symbols binary, n_tokens long, n_known long, base double, within double, "
            "rare array<string>, times array<int>")


def _encode(batches: Iterator[pa.RecordBatch], held: Broadcast) -> Iterator[pa.RecordBatch]:
    """Symbols of each text, and what its common words and its end bring to the two scores."""
    v: Vocabulary = held.value
    uid = TaskContext.get().partitionId() << 33
    common = np.log10(v.counts + ADD)
    for batch in batches_by_size(batches, "text", BATCH):
        lists = words_of(batch.column("text"))
        n = np.diff(lists.offsets.to_numpy())
        coded = lists.flatten().dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        doc = np.repeat(np.arange(len(n)), n)
        ranks = v.ranks(words)
        symbols = v.symbols(words, ranks)
        known = ranks >= 0
        log_c = np.where(known, common[ranks] if len(common) else 0.0, 0.0)
        inside = np.where(symbols < OWN, 0.0, np.where(known, log_c, 0.0) - v.class_norm(symbols))
        sums = [np.bincount(doc, weights[code], len(n)).astype(float) for weights in (known.astype(float), log_c, inside)]
        # Rare words with their number in each text.
        at = np.flatnonzero(~known[code])
        pairs, times = np.unique(doc[at].astype(np.int64) * max(len(words), 1) + code[at], return_counts=True)
        ends = np.searchsorted(pairs, (np.arange(len(n) + 1)) * max(len(words), 1))
        rare = words.take(pa.array(pairs % max(len(words), 1))).cast(pa.string())
        # The sequence of each text, its end included.
        flat = np.insert(symbols[code], np.cumsum(n), v.END).astype("<u2")
        stops = np.cumsum(n + 1) * 2
        data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [
            None, pa.py_buffer(np.concatenate(([0], stops)).astype(np.int64)), pa.py_buffer(flat.tobytes())])
        yield pa.record_batch([
            pa.array(uid + np.arange(len(n))), batch.column("doc_id"), batch.column("held_out"), data.cast(pa.binary()),
            pa.array(n + 1), pa.array((sums[0] + (v.ends > 0)).astype(np.int64)),
            pa.array(sums[1] + np.log10(v.ends + ADD) - (n + 1) * v.log_all), pa.array(sums[2]),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(times, pa.int32()))],
            names=["uid", "doc_id", "held_out", "symbols", "n_tokens", "n_known", "base", "within", "rare", "times"])
        uid += len(n)


@dataclass
class Hmm:
    """start: of a text; later: of a stretch inside a text; move: from row to column; emit: symbol by state."""

    start: np.ndarray
    later: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def _by_time(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences from long to short, laid out step after step: order, symbols, where each step begins."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(lengths.max(initial=0)), side="right")
    begins = np.concatenate(([0], np.cumsum(active)))
    out = np.empty(begins[-1], dtype=np.int64)
    for place, i in enumerate(order):
        out[begins[:lengths[i]] + place] = sequences[i]
    return order, out, begins


def log_likelihood(model: Hmm, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each whole sequence by the scaled forward recursion."""
    order, symbols, begins = _by_time(sequences)
    total = np.zeros(len(sequences))
    now = None
    for t in range(len(begins) - 1):
        emitted = model.emit[symbols[begins[t]:begins[t + 1]]]
        now = (model.start if now is None else now[:len(emitted)] @ model.move) * emitted
        scale = now.sum(axis=1)
        now /= scale[:, None]
        total[:len(scale)] += np.log10(scale)
    out = np.empty(len(sequences))
    out[order] = total
    return out


def expected_counts(model: Hmm, sequences: list[np.ndarray], opens: np.ndarray) -> Hmm:
    """Baum-Welch counts of the sequences; ``opens`` says which of them begin a text."""
    order, symbols, begins = _by_time(sequences)
    opens = opens[order]
    steps, states = len(begins) - 1, len(model.start)
    move, emit = model.move.astype(np.float32), model.emit.astype(np.float32)
    emitted = emit[symbols]
    alpha = np.empty_like(emitted)
    scales = np.empty(len(symbols), dtype=np.float32)
    first = np.where(opens[:, None], model.start, model.later).astype(np.float32)
    for t in range(steps):
        here = slice(begins[t], begins[t + 1])
        size = begins[t + 1] - begins[t]
        now = (first if t == 0 else alpha[begins[t - 1]:begins[t - 1] + size] @ move) * emitted[here]
        scales[here] = now.sum(axis=1)
        alpha[here] = now / scales[here, None]
    moves = np.zeros((states, states))
    beta = np.ones((0, states), dtype=np.float32)
    gamma = np.empty_like(alpha)
    for t in range(steps - 1, -1, -1):
        here = slice(begins[t], begins[t + 1])
        size = begins[t + 1] - begins[t]
        after = np.ones((size, states), dtype=np.float32)
        if t + 1 < steps:
            follows = begins[t + 2] - begins[t + 1]
            ahead = beta * emitted[begins[t + 1]:begins[t + 2]] / scales[begins[t + 1]:begins[t + 2], None]
            moves += alpha[begins[t]:begins[t] + follows].T @ ahead
            after[:follows] = ahead @ move.T
        beta = after
        gamma[here] = alpha[here] * beta
    counts = np.stack([np.bincount(symbols, gamma[:, s], len(emit)) for s in range(states)], axis=1)
    at_first = gamma[:begins[1]] if steps else gamma
    return Hmm(at_first[opens].sum(0, dtype=float), at_first[~opens].sum(0, dtype=float), moves * model.move, counts)


def maximised(counts: Hmm) -> Hmm:
    """The model with the greatest likelihood for the counts, each event counted a little more often."""
    def shares(x: np.ndarray, axis: int) -> np.ndarray:
        x = x + ADD
        return x / x.sum(axis=axis, keepdims=True)

    return Hmm(shares(counts.start, 0), shares(counts.later, 0), shares(counts.move, 1), shares(counts.emit, 0))


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b.as_buffer(), dtype="<u2") for b in column]


def start_model(texts: np.ndarray, states: int = STATES, seed: int = 5) -> Hmm:
    """Start values from numbers of symbols, a row a group of texts: states are groups with like symbols, found by k-means on damped frequencies."""
    symbols = texts.shape[1]
    rng = np.random.default_rng(seed)
    counts = np.full((symbols, states), 1.0) + rng.random((symbols, states))
    if len(texts):
        size = texts.sum(axis=1)
        points = np.sqrt(texts)
        points /= np.linalg.norm(points, axis=1, keepdims=True)
        # Spread seeds: each next one is a group far from those before.
        centers = [points[rng.integers(len(points))]]
        while len(centers) < states:
            far = 1 - np.max(points @ np.stack(centers).T, axis=1)
            far = np.maximum(far, 1e-9) ** 2 * size
            centers.append(points[rng.choice(len(points), p=far / far.sum())])
        centers = np.stack(centers)
        for _ in range(12):
            group = np.argmax(points @ centers.T, axis=1)
            for s in range(states):
                if (group == s).any():
                    centers[s] = (points[group == s] * size[group == s, None]).sum(0)
                    centers[s] /= np.linalg.norm(centers[s])
        counts = np.stack([texts[group == s].sum(0) for s in range(states)], axis=1)
    return _sticky(counts, rng)


def _sticky(counts: np.ndarray, rng: np.random.Generator) -> Hmm:
    """A model that emits as counted (symbol by state) and mostly stays in its state; a state without texts is the whole with some noise."""
    symbols, states = counts.shape
    stay = np.full((states, states), 0.02 / max(states - 1, 1))
    np.fill_diagonal(stay, 0.98)
    even = np.full(states, 1 / states)
    whole = counts.sum(axis=1) + ADD
    emit = counts + 50 * (whole / whole.sum())[:, None] + ADD * rng.random((symbols, states))
    return Hmm(even, even, stay, emit / emit.sum(0))


def _flat(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The symbols of some sequences, and where each of them begins; none is empty."""
    for batch in batches_by_size(batches, "symbols", 2 << 20):
        sequences = _sequences(batch.column("symbols"))
        if sequences:
            lengths = np.array([len(s) for s in sequences])
            yield np.concatenate(sequences).astype(np.int64), np.cumsum(lengths) - lengths


def grouped_counts(encoded: DataFrame, symbols: int, groups: int, group_of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """How often each group of texts has each symbol, over all rows; what comes back is bounded by groups and symbols."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(groups * symbols, dtype=np.int64)
        for flat, starts in _flat(batches):
            group = np.repeat(group_of(flat, starts), np.diff(np.append(starts, len(flat))))
            total += np.bincount(group * symbols + flat, minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["cell", "n"])

    got = encoded.select("symbols").mapInArrow(each, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(groups * symbols)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(groups, symbols)


def first_model(encoded: DataFrame, symbols: int, states: int = STATES, seed: int = 5) -> Hmm:
    """Start values from all rows. Texts on the same sides of random directions make groups, whose sums of symbols k-means
    puts into states; then each text goes to the state it fits best, and the states are counted anew, some times."""
    context = encoded.sparkSession.sparkContext
    rng = np.random.default_rng(seed)
    share = grouped_counts(encoded, symbols, 1, lambda flat, starts: np.zeros(len(starts), dtype=np.int64))[0]
    share /= max(share.sum(), 1)
    direction = (rng.choice([-1.0, 1.0], (symbols, SIDES)) / np.sqrt(share + 1e-4)[:, None])
    held = context.broadcast(((direction - share @ direction).astype(np.float32)))

    def side(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return (np.add.reduceat(held.value[flat], starts) > 0) @ (1 << np.arange(SIDES))

    texts = grouped_counts(encoded, symbols, 1 << SIDES, side)
    model = start_model(texts[texts.any(axis=1)], states, seed)
    held.unpersist()
    for _ in range(WARM_ROUNDS):
        log_emit = context.broadcast(np.log(model.emit).astype(np.float32))
        counts = grouped_counts(encoded, symbols, states, lambda flat, starts: np.argmax(np.add.reduceat(log_emit.value[flat], starts), axis=1))
        log_emit.unpersist()
        model = _sticky(counts.T, rng)
    return model


def _stretches(symbols: list[np.ndarray]) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Sequences cut into stretches, about TOKENS tokens at a time."""
    held, opens, size = [], [], 0
    for s in symbols:
        for at in range(0, len(s), STRETCH):
            held.append(s[at:at + STRETCH])
            opens.append(at == 0)
            size += len(held[-1])
            if size >= TOKENS:
                yield held, np.array(opens)
                held, opens, size = [], [], 0
    if held:
        yield held, np.array(opens)


def baum_welch_round(encoded: DataFrame, model: Hmm) -> Hmm:
    """One round over all rows: each task adds up its counts, and Spark adds up those of the tasks by symbol.

    What comes back has a row a symbol and a state, whatever the size of the corpus.
    """
    held = encoded.sparkSession.sparkContext.broadcast(model)
    states = len(model.start)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for sequences, opens in _stretches(_sequences(batch.column("symbols"))):
                got = expected_counts(held.value, sequences, opens)
                parts = [got.emit, got.move, got.start[None], got.later[None]]
                total = parts if total is None else [a + b for a, b in zip(total, parts)]
        if total is not None:
            rows = np.concatenate(total)
            used = np.flatnonzero(rows.any(axis=1))
            yield pa.record_batch([pa.array(used)] + [pa.array(rows[used, s]) for s in range(states)],
                                  names=["row", *(f"s{s}" for s in range(states))])

    columns = [f"s{s}" for s in range(states)]
    got = (encoded.select("symbols").mapInArrow(each, "row long, " + ", ".join(f"{c} double" for c in columns))
           .groupBy("row").agg(*[F.sum(c).alias(c) for c in columns]).toArrow())
    held.unpersist()
    symbols = len(model.emit)
    rows = np.zeros((symbols + states + 2, states))
    if got.num_rows:
        rows[got.column("row").to_numpy()] = np.column_stack([got.column(c).to_numpy() for c in columns])
    return maximised(Hmm(rows[symbols + states], rows[symbols + states + 1], rows[symbols:symbols + states], rows[:symbols]))


def train(encoded: DataFrame, symbols: int, rounds: int = ROUNDS) -> Hmm:
    """Start values from all documents, then Baum-Welch over all of them."""
    model = first_model(encoded, symbols)
    for _ in range(rounds):
        model = baum_welch_round(encoded, model)
    return model


def score(docs: DataFrame, folds: int = 10, rounds: int = ROUNDS) -> DataFrame:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words and model are learned from all documents outside the held-out fold. ``score`` is the log10 probability of the
    whole text: the likelihood of its symbols, end included, by the forward recursion over the whole sequence, times
    each word's share of its class. A null or empty text is its end alone. Rows that repeat a doc_id are
    scored and counted each; an empty table gives no rows; other columns are not read.

    Words beyond the most frequent ones are never sent around: their counts are joined by word to the texts they stand in.
    """
    spark = docs.sparkSession
    short_batches(spark)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"),
                        (crc_mod("doc_id", folds) == 0).alias("held_out"))
    learns = given.where("not held_out")
    counts = materialize(word_counts(learns), "word-counts")
    words = vocabulary(counts, learns.count())
    held = spark.sparkContext.broadcast(words)  # bounded by COMMON and CLASSES
    encoded = materialize(given.mapInArrow(lambda it: _encode(it, held), _ENCODED), "symbols")
    model = spark.sparkContext.broadcast(train(encoded.where("not held_out"), Vocabulary.SYMBOLS, rounds))

    def likelihood(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_size(batches, "symbols", 16 << 20):
            found = log_likelihood(model.value, _sequences(batch.column("symbols")))
            yield pa.record_batch([*batch.columns[1:], pa.array(found)], names=[*batch.schema.names[1:], "hidden"])

    scored = encoded.select("symbols", "uid", "doc_id", "held_out", "n_tokens", "n_known", "base", "within").mapInArrow(
        likelihood, "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, within double, hidden double")
    rare = encoded.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "uid", F.col("r.rare").alias("r_word"), F.col("r.times").alias("times"))
    seen = F.coalesce("c", F.lit(0))
    sums = (rare.join(counts, F.col("r_word") == F.col("word"), "left").groupBy(F.col("uid").alias("r_uid")).agg(
        F.sum(F.col("times") * F.log10(seen + ADD)).alias("r_log"),
        F.sum(F.when(seen > 0, F.col("times")).otherwise(F.lit(0))).alias("r_known")))
    extra = F.coalesce("r_log", F.lit(0.0))
    return scored.join(sums, F.col("uid") == F.col("r_uid"), "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("r_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"), (F.col("base") + extra).alias("base_score"),
        (F.col("hidden") + F.col("within") + extra).alias("score"))
