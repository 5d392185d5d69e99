"""Periodic runs of words by internal pattern matching."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import batches_by_size, short_batches, words_of

#: A run has at least this many words, and at least this many times its period.
LEAST, TIMES = 6, 4
#: Bytes of text that are indexed together; a longer text is indexed alone.
BATCH = 1 << 20

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string, n_words long, n_dropped long")


def firsts(keys: np.ndarray) -> np.ndarray:
    """For sorted keys, the index of the first one that equals each."""
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    return np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))


def rank_levels(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... symbols, until no two are equal.

    A rank is the number of suffixes that are smaller in those symbols, so equal ranks name equal factors, the
    factors of a rank fill the suffix array from that index on, and the last level is the inverse of the suffix array.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = firsts(symbols[order])
    levels, m = [rank], 1
    while len(tied := np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)):
        after = tied + m
        key = rank[tied] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key)
        key = key[order]
        rank = rank.copy()
        rank[tied[order]] += firsts(key) - firsts(key // (n + 1))
        levels.append(rank)
        m *= 2
    return [level.astype(np.int32) for level in levels]


class Wavelet:
    """A wavelet tree over an array of numbers below ``2 ** bits``, its nodes of a level side by side.

    All queries take arrays and go down the levels once for all of them.
    """

    def __init__(self, values: np.ndarray, bits: int):
        self.levels = []
        for bit in reversed(range(bits)):
            ones = (values >> bit) & 1
            zeros = np.concatenate(([0], np.cumsum(1 - ones))).astype(np.int32)
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate((values[ones == 0], values[ones == 1]))

    def below(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How many of the values at ``low`` to ``high`` are smaller than ``least``."""
        found = np.zeros(len(low), np.int64)
        for bit, zeros, middle in self.levels:
            right = ((least >> bit) & 1).astype(bool)
            zl, zh = zeros[low], zeros[high]
            found += np.where(right, zh - zl, 0)
            low, high = np.where(right, middle + low - zl, zl), np.where(right, middle + high - zh, zh)
        return found

    def nth(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value with ``nth`` smaller ones among those at ``low`` to ``high``."""
        value = np.zeros(len(low), np.int64)
        for bit, zeros, middle in self.levels:
            zl, zh = zeros[low], zeros[high]
            right = nth >= zh - zl
            nth = nth - np.where(right, zh - zl, 0)
            value |= right.astype(np.int64) << bit
            low, high = np.where(right, middle + low - zl, zl), np.where(right, middle + high - zh, zh)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray, none: int) -> np.ndarray:
        """The smallest value from ``least`` on among those at ``low`` to ``high``, or ``none``."""
        smaller = self.below(low, high, least)
        out = np.full(len(low), none, np.int64)
        some = np.flatnonzero(smaller < high - low)
        out[some] = self.nth(low[some], high[some], smaller[some])
        return out


def extensions(levels: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far two positions agree forwards (themselves included) and backwards (themselves left out)."""
    n = len(levels[0])
    i, j = left.copy(), right.copy()
    for k in reversed(range(len(levels) - 1)):
        same = (j < n) & (levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)])
        i, j = i + (same << k), j + (same << k)
    forwards = i - left
    i, j = left.copy(), right.copy()
    for k in reversed(range(len(levels) - 1)):
        p = i - (1 << k)
        same = (p >= 0) & (levels[k][np.maximum(p, 0)] == levels[k][np.maximum(j - (1 << k), 0)])
        i, j = i - (same << k), j - (same << k)
    return forwards, left - i


def find_runs(symbols: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, sorted by start, then period.

    A run of period q holds, for the power m of two in (q / 2, q], a block of m symbols that begins at a multiple
    of m; the block stands again q further on. So each block asks for its occurrences that begin m to 2m - 1 further
    on. Beginnings within m symbols form a progression: its first, second and last member are range successors of
    the block's interval of the suffix array. Every member gives a candidate period, which the maximal extensions of
    the two positions accept or reject. A multiple of a run's period gives the same stretch, and the least one stays.
    """
    n = len(symbols)
    none = (np.zeros(0, np.int64),) * 3
    if n < least or times < 4:
        if times < 4:
            raise ValueError("blocks are only sure to stand in runs of four periods and more")
        return none
    levels = rank_levels(symbols)
    array = np.empty(n, np.int64)
    array[levels[-1]] = np.arange(n)
    tree = Wavelet(array, int(n).bit_length())
    blocks, periods = [], []
    for k, rank in enumerate(levels[:-1]):
        m = 1 << k
        b = np.arange(0, n - m + 1, m)
        low = rank[b].astype(np.int64)
        size = np.bincount(rank, minlength=n)[low]
        # Three occurrences of a block lie in four periods, six in six words of period one.
        b, low, size = (x[size >= (3 if k else least)] for x in (b, low, size))
        high, end = low + size, np.minimum(b + 2 * m, n)
        first = tree.successor(low, high, np.minimum(b + m, n), n)
        b, low, high, end, first = (x[first < end] for x in (b, low, high, end, first))
        if not len(b):
            continue
        second = tree.successor(low, high, first + 1, n)
        several = second < end
        last = np.where(several, tree.nth(low, high, np.maximum(tree.below(low, high, end) - 1, 0)), first)
        step = np.where(several, second - first, 1)
        members = (last - first) // step + 1
        nth = np.arange(members.sum()) - np.repeat(np.cumsum(members) - members, members)
        blocks.append(np.repeat(b, members))
        periods.append(np.repeat(first - b, members) + nth * np.repeat(step, members))
    if not blocks:
        return none
    b, q = np.concatenate(blocks), np.concatenate(periods)
    forwards, backwards = extensions(levels, b, b + q)
    start, length = b - backwards, q + forwards + backwards
    run = length >= np.maximum(least, times * q)
    start, length, q = start[run], length[run], q[run]
    order = np.lexsort((q, length, start))
    start, length, q = start[order], length[order], q[order]
    own = np.concatenate(([True], (start[1:] != start[:-1]) | (length[1:] != length[:-1])))[:len(start)]
    start, length, q = start[own], length[own], q[own]
    order = np.lexsort((q, start))
    return start[order], length[order], q[order]


def planted(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(first word, period) of the repetition that the query puts into a tenth of the documents; a null id has none."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    a = h // 10 % n
    return a, 1 + (n - a) // (3 + h // 10 % 8)


def _batch(batch: pa.RecordBatch, plant: bool, schema: pa.Schema) -> pa.RecordBatch:
    ids = batch.column("doc_id").to_pylist()
    lists = words_of(batch.column("text"), lower=False)
    offsets = lists.offsets.to_numpy()
    offsets = offsets - offsets[0]
    words = lists.flatten()
    n = np.diff(offsets)
    if plant:
        place = np.arange(len(words))
        for d, doc_id in enumerate(ids):
            if (at := planted(doc_id, int(n[d]))) is not None:
                first, stop = offsets[d] + at[0], offsets[d + 1]
                place[first:stop] = first + np.arange(stop - first) % at[1]
        words = words.take(pa.array(place))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # A word is a symbol of its document, so no factor stands in two of them.
    docs = np.repeat(np.arange(len(ids)), n)
    start, length, period = find_runs(docs * (len(coded.dictionary) + 1) + codes)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    stays = np.cumsum(edges[:-1]) == 0
    kept = np.concatenate(([0], np.cumsum(stays)))[offsets]
    texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(kept, pa.int64()), words.filter(pa.array(stays))),
                           pa.scalar(" ", pa.large_string())).to_pylist()
    bounds = np.searchsorted(start, offsets)
    rows = []
    for d, doc_id in enumerate(ids):
        own = slice(bounds[d], bounds[d + 1])
        s, size, q = (start[own] - offsets[d]).tolist(), length[own].tolist(), period[own].tolist()
        best = (None,) * 4
        if s:
            top = 0
            for i in range(1, len(s)):  # fractions are compared as products, so that no rounding decides
                if size[i] * q[top] > size[top] * q[i]:
                    top = i
            best = s[top], size[top], q[top], 1000 * size[top] // q[top]
        listed = "".join(f"{x},{y},{z}\n" for x, y, z in zip(s, size, q, strict=True))
        rows.append((doc_id, len(s), *best, hashlib.sha256(listed.encode()).hexdigest(),
                     hashlib.sha256(texts[d].encode()).hexdigest(), int(n[d]), int(n[d] - kept[d + 1] + kept[d])))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """One row a document: its runs of words, the strongest one, and digests of all runs and of the text without repetitions.

    A run is a stretch of words with smallest period q and at least ``max(6, 4 q)`` words that no neighbouring word
    extends. ``n_runs`` counts them; ``start``, ``length``, ``period`` and ``exponent_milli`` describe the one with the
    greatest length by period (ties: smallest start, then period), and are null without a run. A word is dropped if it
    stands in a run after its first q words; ``collapsed_sha256`` is of the rest, joined by single spaces. With ``plant``
    a tenth of the documents, chosen by id, are first made periodic from some word on.

    A null or empty text, or one of blanks, has no words and no runs; a null id is never made periodic. Rows that repeat an
    id count on their own; an empty table gives no rows; other columns are not read. Each document is indexed whole: a task holds
    about 1 MB of texts, or one longer text, at a few numbers a word and level of its longest repeated stretch. Nothing is shuffled.
    """
    short_batches(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"long": pa.int64(), "string": pa.string()}
        schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in SCHEMA.split(", "))])
        for batch in batches_by_size(batches, "text", BATCH):
            yield _batch(batch, plant, schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(each, SCHEMA)
