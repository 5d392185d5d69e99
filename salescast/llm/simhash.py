"""SimHash near-dedup with anchor points: fingerprints meet at the words of a covering code."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import keep_rows, one_row, repeats, short_batches
from salescast.llm.components import components, forest
from salescast.llm.runs import home_pairs, split_homes, whole_keys
from salescast.staging import materialize

SHINGLE, BITS = 4, 4
#: Pairs compared at a time, and homes of one anchor that share a task.
PAIRS, HOMES = 1 << 19, 4096


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 majority bits over the XXH64 (seed 42) of all word shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    tail = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[tail:].tolist())),
                         dtype="<u8", count=len(words) - tail)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed long; a null or empty text has 0."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64)
            yield pa.record_batch([*batch.columns[:2], pa.array(found.view(np.int64))], names=["doc_id", "text_hash", "fp"])

    short_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        each, "doc_id long, text_hash long, fp long")


@dataclass(frozen=True)
class Block:
    """A covering code on ``width`` neighbouring bits of the fingerprint, from bit ``start`` on.

    The first ``coded`` bits carry a perfect cyclic code with generator polynomial ``poly``, all of whose words
    lie within ``radius``; on the other bits every value is a code word.
    """

    start: int
    width: int
    coded: int = 0
    poly: int = 1
    radius: int = 0

    @cached_property
    def columns(self) -> list[int]:
        """Check bits of each single bit: x to the power i, modulo the polynomial."""
        found, now, top = [], 1, self.poly.bit_length() - 1
        for _ in range(self.coded):
            found.append(now)
            now <<= 1
            if now >> top & 1:
                now ^= self.poly
        return found + [0] * (self.width - self.coded)

    def near(self, within: int) -> tuple[np.ndarray, np.ndarray]:
        """Bit differences of at most ``within`` bits, least first, sorted by check bits; where each value's begin."""
        rows = []
        for n in range(within + 1):
            for places in combinations(range(self.width), n):
                checks = mask = 0
                for i in places:
                    checks ^= self.columns[i]
                    mask |= 1 << i
                rows.append((checks, mask))
        rows.sort(key=lambda r: r[0])  # stable: fewer bits stay first
        checks = np.array([r[0] for r in rows])
        starts = np.searchsorted(checks, np.arange((1 << (self.poly.bit_length() - 1)) + 1))
        return np.array([r[1] for r in rows], dtype=np.uint64), starts

    def checks(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), dtype=np.int64)
        for i, column in enumerate(self.columns[:self.coded]):
            out ^= ((values >> np.uint64(i)) & np.uint64(1)).astype(np.int64) * column
        return out


GOLAY, HAMMING_15, HAMMING_31 = (23, 0b110001110101, 3), (15, 0b10011, 1), (31, 0b100101, 1)


def blocks(*parts: tuple) -> tuple[Block, ...]:
    out, at = [], 0
    for width, *code in parts:
        out.append(Block(at, width, *(code[0] if code else ())))
        at += width
    assert at == 64
    return tuple(out)


#: Coverings by the number of fingerprints they suit: finer anchors mean more copies and fewer comparisons.
#: Which one is used decides the cost alone; each of them finds every link.
COVERINGS = (
    (2_000_000, blocks((23, GOLAY), (23, GOLAY), (18, HAMMING_15))),
    (20_000_000, blocks((22, HAMMING_15), (21, HAMMING_15), (21, HAMMING_15))),
    (500_000_000, blocks((22,), (21,), (21,))),
    (1 << 62, blocks((32, HAMMING_31), (32, HAMMING_31))),
)


def at_anchors(prints: DataFrame, covering: tuple[Block, ...], bits: int = BITS) -> DataFrame:
    """(cell, id, fp, home): each fingerprint once at its nearest anchor and at every anchor near enough.

    Two fingerprints that differ in at most ``bits`` bits differ in at most ``bits // len(covering)`` of one
    block. There the nearest anchor of one lies within the covering radius, hence within that radius plus
    the difference of the other.
    """
    slack = bits // len(covering)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [(b, b.near(b.radius + slack)) for b in covering]
        for batch in batches:
            for lo in range(0, batch.num_rows, 1 << 14):
                rows = batch.slice(lo, 1 << 14)
                ids, fps = (rows.column(i).to_numpy(zero_copy_only=False) for i in range(2))
                for n, (b, (masks, starts)) in enumerate(tables):
                    values = (fps.view(np.uint64) >> np.uint64(b.start)) & np.uint64((1 << b.width) - 1)
                    checks = b.checks(values)
                    first, count = starts[checks], starts[checks + 1] - starts[checks]
                    row = np.repeat(np.arange(len(fps)), count)
                    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                    anchor = values[row] ^ masks[first[row] + nth]
                    yield pa.record_batch([
                        pa.array((anchor | np.uint64(n << 40)).view(np.int64)), pa.array(ids[row]), pa.array(fps[row]),
                        pa.array(nth == 0)], names=["cell", "id", "fp", "home"])

    return prints.select("id", "fp").mapInArrow(each, "cell long, id long, fp long, home boolean")


def _links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Links that connect the fingerprints near each other, from rows sorted by part."""
    for batch in whole_keys(batches, "part"):
        part, ids, fps = (batch.column(c).to_numpy() for c in ("part", "id", "fp"))
        fps = fps.view(np.uint64)
        for left, right in home_pairs(part, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("home", "visit")), PAIRS):
            near = np.flatnonzero((np.bitwise_count(fps[left] ^ fps[right]) <= bits) & (ids[left] != ids[right]))
            if len(near):
                nodes, both = np.unique(np.concatenate([ids[left[near]], ids[right[near]]]), return_inverse=True)
                a, b = forest(both[:len(near)], both[len(near):], len(nodes))
                yield pa.record_batch([pa.array(nodes[a]), pa.array(nodes[b])], names=["a", "b"])


def links(prints: DataFrame, count: int, bits: int = BITS, covering: tuple[Block, ...] | None = None,
          homes: int = HOMES) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of fingerprints at most ``bits`` bits apart.

    ``prints`` has a row a fingerprint with its id. An anchor with many rows is cut into a grid of bounded parts, in
    which about ``homes`` of its homes meet a slice of its visitors. A cell hands on links that connect its
    rows, not all pairs.
    """
    covering = covering or next(c for most, c in COVERINGS if count <= most)
    placed = materialize(at_anchors(prints, covering, bits), "anchors")
    dealt = split_homes(placed, homes, "id", "fp")
    return (dealt.repartition("part").sortWithinPartitions("part")
            .mapInArrow(lambda it: _links(it, bits), "a long, b long"))


def _grouped(docs: DataFrame, shingle: int, bits: int, covering: tuple[Block, ...] | None) -> DataFrame:
    """(doc_id, text_hash, fp, component, head): components by a fingerprint of theirs, and their smallest doc_id."""
    prints = materialize(fingerprints(docs, shingle), "simhash")
    # The fingerprint is the node: different texts may share a doc_id.
    nodes = materialize(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).withColumn("id", F.col("fp")),
        "simhash-nodes")
    linked = components(links(nodes, nodes.count(), bits, covering))
    members = materialize(
        nodes.join(linked, F.col("id") == F.col("node"), "left")
        .select("fp", "least", "n", F.coalesce("component", "id").alias("component")), "simhash-members")
    heads = materialize(
        members.groupBy(F.col("component").alias("h_component")).agg(F.min("least").alias("head"), F.sum("n").alias("rows"))
        .where("rows > 1").drop("rows"), "simhash-heads")
    shared = materialize(
        members.join(heads, F.col("component") == F.col("h_component"))
        .select(F.col("fp").alias("s_fp"), "component", "head"), "simhash-shared")
    return prints.join(shared, F.col("fp") == F.col("s_fp"), "left").select(
        "doc_id", "text_hash", "fp", F.coalesce("component", "fp").alias("component"), F.coalesce("head", "doc_id").alias("head"))


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS,
                   covering: tuple[Block, ...] | None = None) -> DataFrame:
    """One row a document: doc_id, fingerprint (16 hex digits), component_id, the smallest doc_id reachable.

    Equal fingerprints are one node, so copies cost a row each and no more. Texts without words, null ones
    too, have fingerprint 0 and are linked like any other. A null doc_id counts as larger than all others; a
    component of nothing else has a null component_id. Rows that repeat a doc_id are all returned; the id does not
    link their texts. An empty table gives no rows; other columns are not read.
    """
    return _grouped(docs, shingle, bits, covering).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("head").alias("component_id"))


def drop_near(docs: DataFrame, shingle: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each group of near copies, that of the smallest doc_id, all columns as they are.

    Where ids repeat (null ones too), rows are told apart by their texts, and one of the rows with the smallest doc_id stays,
    of equal texts the one whose whole row has the least hash.
    """
    groups = _grouped(docs, shingle, bits, None)
    if not repeats(docs, "doc_id"):
        return keep_rows(docs, groups.where("not doc_id <=> head"))
    keys = groups.where("doc_id <=> head").groupBy("component").agg(
        F.min("head").alias("k_id"), F.min("text_hash").alias("k_hash"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("r_id"), F.xxhash64("text").alias("r_hash"))
    return one_row(rows.join(keys, F.col("r_id").eqNullSafe(F.col("k_id")) & (F.col("r_hash") == F.col("k_hash"))), "component")
