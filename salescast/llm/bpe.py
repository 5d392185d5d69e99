"""BPE encoding and decoding with a public vocabulary; long texts are encoded in parts and welded exactly."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.common import batches_by_size, short_batches, text_of, words_of
from salescast.staging import materialize

#: Characters of a part of a long text.
PART = 32_768
#: Words a worker remembers, in each of two generations, and the characters of the longest one.
REMEMBERED, LONGEST = 120_000, 64
#: Words of plain letters that are encoded as one text.
TOGETHER = 200
#: Tokens on each side of a join that are encoded again at first.
WINDOW = 16
#: Bytes of text in a batch.
BATCH = 2 << 20


# What the steps around the merges of a vocabulary may be, so that white space ends every word
# and decoding joins the tokens with single spaces.
NORMALIZERS = ("NFC", "Replace", "Lowercase")
BLANKS = r"\s+"
# Letters that stay single letters in every step, marks that are no part of a contraction, what a word
# must end in before such marks, and what every added token holds.
PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch
MARKS = ".,;:!?"
ENDS = re.compile("[a-zß-öø-ÿ0-9]$").search
ADDED = "<|"


def check_vocabulary(settings: dict) -> None:
    """Refuse a vocabulary whose texts are not encoded word by word, or are decoded by other rules than joining tokens."""
    def steps(step: dict | None, parts: str) -> list[dict]:
        return [] if step is None else step[parts] if step["type"] == "Sequence" else [step]

    for step in steps(settings["normalizer"], "normalizers"):
        blank = step["type"] != "Replace" or (step["pattern"], step["content"]) == ({"Regex": BLANKS}, " ")
        if step["type"] not in NORMALIZERS or not blank:
            raise ValueError(f"normaliser {step['type']} may look across words")
    splits = steps(settings["pre_tokenizer"], "pretokenizers")
    drops = any(x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"] for x in splits)
    spaced = [x["type"] for x in splits if x["type"] not in ("Split", "ByteLevel") or x.get("add_prefix_space")]
    if not drops or spaced:
        raise ValueError("the splitter keeps white space in words")
    if settings["decoder"] is not None or settings["post_processor"] is not None:
        raise ValueError("the vocabulary has a decoder or adds tokens")
    if not any(step["type"] == "Lowercase" for step in steps(settings["normalizer"], "normalizers")):
        raise ValueError("the normaliser keeps capitals")
    if any(ADDED not in x["content"] or x["normalized"] or x["lstrip"] or x["rstrip"] or set(x["content"]) & set(" \t\n\v\f\r") for x in settings["added_tokens"]):
        raise ValueError("an added token takes white space or looks like a word")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        check_vocabulary(json.load(f))
    own = Tokenizer.from_file(path)
    own.no_truncation()
    own.no_padding()
    return own


class Words:
    """Ids of single words, remembered by worker.

    Neither the normaliser nor the splitter of the vocabulary looks across the six ASCII white space
    characters, and no special token holds one, so a text's ids are those of its words in a row, and its decoding is
    that of its words with spaces between. Nor does the splitter keep punctuation with the letter or digit before
    it, so a word's last marks have ids of their own.
    """

    def __init__(self, path: str) -> None:
        self.own = tokenizer(path)
        self.tokens = pa.array(token_table(path), pa.large_string())
        suffix = self.own.model.end_of_word_suffix or ""
        # Where each word of letters ends, if the merges mark it.
        self.ends = np.array([bool(suffix) and t.endswith(suffix) for t in token_table(path)])
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _together(self, plain: list[str]) -> list[bytes]:
        """Ids of words of plain letters, each of which the splitter leaves whole, from texts of many of them."""
        texts = [" ".join(plain[i:i + TOGETHER]) for i in range(0, len(plain), TOGETHER)]
        ids = np.concatenate([np.array(x.ids, "<u4") for x in self.own.encode_batch_fast(texts, add_special_tokens=False)])
        stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def _encode(self, unknown: list[str]) -> list[bytes]:
        letters = [bool(PLAIN(w)) for w in unknown] if self.ends.any() else [False] * len(unknown)
        plain, others = (list(compress(unknown, flags)) for flags in (letters, [not x for x in letters]))
        found = iter(self._together(plain) if plain else ())
        rest = iter([np.array(x.ids, "<u4").tobytes() for x in self.own.encode_batch_fast(others, add_special_tokens=False)] if others else ())
        return [next(found if x else rest) for x in letters]

    def _known(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        bodies = [w.rstrip(MARKS) for w in words]
        cut = [len(x) if x and len(x) < len(w) and ENDS(x) else len(w) for w, x in zip(words, bodies, strict=True)]
        bodies = [w[:n] for w, n in zip(words, cut, strict=True)]
        new, old = self.new, self.old
        out = [new.get(w) for w in bodies]
        marks = {w[n:] for w, n in zip(words, cut, strict=True) if n < len(w)}
        missing = {w: old.get(w) for w, got in zip(bodies, out, strict=True) if got is None}
        missing |= {w: new.get(w) or old.get(w) for w in marks}
        unknown = [w for w, got in missing.items() if got is None]
        missing.update(zip(unknown, self._encode(unknown), strict=True))
        if len(new) + len(missing) > REMEMBERED:
            self.old, self.new = new, {}
        self.new.update((w, got) for w, got in missing.items() if len(w) <= LONGEST)
        return [(missing[x] if got is None else got) + (missing[w[n:]] if n < len(w) else b"")
                for w, x, n, got in zip(words, bodies, cut, out, strict=True)]

    def encode(self, texts: pa.Array, decodes: bool) -> tuple[pa.Array, pa.Array | None]:
        """The ids of each text as little-endian unsigned 32-bit integers, and its decoding if asked.

        Each distinct word of the batch is looked up once; the rest is gathering of byte ranges by Arrow.
        """
        lists = words_of(texts, lower=False)
        flat, offsets = lists.flatten(), lists.offsets.to_numpy()
        # The normaliser lowers all that is not an added token, and each of those holds the mark.
        flat = pc.if_else(pc.match_substring(flat, ADDED), flat, pc.ascii_lower(flat))
        coded = flat.dictionary_encode()
        known = self._known(coded.dictionary.to_pylist())
        codes = coded.indices

        def joined(values: pa.Array, gap: bytes | str, codes: pa.Array, offsets: np.ndarray) -> pa.Array:
            parts = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), values.take(codes))
            return pc.binary_join(parts, pa.scalar(gap, values.type))

        kept = pa.array(known, pa.large_binary())
        ids = joined(kept, b"", codes, offsets)
        if not decodes:
            return ids, None
        said = np.fromiter(map(bool, known), bool, len(known))[codes.to_numpy(zero_copy_only=False)]
        if not said.all():  # a word without tokens leaves no gap
            codes, offsets = codes.filter(pa.array(said)), np.concatenate(([0], np.cumsum(said)))[offsets]
        return ids, joined(decode_all(kept, self.tokens), " ", codes, offsets)

    def ids(self, text: str) -> bytes:
        return self.encode(pa.array([text], pa.large_string()), False)[0][0].as_py()


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(path)


@lru_cache(maxsize=2)
def token_table(path: str) -> list[str]:
    own = tokenizer(path)
    return [own.id_to_token(i) or "" for i in range(own.get_vocab_size(with_added_tokens=True))]


def decode_all(ids: pa.Array, tokens: pa.Array) -> pa.Array:
    """The texts of ids; the vocabulary has no decoder, so its tokens are joined with single spaces."""
    flat = pa.array(np.frombuffer(b"".join(ids.to_pylist()), dtype="<u4"))
    lengths = pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, tokens.take(flat)), pa.scalar(" ", pa.large_string()))


@dataclass
class Run:
    """A stretch without white space, with its ids and the place of each token in it."""

    text: str = ""
    ids: list[int] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)


@dataclass
class Piece:
    """An encoded part of a text. Its first and last run may go on in the neighbours; one open run is all of
    a ``solid`` piece."""

    head: Run
    middle: bytes = b""
    tail: Run = field(default_factory=Run)
    solid: bool = False

    def ids(self) -> bytes:
        last = [] if self.solid else self.tail.ids
        return np.array(self.head.ids, "<u4").tobytes() + self.middle + np.array(last, "<u4").tobytes()


def encode_run(text: str, path: str) -> Run:
    got = tokenizer(path).encode(text, add_special_tokens=False)
    return Run(text, list(got.ids), [a for a, _ in got.offsets], [b for _, b in got.offsets])


def encode_piece(text: str, path: str) -> Piece:
    """Encode a part by itself: whole words for good, the open runs at its ends for the time being."""
    data = text.encode()
    inner = data.split()
    if not inner:
        return Piece(Run(), solid=not data)
    if len(inner) == 1 and len(inner[0]) == len(data):
        return Piece(encode_run(text, path), solid=True)
    head = tail = b""
    if data.startswith(inner[0]):
        head = inner[0]
    if data.endswith(inner[-1]):
        tail = inner[-1]
    middle = data[len(head):len(data) - len(tail)]
    return Piece(encode_run(head.decode(), path), words(path).ids(middle.decode()), encode_run(tail.decode(), path))


def weld(left: Run, right: Run, path: str, window: int = WINDOW) -> Run:
    """The encoding of two runs in a row.

    A window around the join is encoded anew. It holds where its first token is the left run's token at that
    place (or the left run begins there), and where one of its later tokens, not touched by the window's
    end, is a token of the right run (or the right run ends there). Then every pair of neighbouring tokens stands
    in an encoding of real text around it, and the three stretches are put together. Else the window
    grows on the side that disagrees; at its largest it is the whole run.
    """
    if not left.text or not right.text:
        return right if not left.text else left
    shift, back, ahead = len(left.text), window, window
    while True:
        first = max(len(left.ids) - back, 0)
        # A token may begin inside a character of the one before; a window must not.
        while first and left.starts[first] < left.ends[first - 1]:
            first -= 1
        stop = min(ahead, len(right.ids))
        while stop < len(right.ids) and right.starts[stop] < right.ends[stop - 1]:
            stop += 1
        begin = left.starts[first] if first else 0
        whole = stop == len(right.ids)
        end = len(right.text) if whole else right.ends[stop - 1]
        mid = encode_run(left.text[begin:] + right.text[:end], path)
        places = [a + begin for a in mid.starts], [b + begin for b in mid.ends]
        agrees = not first or bool(
            mid.ids and mid.ids[0] == left.ids[first] and places[0][0] == left.starts[first]
            and places[1][0] == left.ends[first])
        cut = (len(mid.ids), len(right.ids)) if whole else None
        if not whole:
            at = {(right.starts[i] + shift, right.ends[i] + shift, right.ids[i]): i for i in range(1, stop)}
            for j in range(len(mid.ids) - 2, 0, -1):
                i = at.get((places[0][j], places[1][j], mid.ids[j]))
                # The pair before the seam must stand in the new encoding, clear of a split character.
                if i is not None and places[0][j] >= places[1][j - 1] and right.starts[i] >= right.ends[i - 1] \
                        and j < len(mid.ids) - WINDOW // 4:
                    cut = j, i
                    break
        if agrees and cut:
            j, i = cut
            return Run(left.text + right.text, left.ids[:first] + mid.ids[:j] + right.ids[i:],
                       left.starts[:first] + places[0][:j] + [a + shift for a in right.starts[i:]],
                       left.ends[:first] + places[1][:j] + [b + shift for b in right.ends[i:]])
        back, ahead = (back if agrees else back * 2), (ahead if cut else ahead * 2)


def join_pieces(a: Piece, b: Piece, path: str) -> Piece:
    seam = weld(a.head if a.solid else a.tail, b.head, path)
    if a.solid and b.solid:
        return Piece(seam, solid=True)
    if a.solid:
        return Piece(seam, b.middle, b.tail)
    if b.solid:
        return Piece(a.head, a.middle, seam)
    return Piece(a.head, a.middle + np.array(seam.ids, "<u4").tobytes() + b.middle, b.tail)


def join_tree(pieces: list[Piece], path: str) -> Piece:
    """Neighbours are joined in pairs, and the results again, until one is left."""
    while len(pieces) > 1:
        pieces = [join_pieces(*pieces[i:i + 2], path) if i + 1 < len(pieces) else pieces[i]
                  for i in range(0, len(pieces), 2)]
    return pieces[0]


_RUN = "struct<text string, ids array<int>, starts array<int>, ends array<int>>"
_PIECE = f"key binary, part int, head {_RUN}, middle binary, tail {_RUN}, solid boolean"


def _as_row(run: Run) -> dict:
    return {"text": run.text, "ids": run.ids, "starts": run.starts, "ends": run.ends}


def _encode_parts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    run = pa.struct([("text", pa.string()), ("ids", pa.list_(pa.int32())), ("starts", pa.list_(pa.int32())),
                     ("ends", pa.list_(pa.int32()))])
    for batch in batches_by_size(batches, "text", BATCH):
        pieces = [encode_piece(t.as_py(), path) for t in batch.column("text")]
        yield pa.record_batch([
            batch.column("key"), batch.column("part"), pa.array([_as_row(p.head) for p in pieces], run),
            pa.array([p.middle for p in pieces], pa.binary()), pa.array([_as_row(p.tail) for p in pieces], run),
            pa.array([p.solid for p in pieces])], names=["key", "part", "head", "middle", "tail", "solid"])


def _join_parts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key and part, one row a text."""
    key, pieces = None, []

    def done() -> pa.RecordBatch:
        return pa.record_batch([pa.array([key], pa.binary()), pa.array([join_tree(pieces, path).ids()], pa.binary())],
                               names=["l_key", "l_ids"])

    for batch in batches:
        for row in batch.to_pylist():
            if pieces and row["key"] != key:
                yield done()
                pieces = []
            key = row["key"]
            pieces.append(Piece(Run(**row["head"]), row["middle"], Run(**row["tail"]), row["solid"]))
    if pieces:
        yield done()


def encode(docs: DataFrame, path: str, part: int = PART) -> DataFrame:
    """(doc_id, ids): the ids of each whole text as little-endian unsigned 32-bit integers.

    Ids are those of the tokenizers library without added special tokens, for a vocabulary that splits at white space; others
    are refused. A null or empty text has no ids.
    Rows that repeat a doc_id each give a row; a null doc_id is kept; an empty table gives no rows; other
    columns are not read.

    Texts of up to ``part`` characters are encoded where they are. Longer ones are cut into parts, dealt out
    by text and part, encoded apart and welded in a tree; equal long texts are encoded once.
    """
    near, far = _encoded(docs, path, part, False)
    return near.union(far)


def _short(batches: Iterator[pa.RecordBatch], path: str, decodes: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches_by_size(batches, "text", BATCH):
        ids, said = words(path).encode(batch.column("text"), decodes)
        columns = [batch.column("doc_id"), ids.cast(pa.binary())]
        if decodes:
            columns.append(said.cast(pa.string()))
        yield pa.record_batch(columns, names=["doc_id", "ids", "text"][:len(columns)])


def _encoded(docs: DataFrame, path: str, part: int, decodes: bool) -> tuple[DataFrame, DataFrame]:
    """Short and long texts: (doc_id, ids), for the short ones with their decoding if asked, in the same worker."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    long = rows.where(F.length("text") > part).select(
        "doc_id", "text", F.unhex(F.sha2("text", 256)).alias("key"))
    near = rows.where(F.length("text") <= part).mapInArrow(
        lambda it: _short(it, path, decodes), "doc_id long, ids binary" + ", text string" * decodes)
    texts = long.select("key", "text").dropDuplicates(["key"])
    cut = texts.select("key", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.floor((F.length("text") - 1) / part).cast("int")),
        lambda i: F.substring("text", i * part + 1, F.lit(part)))).alias("part", "text"))
    pieces = cut.repartition("key", "part").mapInArrow(lambda it: _encode_parts(it, path), _PIECE)
    joined = (pieces.repartition("key").sortWithinPartitions("key", "part")
              .mapInArrow(lambda it: _join_parts(it, path), "l_key binary, l_ids binary"))
    far = long.select("doc_id", "key").join(
        materialize(joined, "long-texts"), F.col("key") == F.col("l_key")).select("doc_id", F.col("l_ids").alias("ids"))
    return near, far


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): the library's decoding of the ids, special tokens included.

    No ids are the empty text. Rows that repeat a doc_id each give a row; a null doc_id is kept; an empty table gives no rows.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_size(batches, "ids", BATCH):
            yield pa.record_batch([batch.column("doc_id"), batch.column("ids"), decode_all(batch.column("ids"), words(path).tokens).cast(pa.string())],
                                  names=["doc_id", "ids", "text"])

    short_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(each, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, path: str, part: int = PART) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text; odd rows as in :func:`encode` and :func:`decode`."""
    near, far = _encoded(docs, path, part, True)
    return near.union(decode(far, path)).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))
