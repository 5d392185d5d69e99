import hashlib
import random

import numpy as np
import pytest

from salescast.llm import bpe
from salescast.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def library():
    return bpe.tokenizer(TOKENIZER)


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    data = np.array(ids, dtype="<u4").tobytes()
    said = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256(said.encode()).hexdigest()


def test_all_documents_as_the_library(documents, library):
    texts = {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
    for part in (bpe.PART, 500):
        got = bpe.round_trip(documents, TOKENIZER, part).collect()
        assert len(got) == len(texts)
        for r in got:
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(library, texts[r.doc_id])


def test_odd_rows(odd, odd_rows, none, library):
    got = sorted(map(str, (tuple(r) for r in bpe.round_trip(odd, TOKENIZER, 1000).collect())))
    assert got == sorted(map(str, ((r[0], *want(library, r[1])) for r in odd_rows)))
    assert bpe.round_trip(none, TOKENIZER).count() == 0


ALPHABETS = (
    "abcdefgh", "aab", "ab'stre", "a1'2s", "éèaǘ", "éào", "中文字符", "😀👍🏽a", "!!'s?", "ßſİıΣσς", " a\x1c\x85b", "한글하",
    "<|endoftext|>", "a \n\tb",
)


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_welding_parts_is_exact(alphabet, library):
    """Texts without any place to split, cut anywhere, give the ids of the whole."""
    rng = random.Random(alphabet)
    for _ in range(40):
        units = [rng.choice(alphabet) for _ in range(rng.randrange(1, 160))]
        text = "".join("<|endoftext|>" if alphabet.startswith("<|") and rng.random() < 0.3 else u for u in units)
        part = rng.randrange(1, 50)
        pieces = [bpe.encode_piece(text[i:i + part], TOKENIZER) for i in range(0, len(text), part)]
        got = np.frombuffer(bpe.join_tree(pieces, TOKENIZER).ids(), dtype="<u4").tolist()
        assert got == library.encode(text, add_special_tokens=False).ids, (text, part)


def test_windows_grow_where_the_sides_disagree(library):
    rng = random.Random(2)
    words = [library.id_to_token(i) for i in range(600, 4000)]
    plain = [w for w in words if w.isascii() and w.isalpha()]
    for _ in range(30):
        text = "".join(rng.choice(plain) for _ in range(60))
        at = rng.randrange(len(text))
        got = bpe.weld(bpe.encode_run(text[:at], TOKENIZER), bpe.encode_run(text[at:], TOKENIZER), TOKENIZER, window=1)
        assert got.ids == library.encode(text, add_special_tokens=False).ids
        assert got.text == text and len(got.ids) == len(got.starts) == len(got.ends)


def test_other_vocabularies_are_refused():
    """Byte-level vocabularies keep white space in their words, so word by word would give other ids."""
    import public_tokenizers

    with pytest.raises(ValueError, match="splitter|normaliser|decoder"):
        bpe.tokenizer(public_tokenizers.path("byte_bpe_50k.json"))


def test_decoding_of_ids(spark, library):
    texts = ["one two", "", "\u0301", "don't <|endoftext|> 12", "x" * 300]
    rows = [(i, np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()) for i, t in enumerate(texts)]
    got = {r.doc_id: r.text for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, ids binary"), TOKENIZER).collect()}
    assert got == {i: library.decode(library.encode(t, add_special_tokens=False).ids, skip_special_tokens=False) for i, t in enumerate(texts)}


def test_words_without_tokens_leave_no_gap(spark, library):
    texts = ["a \x1c b", "\x1c", "\x1c\x1d \x85", "a\x1cb \x1c", " \u2028 x"]
    got = bpe.round_trip(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), TOKENIZER).collect()
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(library, texts[r.doc_id])


@pytest.mark.parametrize("alphabet", ["abÀß", "aB.,!", "x'St.?", "é1;Z:", "ÿ÷×.a", "İσΣς!", "<|A.|>", "e\u0301.é"])
def test_words_in_batches_as_alone(spark, library, alphabet):
    """Lowered, cut at their last marks, and encoded together with others."""
    rng = random.Random(alphabet)
    texts = [" ".join("".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 9))) for _ in range(60)) for _ in range(30)]
    texts += ["<|ENDOFTEXT|> <|endoftext|>. A<|endoftext|>b", "It's WE'LL, don'T. '.' 's ...", "." * 9]
    got = bpe.round_trip(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), TOKENIZER).collect()
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(library, texts[r.doc_id]), texts[r.doc_id]
