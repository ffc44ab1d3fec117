"""Encoding and decoding against the public library."""

from __future__ import annotations

import random
import sys
from hashlib import sha256
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from staffloom.llm import bpe

sys.path.insert(0, str(Path(__file__).parent))
import messy  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", " ", "a", "the", "ing", "é", "1", "²", "!", "...",
    "😀", "​", "<|endoftext|>", "'s", "'", "漢", "́", "\0", "====", "İ", "word", " ß",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.vocabulary_of(PATH))


def ids_of(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_as_the_library(library, encoder):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(3_000)]
    decoder = bpe.Decoder(encoder.vocabulary)
    for text, packed in zip(texts, encoder.encode_many(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert ids_of(packed) == ids, text
        assert decoder.decode(packed) == library.decode(ids, skip_special_tokens=False) == text


@pytest.mark.parametrize("piece", ["a", "=", "ab", "thing", "é", " ", "0123456789", "漢字", "etaoin"])
def test_long_pretokens(library, encoder, piece):
    text = (piece * 9_000)[:9_000]
    assert ids_of(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_transducer_is_bounded_and_exact(encoder):
    vocabulary = encoder.vocabulary
    rng = random.Random(4)
    data = "".join(rng.choices("etaoinshrdlu", k=20_000)).encode()
    run, ids, most = bpe.Transducer(vocabulary, block=256), [], 0
    for at in range(0, len(data), 100):
        ids += run.feed(data[at : at + 100])
        most = max(most, len(run.buffer))
    ids += run.finish()
    assert ids == bpe.merged(vocabulary, data)
    assert most < 256 + vocabulary.lookahead + 200
    assert len(ids) > 0 and b"".join(vocabulary.tokens[i] for i in ids) == data


def test_lookahead_of_a_small_list():
    tokens = {i: bytes([97 + i]) for i in range(4)} | {4: b"cd", 5: b"bc", 6: b"ab"}
    # ab depends on bc, which depends on cd: three bytes beyond a.
    assert bpe.sufficient_lookahead(tokens, [(2, 3, 4), (1, 2, 5), (0, 1, 6)]) == 3
    small = bpe.Vocabulary(tokens, [(2, 3, 4), (1, 2, 5), (0, 1, 6)], {})
    rng = random.Random(5)
    for _ in range(300):
        data = bytes(rng.choices(b"abcd", k=rng.randint(1, 60)))
        run = bpe.Transducer(small, block=4)
        assert [*run.feed(data), *run.finish()] == bpe.merged(small, data)
        assert bpe._merged_short(small, data) == bpe._merged_long(small, data)


def test_short_and_long_merges_agree(encoder):
    rng = random.Random(7)
    for _ in range(500):
        data = "".join(rng.choices(PIECES, k=rng.randint(0, 30))).encode()
        assert bpe._merged_short(encoder.vocabulary, data) == bpe._merged_long(encoder.vocabulary, data)


def test_stretches_hold_whole_pretokens(encoder):
    rng, cut = random.Random(8), encoder.pretokens.findall
    for n in range(4_000):
        mixed = "".join(rng.choices(PIECES, k=rng.randint(0, 60)))
        text = mixed if n % 2 else "".join(rng.choice(PIECES) * rng.randint(1, 40) for _ in range(rng.randint(1, 6)))
        for size in (8, 17, 40):
            found = []
            for start, end, long in bpe.stretches(text, encoder.pretokens, size):
                found += [text[start:end]] if long else cut(text[start:end])
                assert long or end - start <= size
            assert found == cut(text)


@pytest.mark.parametrize("piece", ["\n", "a\n", "漢字。", "漢", "x", "\n\n ", "a\u2028", "7", "=\n"])
def test_windows_without_blanks(library, encoder, piece, monkeypatch):
    """Whatever a text is made of, only a window is in work, and the ids are the library's."""
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 500)
    text = "one " + piece * 3_000 + " two"
    sizes = [end - start for start, end, long in bpe.stretches(text, encoder.pretokens, 500) if not long]
    assert max(sizes) <= 500
    assert ids_of(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids


def test_every_byte_goes_through_the_transducer(library, monkeypatch):
    fed, real = [], bpe.Transducer.feed

    def feed(self, data):
        fed.append(data)
        return real(self, data)

    monkeypatch.setattr(bpe.Transducer, "feed", feed)
    encoder = bpe.Encoder(bpe.vocabulary_of(PATH))
    text = "one two, three\nand so on: 12 漢字 " + "etaoin" * 200
    assert ids_of(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids
    words = encoder.pretokens.findall(text)
    assert sorted(fed) == sorted({w.encode() for w in words})
    fed.clear()
    assert ids_of(encoder.encode(text)) == library.encode(text, add_special_tokens=False).ids
    assert fed == [("etaoin" * 200).encode()] or fed == [(" " + "etaoin" * 200).encode()]


def test_broken_bytes_and_unknown_ids(library, encoder):
    rng = random.Random(6)
    decoder = bpe.Decoder(encoder.vocabulary)
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(40)]
        parts = [decoder.feed(np.array([i])) for i in ids]
        assert "".join(parts) + decoder.finish() == library.decode(ids, skip_special_tokens=False)
    assert decoder.feed(np.array([10**6, -1])) + decoder.finish() == ""


def test_messy_rows(spark, library):
    docs = messy.frame(spark)
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(docs, PATH).collect()}
    want = set()
    for row in messy.rows():
        ids = library.encode(row[1] or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        text = library.decode(ids, skip_special_tokens=False)
        want.add((row[0], len(ids), sha256(packed).hexdigest(), sha256(text.encode()).hexdigest()))
    assert got == want
    assert bpe.round_trip(messy.empty(spark), PATH).count() == 0
    both = bpe.decode(bpe.encode(docs, PATH), PATH).select("text", "decoded").collect()
    assert len(both) == len(messy.rows()) and all((r["text"] or "") == r["decoded"] for r in both)
