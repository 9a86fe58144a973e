from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from shelfmark.llm import bpe

PATH = bpe.vocabulary_path()


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(PATH))


@pytest.fixture(scope="module")
def library(vocabulary):
    ranks = {token: i for i, token in enumerate(vocabulary.tokens)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={})


def texts():
    r = random.Random(2)
    alphabet = ["'s", "'re", "'ll", "'", " ", "  ", "\n", "\t", " ", "　", "\x85", "\x1c",
                "a", "Ab", "é", "Straße", "中文", "٣", "12", "½", "²", "!", "!!", "—", "😀", "́",
                "x", "'S", "don't", "we've", "''s", " ", "_", "\x00", "The quick brown"]
    out = ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(800)]
    return out + ["", " ", "   ", "a" * 5000, " " * 3000 + "x", "ab" * 700 + "'s", "\n\n\n"]


def test_ids_are_those_of_the_library(vocabulary, library):
    some = texts()
    ids, counts = vocabulary.encode([t.encode() for t in some])
    at = 0
    for text, count in zip(some, counts.tolist(), strict=True):
        assert ids[at:at + count].tolist() == library.encode_ordinary(text), repr(text)
        assert vocabulary.decode(ids[at:at + count]) == text.encode()
        at += count


def test_every_code_point_splits_alike(vocabulary, library):
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for low in range(0, len(points), 40_000):
        text = "".join(f"a{chr(p)}1{chr(p)}a" for p in points[low:low + 40_000])
        ids, _ = vocabulary.encode([text.encode()])
        assert ids.tolist() == library.encode_ordinary(text)


def test_query(spark, library):
    rows = list(enumerate([*texts()[:50], None, None, "twice", "twice"]))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in bpe.byte_level_bpe(frame).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        joined = " ".join(map(str, ids)).encode()
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(joined).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_offsets_and_clashing_columns(spark, vocabulary):
    frame = spark.createDataFrame([(1, "The quick é", "x")], "doc_id int, text string, whole string")
    row = bpe.encode(frame, PATH).first()
    begin = [*row.offsets, len("The quick é".encode())]
    for token, a, b in zip(row.ids, begin, begin[1:]):
        assert vocabulary.tokens[token] == "The quick é".encode()[a:b]
    tokens = bpe.encode(frame, PATH)
    assert bpe.decode(tokens, PATH).first().decoded == "The quick é".encode()
    assert row.whole == "x" and bpe.encode(frame.limit(0), PATH).count() == 0


def test_bytes_that_are_not_utf8(spark, vocabulary, library):
    plain = ["don't stop 12", "é!"]
    odd = [b"a\xffb \xc3", b"\xe4\xb8", b"\xf0\x9f\x98 x\x80's", b"\xed\xa0\x80 y"]
    ids, counts = vocabulary.encode([t.encode() for t in plain] + odd)
    at = 0
    for text, count in zip([t.encode() for t in plain] + odd, counts.tolist()):
        assert vocabulary.decode(ids[at:at + count]) == text
        at += count
    assert ids[:counts[0]].tolist() == library.encode_ordinary(plain[0])
    frame = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62C3' AS string) AS text "
                      "UNION ALL SELECT 2L, 'plain'")
    got = {r.doc_id: r for r in bpe.byte_level_bpe(frame).collect()}
    assert got[1].decoded_sha256 == hashlib.sha256(b"a\xffb\xc3").hexdigest()
    assert got[2].n_tokens == len(library.encode_ordinary("plain"))
