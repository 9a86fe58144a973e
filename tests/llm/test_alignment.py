from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shelfmark.llm import alignment

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def a_bytes(i):
    table = {c: b for b, c in enumerate_bytes()}
    return bytes(table[c] for c in A.id_to_token(i))


def enumerate_bytes():
    n = 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            yield b, chr(b)
        else:
            yield b, chr(256 + n)
            n += 1


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def cut(text):
    """Groups of one text as lists of ids of A and of B; none if it is not given back."""
    if not text:
        return []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    left, right = [a_bytes(i) for i in a], [b_bytes(i) for i in b]
    whole = (" " + text).encode()
    if b"".join(left) != whole or b"".join(right) != whole:
        return []
    ends = lambda parts: [sum(map(len, parts[:k + 1])) for k in range(len(parts))]
    a_end, b_end = ends(left), ends(right)
    common, groups, i, j = sorted(set(a_end) & set(b_end)), [], 0, 0
    for end in common:
        k, m = a_end.index(end) + 1, b_end.index(end) + 1
        groups.append((a[i:k], b[j:m]))
        i, j = k, m
    return groups


def brute(rows):
    cuts = [cut(t) for _, t in rows]
    linked = [Counter((a, b) for x, y in groups for a in x for b in y) for groups in cuts]
    count = Counter(pair for one in linked for pair in one)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for (i, _), groups, pairs in zip(rows, cuts, linked):
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups),
                    len(groups), sum(pairs.values()),
                    sum(n for p, n in pairs.items() if count[p] == best[p[0]]),
                    sum(n * count[p] for p, n in pairs.items()),
                    hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return out


def texts():
    r = random.Random(5)
    some = ["the ", "The", " of", "\n", "\t", "  ", "é", "Straße ", "中文", "\x00", "!!!!!!!", "12345",
            " don't", "😀", "▁", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "unbelievable ",
            "\r\n", "́", "antidisestablishment", " ", "﻿", "\x85", " ", "ﬁ", "½"]
    rows = ["".join(r.choice(some) for _ in range(r.randrange(1, 25))) for _ in range(150)]
    return rows + ["", None, " ", "a", "▁", "a ▁ b", "word " * 900, "word " * 900,
                   "z" * 3000, "!" * 5000, "\x00\x01", "twice", "twice"]


@pytest.mark.parametrize(("docs", "size"), [(8192, 8 << 20), (16, 400)])
def test_query_against_both_libraries(spark, monkeypatch, docs, size):
    monkeypatch.setattr(alignment, "SEGMENT_DOCS", docs)
    monkeypatch.setattr(alignment, "SEGMENT_BYTES", size)
    monkeypatch.setattr(alignment, "UNIQUE", 4096 if size > 400 else 3)
    monkeypatch.setattr(alignment, "FEW", 300_000 if size > 400 else 5)
    rows = [(i if i != 7 else None, t) for i, t in enumerate(texts())]
    rows += [(3, "an id twice"), (None, "the of")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [tuple(r) for r in alignment.cross_tokenizer_alignment(frame).collect()]
    order = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(got, key=order) == sorted(brute(rows), key=order)


def test_pairs_and_multiplicity(spark):
    rows = [(i, t) for i, t in enumerate(texts()) if t]
    index = alignment.Index(spark.createDataFrame(rows, "doc_id bigint, text string"))
    docs, links = Counter(), Counter()
    for _, text in rows:
        one = Counter((a, b) for x, y in cut(text) for a in x for b in y)
        docs.update(set(one))
        links.update(one)
    assert {(r.a, r.b): (r["count"], r.links) for r in index.pairs.collect()} == {
        pair: (docs[pair], links[pair]) for pair in docs}


def test_invalid_text_clashing_columns_and_empty_table(spark):
    frame = spark.sql("""
        SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text, 'x' AS blob, 5 AS segment
        UNION ALL SELECT 2L, 'plain words', 'y', 6""")
    got = {r.doc_id: r for r in alignment.cross_tokenizer_alignment(frame).collect()}
    assert got[1].n_a == 0 and got[1].groups_sha256 == "" and got[2].n_a == 2
    empty = alignment.cross_tokenizer_alignment(frame.limit(0))
    assert empty.collect() == [] and empty.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
