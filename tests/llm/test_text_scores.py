"""Language, quality and compression against plain versions and held-out accuracy."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest

from shelfmark.llm import compression, language, rule_ensemble

FOLDER = "/root/testdata/sf0.01"
ODD = [(900, None), (901, ""), (902, "   \n"), (903, "12 3!"), (904, "a"), (905, "x" * 70000),
       (904, "a")]


def plain_counts(text):
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, windows = set(), {}
    dup = 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    for i in range(len(found) - 4):
        windows.setdefault(tuple(found[i:i + 5]), []).append(i)
    again = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    n = len(found)
    return (n, sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(again),
            n < 10 or 100 * len(again) > 20 * n)


def texts(n=120, seed=8):
    r = random.Random(seed)
    words = ["the", "of", "é|", "ß#", "a", "$b", "ok\n", "\x0b", " ", "x\r\n", "line one\n"]
    return [(i, " ".join(r.choice(words) for _ in range(r.randrange(80)))) for i in range(n)]


def test_base_counts(spark):
    rows = texts() + ODD
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                  r.n_repeat_words, r.base_failed)
                 for r in compression.compression_bands(frame).collect())
    assert got == sorted((i, *plain_counts(t)) for i, t in rows)


def test_bands(spark):
    r = random.Random(1)
    prose = " ".join("".join(r.choice("etaoinshr") for _ in range(r.randrange(2, 9)))
                     for _ in range(600))
    noise = " ".join("".join(chr(r.randrange(33, 127)) for _ in range(400)) for _ in range(20))
    spaced = " ".join(f"{w}{i}" for i, w in enumerate(["same"] * 900))
    rows = [(1, prose), (2, noise), (3, spaced)]
    got = {r.doc_id: r for r in compression.compression_bands(
        spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[1].kept and not got[2].kept
    assert not any(got[i].base_failed for i in (1, 2))
    assert compression.compression_bands(spark.createDataFrame(
        [], "doc_id bigint, text string")).count() == 0


def test_vectors_are_sums_of_bound_letters():
    p = language.Profiles()
    grams, counts = language.trigrams("Abc ab".encode())
    vector = np.zeros(language.WIDTH)
    letters = p.third
    for a, b, c in ((0, 1, 2), (1, 2, 3), (2, 3, 0), (0, 1, 2), (1, 2, 0)):
        vector += np.roll(letters[a], 2) * np.roll(letters[b], 1).astype(int) * letters[c]
    assert counts.sum() == 5
    assert np.allclose(p.unit(b"Abc ab"), vector / np.linalg.norm(vector), atol=1e-5)


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    told = language.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in told if r.held_out]
    assert len(told) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in told)
    assert sum(r.lang == r.lang_pred for r in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in told)


def test_language_of_odd_texts(spark):
    rows = [(i, t, "en") for i, t in ODD] + [(1, "the cat and the dog", "en"),
                                             (2, "le chat et le chien", "fr"), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in language.language_id(docs).collect()}
    assert [got[i].lang_pred for i in (900, 901, 902, 903)] == ["und"] * 4
    kept = language.accepted(docs)
    assert kept.columns == docs.columns and 900 not in [r.doc_id for r in kept.collect()]
    assert language.language_id(docs.limit(0)).collect() == []


def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    told = rule_ensemble.sparse_rules(docs, labels).join(labels, "doc_id").where("held_out")
    rows = told.collect()
    assert sum(r.predicted == r.quality for r in rows) > 0.9 * len(rows)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_quality_without_labels_and_odd_texts(spark):
    docs = spark.createDataFrame(ODD + [(None, "no id")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r.score for r in rule_ensemble.sparse_rules(docs, none).collect()] == [0.5] * 8
    odd = spark.createDataFrame([(904, None, 1), (904, 7, 1), (None, 1, 0), (905, 1, 0)],
                                "doc_id bigint, quality int, toxic int")
    assert rule_ensemble.sparse_rules(docs, odd).count() == 8


def test_lasso_is_sparse_and_rules_agree_with_their_columns(spark):
    r = np.random.default_rng(0)
    rows = r.random((800, len(rule_ensemble.STATISTICS)))
    labels = ((rows[:, 2] > 0.5) & (rows[:, 5] <= 0.7)).astype(float)
    model = rule_ensemble.fit(rows, labels)
    assert 0 < len(model.rules) < 60
    frame = spark.createDataFrame(rows.tolist(), list(rule_ensemble.STATISTICS))
    got = np.array([x[0] for x in frame.select(model.column()).collect()])
    own = model.base + sum(w * rule.of(rows) for w, rule in model.rules)
    assert got == pytest.approx(1 / (1 + np.exp(-own)))
    assert ((got >= 0.5) == labels).mean() > 0.95


def test_short_clean_documents_are_accepted(spark):
    r = random.Random(12)
    rows = [(i, " ".join(r.choice("the house and river of mountains with songs walking to the".split())
                         for _ in range(80)), "en") for i in range(40)]
    short = [(100, "A.", "en"), (101, "Avec.", "fr"), (102, "A.\nZephyr quiz.", "en"), (103, "Erö.", "de"),
             (104, "Qvxj kzw.", None)]
    other = "".join(chr(0x4E00 + r.randrange(9000)) + " " * (k % 5 == 0) for k in range(400))
    docs = spark.createDataFrame([*rows, *short, (200, "12 3!", None), (201, None, None)],
                                 "doc_id bigint, text string, lang string")
    kept = {x.doc_id for x in language.accepted(docs).collect()}
    assert kept == {*range(40), 100, 101, 102, 103, 104}
    strict = docs.union(spark.createDataFrame([(300, other, None)], docs.schema))
    assert 300 not in {x.doc_id for x in language.accepted(strict, least=0.3).collect()}
