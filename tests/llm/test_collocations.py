from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import collocations as co


def brute(rows, least=10, top=2000):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    key = (lang, *w[i:i + k])
                    f[key] = f.get(key, 0) + 1
    found = {}
    for key, a in f.items():
        if len(key) < 3 or a < least:
            continue
        lang, words = key[0], key[1:]
        cuts = []
        for k in range(1, len(words)):
            l, r = f[(lang, *words[:k])], f[(lang, *words[k:])]
            cuts.append((1000000 * a * a // (l * r), k, l, r))
        found[key] = (a, *min(cuts))
    kept = []
    longer = {}
    for key, (a, *_) in found.items():
        if len(key) == 4:
            for inner in (key[:3], (key[0], *key[2:])):
                longer[inner] = max(longer.get(inner, 0), a)
    for key, (a, score, _, l, r) in found.items():
        if 100 * longer.get(key, 0) < 50 * a:
            kept.append((key[0], -score, -a, b" ".join(key[1:]), l, r))
    out, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(kept):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, l, r, n[lang], -score))
    return out


def corpus(seed, n=400):
    r = random.Random(seed)
    some = ["the", "The", "of", "é", "Straße", "x-y", "a\x00b", "w\x85z", "one two", "red  herring",
            "in\tspite of", "hot dog stand", "hot dog"] + [f"w{i}" for i in range(30)]
    def text():
        words = r.choices(some, weights=[30, 20, 15] + [3] * (len(some) - 3), k=r.randrange(60))
        return "".join(w + r.choice([" ", " ", " ", "  ", ". ", "\n", "!", "\x0b", ":"])
                       for w in words)
    rows = [(text(), r.choice(["en", "de", None, "und"])) for _ in range(n)]
    return rows + [(None, "en"), ("", None), ("the " * 3000, "en"), ("same same", "fr")] \
        + [("very common pair", "en")] * 40


def run(spark, rows, **more):
    frame = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    return sorted(map(tuple, co.collocations(frame, **more).collect()))


@pytest.mark.parametrize("bucket", [16 << 20, 900])
def test_against_plain_counts(spark, monkeypatch, bucket):
    monkeypatch.setattr(co, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(co, "STRETCH", 5000 if bucket == 900 else 4 << 20)
    rows = corpus(3)
    assert run(spark, rows) == sorted(brute(rows))
    assert run(spark, rows[:100], least=3, top=7) == sorted(brute(rows[:100], 3, 7))


def test_sql_and_columns(spark):
    rows = corpus(8)
    documents = pd.DataFrame([(t, lang) for t, lang in rows], columns=["text", "lang"])  # noqa: F841
    assert sorted(duckdb.sql(co.collocations_sql()).fetchall()) == sorted(brute(rows))
    frame = spark.createDataFrame(rows, "text string, lang string").select(
        "*", F.lit("x").alias("word"), F.lit(1).alias("w1"), F.lit(None).alias("doc_id"))
    assert sorted(map(tuple, co.collocations(frame).collect())) == sorted(brute(rows))
    assert co.collocations(frame.limit(0)).collect() == []
    assert co.collocations(frame.where("text = ''")).collect() == []


def test_other_hashes_when_two_words_share_one(spark, monkeypatch):
    plain, tried = co._counted, []

    def shared(seed):
        tried.append(seed)
        inner = plain(seed)

        def run(batches):
            for batch in batches:
                for one in inner([batch]):
                    yield one if seed else one.set_column(0, "w", pa.array([5] * len(one)))
        return run

    monkeypatch.setattr(co, "_counted", shared)
    rows = corpus(5, 60)
    assert run(spark, rows) == sorted(brute(rows)) and tried == [0, 1]


def test_sorting_against_counts():
    r = np.random.default_rng(4)
    for n in (0, 1, 50, 4000):
        keys = [np.minimum(r.geometric(0.1, n), 40).astype(np.int32) for _ in range(3)]
        keys[2][r.random(n) < 0.3] = 0
        weight = r.integers(1, 5, n)
        depth, at, total = co.frequent(keys, weight, 6)
        got = sorted((tuple(int(keys[k][p]) for k in range(d)), int(t))
                     for d, p, t in zip(depth, at, total))
        want = Counter()
        for i in range(n):
            row = tuple(int(k[i]) for k in keys)
            for d in (1, 2, 3):
                if 0 not in row[:d]:
                    want[row[:d]] += int(weight[i])
        assert got == sorted((p, t) for p, t in want.items() if t >= 6)


def test_scores_past_64_bits(spark):
    r = random.Random(2)
    rows = [(a, a + r.randrange(10 ** 15), a + r.randrange(10 ** 9))
            for a in [r.randrange(1, 10 ** k) for k in range(1, 16) for _ in range(20)]]
    frame = spark.createDataFrame(rows, "a bigint, l bigint, r bigint")
    got = frame.select("a", "l", "r", co.score(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    assert all(x.s == 1000000 * x.a * x.a // (x.l * x.r) for x in got.collect())
