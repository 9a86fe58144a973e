from __future__ import annotations

import random
import re

import numpy as np
import pytest

from shelfmark.llm import chosen_path as cp
from shelfmark.llm.buffers import U


def brute(rows, size=5, percent=85):
    sets = []
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(
            b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()))
        sets.append((i, {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}
                     if len(w) >= size else {tuple(w)} if w else set()))
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: r.choice("The of énorme and x y straße".split()) + str(r.randrange(60))
    rows, n = [], 0
    for _ in range(30):
        base = [word() for _ in range(r.choice([0, 1, 4, 5, 6, 10, 30, 60, 200, 400]))]
        for _ in range(r.randrange(1, 7)):
            new = list(base)
            for _ in range(r.randrange(5)):
                if new:
                    new[r.randrange(len(new))] = word()
            rows.append((n := n + 1, r.choice([" ", "\n", "\t "]).join(new)))
    base = [word() for _ in range(300)]
    for k in range(90):                          # a family linked in chains
        new = list(base)
        for j in range(k % 12):
            new[23 * j % 300] = f"own{k if k % 3 else j}"
        rows.append((n := n + 1, " ".join(new)))
    line = " ".join(f"hot{j}" for j in range(40))
    rows += [(n + 1 + k, f"{line} {k} {k}a {k}b {k}c {k}d" + f" {k}e" * 9) for k in range(60)]
    r.shuffle(rows)
    return rows + [(9001, None), (9002, ""), (9003, " \n "), (9004, "THE"), (9005, "the"),
                   (9006, "a b"), (9007, "A  B"), (9008, "w" * 70000 + " x y z u v")]


@pytest.mark.parametrize(("leaf", "depth", "family"), [(8192, 6, 2_000_000), (5, 3, 4000),
                                                       (3, 0, 900)])
def test_against_all_pairs(spark, monkeypatch, leaf, depth, family):
    monkeypatch.setattr(cp, "LEAF", leaf)
    monkeypatch.setattr(cp, "DEPTH", depth)
    monkeypatch.setattr(cp, "FAMILY_SHINGLES", family)
    monkeypatch.setattr(cp, "BLOCK_SHINGLES", 900)
    monkeypatch.setattr(cp, "FEW", 2_000_000 if leaf > 5 else 10)
    rows = corpus(4)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert sorted(map(tuple, cp.chosen_path(frame).collect())) == brute(rows)


def test_other_rules(spark):
    rows = corpus(9)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = cp.near_copies(frame, rule=cp.Rule(words=3, percent=80)).collect()
    assert sorted(map(tuple, got)) == brute(rows, 3, 80)
    with pytest.raises(ValueError):
        cp.Rule(percent=40)


def test_parameters_follow_from_the_recall():
    assert cp.Rule().trees == 4 and cp.Rule(miss=1e-3).trees == 2
    assert 25 < cp.Rule().most_bits < 40
    r = np.random.default_rng(1)
    for similar in (0.3, 0.85):
        size, missed, gone = 400, [], 0
        for _ in range(60):
            a = r.integers(0, 2**64, size, dtype=U)
            same = round(2 * size * similar / (1 + similar))
            b = np.r_[a[:same], r.integers(0, 2**64, size - same, dtype=U)]
            pool = cp.minwise([a, b])
            missed.append((pool[:, 0] == pool[:, 1]).mean())
            gone += (((pool[:, 0] ^ pool[:, 1]) & U(1)).sum() > cp.Rule().most_bits)
        assert abs(np.mean(missed) - similar) < 0.02        # tokens agree as sets do
        assert np.std(missed) < 1.5 * (similar * (1 - similar) / cp.POOL) ** 0.5
        assert gone == (0 if similar > 0.8 else 60) or similar < 0.8 and gone > 40


def test_columns_nulls_and_empty_tables(spark):
    text = " ".join(map(str, range(60)))
    rows = [(2, text, 1), (1, text.upper() + " end", 2), (None, text, 3), (4, None, 4),
            (2, "other words here", 5), (2, text, 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id int")
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept)
           for r in cp.near_copies(docs).collect()}
    assert got == {(2, 56): (1, False), (1, 57): (1, True), (None, 56): (None, True),
                   (4, 0): (4, True), (2, 1): (1, False)}
    assert cp.near_copies(docs).count() == len(rows)
    assert cp.near_copies(docs.limit(0)).collect() == []
