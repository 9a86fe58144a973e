from __future__ import annotations

import random
import re

import pytest

from shelfmark.llm import jaccard
from shelfmark.llm.components import components


def brute(rows):
    sets = []
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(
            b + 32 if 65 <= b <= 90 else b for b in (t or "").encode()))
        sets.append((i, {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) > 2
                     else {tuple(w)} if w else set()))
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i)) for i, s in sets)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: r.choice("The of énorme and x y straße".split()) + str(r.randrange(40))
    rows, n = [], 0
    for _ in range(25):
        base = [word() for _ in range(r.choice([0, 1, 2, 3, 11, 12, 30, 60, 200, 400]))]
        for _ in range(r.randrange(1, 7)):
            new = list(base)
            for _ in range(r.randrange(4)):
                if new:
                    new[r.randrange(len(new))] = word()
            rows.append((n := n + 1, r.choice([" ", "\n", "\t "]).join(new)))
    base = [word() for _ in range(300)]
    for k in range(60):                       # a large family, linked in chains
        new = list(base)
        for j in range(k % 12):
            new[25 * j % 300] = f"own{k if k % 3 else j}"
        rows.append((n := n + 1, " ".join(new)))
    line = " ".join(f"hot{j}" for j in range(15))
    rows += [(n + 1 + k, f"{line} {k} {k}a {k}b") for k in range(40)]
    r.shuffle(rows)
    return rows + [(9001, None), (9002, ""), (9003, " \n "), (9004, "THE"), (9005, "the"),
                   (9006, "a b"), (9007, "A  B"), rows[0]]


@pytest.mark.parametrize("block", [1_000_000, 900])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard, "BUCKET_BYTES", 9000)
    rows = corpus(4)
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(map(tuple, jaccard.ngram_jaccard_join(frame).collect()))
    assert got == brute(rows)


def test_one_of_each_keeps_columns_and_nulls(spark):
    text = " ".join(map(str, range(30)))
    rows = [(2, text, "a", 1), (1, text.upper(), None, 2), (None, text, "c", 3), (4, None, "d", 4),
            (5, None, "e", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id string, n int")
    kept = {tuple(r) for r in jaccard.one_of_each(docs).collect()}
    assert kept == {rows[1], rows[2], rows[3], rows[4]}
    assert jaccard.one_of_each(docs.limit(0)).columns == docs.columns
    assert jaccard.jaccard_classes(docs.limit(0)).collect() == []


def test_components_of_paths_and_cycles(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 102), (102, 100), (7, 7)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    got = dict(map(tuple, components(frame).collect()))
    assert got == {**dict.fromkeys(range(1, 41), 1), 100: 100, 101: 100, 102: 100}


def brute_near(rows, size, percent):
    sets = []
    for i, t in rows:
        w = (t or "").lower().split()
        sets.append((i, {tuple(w[k:k + size]) for k in range(len(w) - size + 1)}
                     if len(w) >= size else {tuple(w)} if w else set()))
    group = {i: i for i, _ in sets}
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b) and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {x: low if g == high else g for x, g in group.items()}
    return sorted((i, len(s), group[i]) for i, s in sets)


@pytest.mark.parametrize(("words", "percent"), [(5, 80), (4, 75), (1, 90)])
def test_other_rules_against_all_pairs(spark, monkeypatch, words, percent):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 900)
    monkeypatch.setattr(jaccard, "BUCKET_BYTES", 9000)
    rows = [(i, t.replace("É", "é") if t else t) for i, t in dict(corpus(7)).items()]
    rows += [(9100 + k, " ".join(f"short{j}" for j in range(k))) for k in range(3, 13)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(map(tuple, jaccard.jaccard_classes(
        frame, rule=jaccard.Rule(words, percent)).collect()))
    assert got == brute_near(rows, words, percent)
