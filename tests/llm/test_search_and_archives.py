from __future__ import annotations

import hashlib

import numpy as np
import pytest

from shelfmark.llm import hamming_index, warc


def brute(rows, k, every):
    fine = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all()
            and np.any(v) and len(v) == 16]
    out = {}
    for q, v in fine:
        if q % every == 0:
            near = sorted(((-float((v * w).sum()), j) for j, w in fine if j != q))[:k]
            out[q] = [(j, -s) for s, j in near]
    return out


@pytest.mark.parametrize("block", [8192, 100])
def test_recall_and_ties(spark, monkeypatch, block):
    monkeypatch.setattr(hamming_index, "INDEX_BLOCK", block)
    monkeypatch.setattr(hamming_index, "QUERY_BLOCK", 30)
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=16).astype(np.float32).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[40][1]) for i in range(150)]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16),
             (2060, [None] + [1.0] * 15), (2080, [float("inf")] * 16), (2100, [1.0]), (None, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    got = {}
    for row in hamming_index.nearest(frame).orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row.rank == len(got[row.query_id])
    want = brute(rows, 20, 20)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)
    assert [j for j, _ in got[40]] == list(range(1000, 1020))
    few = spark.createDataFrame(rows[:5], "vec_id bigint, embedding array<float>")
    assert hamming_index.nearest(few).count() == 4
    assert hamming_index.nearest(few.limit(0)).collect() == []


def test_pigeonhole_misses_no_code():
    r = np.random.default_rng(0)
    codes = r.integers(0, 256, (500, 4)).astype(np.uint8)
    tables = hamming_index.Tables(codes)
    for code in codes[:20]:
        apart = np.unpackbits(codes ^ code, axis=1).sum(axis=1)
        for radius in (0, 1, 3, 7, 12, 32):
            assert tables.within(code, radius).tolist() == np.flatnonzero(
                apart <= radius).tolist()


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 7)
    monkeypatch.setattr(warc, "CAPTURES_PER_PART", 9)
    long = "<p>WARC/1.1\r\n\r\né" + "x" * 1200
    rows = [(i, f"http://h{i % 3}.example.org:80/p/{i % 5}?q#f", long + str(i % 4)) for i in range(30)]
    rows += [(50, None, None), (51, "not a url", ""), (52, "http://a/ b\nc", "short"),
             (53, "http://a/x", "short"), (None, "http://b/", "no id"), (5, "http://b/", long + "1")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(2)
    largest = {}
    for i, _, html in rows:
        if html and len(html.encode()) >= 1000:
            largest[html] = max(i, largest.get(html, i))
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        first = largest.get(html)
        want.append((i, len(data), hashlib.sha1(data).hexdigest(),
                     "revisit" if first not in (None, i) else "response",
                     first if first not in (None, i) else None))
    got = [tuple(r) for r in warc.capture_index(pages).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert warc.capture_index(pages.limit(0)).collect() == []


def test_looking_up_few_keys(spark):
    rows = [(i, f"http://site{i % 9}.org/{i}", "x") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    folder = warc.write_archives(pages)
    index = warc.build_index(spark, folder)
    keys = spark.createDataFrame([("org,site4)/4",), ("org,site0)/299",), ("zzz",)], "key string")
    found = warc.look_up(index, keys)
    assert [r.key for r in found.collect()] == ["org,site4)/4"]
    record = warc.read_captures(spark, folder, found).first()
    assert record.page_id == 4 and record.payload == b"x"
