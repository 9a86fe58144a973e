"""Collocations by a multikey three-way quicksort of suffix pointers.

A suffix pointer stands for a word and those that follow it in its piece of text, three at
most. Equal suffixes of a stretch of text are one pointer with a weight. Pointers are routed
by their leading word, so that all occurrences of a phrase meet in one bucket. Leading words
that are so frequent that they would fill buckets of their own are routed with their second
word, two such words in a row with the third; the counts of these pairs travel as suffixes of
two words, which again meet in one bucket each.

A bucket is sorted to the depth of the longest phrase: every partition is split by a pivot
into smaller, equal and larger keys, and the equal part goes on with the next word. The weight
of an equal part is the count of the phrase that leads to it. Partitions that are too light
are abandoned, as nothing within them can be frequent. All partitions of a bucket are split
side by side.

Words are 64-bit hashes of language and letters on the way. That no two words share one is
checked against the table of all words; if two do, the letters get other hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import folders
from shelfmark.llm.buffers import (U, byte_column, cut_points, dump, grouped, load, mix,
                                   numbers_of, planes, span_hashes)

LEAST = 10                  # occurrences of a candidate
COVERED = 50                # percent of a longer candidate that take a shorter one out
TOP = 2000                  # phrases reported of each language
DEPTH = 3                   # words of the longest candidate
STRETCH = 4 << 20           # text whose suffixes are gathered together
TOGETHER = 1 << 20          # text that is cut into words at a time
BUCKET_BYTES = 16 << 20     # text behind a bucket
HEAVY_SHARE = 8             # a word with more than an eighth of a bucket is heavy
MOST_HEAVY = 500_000        # heavy words, 8 bytes each, that are sent to all tasks

UNKNOWN = "und"
END = 0                     # stands for what follows the last word of a piece

SPACE, BREAK = 1, 2
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = SPACE
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """The words of some texts in order; ``follows`` tells those of the same piece."""

    def __init__(self, texts: list[bytes], langs: list[str | None], seed: int):
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        kind = KIND[self.data]
        inside = kind == 0
        self.start = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
        self.end = np.flatnonzero(~inside & np.r_[False, inside[:-1]])
        piece = np.cumsum(kind == BREAK)[self.start] if len(self.start) else self.start
        self.follows = piece[1:] == piece[:-1]
        self.document = np.searchsorted(np.cumsum(sizes), self.start, "right")
        self.langs = [UNKNOWN if lang is None else lang for lang in langs]
        of_lang = np.array([int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8)
                                           .digest(), "little") for lang in self.langs], U)
        plain = span_hashes(self.data ^ np.uint8(seed), self.start, self.end)
        self.key = np.maximum(mix(plain + of_lang[self.document]), U(END + 1))

    def distinct(self) -> pa.RecordBatch:
        """Each word once, with its language and count."""
        key, first, count = np.unique(self.key, return_index=True, return_counts=True)
        data, start, end = self.data.tobytes(), self.start[first], self.end[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)),
             pa.array([self.langs[d] for d in self.document[first].tolist()], pa.string()),
             pa.array([data[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)],
                      pa.binary()), pa.array(count)], ["w", "lang", "word", "f"])

    def suffixes(self) -> list[np.ndarray]:
        """The word and those that follow it, ``END`` behind a piece's last; two or more."""
        second, third = np.full(len(self.key), END, U), np.full(len(self.key), END, U)
        second[:-1][self.follows] = self.key[1:][self.follows]
        both = self.follows[:-1] & self.follows[1:]
        third[:-2][both] = self.key[2:][both]
        several = second != END
        return [self.key[several], second[several], third[several]]


def _stretches(batch: pa.RecordBatch, seed: int):
    """The words of a stretch of text, in parts: what cutting it takes is bounded."""
    texts, langs = byte_column(batch.column(0)), batch.column(1).to_pylist()
    for low, high in grouped(texts, STRETCH):
        yield (Words(texts[low + a:low + b], langs[low + a:low + b], seed)
               for a, b in grouped(texts[low:high], TOGETHER))


def _counted(seed: int):
    def run(batches):
        for batch in batches:
            for parts in _stretches(batch, seed):
                held = pa.Table.from_batches([part.distinct() for part in parts])
                key, first, of = np.unique(held.column("w").to_numpy(), return_index=True,
                                           return_inverse=True)
                total = np.zeros(len(key), np.int64)
                np.add.at(total, of, held.column("f").to_numpy())
                yield from held.take(pa.array(first)).set_column(
                    3, "f", pa.array(total)).to_batches()
    return run


# --- routing ---------------------------------------------------------------------------

def merged(columns: list[np.ndarray], weight: np.ndarray | None = None):
    """Distinct rows of some columns of numbers, with their weight."""
    bits = [int(c.max(initial=0)).bit_length() for c in columns]
    if sum(bits) < 64:                                  # one number holds a whole row
        key = np.zeros(len(columns[0]), np.int64)
        for column, size in zip(columns, bits, strict=True):
            key = key << size | column
        if weight is None:
            key.sort()
            at = cut_points(key)
            weight = np.diff(np.r_[at, len(key)])
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
            at = cut_points(key)
            weight = np.add.reduceat(weight[order], at) if len(at) else weight
        key, rows = key[at], []
        for size in reversed(bits):
            rows.append(key & (1 << size) - 1)
            key = key >> size
        return rows[::-1], weight
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    fresh = np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)]
    at = np.flatnonzero(fresh)
    weight = np.ones(len(order), np.int64) if weight is None else weight[order]
    return [c[at] for c in columns], np.add.reduceat(weight, at)


def _bucket(*words: np.ndarray) -> np.ndarray:
    value = np.zeros(len(words[0]), U)
    for word in words:
        value = mix(value + word)
    return value


def _routed(seed: int, heavy, buckets: int):
    def run(batches):
        for batch in batches:
            for parts in _stretches(batch, seed):
                suffixes = [np.concatenate(x) for x in zip(
                    *(part.suffixes() for part in parts), strict=True)]
                yield from routed(suffixes, heavy.value, buckets)
    return run


def routed(suffixes: list[np.ndarray], heavy: np.ndarray, buckets: int):
    """Distinct suffixes and their weights as blobs, a row for each bucket."""
    if not len(suffixes[0]):
        return
    known = np.unique(np.concatenate([[U(END)], *suffixes]))        # END is 0 in it
    (one, two, three), weight = merged([np.searchsorted(known, s) for s in suffixes])
    is_heavy = np.isin(known, heavy)
    pair, single = is_heavy[one] & is_heavy[two], ~is_heavy[one]
    a, b, c = (known[x] for x in (one, two, three))
    by = np.where(pair, _bucket(a, b, c), np.where(single, _bucket(a), _bucket(a, b)))
    (first, second), total = merged([one[pair], two[pair]], weight[pair])
    # The pairs of two heavy words once more, by themselves: there they are counted.
    by = np.r_[by, _bucket(known[first], known[second])]
    columns = [np.r_[one, first], np.r_[two, second], np.r_[three, np.zeros_like(first)],
               np.r_[weight, total], np.r_[pair, np.zeros(len(first), bool)]]
    bucket = (by % U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [x[order] for x in columns]
    at = cut_points(bucket)
    blobs = [_packed(known, *(x[low:high] for x in columns))
             for low, high in zip(at, np.r_[at[1:], len(bucket)], strict=True)]
    yield pa.RecordBatch.from_arrays([pa.array(bucket[at]), pa.array(blobs, pa.binary())],
                                     ["bucket", "blob"])


def _packed(known, one, two, three, weight, pair) -> bytes:
    used = np.unique(np.concatenate([one, two, three]))
    narrow = np.uint16 if len(used) < 1 << 16 else np.uint32
    words = [planes(np.searchsorted(used, x).astype(narrow)) for x in (one, two, three)]
    return dump(planes(known[used]), words, planes(weight.astype(np.uint32 if int(
        weight.max()) < 1 << 32 else np.int64)), np.packbits(pair), len(pair))


def _unpacked(blobs: list[bytes]):
    """The words of a bucket, its suffixes as numbers of words, their weights and kinds."""
    dictionaries, columns, weights, pairs = [], [], [], []
    for blob in blobs:
        known, words, weight, pair, n = load(blob)
        dictionaries.append(numbers_of(*known))
        columns.append([numbers_of(*x) for x in words])
        weights.append(numbers_of(*weight).astype(np.int64))
        pairs.append(np.unpackbits(pair, count=n).astype(bool))
    known = np.unique(np.concatenate([[U(END)], *dictionaries]))
    keys = [np.concatenate([np.searchsorted(known, d).astype(np.int32)[x[k]] for d, x in zip(
        dictionaries, columns, strict=True)]) for k in range(DEPTH)]
    return known, keys, np.concatenate(weights), np.concatenate(pairs)


# --- sorting ---------------------------------------------------------------------------

def frequent(keys: list[np.ndarray], weight: np.ndarray, least: int = LEAST):
    """Depth, a pointer and the weight of every equal partition of ``least`` or more.

    ``keys`` has the words of each suffix by depth; 0 ends a suffix.
    """
    n, deepest = len(weight), len(keys)
    flat = np.concatenate(keys) if n else np.empty(0, np.int32)
    pointer = np.arange(n, dtype=np.int32)      # a bucket has fewer suffixes than 2 ** 31
    start, depth = np.zeros(min(n, 1), np.int64), np.zeros(min(n, 1), np.int64)
    dice, found = np.random.default_rng(7), []
    while len(pointer):
        size = np.diff(np.r_[start, len(pointer)])
        pivot = flat[depth * n + pointer[start + (dice.random(len(size)) * size).astype(int)]]
        of = np.repeat(np.arange(len(start), dtype=np.int32), size)
        key = flat[(depth * n)[of] + pointer]
        side = (np.sign(key - pivot[of]) + 1).astype(np.int32)   # smaller, equal, larger
        part = 3 * of + side
        count = np.bincount(part, minlength=3 * len(start))
        begin = np.cumsum(count) - count
        place = np.empty(len(pointer), np.int32)
        for s in range(3):
            here = np.flatnonzero(side == s)
            before = np.cumsum(count[s::3]) - count[s::3]        # of this side, by partition
            place[here] = begin[part[here]] + np.arange(len(here)) - before[of[here]]
        moved = np.empty_like(pointer)
        moved[place] = pointer
        full = np.flatnonzero(count)
        total = np.add.reduceat(weight[moved], begin[full])
        equal = full % 3 == 1
        deeper = depth[full // 3] + equal
        ended = equal & (pivot[full // 3] == 0)
        phrase = equal & ~ended & (total >= least)
        found.append((deeper[phrase], moved[begin[full[phrase]]], total[phrase]))
        kept = (total >= least) & ~ended & (deeper < deepest)
        pointer = moved[np.repeat(kept, count[full])]
        size, depth = count[full[kept]], deeper[kept]
        start = np.cumsum(size) - size
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else [
        np.empty(0, np.int64)] * 3


def _sorted(least: int):
    """Frequent phrases of two words and three of each bucket; ``w3`` is 0 for two."""
    def run(batches):
        blobs: dict[int, list[bytes]] = {}
        for batch in batches:
            for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    strict=True):
                blobs.setdefault(bucket, []).append(blob)
        while blobs:
            known, keys, weight, pair = _unpacked(blobs.popitem()[1])
            for kind, shortest in ((pair, 3), (~pair, 2)):
                here = np.flatnonzero(kind)
                depth, at, total = frequent([k[here] for k in keys], weight[here], least)
                told = depth >= shortest
                depth, at, total = depth[told], here[at[told]], total[told]
                words = [np.where(depth > k, known[keys[k][at]], U(END)).view(np.int64)
                         for k in range(DEPTH)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, words), pa.array(total)], ["w1", "w2", "w3", "a"])
    return run


# --- the operator ----------------------------------------------------------------------

def phrase_counts(docs: DataFrame, least: int = LEAST, text_column: str = "text",
                  lang_column: str = "lang") -> tuple[DataFrame, DataFrame]:
    """All words with their counts, and all phrases of two and three words from ``least`` on.

    Words have their hash ``w``, ``lang``, ``word`` and count ``f``; phrases the hashes of
    their words (``w3`` is 0 where there is none) and their count ``a``.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_column).cast("binary").alias("text"),
                        F.col(lang_column).cast("string").alias("lang"))
    for seed in range(256):
        words = folders.written(texts.mapInArrow(
            _counted(seed), "w bigint, lang string, word binary, f bigint").groupBy(
            "w", "lang", "word").agg(F.sum("f").alias("f")), "words")
        if words.groupBy("w").count().where("count > 1").isEmpty():
            break
    buckets = folders.parts_for(folders.total_bytes(texts, "text"), BUCKET_BYTES)
    total = words.agg(F.sum("f")).first()[0] or 0
    share = max(least, total // (HEAVY_SHARE * buckets))
    while words.where(F.col("f") > share).count() > MOST_HEAVY:
        share *= 2
    heavy = spark.sparkContext.broadcast(np.array(
        [r.w for r in words.where(F.col("f") > share).select("w").collect()],
        np.int64).view(U))
    phrases = folders.written(
        texts.mapInArrow(_routed(seed, heavy, buckets), "bucket bigint, blob binary")
        .repartition(buckets, "bucket")
        .mapInArrow(_sorted(least), "w1 bigint, w2 bigint, w3 bigint, a bigint"), "phrases")
    return words, phrases


def score(a: Column, l: Column, r: Column) -> Column:  # noqa: E741
    """``floor(1000000 * a * a / (l * r))``, exact for counts below 10 ** 16."""
    a, l, r = (x.cast("decimal(16,0)") for x in (a, l, r))  # noqa: E741
    above = (a * a).cast("decimal(32,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", above.cast("decimal(38,0)"), (l * r).cast("decimal(38,0)"))


def lowest(a: Column, cuts: list[tuple[Column, Column]]) -> Column:
    """Score, ``l`` and ``r`` of the lowest cut; of equals, the first."""
    return F.array_min(F.array(*(
        F.struct(score(a, l, r).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))
        for k, (l, r) in enumerate(cuts))))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language, and what their scores rest on.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts at its lowest-scoring cut, ``n``
    all words of the language. Null and empty texts have no words; null languages are
    ``und``. Rows that repeat count each; other columns, ids too, are not read. Bytes that
    are not UTF-8 are letters like others.
    """
    words, phrases = phrase_counts(docs, least)
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    common = words.where(F.col("f") >= least).withColumn("word", F.col("word").cast("string"))

    def word(k: int) -> DataFrame:
        return common.select(F.col("w").alias(f"w{k}"), F.col("word").alias(f"word{k}"),
                             F.col("f").alias(f"f{k}"), *[F.col("lang")] * (k == 1))

    twos = phrases.where(f"w3 = {END}").drop("w3")
    threes = phrases.where(f"w3 <> {END}")
    left = twos.withColumnRenamed("a", "f12")
    right = twos.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"),
                        F.col("a").alias("f23"))
    inside = threes.select("w1", "w2", "a").unionByName(threes.select(
        F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")).groupBy("w1", "w2").agg(
        F.max("a").alias("longer"))
    col = F.col
    two = twos.join(inside, ["w1", "w2"], "left") \
        .where(F.coalesce(100 * col("longer") < COVERED * col("a"), F.lit(True))) \
        .join(word(1), "w1").join(word(2), "w2") \
        .select("lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a",
                lowest(col("a"), [(col("f1"), col("f2"))]).alias("cut"))
    three = threes.join(left, ["w1", "w2"]).join(right, ["w2", "w3"]) \
        .join(word(1), "w1").join(word(2), "w2").join(word(3), "w3") \
        .select("lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a",
                lowest(col("a"), [(col("f1"), col("f23")), (col("f12"), col("f3"))])
                .alias("cut"))
    ranked = two.unionByName(three).select("lang", "phrase", "a", "cut.l", "cut.r",
                                           "cut.score").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(
            F.desc("score"), F.desc("a"), "phrase"))).where(col("rank") <= top)
    return ranked.join(F.broadcast(n), "lang").select(
        "lang", col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = LEAST, top: int = TOP) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws
  FROM pieces),
suffixes AS (
  SELECT lang, s[1] AS w1, s[2] AS w2, s[3] AS w3 FROM (
    SELECT lang, unnest(list_zip(ws, ws[2:], ws[3:])) AS s FROM worded)),
f1 AS (SELECT lang, w1, count(*) AS f FROM suffixes GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS a FROM suffixes WHERE w2 IS NOT NULL GROUP BY ALL
       HAVING count(*) >= {least}),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS a FROM suffixes WHERE w3 IS NOT NULL GROUP BY ALL
       HAVING count(*) >= {least}),
cuts AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.a, x.f AS l, y.f AS r, 1 AS k
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1
    JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
  WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.a >= {COVERED} * f2.a
    AND f3.w1 = f2.w1 AND f3.w2 = f2.w2)
  AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = f2.lang AND 100 * f3.a >= {COVERED} * f2.a
    AND f3.w2 = f2.w1 AND f3.w3 = f2.w2)
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.a, x.f, y.a, 1
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1
    JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.a, x.a, y.f, 2
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2
    JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3),
scored AS (
  SELECT *, 1000000 * a::HUGEINT * a // (l::HUGEINT * r) AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM scored)
SELECT lang, rank, phrase, a, l, r,
  (SELECT sum(f)::BIGINT FROM f1 WHERE f1.lang = ranked.lang) AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {top}"""
