"""Alignment of two tokenizers through inverted pair bitmaps.

Both tokenizers cut the same bytes. Where a token of each ends at the same byte, the text is
cut into groups; every pair of a token of A and one of B within a group is linked.

Documents are indexed in segments of bounded size, by their place in it. A segment holds, for
every linked pair, a compressed bitmap of its documents (an ordered list of places, or bits
where the pair is in many documents of the segment), OR-merged from the pieces of text that
are encoded together, and multiplicity planes: a bit of plane ``k`` says whether ``2**k``
is part of the number of links in a document. Cardinalities of a pair's bitmaps, added up over
the segments, are its count of documents; planes weigh its links. The counts return to the
segments that hold the pair, whose postings add them up for every document.

Segments stay where they are made: a hot pair has one bitmap and one row a segment, never
a list of all documents.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import bpe, folders
from shelfmark.llm.buffers import cut_points, dump, load, numbers_of, planes

SEGMENT_DOCS = 8192           # documents of a segment; a place needs 13 bits
SEGMENT_BYTES = 8 << 20       # text of a segment; a longer text is one of its own
TOGETHER = 1 << 20            # text encoded together
DENSE = 16                    # a pair in every DENSE-th document of a segment has bits
PLACE = 13                    # bits of a place
UNIQUE = 4096                 # links of a group from which equal tokens are counted first
FEW = 300_000                 # pairs of 21 bytes that may be broadcast

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"


# --- vocabularies ----------------------------------------------------------------------

def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def read_byte_level(path: str) -> list[bytes]:
    """Tokens by id of a byte-level vocabulary whose merges are in the order of their ids."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    letter = _byte_letters()
    names = sorted(model["vocab"], key=model["vocab"].get)
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    if names[len(names) - len(merged):] != merged or len(names) - len(merged) != 256:
        raise ValueError("the ids of the vocabulary must follow its merges")
    return [bytes(letter[c] for c in name) for name in names]


class ByteLevel:
    """Tokenizer A. Special tokens are ordinary text."""

    def __init__(self, tokens: list[bytes]):
        self.inner = bpe.Vocabulary(tokens)
        self.sizes = self.inner.sizes.astype(np.int64)
        self.names = [f"{i}{end}" for i in range(len(tokens)) for end in ",|"]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self.inner.encode([b" " + t for t in texts])
        return ids.astype(np.int64), np.asarray(counts, np.int64)

    def joined(self, ids: np.ndarray) -> bytes:
        return self.inner.decode(ids)


class Pieces:
    """Tokenizer B, a model of pieces with bytes for what it does not know."""

    def __init__(self, model: bytes):
        self.inner = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.tokens = []
        for i in range(self.inner.vocab_size()):
            name = self.inner.id_to_piece(i)
            self.tokens.append(bytes([int(name[3:5], 16)]) if self.inner.is_byte(i)
                               else name.replace("▁", " ").encode())
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.names = [f"{i}{end}" for i in range(len(self.tokens)) for end in ",;"]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lists = self.inner.encode([t.decode() for t in texts], num_threads=1) if texts else []
        counts = np.array([len(x) for x in lists], np.int64)
        return np.array([i for x in lists for i in x], np.int64), counts

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


# --- one piece of text -----------------------------------------------------------------

@dataclass
class Aligned:
    """What the documents of a piece of text have, and their linked pairs."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    pair: np.ndarray        # sorted with place: a * size of B + b
    place: np.ndarray
    times: np.ndarray


def _encodable(text: bytes | None) -> bool:
    if not text:
        return False
    try:
        text.decode()
    except UnicodeDecodeError:
        return False
    return True


def _split(tokenizer, texts: list[bytes]):
    """Ids and counts; texts whose tokens do not give them back have none."""
    ids, counts = tokenizer.encode(texts)
    at = np.r_[0, np.cumsum(counts)]
    if tokenizer.joined(ids) == b"".join(b" " + t for t in texts):
        size = np.add.reduceat(tokenizer.sizes[ids], at[:-1]) if len(texts) else counts
        if np.array_equal(size, [len(t) + 1 for t in texts]):
            return ids, counts, np.ones(len(texts), bool)
    whole = np.array([tokenizer.joined(ids[low:high]) == b" " + t
                      for t, low, high in zip(texts, at, at[1:], strict=False)], bool)
    return ids, counts, whole


def align(texts: list[bytes | None], a: ByteLevel, b: Pieces) -> Aligned:
    """Groups and links of each text."""
    n = len(texts)
    found = Aligned(*(np.zeros(n, np.int64) for _ in range(4)), [""] * n,
                    *(np.zeros(0, np.int64) for _ in range(3)))
    rows = np.array([i for i, t in enumerate(texts) if _encodable(t)], np.int64)
    if not len(rows):
        return found
    some = [texts[i] for i in rows.tolist()]
    a_ids, a_counts, a_whole = _split(a, some)
    b_ids, b_counts, b_whole = _split(b, some)
    whole = a_whole & b_whole
    a_ids, b_ids = a_ids[np.repeat(whole, a_counts)], b_ids[np.repeat(whole, b_counts)]
    rows, a_counts, b_counts = rows[whole], a_counts[whole], b_counts[whole]
    if not len(rows):
        return found

    a_end, b_end = np.cumsum(a.sizes[a_ids]), np.cumsum(b.sizes[b_ids])
    ends = np.intersect1d(a_end, b_end, assume_unique=True)
    a_group, b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
    in_a = np.bincount(a_group, minlength=len(ends))
    in_b = np.bincount(b_group, minlength=len(ends))
    a_first, b_first = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    place = np.repeat(np.arange(len(rows)), a_counts)[a_first]      # of each group
    found.n_a[rows], found.n_b[rows] = a_counts, b_counts
    found.n_groups[rows] = np.bincount(place, minlength=len(rows))
    np.add.at(found.n_links, rows[place], in_a * in_b)
    for row, digest in zip(rows.tolist(), _digests(
            a, b, a_ids, b_ids, a_counts, b_counts, a_group, b_group, in_a, in_b),
            strict=True):
        found.digests[row] = digest
    pairs = _links(a_ids, b_ids, in_a, in_b, a_first, b_first, rows[place], len(b.sizes))
    found.pair, found.place, found.times = pairs
    return found


def _digests(a, b, a_ids, b_ids, a_counts, b_counts, a_group, b_group, in_a, in_b):
    """Of each document's groups as text: tokens of A, then of B, group after group."""
    a_till, b_till = np.cumsum(in_a), np.cumsum(in_b)
    a_at, b_at = np.arange(len(a_ids)), np.arange(len(b_ids))
    code = np.empty(len(a_ids) + len(b_ids), np.int64)
    code[a_at + (b_till - in_b)[a_group]] = 2 * a_ids + (a_at + 1 == a_till[a_group])
    code[b_at + a_till[b_group]] = len(a.names) + 2 * b_ids + (b_at + 1 == b_till[b_group])
    names = a.names + b.names
    at = np.r_[0, np.cumsum(a_counts + b_counts)].tolist()
    for low, high in zip(at, at[1:], strict=False):
        text = "".join(map(names.__getitem__, code[low:high].tolist()))
        yield hashlib.sha256(text[:-1].encode()).hexdigest()


def _links(a_ids, b_ids, in_a, in_b, a_first, b_first, place, b_size):
    """Distinct (pair, place) in order, with the number of links of each."""
    keys, weights = [], []
    links = in_a * in_b
    plain = np.flatnonzero(links < UNIQUE)
    width = np.repeat(in_b[plain], in_a[plain])                 # for each token of A
    of_a = _ranges(a_first[plain], in_a[plain])
    first_b = np.repeat(b_first[plain], in_a[plain])
    pair = np.repeat(a_ids[of_a], width) * b_size + b_ids[_ranges(first_b, width)]
    keys.append(pair << PLACE | np.repeat(place[plain], links[plain]))
    weights.append(np.ones(len(pair), np.int64))
    for g in np.flatnonzero(links >= UNIQUE).tolist():
        own, many = np.unique(a_ids[a_first[g]:a_first[g] + in_a[g]], return_counts=True)
        other, more = np.unique(b_ids[b_first[g]:b_first[g] + in_b[g]], return_counts=True)
        keys.append((np.add.outer(own * b_size, other) << PLACE | place[g]).ravel())
        weights.append(np.multiply.outer(many, more).ravel())
    key, weight = np.concatenate(keys), np.concatenate(weights)
    if len(keys) == 1:                                      # all weights are one
        key.sort()
        at = cut_points(key)
        times = np.diff(np.r_[at, len(key)])
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = cut_points(key)
        times = np.add.reduceat(weight[order], at)
    key = key[at]
    return key >> PLACE, key & (1 << PLACE) - 1, times


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``first[0], first[0] + 1, ...`` for each size, one after another."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


# --- segments --------------------------------------------------------------------------

class Bitmaps:
    """For sorted pairs the compressed bitmap of their documents, and multiplicity planes."""

    def __init__(self, pair, place, times, documents: int):
        first = cut_points(pair)
        self.pair, self.cards = pair[first], np.diff(np.r_[first, len(pair)])
        self.words = -(-documents // 64)
        self.dense = self.cards * DENSE >= documents
        wide = np.repeat(self.dense, self.cards)
        self.listed = place[~wide].astype(np.uint16)
        row = np.repeat(np.cumsum(self.dense) - 1, self.cards)[wide]
        self.bits = np.zeros((int(self.dense.sum()), self.words), np.uint64)
        at = place[wide]
        np.bitwise_or.at(self.bits, (row, at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
        # Each piece of text has set its bits; what they hold together is counted from them.
        self.cards[self.dense] = np.bitwise_count(self.bits).sum(axis=1)
        most = int(times.max(initial=0))
        self.planes = [np.packbits(times >> k & 1) for k in range(most.bit_length())]

    def postings(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and multiplicities, pair after pair."""
        wide = np.repeat(self.dense, self.cards)
        place = np.empty(len(wide), np.int64)
        place[~wide] = self.listed
        spread = np.unpackbits(self.bits.view(np.uint8), axis=1, bitorder="little")
        place[wide] = np.nonzero(spread)[1]
        times = np.zeros(len(wide), np.int64)
        for k, plane in enumerate(self.planes):
            times += np.unpackbits(plane, count=len(wide)).astype(np.int64) << k
        return place, times

    def links(self) -> np.ndarray:
        """Links of each pair: the bits it has in plane ``k`` count ``2**k``."""
        first, total = np.cumsum(self.cards) - self.cards, np.zeros(len(self.cards), np.int64)
        for k, plane in enumerate(self.planes):
            bits = np.unpackbits(plane, count=int(self.cards.sum())).astype(np.int64)
            total += np.add.reduceat(bits, first) << k
        return total

    def packed(self) -> tuple:
        steps = np.diff(self.pair, prepend=self.pair[:1])
        return (int(self.pair[0]) if len(self.pair) else 0, planes(steps),
                planes(self.cards.astype(np.uint16)), np.packbits(self.dense),
                planes(self.listed), planes(self.bits.ravel()), self.words,
                [planes(p) for p in self.planes])

    @classmethod
    def unpacked(cls, low, steps, cards, dense, listed, bits, words, held) -> Bitmaps:
        new = cls.__new__(cls)
        new.pair = np.cumsum(numbers_of(*steps)) + low
        new.cards = numbers_of(*cards).astype(np.int64)
        new.dense = np.unpackbits(dense, count=len(new.pair)).astype(bool)
        new.listed, new.words = numbers_of(*listed), words
        new.bits = numbers_of(*bits).reshape(-1, words)
        new.planes = [numbers_of(*p) for p in held]
        return new


@dataclass
class Segment:
    """Documents gathered until they are as many as a segment may have."""

    ids: list = field(default_factory=list)
    parts: list[Aligned] = field(default_factory=list)
    size: int = 0

    def add(self, ids: list, texts: list[bytes | None], a: ByteLevel, b: Pieces) -> None:
        part = align(texts, a, b)
        part.place = part.place + len(self.ids)
        self.parts.append(part)
        self.ids += ids
        self.size += sum(len(t or b"") for t in texts)

    def rows(self, number: int, b_size: int):
        """The segment as one row, then a row for each of its pairs."""
        pair, place, times = (np.concatenate([getattr(p, c) for p in self.parts])
                              for c in ("pair", "place", "times"))
        order = np.argsort(pair << PLACE | place, kind="stable")
        held = Bitmaps(pair[order], place[order], times[order], len(self.ids))
        counts = [np.concatenate([getattr(p, c) for p in self.parts])
                  for c in ("n_a", "n_b", "n_groups", "n_links")]
        blob = dump(self.ids, counts, [d for p in self.parts for d in p.digests],
                    held.packed())
        yield _rows(number, None, None, None, None, blob)
        links = held.links()
        for low in range(0, len(links), 1 << 16):
            part = slice(low, low + (1 << 16))
            yield _rows(number, held.pair[part] // b_size, held.pair[part] % b_size,
                        held.cards[part], links[part], None)


def _rows(number, a, b, docs, links, blob) -> pa.RecordBatch:
    n = 1 if a is None else len(a)
    plain = lambda x, kind: pa.nulls(n, kind) if x is None else pa.array(x, kind)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, number)), plain(a, pa.int32()), plain(b, pa.int32()),
         plain(docs, pa.int64()), plain(links, pa.int64()),
         pa.array([blob] * n, pa.binary())],
        ["segment", "a", "b", "docs", "links", "blob"])


_tokenizers: dict[tuple, tuple] = {}


def _indexed(shared, key):
    def run(batches):
        if key not in _tokenizers:
            tokens, model = shared.value
            _tokenizers[key] = ByteLevel(tokens), Pieces(model)
        a, b = _tokenizers[key]
        number, now = TaskContext.get().partitionId() << 32, Segment()
        for batch in batches:
            for ids, texts in _chunks(batch):
                size = sum(len(t or b"") for t in texts)
                if now.ids and (now.size + size > SEGMENT_BYTES
                                or len(now.ids) + len(ids) > SEGMENT_DOCS):
                    yield from now.rows(number, len(b.sizes))
                    number, now = number + 1, Segment()
                now.add(ids, texts, a, b)
        if now.ids:
            yield from now.rows(number, len(b.sizes))
    return run


def _chunks(batch: pa.RecordBatch):
    """Rows of about ``TOGETHER`` bytes of text, at most an eighth of a segment's documents."""
    ids, texts, size = [], [], 0
    for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        text = text.as_py()
        if ids and (size + len(text or b"") > TOGETHER or len(ids) >= SEGMENT_DOCS // 8):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(i)
        texts.append(text)
        size += len(text or b"")
    if ids:
        yield ids, texts


def _scores(b_size: int):
    """Counts that have returned to a segment, added up for its documents."""
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({n: pa.array([], pa.string() if n == "groups_sha256" else pa.int64())
                             for n in names})
        ids, counts, digests, packed = load(left.column("blob")[0].as_py())
        held = Bitmaps.unpacked(*packed)
        pair = right.column("a").to_numpy().astype(np.int64) * b_size \
            + right.column("b").to_numpy()
        order = np.argsort(pair)
        if not np.array_equal(pair[order], held.pair):
            raise ValueError("pairs and counts of a segment differ")
        count = np.repeat(right.column("count").to_numpy()[order], held.cards)
        best = np.repeat(right.column("is_best").to_numpy(zero_copy_only=False)[order],
                         held.cards)
        place, times = held.postings()
        n_best, total = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        np.add.at(n_best, place[best], times[best])
        np.add.at(total, place, times * count)
        columns = [ids, *counts, n_best, total, digests]
        return pa.table([pa.array(c, pa.string() if n == "groups_sha256" else pa.int64())
                         for n, c in zip(names, columns, strict=True)], names)
    return run


# --- the operator ----------------------------------------------------------------------

class Index:
    """Segments of a table of documents, written in the shared folder.

    ``pairs`` has, for every pair of ids that are linked somewhere, the number of documents
    that hold it linked, of its links, and whether no pair of its ``a`` has more documents.
    Every row is a document of its own, also where ids repeat or are null.
    """

    def __init__(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 a_path: str | None = None, b_path: str | None = None):
        a_path = a_path or bpe.vocabulary_path(A_FILE)
        b_path = b_path or bpe.vocabulary_path(B_FILE)
        with open(b_path, "rb") as file:
            model = file.read()
        self.b_size = sentencepiece.SentencePieceProcessor(model_proto=model).vocab_size()
        shared = docs.sparkSession.sparkContext.broadcast((read_byte_level(a_path), model))
        self.table = folders.written(
            docs.select(F.col(id_column).cast("bigint").alias("id"),
                        F.col(text_column).cast("binary").alias("text"))
            .mapInArrow(_indexed(shared, (a_path, b_path)),
                        "segment bigint, a int, b int, docs bigint, links bigint, blob binary"),
            "pair-segments")
        self.postings = self.table.where("a IS NOT NULL").select(
            "segment", "a", "b", "docs", "links")
        counts = folders.written(self.postings.groupBy("a", "b").agg(
            F.sum("docs").alias("count"), F.sum("links").alias("links")), "pair-counts")
        best = counts.groupBy("a").agg(F.max("count").alias("best"))
        self.pairs = counts.join(best, "a").select(
            "a", "b", "count", "links", (F.col("count") == F.col("best")).alias("is_best"))

    def scored(self) -> DataFrame:
        """Each document's tokens, groups, links, and what its links' counts add up to."""
        known = folders.small_enough(folders.written(
            self.pairs.drop("links"), "pair-scores"), FEW)
        back = self.postings.select("segment", "a", "b").join(known, ["a", "b"])
        return self.table.where("blob IS NOT NULL").select(
            F.col("segment").alias("at"), "blob").groupBy("at").cogroup(
            back.groupBy("segment")).applyInArrow(
            _scores(self.b_size), "id bigint, n_a bigint, n_b bigint, n_groups bigint, "
            "n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string")


def cross_tokenizer_alignment(docs: DataFrame) -> DataFrame:
    """Groups, links and scores of every row of ``doc_id`` and ``text``.

    Texts that are null, empty, not UTF-8, or that the tokens of A or B do not give back have
    no tokens: zeros and an empty ``groups_sha256``. A very long text is a segment of its own.
    Rows that repeat an id, or have none, are documents of their own. Other columns are not read.
    """
    return Index(docs).scored().withColumnRenamed("id", "doc_id")
