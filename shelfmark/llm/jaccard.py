"""Jaccard join of word shingles through a token-group matrix.

Sets are collapsed first: documents of the same set are one class with its smallest document
as representative. Of a set of n shingles, rarest first, only the *prefix* of ``n - t + 3``
matters for finding partners: a partner shares ``t`` shingles with it, and so three of those.
Representatives are partitioned into groups of similar documents by their most shared prefix
shingle. The matrix holds, for each shingle, the groups whose union of prefixes has it. A
document opens a group only if it shares three shingles with the union, counting those of
members of a fitting size; then its whole set is compared with the members'.

Groups are opened in blocks of bounded size. Within a block a document that is linked
already is not compared with those it is linked to, so that a block of near copies costs one
pass; links are reported up to connectivity.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import folders
from shelfmark.llm.buffers import (U, byte_column, concat, cut_points, dump, grouped, load,
                                   mix, span_hashes)
from shelfmark.llm.components import components
from shelfmark.llm.compression import words

WORDS = 3
PERCENT = 90                # similarity from which two sets are linked
SKETCH = 20                 # log2 of the slots that count shingles; a fixed size
RANGES = 64                 # rows in which slot counts are summed
SHARED = 3                  # prefix shingles that a pair has to share
BUCKET_BYTES = 8 << 20      # text behind a bucket of the matrix
BLOCK_SHINGLES = 1_000_000  # shingles of a block of a group
PAIRS = 1 << 20             # pairs (document, group) looked at together

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass(frozen=True)
class Rule:
    """When two sets of shingles of so many words are linked, and what follows from it."""

    words: int = WORDS
    percent: int = PERCENT

    def __post_init__(self):
        # Sets that are linked without being equal then have SHARED shingles in common.
        if self.words < 1 or not 75 <= self.percent < 100:
            raise ValueError("shingles have a word or more, similarities are 75 to 99 percent")

    def linked(self, shared, n, m):
        return 100 * shared >= self.percent * (n + m - shared)

    def fits(self, n, m):
        """Whether sets of n and m can be linked."""
        return (100 * m >= self.percent * n) & (100 * n >= self.percent * m)

    def least_overlap(self, n):
        """Shingles that a set of n shares at least with any set it is linked to."""
        return -(-self.percent * n // 100)

    @property
    def least_size(self) -> int:
        """Smaller sets are linked to equal ones only."""
        return -(-self.percent // (100 - self.percent))


def shingle_sets(texts: list[bytes], size: int = WORDS) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes.

    Fewer words than ``size`` make one shingle of all of them; no word, none.
    """
    sizes = np.array([len(t) + 1 for t in texts])
    data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    start, end = words(data)
    if not len(start):
        return [np.empty(0, U)] * len(texts)
    word = span_hashes(data, start, end)
    bound = np.searchsorted(start, np.concatenate([[0], np.cumsum(sizes)]))
    gram = np.zeros(max(0, len(word) - size + 1), U)
    for i in range(size):
        gram = gram * U(0x9E3779B97F4A7C15) + word[i:len(gram) + i]
    gram = mix(gram)
    found = []
    for low, high in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
        if high - low >= size:
            held = np.sort(gram[low:high - size + 1])
            found.append(held[np.concatenate([[True], held[1:] != held[:-1]])])
        elif high > low:
            one = word[low:low + 1]
            for i in range(low + 1, high):
                one = mix(one + word[i:i + 1] * U(0x27D4EB2F165667C5))
            found.append(mix(one ^ U(high - low)))
        else:
            found.append(np.empty(0, U))
    return found


# --- counts of shingles ----------------------------------------------------------------

def _count(size: int):
    def run(batches):
        counts = np.zeros(1 << SKETCH, np.int64)
        for batch in batches:
            texts = byte_column(batch.column(0))
            for low, high in grouped(texts):
                held = concat(shingle_sets(texts[low:high], size), U)
                counts += np.bincount((held >> U(64 - SKETCH)).astype(np.int64),
                                      minlength=1 << SKETCH)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(RANGES)),
             pa.array([dump(_narrow(part)) for part in np.split(counts, RANGES)], pa.binary())],
            ["slots", "blob"])
    return run


def _narrow(counts):
    most = int(counts.max(initial=0))
    return counts.astype(np.uint8 if most < 256 else np.uint16 if most < 65536 else np.int64)


def _sum_counts(batches):
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for slots, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                               strict=True):
            part = load(blob)[0].astype(np.int64)
            total[slots] = total[slots] + part if slots in total else part
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total)), pa.array([dump(p) for p in total.values()], pa.binary())],
            ["slots", "blob"])


def shingle_levels(texts: DataFrame, size: int = WORDS) -> np.ndarray:
    """The order of magnitude of each slot's count over all documents.

    A table of fixed size, not of shingles: slots are shared. Any order of shingles gives
    right results; this one puts shingles of hot passages last.
    """
    rows = (texts.mapInArrow(_count(size), "slots bigint, blob binary").repartition(16, "slots")
            .mapInArrow(_sum_counts, "slots bigint, blob binary").collect())
    counts = np.zeros((RANGES, (1 << SKETCH) // RANGES), np.int64)
    for row in rows:
        counts[row.slots] += load(row.blob)[0]
    return np.floor(4 * np.log2(counts.ravel() + 1.0)).astype(np.uint8)


# --- signatures and the matrix ---------------------------------------------------------

def signature(held: np.ndarray, level: np.ndarray, rule: Rule):
    """Two digests of a set and its prefix."""
    first = int(mix(held).sum(dtype=U)) if len(held) else 0
    second = int(mix(held ^ U(0x5851F42D4C957F2D)).sum(dtype=U)) if len(held) else 0
    n = len(held)
    size = n - rule.least_overlap(n) + min(SHARED, n)
    order = np.argsort(level[(held >> U(64 - SKETCH)).astype(np.int64)], kind="stable")
    return first, second, held[order[:size]]


def _signatures(levels, rule: Rule):
    def run(batches):
        level = levels.value
        for batch in batches:
            texts = byte_column(batch.column(1))
            for low, high in grouped(texts):
                sets = shingle_sets(texts[low:high], rule.words)
                told = [signature(s, level, rule) for s in sets]
                signed = [pa.array(np.array([t[i] for t in told], U).view(np.int64))
                          for i in range(2)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low),
                     pa.array([len(s) for s in sets], pa.int64()), *signed,
                     pa.array([t[2].tobytes() for t in told], pa.binary())],
                    ["id", "n", "first", "second", "prefix"])
    return run


def _dealt(name: str, key: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """Columns as blobs, a row for each value of the key."""
    order = np.argsort(key, kind="stable")
    key, columns = key[order], [c[order] for c in columns]
    at = cut_points(key)
    blobs = [dump(*(c[low:high] for c in columns))
             for low, high in zip(at, np.r_[at[1:], len(key)], strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(key[at], pa.int64()),
                                       pa.array(blobs, pa.binary())], [name, "blob"])


def _bucket(token: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(token) % U(buckets)).astype(np.int64)


def _gathered(batches) -> list[list[np.ndarray]]:
    """The columns of all blobs of a partition, by key."""
    found: dict[int, list] = {}
    for batch in batches:
        for key, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                             strict=True):
            found.setdefault(key, []).append(load(blob))
    return [[np.concatenate(c) for c in zip(*blobs, strict=True)] for blobs in found.values()]


def _postings(buckets: int):
    """Prefix shingles of representatives, dealt by shingle."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for i, n, prefix in zip(*(batch.column(c).to_pylist() for c in range(3)),
                                    strict=True):
                token = np.frombuffer(prefix, U)
                held.append((token, np.full(len(token), i, np.int64),
                             np.full(len(token), n, np.uint32)))
                size += len(token)
                if size > 1 << 20:
                    token, *rest = (np.concatenate(x) for x in zip(*held, strict=True))
                    yield _dealt("bucket", _bucket(token, buckets), token, *rest)
                    held, size = [], 0
        if held:
            token, *rest = (np.concatenate(x) for x in zip(*held, strict=True))
            yield _dealt("bucket", _bucket(token, buckets), token, *rest)
    return run


def _shared(parts: int):
    """Shingles that two prefixes or more have, with how many do, dealt by document."""
    def run(batches):
        for token, doc, n in _gathered(batches):
            order = np.argsort(token, kind="stable")
            token, doc, n = token[order], doc[order], n[order]
            at = cut_points(token)
            count = np.diff(np.r_[at, len(token)])
            count = np.repeat(count, count)
            several = count > 1
            if several.any():
                yield _dealt("part", doc[several] % parts, token[several], doc[several],
                             n[several], count[several])
    return run


def _groups(buckets: int):
    """The group of each document: its most shared prefix shingle. Dealt by shingle.

    A shingle that only one document has says nothing of what the document is similar to;
    the most shared one is that of the largest family it belongs to. Documents that share
    too few prefix shingles with all others together have no links.
    """
    def run(batches):
        for token, doc, n, count in _gathered(batches):
            order = np.lexsort((token, -count, doc))
            token, doc, n = token[order], doc[order], n[order]
            at = cut_points(doc)
            size = np.diff(np.r_[at, len(doc)])
            enough = np.repeat(size >= SHARED, size)
            group = np.repeat(token[at], size).view(np.int64)
            if enough.any():
                yield _dealt("bucket", _bucket(token[enough], buckets), token[enough],
                             doc[enough], n[enough], group[enough])
    return run


def _matrix(parts: int, rule: Rule):
    """How many shingles each document shares with each group's union, bucket by bucket."""
    def run(batches):
        for token, doc, n, group in _gathered(batches):
            order = np.lexsort((group, token))
            yield from _bounds(parts, rule, token[order], doc[order], n[order].astype(np.int64),
                               group[order])
    return run


def _bounds(parts, rule, token, doc, n, grp):
    fresh = np.r_[True, token[1:] != token[:-1]]
    of_token = np.cumsum(fresh) - 1
    row = np.flatnonzero(fresh | np.r_[True, grp[1:] != grp[:-1]])      # of the matrix
    low, high = np.minimum.reduceat(n, row), np.maximum.reduceat(n, row)
    members = np.diff(np.r_[row, len(token)])
    begin = np.searchsorted(of_token[row], of_token, "left")
    width = np.searchsorted(of_token[row], of_token, "right") - begin
    reach = np.cumsum(width)
    at, found, size = 0, [], 0
    while at < len(token):
        end = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + PAIRS)))
        w = width[at:end]
        query = np.repeat(np.arange(at, end), w)
        opened = np.repeat(begin[at:end] - (np.cumsum(w) - w), w) + np.arange(w.sum())
        of = grp[row[opened]]
        own = of == grp[query]
        fits = own | ((of < grp[query]) & (100 * high[opened] >= rule.percent * n[query])
                      & (100 * n[query] >= rule.percent * low[opened]))
        # Its own shingle bounds a document's overlap only with others of its group.
        counts = np.where(own & (members[opened] == 1), 0, 1)
        found.append((doc[query[fits]], of[fits], n[query[fits]], grp[query[fits]],
                      counts[fits]))
        size += int(fits.sum())
        at = end
        if size and (size > PAIRS or at == len(token)):
            tally = _tally(*(np.concatenate(x) for x in zip(*found, strict=True)))
            yield _dealt("part", tally[0] % parts, *tally)
            found, size = [], 0


def _tally(doc, grp, n, own, counts):
    order = np.lexsort((grp, doc))
    doc, grp, n, own, counts = (x[order] for x in (doc, grp, n, own, counts))
    first = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (grp[1:] != grp[:-1])])
    return doc[first], grp[first], n[first], own[first], np.add.reduceat(counts, first)


def _opened(batches):
    """Of each document its own group, and every group whose bound is high enough."""
    for columns in _gathered(batches):
        doc, grp, n, own, shared = _tally(*columns)
        kept = (grp == own) | (shared >= SHARED)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[kept].astype(np.int64)) for x in (doc, n, own, grp, shared)],
            ["id", "n", "own", "grp", "shared"])


# --- opening groups --------------------------------------------------------------------

def _routes(opened: DataFrame) -> DataFrame:
    """The units in which each document's set is needed, and as what.

    A unit is (group, block of members, form, block of queries). Forms: 0, members of a
    block among themselves; 1, two blocks of a group; 2, queries of other groups.
    """
    block = lambda total: F.ceil(total / BLOCK_SHINGLES).cast("bigint")
    unit = lambda m, form, q: F.struct(
        F.col("grp"), F.expr(m).cast("bigint").alias("m"), F.lit(form).alias("form"),
        F.expr(q).cast("bigint").alias("q"))
    within = opened.where(f"grp = own AND shared >= {SHARED}").select("id", "grp", "n")
    across = opened.where("grp <> own").select("id", "grp", "n")
    at = F.pmod(F.xxhash64("id"), F.col("blocks"))

    def tagged(frame, units, member):
        return frame.select("id", F.explode(units).alias("unit"), F.lit(member).alias("member"))

    size = within.groupBy("grp").agg(block(F.sum("n")).alias("blocks"))
    own = within.join(size, "grp").withColumn("at", at)
    groups = across.select("grp").distinct()
    everyone = opened.where("grp = own").join(groups, "grp", "left_semi").select(
        "id", "grp", "n")
    sizes = everyone.groupBy("grp").agg(block(F.sum("n")).alias("blocks")).join(
        across.groupBy("grp").agg(block(F.sum("n")).alias("queries")), "grp")
    holders = everyone.join(sizes, "grp").withColumn("at", at)
    visitors = across.join(sizes, "grp").withColumn(
        "at", F.pmod(F.xxhash64("id"), F.col("queries")))
    return (
        tagged(own, F.array(unit("at", 0, "0")), True)
        .unionByName(tagged(own.where("at + 1 < blocks"), F.transform(
            F.sequence(F.col("at") + 1, F.col("blocks") - 1),
            lambda j: F.struct(F.col("grp"), F.col("at").alias("m"), F.lit(1).alias("form"),
                               j.alias("q"))), True))
        .unionByName(tagged(own.where("at > 0"), F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("at") - 1),
            lambda j: F.struct(F.col("grp"), j.alias("m"), F.lit(1).alias("form"),
                               F.col("at").alias("q"))), False))
        .unionByName(tagged(holders, F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("queries") - 1),
            lambda j: F.struct(F.col("grp"), F.col("at").alias("m"), F.lit(2).alias("form"),
                               j.alias("q"))), True))
        .unionByName(tagged(visitors, F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
            lambda j: F.struct(F.col("grp"), j.alias("m"), F.lit(2).alias("form"),
                               F.col("at").alias("q"))), False)))


def _sets_for_units(size: int):
    def run(batches):
        for batch in batches:
            texts = byte_column(batch.column(1))
            ids, routes = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for low, high in grouped(texts):
                rows = []
                for i, route, held in zip(ids[low:high], routes[low:high],
                                          shingle_sets(texts[low:high], size), strict=True):
                    rows += [(*r["unit"].values(), r["member"], i, held.tobytes()) for r in route]
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                     pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()),
                     pa.array(columns[4], pa.bool_()), pa.array(columns[5], pa.int64()),
                     pa.array(columns[6], pa.binary())],
                    ["grp", "m", "form", "q", "member", "id", "held"])
    return run


class Block:
    """Sets side by side, numbered by the union of their shingles."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.union, self.token = np.unique(np.concatenate(sets), return_inverse=True)
        self.begin = np.cumsum(self.size) - self.size

    def overlaps(self, held: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Shingles that a set shares with each of some sets of the block."""
        at = np.searchsorted(self.union, held)
        at = at[at < len(self.union)]
        there = np.zeros(len(self.union), np.int64)
        there[at[np.isin(self.union[at], held)]] = 1
        size = self.size[rows]
        first = np.cumsum(size) - size
        place = np.repeat(self.begin[rows] - first, size) + np.arange(size.sum())
        return np.add.reduceat(there[self.token[place]], first) if len(rows) else size


def links_within(sets: list[np.ndarray], rule: Rule) -> list[tuple[int, int]]:
    """A spanning forest of the links among some sets, none empty."""
    block, found = Block(sets), []
    waiting = np.ones(len(sets), bool)
    for seed in range(len(sets)):
        front = [seed] if waiting[seed] else []
        waiting[seed] = False
        while front:
            i = front.pop()
            n = block.size[i]
            rows = np.flatnonzero(waiting & rule.fits(n, block.size))
            near = rows[rule.linked(block.overlaps(sets[i], rows), n, block.size[rows])]
            found += [(i, int(j)) for j in near]
            waiting[near] = False
            front += near.tolist()
    return found


def links_between(members: list[np.ndarray], queries: list[np.ndarray], rule: Rule):
    """Links (query, member) that connect what no earlier one has connected."""
    block, found = Block(members), []
    root = np.arange(len(members))
    for i, held in enumerate(queries):
        n = len(held)
        rows = np.flatnonzero(rule.fits(n, block.size))
        near = rows[rule.linked(block.overlaps(held, rows), n, block.size[rows])]
        _, first = np.unique(root[near], return_index=True)
        found += [(i, int(j)) for j in near[first]]
        if len(first) > 1:
            joined = np.isin(root, root[near])
            root[joined] = root[near[0]]
    return found


def _open_unit(rule: Rule):
    def run(table: pa.Table) -> pa.Table:
        form = table.column("form")[0].as_py()
        ids = np.array(table.column("id").to_pylist(), np.int64)
        member = np.array(table.column("member").to_pylist(), bool)
        sets = [np.frombuffer(h, U) for h in table.column("held").to_pylist()]
        inside, outside = np.flatnonzero(member), np.flatnonzero(~member)
        if form == 0:
            pairs = [(inside[i], inside[j])
                     for i, j in links_within([sets[k] for k in inside], rule)]
        elif len(inside) and len(outside):
            pairs = [(outside[i], inside[j]) for i, j in links_between(
                [sets[k] for k in inside], [sets[k] for k in outside], rule)]
        else:
            pairs = []
        a = ids[[p[0] for p in pairs]] if pairs else np.empty(0, np.int64)
        b = ids[[p[1] for p in pairs]] if pairs else np.empty(0, np.int64)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


# --- the operator ----------------------------------------------------------------------

def jaccard_classes(docs: DataFrame, id_column: str = "doc_id",
                    text_column: str = "text", rule: Rule = Rule()) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` of every row.

    Two documents are linked if their sets of shingles (words as runs of other than white
    space, A-Z lower-cased) have the Jaccard similarity of the rule or more. A component's id
    is its smallest document. Null, empty and blank texts have no shingles and no links.
    Rows of the same id are one document with the links of all of them; rows without an id
    have no component.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"),
                        F.col(text_column).cast("binary").alias("text"))
    buckets = folders.parts_for(folders.total_bytes(texts, "text"), BUCKET_BYTES)
    levels = spark.sparkContext.broadcast(shingle_levels(texts.select("text"), rule.words))
    signed = folders.written(texts.mapInArrow(
        _signatures(levels, rule), "id bigint, n bigint, first bigint, second bigint, "
                             "prefix binary"), "signatures")

    known = signed.where("n > 0 AND id IS NOT NULL")
    several = folders.small_enough(folders.written(
        known.groupBy("first", "second").agg(F.min("id").alias("rep"), F.count("*").alias("k"))
        .where("k > 1").drop("k"), "classes"))
    classed = known.join(several, ["first", "second"], "left")
    copies = classed.where("rep <> id").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    reps = classed.where(f"n >= {rule.least_size} AND (rep IS NULL OR rep = id)").select("id", "n", "prefix")
    by_token, by_document = "bucket bigint, blob binary", "part bigint, blob binary"
    opened = folders.written(
        reps.mapInArrow(_postings(buckets), by_token).repartition(buckets, "bucket")
        .mapInArrow(_shared(buckets), by_document).repartition(buckets, "part")
        .mapInArrow(_groups(buckets), by_token).repartition(buckets, "bucket")
        .mapInArrow(_matrix(buckets, rule), by_document).repartition(buckets, "part")
        .mapInArrow(_opened, "id bigint, n bigint, own bigint, grp bigint, shared bigint"),
        "opened")
    routes = folders.small_enough(folders.written(
        _routes(opened).groupBy("id").agg(
            F.collect_list(F.struct("unit", "member")).alias("routes")), "routes"))
    links = (
        texts.join(routes, "id").select("id", "text", "routes")
        .mapInArrow(_sets_for_units(rule.words), "grp bigint, m bigint, form int, q bigint, "
                                     "member boolean, id bigint, held binary")
        .groupBy("grp", "m", "form", "q").applyInArrow(_open_unit(rule), "a bigint, b bigint"))
    told = folders.small_enough(folders.written(
        components(copies.unionByName(links)), "components"))
    return signed.join(told, signed["id"] == told["node"], "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"))


def ngram_jaccard_join(docs: DataFrame) -> DataFrame:
    """Set size and component of every document."""
    return jaccard_classes(docs.select("doc_id", "text"))


def one_of_each(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Of each component the document with the smallest id, in the same columns.

    Rows that repeat an id all stay if it is that id; rows without an id stay.
    """
    gone = jaccard_classes(docs, rule=rule).where("component_id < doc_id").select("doc_id").distinct()
    gone = folders.small_enough(folders.written(gone, "near-copies"))
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`")
                                                           for c in docs.columns])
