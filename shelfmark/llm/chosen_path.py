"""Near copies by a chosen-path set similarity join.

Documents with the same set of shingles are one class, represented by its smallest document.
Of every representative a pool of minwise tokens is kept; two sets agree in one of them with
the probability of their Jaccard similarity. A tree branches its documents by tokens: a node
chooses ``BRANCHES`` places of the pool, and documents that have the same token at such a place
share a child. A pair of similarity ``J`` stays together along some path of one tree with a
probability of at least the fixed point of ``s = 1 - (1 - J * s) ** BRANCHES``, however deep
the tree; as many independent trees are grown as the wanted recall needs.

Only large nodes are branched. A small node is compared exhaustively, by 128-bit sketches (one
bit of every token) whose threshold has the same recall. A large node first compares all its
members with one pivot; members that agree with it are known to be connected from then on, and
a node whose members are all connected is finished. Nodes that are large at the last depth are
compared block against block. What comes out are candidate links, at most one less than members
a node, and they connect documents into families. Links are then confirmed on full
sets, all within a family that are not yet connected, so that a set travels once whatever the
number of trees.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import folders
from shelfmark.llm.buffers import U, byte_column, grouped, mix
from shelfmark.llm.components import components
from shelfmark.llm.jaccard import shingle_sets

POOL = 128                   # minwise tokens of a document, each gives one bit of its sketch
BRANCHES = 3                 # places that a node chooses
LEAF = 8192                  # members up to which a node is compared exhaustively
DEPTH = 6                    # levels of branching
FAMILY_SHINGLES = 2_000_000  # shingles up to which a family is confirmed in one task
BLOCK_SHINGLES = 1_000_000   # shingles of a block of a larger family
FEW = 200_000                # rows of at most 40 bytes that may be broadcast

MULTIPLIERS = np.random.default_rng(20250311).integers(0, 2**63, POOL, dtype=U) * U(2) + U(1)


@dataclass(frozen=True)
class Rule:
    """Sets of ``words``-word shingles are linked from ``percent`` of similarity on.

    ``miss`` bounds the probability that one pair at the threshold is not a candidate.
    """

    words: int = 5
    percent: int = 85
    miss: float = 1e-9

    def __post_init__(self):
        if self.words < 1 or not 50 < self.percent < 100 or not 0 < self.miss < 1:
            raise ValueError("shingles have a word or more, similarities are 51 to 99 percent, "
                             "the probability of a miss is between 0 and 1")

    @property
    def trees(self) -> int:
        """Independent trees that together miss a pair with half of ``miss`` at most."""
        similar, kept = self.percent / 100, 1.0
        for _ in range(200):
            kept = 1 - (1 - similar * kept) ** BRANCHES
        return math.ceil(math.log(self.miss / 2) / math.log(1 - kept))

    @property
    def most_bits(self) -> int:
        """Bits in which sketches of linked sets differ at most, but for the other half."""
        unlike, rest, bits = (1 - self.percent / 100) / 2, self.miss / 2, POOL
        while bits and rest >= (tail := math.comb(POOL, bits) * unlike ** bits
                                * (1 - unlike) ** (POOL - bits)):
            rest -= tail
            bits -= 1
        return bits

    @property
    def least_size(self) -> int:
        """Smaller sets are linked to equal ones only."""
        return -(-self.percent // (100 - self.percent))

    def linked(self, shared, n, m):
        return 100 * shared >= self.percent * (n + m - shared)

    def fits(self, n, m):
        """Whether sets of n and m can be linked; numbers, arrays or columns."""
        return (100 * m >= self.percent * n) & (100 * n >= self.percent * m)


# --- signatures ------------------------------------------------------------------------

def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """The pool of tokens of each set, none empty: a row for each of its places."""
    held = np.concatenate(sets)
    first = np.cumsum([0, *map(len, sets[:-1])])
    return np.stack([mix(np.minimum.reduceat(held * by, first)) for by in MULTIPLIERS])


def _signatures(rule: Rule):
    names = ["id", "n", "first", "second", "low", "high", "tokens"]

    def signed(ids, sets):
        size = np.array([len(s) for s in sets], np.int64)
        told = np.zeros((4, len(sets)), U)
        tokens = np.zeros((len(sets), POOL), np.int32)
        full = np.flatnonzero(size)
        if len(full):
            some = [sets[i] for i in full]
            at = np.cumsum(size[full]) - size[full]
            held = np.concatenate(some)
            told[0, full] = np.add.reduceat(mix(held), at)
            told[1, full] = np.add.reduceat(mix(held ^ U(0x5851F42D4C957F2D)), at)
            pool = minwise(some)
            bits = np.packbits((pool & U(1)).astype(np.uint8), axis=0)
            told[2:, full] = np.ascontiguousarray(bits.T).view(U).T
            tokens[full] = (pool >> U(32)).astype(np.uint32).view(np.int32).T
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(0, tokens.size + 1, POOL, dtype=np.int32)),
            pa.array(tokens.ravel()))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(size), *(pa.array(x.view(np.int64)) for x in told), lists], names)

    def run(batches):
        for batch in batches:
            texts = byte_column(batch.column(1))
            for low, high in grouped(texts):
                yield signed(batch.column(0).slice(low, high - low),
                             shingle_sets(texts[low:high], rule.words))
    return run


# --- trees -----------------------------------------------------------------------------

def _near(a: str, b: str, rule: Rule):
    """Whether two members may be linked, by their sizes and sketches."""
    differ = F.bit_count(F.col(f"{a}.low").bitwiseXOR(F.col(f"{b}.low"))) \
        + F.bit_count(F.col(f"{a}.high").bitwiseXOR(F.col(f"{b}.high")))
    return rule.fits(F.col(f"{a}.n"), F.col(f"{b}.n")) & (differ <= rule.most_bits)


def _agreeing(n, low, high, of, rows, rule: Rule):
    bits = np.bitwise_count(low[rows] ^ low[of]) + np.bitwise_count(high[rows] ^ high[of])
    return rows[rule.fits(n[of], n[rows]) & (bits <= rule.most_bits)]


def forest(n, low, high, label, rule: Rule) -> list[tuple[int, int]]:
    """Candidate links that connect whatever sketches connect, given what labels connect."""
    found, waiting = [], np.ones(len(n), bool)
    of_label: dict[int, list[int]] = {}
    for i, x in enumerate(label.tolist()):
        of_label.setdefault(x, []).append(i)
    for seed in range(len(n)):
        front = of_label[int(label[seed])] if waiting[seed] else []
        waiting[front] = False
        front = list(front)
        while front:
            i = front.pop()
            near = _agreeing(n, low, high, i, np.flatnonzero(waiting), rule)
            for j in near.tolist():
                if waiting[j]:
                    found.append((i, j))
                    others = of_label[int(label[j])]
                    waiting[others] = False
                    front += others
    return found


def _edges(found, ids) -> pa.RecordBatch:
    at = np.array(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(ids[at[:, 0]]), pa.array(ids[at[:, 1]])],
                                      ["a", "b"])


def _leaves(rule: Rule):
    """Candidate links of nodes that come as lists of their members."""
    def run(batches):
        for batch in batches:
            held = batch.column(0)
            bound = held.offsets.to_numpy() - held.offsets[0].as_py()
            columns = held.flatten()
            ids, n, low, high, label = (columns.field(c).to_numpy(zero_copy_only=False)
                                        for c in ("id", "n", "low", "high", "label"))
            low, high = low.view(U), high.view(U)
            found = []
            for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
                found += [(a + i, a + j) for i, j in forest(
                    n[a:b], low[a:b], high[a:b], label[a:b], rule)]
            yield _edges(found, ids)
    return run


def _level(members: DataFrame, rule: Rule, deepest: bool) -> tuple[list[DataFrame], DataFrame]:
    """Candidate links of the small nodes of a level and of pivots; what is left to branch."""
    sizes = folders.written(members.groupBy("node").agg(
        F.count("*").alias("size"), F.min("label").alias("least"), F.max("label").alias("most"),
        F.min("id").alias("a"), F.max("id").alias("b"), F.min("n").alias("n"),
        F.max("n").alias("m"), F.bit_xor("low").alias("low"), F.bit_xor("high").alias("high"))
        .where("least <> most"), "nodes")
    # Of two members, the exclusive or of all sketches has the bits in which they differ.
    differ = F.bit_count("low") + F.bit_count("high")
    pairs = sizes.where("size = 2 AND a <> b").where(
        rule.fits(F.col("n"), F.col("m")) & (differ <= rule.most_bits)).select("a", "b")
    small = sizes.where(f"size BETWEEN 3 AND {LEAF}").select("node")
    leaves = members.join(small, "node").groupBy("node").agg(
        F.collect_list(F.struct("id", "n", "low", "high", "label")).alias("held")) \
        .select("held").mapInArrow(_leaves(rule), "a bigint, b bigint")
    large = sizes.where(f"size > {LEAF}").select("node", "size")
    if large.isEmpty():
        return [pairs, leaves], None
    if deepest:
        return [pairs, leaves, _blocks(members, large, rule)], None
    inside = members.join(large, "node")
    pivots = inside.groupBy("node").agg(F.min(F.struct(
        F.xxhash64("node", "id").alias("order"), "id", "n", "low", "high", "label"))
        .alias("pivot"))
    told = folders.written(
        inside.withColumn("own", F.struct("id", "n", "low", "high")).join(pivots, "node")
        .withColumn("near", _near("own", "pivot", rule))
        .select("node", "id", "n", "low", "high",
                F.when(F.col("near"), F.col("pivot.label")).otherwise(F.col("label"))
                .alias("label"), F.col("pivot.id").alias("pivot"), "near"), "pivots")
    stars = told.where("near AND id <> pivot").select(F.col("id").alias("a"),
                                                      F.col("pivot").alias("b"))
    open_nodes = told.groupBy("node").agg(F.min("label").alias("least"),
                                          F.max("label").alias("most")).where("least <> most")
    left = told.drop("pivot", "near").join(open_nodes.select("node"), "node")
    return [pairs, leaves, stars], left


def _blocks(members: DataFrame, large: DataFrame, rule: Rule) -> DataFrame:
    """Nodes that branching has not divided: every block of members against every other."""
    at = F.pmod(F.xxhash64("id"), F.col("blocks"))
    held = members.join(large.select("node", F.ceil(F.col("size") / LEAF).cast("bigint")
                                     .alias("blocks")), "node").withColumn("at", at)
    others = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1),
                         lambda j: F.struct(F.least(j, F.col("at")).alias("p"),
                                            F.greatest(j, F.col("at")).alias("q")))
    return held.select("node", F.struct("id", "n", "low", "high", "label").alias("one"),
                       F.explode(others).alias("unit")) \
        .groupBy("node", "unit").agg(F.collect_list("one").alias("held")).select("held") \
        .mapInArrow(_leaves(rule), "a bigint, b bigint")


def _children(members: DataFrame, tokens: DataFrame) -> DataFrame:
    """Members of the next level: of each place a node chooses, those with the same token."""
    places = F.array(*(F.pmod(F.xxhash64("node", F.lit(j)), F.lit(POOL)).cast("int")
                       for j in range(BRANCHES)))
    return members.join(tokens, "id").select(
        "id", "n", "low", "high", "label", "node", "tokens",
        F.explode(F.array_distinct(places)).alias("place")).select(
        F.xxhash64("node", "place", F.element_at("tokens", F.col("place") + 1)).alias("node"),
        "id", "n", "low", "high", "label")


def _roots(reps: DataFrame, rule: Rule) -> tuple[DataFrame, DataFrame]:
    """Candidate links of the trees' first nodes of two members; members of the others.

    Nearly all first nodes have one member. They are told by their ids alone, so that
    sketches travel only for members that share a node.
    """
    rows = reps.select("id", F.posexplode(F.slice("tokens", 1, rule.trees * BRANCHES)).alias(
        "place", "token")).select(F.xxhash64(F.lit("root"), "place", "token").alias("node"), "id")
    nodes = folders.written(rows.groupBy("node").agg(
        F.count("*").alias("size"), F.min("id").alias("a"), F.max("id").alias("b"))
        .where("size > 1 AND a <> b"), "roots")
    known = folders.small_enough(folders.written(
        reps.select("id", "n", "low", "high"), "sketches"), FEW)

    def sketch(column: str) -> DataFrame:
        return known.select(F.col("id").alias(column),
                            F.struct("n", "low", "high").alias(f"of_{column}"))

    pairs = nodes.where("size = 2").select("a", "b").distinct().join(sketch("a"), "a").join(
        sketch("b"), "b").where(_near("of_a", "of_b", rule)).select("a", "b")
    members = rows.join(nodes.where("size > 2").select("node"), "node").join(
        known, "id").select("node", "id", "n", "low", "high", F.col("id").alias("label"))
    return pairs, members


def candidates(reps: DataFrame, rule: Rule) -> DataFrame:
    """Links ``a``, ``b`` that connect all sets that may be linked, from their signatures."""
    pairs, members = _roots(reps, rule)
    members = folders.written(members, "members")
    found, depth = [folders.written(pairs, "candidates")], 1
    while members is not None:
        links, left = _level(members, rule, depth > DEPTH)
        found.append(folders.written(reduce(DataFrame.unionByName, links), "candidates"))
        members = None
        if left is not None:
            members = folders.written(_children(left, reps.select("id", "tokens")), "members")
            depth += 1
    return reduce(DataFrame.unionByName, found)


# --- confirming ------------------------------------------------------------------------

class Block:
    """Sets side by side, numbered by the union of their shingles."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.size = np.array([len(s) for s in sets], np.int64)
        self.union, self.number = np.unique(np.concatenate(sets), return_inverse=True)
        self.end = np.cumsum(self.size)
        self.mark = np.zeros(len(self.union), np.int64)

    def linked(self, held: np.ndarray, rows: np.ndarray, rule: Rule) -> np.ndarray:
        """Those of the rows whose set is linked with ``held``."""
        rows = rows[rule.fits(len(held), self.size[rows])]
        if not len(rows):
            return rows
        at = np.searchsorted(self.union, held)
        at = at[at < len(self.union)]
        at = at[np.isin(self.union[at], held, assume_unique=True)]
        self.mark[at] = 1
        size = self.size[rows]
        first = np.cumsum(size) - size
        place = np.repeat(self.end[rows] - size - first, size) + np.arange(size.sum())
        shared = np.add.reduceat(self.mark[self.number[place]], first)
        self.mark[at] = 0
        return rows[rule.linked(shared, len(held), size)]


def confirmed_within(sets: list[np.ndarray], rule: Rule) -> list[tuple[int, int]]:
    """Links that connect what the links among these sets connect."""
    block, found, waiting = Block(sets), [], np.ones(len(sets), bool)
    for seed in range(len(sets)):
        front = [seed] if waiting[seed] else []
        waiting[seed] = False
        while front:
            i = front.pop()
            near = block.linked(sets[i], np.flatnonzero(waiting), rule)
            waiting[near] = False
            found += [(i, j) for j in near.tolist()]
            front += near.tolist()
    return found


def confirmed_between(queries, members, rule: Rule) -> list[tuple[int, int]]:
    """Links of queries with members that connect what no earlier one has connected."""
    block, root, found = Block(members), np.arange(len(members)), []
    for i, held in enumerate(queries):
        near = block.linked(held, np.arange(len(members)), rule)
        if len(near):
            roots, first = np.unique(root[near], return_index=True)
            found += [(i, int(j)) for j in near[first]]
            root[np.isin(root, roots)] = roots[0]
    return found


def _routed_sets(size: int):
    """Sets of documents, one row for each unit in which they are needed."""
    def run(batches):
        for batch in batches:
            texts = byte_column(batch.column(1))
            for low, high in grouped(texts):
                sets = shingle_sets(texts[low:high], size)
                routes = batch.column(2).slice(low, high - low)
                bound = routes.offsets.to_numpy()
                of = np.repeat(np.arange(high - low), np.diff(bound))
                flat = routes.flatten()
                yield pa.RecordBatch.from_arrays(
                    [flat.field("unit"), flat.field("query"),
                     batch.column(0).slice(low, high - low).take(pa.array(of)),
                     pa.array([sets[i].tobytes() for i in of.tolist()], pa.binary())],
                    ["unit", "query", "id", "held"])
    return run


def stars(found: list[tuple[int, int]], ids: np.ndarray) -> list[tuple[int, int]]:
    """Of the links of some rows, each linked row with the smallest id it is connected to."""
    root = {}

    def of(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in found:
        low, high = sorted((of(i), of(j)), key=lambda x: ids[x])
        root[high] = low
    return [(x, of(x)) for x in root if of(x) != x]


def _confirm(rule: Rule):
    """Links of a unit: with queries, those found; else from each row to its smallest."""
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        query = table.column("query").to_numpy()
        sets = [np.frombuffer(x, U) for x in table.column("held").to_pylist()]
        asked, others = np.flatnonzero(query == 1), np.flatnonzero(query == 0)
        pick = lambda rows: [sets[i] for i in rows]
        if not len(asked):
            found = stars([(others[i], others[j])
                           for i, j in confirmed_within(pick(others), rule)], ids)
        else:
            found = [(asked[i], others[j]) for i, j in confirmed_between(
                pick(asked), pick(others), rule)] if len(others) else []
        return pa.Table.from_batches([_edges(found, ids)])
    return run


def _confirmed(texts: DataFrame, routes: DataFrame, rule: Rule) -> DataFrame:
    """Links of all units; ``routes`` has a document's units with its part in each."""
    routes = folders.small_enough(folders.written(routes.groupBy("id").agg(F.collect_list(
        F.struct("unit", "query")).alias("routes")), "routes"), FEW)
    return (texts.join(routes, "id").select("id", "text", "routes")
            .mapInArrow(_routed_sets(rule.words),
                        "unit bigint, query int, id bigint, held binary")
            .groupBy("unit").applyInArrow(_confirm(rule), "a bigint, b bigint"))


def linked(texts: DataFrame, reps: DataFrame, rule: Rule) -> DataFrame:
    """``id, component`` of every representative that is linked to a smaller one.

    A family of few shingles is one unit, whose task tells the components as well. In a
    larger one, all members are compared with its centre; those that are not linked to it are
    then compared with all, block by block.
    """
    edges = folders.written(candidates(reps, rule).distinct(), "candidate-links")
    family = folders.written(components(edges).join(reps.select("id", "n"), F.col("node")
                             == F.col("id")).select("id", "n", "component"), "families")
    sizes = folders.written(family.groupBy("component").agg(F.sum("n").alias("total")),
                            "family-sizes")
    whole = family.join(sizes.where(f"total <= {FAMILY_SHINGLES}"), "component").select(
        "id", F.xxhash64("component").alias("unit"), F.lit(0).alias("query"))
    found = _confirmed(texts, whole, rule).select(F.col("a").alias("id"),
                                                  F.col("b").alias("component"))
    large = sizes.where(f"total > {FAMILY_SHINGLES}")
    if not large.isEmpty():
        more = components(reduce(DataFrame.unionByName, _large_families(
            texts, family.join(large, "component"), edges, rule)))
        found = found.unionByName(more.where("node <> component").select(
            F.col("node").alias("id"), "component"))
    return folders.written(found, "linked")


def _large_families(texts, family, edges, rule: Rule) -> list[DataFrame]:
    family = folders.written(family, "large-families")
    ends = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id")))
    centre = family.join(ends.groupBy("id").agg(F.count("*").alias("k")), "id").groupBy(
        "component").agg(F.max_by("id", F.struct("k", -F.col("id"))).alias("centre"))
    blocks = F.ceil(F.col("total") / BLOCK_SHINGLES).cast("bigint")
    held = family.join(centre, "component").withColumn("blocks", blocks).withColumn(
        "at", F.pmod(F.xxhash64("id"), F.col("blocks")))
    every = lambda n: F.sequence(F.lit(0).cast("bigint"), n - 1)

    def routes(members, asked, rows):
        """Blocks of members, and those who ask in each; ``rows`` numbers the units."""
        one = members.select("id", F.explode(every(F.col(rows))).alias("r"), "component", "at") \
            .select("id", F.xxhash64("component", "at", "r").alias("unit"),
                    F.lit(0).alias("query"))
        two = asked.select("id", "r", "component", F.explode(every(F.col("blocks"))).alias("at")) \
            .select("id", F.xxhash64("component", "at", "r").alias("unit"),
                    F.lit(1).alias("query"))
        return one.unionByName(two)

    star = folders.written(_confirmed(texts, routes(
        held.withColumn("rows", F.lit(1)),
        held.where("id = centre").withColumn("r", F.lit(0).cast("bigint")), "rows"), rule)
        .distinct(), "stars")
    done = star.select(F.col("b").alias("id")).unionByName(star.select(F.col("a").alias("id")))
    rest = folders.written(held.join(done.distinct(), "id", "left_anti"), "rest")
    counts = rest.groupBy("component").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("bigint")
                                           .alias("rows"))
    asked = rest.join(counts, "component").withColumn(
        "r", F.pmod(F.xxhash64("id", F.lit("r")), F.col("rows")))
    return [star, folders.written(_confirmed(texts, routes(
        held.join(counts, "component"), asked, "rows"), rule).where("a <> b"), "links")]


# --- the operator ----------------------------------------------------------------------

def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                rule: Rule = Rule()) -> DataFrame:
    """``n_shingles``, ``component_id`` and ``kept`` of every row.

    Words are runs of other than white space with A-Z lower-cased; a text of fewer words than
    a shingle has one of all of them. Null, empty and blank texts have no shingles and no
    links. Rows of the same id are one document with the links of all of them. Rows without
    an id have no links, no component and stay. Other columns are not read.
    """
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"),
                        F.col(text_column).cast("binary").alias("text"))
    signed = folders.written(texts.mapInArrow(
        _signatures(rule), "id bigint, n bigint, first bigint, second bigint, low bigint, "
                           "high bigint, tokens array<int>"), "signatures")
    known = signed.where("n > 0 AND id IS NOT NULL")
    several = folders.small_enough(folders.written(
        known.groupBy("first", "second").agg(F.min("id").alias("rep"), F.max("id").alias("k"))
        .where("k > rep").drop("k"), "classes"), FEW)
    classed = known.join(several, ["first", "second"], "left")
    reps = classed.where(f"n >= {rule.least_size} AND (rep IS NULL OR rep = id)").select(
        "id", "n", "low", "high", "tokens").dropDuplicates(["id", "n", "low", "high"])
    told = linked(texts, reps, rule)
    if known.groupBy("id").count().where("count > 1").isEmpty():
        found = classed.select("id", F.coalesce("rep", "id").alias("rep")).join(
            folders.small_enough(told.withColumnRenamed("id", "rep"), FEW), "rep", "left").select(
            F.col("id").alias("node"), F.coalesce("component", "rep").alias("component")).where(
            "node <> component")
    else:               # an id may connect sets that no link connects
        found = components(told.select(F.col("id").alias("a"), F.col("component").alias("b"))
                           .unionByName(classed.where("rep <> id").select(
                               F.col("id").alias("a"), F.col("rep").alias("b"))))
    of = folders.small_enough(folders.written(found, "components"), FEW)
    return signed.join(of, signed["id"] == of["node"], "left").select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(True)))


def chosen_path(docs: DataFrame) -> DataFrame:
    return near_copies(docs.select("doc_id", "text"))
