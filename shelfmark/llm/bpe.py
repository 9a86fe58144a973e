"""Byte-level BPE: vectorised pre-tokenisation, cached merging, and decoding.

Text is split by a finite automaton over classes of code points instead of a pattern engine.
Each code point is a function from states to states; functions compose associatively, so
that blocks of text are scanned side by side: first the function of every block, then the
state in which each block begins, then the states inside. The pieces are merged once each,
all new pieces of a stretch of text together, and kept in a cache.
"""

from __future__ import annotations

import base64
import heapq
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.buffers import U, byte_column, cut_points, grouped, span_hashes

TOGETHER = 1 << 20      # bytes of text encoded at a time
BLOCK = 64              # code points of a block of the scan
CACHE = 300_000       # pieces kept by a worker; then the cache starts anew
LONG = 48               # bytes from which a piece is merged with a heap of its own
NEVER = np.int32(2**31 - 1)

# --- splitting -------------------------------------------------------------------------

# Symbols: what a code point is, with as much of what follows as the pattern looks at.
END, LETTER, NUMBER, OTHER, PREFIX, LONE, BLANK, TAIL1, TAIL2 = range(9)
# States: what the last code point belongs to. After LEFT1 and LEFT2 a contraction lacks one
# or two letters; FRESH means that a piece has just ended.
(FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_PREFIX, IN_BLANKS, LEFT1, LEFT2) = range(8)
# White space, by code point (fixed values of the standard).
SPACE_POINTS = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028,
                0x2029, 0x202F, 0x205F, 0x3000)


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """For each symbol and state the next state, and whether a piece begins there."""
    nxt, begins = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)

    def rule(symbol, state, joined, otherwise=None):
        nxt[symbol] = state if otherwise is None else otherwise
        for s in joined:
            nxt[symbol, s], begins[symbol, s] = state, False

    rule(END, FRESH, ())
    rule(LETTER, IN_LETTERS, (IN_LETTERS, AFTER_PREFIX))
    for left, then in ((LEFT1, FRESH), (LEFT2, LEFT1)):
        nxt[LETTER, left], begins[LETTER, left] = then, False
    rule(NUMBER, IN_NUMBERS, (IN_NUMBERS, AFTER_PREFIX))
    rule(OTHER, IN_OTHERS, (IN_OTHERS, AFTER_PREFIX))
    rule(TAIL1, IN_OTHERS, (IN_OTHERS, AFTER_PREFIX), LEFT1)
    rule(TAIL2, IN_OTHERS, (IN_OTHERS, AFTER_PREFIX), LEFT2)
    rule(PREFIX, AFTER_PREFIX, ())
    rule(LONE, FRESH, ())
    rule(BLANK, IN_BLANKS, (IN_BLANKS,))
    return nxt, begins


NEXT, BEGINS = _automaton()
_made: dict[str, np.ndarray] = {}


def _classes() -> np.ndarray:
    """LETTER, NUMBER, BLANK or OTHER of every code point."""
    if "classes" not in _made:
        import regex
        table = np.full(0x110000, OTHER, np.uint8)
        points = "".join(chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000)
        for pattern, symbol in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER)):
            for run in regex.finditer(pattern, points):
                table[[ord(c) for c in run.group()]] = symbol
        table[list(SPACE_POINTS)] = BLANK
        _made["classes"] = table
    return _made["classes"]


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The symbol of each code point; ``ends`` are the separators between texts."""
    symbol = _classes()[points]
    symbol[ends] = END
    following = np.concatenate([symbol[1:], [END]])
    last_blank = (symbol == BLANK) & (following != BLANK) & (following != END)
    quote = np.flatnonzero((points == 0x27) & (following == LETTER))
    if len(quote):
        padded = np.concatenate([points, [0, 0]])
        one, two = padded[quote + 1], padded[quote + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | (
            (one == ord("l")) & (two == ord("l")))
        symbol[quote[single]] = TAIL1
        symbol[quote[double]] = TAIL2
    symbol[last_blank] = np.where(points[last_blank] == 0x20, PREFIX, LONE)
    return symbol


def piece_begins(symbol: np.ndarray) -> np.ndarray:
    """Where a piece begins, from an associative scan over transition functions."""
    n = len(symbol)
    blocks = -(-n // BLOCK)
    grid = np.zeros(blocks * BLOCK, np.uint8)
    grid[:n] = symbol
    columns = np.ascontiguousarray(grid.reshape(blocks, BLOCK).T)
    table, marks = NEXT.ravel(), BEGINS.ravel()
    whole = np.broadcast_to(np.arange(8, dtype=np.uint8), (blocks, 8)).copy()
    for column in columns:
        whole = table[(column[:, None] << 3) | whole]
    step = 1
    while step < blocks:                      # prefix compositions in log2(blocks) rounds
        whole[step:] = np.take_along_axis(whole[step:], whole[:-step], axis=1)
        step *= 2
    state = np.concatenate([[np.uint8(FRESH)], whole[:-1, FRESH]])
    begins = np.empty((BLOCK, blocks), bool)
    for j, column in enumerate(columns):
        at = (column << 3) | state
        begins[j], state = marks[at], table[at]
    return begins.T.ravel()[:n]


def code_points(joined: bytes, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points of some bytes, and where each begins.

    A byte that is not part of valid UTF-8 is a symbol of its own, neither letter nor number.
    """
    try:
        points = np.frombuffer(joined.decode("utf-8").encode("utf-32-le"), np.uint32)
        return points, np.flatnonzero((data & 0xC0) != 0x80)
    except UnicodeDecodeError:
        text = joined.decode("utf-8", "surrogateescape")
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        size = np.digitize(points, [0x80, 0x800, 0x10000]) + 1
        size[(points >= 0xDC80) & (points < 0xDD00)] = 1
        return points, np.cumsum(size) - size


def split(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts; start, end and text of each piece."""
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    points, lead = code_points(joined, data)
    ends = np.searchsorted(lead, np.cumsum(sizes) - 1)
    begins = piece_begins(symbols(points, ends))
    owner = np.repeat(np.arange(len(texts)), sizes)
    start = lead[begins]
    stop = np.concatenate([start[1:], [len(data)]])
    real = np.ones(len(lead), bool)
    real[ends] = False
    real = real[begins]
    return data, start[real], stop[real], owner[start[real]]


# --- merging ---------------------------------------------------------------------------

def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, each at its rank."""
    rows = [line.split() for line in Path(path).read_bytes().splitlines() if line]
    tokens: list[bytes] = [b""] * len(rows)
    for token, rank in rows:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class Vocabulary:
    """Tokens by rank, and the rank of every pair of tokens that together are a token."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        rank = {token: i for i, token in enumerate(tokens)}
        self.byte = np.array([rank[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, i in rank.items():
            for cut in range(1, len(token)):
                left, right = rank.get(token[:cut]), rank.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()], np.int32)
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.letters = np.frombuffer(b"".join(tokens), np.uint8)
        self.forget()

    def forget(self):
        """An empty cache: piece hashes in order, and where the ids of each lie."""
        self.known = np.empty(0, U)
        self.place = np.empty(0, np.int64)
        self.first, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def _rank(self, left: int, right: int) -> int | None:
        key = left << 32 | right
        at = int(np.searchsorted(self.keys, key))
        return int(self.ranks[at]) if at < len(self.keys) and self.keys[at] == key else None

    def merge_long(self, piece: bytes) -> list[int]:
        """Ids of one piece: the least pair first, the leftmost of equals, by a heap."""
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
        heap = []

        def offer(i):
            if i >= 0 and after[i] < len(ids):
                rank = self._rank(ids[i], ids[after[i]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[after[i]]))

        for i in range(len(ids)):
            offer(i)
        gone = [False] * len(ids)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i] if not gone[i] else len(ids)
            if gone[i] or j >= len(ids) or ids[i] != left or ids[j] != right:
                continue
            ids[i], gone[j], after[i] = rank, True, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(i)
            offer(before[i])
        return [t for t, g in zip(ids, gone, strict=True) if not g]

    def merge(self, data, start, end) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short pieces in a row, and their counts; one merge a round each."""
        size = end - start
        owner = np.repeat(np.arange(len(size)), size)
        place = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        token = self.byte[data[place]]
        done_owner, done_token = [], []
        rank = self._adjacent(token, owner)
        while len(token):
            at = cut_points(owner)
            least = np.minimum.reduceat(rank, at)
            spread = np.repeat(least, np.diff(np.r_[at, len(owner)]))
            over = spread == NEVER
            done_owner.append(owner[over])
            done_token.append(token[over])
            if over.any():
                token, owner, rank, spread = (x[~over] for x in (token, owner, rank, spread))
                if not len(token):
                    break
            hit = np.flatnonzero(rank == spread)
            hit = hit[cut_points(owner[hit])]
            token[hit] = rank[hit]
            keep = np.ones(len(token), bool)
            keep[hit + 1] = False
            moved = hit - np.arange(len(hit))
            token, owner, rank = token[keep], owner[keep], rank[keep]
            for left in (moved, moved[moved > 0] - 1):
                inside = left[left + 1 < len(token)]
                inside = inside[owner[inside] == owner[inside + 1]]
                rank[left] = np.where(owner[left] == owner[np.minimum(left + 1,
                                                                      len(owner) - 1)],
                                      rank[left], NEVER)
                rank[inside] = self.pair_ranks(token[inside], token[inside + 1])
            rank[-1] = NEVER
        owner, token = np.concatenate(done_owner), np.concatenate(done_token)
        order = np.argsort(owner, kind="stable")
        return token[order], np.bincount(owner, minlength=len(size))

    def _adjacent(self, token, owner):
        rank = np.full(len(token), NEVER, np.int32)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside] = self.pair_ranks(token[inside], token[inside + 1])
        return rank

    def learn_pieces(self, data, key, start, end) -> None:
        """Put pieces that the cache lacks into it."""
        if len(self.known) > CACHE:
            self.forget()
        lacking = ~np.isin(key, self.known) if len(self.known) else np.ones(len(key), bool)
        key, start, end = key[lacking], start[lacking], end[lacking]
        if not len(key):
            return
        short = end - start < LONG
        ids, counts = self.merge(data, start[short], end[short]) if short.any() else (
            np.empty(0, np.int32), np.empty(0, np.int64))
        long_ids = [self.merge_long(data[a:b].tobytes())
                    for a, b in zip(start[~short].tolist(), end[~short].tolist(), strict=True)]
        counts = np.concatenate([counts, np.array([len(x) for x in long_ids], np.int64)])
        first = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate([self.ids, ids, *(np.array(x, np.int32) for x in long_ids)])
        place = len(self.first) + np.arange(len(counts))
        self.first = np.concatenate([self.first, first])
        self.count = np.concatenate([self.count, counts])
        known = np.concatenate([self.known, key[short], key[~short]])
        order = np.argsort(known, kind="stable")
        self.known, self.place = known[order], np.concatenate([self.place, place])[order]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each text has."""
        data, start, end, owner = split(texts)
        if not len(start):
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        key, where, back = np.unique(span_hashes(data, start, end), return_index=True,
                                     return_inverse=True)
        self.learn_pieces(data, key, start[where], end[where])
        place = self.place[np.searchsorted(self.known, key)][back]
        count = self.count[place]
        at = np.repeat(self.first[place] - (np.cumsum(count) - count), count)
        return (self.ids[at + np.arange(len(at))],
                np.bincount(owner, count, minlength=len(texts)).astype(np.int64))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens in a row, whether or not they end inside a character."""
        size = self.sizes[ids]
        at = np.repeat(self.begins[ids] - (np.cumsum(size) - size), size)
        return self.letters[at + np.arange(len(at))].tobytes()


# --- over frames -----------------------------------------------------------------------

_vocabularies: dict[str, Vocabulary] = {}


def _vocabulary(path: str, tokens) -> Vocabulary:
    """A worker's vocabulary, built once from the broadcast tokens."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(tokens.value)
    return _vocabularies[path]


def _broadcast_tokens(frame: DataFrame, path: str):
    """The tokens of the rank file, whose number does not depend on the data."""
    return frame.sparkSession.sparkContext.broadcast(read_ranks(path))


def encode(docs: DataFrame, path: str, text_column: str = "text",
           decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids``, the tokens of each whole text; null and empty give none.

    ``offsets`` has the byte at which each token begins, so that a stretch of tokens can be
    traced to its bytes. Special tokens are ordinary text. With ``decoded`` the ids are
    decoded again in the same task, which saves a second set of Python workers.
    """
    tokens = _broadcast_tokens(docs, path)
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    whole = frame.schema["whole"].dataType.simpleString()

    def run(batches):
        vocabulary = _vocabulary(path, tokens)
        for batch in batches:
            texts = byte_column(batch.column(0).field(text_column))
            for low, high in grouped(texts, TOGETHER):
                ids, counts = vocabulary.encode(texts[low:high])
                size = vocabulary.sizes[ids]
                begin = np.cumsum(size) - size
                total = np.concatenate([[0], np.cumsum(counts)])
                begun = np.array([len(t) for t in texts[low:high]])
                begin -= np.repeat(np.cumsum(begun) - begun, counts)
                again = [vocabulary.decode(ids[a:b])
                         for a, b in zip(total.tolist(), total[1:].tolist(), strict=False)
                         ] if decoded else [None] * (high - low)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), _lists(total, ids),
                     _lists(total, begin.astype(np.int32)), pa.array(again, pa.binary())],
                    ["whole", "ids", "offsets", "decoded"])

    told = frame.mapInArrow(
        run, f"whole {whole}, ids array<int>, offsets array<int>, decoded binary")
    return told.select("whole.*", "ids", "offsets", *["decoded"] * decoded)


def _lists(total: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(total, pa.int32()), pa.array(values, pa.int32()))


def decode(tokens: DataFrame, path: str, ids_column: str = "ids") -> DataFrame:
    """``tokens`` with ``decoded``, the bytes of its ids; null ids count as none."""
    shared = _broadcast_tokens(tokens, path)
    frame = tokens.select(
        F.coalesce(F.col(ids_column), F.array().cast("array<int>")).alias("ids"),
        F.struct(*[F.col(f"`{c}`") for c in tokens.columns]).alias("whole"))
    whole = frame.schema["whole"].dataType.simpleString()

    def run(batches):
        vocabulary = _vocabulary(path, shared)
        for batch in batches:
            lists = batch.column(0)
            values = lists.values.to_numpy(zero_copy_only=False)
            at = lists.offsets.to_pylist()
            found = [vocabulary.decode(values[a:b])
                     for a, b in zip(at, at[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(found, pa.binary())], ["whole", "decoded"])

    told = frame.mapInArrow(run, f"whole {whole}, decoded binary")
    return told.select("whole.*", "decoded")


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_level_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Counts and digests of ids and of the bytes they decode to."""
    path = path or vocabulary_path()
    return encode(docs.select("doc_id", "text"), path, decoded=True).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, ``ids``, ``n_tokens`` and whether decoding the ids
    gives the text back."""
    path = path or vocabulary_path()
    ids = encode(docs.select("doc_id", "source", "lang", "text"), path, decoded=True)
    return ids.select(
        "doc_id", "source", "lang", F.size("ids").cast("bigint").alias("n_tokens"),
        (F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("same"),
        "ids")
