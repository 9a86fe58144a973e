"""Quality rules: base counts of a text and bands of zstandard ratios.

A text is rejected if it shrinks too well (it repeats itself) or too little (it is noise),
whole or in most of its fixed chunks. What is too well or too little depends on the length,
since short input has no past to refer to.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.buffers import U, byte_column, grouped, mix, span_hashes

CHUNK = 4096
LEVEL = 3
SEEN = 5                # words of a window
# Length in bytes from which a band holds, least and greatest ratio. Fixed values, chosen
# so that ordinary prose lies well inside its band; see README.
BANDS = ((0, 0.20, 9.00), (256, 0.25, 0.95), (1024, 0.20, 0.85), (4096, 0.18, 0.78),
         (32768, 0.15, 0.70))
BAD_SHARE = 0.5         # share of bytes in chunks out of band from which a text is rejected

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BLANK = b" \t\n\x0b\x0c\r"


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array."""
    space = np.concatenate([[True], SPACES[data], [True]])
    return (np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:]))


def repeated_words(data, start, end, owner) -> np.ndarray:
    """Which words lie in a window of words that its own text has twice or more."""
    covered = np.zeros(len(start) + 1, np.int64)
    if len(start) < SEEN:
        return covered[:-1] > 0
    word = span_hashes(data, start, end)
    window = np.zeros(len(start) - SEEN + 1, U)
    for i in range(SEEN):
        window = window * U(0x9E3779B97F4A7C15) + word[i:len(word) - SEEN + 1 + i]
    inside = owner[:-SEEN + 1] == owner[SEEN - 1:]
    window = mix(window + owner[:-SEEN + 1].astype(U) * U(0xD6E8FEB86659FD93))
    at = np.flatnonzero(inside)
    _, back, count = np.unique(window[at], return_inverse=True, return_counts=True)
    at = at[count[back] > 1]
    covered[at] += 1
    np.subtract.at(covered, np.minimum(at + SEEN, len(start)), 1)
    return np.cumsum(covered)[:-1] > 0


def duplicate_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(BLANK)]
    return len(lines) - len(set(lines))


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The base counts of texts of about a megabyte together."""
    sizes = np.array([len(t) + 1 for t in texts])
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    owner = np.repeat(np.arange(len(texts)), sizes)
    start, end = words(data)
    n = len(texts)
    of_word = owner[start]
    lead = ((data & 0xC0) != 0x80) & ~SPACES[data]
    again = repeated_words(data, start, end, of_word)
    return {
        "n_words": np.bincount(of_word, minlength=n),
        "word_chars": np.bincount(owner[lead], minlength=n),
        "n_symbols": np.bincount(owner[SYMBOLS[data]], minlength=n),
        "n_dup_lines": np.array([duplicate_lines(t) for t in texts], np.int64),
        "n_repeat_words": np.bincount(of_word[again], minlength=n)}


def ratios(text: bytes, press: zstandard.ZstdCompressor) -> tuple[float, float]:
    """The ratio of the whole text, and the share of its bytes in chunks out of band."""
    if not text:
        return 1.0, 0.0
    bad = 0
    for at in range(0, len(text), CHUNK):
        chunk = text[at:at + CHUNK]
        if not in_band(len(chunk), len(press.compress(chunk)) / len(chunk)):
            bad += len(chunk)
    return len(press.compress(text)) / len(text), bad / len(text)


def in_band(size: int, ratio: float) -> bool:
    _, low, high = max(band for band in BANDS if band[0] <= size)
    return low <= ratio <= high


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measure(batches):
    press = zstandard.ZstdCompressor(level=LEVEL)
    for batch in batches:
        texts = byte_column(batch.column(0))
        for low, high in grouped(texts):
            held = texts[low:high]
            counts = base_counts(held)
            ratio, bad = zip(*(ratios(t, press) for t in held), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).slice(low, high - low),
                 pa.array([len(t) for t in held], pa.int64()),
                 *(pa.array(counts[c].astype(np.int64)) for c in COUNTS),
                 pa.array(ratio, pa.float64()), pa.array(bad, pa.float64())],
                ["rest", "n_bytes", *COUNTS, "ratio", "bad_share"])


def band_verdict() -> Column:
    """Whether ratio and chunks of a measured text are in the band of its length."""
    low, high = F.lit(BANDS[0][1]), F.lit(BANDS[0][2])
    for size, least, most in BANDS[1:]:
        low = F.when(F.col("n_bytes") >= size, F.lit(least)).otherwise(low)
        high = F.when(F.col("n_bytes") >= size, F.lit(most)).otherwise(high)
    return F.col("ratio").between(low, high) & (F.col("bad_share") < BAD_SHARE)


def base_failure() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def measured(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """All columns but the text, as ``rest``, with counts, ratios and verdicts.

    A null text counts as empty: no words, so that the base rules fail it.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_column]
    frame = docs.select(F.col(text_column).cast("binary").alias("text"),
                        F.struct(*others).alias("rest"))
    rest = frame.schema["rest"].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in COUNTS)
    return (frame.mapInArrow(_measure, f"rest {rest}, n_bytes bigint, {counts}, ratio double, "
                                       "bad_share double")
            .withColumn("base_failed", base_failure())
            .withColumn("kept", ~F.col("base_failed") & band_verdict()))


def compression_bands(docs: DataFrame) -> DataFrame:
    """The counts and the verdict of every document."""
    return measured(docs.select("doc_id", "text")).select(
        "rest.doc_id", *COUNTS, "base_failed", "kept", "ratio", "bad_share")
