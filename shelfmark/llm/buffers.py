"""Text columns of Arrow batches as byte arrays, and hashes of what they hold.

Hashes are polynomials over 64-bit random letters modulo 2**64, finished by a bijective
mixer. They are the same on every machine.
"""

from __future__ import annotations

import ctypes
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard

U = np.uint64
BASE = 0x9E3779B97F4A7C15
LETTERS = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all input bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power(n: int) -> np.uint64:
    return U(pow(BASE, n, 2**64))


def substring_hashes(data: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """For each length, the hash of the substring at every position, by doubling."""
    doubled, n = {1: LETTERS[data]}, 1
    while 2 * n <= max(lengths):
        doubled[2 * n] = doubled[n][:-n] * _power(n) + doubled[n][n:]
        n *= 2
    found = []
    for length in lengths:
        done, value = 0, None
        for part in sorted(doubled, reverse=True):
            if length & part:
                at = doubled[part]
                size = len(data) - (done + part) + 1
                value = at if value is None else (
                    value[:size] * _power(part) + at[done:done + size])
                done += part
        found.append(value)
    return found


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    n, least = 1, values
    while 2 * n <= width:
        least = np.minimum(least[:-n], least[n:])
        n *= 2
    if n < width:
        least = np.minimum(least[:len(values) - width + 1], least[width - n:])
    return least


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE**i`` and its inverse for i < n, modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = (n >> 16) + 1 << 16
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 2**64))):
            factors = np.full(size, base, dtype=U)
            factors[0] = 1
            _POWERS[name] = np.cumprod(factors, dtype=U)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The hash of each ``data[start:end]``, of any length, from prefix sums."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=U)
    np.cumsum(LETTERS[data] * down[:-1], out=sums[1:])
    # The length takes part, so that letters whose contributions cancel cannot hide.
    spans = (sums[ends] - sums[starts]) * up[starts]
    return mix(spans + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def _give_back() -> None:
    """Memory that the last batch has left goes back to the machine; workers live long."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # another C library
        pass


def byte_column(column: pa.Array) -> list[bytes]:
    """Values of a text or binary column as bytes; null is empty."""
    _give_back()
    kind = column.type
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        column = column.cast(pa.large_binary() if pa.types.is_large_string(kind)
                             else pa.binary())
    return [value or b"" for value in column.to_pylist()]


def grouped(texts: list[bytes], size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together; a longer text stands alone."""
    first, held = 0, 0
    for i, text in enumerate(texts):
        if i > first and held + len(text) > size:
            yield first, i
            first, held = i, 0
        held += len(text)
    if first < len(texts):
        yield first, len(texts)


def dump(*arrays: np.ndarray) -> bytes:
    return pickle.dumps(arrays, protocol=5)


def load(blob: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(blob)


def planes(numbers: np.ndarray) -> tuple:
    """Numbers by the places of their bytes; a plane that gets smaller is compressed."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    held = []
    for plane in numbers.view(np.uint8).reshape(len(numbers), numbers.itemsize).T:
        plain = plane.tobytes()
        small = squeeze(plain)
        held.append((True, small) if len(small) < len(plain) else (False, plain))
    return numbers.dtype.str, len(numbers), held


def numbers_of(kind: str, n: int, held: list) -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    rows = [np.frombuffer(expand(x) if small else x, np.uint8) for small, x in held]
    return np.stack(rows, axis=1).reshape(-1).view(kind) if n else np.empty(0, kind)


def slim(ids: np.ndarray) -> tuple[int, np.ndarray]:
    """Ids as a base and small offsets."""
    if not len(ids):
        return 0, ids
    base = int(ids.min())
    wide = int(ids.max()) - base
    return base, (ids - base).astype(np.uint16 if wide < 2**16 else np.uint32 if wide < 2**32
                                     else np.int64)


def full(base: int, offsets: np.ndarray) -> np.ndarray:
    return offsets.astype(np.int64) + base


def concat(arrays: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, kind)


def cut_points(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values of a sorted array begins."""
    if not len(values):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
