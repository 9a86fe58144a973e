"""Language identification by hyperdimensional profiles.

Every letter has a random vector of ones and minus ones. An n-gram is the product of the
vectors of its letters, each rotated by its place; a text is the sum of its n-grams; a
language is the sum of its texts at unit length. A text gets the language of the nearest
prototype by cosine.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.buffers import byte_column

WIDTH = 512             # components of a vector
SYMBOLS = 64            # 0: anything but a letter; 1-26: a-z; the rest shared by other letters
UNKNOWN = "und"
TELLING = 64            # trigrams from which a low cosine tells anything
UNIT = 1 << 20          # prototypes are summed in whole numbers, in any order alike

_tables: dict[str, np.ndarray] = {}


def _symbol_table() -> np.ndarray:
    """The symbol of every code point; upper and lower case share one."""
    if "symbols" not in _tables:
        table = np.zeros(0x110000, np.uint8)
        for point in range(0x110000):
            letter = chr(point)
            if letter.isalpha():
                low = ord(letter.lower()[0])
                table[point] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
        _tables["symbols"] = table
    return _tables["symbols"]


class Profiles:
    """Vectors of trigrams, made when a trigram is first seen."""

    def __init__(self):
        letters = np.random.default_rng(11).choice(np.array([-1, 1], np.int8),
                                                   (SYMBOLS, WIDTH))
        self.first = np.roll(letters, 2, axis=1)
        self.second = np.roll(letters, 1, axis=1)
        self.third = letters
        self.row = np.full(SYMBOLS ** 3, -1, np.int32)
        self.table = np.empty((4096, WIDTH), np.int8)
        self.used = 0

    def of(self, grams: np.ndarray) -> np.ndarray:
        new = grams[self.row[grams] < 0]
        if len(new):
            while self.used + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.empty_like(self.table)])
            self.table[self.used:self.used + len(new)] = (
                self.first[new >> 12] * self.second[(new >> 6) & 63] * self.third[new & 63])
            self.row[new] = np.arange(self.used, self.used + len(new))
            self.used += len(new)
        return self.table[self.row[grams]].astype(np.float32)

    def unit(self, text: bytes) -> np.ndarray | None:
        """The text's vector at length one; None if it has no letter."""
        grams, counts = trigrams(text)
        if not len(grams):
            return None
        vector = counts.astype(np.float32) @ self.of(grams)
        length = float(np.sqrt(vector @ vector))
        return vector / length if length else vector


def trigrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams within words, word ends included, and their counts."""
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    symbol = _symbol_table()[points].astype(np.int32)
    symbol = np.concatenate([[0], symbol, [0]])
    symbol = symbol[np.r_[True, (symbol[1:] != 0) | (symbol[:-1] != 0)]]
    if len(symbol) < 3:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    gram = (symbol[:-2] << 12) | (symbol[1:-1] << 6) | symbol[2:]
    return np.unique(gram[symbol[1:-1] != 0], return_counts=True)


def _profiles() -> Profiles:
    if "profiles" not in _tables:
        _tables["profiles"] = Profiles()
    return _tables["profiles"]


def _bundle(batches):
    """Sums of unit vectors, in whole numbers, by language: a few rows for a task."""
    sums: dict[str, np.ndarray] = {}
    profiles = _profiles()
    for batch in batches:
        texts = byte_column(batch.column(0))
        for text, lang in zip(texts, batch.column(1).to_pylist(), strict=True):
            vector = profiles.unit(text)
            if vector is not None:
                total = sums.setdefault(lang, np.zeros(WIDTH, np.int64))
                total += np.rint(vector * UNIT).astype(np.int64)
    for lang, total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * WIDTH), pa.array(np.arange(WIDTH)), pa.array(total)],
            ["lang", "component", "value"])


def learn(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes, from columns ``text`` and ``lang``.

    What comes to the driver is a vector for each language, however many documents.
    """
    sums = (labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
            .mapInArrow(_bundle, "lang string, component bigint, value bigint")
            .groupBy("lang", "component").agg(F.sum("value").alias("value")).toPandas())
    if not len(sums):
        return [], np.empty((0, WIDTH), np.float32)
    table = sums.pivot(index="lang", columns="component", values="value").sort_index()
    vectors = table.to_numpy(np.float64)
    length = np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))
    return list(table.index), (vectors / np.where(length, length, 1)).astype(np.float32)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray],
             text_column: str = "text") -> DataFrame:
    """``docs`` and the columns ``lang_pred`` and ``score`` (cosine, 0 to 1).

    Texts that are null or have no letter are ``und`` with score 0; of equal cosines the
    language first in order has it. Columns of those names give way to the results.
    """
    langs, prototypes = model

    @F.pandas_udf("lang_pred string, score double")
    def nearest(texts: pd.Series) -> pd.DataFrame:
        profiles, found = _profiles(), []
        for text in texts:
            vector = profiles.unit(text) if text is not None and langs else None
            if vector is None:
                found.append((UNKNOWN, 0.0))
                continue
            cosines = prototypes @ vector
            best = int(cosines.argmax())
            found.append((langs[best], float(min(1.0, max(0.0, cosines[best])))))
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    told = docs.withColumn("__language", nearest(F.col(text_column).cast("binary")))
    return told.select(*[F.col(f"`{c}`") for c in docs.columns
                         if c not in ("lang_pred", "score")], "__language.*")


def held_out(id_column: str = "doc_id"):
    """Every fifth document by checksum; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 5 == 0


def language_id(docs: DataFrame) -> DataFrame:
    """The language of every document; learnt from those that are not held out."""
    docs = docs.select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"),
                    model).select("doc_id", "held_out", "lang_pred", "score")


def accepted(docs: DataFrame, least: float = 0.1, telling: int = TELLING) -> DataFrame:
    """Documents with letters, but for texts that are like none of the languages.

    The cosine of a text falls with its length whatever its language, and the components add
    noise of ``WIDTH ** -0.5``. One below ``least`` counts only from ``telling`` trigrams on;
    shorter texts stay.
    """
    @F.pandas_udf("boolean")
    def long_enough(texts: pd.Series) -> pd.Series:
        return pd.Series([text is not None and int(trigrams(text)[1].sum()) >= telling
                          for text in texts], dtype=bool)

    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = docs.select("doc_id", "text", F.struct(*columns).alias("whole"))
    model = learn(docs.where(~held_out()).select("text", "lang"))
    told = identify(whole, model).where(F.col("lang_pred") != UNKNOWN)
    low = F.col("score") < least
    return told.where(~low | ~long_enough(
        F.when(low, F.col("text").cast("binary")))).select("whole.*")
