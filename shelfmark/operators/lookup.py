"""Resolving raw values against a vocabulary, and reporting what did not match."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, fold
from ..vocabularies import Vocabulary

# A vocabulary is hinted for broadcast up to this many spellings (a few MB);
# beyond it Spark chooses the join from its own statistics.
BROADCAST_SPELLINGS = 50_000
# Stands for null beside folded values, none of which holds a hyphen.
NO_SPELLING = "-"


def spellings_of(frame: DataFrame, vocabulary: Vocabulary | DataFrame) -> DataFrame:
    """``(folded, canonical)``, hinted for broadcast only when known to be small."""
    if isinstance(vocabulary, DataFrame):
        return vocabulary.select("folded", "canonical")
    table = vocabulary.spellings(frame.sparkSession)
    return F.broadcast(table) if _small(vocabulary) else table


def _small(vocabulary: Vocabulary | DataFrame) -> bool:
    return isinstance(vocabulary, Vocabulary) and len(vocabulary.lookup) <= BROADCAST_SPELLINGS


def resolve(frame: DataFrame, **outputs: tuple[Column | str, Vocabulary | DataFrame],
            ) -> DataFrame:
    """Add one canonical column per output: ``resolve(df, brand=("vendor", brands))``.

    A value no spelling matches becomes null; so does everything under an empty
    vocabulary. A left join on the folded value, so no row is lost or doubled. Where that
    value is a column that is never null, a later filter on the output has no null test of
    it derived, which would fold every value a second time.
    """
    for output, (raw, vocabulary) in outputs.items():
        raw = F.col(raw) if isinstance(raw, str) else raw
        if isinstance(vocabulary, Vocabulary) and not vocabulary.lookup:
            frame = frame.withColumn(output, F.lit(None).cast("string"))
            continue
        folded = f"_folded_{output}"
        table = spellings_of(frame, vocabulary).select(
            F.col("folded").alias(folded), F.col("canonical").alias(output))
        value = fold(raw)
        if _small(vocabulary):
            value = F.coalesce(value, F.lit(NO_SPELLING))
        frame = frame.withColumn(folded, value).join(table, folded, "left").drop(folded)
    return frame


def first_resolved(frame: DataFrame, output: str, columns: Sequence[str],
                   vocabulary: Vocabulary) -> DataFrame:
    """The first of several raw columns that maps to something."""
    parts = {f"_{output}_{i}": (c, vocabulary) for i, c in enumerate(columns)}
    resolved = resolve(frame, **parts)
    return resolved.withColumn(output, F.coalesce(*map(F.col, parts))).drop(*parts)


def resolve_arrays(frame: DataFrame, keys: Sequence[str], values: str, output: str,
                   vocabulary: Vocabulary | DataFrame, several: str) -> DataFrame:
    """``one_of`` for a vocabulary too large for a literal map.

    ``keys`` identify a row. The array is exploded, joined with the spellings and
    reduced to two values per row before the shuffle.
    """
    found = (
        frame.select(*keys, F.explode(values).alias("_value"))
        .withColumn("_folded", fold(F.col("_value")))
        .join(spellings_of(frame, vocabulary).withColumnRenamed("folded", "_folded"),
              "_folded")
        .groupBy(*keys)
        .agg(F.min("canonical").alias("_low"), F.max("canonical").alias("_high"))
        .withColumn(output, F.when(F.col("_low") == F.col("_high"), F.col("_low"))
                    .otherwise(F.lit(several)))
    )
    return frame.join(found.select(*keys, output), list(keys), "left")


def unmatched(frame: DataFrame, column: str, vocabulary: Vocabulary | DataFrame,
              *, counted_as: str = "products") -> DataFrame:
    """Raw values the vocabulary did not recognise, and how often, most frequent first.

    Counted before the lookup, so only distinct values are folded and joined. The
    value itself breaks ties.
    """
    counted = (
        frame.select(clean_text(F.col(column)).alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value").agg(F.count(F.lit(1)).alias(counted_as))
    )
    return (
        resolve(counted, _matched=("value", vocabulary))
        .where(F.col("_matched").isNull())
        .select("value", counted_as)
        .orderBy(F.desc(counted_as), "value")
    )


def unmatched_preview(frame: DataFrame, column: str,
                      vocabulary: Vocabulary | DataFrame, top: int = 8,
                      ) -> tuple[list[tuple[str, int]], bool]:
    """The ``top`` unmatched values, and whether there are more."""
    rows = unmatched(frame, column, vocabulary).limit(top + 1).collect()
    return [(r["value"], r["products"]) for r in rows[:top]], len(rows) > top


def collision_findings(vocabularies: Mapping[str, Vocabulary]) -> list[tuple[str, str, str]]:
    """Spellings two canonical values claim, as ``(level, where, message)``."""
    return [
        ("WARN", name, f"spelling {folded!r} means {kept}, no longer {lost}")
        for name, vocabulary in vocabularies.items()
        for folded, lost, kept in vocabulary.collisions
    ]
