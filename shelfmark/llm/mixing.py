"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed in the cells of (source, language, topic). The cells are raked: scaled to
the target of each source, then of each language, then of each topic, and over again. A
document is drawn with the probability of its cell, the fitted over the given tokens relative
to the largest such ratio, by a digest of its id: expected tokens then have the fitted
proportions and no document is needed twice. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm import folders

MARGINS = ("source", "lang", "topic")
TEMPER = 0.9            # targets are shares to this power, unless they are given
ROUNDS = 8
BUDGET = 0.9            # tokens that a budgeted sample is expected to have, of those given
SEED = "mix-1"


def topic_of(text: Column) -> Column:
    """The form of a text, as a topic that needs no model; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(text.contains(" | "), "tabular")
            .when(text.rlike("[#*$%&]{3}"), "symbols")
            .when(~text.rlike("[a-z]"), "capitals")
            .when(F.octet_length(text) < 400, "note")
            .when(F.octet_length(text) < 4000, "article").otherwise("chapter"))


def tokens_of(text: Column) -> Column:
    """Tokens as a quarter of the bytes, at least one."""
    return F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4)).cast(
        "bigint")


def drawn(id_column: str, seed: str) -> Column:
    """A number from 0 up to 1 that depends on the id and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(id_column).cast("string"),
                                                          F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(2**48))


def raked(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None,
          temper: float = TEMPER, rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (margins and ``mass``) with ``fitted``, the mass after raking.

    ``targets`` gives weights of the values of a margin; values it lacks get none. Margins
    without targets get their own shares to the power ``temper``. Null is a value like any
    other. The total mass stays.
    """
    targets = targets or {}
    of = {m: Window.partitionBy(m) for m in MARGINS}
    cells = cells.select(*MARGINS, F.col("mass").cast("double").alias("mass"))
    for m in MARGINS:
        if m in targets:
            weight = F.lit(0.0)
            for value, share in targets[m].items():
                weight = F.when(F.col(m) == value, F.lit(float(share))).otherwise(weight)
        else:
            weight = F.pow(F.sum("mass").over(of[m]), F.lit(temper))
        # A margin's weight is split over its cells, so that their sum counts it once.
        cells = cells.withColumn(f"goal_{m}", weight).withColumn(
            f"part_{m}", weight * F.col("mass") / F.sum("mass").over(of[m]))
    cells = folders.written(cells, "cells")
    sums = cells.agg(F.sum("mass").alias("mass"),
                     *[F.sum(f"part_{m}").alias(m) for m in MARGINS]).first()
    fitted = cells.withColumn("fitted", F.col("mass"))
    for n in range(rounds):
        for m in MARGINS:
            if not sums[m]:
                continue
            goal = F.col(f"goal_{m}") * F.lit(sums["mass"] / sums[m])
            held = F.sum("fitted").over(of[m])
            fitted = fitted.withColumn(
                "fitted", F.when(held > 0, F.col("fitted") * goal / held).otherwise(0.0))
        if n % 4 == 3:
            fitted = folders.written(fitted, "raked")
    return fitted.select(*MARGINS, "mass", "fitted")


def probabilities(docs: DataFrame, targets=None, temper: float = TEMPER,
                  rounds: int = ROUNDS) -> DataFrame:
    """``docs`` (with margins and ``n_tokens``) and the ``probability`` of each row."""
    cells = docs.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("mass"))
    ratio = folders.written(
        raked(cells, targets, temper, rounds).select(
            *[F.col(m).alias(f"of_{m}") for m in MARGINS],
            (F.col("fitted") / F.col("mass")).alias("ratio")), "ratios")
    most = ratio.agg(F.max("ratio")).first()[0] or 1.0
    same = [docs[m].eqNullSafe(F.col(f"of_{m}")) for m in MARGINS]
    return docs.join(folders.small_enough(ratio, 100_000), same).select(
        *[docs[c] for c in docs.columns],
        F.round(F.col("ratio") / F.lit(most), 6).alias("probability"))


def budgeted(cells: DataFrame, targets: dict[str, dict[str, float]] | None = None,
             temper: float = TEMPER, rounds: int = ROUNDS, budget: float = BUDGET) -> DataFrame:
    """``cells`` with ``fitted``: masses near the targets, none above its own, ``budget`` of all.

    Cells whose goal is more than they have are whole, and the others of their margins are
    raked to what is left of the goals. A cell thus never scales down more than what its own
    few tokens leave to others. What the margins leave of the budget goes to the cells that
    are not whole yet, in proportion; cells of weight zero get none.
    """
    fitted = raked(cells, targets, temper, rounds)
    total = fitted.agg(F.sum("mass")).first()[0] or 0.0
    wanted = budget * total
    of = {m: Window.partitionBy(m) for m in MARGINS}
    # The goals of a margin are what raking has made of it, scaled to the budget.
    fitted = fitted.withColumn("fitted", F.col("fitted") * F.lit(budget))
    for m in MARGINS:
        fitted = fitted.withColumn(f"goal_{m}", F.sum("fitted").over(of[m]))
    whole = F.col("fitted") >= F.col("mass")
    capped = F.least("fitted", "mass")
    fitted = fitted.withColumn("fitted", capped)
    for n in range(rounds):
        for m in MARGINS:
            taken = F.sum(F.when(whole, F.col("mass")).otherwise(0.0)).over(of[m])
            free = F.sum(F.when(whole, 0.0).otherwise(F.col("fitted"))).over(of[m])
            left = F.greatest(F.lit(0.0), F.col(f"goal_{m}") - taken)
            fitted = fitted.withColumn("fitted", F.when(
                whole | (free <= 0), F.col("fitted")).otherwise(
                F.least(F.col("mass"), F.col("fitted") * left / free)))
        if n % 2:
            fitted = folders.written(fitted, "budgeted")
    fitted = folders.written(fitted.select(*MARGINS, "mass", "fitted"), "budgeted")
    # The one scale at which the expected tokens are the budget; each step fills a cell more.
    scale, full = 1.0, -1
    while True:
        reached = F.col("fitted") * F.lit(scale) >= F.col("mass")
        held = fitted.agg(
            F.sum(F.when(reached, F.col("mass")).otherwise(0.0)).alias("whole"),
            F.sum(F.when(reached, 0.0).otherwise(F.col("fitted"))).alias("free"),
            F.count(F.when(reached, 1)).alias("full")).first()
        now = (held["whole"] or 0.0) + (held["free"] or 0.0) * scale
        if full < 0 and now > wanted:
            scale = wanted / now
            break
        if not held["free"] or held["full"] == full:
            break
        full, scale = held["full"], (wanted - held["whole"]) / held["free"]
    return fitted.withColumn("fitted", F.least(F.col("mass"), F.col("fitted") * F.lit(scale)))


def budgeted_probabilities(docs: DataFrame, targets=None, temper: float = TEMPER,
                           rounds: int = ROUNDS, budget: float = BUDGET) -> DataFrame:
    """``docs`` (with margins and ``n_tokens``) and the ``probability`` of each row."""
    cells = docs.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("mass"))
    ratio = folders.written(
        budgeted(cells, targets, temper, rounds, budget).select(
            *[F.col(m).alias(f"of_{m}") for m in MARGINS],
            F.least(F.lit(1.0), F.col("fitted") / F.col("mass")).alias("ratio")), "ratios")
    same = [docs[m].eqNullSafe(F.col(f"of_{m}")) for m in MARGINS]
    return docs.join(folders.small_enough(ratio, 100_000), same).select(
        *[docs[c] for c in docs.columns], F.round("ratio", 6).alias("probability"))


def described(docs: DataFrame) -> DataFrame:
    """Id, margins and tokens of every document, and all its columns as ``whole``."""
    return docs.select(
        F.col("doc_id").alias("id"), "source", "lang", topic_of(F.col("text")).alias("topic"),
        tokens_of(F.col("text")).alias("n_tokens"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))


def mixing(docs: DataFrame) -> DataFrame:
    """The documents drawn, with their cell, tokens and probability.

    Null sources and languages are values of their own; rows of one id are drawn alike.
    """
    told = probabilities(described(docs.select("doc_id", "text", "source", "lang")).drop("whole"))
    return told.where(drawn("id", SEED) < F.col("probability")).withColumnRenamed("id", "doc_id")


def mixed(docs: DataFrame) -> DataFrame:
    """The documents drawn within the budget, in the same columns."""
    told = budgeted_probabilities(described(docs))
    return told.where(drawn("id", SEED) < F.col("probability")).select("whole.*")


def mixing_sql(temper: float = TEMPER, rounds: int = ROUNDS, seed: str = SEED) -> str:
    """The same in SQL, one common table for each scaling."""
    goals = ", ".join(
        f"pow(sum(mass) OVER (PARTITION BY {m}), {temper}) AS goal_{m}, "
        f"pow(sum(mass) OVER (PARTITION BY {m}), {temper}) * mass "
        f"/ sum(mass) OVER (PARTITION BY {m}) AS part_{m}" for m in MARGINS)
    steps, last = [], "goals"
    for n in range(rounds):
        for m in MARGINS:
            name = f"r{n}_{m}"
            fitted = "mass" if last == "goals" else "fitted"
            columns = ", ".join(f"goal_{x}" for x in MARGINS)
            steps.append(
                f"{name} AS MATERIALIZED (SELECT {', '.join(MARGINS)}, mass, {columns}, "
                f"{fitted} * goal_{m} * (SELECT sum(mass) / sum(part_{m}) FROM goals) "
                f"/ sum({fitted}) OVER (PARTITION BY {m}) AS fitted FROM {last})")
            last = name
    return f"""
WITH told AS (
  SELECT doc_id, source, lang,
    CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'tabular'
         WHEN regexp_matches(coalesce(text, ''), '[#*$%&]{{3}}') THEN 'symbols'
         WHEN NOT regexp_matches(coalesce(text, ''), '[a-z]') THEN 'capitals'
         WHEN strlen(coalesce(text, '')) < 400 THEN 'note'
         WHEN strlen(coalesce(text, '')) < 4000 THEN 'article' ELSE 'chapter' END AS topic,
    greatest(1, CAST(ceil(strlen(coalesce(text, '')) / 4.0) AS BIGINT)) AS n_tokens
  FROM documents),
cells AS MATERIALIZED (
  SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS mass FROM told
  GROUP BY source, lang, topic),
goals AS MATERIALIZED (SELECT *, {goals} FROM cells),
{", ".join(steps)},
ratios AS MATERIALIZED (
  SELECT source, lang, topic, fitted / mass AS ratio FROM {last}),
drawn AS (
  SELECT t.doc_id, t.source, t.lang, t.topic, t.n_tokens,
    round(r.ratio / (SELECT max(ratio) FROM ratios), 6) AS probability
  FROM told t JOIN ratios r ON t.source IS NOT DISTINCT FROM r.source
    AND t.lang IS NOT DISTINCT FROM r.lang AND t.topic = r.topic)
SELECT * FROM drawn
WHERE CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12)
           AS BIGINT) / 281474976710656.0 < probability"""
