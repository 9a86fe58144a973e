"""Text quality by a sparse ensemble of rules.

Small trees are grown on statistics of labelled texts; every path from a root to a node is a
rule, a conjunction of thresholds. A logistic model with an L1 penalty weighs the rules and
sets most weights to zero. What is left is compiled into one Spark column expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import folders
from shelfmark.llm.buffers import byte_column, grouped, span_hashes
from shelfmark.llm.compression import SPACES, duplicate_lines, words
from shelfmark.llm.language import held_out

SAMPLE = 20_000         # labelled rows that a fit uses at most, chosen by digest of the id
TREES, DEPTH, CUTS = 12, 3, 16
PENALTY = 0.002
STATISTICS = ("log_bytes", "mean_word", "upper", "digit", "mark", "stop", "symbol", "pipe",
              "wide", "space", "lines", "same_lines", "distinct_words", "plain_words")

_FLAGS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "mark": b"!?",
    "stop": b".,;:", "symbol": b"#*$%&<>@^~{}[]=+\\", "pipe": b"|", "lines": b"\n"}


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``STATISTICS`` for each text; zeros for an empty one."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts])
    owner = np.repeat(np.arange(n), sizes + 1)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    length = np.maximum(sizes, 1)
    start, end = words(data)
    of_word = owner[start]
    n_words = np.bincount(of_word, minlength=n)
    some = np.maximum(n_words, 1)
    found = {"log_bytes": np.log1p(sizes), "mean_word": np.bincount(
        of_word, end - start, minlength=n) / some}
    for name, letters in _FLAGS.items():
        flag = np.zeros(256, bool)
        flag[list(letters)] = True
        count = np.bincount(owner[flag[data]], minlength=n)
        found[name] = (count - (name == "lines")) / length
    found["wide"] = np.bincount(owner[data >= 0x80], minlength=n) / length
    found["space"] = (np.bincount(owner[SPACES[data]], minlength=n) - 1) / length
    found["same_lines"] = np.array([duplicate_lines(t) for t in texts]) / (
        1 + found["lines"] * length)
    word = span_hashes(data, start, end) if len(start) else np.empty(0, np.uint64)
    order = np.lexsort((word, of_word))
    fresh = np.r_[True, (np.diff(of_word[order]) != 0) | (np.diff(word[order]) != 0)][
        :len(order)]
    found["distinct_words"] = np.bincount(of_word[order][fresh], minlength=n) / some
    last = data[end - 1] if len(end) else data[:0]
    plain = ((last | 0x20) >= 97) & ((last | 0x20) <= 122) | (last >= 0x80)
    found["plain_words"] = np.bincount(of_word[plain], minlength=n) / some
    return np.where(sizes[:, None] > 0, np.stack([found[s] for s in STATISTICS], axis=1), 0.0)


def _statistics(batches):
    for batch in batches:
        texts = byte_column(batch.column(1))
        for low, high in grouped(texts):
            rows = statistics(texts[low:high])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), *(pa.array(c) for c in rows.T)],
                ["id", *STATISTICS])


def with_statistics(docs: DataFrame, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """``id`` and the statistics of every text, null as empty."""
    fields = ", ".join(f"{s} double" for s in STATISTICS)
    return docs.select(F.col(id_column).cast("bigint").alias("id"),
                       F.col(text_column).cast("binary").alias("text")).mapInArrow(
        _statistics, f"id bigint, {fields}")


@dataclass(frozen=True)
class Rule:
    """Thresholds that all hold: (statistic, whether above, threshold)."""

    terms: tuple[tuple[int, bool, float], ...]

    def of(self, rows: np.ndarray) -> np.ndarray:
        held = np.ones(len(rows), bool)
        for statistic, above, threshold in self.terms:
            held &= (rows[:, statistic] > threshold) == above
        return held

    def column(self) -> Column:
        held = F.lit(True)
        for statistic, above, threshold in self.terms:
            value = F.col(STATISTICS[statistic])
            held = held & ((value > threshold) if above else (value <= threshold))
        return held


@dataclass(frozen=True)
class Ensemble:
    base: float
    rules: tuple[tuple[float, Rule], ...]

    def column(self) -> Column:
        """The probability of label 1 as an expression over the statistics."""
        total = F.lit(self.base)
        for weight, rule in self.rules:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def paths(rows, target, random, depth=DEPTH) -> list[Rule]:
    """Rules of one regression tree over a random half of the statistics."""
    usable = random.permutation(rows.shape[1])[:(rows.shape[1] + 1) // 2]
    found: list[Rule] = []

    def grow(members, terms):
        if terms:
            found.append(Rule(tuple(terms)))
        if len(terms) == depth or len(members) < 40:
            return
        best = (1e-9, None, 0.0)
        y = target[members]
        for statistic in usable:
            values = rows[members, statistic]
            for cut in np.unique(np.quantile(values, np.linspace(0.02, 0.98, CUTS))):
                above = values > cut
                k = above.sum()
                if 10 <= k <= len(members) - 10:
                    gap = y[above].mean() - y[~above].mean()
                    gain = gap * gap * k * (len(members) - k) / len(members)
                    if gain > best[0]:
                        best = (gain, int(statistic), float(cut))
        _, statistic, cut = best
        if statistic is None:
            return
        above = rows[members, statistic] > cut
        grow(members[above], [*terms, (statistic, True, cut)])
        grow(members[~above], [*terms, (statistic, False, cut)])

    grow(random.permutation(len(rows))[:max(1, 2 * len(rows) // 3)], [])
    return found


def lasso(x, y, penalty=PENALTY, steps=400) -> tuple[float, np.ndarray]:
    """Intercept and weights of an L1-penalised logistic model, by accelerated steps."""
    n, k = x.shape
    rate = 4.0 / (np.linalg.norm(x, 2) ** 2 / n + 1.0)
    weight, base = np.zeros(k), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    ahead, ahead_base, t = weight, base, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(x @ ahead + ahead_base))) - y
        new = ahead - rate * (x.T @ error) / n
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_base = ahead_base - rate * error.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - weight)
        ahead_base = new_base + (t - 1) / t_new * (new_base - base)
        weight, base, t = new, new_base, t_new
    return base, weight


def fit(rows: np.ndarray, labels: np.ndarray, seed: int = 5) -> Ensemble:
    """Of no rows the score is a half; of one label its smoothed share."""
    y = labels.astype(float)
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Ensemble(float(np.log(share / (1 - share))), ())
    random = np.random.default_rng(seed)
    rules, rest = [], y - y.mean()
    for _ in range(TREES):
        grown = paths(rows, rest, random)
        rules += grown
        if grown:
            held = np.stack([r.of(rows) for r in grown], axis=1).astype(float)
            leaf, *_ = np.linalg.lstsq(held, rest, rcond=None)
            rest = rest - 0.5 * held @ leaf
    rules = list(dict.fromkeys(rules))
    if not rules:
        share = y.mean()
        return Ensemble(float(np.log(share / (1 - share))), ())
    base, weight = lasso(np.stack([r.of(rows) for r in rules], axis=1).astype(float), y)
    kept = tuple((float(w), r) for w, r in zip(weight, rules, strict=True) if abs(w) > 1e-6)
    return Ensemble(float(base), kept)


def learn(statistics_of: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    """An ensemble from ``labels`` (id, label), of which ``sample`` rows are used at most.

    The sample is chosen by digest of the id; it alone comes to the driver. A label that is
    null or neither 0 nor 1 is not used; several labels of an id all count.
    """
    chosen = (labels.where("label IN (0, 1)").join(statistics_of, "id")
              .orderBy(F.xxhash64("id"), "id", "label").limit(sample)
              .select(*STATISTICS, "label").toPandas())
    return fit(chosen[list(STATISTICS)].to_numpy(float).reshape(-1, len(STATISTICS)),
               chosen["label"].to_numpy(float))


def sparse_rules(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """The quality score of every document; labels of held-out documents are not used."""
    known = folders.written(with_statistics(docs), "quality-statistics")
    model = learn(known, labels.where(~held_out()).select(
        F.col("doc_id").cast("bigint").alias("id"), F.col("quality").alias("label")))
    return known.select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"),
        model.column().alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= least, 1).otherwise(0))
