"""Quality classifier learned from trusted positives and unlabelled web text.

Each text becomes sixteen measures of its form (shares of character classes, repetition, word and
line shape), cut at fixed edges. An additive model over the cut measures minimises the non-negative
unbiased risk of positive-unlabelled learning: labelled negatives are never used. The class prior is
the least ratio of unlabelled to positive mass over upper score ranges of a first classifier that
tells positives from unlabelled text.

The measures of all rows are stored once; every gradient is one small job over that table with
sums by coefficient, so no sample is drawn and only coefficients reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsguard.llm.common import held_out, learnable, stored

MEASURES = (
    "upper", "digit", "bang", "pipe", "stop", "other_mark", "space", "line_end", "beyond_ascii",
    "symbol", "same_next", "distinct", "line_repeat", "word_length", "words", "entropy",
)
#: Inner edges: for shares, for word length, for log2 of the word count, for entropy in bits.
SHARE = (0.0, 0.0005, 0.001, 0.002, 0.005, 0.01, 0.02, 0.04, 0.08, 0.15, 0.25, 0.4, 0.6, 0.8)
LENGTH = (0.0, 2.0, 3.0, 3.5, 4.0, 4.5, 5.0, 5.5, 6.0, 6.5, 7.0, 8.0, 10.0, 14.0)
LOG_WORDS = (0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0, 10.0, 11.0, 12.0, 13.0)
ENTROPY = (0.0, 1.0, 2.0, 2.5, 3.0, 3.25, 3.5, 3.75, 4.0, 4.25, 4.5, 4.75, 5.0, 5.5)
EDGES = np.array([*[SHARE] * 13, LENGTH, LOG_WORDS, ENTROPY])
BINS = EDGES.shape[1] + 1
PARAMETERS = len(MEASURES) * BINS
FIRST_STEPS, FIRST_RATE, RISK_STEPS, RATE = 20, 0.3, 70, 0.1
#: Weight decay: a constant, and a part that falls with the number of trusted positives.
DECAY, DECAY_ROWS = 1e-4, 3.0
THRESHOLD = 0.7


def measures(text: str) -> list[float]:
    """The measures of a whole text; all zero for an empty one."""
    raw = text.encode("utf-8", "replace")
    words, n = text.split(), len(raw)
    if not words:
        return [0.0] * len(MEASURES)
    c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, digit, high = c[65:91].sum(), c[48:58].sum(), c[128:].sum()
    marks = c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum()
    stop, symbol = c[46] + c[44], c[35:39].sum() + c[42]
    lines = text.split("\n")
    p = c[c > 0] / n
    return [
        upper / n, digit / n, c[33] / n, c[124] / n, stop / n, (marks - c[33] - c[124] - stop - symbol) / n, c[32] / n, c[10] / n, high / n, symbol / n,
        sum(map(eq, words, words[1:])) / len(words), len(set(words)) / len(words), 1 - len(set(lines)) / len(lines),
        (n - c[32] - c[10]) / len(words), np.log2(len(words)), float(-(p * np.log2(p)).sum()),
    ]


def cut_measures(documents: DataFrame) -> DataFrame:
    """(doc_id, at): for each row the coefficient that each measure selects; null texts count as empty."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.arange(len(MEASURES)) * BINS
        for batch in batches:
            found = np.array([measures(t.as_py() or "") for t in batch.column("text")]).reshape(-1, len(MEASURES))
            at = np.stack([np.searchsorted(e, found[:, i], side="right") for i, e in enumerate(EDGES)], axis=1) + first
            rows = pa.ListArray.from_arrays(
                pa.array(np.arange(len(at) + 1) * len(MEASURES), pa.int32()), pa.array(at.ravel().astype(np.int16))
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], names=["doc_id", "at"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(apply, "doc_id long, at array<smallint>")


def logit(at: Column, weights: np.ndarray, bias: float) -> Column:
    table = F.lit([float(w) for w in weights])
    parts = [F.element_at(table, (F.element_at(at, i + 1) + 1).cast("int")) for i in range(len(MEASURES))]
    total = F.lit(float(bias))
    for part in parts:
        total = total + part
    return total


def sums(rows: DataFrame, weights: np.ndarray, bias: float) -> dict[tuple[bool, int], np.ndarray]:
    """For positives and unlabelled rows, by coefficient (the last is the bias): the summed slopes and
    losses of the logistic loss towards label 1 and label 0, and the rows."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, PARAMETERS + 1, 5))
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch.column("at").flatten().to_numpy().astype(int).reshape(-1, len(MEASURES))
            known = np.asarray(batch.column("positive").to_numpy(zero_copy_only=False), bool)
            z = weights[at].sum(axis=1) + bias
            up = 1 / (1 + np.exp(-z))
            values = np.stack([up - 1, up, np.logaddexp(0, -z), np.logaddexp(0, z), np.ones(len(z))], axis=1)
            for k in (0, 1):
                mine, v = at[known == k], values[known == k]
                for j in range(5):
                    total[k, :PARAMETERS, j] += np.bincount(mine.ravel(), np.repeat(v[:, j], len(MEASURES)), PARAMETERS)
                total[k, PARAMETERS] += v.sum(axis=0)
        where, index = np.nonzero(total[:, :, 4])
        columns = [pa.array(where.astype(bool)), pa.array(index.astype(np.int32)), *(pa.array(total[where, index, j]) for j in range(5))]
        yield pa.RecordBatch.from_arrays(columns, names=["positive", "i", "a", "b", "c", "d", "n"])

    schema = "positive boolean, i int, a double, b double, c double, d double, n double"
    summed = rows.mapInArrow(apply, schema).groupBy("positive", "i").agg(*(F.sum(x).alias(x) for x in "abcdn"))
    return {(r["positive"], r["i"]): np.array([r[x] for x in "abcdn"]) for r in summed.collect()}


def table_of(got: dict[tuple[bool, int], np.ndarray], positive: bool) -> np.ndarray:
    """Means over the class's rows: (coefficient, [slope to 1, slope to 0, loss to 1, loss to 0, share])."""
    total = got.get((positive, PARAMETERS), np.zeros(5))
    out = np.zeros((PARAMETERS + 1, 5))
    for (kind, i), v in got.items():
        if kind == positive:
            out[i] = v
    return out / max(total[4], 1.0)


def class_prior(rows: DataFrame, weights: np.ndarray, bias: float) -> float:
    """The least ratio of unlabelled to positive mass above a score, over ranges that hold enough positives."""
    level = F.floor(F.greatest(F.least(logit(F.col("at"), weights, bias), F.lit(8.0)), F.lit(-8.0)) * 8).cast("int")
    got = rows.groupBy(level.alias("level"), "positive").agg(F.count("*").alias("n")).collect()
    counts = {(r["level"], r["positive"]): r["n"] for r in got}
    n_u, n_p = (sum(n for (_, k), n in counts.items() if k is kind) for kind in (False, True))
    if not n_u or not n_p:
        return 0.5
    best, u, p = 1.0, 0, 0
    for at in sorted({k for k, _ in counts}, reverse=True):
        u, p = u + counts.get((at, False), 0), p + counts.get((at, True), 0)
        if p >= 0.2 * n_p and p >= 30:
            slack = 1 / np.sqrt(p) + 1 / np.sqrt(max(u, 1))
            best = min(best, (u / n_u) / (p / n_p) * (1 + slack))
    return float(min(0.98, max(0.02, best)))


class Steps:
    """Adam steps over the coefficients and the bias."""

    def __init__(self) -> None:
        self.w, self.m, self.v, self.t, self.decay = np.zeros(PARAMETERS + 1), 0.0, 0.0, 0, DECAY

    def take(self, slope: np.ndarray, rate: float) -> None:
        self.t += 1
        slope = slope + self.decay * self.w
        self.m = 0.9 * self.m + 0.1 * slope
        self.v = 0.99 * self.v + 0.01 * slope**2
        self.w = self.w - rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.99**self.t)) + 1e-8)


def fit_quality(cut: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float, float]:
    """(weights, bias, prior) from learnable rows of the stored ``cut``; only positive labels are read."""
    trusted = (
        labels.where(learnable(F.col("doc_id")) & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q")).where("q = 1").select("doc_id", F.lit(True).alias("t"))
    )
    web = cut.where(learnable(F.col("doc_id")))
    known = web.join(trusted, "doc_id", "left_semi").select("at", F.lit(True).alias("positive"))
    rows = stored(known.unionByName(web.select("at", F.lit(False).alias("positive"))), "quality-rows")
    positives = rows.where("positive").count()
    first, risk = Steps(), Steps()
    first.decay = risk.decay = DECAY + DECAY_ROWS / max(positives, 1)
    for _ in range(FIRST_STEPS):  # positives against all web text
        got = sums(rows, first.w[:-1], float(first.w[-1]))
        first.take(0.5 * table_of(got, True)[:, 0] + 0.5 * table_of(got, False)[:, 1], FIRST_RATE)
    prior = class_prior(rows, first.w[:-1], float(first.w[-1]))
    for k in range(RISK_STEPS):
        got = sums(rows, risk.w[:-1], float(risk.w[-1]))
        p, u = table_of(got, True), table_of(got, False)
        rest = u[PARAMETERS, 3] - prior * p[PARAMETERS, 3]  # risk of the negatives, which cannot be below 0
        slope_rest = u[:, 1] - prior * p[:, 1]
        risk.take(prior * p[:, 0] + slope_rest if rest >= 0 else -slope_rest, RATE * (1 - 0.9 * k / RISK_STEPS))
    return risk.w[:-1], float(risk.w[-1]), prior


def score_quality(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``.

    Only texts are scored; a null or empty text is scored as a text without words. Repeated rows score
    alike; without trusted positives every score is near one half; an empty table gives no rows.
    """
    cut = stored(cut_measures(documents), "quality-measures")
    weights, bias, _ = fit_quality(cut, labels)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit(F.col("at"), weights, bias)))
    return cut.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
