"""Toxicity by compression distance to two zstandard dictionaries.

A window is one word written four times, so that its letters and not the frame decide the compressed
length. The toxic dictionary is made of windows that toxic text has and ordinary text lacks, the
ordinary dictionary of ordinary text's commonest windows. A window's margin is what the toxic
dictionary saves against the ordinary one, counted only where the toxic length is as short as that
of a whole dictionary entry (both thresholds come from labelled rows). A document's margin is its
greatest; labelled rows kept apart from the dictionaries turn margins into probabilities.

Words are counted by distinct preceding word, so copies of a document count once.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsguard.llm.common import held_out, kept_in_worker, learnable, stored, tidy

#: Cut between words, the same for Spark and Python.
BREAK = r"[\s!-/:-@\[-`{-~]+"
LEVEL = 19
REPEATS = 4
#: Bound on the labelled rows of each class that a fit reads, chosen by a hash of doc_id.
SAMPLE_PER_CLASS = 12_000
TOXIC_ENTRIES, ORDINARY_ENTRIES = 1_000, 2_500
#: Least log-likelihood gain, and least ratio of rates, of a toxic window.
LEAST_GAIN, LEAST_RATIO = 10.0, 4.0
THRESHOLD = 0.3
NOTHING = -99
CACHED_WINDOWS = 300_000

_break = re.compile(BREAK)


def window(word: str) -> bytes:
    return (" ".join([word] * REPEATS) + " ").encode("utf-8", "replace")


def compressor(entries: list[str]) -> zstandard.ZstdCompressor:
    """Entries by falling weight; the heaviest are nearest to the window, where a reference is cheapest."""
    raw = b"".join(window(w) for w in reversed(entries)) or b"        "
    content = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=content, write_content_size=False, write_dict_id=False, write_checksum=False
    )


@dataclass
class CompressionModel:
    toxic: list[str]
    ordinary: list[str]
    prior: float
    longest: int = 0
    #: Margin thresholds, ascending, and the probability from each on; the first holds for all below.
    steps: list[tuple[int, float]] = field(default_factory=list)

    def margins(self) -> Margins:
        key = ("margins", tuple(self.toxic), tuple(self.ordinary), self.longest)
        return kept_in_worker(key, lambda: Margins(self))

    def probability(self, margins: np.ndarray) -> np.ndarray:
        if not self.steps:
            return np.full(len(margins), self.prior)
        at = np.searchsorted([s for s, _ in self.steps], margins, side="right") - 1
        return np.array([p for _, p in self.steps])[np.maximum(at, 0)]


class Margins(dict):
    """Margin by word; kept for the worker's life, emptied when it grows too large."""

    def __init__(self, model: CompressionModel) -> None:
        super().__init__()
        self.a, self.b, self.longest = compressor(model.ordinary), compressor(model.toxic), model.longest

    def __missing__(self, word: str) -> int:
        text = window(word)
        short = len(self.b.compress(text))
        self[word] = value = len(self.a.compress(text)) - short if short <= self.longest else NOTHING
        return value

    def of(self, text: str | None) -> int:
        if len(self) > CACHED_WINDOWS:
            self.clear()
        words = set(_break.split(text.lower())) if text else set()
        words.discard("")
        return max(map(self.__getitem__, words), default=NOTHING)


def with_margin(documents: DataFrame, model: CompressionModel) -> DataFrame:
    """(doc_id, margin) for every row of ``documents``."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.margins().of
        for batch in batches:
            found = pa.array([of(t.as_py()) for t in batch.column("text")], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), found], names=["doc_id", "margin"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(measure), "doc_id long, margin int")


def sampled_labels(labels: DataFrame, column: str, per_class: int) -> tuple[DataFrame, dict[int, int], dict[int, float]]:
    """Learnable labels, one row for each document without contradiction, at most about ``per_class``
    of each class by a hash of doc_id; with the counts of all such labels and the sampled shares."""
    one = (
        labels.where(F.col(column).isNotNull() & learnable(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(column).cast("int").alias("y"), F.max(column).cast("int").alias("_most"))
        .where("y = _most and y in (0, 1)")
        .drop("_most")
    )
    counts = {int(r["y"]): int(r["n"]) for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = {y: min(1.0, per_class / n) for y, n in counts.items()}
    spot = F.pmod(F.xxhash64(F.lit(column), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    limit = F.when(F.col("y") == 1, F.lit(share.get(1, 0.0))).otherwise(F.lit(share.get(0, 0.0)))
    return one.where(spot < limit), counts, share


def for_calibration(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("calibration"), doc_id), F.lit(10)) >= 7


def fit_toxicity(documents: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> CompressionModel:
    """Dictionaries and thresholds from learnable labels only; a model without steps if there are too few."""
    chosen, counts, share = sampled_labels(labels, "toxic", per_class)
    prior = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    words = F.filter(F.split(F.lower("text"), BREAK), lambda w: w != "")
    pairs = (
        rows.where(~for_calibration(F.col("doc_id")) & F.col("text").isNotNull())
        .select("y", words.alias("w"))
        .select("y", F.explode(F.arrays_zip(F.col("w"), F.concat(F.array(F.lit("")), "w").alias("before"))).alias("p"))
        .select("y", F.col("p.w").alias("word"), F.col("p.before").alias("before"))
        .where(F.col("word").isNotNull())
        .distinct()
    )
    by_word = stored(
        pairs.groupBy("word").agg(F.count_if(F.col("y") == 1).alias("t"), F.count_if(F.col("y") == 0).alias("o")),
        "toxicity-words",
    )
    totals = by_word.agg(F.sum("t").alias("t"), F.sum("o").alias("o")).first()
    nt, no = int(totals["t"] or 0), int(totals["o"] or 0)
    if not nt or not no:
        return CompressionModel([], [], prior)
    q = nt / (nt + no)
    t, o, n = F.col("t"), F.col("o"), F.col("t") + F.col("o")
    gain = t * F.log(t / (n * q)) + F.when(o > 0, o * F.log(o / (n * (1 - q)))).otherwise(0.0)
    toxic = (
        by_word.where((t >= 3) & (t / nt > LEAST_RATIO * (o + 0.5) / no) & (gain >= LEAST_GAIN))
        .orderBy(F.desc(gain), "word").limit(TOXIC_ENTRIES).select("word").collect()
    )
    ordinary = by_word.where(o > 1).orderBy(F.desc("o"), "word").limit(ORDINARY_ENTRIES).select("word").collect()
    model = CompressionModel([r["word"] for r in toxic], [r["word"] for r in ordinary], prior)
    if not toxic:
        return model
    entry = compressor(model.toxic)
    lengths = sorted(len(entry.compress(window(w))) for w in model.toxic)
    model.longest = lengths[int(0.98 * (len(lengths) - 1))]
    apart = rows.where(for_calibration(F.col("doc_id")))
    seen = (
        with_margin(apart, model).join(F.broadcast(chosen), "doc_id").groupBy("margin", "y").agg(F.count("*").alias("n")).collect()
    )
    model.steps = calibrated([(int(r["margin"]), int(r["y"]), r["n"] / share[int(r["y"])]) for r in seen], prior)
    return model


def calibrated(rows: list[tuple[int, int, float]], prior: float) -> list[tuple[int, float]]:
    """Monotone probability by margin: adjacent violators are pooled; half a row of prior in each step."""
    blocks: list[list[float]] = []  # margin, weight, weight of label 1
    for margin in sorted({m for m, _, _ in rows}):
        total = sum(w for m, _, w in rows if m == margin)
        blocks.append([margin, total, sum(w for m, y, w in rows if m == margin and y)])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            _, w, p = blocks.pop()
            blocks[-1][1] += w
            blocks[-1][2] += p
    return [(int(m), min(1.0, max(0.0, (p + 0.5 * prior) / (w + 0.5)))) for m, w, p in blocks]


def score_toxicity(documents: DataFrame, model: CompressionModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; a null or empty text scores the lowest step.

    Only the text is read. Repeated rows score alike; an empty table gives no rows.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.margins().of
        for batch in batches:
            score = model.probability(np.array([of(t.as_py()) for t in batch.column("text")], int))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score, pa.float64())], names=["doc_id", "score"]
            )

    scored = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(apply), "doc_id long, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_civil(documents: DataFrame, model: CompressionModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that score below ``threshold``, with all their columns.

    A model without steps tells no text from another: all rows are kept.
    """
    if not model.steps:
        return documents

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.margins().of
        for batch in batches:
            score = model.probability(np.array([of(t.as_py()) for t in batch.column("text")], int))
            yield batch.filter(pa.array(score < threshold))

    return documents.mapInArrow(tidy(keep), documents.schema)
