"""Packing documents into token sequences by cutting-stock column generation.

Every document is tokenised whole and cut into pieces: full sequences and one remainder. The
remainders' lengths form a histogram of bounded width. A linear program over packing patterns (how
many remainders of each length class share a sequence) is solved by column generation: a knapsack
dynamic program prices new patterns with the current duals. Pattern counts are rounded down, what
the rounding leaves is packed first-fit decreasing, and the patterns are dealt to documents by
their rank within a length class.

Only the histogram and the patterns, both bounded by the sequence length, reach the driver; ranks
come from counts per (class, bucket), so a length that a third of all documents share is split.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsguard.llm.common import kept_in_worker, stored, text_chunks, tidy

SEQUENCE = 2048
END_ID = 1
#: Ranks are counted in buckets of about so many pieces of a class.
BUCKET_ROWS = 50_000
#: Column generation stops within this share of the bound on the optimum.
GAP = 0.0005
MAX_PIVOTS = 1500

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


#: Words tokenised at a time: the tokenizer holds some hundred bytes a token until a call returns.
LEARNED = 10_000


class WordIds:
    """Token ids by whitespace-separated word; the vocabulary's rules never cross white space.

    The ids of words seen before are kept as little-endian bytes, so a document is one lookup a word
    and one join. A sentence mark after an ASCII letter or digit at a word's end is a piece of its own for
    the vocabulary, so such a word reuses the ids of what precedes the mark. The store is emptied
    when it grows past ``most`` words.
    """

    def __init__(self, path: str, most: int = 1_000_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; further threads would take memory
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.most = most
        self.known: dict[str, bytes] = {}
        self.end = np.array([END_ID], "<u4").tobytes()

    @staticmethod
    def _words(text: str) -> list[str] | None:
        # str.split() also cuts at the separators 1C-1F, which the vocabulary takes as symbols
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return None
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:  # folding by character and by Python may differ here
            return text.split()
        return text.lower().split()

    def _learn(self, words: set[str]) -> None:
        # only after ASCII: some other letters are folded to a letter and a mark, which joins the sentence mark
        marked = [w for w in words if w[-1] in ".," and w[-2:-1].isascii() and w[-2:-1].isalnum()]
        plain = list((words.difference(marked) | {w[:-1] for w in marked} | {".", ","}) - self.known.keys())
        for a in range(0, len(plain), LEARNED):
            part = plain[a : a + LEARNED]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            ends = np.cumsum([0, *map(len, ids)]) * 4
            flat = np.fromiter(chain.from_iterable(ids), "<u4", int(ends[-1]) // 4).tobytes()
            ends = ends.tolist()
            self.known.update(zip(part, map(flat.__getitem__, map(slice, ends[:-1], ends[1:])), strict=True))
        self.known.update({w: self.known[w[:-1]] + self.known[w[-1]] for w in marked})

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text with END_ID appended, as little-endian unsigned 32-bit bytes."""
        if len(self.known) > self.most:
            self.known = {}
        words = [self._words(t) for t in texts]
        if new := set().union(*filter(None, words)) - self.known.keys():
            self._learn(new)
        get = self.known.__getitem__
        out = []
        for text, ws in zip(texts, words, strict=True):
            if ws is None:
                ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                ids = b"".join(map(get, ws))
            out.append(ids + self.end)
        return out


def word_ids(path: str) -> WordIds:
    return kept_in_worker(("words", path), lambda: WordIds(path))


def cut_pieces(documents: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """Pieces of every document: full sequences, then one remainder. A null text is empty: one id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        for batch in batches:
            for part in text_chunks(batch):
                doc, start, length, crc, total = [], [], [], [], []
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), words.encode(texts), strict=True):
                    for a in range(0, len(ids) // 4, sequence):
                        piece = ids[4 * a : 4 * (a + sequence)]
                        doc.append(doc_id)
                        start.append(a)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(len(ids) // 4)
                columns = [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(cut), PIECES)


def length_classes(sequence: int) -> np.ndarray:
    """Upper ends of the classes: every length up to 256, then steps of at most 1/128 of the length."""
    ends, at = [], 0
    while at < sequence:
        at = min(sequence, at + max(1, 1 << max(0, (at // 128).bit_length() - 1)))
        ends.append(at)
    return np.array(ends)


def price(duals: np.ndarray, lengths: np.ndarray, sequence: int) -> tuple[float, np.ndarray]:
    """The pattern of greatest dual value: an unbounded knapsack over the sequence's tokens."""
    useful = np.flatnonzero(duals > 1e-12)
    order = useful[np.argsort(lengths[useful])]
    sizes, value = lengths[order], duals[order]
    best, choice = np.zeros(sequence + 1), np.full(sequence + 1, -1)
    fits = np.searchsorted(sizes, np.arange(sequence + 1), side="right")
    for c in range(1, sequence + 1):
        best[c] = best[c - 1]
        if n := fits[c]:
            gain = best[c - sizes[:n]] + value[:n]
            k = int(gain.argmax())
            if gain[k] > best[c] + 1e-15:
                best[c], choice[c] = gain[k], k
    pattern, c = np.zeros(len(lengths), np.int64), sequence
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            pattern[order[choice[c]]] += 1
            c -= sizes[choice[c]]
    return float(best[sequence]), pattern


def first_fit(left: dict[int, int], sequence: int) -> list[tuple[list[tuple[int, int]], int]]:
    """First-fit decreasing by whole groups: equal fillings are taken at once, so the work is bounded."""
    left, out = {k: v for k, v in left.items() if v > 0}, []
    while left:
        room, items = sequence, []
        for k in sorted(left, reverse=True):
            if n := min(left[k], room // k):
                items.append((k, n))
                room -= n * k
        times = min(left[k] // n for k, n in items)
        out.append((items, times))
        for k, n in items:
            left[k] -= n * times
        left = {k: v for k, v in left.items() if v > 0}
    return out


def solve_patterns(lengths: np.ndarray, demand: np.ndarray, sequence: int) -> list[tuple[np.ndarray, float]]:
    """Amounts of patterns that cover ``demand``, by column generation; returns (pattern, amount).

    The master program starts from first-fit patterns; a revised simplex with surplus columns solves
    it, and the knapsack adds the best pattern for the current duals until the bound that any duals
    give (demand priced, over the best pattern's price) is within GAP of the amount.
    """
    m = len(lengths)
    place = {int(k): i for i, k in enumerate(lengths)}
    start = first_fit({int(k): int(d) for k, d in zip(lengths, demand, strict=True)}, sequence)
    pool = []
    for items, _ in start:
        column = np.zeros(m)
        for k, n in items:
            column[place[k]] = n
        pool.append(column)
    best = [(c, float(times)) for c, (_, times) in zip(pool, start, strict=True)]
    least = sum(x for _, x in best)
    duals = lengths / sequence  # a token is worth its share of a sequence
    value, column = price(duals, lengths, sequence)
    bound = float(duals @ demand) / value
    if least <= bound * (1 + GAP):
        return [(c.astype(np.int64), x) for c, x in best]
    basis, cost = np.diag(sequence // lengths).astype(float), np.ones(m)
    inverse = np.diag(1.0 / np.diag(basis))
    amount = inverse @ demand
    pool.append(column.astype(float))
    for _ in range(MAX_PIVOTS):
        duals = cost @ inverse
        if duals.min() < -1e-9:  # a surplus column: covering more than is asked costs nothing
            column, price_in = np.zeros(m), 0.0
            column[int(duals.argmin())] = -1.0
        else:
            price_in = 1.0
            values = np.array(pool) @ duals
            column = pool[int(values.argmax())]
            if values.max() <= 1 + 1e-7:
                value, column = price(np.maximum(duals, 0), lengths, sequence)
                bound = max(bound, float(duals @ demand) / value)
                if value <= 1 + 1e-9 or float(cost @ amount) <= bound * (1 + GAP):
                    break
                column = column.astype(float)
                pool.append(column)
        entering = inverse @ column
        able = entering > 1e-9
        if not able.any():
            break
        ratio = np.where(able, amount / np.where(able, entering, 1.0), np.inf)
        leave = int(ratio.argmin())
        step = ratio[leave]
        amount = amount - step * entering
        amount[leave] = step
        np.maximum(amount, 0.0, out=amount)
        pivot = inverse[leave] / entering[leave]
        inverse -= np.outer(entering, pivot)
        inverse[leave] = pivot
        basis[:, leave], cost[leave] = column, price_in
    if float(cost @ amount) < least:
        best = [(basis[:, i], float(amount[i])) for i in range(m) if cost[i]]
    return [(c.astype(np.int64), x) for c, x in best if x > 0]


def rounded_patterns(counts: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[list[int], int]]:
    """Whole patterns covering exactly ``counts`` pieces of each class length: (lengths, how often)."""
    left = {k: v for k, v in counts.items() if v > 0}
    out: list[tuple[list[int], int]] = []
    if not left:
        return out
    lengths = np.array(sorted(left))
    solved = solve_patterns(lengths, np.array([left[k] for k in lengths], float), sequence)
    for pattern, amount in sorted(solved, key=lambda x: -x[1]):
        items = [(int(lengths[i]), int(a)) for i, a in enumerate(pattern) if a]
        times = int(min([amount + 1e-6, *(left[k] // a for k, a in items)]))
        if times > 0:
            out.append(([k for k, a in reversed(items) for _ in range(a)], times))
            for k, a in items:
                left[k] -= a * times
    for items, times in first_fit(left, sequence):
        out.append(([k for k, n in items for _ in range(n)], times))
    return out


def slot_table(patterns: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By class: the first rank, first sequence and place in the pattern of each run of ranks."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    base = 0
    for items, times in patterns:
        for place, k in enumerate(items):
            runs.setdefault(k, []).append((taken.get(k, 0), base, place))
            taken[k] = taken.get(k, 0) + times
        base += times
    return {k: tuple(np.array(x) for x in zip(*v, strict=True)) for k, v in runs.items()}


def pack_pieces(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Add sequence_id and offset to stored ``pieces``; rows that are equal may swap places."""
    ends = length_classes(sequence)
    # a class's upper end: the length itself up to 256, else rounded up to a multiple of the step
    class_of = F.element_at(F.lit(ends[np.searchsorted(ends, np.arange(1, sequence + 1))]), F.col("length").cast("int"))
    histogram = {int(r["class"]): int(r["n"]) for r in pieces.groupBy(class_of.alias("class")).agg(F.count("*").alias("n")).collect()}
    buckets = max(64, max(histogram.values(), default=0) // BUCKET_ROWS)
    slots = slot_table(rounded_patterns(histogram, sequence))

    keyed = pieces.withColumn("_class", class_of).withColumn(
        "_bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)).cast("int")
    )
    inside = Window.partitionBy("_class", "_bucket").orderBy(F.desc("length"), "doc_id", "start", "ids_crc32", "doc_tokens")
    sizes = keyed.groupBy("_class", "_bucket").agg(F.count("*").alias("_n"))
    before = sizes.withColumn(
        "_before",
        F.coalesce(F.sum("_n").over(Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).drop("_n")
    ranked = keyed.withColumn("_rank", F.row_number().over(inside)).join(before, ["_class", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before") - 1).drop("_before", "_bucket")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, rank = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("_class", "_rank"))
            seq, place = np.zeros(len(kind), np.int64), np.zeros(len(kind), np.int64)
            for k in np.unique(kind):
                at = np.flatnonzero(kind == k)
                first, base, slot = slots[int(k)]
                run = np.searchsorted(first, rank[at], side="right") - 1
                seq[at], place[at] = base[run] + rank[at] - first[run], slot[run]
            keep = [batch.column(x) for x in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(seq), pa.array(place)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "_place"],
            )

    dealt = ranked.mapInArrow(tidy(assign), PIECES + ", sequence_id long, _place long")
    in_order = Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dealt.withColumn("offset", F.sum("length").over(in_order) - F.col("length")).drop("_place")


def pack_documents(documents: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """Pack all ``documents`` (doc_id, text; other columns are not read) into token sequences.

    Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Every row is packed,
    also repeated rows, each on its own. An empty table gives no rows.
    """
    return pack_pieces(stored(cut_pieces(documents, tokenizer, sequence), "pieces"), sequence)
