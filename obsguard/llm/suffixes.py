"""Exact removal of repeated byte strings by bucket refinement over sampled suffixes.

Two suffixes that agree on ``LENGTH`` bytes agree on every q-gram in them, so instead of all suffixes
only the bucket of each window's least q-gram (its anchor) is kept. Buckets are refined step by
step, each step reusing the identifiers of the one before:

1. Suffixes start in the bucket of their anchor's q-gram.
2. Neighbouring windows with one anchor form a run; a bucket is sorted by the identifier of the whole
   run, so exact copies are settled at once: all but the first occurrence are removed.
3. First occurrences that still share a bucket are refined by the identifiers of the bytes before
   and after the anchor; every window holds one of the two.
4. What is still shared is refined window by window: its identifier is the pair of the identifiers
   at its start and at half its length, each of which again is such a pair.

Sorting is Spark's, by bucket; a task sees its buckets as a stream and keeps one row of state.
Copies within an input batch are settled before the shuffle, so a string that a third of all
documents hold costs one row for each batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsguard.llm.common import mix64, stored, tidy
from obsguard.llm.shingles import BASE, BYTE, UNBASE, powers

LENGTH, GRAM = 100, 24
SIDE = (LENGTH - GRAM) // 2
#: Texts are hashed in segments of at most this many bytes that overlap by LENGTH - 1; a worker holds some twenty
#: arrays of 64 bits for one.
SEGMENT = 1 << 20
PLACE_BITS = np.uint64(23)

RUNS = "kind int, anchor long, run long, sides long, doc long, start long, off int, n int"
FOUND = "kind int, anchor long, sides long, doc long, start long, off int, n int"
REMOVED, OPEN = 0, 1


class Hashes:
    """Identifiers of byte ranges of one buffer; equal bytes give equal identifiers in any buffer."""

    def __init__(self, raw: np.ndarray) -> None:
        self.total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(BYTE[raw] * powers(BASE, len(raw)), out=self.total[1:])
        self.undo = powers(UNBASE, len(raw) + 1)

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mix64((self.total[start + size] - self.total[start]) * self.undo[start])

    def windows(self, start: np.ndarray, size: int) -> np.ndarray:
        """Identifiers of ``size`` bytes: pairs of half-length identifiers, down to an eighth."""
        if size % 2 or size <= LENGTH // 4:
            return self.of(start, size)
        half = size // 2
        return mix64(self.windows(start, half) * np.uint64(0x9FB21C651E98DF25) + self.windows(start + half, half))


def segments(ids: list[int], texts: list[bytes], budget: int = SEGMENT) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int, int]]]]:
    """Buffers of about ``budget`` bytes with their parts: (document, offset in it, begin, end in the buffer)."""
    pieces, parts, size = [], [], 0
    for doc, text in zip(ids, texts, strict=True):
        for a in range(0, max(1, len(text) - LENGTH + 1), budget - LENGTH + 1):
            piece = text[a : a + budget]
            if size + len(piece) > budget and size:
                yield np.frombuffer(b"".join(pieces), np.uint8), parts
                pieces, parts, size = [], [], 0
            pieces.append(piece)
            parts.append((doc, a, size, size + len(piece)))
            size += len(piece)
    if size:
        yield np.frombuffer(b"".join(pieces), np.uint8), parts


def anchors(h: Hashes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start the place of its least q-gram, the leftmost among equals; and all q-gram identifiers."""
    grams = h.of(np.arange(size - GRAM + 1), GRAM)
    best = (grams >> PLACE_BITS << PLACE_BITS) | np.arange(len(grams), dtype=np.uint64)
    width, reach = LENGTH - GRAM + 1, 1
    while reach * 2 <= width:
        best = np.minimum(best[:-reach], best[reach:])
        reach *= 2
    if width > reach:
        best = np.minimum(best[: len(best) - (width - reach)], best[width - reach :])
    return (best & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64), grams


def runs_of(raw: np.ndarray, parts: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Rows (anchor, run, sides, doc, start, off, n) of all windows of a buffer, as unsigned or signed 64 bits."""
    if len(raw) < LENGTH:
        return np.zeros((0, 7), np.int64)
    h = Hashes(raw)
    at, grams = anchors(h, len(raw))
    part_end = np.array([e for *_, e in parts])
    part_begin = np.array([b for _, _, b, _ in parts])
    place = np.arange(len(at))
    of_part = np.repeat(np.arange(len(parts)), part_end - part_begin)[: len(at)]
    valid = place + LENGTH <= part_end[of_part]
    first = valid & np.concatenate([[True], ~valid[:-1] | (at[1:] != at[:-1]) | (of_part[1:] != of_part[:-1])])
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.zeros((0, 7), np.int64)
    number = np.cumsum(first)[valid] - 1
    n = np.bincount(number, minlength=len(begin))
    anchor, off = at[begin], at[begin] - begin
    run = mix64(h.of(begin, n + LENGTH - 1) + mix64((off * 128 + n).astype(np.uint64)))
    before, after = anchor - SIDE, anchor - SIDE  # windows starting at or before, and at or after this place
    has_left, has_right = begin <= before, begin + n - 1 >= after
    left, right = np.zeros(len(begin), np.uint64), np.zeros(len(begin), np.uint64)
    low = np.uint64(0x7FFFFFFF)
    left[has_left] = (h.of(before[has_left], SIDE + GRAM) & low) | np.uint64(1)
    right[has_right] = (h.of(anchor[has_right], SIDE + GRAM) & low) | np.uint64(1)
    doc = np.array([d for d, *_ in parts])[of_part[begin]]
    start = begin - part_begin[of_part[begin]] + np.array([o for _, o, *_ in parts])[of_part[begin]]
    signed = lambda x: x.view(np.int64)
    return np.stack([signed(grams[anchor]), signed(run), signed((left << np.uint64(31)) | right), doc, start, off, n], axis=1)


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal spans: overlapping or touching spans of a document joined."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    new = np.ones(len(doc), bool)
    group = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    reach = np.maximum.accumulate(stop + group * (int(stop.max()) + 1)) - group * (int(stop.max()) + 1)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return doc[first], start[first], np.maximum.reduceat(stop, first)


def earliest(rows: np.ndarray, key: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, is_first): rows sorted by their ``key`` leading columns, then doc and start, both in the
    columns that follow ``key`` and one more; is_first marks rows with no strictly earlier equal one."""
    order = np.lexsort(tuple(rows[:, c] for c in (4, 3, *range(key - 1, -1, -1))))
    s = rows[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:, :key] != s[:-1, :key]).any(axis=1)
    head = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    return order, (s[:, 3] == s[head, 3]) & (s[:, 4] == s[head, 4])


def record(rows: np.ndarray, names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[:, i]).cast(k) for i, k in enumerate(kinds)], names=names)


LONG, INT = pa.int64(), pa.int32()
RUN_NAMES = ["kind", "anchor", "run", "sides", "doc", "start", "off", "n"]
RUN_KINDS = [INT, LONG, LONG, LONG, LONG, LONG, INT, INT]
FOUND_NAMES = ["kind", "anchor", "sides", "doc", "start", "off", "n"]
FOUND_KINDS = [INT, LONG, LONG, LONG, LONG, INT, INT]


def local_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a batch, copies within it settled: kind 0 has a removed span (n its length), kind 1 an open run."""
    for batch in batches:
        ids = batch.column("doc").to_pylist()
        texts = [(t or "").encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
        found = [runs_of(raw, parts) for raw, parts in segments(ids, texts)]
        rows = np.concatenate(found) if found else np.zeros((0, 7), np.int64)
        if not len(rows):
            continue
        order, first = earliest(rows, 2)
        rows = rows[order]
        gone = rows[~first]
        doc, start, stop = merged(gone[:, 3], gone[:, 4], gone[:, 4] + gone[:, 6] + LENGTH - 1)
        spans = np.zeros((len(doc), 8), np.int64)
        spans[:, 1] = mix64((doc * 1_000_003 + start).astype(np.uint64)).view(np.int64)
        spans[:, 4], spans[:, 5], spans[:, 7] = doc, start, stop - start
        kept = rows[first]
        yield record(np.concatenate([spans, np.hstack([np.ones((len(kept), 1), np.int64), kept])]), RUN_NAMES, RUN_KINDS)


def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted stream of runs by anchor: spans of all but the first occurrence of each run, and the
    first occurrences of anchors that have several runs. State: two rows."""
    carried = np.zeros((0, 8), np.int64)
    told = np.zeros(0, bool)
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in RUN_NAMES], axis=1)
        out = [rows[rows[:, 0] == REMOVED][:, [0, 1, 3, 4, 5, 6, 7]]]
        rows = rows[rows[:, 0] == OPEN]
        if len(rows):
            old = np.concatenate([told, np.zeros(len(rows), bool)])
            rows = np.concatenate([carried, rows])
            new_anchor, new_run = np.ones(len(rows), bool), np.ones(len(rows), bool)
            new_anchor[1:] = rows[1:, 1] != rows[:-1, 1]
            new_run[1:] = new_anchor[1:] | (rows[1:, 2] != rows[:-1, 2])
            head = np.maximum.accumulate(np.where(new_run, np.arange(len(rows)), 0))
            later = ~((rows[:, 4] == rows[head, 4]) & (rows[:, 5] == rows[head, 5]))
            group = np.cumsum(new_anchor) - 1
            several = np.bincount(group, new_run)[group] > 1
            gone = rows[later]
            doc, start, stop = merged(gone[:, 4], gone[:, 5], gone[:, 5] + gone[:, 7] + LENGTH - 1)
            spans = np.zeros((len(doc), 7), np.int64)
            spans[:, 3], spans[:, 4], spans[:, 6] = doc, start, stop - start
            asks = new_run & several & ~old
            out += [spans, rows[asks][:, [0, 1, 3, 4, 5, 6, 7]]]
            # the last anchor may go on: keep its first run's head and its last run's head
            keep = np.unique([np.flatnonzero(new_anchor)[-1], head[-1]])
            carried, told = rows[keep], old[keep] | asks[keep]
        yield record(np.concatenate(out), FOUND_NAMES, FOUND_KINDS)


def open_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, doc, start) for the open windows of each text; copies within a batch settled (a is null)."""
    for batch in batches:
        ids = batch.column("doc").to_pylist()
        texts = [(t or "").encode("utf-8", "replace") for t in batch.column("text").to_pylist()]
        lists = dict(zip(ids, batch.column("open").to_pylist(), strict=True))
        found = []
        for raw, parts in segments(ids, texts):
            if len(raw) < LENGTH:
                continue
            h = Hashes(raw)
            for doc, offset, begin, end in parts:
                places = [np.arange(max(r["first"] - offset, 0), min(r["last"] - offset, end - begin - LENGTH) + 1) for r in lists[doc]]
                at = np.unique(np.concatenate(places)) + begin
                if len(at):
                    a, b = h.windows(at, LENGTH // 2), h.windows(at + LENGTH // 2, LENGTH // 2)
                    found.append(np.stack([a.view(np.int64), b.view(np.int64), np.zeros(len(at), np.int64), np.full(len(at), doc), at - begin + offset], axis=1))
        rows = np.concatenate(found) if found else np.zeros((0, 5), np.int64)
        if len(rows):
            order, first = earliest(rows, 2)
            rows, gone = rows[order], ~first
            doc, start, stop = merged(rows[gone, 3], rows[gone, 4], rows[gone, 4] + LENGTH)
            kept = rows[first]
            kind = np.concatenate([np.zeros(len(doc), np.int64), np.ones(len(kept), np.int64)])
            spread = mix64((doc * 1_000_003 + start).astype(np.uint64)).view(np.int64)
            table = np.stack(
                [kind, np.concatenate([spread, kept[:, 0]]), np.concatenate([stop - start, kept[:, 1]]),
                 np.concatenate([doc, kept[:, 3]]), np.concatenate([start, kept[:, 4]])], axis=1
            )
            yield record(table, ["kind", "a", "b", "doc", "start"], [INT, LONG, LONG, LONG, LONG])


def repeated_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sorted stream of windows: spans (doc, start, n) of all but the first of equal ones."""
    last = np.zeros((0, 5), np.int64)
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("kind", "a", "b", "doc", "start")], axis=1)
        done = rows[rows[:, 0] == REMOVED]
        rows = rows[rows[:, 0] == OPEN]
        doc, start, stop = done[:, 3], done[:, 4], done[:, 4] + done[:, 2]
        if len(rows):
            rows = np.concatenate([last, rows])
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:, 1] != rows[:-1, 1]) | (rows[1:, 2] != rows[:-1, 2])
            head = np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))
            gone = rows[~((rows[:, 3] == rows[head, 3]) & (rows[:, 4] == rows[head, 4]))]
            last = rows[head[-1] : head[-1] + 1]
            doc, start = np.concatenate([doc, gone[:, 3]]), np.concatenate([start, gone[:, 4]])
            stop = np.concatenate([stop, gone[:, 4] + LENGTH])
        doc, start, stop = merged(doc, start, stop)
        yield record(np.stack([doc, start, stop - start], axis=1), ["doc", "start", "n"], [LONG, LONG, LONG])


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            raw, at, kept, runs = (text or "").encode("utf-8", "replace"), 0, [], 0
            for a, b in sorted((s["start"], s["start"] + s["n"]) for s in spans or ()):
                if a > at or not runs:
                    runs += 1
                if b > at:
                    kept.append(raw[at : max(a, at)])
                    at = b
            kept.append(raw[at:])
            rest = b"".join(kept)
            out.append((len(raw), len(raw) - len(rest), runs, hashlib.sha256(rest).hexdigest()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, (LONG, LONG, LONG, pa.string()), strict=True))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_spans(documents: DataFrame) -> DataFrame:
    """(doc, start, n): byte spans of ``documents`` (doc, text) whose union is all that occurs earlier."""
    sort = ("kind", "anchor", "run", "doc", "start")
    runs = documents.mapInArrow(tidy(local_runs), RUNS).repartition("anchor").sortWithinPartitions(*sort)
    found = stored(runs.mapInArrow(settled, FOUND), "settled")
    spans = found.where(F.col("kind") == REMOVED).select("doc", "start", F.col("n").cast("long").alias("n"))

    left = F.shiftright("sides", 31)
    right = F.col("sides").bitwiseAND(F.lit((1 << 31) - 1))
    anchor_at = F.col("start") + F.col("off")
    last = F.col("start") + F.col("n") - 1
    sides = found.where(F.col("kind") == OPEN).select(
        "anchor", "doc",
        F.explode(F.array(
            F.struct(F.lit(0).alias("side"), left.alias("id"), F.col("start").alias("first"), F.least(last, anchor_at - SIDE).alias("last")),
            F.struct(F.lit(1).alias("side"), right.alias("id"), F.greatest(F.col("start"), anchor_at - SIDE).alias("first"), last.alias("last")),
        )).alias("s"),
    ).where("s.id <> 0").select("anchor", "doc", "s.*")
    shared = sides.groupBy("anchor", "side", "id").agg(F.count("*").alias("k")).where("k > 1").drop("k")
    still = sides.join(shared, ["anchor", "side", "id"]).groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("open"))
    still = stored(still, "open-windows")
    windows = documents.join(still, "doc").select("doc", "text", "open").mapInArrow(tidy(open_windows), "kind int, a long, b long, doc long, start long")
    windows = windows.repartition("a").sortWithinPartitions("kind", "a", "b", "doc", "start")
    return spans.unionByName(windows.mapInArrow(repeated_windows, "doc long, start long, n long"))


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``documents``.

    A byte goes when a string of 100 bytes that covers it also starts earlier: in a document with a
    smaller id, or earlier in the same one. A null text is empty; texts shorter than 100 bytes stay
    whole. Rows with a null doc_id take no part and are returned whole; rows that share a doc_id count
    as one place in the order, so they do not remove each other, and lose the same bytes if equal.
    Other columns are not read; an empty table gives no rows.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc"), "text")
    named = rows.where("doc is not null")
    lists = repeated_spans(named).groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    # the texts meet their spans in the same exchange by id in which they met their open windows
    joined = named.join(lists, "doc", "left").select(F.col("doc").alias("doc_id"), "text", "spans")
    nameless = rows.where("doc is null").select(F.col("doc").alias("doc_id"), "text", F.lit(None).cast(joined.schema["spans"].dataType).alias("spans"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return joined.mapInArrow(digests, schema).unionByName(nameless.mapInArrow(digests, schema))
