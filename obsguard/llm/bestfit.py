"""Best-fit packing after Martello and Toth's dominance reduction.

Documents longer than a sequence are cut into full pieces, a shorter one first; all others stay whole. What
is packed is the histogram of piece lengths, which the sequence length bounds:

1. **Reduction.** For a piece j, longest first, a set of at most three pieces with j *dominates* if some
   best packing is known to use it: any other set with j could be exchanged for it without a sequence
   more. Such sets are fixed for good, for as many copies as the histogram holds, and the smaller
   instance is looked at again until nothing dominates.
2. **Best fit.** The rest, longest first, goes to the fullest sequence that still takes it. Sequences of
   equal content are one entry with a count, so the work is bounded by lengths and not by documents.

Short pieces keep sets from dominating though they hardly matter, so the reduction is also tried on the pieces
from a few lengths on, whose least number of sequences is one that no packing of all pieces can beat; the shorter ones
then join the rest. The plan with the fewest sequences is taken.

The result is a list of patterns with counts. Pieces get a rank within their length from counts per
(length, bucket), so a length that a third of all documents share is spread; rank and pattern give the place.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsguard.llm.common import kept_in_worker, stored, text_chunks

SEQUENCE = 1024
END_ID = 2
#: Ranks are counted in buckets of about so many pieces of a length.
BUCKET_ROWS = 50_000
#: Least lengths, as parts of a sequence, of the instances that are reduced.
LEAST_PARTS = (0, 1 / 64, 1 / 16, 1 / 8, 1 / 6, 1 / 5, 1 / 4, 1 / 3)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: (length, how often) in the order of their places, and the number of sequences so filled.
Pattern = tuple[tuple[tuple[int, int], ...], int]


#: Letters and digits for certain, and ASCII symbols but the apostrophe, which may begin a contraction.
KNOWN, SYMBOL = "A-Za-z0-9À-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
#: Pieces of a text that the byte vocabulary never merges across. Runs of known letters and digits, and runs of
#: symbols, end where white space or the other kind begins; any other run goes on to the next white space. Spaces are
#: dealt as the vocabulary does: the last one before a run belongs to it.
PIECE = rf" ?[{KNOWN}]+(?=[\s{SYMBOL}]|\Z)| ?[{SYMBOL}]+(?=[\s{KNOWN}]|\Z)| ?\S+|\s+(?!\S)|\s+"


class ByteIds:
    """Token ids of texts by pieces (PIECE); ids of pieces seen before are kept as little-endian bytes.

    New words are tokenised many at a time, set one after the other as they may stand in a text. The store is emptied when
    it holds more than ``most`` letters. Texts with a special token, or with separators that Python takes for
    white space and the vocabulary does not, are tokenised whole.
    """

    def __init__(self, path: str, most: int = 16_000_000, longest: int = 64) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.most, self.longest = most, longest
        self.pieces = re.compile(PIECE).findall
        self.word = re.compile(f" ?[{KNOWN}]+").fullmatch
        self.known: dict[str, bytes] = {}
        self.letters = 0
        self.end = np.array([END_ID], "<u4").tobytes()

    def _alone(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _in_a_row(self, words: list[str], between: str) -> list[bytes]:
        """Ids of words that may follow each other with ``between``, told apart by where their tokens start."""
        out: list[bytes] = []
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            found = self.tokenizer.encode(between.join(some), add_special_tokens=False)
            size = np.fromiter(map(len, some), np.int64, len(some))
            start = np.cumsum(size + len(between)) - size - len(between)
            place = np.fromiter(chain.from_iterable(found.offsets), np.int64, 2 * len(found.ids))[::2]
            ids = np.array(found.ids, "<u4")
            word = np.searchsorted(start, place, side="right") - 1
            inside = place < start[word] + size[word]
            ids, word = ids[inside], word[inside]
            ends = (np.searchsorted(word, np.arange(len(some) + 1)) * 4).tolist()
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        return out

    def _learn(self, new: set[str]) -> dict[str, bytes]:
        words = [p for p in new if self.word(p)]
        other = [p for p in new if not self.word(p)]
        spaced, plain = [p for p in words if p[0] == " "], [p for p in words if p[0] != " "]
        ids = self._in_a_row(spaced, "") + self._in_a_row(plain, "\n") + self._alone(other)
        return dict(zip(spaced + plain + other, ids, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text with END_ID appended, as little-endian unsigned 32-bit bytes."""
        if self.letters > self.most:
            self.known, self.letters = {}, 0
        whole = {i for i, t in enumerate(texts) if any(c in t for c in ("\x1c", "\x1d", "\x1e", "\x1f", *self.special))}
        parts = [[] if i in whole else self.pieces(t) for i, t in enumerate(texts)]
        new = set().union(*parts) - self.known.keys()
        fresh = self._learn(new) if new else {}
        short = {p: ids for p, ids in fresh.items() if len(p) <= self.longest}
        self.known.update(short)
        self.letters += sum(map(len, short))
        get = self.known.__getitem__
        if len(short) < len(fresh):
            get = lambda p: self.known[p] if p in self.known else fresh[p]
        out = [b"".join(map(get, p)) + self.end for p in parts]
        for i in whole:
            out[i] = self._alone([texts[i]])[0] + self.end
        return out


def byte_ids(path: str) -> ByteIds:
    return kept_in_worker(("bytes", path), lambda: ByteIds(path))


def cut_documents(documents: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """PIECES of every document: one, or full ones after what is over. A null text is empty: one id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = byte_ids(tokenizer)
        for batch in batches:
            for part in text_chunks(batch, 2 << 20):
                doc, number, start, length, crc = [], [], [], [], []
                texts = [t or "" for t in part.column("text").to_pylist()]
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), known.encode(texts), strict=True):
                    total = len(ids) // 4
                    cuts = [0, *range(total % sequence or sequence, total + 1, sequence)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        doc.append(doc_id)
                        number.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(ids[4 * a : 4 * b]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


class Histogram:
    """Counts of lengths, ascending; the queries of the reduction take one piece of a given length as set aside."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.count = Counter({k: v for k, v in counts.items() if v > 0})
        self.lengths = sorted(self.count)

    def take(self, items: Counter, times: int) -> None:
        for length, k in items.items():
            self.count[length] -= k * times
            if not self.count[length]:
                del self.count[length]
                self.lengths.remove(length)

    def smallest(self, aside: int, over: int = 0, most: int = 3) -> list[int]:
        """The up to ``most`` smallest lengths greater than ``over``, repeated by their counts."""
        out: list[int] = []
        for length in self.lengths[bisect_left(self.lengths, over + 1) :]:
            out += [length] * min(self.count[length] - (length == aside), most - len(out))
            if len(out) == most:
                break
        return out

    def largest(self, aside: int, room: int) -> int | None:
        """The greatest length of at most ``room``."""
        for k in range(bisect_left(self.lengths, room + 1) - 1, -1, -1):
            if self.count[self.lengths[k]] > (self.lengths[k] == aside):
                return self.lengths[k]
        return None

    def best_pair(self, aside: int, room: int) -> tuple[int, int] | None:
        """Two lengths a >= b of the greatest sum within ``room``; the greater a among equal sums."""
        best, low = None, 0
        for high in range(bisect_left(self.lengths, room + 1) - 1, -1, -1):
            a = self.lengths[high]
            if self.count[a] <= (a == aside):
                continue
            while low < len(self.lengths) and self.lengths[low] + a <= room:
                low += 1
            for k in range(min(low - 1, high), -1, -1):
                b = self.lengths[k]
                if self.count[b] - (b == aside) - (b == a) > 0:
                    if best is None or a + b > sum(best):
                        best = (a, b)
                    break
        return best


def dominating(left: Histogram, j: int, sequence: int) -> tuple[int, ...] | None:
    """Lengths that with a piece ``j`` make a set which dominates all sets with j, if such a set is found.

    * Nothing fits with j: j alone.
    * The greatest other length fills the sequence, or two others never fit with j: that pair, since what
      else could be with j takes no more room than the one piece and can be put where that piece was.
    * Three others never fit: with the two others of the greatest sum, if the greatest single one takes no
      less room than they do, the pair with it. Else, if one of the two is that greatest one, the
      triple, unless two pieces that are both longer than the second could be with j.
    """
    room = sequence - j
    small = left.smallest(j)
    greatest = left.largest(j, room)
    if greatest is None:
        return ()
    if greatest == room or len(small) < 2 or small[0] + small[1] > room:
        return (greatest,)
    if len(small) == 3 and sum(small) <= room:
        return None
    a, b = left.best_pair(j, room)
    if greatest >= a + b:
        return (greatest,)
    if greatest == a:
        longer = left.smallest(j, b, 2)
        if len(longer) < 2 or sum(longer) > room:
            return (a, b)
    return None


def reduce_instance(left: Histogram, sequence: int) -> list[Pattern]:
    """Patterns of the sets that dominate; their pieces leave ``left``.

    A set that dominates does so while copies of all its pieces are left, since less choice cannot undo
    it, so it is fixed for all of them at once and a length runs out each time.
    """
    fixed: list[Pattern] = []
    before = None
    while before != len(fixed):
        before = len(fixed)
        for j in list(reversed(left.lengths)):
            while left.count[j] and (others := dominating(left, j, sequence)) is not None:
                items = Counter((j, *others))
                times = min(left.count[length] // k for length, k in items.items())
                fixed.append((tuple(sorted(items.items(), reverse=True)), times))
                left.take(items, times)
    return fixed


def best_fit(left: Histogram, sequence: int, begun: list[Pattern] | None = None) -> list[Pattern]:
    """``begun`` and new patterns after best fit decreasing over all pieces of ``left``, sequences of equal content at once."""
    open_by_room: dict[int, list[Pattern]] = {}
    rooms: list[int] = []

    def put(items: tuple[tuple[int, int], ...], times: int, room: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append((items, times))

    for items, times in begun or []:
        put(items, times, sequence - sum(length * k for length, k in items))
    for length in reversed(left.lengths):
        many = left.count[length]
        while many:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                items, times = open_by_room[room].pop()
                if not open_by_room[room]:
                    del open_by_room[room]
                    rooms.pop(at)
            else:
                room, items, times = sequence, (), many
            each = room // length  # the sequence just added to stays the fullest one that takes the next piece
            whole = min(times, many // each)
            if whole:
                put((*items, (length, each)), whole, room - each * length)
                many -= whole * each
            rest = min(1, times - whole) if many else 0
            if rest:
                put((*items, (length, many)), 1, room - many * length)
                many = 0
            if items and times > whole + rest:
                put(items, times - whole - rest, room)
    return [pattern for same in open_by_room.values() for pattern in same]


def plan_patterns(counts: dict[int, int], sequence: int = SEQUENCE) -> list[Pattern]:
    """Patterns that take exactly ``counts`` pieces of each length."""
    least, best = least_sequences(counts, sequence), None
    for part in LEAST_PARTS:
        large = Histogram({k: v for k, v in counts.items() if k >= part * sequence})
        fixed = reduce_instance(large, sequence)
        rest = Histogram(large.count + Counter({k: v for k, v in counts.items() if k < part * sequence}))
        plan = best_fit(rest, sequence, fixed)
        if best is None or sum(t for _, t in plan) < sum(t for _, t in best):
            best = plan
        if sum(t for _, t in best) == least:
            break
    return best


def least_sequences(counts: dict[int, int], sequence: int = SEQUENCE) -> int:
    """Martello and Toth's second bound: no packing takes fewer sequences."""
    lengths = np.array(sorted(k for k, v in counts.items() if v > 0), np.int64)
    if not len(lengths):
        return 0
    many = np.array([counts[int(k)] for k in lengths], np.int64)
    best = -(-int((lengths * many).sum()) // sequence)
    for cut in [k for k in lengths if 2 * k <= sequence]:
        alone = int(many[lengths > sequence - cut].sum())
        halves = (lengths <= sequence - cut) & (2 * lengths > sequence)
        small = (lengths >= cut) & (2 * lengths <= sequence)
        room = int(many[halves].sum()) * sequence - int((lengths * many)[halves].sum())
        more = max(0, -(-(int((lengths * many)[small].sum()) - room) // sequence))
        best = max(best, alone + int(many[halves].sum()) + more)
    return best


def slot_runs(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """By length, for every run of ranks: first rank, first sequence, number of sequences, offset there."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: Counter = Counter()
    base = 0
    for items, times in patterns:
        offset = 0
        for length, k in items:
            runs.setdefault(length, []).append((taken[length], base, times, offset))
            taken[length] += k * times
            offset += k * length
        base += times
    return {length: np.array(rows, np.int64).T for length, rows in runs.items()}


def place_pieces(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Add sequence_id and offset to stored ``pieces``; equal rows may swap places."""
    histogram = {int(r["length"]): int(r["k"]) for r in pieces.groupBy("length").agg(F.count("*").alias("k")).collect()}
    runs = slot_runs(plan_patterns(histogram, sequence))
    spread = max(64, max(histogram.values(), default=0) // BUCKET_ROWS)

    keyed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(spread)).cast("int"))
    sizes = keyed.groupBy("length", "_bucket").agg(F.count("*").alias("_k"))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("length", "_bucket", F.coalesce(F.sum("_k").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = keyed.withColumn("_rank", F.row_number().over(inside)).join(before, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before") - 1).drop("_before", "_bucket")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            number, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length):
                at = np.flatnonzero(length == k)
                first, base, times, begin = runs[int(k)]
                run = np.searchsorted(first, rank[at], side="right") - 1
                local = rank[at] - first[run]
                number[at], offset[at] = base[run] + local % times[run], begin[run] + local // times[run] * k
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(number), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(deal, PIECES + ", sequence_id long, offset long")


def pack_best_fit(documents: DataFrame, tokenizer: str, sequence: int = SEQUENCE) -> DataFrame:
    """Pack all ``documents`` (doc_id, text; other columns are not read) into few sequences of ``sequence`` tokens.

    Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Every row is packed, repeated
    rows and rows with a null id each on their own; a null text is an empty one, which is its end id alone. An
    empty table gives no rows.
    """
    return place_pieces(stored(cut_documents(documents, tokenizer, sequence), "whole-pieces"), sequence)
