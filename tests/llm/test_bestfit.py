"""Best-fit packing: ids against the tokenizer, contract of the pieces, dominance against exhaustive search."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from obsguard.llm import bestfit

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = "doc_id long, text string"


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, bestfit.END_ID]


@cache
def fewest(items, sequence):
    """Exhaustive least number of sequences for a sorted tuple of lengths."""
    if not items:
        return 0
    head, rest = items[0], items[1:]
    best = len(items)

    def choose(at, room, taken):
        nonlocal best
        left = tuple(x for k, x in enumerate(rest) if k not in taken)
        best = min(best, 1 + fewest(left, sequence))
        for k in range(at, len(rest)):
            if rest[k] <= room and (k == at or rest[k] != rest[k - 1]):
                choose(k + 1, room - rest[k], taken | {k})

    choose(0, sequence - head, frozenset())
    return best


def test_reduction_keeps_the_optimum():
    pick = random.Random(3)
    fixed_some = fixed_triples = 0
    for _ in range(400):
        sequence = pick.choice([10, 17, 24])
        low = pick.choice([1, 2, 4])
        items = tuple(sorted((pick.randint(low, sequence) for _ in range(pick.randint(1, 9))), reverse=True))
        left = bestfit.Histogram(Counter(items))
        fixed = bestfit.reduce_instance(left, sequence)
        rest = tuple(sorted(left.count.elements(), reverse=True))
        assert all(sum(length * k for length, k in p) <= sequence for p, _ in fixed)
        assert sum(t for _, t in fixed) + fewest(rest, sequence) == fewest(items, sequence)
        assert bestfit.least_sequences(Counter(items), sequence) <= fewest(items, sequence)
        fixed_some += bool(fixed)
        fixed_triples += any(sum(k for _, k in p) == 3 for p, _ in fixed)
    assert fixed_some > 200 and fixed_triples > 5


def test_best_fit_equals_piece_by_piece():
    pick = random.Random(4)
    for _ in range(200):
        items = Counter(pick.choices(range(1, 21), k=60))
        rooms = []
        for length in sorted(items.elements(), reverse=True):
            fitting = [r for r in rooms if r >= length]
            room = min(fitting, default=20)
            if fitting:
                rooms.remove(room)
            rooms.append(room - length)
        patterns = bestfit.best_fit(bestfit.Histogram(items), 20)
        got = Counter({20 - sum(length * k for length, k in p): 0 for p, _ in patterns})
        for p, times in patterns:
            got[20 - sum(length * k for length, k in p)] += times
        assert got == Counter(rooms)


def test_patterns_hold_all_pieces_near_the_bound():
    pick = np.random.default_rng(1)
    for counts in (
        Counter(pick.integers(1, 1025, 20_000).tolist()), Counter((pick.pareto(1.2, 50_000) * 60 + 1).clip(1, 1024).astype(int).tolist()),
        Counter({512: 7_000_000, 5: 9}), Counter({1024: 5}), Counter({1: 1}), Counter(),
    ):
        plan = bestfit.plan_patterns(counts)
        used = Counter()
        for items, times in plan:
            assert sum(length * k for length, k in items) <= 1024 and times > 0
            for length, k in items:
                used[length] += k * times
        assert used == +counts
        assert sum(t for _, t in plan) <= bestfit.least_sequences(counts) * 1.01 + 1


def test_short_pieces_do_not_hide_dominating_sets():
    plan = bestfit.plan_patterns(Counter({341: 10_000_000, 342: 10_000_000, 5: 3}))
    assert sum(t for _, t in plan) == 7_500_000  # every pair of 341 with a 342, what is left of these in pairs


def test_ids_equal_the_tokenizer():
    pick = random.Random(8)
    alphabet = ["a", "the", "İ.", "é", "ß", " ", "  ", "\n", "\n\n", "\t", " \n", " ", " ", "\x1c", "\x85", "12", "'s", "'", "...", "<|endoftext|>", "中文", "👩‍👩‍👧", "​", "ǅ", "̈", "٣", "\r\n", "x" * 70]
    texts = ["".join(pick.choices(alphabet, k=pick.randint(0, 14))) for _ in range(6000)] + ["", " ", "  a", "a  ", "a \n b"]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    got = bestfit.ByteIds(VOCABULARY, most=2000).encode(texts[:3000]) + bestfit.ByteIds(VOCABULARY).encode(texts[3000:])
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == ids_of(tokenizer, text), repr(text)


def check(rows, docs, tokenizer):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    wanted = Counter()
    for doc_id, text in docs:
        ids = ids_of(tokenizer, text)
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            wanted[doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert wanted == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    return len(by_sequence)


def test_packing_round_trip_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = bestfit.pack_best_fit(docs, VOCABULARY).collect()
    used = check(rows, [tuple(r) for r in docs.collect()], Tokenizer.from_file(VOCABULARY))
    counts = Counter(r["length"] for r in rows)
    assert used <= bestfit.least_sequences(counts) * 1.005 + 1


def test_awkward_tables(spark):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = [(1, None), (1, ""), (None, "a b"), (2, "same text"), (2, "same text"), (3, "word " * 5000), (4, "x" * 300_000), (5, " ")]
    wide = spark.createDataFrame([(*r, 1, 2, "s") for r in rows], COLUMNS + ", length int, sequence_id int, piece string")
    check(bestfit.pack_best_fit(wide, VOCABULARY).collect(), rows, tokenizer)
    empty = bestfit.pack_best_fit(spark.createDataFrame([], COLUMNS), VOCABULARY)
    assert empty.collect() == []
    assert empty.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
