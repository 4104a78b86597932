"""Spelling variants against all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from obsguard.llm import variants

COLUMNS = "doc_id long, text string"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_counts(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def plain(rows):
    n = plain_counts(rows)
    links = {w: [] for w in n}
    words = sorted(n)
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) < 2 and near(a, b):
                links[a].append(b)
                links[b].append(a)
    form = {}
    for w in words:
        best = min(links[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None))
    return out


def check(spark, rows):
    df = variants.spelling_variants(spark.createDataFrame(rows, COLUMNS))
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = plain(rows)
    assert sorted(tuple(r) for r in df.collect()) == want
    return want


def made(pick, letters, size):
    return "".join(pick.choices(letters, k=size))


def test_random_words_of_few_letters(spark):
    pick = random.Random(2)
    words = [made(pick, "abé", pick.randint(7, 9)) for _ in range(500)]
    weight = [10 ** pick.choice([0, 0, 1, 2]) for _ in words]
    rows = [(i, " ".join(pick.choices(words, weight, k=60))) for i in range(400)]
    got = check(spark, rows)
    assert sum(r[1] is not None for r in got) > 20


def test_awkward_texts(spark):
    long = "Straße" * 600
    rows = [
        (1, None), (2, ""), (None, "Elephant ELEPHANT elephantx"), (3, "elephant éléphant Éléphant ÉLÉPHANT"), (3, "elephant éléphant Éléphant ÉLÉPHANT"),
        (4, f"{long} {long} {long}x {long}x x{long} x{long}"), (5, "×÷×÷×÷× ×÷×÷×÷× ×÷×÷×÷ö ×÷×÷×÷ö a1234567 1234567"), (6, "elephants " * 50_000),
        (7, "elephantz " * 100 + "elephanzz " * 5),
    ]
    rows += [(k, "elephants elephant") for k in range(100, 160)]
    forms = {r[0]: r[1:3] for r in check(spark, rows)}
    assert forms["elephanzz"] == ("elephantz", "elephants")
    assert variants.spelling_variants(spark.createDataFrame([], COLUMNS)).collect() == []
    wide = spark.createDataFrame([(1, "longword longword", "w", 2, "k")], COLUMNS + ", word string, n int, key string")
    assert [tuple(r) for r in variants.spelling_variants(wide).collect()] == plain([(1, "longword longword")])


@pytest.mark.parametrize("parts", variants.PARTS)
def test_every_number_of_sets_finds_the_same_pairs(spark, parts):
    pick = random.Random(parts)
    words = sorted({made(pick, "abcdefghé", 7) for _ in range(60)} | {made(pick, "ab", pick.randint(7, 10)) for _ in range(150)} | {"a" * 300, "a" * 301, "a" * 300 + "b"})
    counts = {w: pick.randint(2, 50) for w in words}
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    got = {r["word"]: (r["near"], r["best_n"], r["best_word"]) for r in variants.near_words(df, parts).collect()}
    for w in words:
        links = [x for x in words if x != w and near(*sorted((w, x), key=len))]
        if links:
            best = min(links, key=lambda x: (-counts[x], x))
            assert got[w] == (len(links), counts[best], best)
        else:
            assert w not in got


def test_tiles_of_a_block_meet_once(spark):
    words = [f"{i:07d}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(0, 3000)]
    rows = [(b"k", True, w, 2 + i) for i, w in enumerate(words)] + [(b"k", False, w + "z", 2) for w in words[:50]]
    df = spark.createDataFrame(rows, "key binary, home boolean, word string, n long")
    large = spark.createDataFrame([(b"k", 4, 3)], "key binary, tiles long, shifts long")
    met = variants.tiled(df, large)
    meetings = Counter()
    for group in met.groupBy("tile", "shift").agg({"word": "collect_list", "home": "collect_list"}).collect():
        seen = list(zip(group["collect_list(home)"], group["collect_list(word)"], strict=True))
        homes = [w for h, w in seen if h]
        others = [w for h, w in seen if not h]
        sample = [w for w in homes if w in words[:40]]
        for a in sample:
            for b in others:
                if b in words[:40] or b.endswith("z"):
                    meetings[frozenset((a, b))] += 1
            if group["shift"] == 0:
                for b in sample:
                    if a < b:
                        meetings[frozenset((a, b))] += 1
    assert set(meetings.values()) == {1}
    assert len(meetings) == 40 * 39 // 2 + 40 * 50
