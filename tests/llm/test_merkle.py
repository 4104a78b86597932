"""The manifest against trees built leaf by leaf."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

from obsguard.llm import merkle

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, text, lang, source, n_chars):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return digest(*parts)


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + 3]) for i in range(0, len(below), 3)])
    return levels


def way_of(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 3 * 3
        run = level[first : first + 3]
        out.append((run[: i - first], run[i - first + 1 :]))
        i //= 3
    return out


def plain(rows):
    """[(doc_id, leaf, subroot, root, proof, folded, verified)] of (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append((row[0] is not None, row[0] or 0, leaf_of(*row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for i, (_, _, own, row) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            way = way_of(trees[s], i) + way_of(top, place)
            doc_id, text = row[:2]
            at = own
            if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                at = leaf_of(doc_id, text.replace("\n", ""), *row[2:])
            for before, after in way:
                at = digest(*before, at, *after)
            proof = digest(*[d for pair in way for side in pair for d in side])
            out.append((doc_id, own, trees[s][-1][0], top[-1][0], proof, at, at == top[-1][0]))
    return out


def found(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)


def check(spark, rows):
    got = found(merkle.manifest_proofs(spark.createDataFrame(rows, COLUMNS)))
    assert got == sorted(plain(rows), key=repr)
    return got


def test_two_bands_many_groups_nulls_and_repeats(spark):
    pick = random.Random(5)
    rows = [(i * 7, f"line {i}\nmore", "en", "hot", i) for i in range(2200)]  # 3 ** 7 = 2187 leaves are not enough
    rows += [(i, f"t{i}", "de", f"src{i % 90}", None) for i in range(400)]
    rows += [(None, "x\ny", None, None, 3), (None, None, None, None, None), (4, None, "en", None, 0), (4, "", "en", "", 0)]
    rows += [(9, "same\n", "en", "twice", 5)] * 5 + [(9, "other", "en", "twice", 5), (-3, "é\nü", "fr", "zé", 4)]
    pick.shuffle(rows)
    got = check(spark, rows)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_one_row_and_full_powers(spark):
    check(spark, [(2, "a\nb", "en", "s", 3)])
    check(spark, [(i, "a\nb" * i, "en", "s", 3) for i in range(27)])
    check(spark, [(i, None, None, None, None) for i in range(4)])


def test_empty_table_extra_columns_and_long_text(spark):
    empty = merkle.manifest_proofs(spark.createDataFrame([], COLUMNS))
    assert empty.collect() == [] and empty.columns[:4] == ["doc_id", "leaf", "subroot", "root"]
    rows = [(1, "word \n" * 400_000, "en", "s", 7), (2, "b", "en", "s", 1)]
    extra = "tree string, lo long, n long, digest string, bucket string, changed string"
    wide = spark.createDataFrame([(*r, "t", 5, 6, "d", "b", "c") for r in rows], f"{COLUMNS}, {extra}")
    assert found(merkle.manifest_proofs(wide)) == sorted(plain(rows), key=repr)


def test_siblings_fold_to_the_root(spark):
    rows = [(i, f"t{i}", "en", "ab"[i % 2], i) for i in range(11)]
    for r in merkle.manifest_proofs(spark.createDataFrame(rows, COLUMNS), with_siblings=True).collect():
        assert digest(*r["siblings"]) == r["proof_sha256"] and r["leaf"] not in r["siblings"]
