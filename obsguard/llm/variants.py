"""Spelling variants by blocked Gram matrices.

Two words one edit apart have letter-count vectors at a squared distance of at most 2: 1 for an inserted
or deleted letter, 2 for a replaced one. Words lie in blocks of one length, which are divided further
by the counts of ``parts`` sets of letters: one edit moves a word to its own block, to one with a letter
more in one set (the adjacent length), or to one with a letter more in one set and less in another.
NumPy products of the count matrices of a block and of its visitors give all squared distances; pairs at
2 or less are kept and their edits verified.

A block is cut into tiles of a fixed number of words, and what visits it likewise, so no task holds more
than two tiles whatever the words are. The number of sets follows the measured block sizes, which keeps the products
of a word about constant while the vocabulary grows; every choice finds the same pairs.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsguard.llm.common import stored

#: Letters of a run: A-Z, a-z, U+00C0 to U+00FF. Lower-casing leaves all but A-Z as they are.
LETTERS = string.ascii_lowercase + "".join(map(chr, range(0xC0, 0x100)))
LEAST_LENGTH, LEAST_COUNT = 7, 2
ALTERED_EVERY = 31
#: A form is at least so many times as frequent as its variant.
FORM_RATIO = 10
#: Home words and visitors of one task, about, at most.
TILE, VISITORS = 8192, 65_536
#: Numbers of letter sets to choose from: the first whose mean block, as a word sees it, holds at most so many words.
PARTS, MEAN_BLOCK = (1, 2, 4, 6, 8, 10, 12), 4000
#: Distances a task is to work out, about; rows of block sizes that may be broadcast (some 40 bytes each).
TASK_WORK, BROADCAST_BLOCKS = 4_000_000_000, 100_000
#: Letters a batch of pairs may hold while edits are verified.
VERIFY_LETTERS = 1 << 22

#: Place of a Latin-1 code among LETTERS.
PLACE = np.zeros(256, np.int64)
PLACE[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))

NEAR = "word string, near long, best_n long, best_word string"


def folded_case(run: Column) -> Column:
    plain = F.octet_length(run) == F.char_length(run)
    return F.when(plain, F.lower(run)).otherwise(F.translate(run, string.ascii_uppercase, string.ascii_lowercase))


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n): the words of all texts with LEAST_LENGTH letters and LEAST_COUNT occurrences or more.

    Where ALTERED_EVERY divides the crc32 of id and run, the run loses the letter that it names. Runs that are too short
    are never unpacked, since a run does not become longer. A null id alters nothing.
    """
    run_pattern = f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}"
    runs = documents.select(
        F.col("doc_id").cast("string").alias("_doc"), F.explode(F.regexp_extract_all(F.col("text"), F.lit(run_pattern), F.lit(0))).alias("_run")
    ).withColumn("_run", folded_case(F.col("_run")))
    named = runs.withColumn("_h", F.crc32(F.concat("_doc", F.lit(":"), "_run").cast("binary")))
    at = (F.col("_h") % F.char_length("_run")).cast("int")
    shorter = F.concat(F.substr("_run", F.lit(1), at), F.substr("_run", at + 2))
    word = F.when(F.col("_h") % ALTERED_EVERY == 0, shorter).otherwise(F.col("_run"))
    words = named.select(word.alias("word")).where(F.char_length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letter_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Latin-1 codes of all words, one after the other, and the words' lengths."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), np.fromiter(map(len, words), np.int64, len(words))


def letter_counts(words: list[str]) -> np.ndarray:
    """The count matrix of ``words``, in a float type that holds all products exactly."""
    codes, size = letter_codes(words)
    width = len(LETTERS)
    row = np.repeat(np.arange(len(words)), size)
    counts = np.bincount(row * width + PLACE[codes], minlength=len(words) * width).reshape(len(words), width)
    return counts.astype(np.float32 if size.max(initial=0) < 2048 else np.float64)


def set_counts(words: list[str], parts: int) -> np.ndarray:
    """How many letters of each set a word has; letters go to the sets in turn."""
    codes, size = letter_codes(words)
    row = np.repeat(np.arange(len(words)), size)
    return np.bincount(row * parts + PLACE[codes] % parts, minlength=len(words) * parts).reshape(len(words), parts)


def packed(counts: np.ndarray) -> pa.Array:
    """A block's name: its counts, a byte each, or after a byte 255 as 32-bit numbers where one does not fit."""
    small = (counts < 255).all(axis=1)
    if small.all():
        raw = np.ascontiguousarray(counts, np.uint8)
        return pa.FixedSizeBinaryArray.from_buffers(pa.binary(raw.shape[1]), len(raw), [None, pa.py_buffer(raw)]).cast(pa.binary())
    names = [c.astype(np.uint8).tobytes() if s else b"\xff" + c.astype("<u4").tobytes() for c, s in zip(counts, small, strict=True)]
    return pa.array(names, pa.binary())


def unpacked(names: list[bytes], parts: int) -> np.ndarray:
    rows = [np.frombuffer(x, np.uint8) if len(x) == parts else np.frombuffer(x[1:], "<u4") for x in names]
    return np.array(rows, np.int64).reshape(len(names), parts)


def neighbours(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, counts) of the blocks that rows of ``counts`` visit: a letter more in one set, or one moved between two.

    Of two blocks with a letter moved between them one visits the other, so a pair of words meets once.
    """
    everyone = np.arange(len(counts))
    for i in range(counts.shape[1]):
        more = counts.copy()
        more[:, i] += 1
        yield everyone, more
    for i, j in combinations(range(counts.shape[1]), 2):
        able = np.flatnonzero(counts[:, j])
        moved = counts[able]
        moved[:, i] += 1
        moved[:, j] -= 1
        yield able, moved


def block_counts(words: DataFrame) -> DataFrame:
    """(parts, key, homes): the words of every block under each of PARTS."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column("word").to_pylist()
            for parts in PARTS:
                name = packed(set_counts(given, parts))
                yield pa.RecordBatch.from_arrays([pa.array([parts] * len(given), pa.int32()), name], names=["parts", "key"])

    rows = words.select("word").mapInArrow(keys, "parts int, key binary")
    return rows.groupBy("parts", "key").agg(F.count("*").alias("homes"))


def choose_parts(blocks: DataFrame) -> int:
    """The first of PARTS whose blocks are small enough; one row for each reaches the driver."""
    seen = blocks.groupBy("parts").agg((F.sum(F.col("homes") * F.col("homes")) / F.sum("homes")).alias("mean")).collect()
    return min((r["parts"] for r in seen if r["mean"] <= MEAN_BLOCK), default=PARTS[-1])


def tile_counts(blocks: DataFrame, parts: int) -> DataFrame:
    """(key, tiles, shifts, work) of every block of ``blocks`` (key, homes), from what visits it."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            homes = batch.column("homes")
            for at, counts in neighbours(unpacked(batch.column("key").to_pylist(), parts)):
                yield pa.RecordBatch.from_arrays([packed(counts), homes.take(pa.array(at))], names=["key", "visits"])

    visits = blocks.mapInArrow(visit, "key binary, visits long").groupBy("key").agg(F.sum("visits").alias("visits"))
    tiles = F.ceil(F.col("homes") / TILE)
    coming = F.coalesce("visits", F.lit(0)) + F.when(tiles > 1, F.col("homes")).otherwise(0)
    return blocks.join(visits, "key", "left").select(
        "key", tiles.alias("tiles"), F.greatest(F.ceil(coming / VISITORS), F.lit(1)).alias("shifts"),
        (F.col("homes").cast("double") * (F.col("homes") + coming)).alias("work"),
    )


def routed(words: DataFrame, parts: int) -> DataFrame:
    """(key, home, word, n): each word at home in its block, and as a visitor where a neighbour may live."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "home", "word", "n"]
        for batch in batches:
            counts = set_counts(batch.column("word").to_pylist(), parts)
            yield pa.RecordBatch.from_arrays([packed(counts), pa.array([True] * len(counts)), batch.column("word"), batch.column("n")], names=names)
            for at, moved in neighbours(counts):
                some = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([packed(moved), pa.array([False] * len(at), pa.bool_()), some.column("word"), some.column("n")], names=names)

    return words.select("word", "n").mapInArrow(route, "key binary, home boolean, word string, n long")


def tiled(rows: DataFrame, large: DataFrame) -> DataFrame:
    """``rows`` dealt to tasks (key, tile, shift): TILE home words and VISITORS visitors, about, meet in each.

    ``large`` (key, tiles, shifts) holds the blocks that are more than one task. A home word goes to its tile once for every
    shift of visitors, a visitor to every tile of the block; the words of a block's tile visit the tiles after it.
    """
    one = F.lit(1).cast("long")
    known = rows.join(large, "key", "left").withColumns({"tiles": F.coalesce("tiles", one), "shifts": F.coalesce("shifts", one)})
    name = F.crc32(F.col("word").cast("binary"))
    known = known.withColumns({"_tile": name % F.col("tiles"), "_shift": F.floor(name / 7919) % F.col("shifts")})
    none = F.lit(0).cast("long")
    # (home, first and last tile, first and last shift) of each copy; a home word's second copy visits later tiles
    span = F.struct(F.col("home").alias("home"), F.when(F.col("home"), F.col("_tile")).otherwise(none).alias("t0"),
                    F.when(F.col("home"), F.col("_tile")).otherwise(F.col("tiles") - 1).alias("t1"),
                    F.when(F.col("home"), none).otherwise(F.col("_shift")).alias("s0"),
                    F.when(F.col("home"), F.col("shifts") - 1).otherwise(F.col("_shift")).alias("s1"))
    onward = F.struct(F.lit(False).alias("home"), (F.col("_tile") + 1).alias("t0"), (F.col("tiles") - 1).alias("t1"),
                      F.col("_shift").alias("s0"), F.col("_shift").alias("s1"))
    copies = F.when(F.col("home") & (F.col("_tile") + 1 < F.col("tiles")), F.array(span, onward)).otherwise(F.array(span))
    spread = known.select("key", "word", "n", F.explode(copies).alias("c")).select(
        "key", "word", "n", "c.home", F.explode(F.expr("sequence(c.t0, c.t1)")).alias("tile"), F.col("c.s0").alias("s0"), F.col("c.s1").alias("s1")
    )
    return spread.select("key", "tile", F.explode(F.expr("sequence(s0, s1)")).alias("shift"), "home", "word", "n")


def same_length_edits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two code matrices differ in exactly one place."""
    return (a != b).sum(axis=1) == 1


def inserted_edits(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows of ``long`` are those of ``short`` with one letter put in: common start and end cover the short one."""
    width = short.shape[1]
    start, end = short == long[:, :-1], (short == long[:, 1:])[:, ::-1]
    first = np.where(start.all(axis=1), width, start.argmin(axis=1))
    last = np.where(end.all(axis=1), width, end.argmin(axis=1))
    return first + last >= width


def near_in_tile(homes: list[str], visitors: list[str], inner: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (home, other) of the pairs one edit apart: among ``homes`` if ``inner``, and of homes with visitors.

    Homes are of one length, visitors of that or one letter less. Others are numbered homes first, then visitors.
    """
    length = len(homes[0])
    home = letter_counts(homes)
    used = np.flatnonzero(home.any(axis=0))
    # |x - y|^2 as one product of (x, |x|^2, 1) and (-2 y, 1, |y|^2); letters that no home word has count in |y|^2 alone
    left = np.column_stack([home[:, used], (home * home).sum(axis=1), np.ones(len(home), home.dtype)])
    codes = letter_codes(homes)[0].reshape(len(homes), length)
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def keep(x: np.ndarray, y: np.ndarray, other: np.ndarray, shift: np.ndarray) -> None:
        step = max(1, VERIFY_LETTERS // length)
        edits = same_length_edits if other.shape[1] == length else inserted_edits
        for at in range(0, len(x), step):
            i, j = x[at : at + step], y[at : at + step]
            ok = edits(other[j], codes[i])
            found.append((i[ok], shift[j[ok]]))

    def close(counts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Places of home words and of rows of ``counts`` at a squared distance of at most 2, by slices of the rows."""
        for at in range(0, len(counts), 256):
            part = counts[at : at + 256].astype(home.dtype, copy=False)
            right = np.column_stack([-2 * part[:, used], np.ones(len(part), home.dtype), (part * part).sum(axis=1)])
            x, y = np.divmod(np.flatnonzero(left @ right.T <= 2), len(part))
            yield at, x, y

    if inner:
        own = np.arange(len(homes))
        for at, x, y in close(home):
            before = x < y + at
            keep(x[before], y[before] + at, codes, own)
    for size in (length, length - 1):
        place = np.array([k for k, w in enumerate(visitors) if len(w) == size], np.int64)
        if len(place):
            some = [visitors[k] for k in place]
            other = letter_codes(some)[0].reshape(len(some), size)
            for at, x, y in close(letter_counts(some)):
                keep(x, y + at, other, place + len(homes))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def summed(words: list[str], n: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.Table:
    """NEAR rows of the words in the pairs (x, y): how many near words, and the most frequent of them."""
    a, b = np.concatenate([x, y]), np.concatenate([y, x])
    rank = np.empty(len(words), np.int64)
    rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    one, first, size = np.unique(a, return_index=True, return_counts=True)
    best = b[first]
    return pa.table(
        [
            pa.array([words[i] for i in one], pa.string()), pa.array(size, pa.int64()), pa.array(n[best], pa.int64()),
            pa.array([words[i] for i in best], pa.string()),
        ],
        names=["word", "near", "best_n", "best_word"],
    )


def near_of_tile(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    home = rows.column("home").to_numpy()
    homes, visitors = rows.filter(pa.array(home)), rows.filter(pa.array(~home))
    words = homes.column("word").to_pylist()
    others = visitors.column("word").to_pylist()
    if not words:
        return summed([], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    x, y = near_in_tile(words, others, key[2].as_py() == 0)
    n = np.concatenate([homes.column("n").to_numpy(), visitors.column("n").to_numpy()])
    return summed(words + others, n, x, y)


def near_words(words: DataFrame, parts: int | None = None) -> DataFrame:
    """NEAR of every word of the stored ``words`` (word, n; letters of LETTERS) that has a near word.

    Every task adds up its own pairs first, so what is exchanged grows with words and tiles, not pairs.
    """
    blocks = stored(block_counts(words), "word-blocks")
    if parts is None:
        parts = choose_parts(blocks)
    sizes = stored(tile_counts(blocks.where(F.col("parts") == parts).select("key", "homes"), parts), "block-tiles")
    large = sizes.where("tiles > 1 or shifts > 1").drop("work")
    known = sizes.agg(F.sum("work").alias("work"), F.count_if(F.expr("tiles > 1 or shifts > 1")).alias("large")).first()
    tasks = max(int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")), int((known["work"] or 0) / TASK_WORK))
    met = tiled(routed(words, parts), F.broadcast(large) if known["large"] <= BROADCAST_BLOCKS else large)
    # the work of a task does not follow from its bytes, so the number of tasks is set by the distances asked for
    found = met.repartition(tasks, "key", "tile", "shift").groupBy("key", "tile", "shift").applyInArrow(near_of_tile, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("m"), F.col("best_word").alias("w")))
    return found.groupBy("word").agg(F.sum("near").alias("near"), best.alias("_best")).select(
        "word", "near", (-F.col("_best.m")).alias("best_n"), F.col("_best.w").alias("best_word")
    )


def with_roots(forms: DataFrame, most: int) -> DataFrame:
    """(word, root) for the stored ``forms`` (word, form): the last word when forms are followed.

    A form is FORM_RATIO times as frequent as its word, so a chain has at most log(``most``) links; each round doubles what is followed.
    """
    ends, links = forms.select("word", F.col("form").alias("root")), 1
    while FORM_RATIO**links < most:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        ends = stored(ends.join(further, "root", "left").select("word", F.coalesce("_further", "root").alias("root")), "roots")
        links *= 2
    return ends


def spelling_variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for all words of ``documents`` (doc_id, text; other columns are not read).

    A null text has no words, a null id alters none. Repeated rows count each. A word without a near
    word of FORM_RATIO times its count has null as form and itself as root; ties go to the smaller word. An empty table gives no
    rows.
    """
    words = stored(word_counts(documents), "words")
    near = stored(near_words(words), "near-words")
    is_form = F.col("best_n") >= FORM_RATIO * F.col("n")
    found = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best_word")).alias("form"),
        F.when(is_form, F.col("best_n")).alias("form_n"),
    )
    found = stored(found, "word-forms")
    most = words.agg(F.max("n")).first()[0] or 0
    roots = with_roots(found.where("form is not null").select("word", "form"), most)
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


_ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
_STAND_INS = string.ascii_uppercase + string.digits + "!#$%&()*+,-./:;<=>?@[]^_`{|}~ "[:28]

#: The same in SQL; accented letters are replaced by other single bytes, since its edit distance counts bytes.
VARIANTS_SQL = f"""
WITH RECURSIVE
crc_steps AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
),
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS run
    FROM documents
),
long_runs AS (SELECT run, doc_id || ':' || run AS name FROM runs WHERE length(run) >= {LEAST_LENGTH}),
hashed AS (
    SELECT run, xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(name, ''), lambda x:
            CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END))),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) AS h
    FROM long_runs, crc_steps
),
results AS (
    SELECT CASE WHEN h % {ALTERED_EVERY} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
    FROM hashed
),
words AS (
    SELECT word, count(*) AS n, length(word) AS size, translate(word, '{_ACCENTED}', '{_STAND_INS}') AS bytes
    FROM results WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING count(*) >= {LEAST_COUNT}
),
halves AS (
    SELECT word, n, size, bytes, size AS span, 'start' AS side, substr(bytes, 1, (size // 2)::BIGINT) AS half FROM words
    UNION ALL SELECT word, n, size, bytes, size, 'end', substr(bytes, (size // 2)::BIGINT + 1) FROM words
    UNION ALL SELECT word, n, size, bytes, size - 1, 'start', substr(bytes, 1, ((size - 1) // 2)::BIGINT) FROM words
    UNION ALL SELECT word, n, size, bytes, size - 1, 'end', substr(bytes, (size - (size - 1 - (size - 1) // 2) + 1)::BIGINT) FROM words
),
links AS (
    SELECT DISTINCT a.word AS a, b.word AS b, b.n AS bn, a.n AS an
    FROM halves a JOIN halves b USING (span, side, half) WHERE a.word <> b.word AND levenshtein(a.bytes, b.bytes) = 1
),
near AS (
    SELECT a AS word, count(*) AS n_near, max(bn) AS best_n, arg_min(b, (-bn, b)) AS best_word FROM links GROUP BY a
),
forms AS (
    SELECT word, CASE WHEN best_n >= {FORM_RATIO} * n THEN best_word END AS form, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN best_n >= {FORM_RATIO} * n THEN best_n END AS form_n
    FROM words LEFT JOIN near USING (word)
),
chain AS (
    SELECT word, word AS last, 0 AS hops FROM forms
    UNION ALL SELECT c.word, f.form, c.hops + 1 FROM chain c JOIN forms f ON f.word = c.last WHERE f.form IS NOT NULL
),
roots AS (SELECT word, arg_max(last, hops) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
"""
