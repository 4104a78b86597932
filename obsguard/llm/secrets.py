"""Secret scan: fixed patterns, and strings that a public vocabulary cannot compress.

A long run of token characters that a byte-pair vocabulary cuts into many pieces per character is
random text: words and identifiers come out at several characters a token, random strings at little
more than one. Known digests (hex of a digest's length) and UUIDs are set aside, and so are runs
whose parts between separators are words by the same vocabulary. Both the whole run and its long
parts are judged, so a random string at the end of a path is found too.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsguard.llm.common import tidy

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("passw", "secret", "token", "key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
RUN = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z0-9+/_=.-]{16,}")
#: Lengths in hex digits of md5, sha1, sha224, sha256, sha384 and sha512.
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = r"[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}"
DIGEST = "|".join(f"[0-9a-f]{{{n}}}|[0-9A-F]{{{n}}}" for n in DIGEST_LENGTHS)
KNOWN = re.compile(rf"(?<![A-Za-z0-9])(?:{UUID}|{DIGEST})(?![A-Za-z0-9])")
PART = re.compile(r"[A-Za-z0-9]+")
ENDS = "+/_.=-"

#: At or below this many characters a token, a run is random.
RATIO = 2.0
LEAST_LENGTH = 16
#: A shorter part that is no token of its own is neither a word nor a random string.
LEAST_PART = 4
#: Digits of a date or a counter; longer numbers are judged by the vocabulary, those of 16 digits are hex findings.
DATE_DIGITS = 8


def load_encoding(path: str) -> tiktoken.Encoding:
    """A tiktoken encoding of the ranks in ``path``; its pattern takes a run as one piece."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("runs", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})


def is_random(run: str, encoding: tiktoken.Encoding, ratio: float) -> bool:
    return len(run) <= ratio * len(encoding.encode_ordinary(run))


def made_of_words(run: str, encoding: tiktoken.Encoding, ratio: float) -> bool:
    """Whether all parts of ``run`` are words by the vocabulary: single or long tokens, or dates."""
    words = unclear = 0
    for part in PART.findall(run):
        tokens = len(encoding.encode_ordinary(part))
        if tokens == 1 or len(part) > ratio * tokens or (part.isdigit() and len(part) <= DATE_DIGITS):
            words += len(part)
        elif len(part) >= LEAST_PART:
            return False
        else:
            unclear += len(part)
    return words >= unclear


def random_spans(run: str, encoding: tiktoken.Encoding, ratio: float) -> list[tuple[int, int]]:
    """(start, end) of the random strings in ``run``: what lies between digests and UUIDs, or long parts of it."""
    out, at = [], 0
    for a, b in [*(m.span() for m in KNOWN.finditer(run)), (len(run), len(run))]:
        stretch = run[at:a].rstrip(".=-_")
        if len(stretch) >= LEAST_LENGTH:
            if is_random(stretch, encoding, ratio) and not made_of_words(stretch, encoding, ratio):
                out.append((at, at + len(run[at:a].rstrip(".-_"))))
            else:
                parts = (m.span() for m in PART.finditer(stretch) if len(m[0]) >= LEAST_LENGTH)
                out += [(at + x, at + y) for x, y in parts if is_random(stretch[x:y], encoding, ratio)]
        at = b
    return out


def uncovered(a: int, b: int, covers: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What of a..b lies in none of ``covers`` (start, kind, end)."""
    for start, _, end in sorted(c for c in covers if c[0] < b and a < c[2]):
        if a < start:
            yield a, start
        a = max(a, end)
    if a < b:
        yield a, b


def find_spans(text: str, encoding: tiktoken.Encoding, ratio: float = RATIO) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all findings in ``text``, by start, then kind in the order of KINDS."""
    found: list[tuple[int, int, int]] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    odd = []
    for m in RUN.finditer(text):
        run, at = m[0], m.start()
        found += [(at + a.start(), 1, at + a.end()) for a in ACCESS.finditer(run) if len(a[0]) >= 18]
        found += [(at + h.start(), 2, at + h.end()) for h in HEX.finditer(run)]
        odd += [(at + a, at + b) for a, b in random_spans(run, encoding, ratio)]
    base = list(found)
    for a, b in odd:
        for x, y in uncovered(a, b, base):
            if (x, y) == (a, b):
                found.append((x, 3, y))
                continue
            rest = text[x:y].strip(ENDS)
            if rest and not made_of_words(rest, encoding, ratio):
                x += text[x:y].index(rest)
                found.append((x, 3, x + len(rest)))
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def digest_of(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def scan_secrets(documents: DataFrame, vocabulary: str, ratio: float = RATIO) -> DataFrame:
    """Findings of every whole text: doc_id, counts by kind, a digest of the pattern findings, all spans.

    One row for each input row, repeated rows included; a null or empty text has no findings; other
    columns are not read. ``vocabulary`` is a tiktoken rank file that every executor can open.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(vocabulary)
        for batch in batches:
            ids, rows = batch.column("doc_id"), []
            for text in batch.column("text"):
                spans = find_spans(text.as_py() or "", encoding, ratio)
                base = [s for s in spans if s[1] != "random"]
                rows.append(
                    [sum(s[1] == k for s in spans) for k in KINDS]
                    + [hashlib.sha256(digest_of(base).encode()).hexdigest(), digest_of(spans)]
                )
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "n_random", "base_sha256", "spans"],
            )

    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(scan), schema)


def redact_secrets(documents: DataFrame, vocabulary: str, mark: str = "<secret>", ratio: float = RATIO) -> DataFrame:
    """``documents`` with every finding replaced by ``mark``; overlapping findings become one mark.

    All rows and columns stay; ``n_chars`` is set to the new length. A null text stays null.
    """

    def clean(text: str, encoding: tiktoken.Encoding) -> str:
        out, at = [], 0
        for a, _, b in find_spans(text, encoding, ratio):
            if a >= at:
                out += [text[at:a], mark]
            at = max(at, b)
        return "".join(out) + text[at:]

    schema = documents.schema

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(vocabulary)
        for batch in batches:
            i = batch.schema.get_field_index("text")
            texts = [None if t is None else clean(t, encoding) for t in batch.column(i).to_pylist()]
            yield batch.set_column(i, batch.schema.field(i), pa.array(texts, batch.schema.field(i).type))

    done = documents.mapInArrow(tidy(apply), schema)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.length("text").cast(kind))
    return done.select(*documents.columns)


def has_spans(spans: Column) -> Column:
    return spans != ""
