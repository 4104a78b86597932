"""Word shingle sets of whole texts as sorted 64-bit hashes, many documents at a time."""

from __future__ import annotations

import numpy as np

from obsguard.llm.common import mix64

_rng = np.random.default_rng(20_240_517)
#: A random odd 64-bit number for each byte, so that equal sums of different words are unlikely.
BYTE = _rng.integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
#: Its inverse modulo 2**64.
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))
STEP = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
SHORT = np.uint64(0x8EBC6AF09C88C6E3)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start places of the words of ``raw`` (bytes); words end at blanks and 9 to 13."""
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, np.uint64), start
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE[raw] * powers(BASE, len(raw)), out=total[1:])
    # (sum over the word of byte * base^place) / base^start depends on the word alone
    value = (total[end] - total[start]) * powers(UNBASE, len(raw))[start]
    return mix64(value ^ (end - start).astype(np.uint64)), start


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A to Z folded. Fewer words than ``width``: the whole
    sequence is the one shingle; no words: none."""
    if not texts:
        return []
    raw = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    value, start = word_hashes(raw)
    first = np.searchsorted(start, begin)
    joined = value.copy()
    for k in range(1, width):
        joined[: len(joined) - k] = joined[: len(joined) - k] * STEP[(k - 1) % 3] + value[k:]
    joined = mix64(joined)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(joined[a : b - width + 1]))
        elif b > a:
            whole = SHORT * np.uint64(b - a)
            for v in value[a:b]:
                whole = whole * STEP[0] + v
            out.append(mix64(np.array([whole])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
