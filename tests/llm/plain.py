"""Plain single-process versions that the tests compare the operators with."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict


def text_of(value: str | None) -> bytes:
    return (value or "").encode()


def remaining(rows, length=100):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256)} with every byte covered by an earlier string removed."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        raw = text_of(text)
        gone = [False] * len(raw)
        for p in range(len(raw) - length + 1):
            window = raw[p : p + length]
            if window in seen:
                gone[p : p + length] = [True] * length
            seen.add(window)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def shingles(text, width=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", text_of(text).lower())
    if len(words) >= width:
        return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def jaccard_components(rows, share=85, width=4):
    """{doc_id: (n_shingles, component_id)} from all pairs."""
    sets = {doc: shingles(text, width) for doc, text in rows}
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= share * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {doc: (len(sets[doc]), find(doc)) for doc in sets}


def secret_spans(text):
    """The pattern findings of a text by the contract's own words."""
    text = text or ""
    rules = (
        ("assign", r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12, 2),
        ("access", r"AKIA[A-Z0-9]+", 18, 0),
        ("hex", r"[0-9a-f]+", 16, 0),
    )
    found = [
        (m.start(), k, m.end()) for k, (_, rule, least, group) in enumerate(rules) for m in re.finditer(rule, text) if len(m[group]) >= least
    ]
    return [(rules[k][0], a, b) for a, k, b in sorted(found)]


def groups_of(pairs):
    out = defaultdict(set)
    for doc, component in pairs:
        out[component].add(doc)
    return {frozenset(v) for v in out.values()}
