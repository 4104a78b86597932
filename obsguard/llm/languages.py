"""Language of web pages by fusing evidence: text, declared markup language, address and host.

The likelihood of the visible text comes from byte trigrams of labelled documents. Three more sources
are learned from the pages themselves, as sums of the text's posteriors by group: how often each
declaration goes with each language, and what languages a host serves. Host sums are smoothed
towards those of the registered domain, these towards the address suffix, and these towards all
pages; a page's own share is taken out of each sum first. Groups of any size are sums, combined
before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsguard.llm.common import learnable, stored

GRAMS = 1 << 14
#: Bound on labelled documents of each language for the trigram model, chosen by a hash of doc_id.
SAMPLE_PER_LANGUAGE = 3_000
#: Evidence of a text saturates at that of so many trigrams.
SATURATION = 80.0
#: Weight, in pages, of the level above when smoothing.
WEIGHT = 5.0

HIDDEN_OPEN = re.compile(r"<!--|<(script|style|template|noscript)\b", re.IGNORECASE)
HIDDEN_CLOSE = {k: re.compile(rf"</{k}\s*>", re.IGNORECASE) for k in ("script", "style", "template", "noscript")}
ENTITY = re.compile(r"&#?\w+;")
HTML, META = re.compile(r"<html\b", re.IGNORECASE), re.compile(r"<meta\b", re.IGNORECASE)
LANG = re.compile(r"""\blang\s*=\s*["']?([A-Za-z]{2,3})""", re.IGNORECASE)
CONTENT_LANGUAGE = re.compile(r"""content-language["']""", re.IGNORECASE)
CONTENT = re.compile(r"""content\s*=\s*["']?([A-Za-z]{2,3})""", re.IGNORECASE)
#: Labels below a country's own under which names are registered.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "gob", "go", "net", "ne", "or", "org")
HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", re.IGNORECASE)


def without_hidden(html: str) -> str:
    """``html`` with comments and unseen elements blanked. One pass: a closing mark that was not found is not looked for again."""
    out, at, unclosed = [], 0, set()
    for found in HIDDEN_OPEN.finditer(html):
        kind = (found[1] or "").lower()
        if found.start() < at or kind in unclosed:
            continue
        if kind:
            closing = HIDDEN_CLOSE[kind].search(html, found.end())
            end = closing.end() if closing else -1
        else:
            closing = html.find("-->", found.end())
            end = closing + 3 if closing >= 0 else -1
        if end < 0:
            unclosed.add(kind)
            continue
        out.append(html[at : found.start()])
        at = end
    return " ".join([*out, html[at:]])


def without_tags(html: str) -> str:
    out, at = [], 0
    while (start := html.find("<", at)) >= 0 and (end := html.find(">", start)) >= 0:
        out.append(html[at:start])
        at = end + 1
    return " ".join([*out, html[at:]])


def visible_text(html: str) -> str:
    return ENTITY.sub(" ", without_tags(without_hidden(html)))


def attributes(html: str, opening: re.Pattern) -> Iterator[str]:
    """What stands in each tag that begins with ``opening``, up to its end; a tag begun inside another is part of it."""
    at = 0
    for found in opening.finditer(html):
        if found.start() >= at:
            end = html.find(">", found.end())
            at = len(html) if end < 0 else end
            yield html[found.end() : at]


def declared_language(html: str) -> str:
    for inside in attributes(html, HTML):
        if found := LANG.search(inside):
            return found[1].lower()
    for inside in attributes(html, META):
        named = CONTENT_LANGUAGE.search(inside)
        if named and (found := CONTENT.search(inside, named.end())):
            return found[1].lower()
    return ""


def address_levels(url: str) -> tuple[str, str, str]:
    """(host, registered domain, suffix); empty where the address has none. ``a.b.co.uk`` is registered as ``b.co.uk``."""
    found = HOST.match(url)
    host = found[1].lower().strip(".") if found else ""
    parts = host.split(".")
    labels = 3 if len(parts) > 2 and len(parts[-1]) == 2 and parts[-2] in SECOND_LEVEL else 2
    return host, ".".join(parts[-labels:]), parts[-1] if host else ""


def trigrams(text: str) -> np.ndarray:
    """Hashed trigrams of the folded bytes of letters; all else is one blank."""
    raw = np.frombuffer(re.sub(r"[\W\d_]+", " ", text.lower()).encode("utf-8", "replace"), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    mixed = (raw[:-2] * np.uint32(0x9E3779B1)) ^ (raw[1:-1] * np.uint32(0x85EBCA77)) ^ (raw[2:] * np.uint32(0xC2B2AE3D))
    return ((mixed ^ (mixed >> np.uint32(15))) % np.uint32(GRAMS)).astype(np.int64)


def fit_trigrams(documents: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages of the learnable documents and the log likelihoods of trigrams, (GRAMS, languages)."""
    known = documents.where(F.col("lang").isNotNull() & learnable(F.col("doc_id")))
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).collect()
    names = sorted(r["lang"] for r in counts)
    if not names:
        return [], np.zeros((GRAMS, 0))
    share = {r["lang"]: min(1.0, per_language / r["n"]) for r in counts}
    limit = reduce(lambda a, k: a.when(F.col("lang") == k, F.lit(share[k])), names, F.when(F.lit(False), F.lit(0.0))).otherwise(0.0)
    spot = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), GRAMS), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if text:
                    total[names.index(lang)] += np.bincount(trigrams(text), minlength=GRAMS)
        k, gram = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k.astype(np.int32)), pa.array(gram.astype(np.int32)), pa.array(total[k, gram])], names=["k", "gram", "n"]
        )

    rows = known.where(F.col("lang").isin(names)).where(spot < limit).select("lang", "text")
    sums = rows.mapInArrow(count, "k int, gram int, n long").groupBy("k", "gram").agg(F.sum("n").alias("n")).collect()
    table = np.full((GRAMS, len(names)), 0.5)
    for r in sums:
        table[r["gram"], r["k"]] += r["n"]
    return names, np.log(table / table.sum(axis=0))


def read_evidence(pages: DataFrame, likelihoods: np.ndarray) -> DataFrame:
    """(page_id, host, domain, suffix, declared, n_grams, text): text holds tempered log likelihoods."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                grams = trigrams(visible_text(html or ""))
                total = likelihoods[grams].sum(axis=0) / (1 + len(grams) / SATURATION)
                out.append((*address_levels(url or ""), declared_language(html or ""), len(grams), (total - total.max()).tolist()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.string()] * 4 + [pa.int32(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["page_id", "host", "domain", "suffix", "declared", "n_grams", "text"],
            )

    schema = "page_id long, host string, domain string, suffix string, declared string, n_grams int, text array<double>"
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html").mapInArrow(read, schema)


def posterior(scores: Column, size: int) -> Column:
    """Normalised exponentials of an array of scores."""
    top = F.array_max(scores)
    raised = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def identify_languages(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """page_id, host, declared, language, probability, text_language for every row of ``pages``.

    A null or empty page has no text evidence, a null address no host: the other evidence decides, in
    the end the languages of all pages. Only learnable documents with a language are learned from;
    without any, language is null. Repeated rows are pages each. Other columns are not read.
    """
    names, likelihoods = fit_trigrams(documents)
    if not names:
        empty = F.lit(None).cast("string")
        host = pages.select(F.col("page_id").cast("long").alias("page_id"))
        return host.select("page_id", *(empty.alias(c) for c in ("host", "declared", "language")), F.lit(None).cast("double").alias("probability"), empty.alias("text_language"))
    size = len(names)
    seen = read_evidence(pages, likelihoods).withColumn("q", posterior(F.col("text"), size))
    seen = stored(seen, "page-evidence")
    sums = lambda p: [F.sum(F.col("q")[k]).alias(f"{p}{k}") for k in range(size)]
    whole = seen.agg(F.count("*").alias("n"), *sums("g")).first()
    n = float(whole["n"] or 0)
    overall = [((whole[f"g{k}"] or 0.0) + 1.0) / (n + size) for k in range(size)]

    def level(name: str) -> DataFrame:
        return seen.where(F.col(name) != "").groupBy(name).agg(F.count("*").alias(f"n_{name}"), *sums(f"{name}_"))

    joined = seen
    for name in ("host", "domain", "suffix", "declared"):
        joined = joined.join(level(name), name, "left")

    def without_own(name: str, k: int) -> tuple[Column, Column]:
        """A group's sum for a language and its size, less the page itself; 0 where there is no group."""
        some = F.col(f"n_{name}").isNotNull()
        return (
            F.when(some, F.greatest(F.col(f"{name}_{k}") - F.col("q")[k], F.lit(0.0))).otherwise(0.0),
            F.when(some, F.col(f"n_{name}") - 1.0).otherwise(0.0),
        )

    scores = []
    for k in range(size):
        prior: Column = F.lit(overall[k])
        for name in ("suffix", "domain", "host"):
            own, rows = without_own(name, k)
            prior = (own + WEIGHT * prior) / (rows + WEIGHT)
        # how likely this declaration is for the language, against how common it is
        own, rows = without_own("declared", k)
        lift = F.when(F.col("declared") == "", F.lit(1.0)).otherwise((own + WEIGHT * overall[k]) / (rows + WEIGHT) / overall[k])
        scores.append(F.col("text")[k] + F.log(F.greatest(prior, F.lit(1e-9))) + F.log(F.greatest(lift, F.lit(1e-9))))
    fused = joined.withColumn("p", posterior(F.array(*scores), size))
    named = F.lit(names)
    best = lambda c: F.element_at(named, F.array_position(c, F.array_max(c)).cast("int"))
    return fused.select(
        "page_id", F.nullif("host", F.lit("")).alias("host"), F.nullif("declared", F.lit("")).alias("declared"),
        best(F.col("p")).alias("language"), F.array_max("p").alias("probability"),
        F.when(F.col("n_grams") > 0, best(F.col("q"))).alias("text_language"),
    )
