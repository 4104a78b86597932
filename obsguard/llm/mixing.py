"""Soft-membership mixing: document rates whose expected domain token totals meet target weights.

A naive Bayes classifier over hashed words, learned from the labels table, gives every document a
posterior over domains instead of one hard domain. Nonnegative rates (expected copies of each
document) then minimise the squared gap between expected token totals by domain and the targets,
each gap weighted by one over the domain's share, with projected-gradient steps from one copy each; a step
starts from where the last two point to, which takes far fewer of them.

Everything is DataFrame work: one aggregate a step brings one number for each domain to the driver,
and documents' rates are stored anew after every few steps, so no state is shuffled.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsguard.llm.common import learnable, stored

DOMAINS = ("plain", "poor", "toxic")
TARGETS = {"plain": 0.85, "poor": 0.12, "toxic": 0.03}
BUCKETS = 16_384
#: Bound on the labelled rows of each domain that the classifier reads, chosen by a hash of doc_id.
SAMPLE_PER_DOMAIN = 12_000
#: Evidence is the mean log ratio of a document's words, times the root of their number and this.
STRENGTH = 1.0
#: Steps end where all gaps are within the tolerance (of the least target), or where a step no longer moves the rates by
#: so many copies a token, which is how an optimum under nonnegative rates shows. More steps than this are an error.
STEPS, TOLERANCE, SETTLED = 300, 1e-3, 1e-3
#: Rates are written out after so many steps, which bounds the projections of a pass.
FOLD = 8


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "")


def bucket_of(word: Column) -> Column:
    return F.pmod(F.hash(word), F.lit(BUCKETS))


def domain_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, domain): toxic before poor before plain; null labels and contradicting rows are left out."""
    kind = F.when(F.col("toxic") == 1, 2).when((F.col("toxic") == 0) & (F.col("quality") == 0), 1).when(
        (F.col("toxic") == 0) & (F.col("quality") == 1), 0
    )
    return (
        labels.where(learnable(F.col("doc_id")))
        .select(F.col("doc_id").cast("long").alias("doc_id"), kind.alias("k"))
        .where("k is not null")
        .groupBy("doc_id").agg(F.min("k").alias("domain"), F.max("k").alias("_most"))
        .where("domain = _most").drop("_most")
    )


def fit_domains(documents: DataFrame, labels: DataFrame, per_domain: int = SAMPLE_PER_DOMAIN) -> tuple[list[float], list[list[float]]]:
    """Log priors and, by domain after the first, the log likelihood ratio of each word bucket."""
    known = domain_labels(labels)
    counts = {int(r["domain"]): int(r["n"]) for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    spot = F.pmod(F.xxhash64(F.lit("domain"), "doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    limit = F.element_at(F.array(*(F.lit(min(1.0, per_domain / counts[k]) if counts.get(k) else 0.0) for k in range(len(DOMAINS)))), F.col("domain") + 1)
    chosen = known.where(spot < limit)
    seen = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select(
        "domain", F.explode(F.array_distinct(F.transform(words_of(F.col("text")), bucket_of))).alias("bucket")
    )
    found = seen.groupBy("bucket").agg(*(F.count_if(F.col("domain") == k).alias(f"n{k}") for k in range(len(DOMAINS)))).collect()
    hits = np.zeros((len(DOMAINS), BUCKETS))
    for r in found:
        hits[:, r["bucket"]] = [r[f"n{k}"] for k in range(len(DOMAINS))]
    rate = (hits + 0.5) / (hits.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
    total = sum(counts.values())
    prior = [float(np.log((counts.get(k, 0) + 0.5) / (total + 0.5 * len(DOMAINS)))) for k in range(len(DOMAINS))]
    return prior, [np.log(rate[k] / rate[0]).round(5).tolist() for k in range(1, len(DOMAINS))]


def constant_array(values: list[float]) -> Column:
    """A long literal array: split from one string and folded once while planning."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<double>")


def with_posteriors(documents: DataFrame, prior: list[float], ratios: list[list[float]]) -> DataFrame:
    """(row, n_tokens, p_<domain>...) of (row, _text): tokens are words; evidence is tempered by the root of its size."""
    words = documents.select("row", F.transform(words_of(F.col("_text")), bucket_of).alias("_b"))
    words = words.select("row", F.size("_b").cast("long").alias("n_tokens"), F.array_distinct("_b").alias("_b"))
    size = F.sqrt(F.greatest(F.size("_b"), F.lit(1)).cast("double"))

    def evidence(table: list[float]) -> Column:
        at = constant_array(table)
        return F.aggregate("_b", F.lit(0.0), lambda a, b: a + F.element_at(at, b + 1))

    scores = [F.lit(prior[0]), *(F.lit(x) + evidence(r) * STRENGTH / size for x, r in zip(prior[1:], ratios, strict=True))]
    named = words.select("row", "n_tokens", *(s.alias(f"_s{k}") for k, s in enumerate(scores)))
    top = F.greatest(*(F.col(f"_s{k}") for k in range(len(DOMAINS))))
    shifted = named.select("row", "n_tokens", *(F.exp(F.col(f"_s{k}") - top).alias(f"_e{k}") for k in range(len(DOMAINS))))
    total = reduce(lambda a, b: a + b, (F.col(f"_e{k}") for k in range(len(DOMAINS))))
    return shifted.select("row", "n_tokens", *((F.col(f"_e{k}") / total).alias(f"p_{d}") for k, d in enumerate(DOMAINS)))


def rate_after(steps: list[list[float]]) -> Column:
    """A document's rate after all ``steps``, as one fold from one copy.

    A step (momentum, pull by domain...) goes on along the last change, moves against the gradient, and back to at least 0.
    """
    if not steps:
        return F.lit(1.0)
    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("before"))

    def step(state: Column, y: Column) -> Column:
        pull = reduce(lambda a, b: a + b, (F.col(f"p_{d}") * F.element_at(y, k + 2) for k, d in enumerate(DOMAINS)))
        ahead = state["rate"] + F.element_at(y, 1) * (state["rate"] - state["before"])
        return F.struct(F.greatest(F.lit(0.0), ahead - pull).alias("rate"), state["rate"].alias("before"))

    return F.aggregate(F.array(*(F.array(*map(F.lit, y)) for y in steps)), start, step, lambda state: state["rate"])


def advanced(state: DataFrame, steps: list[list[float]]) -> DataFrame:
    """``state`` (n_tokens, p_<domain>..., rate, before) after ``steps``: one projection each, all in generated code."""
    names = [f"p_{d}" for d in DOMAINS]
    for momentum, *pull in steps:
        ahead = F.col("rate") + momentum * (F.col("rate") - F.col("before"))
        back = reduce(lambda a, b: a + b, (F.col(c) * y for c, y in zip(names, pull, strict=True)))
        state = state.select("n_tokens", *names, F.greatest(F.lit(0.0), ahead - back).alias("rate"), F.col("rate").alias("before"))
    return state


def wanted_shares(share: np.ndarray, targets: dict[str, float | None], total_share: float) -> np.ndarray:
    """Target totals as shares of the input's tokens: a domain without a weight keeps its share, the others divide the rest."""
    kept = np.array([targets[d] is None for d in DOMAINS])
    weights = np.array([targets[d] or 0.0 for d in DOMAINS])
    return total_share * np.where(kept, share, weights / weights.sum() * (1 - share[kept].sum()))


def fit_rates(members: DataFrame, targets: dict[str, float | None], total_share: float = 1.0) -> list[list[float]]:
    """The projected-gradient steps for stored ``members``; none for an empty table."""
    n = F.col("n_tokens").cast("double")
    p = [F.col(f"p_{d}") for d in DOMAINS]
    first = members.agg(
        F.sum(n).alias("n"),
        *(F.sum(n * x).alias(f"t{i}") for i, x in enumerate(p)),
        *(F.sum(n * x * y).alias(f"g{i}_{j}") for i, x in enumerate(p) for j, y in enumerate(p)),
    ).first()
    if not first["n"]:
        return []
    total, size = float(first["n"]), len(DOMAINS)
    share = np.array([first[f"t{i}"] for i in range(size)]) / total
    wanted = wanted_shares(share, targets, total_share)
    weight = 1 / np.maximum(share, 1e-3)
    gram = np.array([[first[f"g{i}_{j}"] for j in range(size)] for i in range(size)]) / total
    size_of_step = 1 / np.linalg.eigvalsh(np.sqrt(np.outer(weight, weight)) * gram).max()
    names = [f"p_{d}" for d in DOMAINS]
    state = members.select("n_tokens", *names, F.lit(1.0).alias("rate"), F.lit(1.0).alias("before"))
    steps: list[list[float]] = []
    since = 0  # steps that the stored rates already hold
    earlier, moved, pace = share, np.inf, 1.0
    for _ in range(STEPS):
        if np.abs(share - wanted).max() <= TOLERANCE * max(wanted.min(), 0.01) or moved <= SETTLED:
            break
        if len(steps) - since >= FOLD:
            state = stored(advanced(state, steps[since:]), "rates")
            since = len(steps)
        next_pace = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        momentum = (pace - 1) / next_pace
        # totals follow the rates linearly, so those at the point ahead need no pass
        gap = share + momentum * (share - earlier) - wanted
        steps.append([float(momentum), *(size_of_step * weight * gap).tolist()])
        got = advanced(state, steps[since:]).agg(
            *(F.sum(n * x * F.col("rate")).alias(f"t{i}") for i, x in enumerate(p)), F.sum(n * F.abs(F.col("rate") - F.col("before"))).alias("moved")
        ).first()
        now, moved = np.array([got[f"t{i}"] for i in range(size)]) / total, got["moved"] / total
        worse = (weight * (now - wanted) ** 2).sum() > (weight * (share - wanted) ** 2).sum()
        earlier, share, pace = share, now, 1.0 if worse else next_pace
    else:
        raise RuntimeError(f"rates not settled after {STEPS} steps: gaps {(share - wanted).tolist()}")
    return steps


def mix_documents(documents: DataFrame, labels: DataFrame, targets: dict[str, float | None] | None = None) -> DataFrame:
    """doc_id, n_tokens, posteriors by domain and rate, one row for each row of ``documents``.

    ``targets`` are weights by domain; a domain with None keeps its share. Where no nonnegative rates meet the targets,
    they come as near as they can. A null or empty text has no tokens, the prior as posterior and a
    rate that changes no total. Without labels every document gets the same posterior. Repeated rows
    get equal rates; an empty table gives no rows; other columns are not read.
    """
    rows = documents.select(F.struct("doc_id").alias("row"), F.col("text").alias("_text"))
    members = stored(with_posteriors(rows, *fit_domains(documents, labels)), "members")
    rate = rate_after(fit_rates(members, targets or TARGETS))
    return members.select("row.doc_id", "n_tokens", *(f"p_{d}" for d in DOMAINS), rate.alias("rate"))


def apply_rates(
    documents: DataFrame, labels: DataFrame, targets: dict[str, float | None] | None = None, total_share: float = 1.0
) -> DataFrame:
    """``documents`` with each row as often as its rate says; a fraction is decided by a hash of doc_id.

    The targets add up to ``total_share`` times the input's tokens. The columns stay; a rate below one may leave a row out, a rate above one repeats it. A row with a
    null doc_id is decided by the hash of null.
    """
    rows = documents.select(F.struct(*documents.columns).alias("row"), F.col("text").alias("_text"))
    members = stored(with_posteriors(rows, *fit_domains(documents, labels)), "members")
    spot = F.pmod(F.xxhash64(F.lit("copies"), "row.doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    times = F.floor(rate_after(fit_rates(members, targets or TARGETS, total_share)) + spot).cast("int")
    copies = members.select("row", times.alias("times")).where("times > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")).select("row.*")
