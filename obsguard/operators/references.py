"""Checks against a reference group: climatology, whole-series statistics, neighbour stations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsguard.operators.framework import flag_when
from obsguard.operators.joins import join_null_safe
from obsguard.operators.quantiles import robust_statistics

# Thresholds of the reference checks.
Z_LIMIT = 4.0
ROBUST_Z_LIMIT = 4.5
IQR_FACTOR = 3.0
MAD_LIMIT = 6.0
MIN_YEARS, MIN_SAMPLES = 10, 30


def climatology(
    history: DataFrame,
    keys: list[str],
    value: str,
    year: str,
    min_years: int = MIN_YEARS,
    min_samples: int = MIN_SAMPLES,
) -> DataFrame:
    """Reference statistics per group: p1, p25, median, p75, p99, mean, std, MAD, years.

    Groups with too few years or samples are left out, so observations there are not checked.
    """
    probs = {"p1": 0.01, "p25": 0.25, "p75": 0.75, "p99": 0.99}
    stats = robust_statistics(history, keys, value, probs, year)
    return stats.filter((F.col("years") >= min_years) & (F.col("n") >= min_samples))


def _flags(x: Column) -> dict[str, Column]:
    iqr = F.col("p75") - F.col("p25")
    off = F.abs(x - F.col("median"))
    return {
        "percentile": flag_when((x < F.col("p1")) | (x > F.col("p99")), "SUSPECT", [x, F.col("p1")]),
        "z_score": flag_when(
            F.round(F.abs(x - F.col("mean")) / F.col("std"), 6) > Z_LIMIT, "SUSPECT", [x, F.col("std")],
            skip=F.col("std") <= 0,
        ),
        "robust_z_score": flag_when(
            F.round(off * 0.6745 / F.col("mad"), 6) > ROBUST_Z_LIMIT, "SUSPECT", [x, F.col("mad")],
            skip=F.col("mad") <= 0,
        ),
        "interquartile_range": flag_when(
            (F.round(F.col("p25") - iqr * IQR_FACTOR - x, 6) > 0)
            | (F.round(x - F.col("p75") - iqr * IQR_FACTOR, 6) > 0),
            "SUSPECT", [x, F.col("p25")],
        ),
        "median_absolute_deviation": flag_when(
            F.round(off / F.col("mad"), 6) > MAD_LIMIT, "SUSPECT", [x, F.col("mad")], skip=F.col("mad") <= 0
        ),
    }


def climatology_flags(obs: DataFrame, reference: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Five flags per observation against its reference group; no group means NOT_CHECKED."""
    wanted = ["p1", "p25", "median", "p75", "p99", "mean", "std", "mad"]
    joined = join_null_safe(obs, reference.select(*keys, *wanted), keys, "left")
    x = F.col(value).cast("double")
    return joined.withColumns({f"climatology_{n}": f for n, f in _flags(x).items()}).drop(*wanted)


def series_flags(
    obs: DataFrame, keys: list[str], value: str, min_samples: int = MIN_SAMPLES
) -> DataFrame:
    """IQR and MAD flags of an observation against its own (station, variable) series."""
    stats = robust_statistics(obs, keys, value, {"p25": 0.25, "p75": 0.75}).filter(F.col("n") >= min_samples)
    wanted = ["p25", "median", "p75", "mad"]
    joined = join_null_safe(obs, stats.select(*keys, *wanted), keys, "left").withColumns(
        {c: F.lit(None).cast("double") for c in ("p1", "p99", "mean", "std")}
    )
    flags = _flags(F.col(value).cast("double"))
    return joined.withColumns(
        {
            "statistical_interquartile_range": flags["interquartile_range"],
            "statistical_median_absolute_deviation": flags["median_absolute_deviation"],
        }
    ).drop(*wanted, "p1", "p99", "mean", "std")


def spatial_flags(
    obs: DataFrame, matches: DataFrame, threshold: float, row_id: str = "event_id", value: str = "value",
    min_neighbours: int = 2,
) -> DataFrame:
    """Neighbour difference and isolated extreme, from one nearest observation per neighbour station.

    ``matches`` holds them in one array a row (see :func:`obsguard.operators.joins.nearest_around`), so only four
    numbers a row are exchanged.
    """
    values, n = F.col("_values"), F.size("_values")
    middle = F.get(values, F.floor((n - 1) / 2).cast("int")) * 0.5 + F.get(values, F.floor(n / 2).cast("int")) * 0.5
    around = matches.select(row_id, F.sort_array(F.col("matches.neighbour_value").cast("array<double>")).alias("_values")).select(
        row_id, n.alias("neighbours"), middle.alias("_median"), F.get(values, F.lit(0)).alias("_lo"), F.get(values, n - 1).alias("_hi")
    )
    x = F.col(value).cast("double")
    few = F.coalesce(F.col("neighbours"), F.lit(0)) < min_neighbours
    return (
        obs.join(around, row_id, "left")
        .withColumns(
            {
                "neighbours": F.coalesce("neighbours", F.lit(0)).cast("bigint"),
                "spatial_neighbor_difference": flag_when(
                    F.round(F.abs(x - F.col("_median")), 6) > threshold, "SUSPECT", [x], skip=few
                ),
                "spatial_isolated_extreme": flag_when(
                    (F.round(F.col("_lo") - x, 6) > threshold) | (F.round(x - F.col("_hi"), 6) > threshold),
                    "SUSPECT", [x], skip=few,
                ),
            }
        )
        .drop("_median", "_lo", "_hi")
    )
