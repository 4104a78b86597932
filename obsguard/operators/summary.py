"""Summaries and product tables.

Counts are reduced to the finest grouping first; coarser levels are built from that small table,
so the data is read and shuffled once whatever the number of levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsguard.catalogs import rulebook as R
from obsguard.operators.framework import detail
from obsguard.operators.joins import join_null_safe
from obsguard.operators.quantiles import quantiles_of_counts, value_counts

SUMMARY_KEYS = ["station_id", "year", "month", "variable", "rule_id"]


def findings(df: DataFrame, ids: list[str], results: str = "qc_results") -> DataFrame:
    """(ids, variable, rule_id, flag) for every result."""
    return detail(df, ids, results, failed_only=False).select(*ids, "variable", "rule_id", "flag")


def flag_counts(found: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per (keys, flag): the finest table all summaries start from."""
    return found.groupBy(*keys, "flag").agg(F.count(F.lit(1)).alias("observations"))


def _totals() -> list[Column]:
    n = F.col("observations")

    def of(flag: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("flag") == flag, n)), F.lit(0)).cast("bigint")

    failed = F.sum(F.when(F.col("flag").isin("SUSPECT", "ERROR", "MISSING"), n).otherwise(0))
    return [
        F.sum(n).cast("bigint").alias("total_observations"),
        of("PASS").alias("passed_observations"),
        of("SUSPECT").alias("suspect_observations"),
        of("ERROR").alias("erroneous_observations"),
        of("MISSING").alias("missing_observations"),
        of("NOT_CHECKED").alias("not_checked_observations"),
        F.round(failed * 100.0 / F.sum(n), 4).alias("failure_pct"),
    ]


def summary(counts: DataFrame, keys: list[str]) -> DataFrame:
    return counts.groupBy(*keys).agg(*_totals())


def summary_levels(counts: DataFrame, sets: list[list[str]], keys: list[str]) -> DataFrame:
    """Several grouping levels at once, told apart by ``level`` (the grouping id)."""
    return counts.groupingSets(sets, *keys).agg(F.grouping_id().cast("bigint").alias("level"), *_totals())


def frequent_errors(counts: DataFrame, k: int = 10) -> DataFrame:
    """The k rules failing most often, ties by rule id."""
    return (
        counts.filter(F.col("flag").isin("SUSPECT", "ERROR", "MISSING"))
        .groupBy("rule_id")
        .agg(F.sum("observations").cast("bigint").alias("failures"))
        .orderBy(F.desc("failures"), "rule_id")
        .limit(k)
    )


def stage_summary(counts: DataFrame, stage: str) -> DataFrame:
    """Per rule of one quality-control stage."""
    return summary(counts.filter(F.col("rule_id").isin(R.rules_of_stage(stage, include_disabled=True))), ["rule_id"])


def stage_summaries(counts: DataFrame, stages: list[str]) -> DataFrame:
    """Per rule of every stage named, from one reading of ``counts``; a rule belongs to one stage."""
    of = {r: stage for stage in stages for r in R.rules_of_stage(stage, include_disabled=True)}
    known = counts.filter(F.col("rule_id").isin(list(of)))
    by_rule = F.create_map(*[F.lit(x) for kv in of.items() for x in kv])
    return summary(known, ["rule_id"]).withColumn("stage", F.element_at(by_rule, F.col("rule_id")))


def limit_rows(df: DataFrame, order: list[Column], rows: int = 100) -> DataFrame:
    """The first rows of a report table."""
    return df.orderBy(*order).limit(rows)


# --- descriptive statistics ---------------------------------------------------------------------


def descriptive_statistics(
    long_df: DataFrame, keys: list[str], value: str = "value", flag: str | None = None, duplicate: str | None = None
) -> DataFrame:
    """Observations, missing, mean, median, extremes and deviation per group.

    With a ``flag`` column also passed, suspect and erroneous observations and their share, with a
    ``duplicate`` column (true on every copy but the first) the number of copies. Everything is one aggregate
    but the median, which is picked by rank from value counts, so that a hot group is reduced first.
    """
    x, n = F.col(value).cast("double"), F.count(F.lit(1))
    counted = []
    if flag is not None:
        f = F.col(flag)
        counted = [F.count_if(f == v).alias(c) for c, v in (("passed", "PASS"), ("suspect", "SUSPECT"), ("errors", "ERROR"))]
        counted.append(F.round(F.count_if(f == "PASS") * 100.0 / n, 4).alias("passed_pct"))
    if duplicate is not None:
        counted.append(F.count_if(F.col(duplicate)).alias("duplicates"))
    base = long_df.groupBy(*keys).agg(
        n.alias("observations"),
        F.count_if(x.isNull()).alias("missing"),
        F.round(F.count_if(x.isNull()) * 100.0 / n, 4).alias("missing_pct"),
        F.avg(x).alias("mean"),
        F.min(x).alias("minimum"),
        F.max(x).alias("maximum"),
        F.stddev_samp(x).alias("standard_deviation"),
        *counted,
    )
    median = quantiles_of_counts(value_counts(long_df, keys, value), keys, {"median": 0.5})
    return join_null_safe(base, median, keys, "left")


def flag_totals(long_df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Passed, suspect, erroneous counts and shares per group of a frame with one flag column."""
    f = F.col(flag)
    n = F.count(F.lit(1))
    return long_df.groupBy(*keys).agg(
        n.alias("observations"),
        F.count_if(f == "PASS").alias("passed"),
        F.count_if(f == "SUSPECT").alias("suspect"),
        F.count_if(f == "ERROR").alias("errors"),
        F.round(F.count_if(f == "PASS") * 100.0 / n, 4).alias("passed_pct"),
    )


# --- products -----------------------------------------------------------------------------------


def period_means(long_df: DataFrame, keys: list[str], ts: str, period: str, value: str = "value") -> DataFrame:
    """Time series of hourly / daily / monthly means: period is hour, day, month or year."""
    return long_df.groupBy(*keys, F.date_trunc(period, F.col(ts)).cast("timestamp_ntz").alias("period")).agg(
        F.avg(F.col(value).cast("double")).alias("mean"), F.count(value).alias("n")
    )


def rolled_means(long_df: DataFrame, keys: list[str], ts: str, periods: list[str], value: str = "value") -> DataFrame:
    """Means at several resolutions, finest first: sums and counts of the finest are rolled up in one grouping."""
    x = F.col(value).cast("double")
    finest = F.date_trunc(periods[0], F.col(ts)).cast("timestamp_ntz")
    sums = long_df.groupBy(*keys, finest.alias("_at")).agg(F.sum(x).alias("_sum"), F.count(x).alias("_n"))
    levels = F.array(*[
        F.struct(F.lit(p).alias("resolution"), F.date_trunc(p, F.col("_at")).cast("timestamp_ntz").alias("period")) for p in periods
    ])
    spread = sums.select(*keys, "_sum", "_n", F.explode(levels).alias("_level")).select(*keys, "_sum", "_n", "_level.*")
    rolled = spread.groupBy("resolution", *keys, "period").agg((F.sum("_sum") / F.sum("_n")).alias("mean"), F.sum("_n").alias("n"))
    return rolled.select("resolution", *keys, "period", "mean", "n")


def monthly_climatology(long_df: DataFrame, keys: list[str], ts: str, value: str = "value") -> DataFrame:
    x = F.col(value).cast("double")
    return long_df.groupBy(*keys, F.month(ts).alias("month")).agg(
        F.avg(x).alias("mean"), F.min(x).alias("minimum"), F.max(x).alias("maximum"), F.count(x).alias("n")
    )


def daily_extremes(df: DataFrame, keys: list[str], local_date: str, temperature: str, rain: str) -> DataFrame:
    t, r = F.col(temperature).cast("double"), F.col(rain).cast("double")
    return df.groupBy(*keys, local_date).agg(
        F.max(t).alias("maximum_temperature"), F.min(t).alias("minimum_temperature"),
        F.sum(r).alias("precipitation_total"),
    )


def histogram(long_df: DataFrame, keys: list[str], width: float, low: float = 0.0, value: str = "value") -> DataFrame:
    x = F.col(value).cast("double")
    return (
        long_df.filter(x.isNotNull())
        .groupBy(*keys, F.floor((x - low) / width).cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_start", F.col("bin") * width + low)
    )


def heat_map(df: DataFrame, row: str, column: Column, values: list[int], measure: Column, name: str) -> DataFrame:
    """Row x column table of a measure, one output column per listed value."""
    table = df.withColumn("_col", column).groupBy(row).pivot("_col", values).agg(measure)
    return table.select(row, *[F.col(str(v)).alias(f"{name}_{v}") for v in values])


# Class limits of the wind rose in knots; the last class is open.
SPEED_CLASSES = [1.0, 7.0, 14.0, 21.0, 28.0]


def wind_rose(df: DataFrame, direction: str, speed: str, limits: list[float] | None = None) -> DataFrame:
    """Counts by 16 sectors and speed class with shares of all wind observations; calm is sector -1."""
    limits = limits or SPEED_CLASSES
    d, v = F.col(direction).cast("double"), F.col(speed).cast("double")
    speed_class = F.lit(0)
    for limit in limits:
        speed_class = speed_class + (v >= limit).cast("int")
    calm = v == 0
    sector = F.when(calm, -1).otherwise(F.floor(F.pmod(d + 11.25, F.lit(360.0)) / 22.5).cast("int"))
    counts = (
        df.filter(v.isNotNull() & (calm | d.isNotNull()))
        .groupBy(sector.alias("sector"), F.when(calm, 0).otherwise(speed_class).alias("speed_class"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most 17 x 7 rows are left, so a total over all of them is one small window.
    return counts.withColumn("share_pct", F.round(F.col("n") * 100.0 / F.sum("n").over(W.partitionBy()), 4))


def missing_summary(long_df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    n = F.count(F.lit(1))
    miss = F.count_if(F.col(value).isNull())
    return long_df.groupBy(*keys).agg(
        n.alias("observations"), miss.alias("missing"), F.round(miss * 100.0 / n, 4).alias("missing_pct")
    )


def duplicate_summary(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys occurring more than once and how often."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
