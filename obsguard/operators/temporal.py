"""Checks along time: step, spike, persistence, repeated pattern, accumulation, rolling z-score.

Each check is a list of stages; a stage maps a window to named columns and may use the columns of
the stage before. All checks of a call share one window specification, hence one exchange and one
sort, and run through :func:`over_ordered_groups`, which evaluates groups in slices.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F

from obsguard.functions import scalars as S
from obsguard.operators.framework import flag_when
from obsguard.operators.frames import SLICE_DAYS, SLICE_NUMBERS, over_ordered_groups
from obsguard.operators.joins import one_row_each

Stage = Callable[[WindowSpec], dict[str, Column]]


@dataclass(frozen=True)
class FrameCheck:
    name: str
    reach: int
    stages: list[Stage] = field(default_factory=list)


def apply_checks(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    checks: list[FrameCheck],
    slice_days: float = SLICE_DAYS,
) -> DataFrame:
    """Add one column per check (its name); helper columns are dropped again."""
    names = {c.name for c in checks}
    depth = max(len(c.stages) for c in checks)

    def compute(frame: DataFrame, w: WindowSpec) -> DataFrame:
        helpers: list[str] = []
        for level in range(depth):
            columns: dict[str, Column] = {}
            for c in checks:
                if level < len(c.stages):
                    columns.update(c.stages[level](w))
            frame = frame.withColumns(columns)
            helpers += [n for n in columns if n not in names]
        return frame.drop(*helpers)

    return over_ordered_groups(df, keys, order, max(c.reach for c in checks), compute, slice_days)


def _limit(given: float | str) -> Column:
    """A constant, or the column holding the limit of each row."""
    return F.col(given).cast("double") if isinstance(given, str) else F.lit(float(given))


def step(
    name: str,
    value: str,
    ts: str,
    per_hour: float | str,
    min_gap_min: float | None = None,
    max_gap_min: float | None = None,
    flag: str = "SUSPECT",
) -> FrameCheck:
    """Absolute change per hour against the previous observation; outside the gap gate not checked."""

    def stage(w: WindowSpec) -> dict[str, Column]:
        limit = _limit(per_hour)
        x = F.col(value).cast("double")
        before, t0 = F.lag(x).over(w), F.lag(F.col(ts)).over(w)
        hours = S.hours_between(F.col(ts), t0)
        outside = F.coalesce(hours <= 0, F.lit(True))
        if min_gap_min is not None:
            outside = outside | (hours < min_gap_min / 60.0)
        if max_gap_min is not None:
            outside = outside | (hours > max_gap_min / 60.0)
        rate = F.round(F.abs(x - before) / hours, 6)
        return {name: flag_when(rate > limit, flag, [x, before, limit], skip=outside)}

    return FrameCheck(name, 1, [stage])


def spike(name: str, value: str, threshold: float | str, flag: str = "SUSPECT") -> FrameCheck:
    """Three-point test: |x - (p+n)/2| - |n-p|/2 above the threshold."""

    def stage(w: WindowSpec) -> dict[str, Column]:
        limit = _limit(threshold)
        x = F.col(value).cast("double")
        p, n = F.lag(x).over(w), F.lead(x).over(w)
        size = F.round(F.abs(x - (p + n) / 2) - F.abs(n - p) / 2, 6)
        return {name: flag_when(size > limit, flag, [x, p, n, limit])}

    return FrameCheck(name, 1, [stage])


def persistence(
    name: str,
    value: str,
    n: int,
    tolerance: float,
    coverage_pct: float = 100.0,
    flag: str = "SUSPECT",
    also: tuple[str, float, str, float] | None = None,
) -> FrameCheck:
    """n consecutive observations varying by at most ``tolerance``; every member is flagged.

    ``also = (column, tolerance, gate_column, gate_minimum)``: where the gate column is at least the
    minimum over the whole run, that column must be constant too (wind direction at 3 kt and more).
    """
    hit, full = f"_{name}_hit", f"_{name}_full"

    def detect(w: WindowSpec) -> dict[str, Column]:
        x = F.col(value).cast("double")
        run = w.rowsBetween(-(n - 1), 0)
        present = F.count(x).over(run) * 100.0 >= n * coverage_pct
        still = F.round(F.max(x).over(run) - F.min(x).over(run), 6) <= tolerance
        if also is not None:
            other, tol, gate, least = also
            o, g = F.col(other).cast("double"), F.col(gate).cast("double")
            turning = F.round(F.max(o).over(run) - F.min(o).over(run), 6) > tol
            still = still & ~((F.min(g).over(run) >= least) & F.coalesce(turning, F.lit(False)))
        whole = F.count(F.lit(1)).over(run) == n
        return {
            full: (whole & present).cast("int"),
            hit: (whole & present & F.coalesce(still, F.lit(False))).cast("int"),
        }

    def spread(w: WindowSpec) -> dict[str, Column]:
        ahead = w.rowsBetween(0, n - 1)
        found, covered = F.max(hit).over(ahead), F.max(full).over(ahead)
        return {name: flag_when(found == 1, flag, [F.col(value)], skip=covered == 0)}

    return FrameCheck(name, n - 1, [detect, spread])


def repeated_pattern(name: str, value: str, length: int = 3, times: int = 3, flag: str = "SUSPECT") -> FrameCheck:
    """A block of ``length`` values seen ``times`` times in a row; constant blocks do not count."""
    total = length * times
    same, hit, full = f"_{name}_same", f"_{name}_hit", f"_{name}_full"

    def compare(w: WindowSpec) -> dict[str, Column]:
        x = F.col(value).cast("double")
        return {same: F.coalesce(x == F.lag(x, length).over(w), F.lit(False)).cast("int")}

    def detect(w: WindowSpec) -> dict[str, Column]:
        x = F.col(value).cast("double")
        tail, block = w.rowsBetween(-(total - length - 1), 0), w.rowsBetween(-(length - 1), 0)
        whole = F.count(F.lit(1)).over(w.rowsBetween(-(total - 1), 0)) == total
        repeats = F.min(same).over(tail) == 1
        varied = F.max(x).over(block) > F.min(x).over(block)
        return {full: whole.cast("int"), hit: (whole & repeats & F.coalesce(varied, F.lit(False))).cast("int")}

    def spread(w: WindowSpec) -> dict[str, Column]:
        ahead = w.rowsBetween(0, total - 1)
        return {
            name: flag_when(
                F.max(hit).over(ahead) == 1, flag, [F.col(value)], skip=F.max(full).over(ahead) == 0
            )
        }

    return FrameCheck(name, total - 1, [compare, detect, spread])


def decreasing_accumulation(name: str, value: str, reset: str | None = None, flag: str = "SUSPECT") -> FrameCheck:
    """A running total below its predecessor within the same reset period."""

    def stage(w: WindowSpec) -> dict[str, Column]:
        x = F.col(value).cast("double")
        before = F.lag(x).over(w)
        other = F.lit(False) if reset is None else ~F.col(reset).eqNullSafe(F.lag(F.col(reset)).over(w))
        return {name: flag_when(x < before, flag, [x, before], skip=other)}

    return FrameCheck(name, 1, [stage])


def rolling_z(name: str, value: str, rows: int = 30, threshold: float = 4.0, flag: str = "SUSPECT") -> FrameCheck:
    """Distance from the mean of the previous ``rows`` observations in their standard deviations."""

    def stage(w: WindowSpec) -> dict[str, Column]:
        x = F.col(value).cast("double")
        past = w.rowsBetween(-rows, -1)
        mean, std = F.avg(x).over(past), F.stddev_samp(x).over(past)
        short = (F.count(x).over(past) < rows) | F.coalesce(std <= 0, F.lit(True))
        return {name: flag_when(F.round(F.abs(x - mean) / std, 6) > threshold, flag, [x], skip=short)}

    return FrameCheck(name, rows, [stage])


def enough_rows(name: str, least: int = 3) -> FrameCheck:
    """True where the group has at least ``least`` rows, seen through a bounded frame."""

    def stage(w: WindowSpec) -> dict[str, Column]:
        return {name: F.count(F.lit(1)).over(w.rowsBetween(-(least - 1), least - 1)) >= least}

    return FrameCheck(name, least - 1, [stage])


def out_of_source_order(name: str, ts: str, flag: str = "SUSPECT") -> FrameCheck:
    """Time earlier than the predecessor's; the window must be ordered by source position."""

    def stage(w: WindowSpec) -> dict[str, Column]:
        before = F.lag(F.col(ts)).over(w)
        return {name: flag_when(F.col(ts) < before, flag, [F.col(ts), before])}

    return FrameCheck(name, 1, [stage])


# --- duplicates ---------------------------------------------------------------------------------


def mark_duplicates(df: DataFrame, key: list[str], first_by: list[str], name: str = "duplicate_flag") -> DataFrame:
    """Group size, and ERROR on every row of a key but the first (by ``first_by``, which must be unique).

    A row with a null in its key cannot be compared: NOT_CHECKED. One pre-aggregated row per repeated
    key is joined back; a group of copies, or of rows without a key, is never gathered.
    """
    rank = F.struct(*[F.col(c) for c in first_by])
    comparable = S.all_of([F.col(k).isNotNull() for k in key])
    groups = (
        df.filter(comparable).groupBy(*key)
        .agg(F.count(F.lit(1)).alias("duplicate_count"), F.min(rank).alias("_first"))
        .filter(F.col("duplicate_count") > 1)
    )
    renamed = groups.select(*[F.col(k).alias(f"_d_{k}") for k in key], "duplicate_count", "_first")
    on = S.all_of([F.col(k) == F.col(f"_d_{k}") for k in key])
    joined = df.join(renamed, on, "left")
    return joined.withColumns(
        {
            "duplicate_count": F.coalesce("duplicate_count", F.lit(1)),
            name: F.when(~comparable, "NOT_CHECKED")
            .when(F.col("_first").isNotNull() & (rank != F.col("_first")), "ERROR")
            .otherwise("PASS"),
        }
    ).drop("_first", *[f"_d_{k}" for k in key])


def duplicate_ordinals(
    df: DataFrame, key: list[str], exact: list[str], order: str, numbers: int = SLICE_NUMBERS
) -> DataFrame:
    """Add ``duplicate_ordinal`` and ``duplicate_kind`` of every row among the rows with its ``key``.

    The ordinal counts from 1 by ``order``, a unique number. The kind is ``first``, ``exact`` where an earlier row has the same
    ``exact`` fields, else ``key``; a row with a null in its key is ``not_checked`` and has no ordinal.
    A key's rows are counted in slices of ``order``; a row's ordinal is its place in the slice and the
    count of the slices before, so copies of one key never gather. Equal contents meet as one pre-aggregated row.
    """
    comparable = S.all_of([F.col(k).isNotNull() for k in key])
    rows = df.withColumns({"_slice": F.floor(F.col(order) / F.lit(numbers)), "_same": F.xxhash64(*exact), "_fit": comparable})
    known = rows.filter("_fit")
    counts = known.groupBy(*key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy(*key).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select(*key, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # equal contents are compared by their fields; the hash only finds candidates
    firsts = known.groupBy(*key, "_same", *[F.col(c).alias(f"_x_{c}") for c in exact]).agg(F.min(order).alias("_first"))
    inside = W.partitionBy(*key, "_slice").orderBy(order)
    placed = known.withColumn("_k", F.row_number().over(inside)).join(counts, [*key, "_slice"])
    same = S.all_of([F.col(c).eqNullSafe(F.col(f"_x_{c}")) for c in exact])
    renamed = firsts.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("_same").alias("_same2"), *[f"_x_{c}" for c in exact], "_first")
    on = S.all_of([F.col(k) == F.col(f"_k_{k}") for k in key]) & (F.col("_same") == F.col("_same2")) & same
    ordinal = F.col("_before") + F.col("_k")
    out = placed.join(renamed, on).withColumns(
        {
            "duplicate_ordinal": ordinal,
            "duplicate_kind": F.when(ordinal == 1, "first").when(F.col(order) > F.col("_first"), "exact").otherwise("key"),
        }
    ).select(*df.columns, "duplicate_ordinal", "duplicate_kind")
    others = rows.filter(~F.col("_fit")).select(
        *df.columns, F.lit(None).cast("bigint").alias("duplicate_ordinal"), F.lit("not_checked").alias("duplicate_kind")
    )
    return out.unionByName(others)


# --- completeness -------------------------------------------------------------------------------

# The expected local hours of a day (inclusive).
FIRST_HOUR, LAST_HOUR = 6, 19
FALLBACK_ZONE = "America/Lima"


def expected_grid(
    stations: DataFrame, first_day: str, last_day: str, station: str = "station_id",
    first_hour: int = FIRST_HOUR, last_hour: int = LAST_HOUR,
) -> DataFrame:
    """(station, local_date, expected_hours) for every day of the period and every station of the catalogue: a
    silent station is expected too, and a wrong date of a report stretches nothing. Hours are bits of one number,
    bit 6 for six o'clock, so a station's day is one row."""
    days = F.sequence(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"), F.expr("interval 1 day"))
    hours = sum(1 << h for h in range(first_hour, last_hour + 1))
    return (
        stations.filter(F.col(station).isNotNull()).select(station).distinct()
        .select(station, F.explode(days).alias("local_date"), F.lit(hours).alias("expected_hours"))
    )


def with_station_zone(
    observations: DataFrame, stations: DataFrame, station: str = "station_id", zone: str = "timezone"
) -> DataFrame:
    """Add the station's zone; an unknown station, or one without a zone, gets the fallback zone."""
    known = one_row_each(stations.select(F.col(station).alias("_of"), F.col(zone).alias("_zone")), ["_of"])
    joined = observations.join(known, F.col(station) == F.col("_of"), "left")
    return joined.withColumn(zone, F.coalesce("_zone", F.lit(FALLBACK_ZONE))).drop("_of", "_zone")


def received_hours(
    observations: DataFrame, station: str = "station_id", local_ts: str = "local_ts",
    report_type: str | None = None,
) -> DataFrame:
    """(station, local_date, received_hours): the hours received on the hour as bits, one row a day, combined on the map side.

    Only reports of minute 0 count; SPECI and other special reports are additional, as are those of
    unknown type where a type is given.
    """
    obs = observations.filter(F.minute(local_ts) == 0)
    if report_type is not None:
        obs = obs.filter(F.col(report_type).isin("LOCAL_OBSERVATION", "HISTORICAL_OBSERVATION", "METAR"))
    bit = F.expr(f"shiftleft(1, hour(`{local_ts}`))")
    return obs.groupBy(station, F.to_date(local_ts).alias("local_date")).agg(F.bit_or(bit).alias("received_hours"))


def _compared(grid: DataFrame, received: DataFrame, station: str) -> DataFrame:
    """The expected days with the hours received of those expected, and the hours missing."""
    got = F.col("expected_hours").bitwiseAND(F.coalesce("received_hours", F.lit(0)))
    joined = grid.join(received, [station, "local_date"], "left").withColumn("_got", got)
    return joined.withColumn("_lost", F.col("expected_hours").bitwiseXOR(F.col("_got")))


def missing_hours(grid: DataFrame, received: DataFrame, station: str = "station_id") -> DataFrame:
    """(station, local_date, local_hour) of every expected hour that was not received."""
    lost = F.filter(F.sequence(F.lit(0), F.lit(23)), lambda h: F.getbit(F.col("_lost"), h) == 1)
    return _compared(grid, received, station).select(station, "local_date", F.explode(lost).alias("local_hour"))


def completeness(grid: DataFrame, received: DataFrame, station: str = "station_id") -> DataFrame:
    """Expected, received, missing and percentage per (station, local date)."""
    count = lambda c: F.bit_count(c).cast("bigint")
    return _compared(grid, received, station).select(
        station, "local_date", count("expected_hours").alias("expected"), count("_got").alias("received"), count("_lost").alias("missing")
    ).withColumn("completeness_pct", F.round(F.col("received") * 100.0 / F.col("expected"), 2))


def missing_runs(
    grid: DataFrame, received: DataFrame, least: int = 2, station: str = "station_id",
    first_hour: int = FIRST_HOUR, last_hour: int = LAST_HOUR,
) -> DataFrame:
    """Runs of at least ``least`` consecutive expected hours that were not received.

    The position of an hour on the expected grid is arithmetic (day number and hour), so only the
    missing hours are numbered; a station's grid is bounded by its days, not by its rows.
    """
    per_day = last_hour - first_hour + 1
    slot = F.unix_date("local_date").cast("bigint") * per_day + F.col("local_hour") - first_hour
    gaps = missing_hours(grid, received, station).withColumn("_slot", slot)
    island = F.col("_slot") - F.row_number().over(W.partitionBy(station).orderBy("_slot"))
    start = F.min(F.struct("local_date", "local_hour"))
    end = F.max(F.struct("local_date", "local_hour"))
    return (
        gaps.withColumn("_island", island)
        .groupBy(station, "_island")
        .agg(F.count(F.lit(1)).alias("missing_count"), start.alias("_s"), end.alias("_e"))
        .filter(F.col("missing_count") >= least)
        .select(
            station, "missing_count",
            F.col("_s.local_date").alias("first_date"), F.col("_s.local_hour").alias("first_hour"),
            F.col("_e.local_date").alias("last_date"), F.col("_e.local_hour").alias("last_hour"),
        )
    )


def daily_accumulation_flags(
    df: DataFrame, station: str, local_date: str, hourly: str, daily: str, tolerance: float = 0.1
) -> DataFrame:
    """Sum of the hourly amounts of a local day against the reported daily amount."""
    keys = [station, local_date]
    sums = df.groupBy(*keys).agg(F.round(F.sum(F.col(hourly).cast("double")), 6).alias("_sum"))
    right = sums.select(*[F.col(k).alias(f"_a_{k}") for k in keys], "_sum")
    on = S.all_of([F.col(k).eqNullSafe(F.col(f"_a_{k}")) for k in keys])
    gap = F.round(F.abs(F.col("_sum") - F.col(daily).cast("double")), 6)
    return (
        df.join(right, on, "left")
        .withColumn(
            "precipitation_accumulation_inconsistent",
            flag_when(gap > tolerance, "SUSPECT", [F.col("_sum"), F.col(daily)]),
        )
        .drop("_sum", *[f"_a_{k}" for k in keys])
    )
