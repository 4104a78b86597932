"""The whole quality run: every rule that is on, from the identity of a row to the completeness of its day.

Findings have three grains, and all of them end in one code array of the record they belong to:

* **the row**: identity, time, values, types, units, limits, relations between variables: projections;
* **the station's time**: steps, spikes, persistence, patterns, repeated times, running totals: one pass over
  ordered frames for all checks of all variables. Variables stay columns, so no long form is sorted;
* **the station's day**: expected hours and daily totals: one aggregate of a small row a day, joined
  back. Hours received are a bit mask, so runs of missing hours are bit arithmetic on neighbouring days.

The last, and the order of rows in their source file, need few columns: they are worked out beside the wide rows and
come to them by one exchange on the record. Rows without a station or a time are not checked along
time, and never stand between rows that are.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsguard.catalogs import dimensions as dim
from obsguard.catalogs import rulebook as R
from obsguard.functions import scalars as S
from obsguard.operators import row_rules as RR
from obsguard.operators import temporal as TP
from obsguard.operators.coded import Item, Results, assess_codes
from obsguard.operators.framework import Check, flag_when
from obsguard.operators.frames import SLICE_DAYS
from obsguard.operators.joins import enrich_from_stations
from obsguard.plans.quality import observation_frame_checks

STATION, TIME = "station_id", "datetime_utc"
REGULAR_REPORTS = ("LOCAL_OBSERVATION", "HISTORICAL_OBSERVATION", "METAR")


@dataclass(frozen=True)
class Settings:
    """What a run is told besides the rules.

    ``limits``: variable -> (physical minimum, maximum, operational minimum, maximum), each may be None;
    ``thresholds``: variable -> (step per hour, spike); ``raw_types``: column of raw text -> declared type;
    ``categories``: column -> code list; ``units``: variable -> (column with the unit given, unit wanted).
    """

    as_of: str
    first_day: str
    last_day: str
    variables: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    limits: dict[str, tuple[float | None, float | None, float | None, float | None]] = field(default_factory=dict)
    thresholds: dict[str, tuple[float, float]] = field(default_factory=dict)
    raw_types: dict[str, str] = field(default_factory=dict)
    categories: dict[str, str] = field(default_factory=dict)
    units: dict[str, tuple[str, str]] = field(default_factory=dict)
    hourly_amount: str = "accumulated_precipitation_mm"
    daily_amount: str = "daily_precipitation_mm"
    first_hour: int = TP.FIRST_HOUR
    last_hour: int = TP.LAST_HOUR


# --- rows ---------------------------------------------------------------------------------------

_TYPE_RULES = {"integer": "datatype_invalid", "number": "datatype_invalid_numeric", "boolean": "datatype_invalid_boolean"}


def type_checks(raw_types: dict[str, str]) -> list[Check]:
    return [c for column, dtype in raw_types.items() for c in RR.datatype_checks({column: dtype}, _TYPE_RULES.get(dtype, "datatype_invalid"))]


def category_checks(categories: dict[str, str]) -> list[Check]:
    rule = "datatype_invalid_category"
    return [Check(rule, RR.category_flag(F.col(c), domain, R.RULES[rule].flag), c) for c, domain in categories.items()]


def limit_checks(limits: dict[str, tuple[float | None, ...]]) -> list[Check]:
    """The four range rules of every variable with limits; a limit that is not given is not checked."""
    names = ("range_below_physical_minimum", "range_above_physical_maximum", "range_below_operational_minimum", "range_above_operational_maximum")
    out = []
    for variable, bounds in limits.items():
        x = F.col(variable).cast("double")
        for rule, bound, below in zip(names, bounds, (True, False, True, False), strict=True):
            if bound is None:
                out.append(Check(rule, F.lit("NOT_CHECKED"), variable))
            else:
                out.append(Check(rule, flag_when(x < bound if below else x > bound, R.RULES[rule].flag, [x]), variable))
    return out


def unit_checks(units: dict[str, tuple[str, str]]) -> list[Check]:
    """The three unit rules of every variable that states its unit; spellings come from the catalogue's own table."""
    known = {r[0]: r for r in dim._rows(dim.UNITS_TEXT)}
    spelled = {name: r[0] for r in known.values() for name in [r[0], r[1], r[7], *(r[8] or "").split(";")] if name}
    by_name = F.create_map(*[F.lit(x) for kv in spelled.items() for x in kv])
    base = F.create_map(*[F.lit(x) for r in known.values() for x in (r[0], r[3])])
    out = []
    for variable, (column, wanted) in units.items():
        given = F.col(column)
        found = F.try_element_at(by_name, given)
        other = F.try_element_at(base, found) != F.lit(known[wanted][3])
        for rule, bad, needs in (
            ("unit_unknown", found.isNull(), [given]), ("unit_incompatible", other, [found]), ("unit_non_canonical", found != F.lit(wanted), [found]),
        ):
            out.append(Check(rule, flag_when(bad, R.RULES[rule].flag, needs), variable))
    return out


def row_grain(df: DataFrame, settings: Settings) -> list[Check]:
    local = [r for r in RR.row_rule_ids() if R.RULES[r].enabled]
    return (
        RR.row_checks(df, local, as_of=settings.as_of)
        + RR.null_value_checks(list(settings.variables))
        + RR.null_value_checks(list(settings.required), "completeness_required_variable")
        + type_checks(settings.raw_types) + category_checks(settings.categories)
        + limit_checks(settings.limits) + unit_checks(settings.units)
    )


# --- along a station's time ---------------------------------------------------------------------

_GENERIC = ("temporal_step", "temporal_spike", "temporal_persistence", "temporal_repeated_pattern")


def repeated_time(name: str, ts: str) -> TP.FrameCheck:
    """A row at the same time as the row before it in its station; the first of them passes."""

    def stage(w) -> dict[str, Column]:
        return {name: F.when(F.coalesce(F.lag(F.col(ts)).over(w) == F.col(ts), F.lit(False)), "ERROR").otherwise("PASS")}

    return TP.FrameCheck(name, 1, [stage])


def time_frames(settings: Settings) -> list[TP.FrameCheck]:
    out = observation_frame_checks(TIME)
    out.append(repeated_time("datetime_duplicate_observation", TIME))
    out.append(TP.decreasing_accumulation("temporal_non_monotonic_accumulation", settings.hourly_amount, "local_date"))
    out.append(TP.enough_rows("_enough", 3))
    for variable, (per_hour, spike) in settings.thresholds.items():
        out += [
            TP.step(f"temporal_step {variable}", variable, TIME, per_hour), TP.spike(f"temporal_spike {variable}", variable, spike),
            TP.persistence(f"temporal_persistence {variable}", variable, 6, 0.0), TP.repeated_pattern(f"temporal_repeated_pattern {variable}", variable),
        ]
    return out


_REPORTED = {
    "temperature_persistence": "air_temperature_c", "temperature_temporal_step": "air_temperature_c", "humidity_persistence": "relative_humidity_pct",
    "pressure_temporal_change": "qnh_hpa", "wind_persistence": "wind_speed_kt", "wind_temporal_speed_change": "wind_speed_kt",
    "visibility_temporal_change": "prevailing_visibility_m", "datetime_duplicate_observation": TIME,
}


def time_grain(settings: Settings, placed: Column) -> list[Check]:
    """Checks that read the frames' columns; rows without a place in time are not checked."""
    out = []
    for frame in time_frames(settings):
        if frame.name == "_enough":
            continue
        rule, _, variable = frame.name.partition(" ")
        checked = placed & F.col("_enough") if rule in _GENERIC else placed
        variable = variable or _REPORTED.get(rule) or settings.hourly_amount
        out.append(Check(rule, F.when(checked, F.col(f"`{frame.name}`")).otherwise("NOT_CHECKED"), variable))
    return out


# --- a station's day ----------------------------------------------------------------------------


def day_facts(obs: DataFrame, settings: Settings) -> DataFrame:
    """(_station, local_date, _some_missing, _run_missing, _total) of every station's day with rows.

    Bit h of the mask is set when the hour was received on the hour by a regular report. A run of two
    missing hours lies inside the day, or over its edge: the last hour of the day before, or the first of the
    day after, is missing too. A day without rows misses all hours; days outside the period expect none.
    """
    first, last = settings.first_hour, settings.last_hour
    hour = F.hour("local_ts")
    counts = (F.minute("local_ts") == 0) & hour.between(first, last) & F.col("report_type").isin(*REGULAR_REPORTS)
    days = (
        obs.filter(F.col("_station").isNotNull() & F.col("local_date").isNotNull())
        .groupBy("_station", "local_date")
        .agg(
            F.coalesce(F.bit_or(F.when(counts, F.expr(f"shiftleft(1, hour(local_ts) - {first})"))), F.lit(0)).alias("_mask"),
            F.round(F.sum(F.col(settings.hourly_amount).cast("double")), 6).alias("_total"),
        )
    )
    slots = last - first + 1
    inside = F.col("local_date").between(F.lit(settings.first_day).cast("date"), F.lit(settings.last_day).cast("date"))
    lost = F.col("_mask").bitwiseXOR(F.lit((1 << slots) - 1))
    days = days.withColumns({"_inside": inside, "_lost": lost})
    w = W.partitionBy("_station").orderBy("local_date")

    def beside(shift, days_away: int, bit: int) -> Column:
        """Is the expected hour next to the day's edge missing on the neighbouring day?"""
        there = F.date_add("local_date", days_away)
        next_to = shift("local_date").over(w) == there
        missing = F.when(F.coalesce(next_to, F.lit(False)), shift("_lost").over(w).bitwiseAND(F.lit(1 << bit)) != 0).otherwise(F.lit(True))
        return missing & there.between(F.lit(settings.first_day).cast("date"), F.lit(settings.last_day).cast("date"))

    edge_before = (lost.bitwiseAND(F.lit(1)) != 0) & beside(F.lag, -1, slots - 1)
    edge_after = (lost.bitwiseAND(F.lit(1 << (slots - 1))) != 0) & beside(F.lead, 1, 0)
    run = (F.col("_lost").bitwiseAND(F.shiftleft("_lost", 1)) != 0) | edge_before | edge_after
    return days.select(
        "_station", "local_date", "_total", F.when(F.col("_inside"), F.col("_lost") != 0).alias("_some_missing"),
        F.when(F.col("_inside"), run).alias("_run_missing"),
    )


def day_grain(settings: Settings) -> list[Check]:
    """Findings of the record's own day; a day outside the period, or no day at all, is not checked."""
    gap = F.round(F.abs(F.col("_total") - F.col(settings.daily_amount).cast("double")), 6)
    some, run = F.col("_some_missing"), F.col("_run_missing")
    return [
        Check("completeness_expected_observations", flag_when(some, "MISSING", [some]), TIME),
        Check("completeness_consecutive_missing", flag_when(run, "SUSPECT", [run]), TIME),
        Check(
            "precipitation_accumulation_inconsistent", flag_when(gap > 0.1, "SUSPECT", [F.col("_total"), F.col(settings.daily_amount)]),
            settings.daily_amount,
        ),
    ]


# --- the run ------------------------------------------------------------------------------------


def evaluate_all(
    obs: DataFrame, stations: DataFrame, settings: Settings, row_key: str = "record_id", slice_days: float = SLICE_DAYS
) -> tuple[DataFrame, list[Item]]:
    """``obs`` with ``local_date`` and the code of every check in ``qc_codes``, and what the codes stand for.

    ``obs`` has typed columns named by the contract, ``datetime_utc`` and a unique ``row_key``; columns that
    a rule needs and the frame lacks count as null. A station listed twice multiplies nothing.
    """
    absent = {c: F.lit(None).cast("double") for c in _numbers(settings) if c not in obs.columns}
    absent |= {c: F.lit(None).cast("string") for c in ("report_type",) if c not in obs.columns}
    known = enrich_from_stations(obs.withColumns(absent) if absent else obs, stations, STATION, ["timezone"])
    zone = F.coalesce("timezone", F.lit(TP.FALLBACK_ZONE))
    name = F.upper(F.trim(F.col(STATION).cast("string")))
    known = known.withColumns(
        {"_station": F.when(name != "", name), "local_ts": S.local_time(F.col(TIME), zone)}
    ).withColumn("local_date", F.to_date("local_ts"))
    results = Results(known)
    results.add(row_grain(known, settings))

    placed = F.col("_station").isNotNull() & F.col(TIME).isNotNull()
    # rows without a place in time take no part: each is a group of its own, so they do not gather in one task
    results.transform(lambda df: df.withColumn("_alone", F.when(~placed, F.xxhash64(row_key))))
    results.transform(TP.apply_checks, ["_station", "_alone"], [TIME, row_key], time_frames(settings), slice_days)
    results.add(time_grain(settings, placed), [f.name for f in time_frames(settings)])
    beside, items = beside_rows(known, settings, row_key).finish("_beside")
    coded, own = results.finish("_own")
    out = coded.join(beside.select(row_key, "_beside"), row_key).withColumn("qc_codes", F.concat("_own", "_beside"))
    return out.drop("_own", "_beside", "_station", "_alone", "local_ts", "station_known", *absent), own + items


def _numbers(settings: Settings) -> list[str]:
    """Columns that rules compare as numbers whatever the frame has."""
    fixed = ["relative_humidity_pct", "wind_direction_deg", "prevailing_visibility_m", "minimum_temperature_c", "maximum_temperature_c"]
    paired = ["air_temperature_c", "dew_point_temperature_c", "wind_speed_kt", "wind_gust_kt", "qnh_hpa", "qfe_hpa"]
    given = [settings.hourly_amount, settings.daily_amount, *settings.limits, *settings.thresholds, *settings.variables, *settings.required]
    return list(dict.fromkeys([*fixed, *paired, *given]))


def beside_rows(known: DataFrame, settings: Settings, row_key: str) -> Results:
    """Findings from the order of the source file and from the station's day, over the few columns they need."""
    placed = ["source_file", "source_row"]
    columns = ["_station", "local_date", "local_ts", TIME, "report_type", settings.hourly_amount, settings.daily_amount]
    have = [c for c in (row_key, *columns, *placed) if c in known.columns]
    narrow = known.select(*have)
    order = "datetime_non_chronological"
    days = day_facts(narrow, settings)
    if all(c in have for c in placed):
        checked = TP.apply_checks(narrow, ["_station", "source_file"], ["source_row", row_key], [TP.out_of_source_order("_order", TIME)])
        listed = F.col("_station").isNotNull() & F.col("source_file").isNotNull() & F.col("source_row").isNotNull()
        flag = F.when(listed, F.col("_order")).otherwise("NOT_CHECKED")
    else:
        checked, flag = narrow, F.lit("NOT_CHECKED")
    results = Results(checked).add([Check(order, flag, TIME)])
    results.transform(lambda df: df.join(days, ["_station", "local_date"], "left"))
    return results.add(day_grain(settings))


def whole_quality(
    obs: DataFrame, stations: DataFrame, settings: Settings, row_key: str = "record_id", slice_days: float = SLICE_DAYS
) -> tuple[DataFrame, list[Item]]:
    """The final dataset: every record with its codes and its assessment over all rules that are on."""
    coded, items = evaluate_all(obs, stations, settings, row_key, slice_days)
    return assess_codes(coded, items), items


def stage_of(rule_id: str) -> str:
    module = R.RULES[rule_id].module
    return next(stage for stage, modules in R.STAGE_MODULES.items() if module in modules)
