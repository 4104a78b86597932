"""The quality-control stages over the canonical table.

Row checks are one projection. All checks that look along time share one exchange on the station
and one sort. Rows in equal rows out: every stage only adds columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsguard.catalogs import rulebook as R
from obsguard.functions import scalars as S
from obsguard.operators import canonical as C
from obsguard.operators import temporal as TP
from obsguard.operators.framework import Check, assess, evaluate
from obsguard.operators.frames import SLICE_DAYS
from obsguard.operators.joins import enrich_from_stations
from obsguard.operators.row_rules import limit_flags, null_value_checks, row_checks

STATION, TIME = "station_id", "datetime_utc"


def observation_frame_checks(ts: str = TIME) -> list[TP.FrameCheck]:
    """The checks of the weather modules that follow one station in time."""
    return [
        TP.persistence("temperature_persistence", "air_temperature_c", 6, 0.1, 80.0),
        TP.step("temperature_temporal_step", "air_temperature_c", ts, 12.0, 30, 90),
        TP.persistence("humidity_persistence", "relative_humidity_pct", 8, 1.0),
        TP.step("pressure_temporal_change", "qnh_hpa", ts, 10.0),
        TP.persistence(
            "wind_persistence", "wind_speed_kt", 8, 0.0,
            also=("wind_direction_deg", 0.0, "wind_speed_kt", 3.0),
        ),
        TP.step("wind_temporal_speed_change", "wind_speed_kt", ts, 40.0),
        TP.step("visibility_temporal_change", "prevailing_visibility_m", ts, 9000.0),
    ]


def long_frame_checks(ts: str = TIME, value: str = "value") -> list[TP.FrameCheck]:
    """The generic checks per (station, variable); limits come from the joined threshold columns."""
    return [
        TP.step("temporal_step", value, ts, "step_per_hour"),
        TP.spike("temporal_spike", value, "spike"),
        TP.persistence("temporal_persistence", value, 6, 0.0),
        TP.repeated_pattern("temporal_repeated_pattern", value),
        TP.enough_rows("enough_rows", 3),
    ]


def with_flags(df: DataFrame, flags: dict[str, str], observed: str | None = None) -> DataFrame:
    """Move flag columns {rule_id: variable} into the results array."""
    checks = [
        Check(rule, F.col(rule), variable, F.col(observed or variable) if (observed or variable) in df.columns else None)
        for rule, variable in flags.items()
    ]
    return evaluate(df, checks).drop(*flags)


def basic_quality(
    obs: DataFrame,
    stations: DataFrame,
    as_of: str,
    duplicate_key: list[str] | None = None,
    row_key: str = "record_id",
    null_columns: list[str] | None = None,
) -> DataFrame:
    """Identity, time, completeness of values and duplicates."""
    fields = ["timezone"] + [c for c in ("elevation_m", "latitude", "longitude", "aerodrome_name") if c in stations.columns]
    known = enrich_from_stations(obs, stations, STATION, fields)
    marked = TP.mark_duplicates(
        known, duplicate_key or [STATION, TIME], [row_key], "datetime_duplicate_observation"
    ).drop("duplicate_count")
    flagged = evaluate(
        marked,
        row_checks(marked, R.rules_of("identity", "datetime"), as_of=as_of)
        + null_value_checks(null_columns or []),
    )
    return with_flags(flagged, {"datetime_duplicate_observation": TIME})


def meteorological_quality(
    obs: DataFrame, row_key: str = "record_id", slice_days: float = SLICE_DAYS
) -> DataFrame:
    """Checks between variables of a row and along one station's time."""
    row_level = evaluate(obs, row_checks(obs, R.rules_of_stage("meteorological")))
    along = TP.apply_checks(
        row_level, [STATION], [TIME, row_key], observation_frame_checks(), slice_days
    )
    variables = {
        "temperature_persistence": "air_temperature_c", "temperature_temporal_step": "air_temperature_c",
        "humidity_persistence": "relative_humidity_pct", "pressure_temporal_change": "qnh_hpa",
        "wind_persistence": "wind_speed_kt", "wind_temporal_speed_change": "wind_speed_kt",
        "visibility_temporal_change": "prevailing_visibility_m",
    }
    return with_flags(along, variables)


def advanced_quality(
    long_df: DataFrame, thresholds: DataFrame, row_key: str = "record_id", ts: str = TIME,
    slice_days: float = SLICE_DAYS,
) -> DataFrame:
    """Generic temporal checks on the long form; groups under three rows are not checked."""
    with_limits = long_df.join(thresholds, "variable", "left")
    flagged = TP.apply_checks(
        with_limits, [STATION, "variable"], [ts, row_key], long_frame_checks(ts), slice_days
    )
    names = ["temporal_step", "temporal_spike", "temporal_persistence", "temporal_repeated_pattern"]
    gated = flagged.withColumns(
        {n: F.when(F.col("enough_rows"), F.col(n)).otherwise("NOT_CHECKED") for n in names}
    )
    return gated.drop("enough_rows", *[c for c in thresholds.columns if c != "variable"])


def range_quality(long_df: DataFrame, limits: DataFrame) -> DataFrame:
    """Physical and operational limits per variable; without a limit a value is not checked."""
    out = limit_flags(long_df.join(limits, "variable", "left"))
    return out.drop(*[c for c in limits.columns if c != "variable"])


def final_quality(
    obs: DataFrame, stations: DataFrame, as_of: str, row_key: str = "record_id",
    null_columns: list[str] | None = None, slice_days: float = SLICE_DAYS,
) -> DataFrame:
    """Basic and meteorological stages with the per-observation assessment."""
    basic = basic_quality(obs, stations, as_of, row_key=row_key, null_columns=null_columns)
    return assess(meteorological_quality(basic, row_key, slice_days))


def prepare(
    rows: DataFrame,
    types: dict[str, str],
    at: str,
    run_id: str,
    versions: tuple[str, str] = ("1", "1"),
    typos: DataFrame | None = None,
    start_month: int = 1,
) -> DataFrame:
    """Consolidated text rows to typed canonical values: text, case, typing errors, types, time, identity."""
    text = C.normalize_text(rows, [c for c in types if c in rows.columns])
    cased = C.normalize_case(text, at)
    if typos is not None:
        for field in ("report_status", "station_id"):
            cased = C.fix_known_typos(cased, typos, field, at)
    typed = C.parse_columns(cased, types)
    timed = C.with_datetime(typed, start_month)
    return C.with_technical_columns(timed, run_id, at, *versions)


def add_local_time(obs: DataFrame, zone: str = "timezone", ts: str = TIME) -> DataFrame:
    return obs.withColumn("local_ts", S.local_time(F.col(ts), F.col(zone)))
