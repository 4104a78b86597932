"""The catalogue of checks: identifier, module, flag raised, whether it is on by default."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Code and severity of a flag, and its penalty on the score.
FLAG_CODES = {"PASS": 0, "SUSPECT": 1, "ERROR": 2, "MISSING": 3, "NOT_CHECKED": 8, "NOT_APPLICABLE": 9}
FLAG_SEVERITY = {
    "PASS": "info", "SUSPECT": "warning", "ERROR": "error", "MISSING": "warning",
    "NOT_CHECKED": "info", "NOT_APPLICABLE": "info",
}
SCORE_START = 100
SCORE_PENALTIES = {"SUSPECT": 10, "ERROR": 30, "MISSING": 15}

# Worst first; the numeric codes above are not ordered by severity.
FLAG_ORDER = ["ERROR", "MISSING", "SUSPECT", "PASS", "NOT_CHECKED", "NOT_APPLICABLE"]

# Identifiers of the checks by module, flag and default state ("off" where disabled).
RULES_TEXT = """\
identity|identity_missing_station_id|ERROR|on|METADATA
identity|identity_invalid_station_id|ERROR|on|METADATA
identity|identity_missing_source_file|SUSPECT|on|METADATA
identity|identity_missing_source_row|SUSPECT|on|METADATA
identity|identity_missing_report_type|SUSPECT|on|METADATA
identity|identity_invalid_report_type|ERROR|on|METADATA
datetime|datetime_missing|ERROR|on|METADATA
datetime|datetime_invalid_date|ERROR|on|METADATA
datetime|datetime_invalid_time|ERROR|on|METADATA
datetime|datetime_invalid_timezone|ERROR|on|METADATA
datetime|datetime_future|ERROR|on|TEMPORAL
datetime|datetime_implausible_historical|ERROR|on|TEMPORAL
datetime|datetime_duplicate_observation|ERROR|on|DUPLICATE
datetime|datetime_non_chronological|SUSPECT|on|TEMPORAL
completeness|completeness_null_value|MISSING|on|MISSING
completeness|completeness_required_variable|MISSING|on|MISSING
completeness|completeness_expected_observations|MISSING|on|MISSING
completeness|completeness_consecutive_missing|SUSPECT|on|MISSING
datatype|datatype_invalid|ERROR|on|METADATA
datatype|datatype_invalid_numeric|ERROR|on|METADATA
datatype|datatype_invalid_boolean|ERROR|on|METADATA
datatype|datatype_invalid_category|ERROR|on|METADATA
units|unit_unknown|ERROR|on|METADATA
units|unit_incompatible|ERROR|on|METADATA
units|unit_non_canonical|SUSPECT|on|METADATA
physical_range|range_below_physical_minimum|ERROR|on|OUT_OF_RANGE
physical_range|range_above_physical_maximum|ERROR|on|OUT_OF_RANGE
physical_range|range_below_operational_minimum|SUSPECT|on|OUT_OF_RANGE
physical_range|range_above_operational_maximum|SUSPECT|on|OUT_OF_RANGE
temperature|temperature_dew_point_above_air|ERROR|on|CONSISTENCY
temperature|temperature_wet_bulb_inconsistent|SUSPECT|on|CONSISTENCY
temperature|temperature_daily_extremes_inconsistent|ERROR|on|CONSISTENCY
temperature|temperature_outside_daily_extremes|SUSPECT|on|CONSISTENCY
temperature|temperature_persistence|SUSPECT|on|TEMPORAL
temperature|temperature_temporal_step|SUSPECT|on|TEMPORAL
humidity|humidity_invalid_range|ERROR|on|OUT_OF_RANGE
humidity|humidity_dew_point_inconsistent|SUSPECT|on|CONSISTENCY
humidity|humidity_persistence|SUSPECT|on|TEMPORAL
pressure|pressure_temporal_change|SUSPECT|on|TEMPORAL
pressure|pressure_qnh_qfe_relationship|SUSPECT|on|CONSISTENCY
pressure|pressure_elevation_consistency|SUSPECT|off|CONSISTENCY
wind|wind_direction_range|ERROR|on|OUT_OF_RANGE
wind|wind_variable_direction|NOT_APPLICABLE|on|CONSISTENCY
wind|wind_calm_consistency|SUSPECT|on|CONSISTENCY
wind|wind_gust_below_mean_speed|ERROR|on|CONSISTENCY
wind|wind_gust_significance|SUSPECT|on|CONSISTENCY
wind|wind_directional_extremes_inconsistent|SUSPECT|on|CONSISTENCY
wind|wind_persistence|SUSPECT|on|TEMPORAL
wind|wind_temporal_speed_change|SUSPECT|on|TEMPORAL
visibility|visibility_minimum_above_prevailing|ERROR|on|CONSISTENCY
visibility|visibility_second_minimum_without_first|ERROR|on|CONSISTENCY
visibility|visibility_minimum_direction_missing|SUSPECT|on|CONSISTENCY
visibility|visibility_cavok_inconsistent|ERROR|on|CONSISTENCY
visibility|visibility_temporal_change|SUSPECT|on|TEMPORAL
present_weather|weather_invalid_code|ERROR|on|METADATA
present_weather|weather_duplicate_code|SUSPECT|on|DUPLICATE
present_weather|weather_visibility_inconsistent|SUSPECT|on|CONSISTENCY
present_weather|weather_precipitation_cloud_inconsistent|SUSPECT|on|CONSISTENCY
present_weather|weather_thunderstorm_inconsistent|SUSPECT|on|CONSISTENCY
clouds|cloud_invalid_amount|ERROR|on|METADATA
clouds|cloud_invalid_type|ERROR|on|METADATA
clouds|cloud_negative_height|ERROR|on|OUT_OF_RANGE
clouds|cloud_amount_without_height|ERROR|on|CONSISTENCY
clouds|cloud_height_without_amount|ERROR|on|CONSISTENCY
clouds|cloud_layers_not_ordered|SUSPECT|on|CONSISTENCY
clouds|cloud_vertical_visibility_inconsistent|ERROR|on|CONSISTENCY
clouds|cloud_nsc_inconsistent|ERROR|on|CONSISTENCY
precipitation|precipitation_negative|ERROR|on|OUT_OF_RANGE
precipitation|precipitation_period_missing|SUSPECT|on|METADATA
precipitation|precipitation_weather_inconsistent|SUSPECT|on|CONSISTENCY
precipitation|precipitation_accumulation_inconsistent|SUSPECT|on|CONSISTENCY
cross_variable_consistency|consistency_dew_point_temperature|ERROR|on|CONSISTENCY
cross_variable_consistency|consistency_gust_speed|ERROR|on|CONSISTENCY
cross_variable_consistency|consistency_qnh_qfe|SUSPECT|on|CONSISTENCY
cross_variable_consistency|consistency_temperature_extremes|ERROR|on|CONSISTENCY
cross_variable_consistency|consistency_humidity_dew_point|SUSPECT|on|CONSISTENCY
cross_variable_consistency|consistency_cavok|ERROR|on|CONSISTENCY
temporal|temporal_step|SUSPECT|on|TEMPORAL
temporal|temporal_spike|SUSPECT|on|TEMPORAL
temporal|temporal_persistence|SUSPECT|on|TEMPORAL
temporal|temporal_repeated_pattern|SUSPECT|on|TEMPORAL
temporal|temporal_non_monotonic_accumulation|SUSPECT|on|TEMPORAL
climatology|climatology_percentile|SUSPECT|off|CLIMATOLOGY
climatology|climatology_z_score|SUSPECT|off|CLIMATOLOGY
climatology|climatology_robust_z_score|SUSPECT|off|CLIMATOLOGY
climatology|climatology_interquartile_range|SUSPECT|off|CLIMATOLOGY
climatology|climatology_median_absolute_deviation|SUSPECT|off|CLIMATOLOGY
spatial|spatial_neighbor_difference|SUSPECT|off|CONSISTENCY
spatial|spatial_isolated_extreme|SUSPECT|off|CONSISTENCY
statistical|statistical_interquartile_range|SUSPECT|off|STATISTICAL
statistical|statistical_median_absolute_deviation|SUSPECT|off|STATISTICAL
statistical|statistical_rolling_z_score|SUSPECT|off|STATISTICAL
"""

# The modules each quality-control stage runs.
STAGE_MODULES = {
    "basic": ["identity", "datetime", "completeness", "datatype", "units", "physical_range"],
    "meteorological": [
        "temperature", "humidity", "pressure", "wind", "visibility", "present_weather", "clouds",
        "precipitation", "cross_variable_consistency",
    ],
    "advanced": ["temporal", "climatology", "spatial", "statistical"],
}

# Checks written as text expressions over rule names, and the rule name -> column map.
EXPRESSION_RULES = {
    "consistency_dew_point_temperature": "dewpoint_temp_c <= air_temp_c + 0.2",
    "consistency_gust_speed": "wind_gust_kt >= wind_speed_kt",
    "consistency_qnh_qfe": "qnh_hpa >= qfe_hpa - 1.0",
    "consistency_temperature_extremes": "minimum_daily_temperature_c <= maximum_daily_temperature_c",
}
COLUMN_ALIASES = {
    "air_temp_c": "air_temperature_c",
    "dewpoint_temp_c": "dew_point_temperature_c",
    "wet_bulb_temp_c": "wet_bulb_temperature_c",
    "maximum_daily_temperature_c": "maximum_temperature_c",
    "minimum_daily_temperature_c": "minimum_temperature_c",
    "relative_humidity": "relative_humidity_pct",
    "wind_dir": "wind_direction_deg",
    "visibility_m": "prevailing_visibility_m",
    "visibility_min_1_m": "minimum_visibility_1_m",
    "visibility_min_2_m": "minimum_visibility_2_m",
}


@dataclass(frozen=True)
class Rule:
    module: str
    rule_id: str
    flag: str
    enabled: bool
    category: str


RULES: dict[str, Rule] = {
    r.rule_id: r
    for r in (
        Rule(m, i, f, state == "on", c)
        for m, i, f, state, c in (line.split("|") for line in RULES_TEXT.strip("\n").split("\n"))
    )
}


def rules_of(*modules: str, include_disabled: bool = False) -> list[str]:
    return [r.rule_id for r in RULES.values() if r.module in modules and (r.enabled or include_disabled)]


def rules_of_stage(stage: str, include_disabled: bool = False) -> list[str]:
    return rules_of(*STAGE_MODULES[stage], include_disabled=include_disabled)


def rules_df(spark: SparkSession) -> DataFrame:
    rows = [(r.rule_id, r.module, r.flag, FLAG_SEVERITY[r.flag], r.enabled, r.category) for r in RULES.values()]
    return spark.createDataFrame(
        rows, "rule_id string, module string, flag string, severity string, enabled boolean, category string"
    )
