"""Row checks of the catalogue, one query each, and the framework around them."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverage_queries import bindings as B
from coverage_queries.registry import query, register
from obsguard.catalogs import dimensions as dim
from obsguard.catalogs import rulebook as R
from obsguard.functions import scalars as S
from obsguard.operators import canonical as C
from obsguard.operators import framework as FW
from obsguard.operators import row_rules as RR
from obsguard.operators import summary as SM
from obsguard.operators.joins import enrich_from_stations, resolve_units

AS_OF = "2024-01-20 00:00:00"


# --- the same checks, written as SQL over the wide observations ---------------------------------


def _case(bad: str, flag: str, unchecked: str | None = None) -> str:
    first = f"WHEN {unchecked} THEN 'NOT_CHECKED' " if unchecked else ""
    return f"CASE {first}WHEN {bad} THEN '{flag}' ELSE 'PASS' END"


def _any(template: str) -> str:
    return "(" + " OR ".join(template.replace("#", str(i)) for i in (1, 2, 3)) + ")"


def _all(template: str) -> str:
    return "(" + " AND ".join(template.replace("#", str(i)) for i in (1, 2, 3)) + ")"


def _count(template: str) -> str:
    return "(" + " + ".join(f"CASE WHEN {template.replace('#', str(i))} THEN 1 ELSE 0 END" for i in (1, 2, 3)) + ")"


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"


T, TD, TW, RH = "air_temperature_c", "dew_point_temperature_c", "wet_bulb_temperature_c", "relative_humidity_pct"
TMAX, TMIN = "maximum_temperature_c", "minimum_temperature_c"
VIS, V1, V2 = "prevailing_visibility_m", "minimum_visibility_1_m", "minimum_visibility_2_m"
DIR, CCW, CW = "wind_direction_deg", "wind_direction_ccw_deg", "wind_direction_cw_deg"
SPD, GUST = "wind_speed_kt", "wind_gust_kt"
RAIN = "accumulated_precipitation_mm"
_ES = "6.112 * exp(17.62 * {0} / (243.12 + {0}))"
_WRAP = "(({0}) - 360 * floor(({0}) / 360))"
_PRECIP = "DZ|RA|SN|SG|IC|PL|GR|GS|UP"
_PHENOMENA = _PRECIP + "|FG|BR|HZ|FU|DU|SA|VA|PO|SQ|FC|SS|DS"
_WEATHER_RE = f"^[+-]?((MI|BC|PR|DR|BL|SH|TS|FZ)({_PHENOMENA})*|({_PHENOMENA})+)$"
_NO_CODES = _all("present_weather_# IS NULL")
_RAINING = _any(f"coalesce(regexp_matches(present_weather_#, '{_PRECIP}'), FALSE)")
_NO_AMOUNTS = _all("cloud_amount_# IS NULL")
_NO_HEIGHTS = _all("cloud_base_height_#_ft IS NULL")
_CLEAR = "('NSC', 'NCD', 'SKC', 'CLR')"
_TOWER = _any("coalesce(cloud_type_# IN ('CB', 'TCU'), FALSE)")

_HUMIDITY = _case(
    f"round(abs({RH} - 100 * ({_ES.format(TD)}) / ({_ES.format(T)})), 6) > 5", "SUSPECT",
    f"{RH} IS NULL OR {T} IS NULL OR {TD} IS NULL",
)
_CAVOK = (
    "CASE WHEN metar IS NULL THEN 'NOT_CHECKED' WHEN metar NOT LIKE '%CAVOK%' THEN 'NOT_APPLICABLE'"
    f" WHEN coalesce({VIS} < 10000, FALSE) OR NOT {_NO_CODES} OR {_TOWER} OR "
    + _any(
        f"coalesce(cloud_amount_# NOT IN {_CLEAR} AND (cloud_base_height_#_ft IS NULL OR cloud_base_height_#_ft < 5000), FALSE)"
    )
    + " THEN 'ERROR' ELSE 'PASS' END"
)
_ORDER = (
    "coalesce(cloud_base_height_2_ft < cloud_base_height_1_ft, FALSE)"
    " OR coalesce(cloud_base_height_3_ft < coalesce(cloud_base_height_2_ft, cloud_base_height_1_ft), FALSE)"
)

ROW_SQL = {
    "identity_missing_station_id": _case(_blank("station_id"), "ERROR"),
    "identity_missing_source_file": _case(_blank("source_file"), "SUSPECT"),
    "identity_missing_source_row": _case(_blank("source_row"), "SUSPECT"),
    "identity_missing_report_type": _case(_blank("report_type"), "SUSPECT"),
    "identity_invalid_report_type": _case(
        "report_type NOT IN ('METAR','SPECI','TAF','LOCAL_OBSERVATION','HISTORICAL_OBSERVATION')", "ERROR",
        "report_type IS NULL",
    ),
    "datetime_missing": _case(
        "year IS NULL OR month IS NULL OR day IS NULL OR hour_utc IS NULL OR minute IS NULL", "ERROR"
    ),
    "datetime_invalid_date": _case(
        "TRY_CAST(year || '-' || month || '-' || day AS DATE) IS NULL", "ERROR",
        "year IS NULL OR month IS NULL OR day IS NULL",
    ),
    "datetime_invalid_time": _case(
        "hour_utc NOT BETWEEN 0 AND 23 OR minute NOT BETWEEN 0 AND 59", "ERROR",
        "hour_utc IS NULL OR minute IS NULL",
    ),
    "datetime_invalid_timezone": _case("timezone_declared <> 'UTC'", "ERROR", "timezone_declared IS NULL"),
    "datetime_future": _case(
        f"datetime_utc > TIMESTAMP '{AS_OF}' + INTERVAL 10 MINUTE", "ERROR", "datetime_utc IS NULL"
    ),
    "datetime_implausible_historical": _case(
        "datetime_utc < TIMESTAMP '1900-01-01 00:00:00'", "ERROR", "datetime_utc IS NULL"
    ),
    "temperature_dew_point_above_air": _case(f"round({TD} - {T}, 6) > 0.2", "ERROR", f"{T} IS NULL OR {TD} IS NULL"),
    "temperature_wet_bulb_inconsistent": _case(
        f"coalesce(round({TD} - {TW}, 6) > 0.5, FALSE) OR coalesce(round({TW} - {T}, 6) > 0.5, FALSE)", "SUSPECT",
        f"{TW} IS NULL OR ({T} IS NULL AND {TD} IS NULL)",
    ),
    "temperature_daily_extremes_inconsistent": _case(f"{TMIN} > {TMAX}", "ERROR", f"{TMIN} IS NULL OR {TMAX} IS NULL"),
    "temperature_outside_daily_extremes": _case(
        f"round({TMIN} - {T}, 6) > 0.5 OR round({T} - {TMAX}, 6) > 0.5", "SUSPECT",
        f"{T} IS NULL OR {TMIN} IS NULL OR {TMAX} IS NULL",
    ),
    "humidity_invalid_range": _case(f"{RH} < 0 OR {RH} > 100", "ERROR", f"{RH} IS NULL"),
    "humidity_dew_point_inconsistent": _HUMIDITY,
    "consistency_humidity_dew_point": _HUMIDITY,
    "pressure_qnh_qfe_relationship": _case(
        "round(qfe_hpa - qnh_hpa, 6) > 1.0", "SUSPECT", "qnh_hpa IS NULL OR qfe_hpa IS NULL"
    ),
    "pressure_elevation_consistency": _case(
        "round(abs(qfe_hpa - qnh_hpa * pow(1 - 0.0065 * elevation_m / 288.15, 5.255)), 6) > 20", "SUSPECT",
        "qnh_hpa IS NULL OR qfe_hpa IS NULL OR elevation_m IS NULL",
    ),
    "wind_direction_range": _case(f"{DIR} < 0 OR {DIR} > 360", "ERROR", f"{DIR} IS NULL"),
    "wind_variable_direction": _case("wind_direction_raw = 'VRB'", "NOT_APPLICABLE", "wind_direction_raw IS NULL"),
    "wind_calm_consistency": _case(f"{SPD} = 0 AND {DIR} IS NOT NULL AND {DIR} <> 0", "SUSPECT", f"{SPD} IS NULL"),
    "wind_gust_below_mean_speed": _case(f"{GUST} < {SPD}", "ERROR", f"{GUST} IS NULL OR {SPD} IS NULL"),
    "wind_gust_significance": _case(
        f"{GUST} - {SPD} >= 0 AND {GUST} - {SPD} < 10", "SUSPECT", f"{GUST} IS NULL OR {SPD} IS NULL"
    ),
    "wind_directional_extremes_inconsistent": _case(
        f"({CCW} IS NULL) <> ({CW} IS NULL) OR {_WRAP.format(f'{DIR} - {CCW}')} > {_WRAP.format(f'{CW} - {CCW}')}",
        "SUSPECT",
        f"({CCW} IS NULL AND {CW} IS NULL) OR ({CCW} IS NOT NULL AND {CW} IS NOT NULL AND {DIR} IS NULL)",
    ),
    "visibility_minimum_above_prevailing": _case(
        f"coalesce({V1} > {VIS}, FALSE) OR coalesce({V2} > {VIS}, FALSE)", "ERROR",
        f"{VIS} IS NULL OR ({V1} IS NULL AND {V2} IS NULL)",
    ),
    "visibility_second_minimum_without_first": _case(
        f"{V2} IS NOT NULL AND {V1} IS NULL", "ERROR", f"{V1} IS NULL AND {V2} IS NULL"
    ),
    "visibility_minimum_direction_missing": _case(
        f"({V1} IS NOT NULL AND minimum_visibility_direction_1 IS NULL)"
        f" OR ({V2} IS NOT NULL AND minimum_visibility_direction_2 IS NULL)", "SUSPECT",
        f"{V1} IS NULL AND {V2} IS NULL",
    ),
    "visibility_cavok_inconsistent": _CAVOK,
    "consistency_cavok": _CAVOK,
    "weather_invalid_code": _case(
        _any(f"coalesce(NOT regexp_matches(present_weather_#, '{_WEATHER_RE}'), FALSE)"), "ERROR", _NO_CODES
    ),
    "weather_duplicate_code": _case(
        "coalesce(present_weather_1 = present_weather_2, FALSE) OR coalesce(present_weather_1 = present_weather_3, FALSE)"
        " OR coalesce(present_weather_2 = present_weather_3, FALSE)", "SUSPECT", _NO_CODES,
    ),
    "weather_visibility_inconsistent": _case(
        "(" + _any("coalesce(present_weather_# IN ('FG', 'FZFG'), FALSE)") + f" AND {VIS} >= 1000) OR ("
        + _any("coalesce(present_weather_# = 'BR', FALSE)") + f" AND ({VIS} < 1000 OR {VIS} > 5000))",
        "SUSPECT",
        f"{VIS} IS NULL OR NOT " + _any("coalesce(present_weather_# IN ('FG', 'FZFG', 'BR'), FALSE)"),
    ),
    "weather_precipitation_cloud_inconsistent": _case(
        f"{_RAINING} AND NOT " + _any(f"coalesce(cloud_amount_# NOT IN {_CLEAR}, FALSE)"), "SUSPECT", _NO_CODES
    ),
    "weather_thunderstorm_inconsistent": _case(
        _any("coalesce(contains(present_weather_#, 'TS'), FALSE)") + f" AND NOT {_TOWER}", "SUSPECT", _NO_CODES
    ),
    "cloud_invalid_amount": _case(
        _any("coalesce(cloud_amount_# NOT IN ('SKC','CLR','FEW','SCT','BKN','OVC','NSC','NCD','VV'), FALSE)"),
        "ERROR", _NO_AMOUNTS,
    ),
    "cloud_invalid_type": _case(
        _any("coalesce(cloud_type_# NOT IN ('CB', 'TCU'), FALSE)"), "ERROR", _all("cloud_type_# IS NULL")
    ),
    "cloud_negative_height": _case(_any("coalesce(cloud_base_height_#_ft < 0, FALSE)"), "ERROR", _NO_HEIGHTS),
    "cloud_amount_without_height": _case(
        _any("coalesce(cloud_amount_# NOT IN ('NSC','NCD','SKC','VV') AND cloud_base_height_#_ft IS NULL, FALSE)"),
        "ERROR", _NO_AMOUNTS,
    ),
    "cloud_height_without_amount": _case(
        _any("(cloud_base_height_#_ft IS NOT NULL AND cloud_amount_# IS NULL)"), "ERROR", _NO_HEIGHTS
    ),
    "cloud_layers_not_ordered": _case(_ORDER, "SUSPECT", _count("cloud_base_height_#_ft IS NOT NULL") + " < 2"),
    "cloud_vertical_visibility_inconsistent": _case(
        _any("coalesce(cloud_amount_# = 'VV', FALSE)") + " AND ("
        + _count("cloud_amount_# IS NOT NULL OR cloud_base_height_#_ft IS NOT NULL") + " > 1 OR "
        + _any("coalesce(cloud_amount_# = 'VV' AND cloud_base_height_#_ft IS NULL, FALSE)") + ")",
        "ERROR", _NO_AMOUNTS,
    ),
    "cloud_nsc_inconsistent": _case(
        _any("coalesce(cloud_amount_# IN ('NSC','NCD','SKC'), FALSE)") + " AND "
        + _count("cloud_amount_# IS NOT NULL") + " > 1", "ERROR", _NO_AMOUNTS,
    ),
    "precipitation_negative": _case(
        f"coalesce({RAIN} < 0, FALSE) OR coalesce(daily_precipitation_mm < 0, FALSE)", "ERROR",
        f"{RAIN} IS NULL AND daily_precipitation_mm IS NULL",
    ),
    "precipitation_period_missing": _case("precipitation_period IS NULL", "SUSPECT", f"{RAIN} IS NULL"),
    "precipitation_weather_inconsistent": _case(f"({RAIN} > 0.1) <> {_RAINING}", "SUSPECT", f"{RAIN} IS NULL"),
    "consistency_dew_point_temperature": _case(f"NOT ({TD} <= {T} + 0.2)", "ERROR", f"{T} IS NULL OR {TD} IS NULL"),
    "consistency_gust_speed": _case(f"NOT ({GUST} >= {SPD})", "ERROR", f"{GUST} IS NULL OR {SPD} IS NULL"),
    "consistency_qnh_qfe": _case(
        "NOT (qnh_hpa >= qfe_hpa - 1.0)", "SUSPECT", "qnh_hpa IS NULL OR qfe_hpa IS NULL"
    ),
    "consistency_temperature_extremes": _case(
        f"NOT ({TMIN} <= {TMAX})", "ERROR", f"{TMIN} IS NULL OR {TMAX} IS NULL"
    ),
}

TIMED_CTE = f"{B.WIDE_CTE}, timed AS (SELECT *, {B.SQL_TIME} AS datetime_utc FROM obs)"


def _row_rule(rule_id: str):
    def run(spark, sf_dir):
        df = C.with_datetime(B.wide(spark, sf_dir))
        (check,) = RR.row_checks(df, [rule_id], as_of=AS_OF)
        return df.select("event_id", check.flag.alias("flag"))

    return run


for _rule_id, _sql in ROW_SQL.items():
    register(
        f"rule_{_rule_id}", _row_rule(_rule_id), f"WITH {TIMED_CTE} SELECT event_id, {_sql} AS flag FROM timed"
    )


@query(
    "rule_identity_invalid_station_id",
    f"""WITH {B.WIDE_CTE}, {B.OPEN_STATION_CTE}
    SELECT o.event_id, CASE WHEN {_blank('o.station_id')} THEN 'NOT_CHECKED'
      WHEN s.station_id IS NULL THEN 'ERROR' ELSE 'PASS' END AS flag
    FROM obs o LEFT JOIN stations s ON trim(o.station_id) = s.station_id""",
)
def invalid_station(spark, sf_dir):
    df = enrich_from_stations(B.wide(spark, sf_dir), B.stations(spark, sf_dir, open_only=True), fields=["timezone"])
    (check,) = RR.row_checks(df, ["identity_invalid_station_id"])
    return df.select("event_id", check.flag.alias("flag"))


# --- completeness of values ---------------------------------------------------------------------

NULL_COLUMNS = [T, TD, RH, "qnh_hpa", SPD, VIS]


def _null_flags(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT event_id, '{c}' AS variable, CASE WHEN {c} IS NULL THEN 'MISSING' ELSE 'PASS' END AS flag FROM obs"
        for c in columns
    )


@query("rule_completeness_null_value", f"WITH {B.WIDE_CTE} {_null_flags(NULL_COLUMNS)}")
def null_values(spark, sf_dir):
    df = FW.evaluate(B.wide(spark, sf_dir), RR.null_value_checks(NULL_COLUMNS))
    return SM.findings(df, ["event_id"]).select("event_id", "variable", "flag")


# Enabled and implemented variables of the catalogue that the observations carry.
REQUIRED = [
    "accumulated_precipitation_mm", "air_temperature_c", "cloud_base_height_1_ft", "dew_point_temperature_c",
    "maximum_temperature_c", "minimum_temperature_c", "minimum_visibility_1_m", "minimum_visibility_2_m",
    "prevailing_visibility_m", "qfe_hpa", "qnh_hpa", "relative_humidity_pct", "wet_bulb_temperature_c",
    "wind_direction_ccw_deg", "wind_direction_cw_deg", "wind_direction_deg", "wind_gust_kt", "wind_speed_kt",
    "cloud_base_height_2_ft", "cloud_base_height_3_ft",
]


def required_variables(spark) -> list[str]:
    """Catalogue variables with a unit that are enabled and implemented; a table of 75 rows."""
    chosen = dim.select_variables(dim.variables(spark), enabled=True, implemented=True, role="observed")
    return [r[0] for r in chosen.filter(F.col("unit").isNotNull()).select("canonical_name").collect()]


@query(
    "rule_completeness_required_variable",
    f"WITH {B.WIDE_CTE}, found AS ({_null_flags(REQUIRED)})"
    " SELECT variable, count(*) AS observations, count(*) FILTER (flag = 'MISSING') AS missing FROM found GROUP BY variable",
)
def required_values(spark, sf_dir):
    df = B.wide(spark, sf_dir)
    columns = [c for c in required_variables(spark) if c in df.columns]
    found = SM.findings(
        FW.evaluate(df, RR.null_value_checks(columns, "completeness_required_variable")), ["event_id"]
    )
    return found.groupBy("variable").agg(
        F.count(F.lit(1)).alias("observations"), F.count_if(F.col("flag") == "MISSING").alias("missing")
    )


# --- data types, categories, units, ranges ------------------------------------------------------

# Raw texts as they would come out of a file, readable or not.
RAW = {
    "raw_integer": "CASE event_id % 5 WHEN 0 THEN CAST(k AS STRING) WHEN 1 THEN concat(CAST(k AS STRING), '.5')"
    " WHEN 2 THEN 'x' WHEN 3 THEN NULL ELSE ' 7 ' END",
    "raw_number": "CASE event_id % 4 WHEN 0 THEN concat(CAST(k AS STRING), ',25') WHEN 1 THEN 'n/d'"
    " WHEN 2 THEN NULL ELSE CAST(k AS STRING) END",
    "raw_boolean": "CASE event_id % 5 WHEN 0 THEN 'true' WHEN 1 THEN 'no' WHEN 2 THEN 'maybe' WHEN 3 THEN NULL ELSE '1' END",
}
RAW_CTE = f"{B.BASE_CTE}, raw AS (SELECT event_id, " + ", ".join(f"{e} AS {n}" for n, e in RAW.items()) + " FROM base)"


def raw(spark, sf_dir):
    return B.base(spark, sf_dir).selectExpr("event_id", *[f"{e} AS {n}" for n, e in RAW.items()])


_BAD_INT = "TRY_CAST(trim(raw_integer) AS DOUBLE) IS NULL OR TRY_CAST(trim(raw_integer) AS DOUBLE) <> floor(TRY_CAST(trim(raw_integer) AS DOUBLE))"
_BAD_NUM = "TRY_CAST(replace(trim(raw_number), ',', '.') AS DOUBLE) IS NULL"
_BAD_BOOL = "lower(trim(raw_boolean)) NOT IN ('t','true','y','yes','1','f','false','n','no','0')"


def _type_rule(column: str, dtype: str, rule: str, bad: str):
    def run(spark, sf_dir):
        df = raw(spark, sf_dir)
        (check,) = RR.datatype_checks({column: dtype}, rule)
        return df.select("event_id", check.flag.alias("flag"))

    sql = f"WITH {RAW_CTE} SELECT event_id, {_case(bad, 'ERROR', f'{column} IS NULL')} AS flag FROM raw"
    register(f"rule_{rule}", run, sql)


_type_rule("raw_integer", "integer", "datatype_invalid", _BAD_INT)
_type_rule("raw_number", "number", "datatype_invalid_numeric", _BAD_NUM)
_type_rule("raw_boolean", "boolean", "datatype_invalid_boolean", _BAD_BOOL)


@query(
    "rule_datatype_invalid_category",
    f"""WITH {B.WIDE_CTE} SELECT event_id, {_case("cloud_amount_1 NOT IN ('SKC','CLR','FEW','SCT','BKN','OVC','NSC','NCD','VV')", 'ERROR', 'cloud_amount_1 IS NULL')} AS flag,
    'NOT_CHECKED' AS no_domain_flag FROM obs""",
)
def invalid_category(spark, sf_dir):
    c = F.col("cloud_amount_1")
    return B.wide(spark, sf_dir).select(
        "event_id",
        RR.category_flag(c, "cloud_codes").alias("flag"),
        RR.category_flag(c, "sea_state_codes").alias("no_domain_flag"),
    )


# Every variable arrives in some unit; the target is the catalogue's.
UNIT_BINDING = {
    "unit": "CASE event_id % 7 WHEN 0 THEN 'kt' WHEN 1 THEN 'mps' WHEN 2 THEN 'kph' WHEN 3 THEN 'hPa' WHEN 4 THEN 'furlong'"
    " WHEN 5 THEN NULL ELSE 'knots' END",
}
UNIT_CTE = f"{B.BASE_CTE}, given AS (SELECT event_id, value, {UNIT_BINDING['unit']} AS unit FROM base)"
# (alias, unit, base unit, factor) of the spellings above.
_UNIT_VALUES = (
    "u(alias, unit_id, base_unit, factor) AS (VALUES ('kt','speed_knot','speed_meter_per_second',0.5144444444),"
    "('knots','speed_knot','speed_meter_per_second',0.5144444444),"
    "('mps','speed_meter_per_second','speed_meter_per_second',1.0),"
    "('kph','speed_kilometer_per_hour','speed_meter_per_second',0.2777777778),"
    "('hPa','pressure_hectopascal','pressure_pascal',100.0))"
)


def given_units(spark, sf_dir):
    df = B.base(spark, sf_dir).selectExpr("event_id", "value", f"{UNIT_BINDING['unit']} AS unit")
    units = dim.units(spark)
    resolved = resolve_units(df, "unit", dim.unit_aliases(spark), units)
    return RR.unit_flags(
        resolved.withColumn("target_unit", F.lit("speed_knot")).withColumn(
            "target_base", F.lit("speed_meter_per_second")
        )
    )


_UNIT_SQL = {
    "unit_unknown": _case("u.unit_id IS NULL", "ERROR", "g.unit IS NULL"),
    "unit_incompatible": _case("u.base_unit <> 'speed_meter_per_second'", "ERROR", "u.unit_id IS NULL"),
    "unit_non_canonical": _case("u.unit_id <> 'speed_knot'", "SUSPECT", "u.unit_id IS NULL"),
}
for _rule_id, _sql in _UNIT_SQL.items():
    register(
        f"rule_{_rule_id}",
        (lambda r: lambda spark, sf_dir: given_units(spark, sf_dir).select("event_id", F.col(r).alias("flag")))(_rule_id),
        f"WITH {UNIT_CTE}, {_UNIT_VALUES} SELECT g.event_id, {_sql} AS flag FROM given g LEFT JOIN u ON g.unit = u.alias",
    )

# Caller-supplied limits: one variable has none, so its values are not checked.
LIMITS = [
    ("click", 1.0, 300.0, 5.0, 120.0), ("view", 0.5, 200.0, 2.0, 100.0), ("purchase", 2.0, 250.0, 4.0, 150.0),
    ("error", 0.1, 400.0, 1.0, 90.0),
]
_LIMIT_VALUES = "lim(variable, phys_min, phys_max, oper_min, oper_max) AS (VALUES " + ", ".join(
    f"('{v}', {a}, {b}, {c}, {d})" for v, a, b, c, d in LIMITS
) + ")"


def limits(spark):
    return spark.createDataFrame(
        LIMITS, "variable string, phys_min double, phys_max double, oper_min double, oper_max double"
    )


_RANGE_SQL = {
    "range_below_physical_minimum": ("value < phys_min", "ERROR", "phys_min"),
    "range_above_physical_maximum": ("value > phys_max", "ERROR", "phys_max"),
    "range_below_operational_minimum": ("value < oper_min", "SUSPECT", "oper_min"),
    "range_above_operational_maximum": ("value > oper_max", "SUSPECT", "oper_max"),
}


def ranged(spark, sf_dir):
    return RR.limit_flags(B.long(spark, sf_dir).join(limits(spark), "variable", "left"))


for _rule_id, (_bad, _flag, _limit) in _RANGE_SQL.items():
    register(
        f"rule_{_rule_id}",
        (lambda r: lambda spark, sf_dir: ranged(spark, sf_dir).select("event_id", F.col(r).alias("flag")))(_rule_id),
        f"WITH {B.LONG_CTE}, {_LIMIT_VALUES} SELECT event_id, {_case(_bad, _flag, f'{_limit} IS NULL')} AS flag"
        " FROM long LEFT JOIN lim USING (variable)",
    )


# The three group ranges without an identifier of their own: limits per weather variable.
def _group_range(name: str, columns: list[str], low: float, high: float):
    def run(spark, sf_dir):
        bounds = spark.createDataFrame(
            [(c, low, high, low, high) for c in columns],
            "variable string, phys_min double, phys_max double, oper_min double, oper_max double",
        )
        melted = C.melt(B.wide(spark, sf_dir), ["event_id"], columns)
        flagged = RR.limit_flags(melted.join(bounds, "variable", "left"))
        return flagged.select(
            "event_id", "variable",
            F.when(F.col("range_below_physical_minimum") == "ERROR", "ERROR")
            .otherwise(F.col("range_above_physical_maximum")).alias("flag"),
        )

    sql = " UNION ALL ".join(
        f"SELECT event_id, '{c}' AS variable, {_case(f'{c} < {low} OR {c} > {high}', 'ERROR', f'{c} IS NULL')} AS flag FROM obs"
        for c in columns
    )
    register(name, run, f"WITH {B.WIDE_CTE} {sql}")


_group_range("rule_temperature_range", [T, TD, TW, TMAX, TMIN], 0.0, 25.0)
_group_range("rule_pressure_range", ["qnh_hpa", "qfe_hpa"], 985.0, 1025.0)
_group_range("rule_visibility_range", [VIS, V1, V2], 0.0, 9900.0)


# --- framework ----------------------------------------------------------------------------------

FRAME_RULES = [
    "temperature_dew_point_above_air", "humidity_invalid_range", "pressure_qnh_qfe_relationship",
    "wind_direction_range", "wind_gust_below_mean_speed", "visibility_minimum_above_prevailing",
    "weather_invalid_code", "cloud_negative_height", "precipitation_negative",
]
FRAME_NULLS = [T, RH]
_RESULTS_CTE = (
    f"{B.WIDE_CTE}, results AS ("
    + " UNION ALL ".join(f"SELECT event_id, '{r}' AS rule_id, {ROW_SQL[r]} AS flag FROM obs" for r in FRAME_RULES)
    + " UNION ALL "
    + " UNION ALL ".join(
        f"SELECT event_id, 'completeness_null_value' AS rule_id, CASE WHEN {c} IS NULL THEN 'MISSING' ELSE 'PASS' END AS flag FROM obs"
        for c in FRAME_NULLS
    )
    + ")"
)
_FLAG_COUNTS = (
    "per_obs AS (SELECT event_id, count(*) AS n, count(*) FILTER (flag IN ('SUSPECT','ERROR','MISSING')) AS failed,"
    " count(*) FILTER (flag = 'SUSPECT') AS s, count(*) FILTER (flag = 'ERROR') AS e,"
    " count(*) FILTER (flag = 'MISSING') AS m, count(*) FILTER (flag = 'PASS') AS p,"
    " count(*) FILTER (flag = 'NOT_CHECKED') AS nc FROM results GROUP BY event_id)"
)


# Aggregates over the results of one observation.
_ASSESSED = """CASE WHEN bool_or(flag = 'ERROR') THEN 'ERROR' WHEN bool_or(flag = 'MISSING') THEN 'MISSING' WHEN bool_or(flag = 'SUSPECT') THEN 'SUSPECT'
      WHEN bool_or(flag = 'PASS') THEN 'PASS' WHEN bool_or(flag = 'NOT_CHECKED') THEN 'NOT_CHECKED' ELSE 'NOT_APPLICABLE' END AS qc_status,
    CAST(greatest(0, 100 - 10 * count(*) FILTER (flag = 'SUSPECT') - 30 * count(*) FILTER (flag = 'ERROR') - 15 * count(*) FILTER (flag = 'MISSING')) AS DOUBLE) AS qc_score,
    coalesce(array_to_string(list_sort(list_distinct(list(rule_id) FILTER (flag IN ('SUSPECT','ERROR','MISSING')))), ','), '') AS qc_flags"""


def evaluated(spark, sf_dir):
    df = B.wide(spark, sf_dir)
    return FW.evaluate(df, RR.row_checks(df, FRAME_RULES) + RR.null_value_checks(FRAME_NULLS))


@query("qcf_01_results_in_one_array", f"WITH {_RESULTS_CTE} SELECT event_id, rule_id, flag FROM results")
def results_array(spark, sf_dir):
    return SM.findings(evaluated(spark, sf_dir), ["event_id"]).select("event_id", "rule_id", "flag")


@query(
    "qcf_02_flag_codes_and_severity",
    f"""WITH {_RESULTS_CTE} SELECT flag,
    CASE flag WHEN 'PASS' THEN 0 WHEN 'SUSPECT' THEN 1 WHEN 'ERROR' THEN 2 WHEN 'MISSING' THEN 3 WHEN 'NOT_CHECKED' THEN 8 ELSE 9 END AS code,
    CASE flag WHEN 'ERROR' THEN 'error' WHEN 'SUSPECT' THEN 'warning' WHEN 'MISSING' THEN 'warning' ELSE 'info' END AS severity,
    count(*) AS n FROM results GROUP BY flag""",
)
def flag_codes(spark, sf_dir):
    found = FW.detail(evaluated(spark, sf_dir), [], failed_only=False)
    return found.groupBy("flag", FW.lookup(R.FLAG_CODES, F.col("flag")).alias("code"), "severity").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "qcf_03_score",
    f"WITH {_RESULTS_CTE}, {_FLAG_COUNTS} SELECT event_id, CAST(greatest(0, least(100, 100 - 10 * s - 30 * e - 15 * m)) AS BIGINT) AS score FROM per_obs",
)
def scores(spark, sf_dir):
    return evaluated(spark, sf_dir).select("event_id", FW.score(F.col("qc_results")).cast("bigint").alias("score"))


_WORST = (
    "CASE WHEN e > 0 THEN 'ERROR' WHEN m > 0 THEN 'MISSING' WHEN s > 0 THEN 'SUSPECT' WHEN p > 0 THEN 'PASS'"
    " WHEN nc > 0 THEN 'NOT_CHECKED' ELSE 'NOT_APPLICABLE' END"
)


@query("qcf_04_worst_flag", f"WITH {_RESULTS_CTE}, {_FLAG_COUNTS} SELECT event_id, {_WORST} AS flag FROM per_obs")
def worst(spark, sf_dir):
    return evaluated(spark, sf_dir).select("event_id", FW.worst_flag(F.col("qc_results")).alias("flag"))


@query(
    "qcf_05_null_is_not_checked",
    f"""WITH {_RESULTS_CTE} SELECT r.rule_id, count(*) AS n FROM results r JOIN obs o USING (event_id)
    WHERE o.{T} IS NULL AND r.flag = 'NOT_CHECKED' GROUP BY r.rule_id""",
)
def null_semantics(spark, sf_dir):
    found = SM.findings(evaluated(spark, sf_dir).filter(F.col(T).isNull()), ["event_id"])
    return found.filter("flag = 'NOT_CHECKED'").groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "qcf_06_text_expression_rules",
    f"WITH {B.WIDE_CTE} SELECT event_id, "
    + ", ".join(f"{ROW_SQL[r]} AS {r}" for r in R.EXPRESSION_RULES)
    + f", {_case(f'NOT ({SPD} < {VIS} / 100)', 'SUSPECT', f'{SPD} IS NULL OR {VIS} IS NULL')} AS user_rule FROM obs",
)
def text_rules(spark, sf_dir):
    df = B.wide(spark, sf_dir)
    flags = [
        FW.expression_flag(df, text, R.RULES[r].flag).alias(r) for r, text in R.EXPRESSION_RULES.items()
    ]
    mine = FW.expression_flag(df, "wind_speed_kt < visibility_m / 100", "SUSPECT").alias("user_rule")
    return df.select("event_id", *flags, mine)


@query(
    "qcf_07_rule_selection_by_stage",
    f"""WITH {B.WIDE_CTE}, results AS ({" UNION ALL ".join(
        f"SELECT '{r}' AS rule_id, {ROW_SQL[r]} AS flag FROM obs" for r in R.rules_of("temperature", "humidity") if r in ROW_SQL)})
    SELECT rule_id, count(*) AS n, count(*) FILTER (flag IN ('SUSPECT','ERROR','MISSING')) AS failed FROM results GROUP BY rule_id""",
)
def selected_modules(spark, sf_dir):
    df = B.wide(spark, sf_dir)
    found = SM.findings(FW.evaluate(df, RR.row_checks(df, R.rules_of("temperature", "humidity"))), ["event_id"])
    return found.groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("flag").isin(*FW.FAILED)).alias("failed")
    )


@query(
    "qcf_08_traced_corrections",
    f"""WITH {B.WIDE_CTE} SELECT event_id, upper(trim(report_status)) AS report_status,
    CASE WHEN trim(report_status) <> report_status THEN 1 ELSE 0 END
      + CASE WHEN upper(trim(report_status)) <> trim(report_status) THEN 1 ELSE 0 END AS corrections,
    CASE WHEN trim(report_status) <> report_status THEN 'trim_spaces: ' || report_status || ' > ' || trim(report_status)
      ELSE 'normalize_case: ' || report_status || ' > ' || upper(report_status) END AS first_correction FROM obs""",
)
def corrections(spark, sf_dir):
    df = B.wide(spark, sf_dir).select("event_id", "report_status")
    df = FW.correct(df, "report_status", F.trim("report_status"), "trim_spaces", AS_OF)
    df = FW.correct(df, "report_status", F.upper("report_status"), "normalize_case", AS_OF)
    first = F.col("corrections")[0]
    return df.select(
        "event_id", "report_status", F.size("corrections").alias("corrections"),
        F.concat(first["reason"], F.lit(": "), first["old_value"], F.lit(" > "), first["new_value"]).alias("first_correction"),
    )


@query(
    "qcf_09_detail_table",
    f"""WITH {_RESULTS_CTE} SELECT event_id, rule_id, flag, rule_id || ': ' || lower(flag) AS message
    FROM results WHERE flag IN ('SUSPECT','ERROR','MISSING')""",
)
def detail(spark, sf_dir):
    return FW.detail(evaluated(spark, sf_dir), ["event_id"]).select("event_id", "rule_id", "flag", "message")


# The rule table audited: the variables of the data act as rules, one per (variable, station).
_EVENT_RULES = (
    "er AS (SELECT event_type || '_' || CAST(user_id % 50 AS VARCHAR) AS rule_id,"
    " CASE WHEN max(value) > 250 THEN 'FATAL' ELSE 'ERROR' END AS flag, event_type AS variable"
    " FROM events GROUP BY event_type, user_id)"
)


@query(
    "qcf_10_rule_catalogue_audit",
    f"""WITH {_EVENT_RULES}, lim(variable) AS (VALUES ('click'), ('view'), ('purchase'), ('error'))
    SELECT rule_id, 'duplicate_rule_id' AS problem FROM er GROUP BY rule_id HAVING count(*) > 1
    UNION ALL SELECT rule_id, 'unknown_flag' FROM er WHERE flag = 'FATAL'
    UNION ALL SELECT rule_id, 'unknown_variable' FROM er WHERE variable NOT IN (SELECT variable FROM lim)""",
)
def rule_audit(spark, sf_dir):
    rules = (
        B.table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.max("value").alias("top"))
        .select(
            F.concat("event_type", F.lit("_"), (F.col("user_id") % 50).cast("string")).alias("rule_id"),
            F.when(F.col("top") > 250, "FATAL").otherwise("ERROR").alias("flag"),
            F.col("event_type").alias("variable"),
        )
    )
    known = limits(spark).select("variable")
    return FW.audit_rules(rules, list(R.FLAG_CODES)).unionByName(
        FW.audit_references(rules, known, "variable", "variable", "unknown_variable")
    )


@query(
    "qcf_11_contract_audit",
    """WITH cols AS (SELECT CAST(p_partkey AS INT) AS position, p_name AS name, CASE WHEN p_size > 45 THEN NULL ELSE p_type END AS dtype FROM part
      UNION ALL SELECT CAST(p_partkey AS INT), p_brand, p_type FROM part)
    SELECT 'positions' AS name, 'not_consecutive' AS problem FROM cols HAVING min(position) <> 1 OR max(position) <> count(*) OR count(DISTINCT position) <> count(*)
    UNION ALL SELECT name, 'duplicate_name' FROM cols GROUP BY name HAVING count(*) > 1
    UNION ALL SELECT name, 'missing_attribute' FROM cols WHERE dtype IS NULL""",
)
def contract_audit(spark, sf_dir):
    part = B.table(spark, sf_dir, "part")
    position = F.col("p_partkey").cast("int").alias("position")
    columns = part.select(
        position, F.col("p_name").alias("name"), F.when(F.col("p_size") <= 45, F.col("p_type")).alias("dtype")
    ).unionByName(part.select(position, F.col("p_brand").alias("name"), F.col("p_type").alias("dtype")))
    return FW.audit_schema(columns)


@query("qcf_12_custom_transform", "SELECT event_id, round(value * 2 + 1, 6) AS scaled FROM events")
def custom_transform(spark, sf_dir):
    def scale(df, factor, shift):
        return df.withColumn("scaled", F.round(F.col("value") * factor + shift, 6))

    return B.table(spark, sf_dir, "events").transform(scale, 2, 1).select("event_id", "scaled")


@query(
    "qcf_13_unknown_reference_policy",
    f"""WITH {UNIT_CTE}, {_UNIT_VALUES}, {_LIMIT_VALUES} SELECT g.event_id,
    CASE WHEN g.unit IS NOT NULL AND u.unit_id IS NULL THEN 'error' ELSE 'info' END AS unit_severity,
    CASE WHEN l.variable IS NULL THEN 'warning' ELSE 'info' END AS variable_severity
    FROM given g JOIN events e USING (event_id) LEFT JOIN u ON g.unit = u.alias LEFT JOIN lim l ON e.event_type = l.variable""",
)
def unknown_policies(spark, sf_dir):
    flagged = given_units(spark, sf_dir).select("event_id", "unit_unknown")
    known = B.long(spark, sf_dir).join(
        limits(spark).select("variable", F.lit(True).alias("_known")), "variable", "left"
    )
    return known.join(flagged, "event_id").select(
        "event_id",
        FW.lookup(R.FLAG_SEVERITY, F.col("unit_unknown")).alias("unit_severity"),
        F.when(F.col("_known").isNull(), "warning").otherwise("info").alias("variable_severity"),
    )
