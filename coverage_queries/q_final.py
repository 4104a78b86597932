"""The whole quality run over the events as observations: results, final dataset, summaries, reports.

The SQL spells out every check of the run as one branch of a union, with the place it has in the run.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from coverage_queries import bindings as B
from coverage_queries.q_checks import _ASSESSED, AS_OF, RAW, REQUIRED, ROW_SQL, _case
from coverage_queries.q_sources import scratch
from coverage_queries.q_time import _pattern_sql, _persist_sql, _step_sql
from coverage_queries.registry import register
from obsguard.catalogs import rulebook as R
from obsguard.operators import canonical as C
from obsguard.operators import coded as K
from obsguard.operators import row_rules as RR
from obsguard.operators import summary as SM
from obsguard.plans import whole_run as WR
from obsguard.sinks import writers as W

_UNIT_OF = {
    "wind_speed_unit": "CASE event_id % 5 WHEN 0 THEN 'kt' WHEN 1 THEN 'knots' WHEN 2 THEN 'mps' WHEN 3 THEN 'furlong' END",
    "qnh_unit": "CASE event_id % 7 WHEN 0 THEN 'hPa' WHEN 1 THEN 'kt' WHEN 2 THEN 'pressure_pascal' WHEN 3 THEN NULL ELSE 'hPa' END",
}
_EXTRA = {**RAW, **_UNIT_OF}

SETTINGS = WR.Settings(
    as_of=AS_OF, first_day="2024-01-03", last_day="2024-01-16", variables=tuple(REQUIRED), required=tuple(REQUIRED),
    limits={
        "air_temperature_c": (-10.0, 28.0, 0.0, 25.0), "dew_point_temperature_c": (-12.0, 27.0, -5.0, 22.0), "relative_humidity_pct": (0.0, 100.0, 5.0, None),
        "qnh_hpa": (980.0, 1028.0, 1001.0, 1025.0), "wind_speed_kt": (0.0, 30.0, None, 25.0), "prevailing_visibility_m": (0.0, 10000.0, 100.0, None),
    },
    thresholds={"air_temperature_c": (12.0, 6.0), "qnh_hpa": (10.0, 8.0), "relative_humidity_pct": (30.0, 5.0), "wind_speed_kt": (40.0, 12.0)},
    raw_types={"raw_integer": "integer", "raw_number": "number", "raw_boolean": "boolean"},
    categories={f"cloud_amount_{i}": "cloud_codes" for i in (1, 2, 3)} | {"present_weather_1": "sea_state_codes"},
    units={"wind_speed_kt": ("wind_speed_unit", "speed_knot"), "qnh_hpa": ("qnh_unit", "pressure_hectopascal")},
)


def observations(spark, sf_dir):
    rows = B.base(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in {**B.WIDE, **_EXTRA}.items()])
    return C.with_datetime(rows)


def coded(spark, sf_dir):
    return WR.evaluate_all(observations(spark, sf_dir), B.stations(spark, sf_dir, open_only=True), SETTINGS, "event_id")


# --- the same in SQL ----------------------------------------------------------------------------

_WIDE = ", ".join(f"{e} AS {n}" for n, e in {**B.WIDE, **_EXTRA}.items())
_RUN_CTE = f"""{B.BASE_CTE}, obs AS (SELECT {_WIDE} FROM base), timed AS (SELECT *, {B.SQL_TIME} AS datetime_utc FROM obs), {B.OPEN_STATION_CTE},
    series AS MATERIALIZED (SELECT * EXCLUDE (ts), datetime_utc AS ts, nullif(upper(trim(station_id)), '') AS sk, datetime_utc IS NULL AS untimed, count(*) OVER (PARTITION BY nullif(upper(trim(station_id)), ''), datetime_utc IS NULL) AS members,
      datetime_utc AT TIME ZONE 'UTC' AT TIME ZONE coalesce(zone, 'America/Lima') AS local_ts, CAST(datetime_utc AT TIME ZONE 'UTC' AT TIME ZONE coalesce(zone, 'America/Lima') AS DATE) AS local_date
      FROM (SELECT timed.*, s.timezone AS zone, s.station_id IS NOT NULL AS station_known FROM timed LEFT JOIN stations s ON upper(trim(timed.station_id)) = upper(s.station_id)))"""
_KEY = "sk, untimed"
_ONE = "one AS (SELECT 1 AS x)"
_T, _RH, _SPD, _RAIN = "air_temperature_c", "relative_humidity_pct", "wind_speed_kt", "accumulated_precipitation_mm"
_FRAMES = {
    "temperature_persistence": _persist_sql(_T, 6, 0.1, 80, _KEY, _ONE, "series"),
    "temperature_temporal_step": _step_sql(_T, "12", _KEY, "OR h < 0.5 OR h > 1.5", _ONE).replace("{t}", "series"),
    "humidity_persistence": _persist_sql(_RH, 8, 1, 100, _KEY, _ONE, "series"),
    "pressure_temporal_change": _step_sql("qnh_hpa", "10", _KEY, "", _ONE).replace("{t}", "series"),
    "wind_persistence": _persist_sql(
        _SPD, 8, 0, 100, _KEY, _ONE, "series",
        f"NOT (min({_SPD}) OVER r >= 3 AND coalesce(round(max(wind_direction_deg) OVER r - min(wind_direction_deg) OVER r, 6) > 0, FALSE))",
    ),
    "wind_temporal_speed_change": _step_sql(_SPD, "40", _KEY, "", _ONE).replace("{t}", "series"),
    "visibility_temporal_change": _step_sql("prevailing_visibility_m", "9000", _KEY, "", _ONE).replace("{t}", "series"),
    "datetime_duplicate_observation": f"SELECT event_id, CASE WHEN coalesce(lag(ts) OVER w = ts, FALSE) THEN 'ERROR' ELSE 'PASS' END AS flag FROM series"
    f" WINDOW w AS (PARTITION BY {_KEY} ORDER BY ts, event_id)",
    "temporal_non_monotonic_accumulation": f"""SELECT event_id, CASE WHEN {_RAIN} IS NULL OR lag({_RAIN}) OVER w IS NULL OR local_date IS DISTINCT FROM lag(local_date) OVER w THEN 'NOT_CHECKED'
      WHEN {_RAIN} < lag({_RAIN}) OVER w THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM series WINDOW w AS (PARTITION BY {_KEY} ORDER BY ts, event_id)""",
}


def _generic(variable: str, per_hour: float, spike: float) -> dict[str, str]:
    t = f"(SELECT event_id, sk, untimed, ts, members, {variable} AS value FROM series)"
    n, p = "lead(value) OVER w", "lag(value) OVER w"
    return {
        f"temporal_step {variable}": _step_sql("value", str(per_hour), _KEY, "OR members < 3", _ONE).replace("{t}", t),
        f"temporal_spike {variable}": f"""SELECT event_id, CASE WHEN members < 3 OR value IS NULL OR {p} IS NULL OR {n} IS NULL THEN 'NOT_CHECKED'
          WHEN round(abs(value - ({p} + {n}) / 2) - abs({n} - {p}) / 2, 6) > {spike} THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM {t}
          WINDOW w AS (PARTITION BY {_KEY} ORDER BY ts, event_id)""",
        f"temporal_persistence {variable}": _persist_sql("value", 6, 0, 100, _KEY, _ONE, t),
        f"temporal_repeated_pattern {variable}": _pattern_sql(3, 3, _ONE, t, _KEY, "OR members < 3"),
    }


for _v, (_a, _b) in SETTINGS.thresholds.items():
    _FRAMES.update(_generic(_v, _a, _b))

_FIRST, _LAST = SETTINGS.first_day, SETTINGS.last_day
_DAYS = f"""got AS (SELECT DISTINCT sk, local_date, CAST(hour(local_ts) AS INT) AS local_hour FROM series WHERE minute(local_ts) = 0 AND report_type IN ('METAR', 'LOCAL_OBSERVATION', 'HISTORICAL_OBSERVATION')),
    grid AS (SELECT sk, local_date, CAST(unnest(generate_series(6, 19)) AS INT) AS local_hour FROM (SELECT sk, CAST(unnest(generate_series(DATE '{_FIRST}', DATE '{_LAST}', INTERVAL 1 DAY)) AS DATE) AS local_date
      FROM (SELECT DISTINCT sk FROM series WHERE sk IS NOT NULL AND local_date IS NOT NULL))),
    gaps AS (SELECT *, date_diff('day', DATE '1970-01-01', local_date) * 14 + local_hour - 6 AS slot FROM grid ANTI JOIN got USING (sk, local_date, local_hour)),
    islands AS (SELECT *, slot - row_number() OVER (PARTITION BY sk ORDER BY slot) AS island FROM gaps),
    lost AS (SELECT DISTINCT sk, local_date FROM gaps),
    runs AS (SELECT DISTINCT sk, local_date FROM (SELECT *, count(*) OVER (PARTITION BY sk, island) AS size FROM islands) WHERE size >= 2),
    totals AS (SELECT sk, local_date, round(sum({_RAIN}), 6) AS total FROM series WHERE sk IS NOT NULL AND local_date IS NOT NULL GROUP BY ALL)"""
_NO_DAY = f"s.sk IS NULL OR s.local_date IS NULL OR s.local_date NOT BETWEEN DATE '{_FIRST}' AND DATE '{_LAST}'"


def _limit_sql(variable: str) -> list[tuple[str, str, str]]:
    out = []
    for rule, bound, sign in zip(
        ("range_below_physical_minimum", "range_above_physical_maximum", "range_below_operational_minimum", "range_above_operational_maximum"),
        SETTINGS.limits[variable], "<><>", strict=True,
    ):
        out.append((rule, variable, "'NOT_CHECKED'" if bound is None else _case(f"{variable} {sign} {bound}", R.RULES[rule].flag, f"{variable} IS NULL")))
    return out


_SPELLED = {"kt": "speed_knot", "knots": "speed_knot", "mps": "speed_meter_per_second", "hPa": "pressure_hectopascal", "pressure_pascal": "pressure_pascal"}
_BASE = {"speed_knot": "speed_meter_per_second", "speed_meter_per_second": "speed_meter_per_second", "pressure_hectopascal": "pressure_pascal", "pressure_pascal": "pressure_pascal"}


def _unit_sql(variable: str, column: str, wanted: str) -> list[tuple[str, str, str]]:
    found = f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _SPELLED.items()) + " END"
    base = f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{_BASE[v]}'" for k, v in _SPELLED.items()) + " END"
    return [
        ("unit_unknown", variable, _case(f"{found} IS NULL", "ERROR", f"{column} IS NULL")),
        ("unit_incompatible", variable, _case(f"{base} <> '{_BASE[wanted]}'", "ERROR", f"{found} IS NULL")),
        ("unit_non_canonical", variable, _case(f"{found} <> '{wanted}'", "SUSPECT", f"{found} IS NULL")),
    ]


def _branches() -> list[tuple[str, str, str]]:
    """(rule, variable, query of event_id and flag) of every check, in the order of the run."""
    rows: list[tuple[str, str, str]] = []
    for rule in RR.row_rule_ids():
        if not R.RULES[rule].enabled:
            continue
        sql = _case("NOT station_known", "ERROR", "coalesce(trim(station_id), '') = ''") if rule == "identity_invalid_station_id" else ROW_SQL[rule]
        rows.append((rule, RR.reported_variable(rule), sql))
    rows += [("completeness_null_value", c, _case(f"{c} IS NULL", "MISSING")) for c in SETTINGS.variables]
    rows += [("completeness_required_variable", c, _case(f"{c} IS NULL", "MISSING")) for c in SETTINGS.required]
    whole = "TRY_CAST(trim(raw_integer) AS DOUBLE)"
    rows += [
        ("datatype_invalid", "raw_integer", _case(f"{whole} IS NULL OR {whole} <> floor({whole})", "ERROR", "raw_integer IS NULL")),
        ("datatype_invalid_numeric", "raw_number", _case("TRY_CAST(replace(trim(raw_number), ',', '.') AS DOUBLE) IS NULL", "ERROR", "raw_number IS NULL")),
        ("datatype_invalid_boolean", "raw_boolean", _case("lower(trim(raw_boolean)) NOT IN ('t','true','y','yes','1','f','false','n','no','0')", "ERROR", "raw_boolean IS NULL")),
    ]
    rows += [
        ("datatype_invalid_category", f"cloud_amount_{i}", _case(f"cloud_amount_{i} NOT IN ('SKC','CLR','FEW','SCT','BKN','OVC','NSC','NCD','VV')", "ERROR", f"cloud_amount_{i} IS NULL"))
        for i in (1, 2, 3)
    ]
    rows.append(("datatype_invalid_category", "present_weather_1", "'NOT_CHECKED'"))
    for variable in SETTINGS.limits:
        rows += _limit_sql(variable)
    for variable, (column, wanted) in SETTINGS.units.items():
        rows += _unit_sql(variable, column, wanted)
    out = [(rule, variable, f"SELECT event_id, {sql} AS flag FROM series") for rule, variable, sql in rows]
    for name in (f.name for f in WR.time_frames(SETTINGS) if f.name != "_enough"):
        rule, _, variable = name.partition(" ")
        gate = "sk IS NULL OR ts IS NULL" + (" OR members < 3" if rule in ("temporal_persistence", "temporal_repeated_pattern") else "")
        sql = f"SELECT s.event_id, CASE WHEN {gate} THEN 'NOT_CHECKED' ELSE f.flag END AS flag FROM ({_FRAMES[name]}) f JOIN (SELECT event_id, sk, ts, members FROM series) s USING (event_id)"
        out.append((rule, variable or WR._REPORTED.get(rule) or _RAIN, sql))
    out.append((
        "datetime_non_chronological", "datetime_utc",
        "SELECT event_id, CASE WHEN sk IS NULL OR source_file IS NULL OR source_row IS NULL OR ts IS NULL OR lag(ts) OVER w IS NULL THEN 'NOT_CHECKED' WHEN ts < lag(ts) OVER w THEN 'SUSPECT' ELSE 'PASS' END AS flag"
        " FROM series WINDOW w AS (PARTITION BY sk, source_file ORDER BY source_row NULLS FIRST, event_id)",
    ))
    for rule, table, flag in (("completeness_expected_observations", "lost", "MISSING"), ("completeness_consecutive_missing", "runs", "SUSPECT")):
        out.append((rule, "datetime_utc", f"SELECT s.event_id, CASE WHEN {_NO_DAY} THEN 'NOT_CHECKED' WHEN d.sk IS NOT NULL THEN '{flag}' ELSE 'PASS' END AS flag FROM series s LEFT JOIN {table} d USING (sk, local_date)"))
    out.append((
        "precipitation_accumulation_inconsistent", "daily_precipitation_mm",
        "SELECT s.event_id, CASE WHEN t.total IS NULL OR s.daily_precipitation_mm IS NULL THEN 'NOT_CHECKED' WHEN round(abs(t.total - s.daily_precipitation_mm), 6) > 0.1 THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM series s LEFT JOIN totals t USING (sk, local_date)",
    ))
    return out


BRANCHES = _branches()
RESULTS_CTE = f"{_RUN_CTE}, {_DAYS}, results AS NOT MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT event_id, {k} AS place, '{rule}' AS rule_id, '{variable}' AS variable, flag FROM ({sql})" for k, (rule, variable, sql) in enumerate(BRANCHES)
) + ")"
KEYED_CTE = f"{RESULTS_CTE}, found AS (SELECT r.*, e.user_id AS station_id, CAST(year(e.ts) AS INT) AS year, CAST(month(e.ts) AS INT) AS month FROM results r JOIN events e USING (event_id))"


# --- the stored stage ---------------------------------------------------------------------------

_stored: dict[tuple[str, str], tuple[str, list[K.Item], dict]] = {}
_KEPT = ["event_id", "station_id", "user_id", "ts", "qc_status", "qc_flag", "qc_score", "qc_rule_count", "qc_failed_rule_count", "qc_flags", "qc_messages", "qc_codes"]


def final_stage(spark, sf_dir):
    """The final dataset, its checks and the metrics of its export.

    The run is evaluated and written once in a session; summaries and reports read what was written,
    as later stages do.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        coded_rows, items = coded(spark, sf_dir)
        final = K.assess_codes(coded_rows, items).select(*_KEPT)
        metrics = {
            "observations": F.count(F.lit(1)), "checks": F.sum("qc_rule_count"), "failed_checks": F.sum("qc_failed_rule_count"),
            **{f"status_{f.lower()}": F.count_if(F.col("qc_status") == f) for f in R.FLAG_ORDER},
        }
        path = scratch(spark)
        _stored[key] = (path, items, W.write_observed(final, path, metrics))
    path, items, metrics = _stored[key]
    return spark.read.parquet(path), items, metrics


def keyed(spark, sf_dir):
    """The final dataset with its summary keys: the reporting user stands for the station of a summary."""
    df, items, _ = final_stage(spark, sf_dir)
    return df.withColumns({"station_id": F.col("user_id"), "year": F.year("ts"), "month": F.month("ts")}), items


def counts(spark, sf_dir, keys: list[str]):
    """Counts by the summary keys a summary asks for, and no finer."""
    df, items = keyed(spark, sf_dir)
    return K.code_counts(df, keys, items)


def final_query(name: str, sql: str):
    def keep(fn):
        register(name, fn, f"WITH {sql}")
        return fn

    return keep


@final_query(
    "final_01_findings",
    f"{RESULTS_CTE} SELECT event_id, rule_id, variable, flag, CASE flag WHEN 'ERROR' THEN 'error' ELSE 'warning' END AS severity, rule_id || ': ' || lower(flag) AS message"
    " FROM results WHERE flag IN ('SUSPECT', 'ERROR', 'MISSING')",
)
def findings(spark, sf_dir):
    df, items = coded(spark, sf_dir)
    return K.code_detail(df, ["event_id"], items).drop("observed_value")


@final_query("final_02_rules_run", f"{RESULTS_CTE} SELECT rule_id, variable, flag, count(*) AS observations FROM results GROUP BY ALL")
def rules_run(spark, sf_dir):
    df, items, _ = final_stage(spark, sf_dir)
    return K.code_counts(df, [], items).groupBy("rule_id", "variable", "flag").agg(F.sum("observations").alias("observations"))


# --- the final dataset and its assessment -------------------------------------------------------

_FAILED_SQL = "flag IN ('SUSPECT','ERROR','MISSING')"


@final_query(
    "exp_13_final_dataset",
    f"{RESULTS_CTE}, q AS (SELECT event_id, {_ASSESSED}, coalesce(string_agg(rule_id || ': ' || lower(flag), '; ' ORDER BY place) FILTER ({_FAILED_SQL}), '') AS qc_messages"
    " FROM results GROUP BY event_id) SELECT q.*, o.station_id FROM q JOIN obs o USING (event_id)",
)
def final_export(spark, sf_dir):
    df, _, _ = final_stage(spark, sf_dir)
    return df.select("event_id", "station_id", "qc_status", "qc_flags", "qc_score", "qc_messages").withColumns(
        {"qc_flags": F.concat_ws(",", "qc_flags"), "qc_score": F.col("qc_score").cast("double")}
    )


@final_query(
    "agg_09_observation_assessment",
    f"{RESULTS_CTE} SELECT event_id, count(*) AS qc_rule_count, count(*) FILTER ({_FAILED_SQL}) AS qc_failed_rule_count, {_ASSESSED.replace('AS qc_status', 'AS qc_flag')}"
    " FROM results GROUP BY event_id",
)
def assessment(spark, sf_dir):
    df, _, _ = final_stage(spark, sf_dir)
    return df.select(
        "event_id", F.col("qc_rule_count").cast("bigint").alias("qc_rule_count"),
        F.col("qc_failed_rule_count").cast("bigint").alias("qc_failed_rule_count"), "qc_flag",
        F.col("qc_score").cast("double").alias("qc_score"), F.concat_ws(",", "qc_flags").alias("qc_flags"),
    )


# --- summaries ----------------------------------------------------------------------------------

_TOTALS = f"""count(*) AS total_observations, count(*) FILTER (flag = 'PASS') AS passed_observations, count(*) FILTER (flag = 'SUSPECT') AS suspect_observations,
    count(*) FILTER (flag = 'ERROR') AS erroneous_observations, count(*) FILTER (flag = 'MISSING') AS missing_observations,
    count(*) FILTER (flag = 'NOT_CHECKED') AS not_checked_observations, round(count(*) FILTER ({_FAILED_SQL}) * 100.0 / count(*), 4) AS failure_pct"""


@final_query("agg_05_quality_summary", f"{KEYED_CTE} SELECT station_id, year, month, variable, rule_id, {_TOTALS} FROM found GROUP BY ALL")
def quality_summary(spark, sf_dir):
    return SM.summary(counts(spark, sf_dir, SM.SUMMARY_KEYS[:3]), SM.SUMMARY_KEYS)


@final_query(
    "agg_05_summary_levels",
    f"{KEYED_CTE} SELECT CAST(grouping_id(station_id, rule_id) AS BIGINT) AS level, station_id, rule_id, {_TOTALS}"
    " FROM found GROUP BY GROUPING SETS ((station_id, rule_id), (rule_id), (station_id), ())",
)
def summary_levels(spark, sf_dir):
    return SM.summary_levels(
        counts(spark, sf_dir, ["station_id"]), [["station_id", "rule_id"], ["rule_id"], ["station_id"], []], ["station_id", "rule_id"]
    )


_TOP_SQL = f"{RESULTS_CTE} SELECT rule_id, count(*) AS failures FROM results WHERE {_FAILED_SQL} GROUP BY rule_id ORDER BY failures DESC, rule_id LIMIT 5"


@final_query("agg_06_frequent_errors", _TOP_SQL)
def frequent(spark, sf_dir):
    return SM.frequent_errors(counts(spark, sf_dir, []), 5)


@final_query("ord_05_top_errors", _TOP_SQL.replace("LIMIT 5", "LIMIT 3"))
def top_errors(spark, sf_dir):
    return SM.frequent_errors(counts(spark, sf_dir, []), 3)


_STAGE_OF = "CASE " + " ".join(
    f"WHEN rule_id IN ({', '.join(repr(r) for r in R.rules_of_stage(stage, include_disabled=True))}) THEN '{stage}'" for stage in R.STAGE_MODULES
) + " END"


def stage_report(spark, sf_dir, stage: str):
    return SM.stage_summary(counts(spark, sf_dir, []), stage).withColumn("stage", F.lit(stage))


@final_query("agg_08_stage_summaries", f"{RESULTS_CTE} SELECT {_STAGE_OF} AS stage, rule_id, {_TOTALS} FROM results GROUP BY ALL")
def stage_summaries(spark, sf_dir):
    return SM.stage_summaries(counts(spark, sf_dir, []), list(R.STAGE_MODULES))


# --- report products ----------------------------------------------------------------------------


@final_query(
    "agg_19_executive_report",
    f"{RESULTS_CTE}, o AS (SELECT event_id, {_ASSESSED} FROM results GROUP BY event_id)"
    " SELECT qc_status AS flag, count(*) AS observations, round(avg(qc_score), 4) AS mean_score, CAST(min(qc_score) AS DOUBLE) AS lowest_score FROM o GROUP BY qc_status",
)
def executive(spark, sf_dir):
    final = final_stage(spark, sf_dir)[0].withColumn("score", F.col("qc_score").cast("double"))
    return final.groupBy(F.col("qc_flag").alias("flag")).agg(
        F.count(F.lit(1)).alias("observations"), F.round(F.avg("score"), 4).alias("mean_score"),
        F.min("score").alias("lowest_score"),
    )


for _stage in R.STAGE_MODULES:
    register(
        f"agg_19_{_stage}_report",
        (lambda stage: lambda spark, sf_dir: stage_report(spark, sf_dir, stage))(_stage),
        f"WITH {RESULTS_CTE}, staged AS (SELECT *, {_STAGE_OF} AS stage FROM results) SELECT stage, rule_id, {_TOTALS} FROM staged WHERE stage = '{_stage}' GROUP BY ALL",
    )


@final_query(
    "agg_19_final_dataset_report",
    f"{RESULTS_CTE}, o AS (SELECT event_id, count(*) AS n, count(*) FILTER ({_FAILED_SQL}) AS failed, {_ASSESSED} FROM results GROUP BY event_id),"
    " s AS (SELECT count(*) AS observations, sum(n) AS checks, sum(failed) AS failed_checks, "
    + ", ".join(f"count(*) FILTER (qc_status = '{f}') AS status_{f.lower()}" for f in R.FLAG_ORDER)
    + " FROM o) SELECT 'run-1' AS run_id, 'stage15' AS stage, metric, CAST(value AS VARCHAR) AS value FROM (UNPIVOT (SELECT "
    + ", ".join(f"CAST({m} AS BIGINT) AS {m}" for m in ["observations", "checks", "failed_checks", *[f"status_{f.lower()}" for f in R.FLAG_ORDER]])
    + " FROM s) ON COLUMNS(*) INTO NAME metric VALUE value)",
)
def final_dataset_report(spark, sf_dir):
    """What the export of the final dataset wrote, as observed while it was written."""
    metrics = final_stage(spark, sf_dir)[2]
    return W.run_log(spark, "run-1", "stage15", spark.createDataFrame([tuple(metrics.values())], ", ".join(f"{m} long" for m in metrics)))
