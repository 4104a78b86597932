"""Checks along time: window operators, duplicates, completeness, temporal and statistical rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverage_queries import bindings as B
from coverage_queries.registry import query, register
from obsguard.functions import scalars as S
from obsguard.operators import canonical as C
from obsguard.operators import temporal as TP
from obsguard.operators.references import climatology, climatology_flags, series_flags
from obsguard.plans import quality as Q

_W = "PARTITION BY {key} ORDER BY ts, event_id"
_HOURS = "(epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 3.6e9"


def _step_sql(value: str, limit: str, key: str, gate: str, source: str, extra: str = "") -> str:
    return f"""WITH {source}, d AS (SELECT *, {value} AS x, lag({value}) OVER w AS p, {_HOURS} AS h FROM {{t}}
      WINDOW w AS ({_W.format(key=key)}))
    SELECT event_id, CASE WHEN x IS NULL OR p IS NULL OR h IS NULL OR h <= 0 {gate} {extra} THEN 'NOT_CHECKED'
      WHEN round(abs(x - p) / h, 6) > {limit} THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM d"""


def _persist_sql(value: str, n: int, tol: float, coverage: float, key: str, source: str, t: str, also: str = "TRUE") -> str:
    return f"""WITH {source}, a AS (SELECT *, {value} AS x,
        count(*) OVER r = {n} AND count({value}) OVER r * 100.0 >= {n * coverage} AS enough,
        round(max({value}) OVER r - min({value}) OVER r, 6) <= {tol} AND {also} AS still FROM {t}
        WINDOW r AS ({_W.format(key=key)} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)),
      b AS (SELECT event_id, x, max(CASE WHEN enough THEN 1 ELSE 0 END) OVER f AS covered,
        max(CASE WHEN enough AND still THEN 1 ELSE 0 END) OVER f AS hit FROM a
        WINDOW f AS ({_W.format(key=key)} ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING))
    SELECT event_id, CASE WHEN x IS NULL OR covered = 0 THEN 'NOT_CHECKED' WHEN hit = 1 THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM b"""


# Values rounded to tens repeat often enough to show persistence and patterns.
COARSE = "CAST(floor(value / 40) AS DOUBLE)"
COARSE_CTE = f"coarse AS (SELECT event_id, user_id AS station_id, ts, event_type AS variable, {COARSE} AS value FROM events)"


def coarse(spark, sf_dir):
    return B.table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id AS station_id", "ts", "event_type AS variable", f"{COARSE} AS value"
    )


def _flag_of(frame, keys, check):
    def run(spark, sf_dir):
        df = TP.apply_checks(frame(spark, sf_dir), keys, ["ts", "event_id"], [check])
        return df.select("event_id", F.col(check.name).alias("flag"))

    return run


# --- window operators ---------------------------------------------------------------------------


def hourly(spark, sf_dir):
    return B.table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("hour")
    )


_DUP_SQL = """WITH h AS (SELECT event_id, user_id, date_trunc('hour', ts) AS hour FROM events)
    SELECT event_id, count(*) OVER (PARTITION BY user_id, hour) AS duplicate_count,
    CASE WHEN row_number() OVER (PARTITION BY user_id, hour ORDER BY event_id) > 1 THEN 'ERROR' ELSE 'PASS' END AS flag FROM h"""


def duplicates(spark, sf_dir):
    return TP.mark_duplicates(hourly(spark, sf_dir), ["user_id", "hour"], ["event_id"], "flag").select(
        "event_id", "duplicate_count", "flag"
    )


register("win_01_duplicate_groups", duplicates, _DUP_SQL)


@query(
    "rule_datetime_duplicate_observation",
    f"""WITH {B.WIDE_CTE}, h AS (SELECT event_id, station_id, date_trunc('hour', ts) AS t, report_type, report_status FROM obs)
    SELECT event_id, CASE WHEN station_id IS NULL OR t IS NULL OR report_type IS NULL OR report_status IS NULL THEN 'NOT_CHECKED'
        WHEN row_number() OVER (PARTITION BY station_id, t, report_type, report_status ORDER BY event_id) > 1 THEN 'ERROR' ELSE 'PASS' END AS key_flag,
      CASE WHEN station_id IS NULL OR t IS NULL THEN 'NOT_CHECKED' WHEN row_number() OVER (PARTITION BY station_id, t ORDER BY event_id) > 1 THEN 'ERROR' ELSE 'PASS' END AS flag FROM h""",
)
def duplicate_rule(spark, sf_dir):
    df = B.wide(spark, sf_dir).select(
        "event_id", "station_id", F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("t"),
        "report_type", "report_status",
    )
    key = ["station_id", "t", "report_type", "report_status"]
    df = TP.mark_duplicates(df, key, ["event_id"], "key_flag").drop("duplicate_count")
    return TP.mark_duplicates(df, ["station_id", "t"], ["event_id"], "flag").select("event_id", "key_flag", "flag")


# Line items of one supplier group and status are copies; equal flag and line make them exact ones. The number is order and line.
_COPY_KEY = ["customer", "mode"]
_COPIES = """c AS (SELECT (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS line, CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE l_suppkey % 40 END AS customer, l_linestatus AS mode, l_returnflag AS flag, l_linenumber AS status FROM lineitem)"""


@query(
    "win_01_duplicate_ordinals",
    f"""WITH {_COPIES}, r AS (SELECT *, row_number() OVER (PARTITION BY customer, mode ORDER BY line) AS n, row_number() OVER (PARTITION BY customer, mode, flag, status ORDER BY line) AS m FROM c)
    SELECT line, CASE WHEN customer IS NOT NULL AND mode IS NOT NULL THEN n END AS duplicate_ordinal,
    CASE WHEN customer IS NULL OR mode IS NULL THEN 'not_checked' WHEN n = 1 THEN 'first' WHEN m > 1 THEN 'exact' ELSE 'key' END AS duplicate_kind FROM r""",
)
def ordinals(spark, sf_dir):
    rows = B.table(spark, sf_dir, "lineitem").selectExpr(
        "(l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS line", "CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE l_suppkey % 40 END AS customer", "l_linestatus AS mode",
        "l_returnflag AS flag", "l_linenumber AS status",
    )
    return TP.duplicate_ordinals(rows, _COPY_KEY, ["flag", "status"], "line", 10**9).select("line", "duplicate_ordinal", "duplicate_kind")


# Source order: orders arrive by number, their dates do not.
_ORDER_SQL = """SELECT o_orderkey, CASE WHEN o_orderdate IS NULL OR lag(o_orderdate) OVER w IS NULL THEN 'NOT_CHECKED'
    WHEN o_orderdate < lag(o_orderdate) OVER w THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)"""


def source_order(spark, sf_dir):
    check = TP.out_of_source_order("flag", "o_orderdate")
    df = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return TP.apply_checks(df, ["o_custkey"], ["o_orderkey"], [check]).select("o_orderkey", "flag")


register("win_02_non_chronological", source_order, _ORDER_SQL)
register("rule_datetime_non_chronological", source_order, _ORDER_SQL)

register(
    "win_03_step",
    _flag_of(B.long, ["station_id"], TP.step("step", "value", "ts", 40.0, 30, 90)),
    _step_sql("value", "40", "station_id", "OR h < 0.5 OR h > 1.5", B.LONG_CTE).replace("{t}", "long"),
)
register(
    "win_04_three_point_spike",
    _flag_of(B.long, ["station_id"], TP.spike("spike", "value", 60.0)),
    f"""WITH {B.LONG_CTE} SELECT event_id, CASE WHEN lag(value) OVER w IS NULL OR lead(value) OVER w IS NULL THEN 'NOT_CHECKED'
      WHEN round(abs(value - (lag(value) OVER w + lead(value) OVER w) / 2) - abs(lead(value) OVER w - lag(value) OVER w) / 2, 6) > 60
      THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM long WINDOW w AS ({_W.format(key='station_id')})""",
)
register(
    "win_05_persistence",
    _flag_of(coarse, ["station_id"], TP.persistence("persistence", "value", 4, 0.0)),
    _persist_sql("value", 4, 0.0, 100, "station_id", COARSE_CTE, "coarse"),
)


def _pattern_sql(length: int, times: int, source: str, t: str, key: str, gate: str = "") -> str:
    total = length * times
    tail = f"ROWS BETWEEN {total - length - 1} PRECEDING AND CURRENT ROW"
    return f"""WITH {source}, a AS (SELECT *, coalesce(value = lag(value, {length}) OVER w, FALSE) AS same FROM {t} WINDOW w AS ({_W.format(key=key)})),
    b AS (SELECT *, count(*) OVER (w ROWS BETWEEN {total - 1} PRECEDING AND CURRENT ROW) = {total} AS whole,
      bool_and(same) OVER (w {tail}) AND max(value) OVER (w ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW)
        > min(value) OVER (w ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW) AS hit FROM a WINDOW w AS ({_W.format(key=key)})),
    c AS (SELECT *, max(CASE WHEN whole THEN 1 ELSE 0 END) OVER f AS covered, max(CASE WHEN whole AND hit THEN 1 ELSE 0 END) OVER f AS found,
      count(*) OVER (PARTITION BY {key}) AS members FROM b
      WINDOW f AS ({_W.format(key=key)} ROWS BETWEEN CURRENT ROW AND {total - 1} FOLLOWING))
    SELECT event_id, CASE WHEN value IS NULL OR covered = 0 {gate} THEN 'NOT_CHECKED' WHEN found = 1 THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM c"""


register(
    "win_06_repeated_pattern",
    _flag_of(coarse, ["station_id"], TP.repeated_pattern("pattern", "value", 2, 2)),
    _pattern_sql(2, 2, COARSE_CTE, "coarse", "station_id"),
)


def rainy(spark, sf_dir):
    return C.with_datetime(B.wide(spark, sf_dir)).select(
        "event_id", "user_id", "ts", "accumulated_precipitation_mm", F.to_date("ts").alias("day")
    )


_ACCUMULATION_SQL = f"""WITH {B.WIDE_CTE}, d AS (SELECT event_id, accumulated_precipitation_mm AS x, lag(accumulated_precipitation_mm) OVER w AS p,
      CAST(ts AS DATE) AS day, lag(CAST(ts AS DATE)) OVER w AS pday FROM obs WINDOW w AS ({_W.format(key='user_id')}))
    SELECT event_id, CASE WHEN x IS NULL OR p IS NULL OR day IS DISTINCT FROM pday THEN 'NOT_CHECKED' WHEN x < p THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM d"""
_accumulation = _flag_of(
    rainy, ["user_id"], TP.decreasing_accumulation("decrease", "accumulated_precipitation_mm", "day")
)
register("win_07_non_monotonic_accumulation", _accumulation, _ACCUMULATION_SQL)
register("rule_temporal_non_monotonic_accumulation", _accumulation, _ACCUMULATION_SQL)


def _rolling_sql(limit: float) -> str:
    return f"""WITH {B.LONG_CTE}, d AS (SELECT event_id, value, avg(value) OVER r AS m, stddev_samp(value) OVER r AS s, count(value) OVER r AS n FROM long
      WINDOW r AS ({_W.format(key='station_id')} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
    SELECT event_id, CASE WHEN value IS NULL OR n < 30 OR s IS NULL OR s <= 0 THEN 'NOT_CHECKED' WHEN round(abs(value - m) / s, 6) > {limit} THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM d"""


register(
    "win_08_rolling_z_score",
    _flag_of(B.long, ["station_id"], TP.rolling_z("z", "value", 30, 2.0)),
    _rolling_sql(2.0),
)
register(
    "rule_statistical_rolling_z_score",
    _flag_of(B.long, ["station_id"], TP.rolling_z("z", "value", 30, 4.0)),
    _rolling_sql(4.0),
)


@query(
    "win_10_minimum_group_size",
    f"WITH {B.LONG_CTE} SELECT event_id, count(*) OVER (PARTITION BY station_id, variable) >= 8 AS enough FROM long",
)
def group_size(spark, sf_dir):
    df = TP.apply_checks(
        B.long(spark, sf_dir), ["station_id", "variable"], ["ts", "event_id"], [TP.enough_rows("enough", 8)]
    )
    return df.select("event_id", "enough")


# --- completeness -------------------------------------------------------------------------------


def located(spark, sf_dir):
    """Events as reports: four in five on the hour, one in eleven special; zones of half of the stations are known."""
    df = B.table(spark, sf_dir, "events").selectExpr("user_id AS station_id", f"{_REPORT_TIME} AS ts", f"{_REPORT_TYPE} AS report_type")
    zoned = TP.with_station_zone(df, zoned_stations(spark, sf_dir))
    return zoned.withColumn("local_ts", S.local_time(F.col("ts"), F.col("timezone")))


def zoned_stations(spark, sf_dir):
    return B.stations(spark, sf_dir).selectExpr("user_id AS station_id", "CASE WHEN user_id % 2 = 0 THEN timezone END AS timezone")


def expected(spark, sf_dir):
    return TP.expected_grid(zoned_stations(spark, sf_dir), *PERIOD)


def received(spark, sf_dir):
    return TP.received_hours(located(spark, sf_dir), report_type="report_type")


PERIOD = ("2024-01-03", "2024-01-16")
_REPORT_TIME = "CASE WHEN event_id % 5 > 0 THEN date_trunc('hour', ts) ELSE ts END"
_REPORT_TYPE = "CASE WHEN event_id % 11 = 0 THEN 'SPECI' ELSE 'METAR' END"
_GRID_CTE = f"""{B.STATION_CTE}, loc AS (SELECT e.user_id AS station_id, {_REPORT_TIME} AT TIME ZONE 'UTC' AT TIME ZONE
    coalesce(CASE WHEN s.user_id % 2 = 0 THEN s.timezone END, 'America/Lima') AS t, {_REPORT_TYPE} AS report_type FROM events e LEFT JOIN stations s ON e.user_id = s.user_id),
  got AS (SELECT DISTINCT station_id, CAST(t AS DATE) AS local_date, CAST(hour(t) AS INT) AS local_hour FROM loc WHERE minute(t) = 0 AND report_type = 'METAR'),
  days AS (SELECT user_id AS station_id, CAST(unnest(generate_series(DATE '{PERIOD[0]}', DATE '{PERIOD[1]}', INTERVAL 1 DAY)) AS DATE) AS local_date FROM stations),
  grid AS (SELECT station_id, local_date, CAST(unnest(generate_series(6, 19)) AS INT) AS local_hour FROM days),
  gaps AS (SELECT * FROM grid ANTI JOIN got USING (station_id, local_date, local_hour))"""


def _missing(spark, sf_dir):
    return TP.missing_hours(expected(spark, sf_dir), received(spark, sf_dir))


register(
    "jon_04_expected_grid_anti_join", _missing,
    f"WITH {_GRID_CTE} SELECT station_id, local_date, local_hour FROM gaps",
)
register(
    "rule_completeness_expected_observations",
    lambda spark, sf_dir: _missing(spark, sf_dir).withColumn("flag", F.lit("MISSING")),
    f"WITH {_GRID_CTE} SELECT station_id, local_date, local_hour, 'MISSING' AS flag FROM gaps",
)

_RUNS_SQL = f"""WITH {_GRID_CTE}, n AS (SELECT *, date_diff('day', DATE '1970-01-01', local_date) * 14 + local_hour - 6 AS slot FROM gaps),
  i AS (SELECT *, slot - row_number() OVER (PARTITION BY station_id ORDER BY slot) AS island FROM n)
  SELECT station_id, count(*) AS missing_count, CAST(min(slot) AS BIGINT) AS first_slot, CAST(max(slot) AS BIGINT) AS last_slot FROM i GROUP BY station_id, island HAVING count(*) >= 2"""


def missing_runs(spark, sf_dir):
    runs = TP.missing_runs(expected(spark, sf_dir), received(spark, sf_dir))

    def slot(d, h):
        return F.unix_date(d).cast("bigint") * 14 + F.col(h) - 6

    return runs.select(
        "station_id", "missing_count", slot("first_date", "first_hour").alias("first_slot"),
        slot("last_date", "last_hour").alias("last_slot"),
    )


register("win_09_missing_runs", missing_runs, _RUNS_SQL)
register("rule_completeness_consecutive_missing", missing_runs, _RUNS_SQL)


@query(
    "agg_13_completeness",
    f"""WITH {_GRID_CTE} SELECT g.station_id, g.local_date, count(*) AS expected, count(r.local_hour) AS received, count(*) - count(r.local_hour) AS missing,
    round(count(r.local_hour) * 100.0 / count(*), 2) AS completeness_pct FROM grid g LEFT JOIN got r USING (station_id, local_date, local_hour) GROUP BY ALL""",
)
def daily_completeness(spark, sf_dir):
    return TP.completeness(expected(spark, sf_dir), received(spark, sf_dir))


# --- rules along one station's time -------------------------------------------------------------


def station_series(spark, sf_dir):
    return B.wide(spark, sf_dir)


_FRAME_RULES = {c.name: c for c in Q.observation_frame_checks("ts")}
_SQL_BY_RULE = {
    "temperature_persistence": _persist_sql("air_temperature_c", 6, 0.1, 80, "user_id", B.WIDE_CTE, "obs"),
    "temperature_temporal_step": _step_sql(
        "air_temperature_c", "12", "user_id", "OR h < 0.5 OR h > 1.5", B.WIDE_CTE
    ).replace("{t}", "obs"),
    "humidity_persistence": _persist_sql("relative_humidity_pct", 8, 1, 100, "user_id", B.WIDE_CTE, "obs"),
    "pressure_temporal_change": _step_sql("qnh_hpa", "10", "user_id", "", B.WIDE_CTE).replace("{t}", "obs"),
    "wind_persistence": _persist_sql(
        "wind_speed_kt", 8, 0, 100, "user_id", B.WIDE_CTE, "obs",
        "NOT (min(wind_speed_kt) OVER r >= 3 AND coalesce(round(max(wind_direction_deg) OVER r - min(wind_direction_deg) OVER r, 6) > 0, FALSE))",
    ),
    "wind_temporal_speed_change": _step_sql("wind_speed_kt", "40", "user_id", "", B.WIDE_CTE).replace("{t}", "obs"),
    "visibility_temporal_change": _step_sql(
        "prevailing_visibility_m", "9000", "user_id", "", B.WIDE_CTE
    ).replace("{t}", "obs"),
}
for _name, _sql in _SQL_BY_RULE.items():
    register(f"rule_{_name}", _flag_of(station_series, ["user_id"], _FRAME_RULES[_name]), _sql)


@query(
    "rule_precipitation_accumulation_inconsistent",
    f"""WITH {B.WIDE_CTE}, d AS (SELECT event_id, daily_precipitation_mm AS daily,
      round(sum(accumulated_precipitation_mm) OVER (PARTITION BY user_id, CAST(ts AS DATE)), 6) AS total FROM obs)
    SELECT event_id, CASE WHEN total IS NULL OR daily IS NULL THEN 'NOT_CHECKED' WHEN round(abs(total - daily), 6) > 0.1 THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM d""",
)
def accumulation(spark, sf_dir):
    df = B.wide(spark, sf_dir).withColumn("local_date", F.to_date("ts"))
    out = TP.daily_accumulation_flags(
        df, "user_id", "local_date", "accumulated_precipitation_mm", "daily_precipitation_mm"
    )
    return out.select("event_id", F.col("precipitation_accumulation_inconsistent").alias("flag"))


# --- generic temporal rules on the long form, thresholds per variable ----------------------------

THRESHOLDS = [("click", 20.0, 30.0), ("view", 15.0, 25.0), ("purchase", 40.0, 60.0), ("error", 5.0, 20.0)]
_THRESHOLD_VALUES = "thr(variable, step_per_hour, spike) AS (VALUES " + ", ".join(
    f"('{v}', {a}, {b})" for v, a, b in THRESHOLDS
) + ")"


def _advanced(rule: str):
    def run(spark, sf_dir):
        thresholds = spark.createDataFrame(THRESHOLDS, "variable string, step_per_hour double, spike double")
        frame = (coarse if rule in ("temporal_persistence", "temporal_repeated_pattern") else B.long)(spark, sf_dir)
        out = Q.advanced_quality(frame, thresholds, "event_id", "ts")
        return out.select("event_id", F.col(rule).alias("flag"))

    return run


_KEY = "station_id, variable"
_MEMBERS = "count(*) OVER (PARTITION BY station_id, variable)"
_GATED = f"(SELECT long.*, thr.step_per_hour, thr.spike, {_MEMBERS} AS members FROM long LEFT JOIN thr USING (variable))"
register(
    "rule_temporal_step", _advanced("temporal_step"),
    _step_sql("value", "step_per_hour", _KEY, "OR members < 3 OR step_per_hour IS NULL", f"{B.LONG_CTE}, {_THRESHOLD_VALUES}").replace("{t}", _GATED),
)
register(
    "rule_temporal_spike", _advanced("temporal_spike"),
    f"""WITH {B.LONG_CTE}, {_THRESHOLD_VALUES}, d AS (SELECT event_id, value AS x, spike, members, lag(value) OVER w AS p, lead(value) OVER w AS n
      FROM {_GATED} WINDOW w AS ({_W.format(key=_KEY)}))
    SELECT event_id, CASE WHEN members < 3 OR p IS NULL OR n IS NULL OR spike IS NULL THEN 'NOT_CHECKED'
      WHEN round(abs(x - (p + n) / 2) - abs(n - p) / 2, 6) > spike THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM d""",
)
register(
    "rule_temporal_persistence", _advanced("temporal_persistence"),
    _persist_sql("value", 6, 0, 100, _KEY, COARSE_CTE, "coarse"),
)
register(
    "rule_temporal_repeated_pattern", _advanced("temporal_repeated_pattern"),
    _pattern_sql(3, 3, COARSE_CTE, "coarse", _KEY, "OR members < 3"),
)


# --- climatology and whole-series statistics ----------------------------------------------------

# Stations 0-9 of the day part stand for months, the order year for the climate year.
_HISTORY = {
    "station_id": "o_orderpriority",
    "month": "CAST(month(o_orderdate) AS INT)",
    "hour": "CAST(o_custkey % 4 AS INT)",
    "variable": "o_orderstatus",
    "year": "CAST(year(o_orderdate) AS INT)",
    "value": "o_totalprice",
    "o_orderkey": "o_orderkey",
}
_HISTORY_CTE = "hist AS (SELECT " + ", ".join(f"{e} AS {n}" for n, e in _HISTORY.items()) + " FROM orders)"
CLIMATE_KEYS = ["station_id", "month", "hour", "variable"]
_CK = ", ".join(CLIMATE_KEYS)
# The orders span seven years, so the year gate is set to six here; thirty samples as declared.
_CLIMATE_CTE = f"""{_HISTORY_CTE}, ref AS (SELECT {_CK}, count(value) AS n, count(DISTINCT year) AS years, avg(value) AS mean, stddev_samp(value) AS std,
    quantile_cont(value, 0.01) AS p1, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS median,
    quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.99) AS p99 FROM hist GROUP BY {_CK}),
  devs AS (SELECT {_CK}, quantile_cont(abs(value - median), 0.5) AS mad FROM hist JOIN ref USING ({_CK}) GROUP BY {_CK}),
  clim AS (SELECT * FROM ref JOIN devs USING ({_CK}) WHERE years >= 6 AND n >= 30)"""


def history(spark, sf_dir):
    return B.table(spark, sf_dir, "orders").selectExpr(*[f"{e} AS {n}" for n, e in _HISTORY.items()])


def reference(spark, sf_dir):
    return climatology(history(spark, sf_dir), CLIMATE_KEYS, "value", "year", min_years=6)


_STATS = ["mean", "std", "p1", "p25", "median", "p75", "p99", "mad"]


@query(
    "agg_10_climatological_reference",
    f"WITH {_CLIMATE_CTE} SELECT {_CK}, n, years, " + ", ".join(f"round({c}, 6) AS {c}" for c in _STATS) + " FROM clim",
)
def climate_reference(spark, sf_dir):
    return reference(spark, sf_dir).select(
        *CLIMATE_KEYS, "n", "years", *[F.round(c, 6).alias(c) for c in _STATS]
    )


_CLIMATE_SQL = {
    "percentile": "WHEN p1 IS NULL THEN 'NOT_CHECKED' WHEN value < p1 OR value > p99",
    "z_score": "WHEN std IS NULL OR std <= 0 THEN 'NOT_CHECKED' WHEN round(abs(value - mean) / std, 6) > 4",
    "robust_z_score": "WHEN mad IS NULL OR mad <= 0 THEN 'NOT_CHECKED' WHEN round(0.6745 * abs(value - median) / mad, 6) > 4.5",
    "interquartile_range": "WHEN p25 IS NULL THEN 'NOT_CHECKED' WHEN value < p25 - 3 * (p75 - p25) OR value > p75 + 3 * (p75 - p25)",
    "median_absolute_deviation": "WHEN mad IS NULL OR mad <= 0 THEN 'NOT_CHECKED' WHEN round(abs(value - median) / mad, 6) > 6",
}


def _climate_flags(spark, sf_dir):
    return climatology_flags(history(spark, sf_dir), reference(spark, sf_dir), CLIMATE_KEYS, "value")


for _method, _test in _CLIMATE_SQL.items():
    register(
        f"rule_climatology_{_method}",
        (lambda m: lambda spark, sf_dir: _climate_flags(spark, sf_dir).select("o_orderkey", F.col(f"climatology_{m}").alias("flag")))(_method),
        f"WITH {_CLIMATE_CTE} SELECT o_orderkey, CASE {_test} THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM hist LEFT JOIN clim USING ({_CK})",
    )


@query(
    "jon_05_climatology_join",
    f"WITH {_CLIMATE_CTE} SELECT o_orderkey, round(value - median, 6) AS anomaly, years FROM hist LEFT JOIN clim USING ({_CK})",
)
def climate_join(spark, sf_dir):
    joined = history(spark, sf_dir).drop("year").join(reference(spark, sf_dir), CLIMATE_KEYS, "left")
    return joined.select("o_orderkey", F.round(F.col("value") - F.col("median"), 6).alias("anomaly"), "years")


_SERIES_CTE = f"""{B.LONG_CTE}, ref AS (SELECT station_id, count(value) AS n, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS median,
    quantile_cont(value, 0.75) AS p75 FROM long GROUP BY station_id),
  devs AS (SELECT station_id, quantile_cont(abs(value - median), 0.5) AS mad FROM long JOIN ref USING (station_id) GROUP BY station_id),
  stat AS (SELECT * FROM ref JOIN devs USING (station_id) WHERE n >= 30)"""


def _series(method: str):
    def run(spark, sf_dir):
        out = series_flags(B.long(spark, sf_dir), ["station_id"], "value")
        return out.select("event_id", F.col(f"statistical_{method}").alias("flag"))

    return run


for _method in ("interquartile_range", "median_absolute_deviation"):
    register(
        f"rule_statistical_{_method}", _series(_method),
        f"WITH {_SERIES_CTE} SELECT event_id, CASE {_CLIMATE_SQL[_method]} THEN 'SUSPECT' ELSE 'PASS' END AS flag FROM long LEFT JOIN stat USING (station_id)",
    )
