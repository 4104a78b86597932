"""Summaries, statistics and product tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverage_queries import bindings as B
from coverage_queries.q_grids import _GRID_CTE, _INGEST_STATS, _MELT_SQL, _TEXT_CTE, MELTED, prepared, rollup
from coverage_queries.q_time import _step_sql
from coverage_queries.registry import query, register
from obsguard.functions import scalars as S
from obsguard.operators import canonical as C
from obsguard.operators import framework as FW
from obsguard.operators import grid as G
from obsguard.operators import summary as SM
from obsguard.operators import temporal as TP
from obsguard.sinks.writers import run_log

# --- the flagship: step rule, results, score, summary -------------------------------------------

_STEP = _step_sql("value", "40", "station_id", "OR h < 0.5 OR h > 1.5", B.LONG_CTE).replace("{t}", "long")
FLAGSHIP_SQL = f"""WITH flags AS ({_STEP}) SELECT e.user_id AS station_id, e.event_type AS variable, f.flag, count(*) AS observations,
    CAST(sum(CASE f.flag WHEN 'SUSPECT' THEN 90 ELSE 100 END) AS BIGINT) AS score_sum FROM flags f JOIN events e USING (event_id) GROUP BY ALL"""


@query("flagship_step_quality_summary", FLAGSHIP_SQL)
def flagship(spark, sf_dir):
    """Step check on every station, results array and score per observation, summary by variable and flag."""
    flagged = TP.apply_checks(
        B.long(spark, sf_dir), ["station_id"], ["ts", "event_id"],
        [TP.step("temporal_step", "value", "ts", 40.0, 30, 90)],
    )
    check = FW.Check("temporal_step", F.col("temporal_step"), "value", F.col("value"), "40 per hour")
    scored = FW.assess(FW.evaluate(flagged, [check]))
    return scored.groupBy("station_id", "variable", F.col("qc_results")[0]["flag"].alias("flag")).agg(
        F.count(F.lit(1)).alias("observations"), F.sum(F.col("qc_score").cast("bigint")).alias("score_sum")
    )


@query(
    "ord_04_report_row_cap",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def row_cap(spark, sf_dir):
    df = B.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return SM.limit_rows(df, [F.desc("o_totalprice"), F.col("o_orderkey")], 100)


_STAT_COLUMNS = ["mean", "minimum", "maximum", "standard_deviation", "median"]
_DESCRIBE_SQL = f"""WITH {B.WIDE_CTE}, m AS ({_MELT_SQL}) SELECT user_id AS station_id, variable, count(*) AS observations, count(*) FILTER (value IS NULL) AS missing,
    round(count(*) FILTER (value IS NULL) * 100.0 / count(*), 4) AS missing_pct, round(avg(value), 6) AS mean, min(value) AS minimum, max(value) AS maximum,
    round(stddev_samp(value), 6) AS standard_deviation, round(quantile_cont(value, 0.5), 6) AS median FROM m GROUP BY user_id, variable"""


@query("agg_07_descriptive_statistics", _DESCRIBE_SQL)
def describe(spark, sf_dir):
    long_df = C.melt(B.wide(spark, sf_dir), ["event_id", "user_id"], MELTED).withColumnRenamed("user_id", "station_id")
    out = SM.descriptive_statistics(long_df, ["station_id", "variable"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "standard_deviation", "median")})


# Values with their flag by the step rule, and the copies of a station's hour, in one table of statistics.
_STATISTICS_SQL = f"""WITH flags AS ({_STEP}), rows_ AS (SELECT e.event_type AS variable, e.user_id AS station_id, e.value, f.flag,
      row_number() OVER (PARTITION BY e.user_id, e.event_type, date_trunc('hour', e.ts) ORDER BY e.event_id) > 1 AS copy FROM flags f JOIN events e USING (event_id))
    SELECT station_id, variable, count(*) AS observations, count(*) FILTER (value IS NULL) AS missing, round(count(*) FILTER (value IS NULL) * 100.0 / count(*), 4) AS missing_pct,
    count(*) FILTER (flag = 'PASS') AS passed, count(*) FILTER (flag = 'SUSPECT') AS suspect, count(*) FILTER (flag = 'ERROR') AS errors,
    round(count(*) FILTER (flag = 'PASS') * 100.0 / count(*), 4) AS passed_pct, count(*) FILTER (copy) AS duplicates, round(avg(value), 8) AS mean, min(value) AS minimum,
    max(value) AS maximum, round(stddev_samp(value), 8) AS standard_deviation, round(quantile_cont(value, 0.5), 8) AS median FROM rows_ GROUP BY ALL"""


def statistics(spark, sf_dir):
    flagged = TP.apply_checks(
        B.long(spark, sf_dir), ["station_id"], ["ts", "event_id"], [TP.step("flag", "value", "ts", 40.0, 30, 90)]
    ).withColumn("_hour", F.date_trunc("hour", "ts"))
    marked = TP.mark_duplicates(flagged, ["station_id", "variable", "_hour"], ["event_id"], "_copy")
    out = SM.descriptive_statistics(marked.withColumn("_copy", F.col("_copy") == "ERROR"), ["station_id", "variable"], "value", "flag", "_copy")
    return out.withColumns({c: F.round(c, 8) for c in ("mean", "standard_deviation", "median")})


register("agg_07_statistics_table", statistics, _STATISTICS_SQL)
register("agg_19_statistics_report", statistics, _STATISTICS_SQL)


@query(
    "agg_07_flag_totals",
    f"""WITH flags AS ({_STEP}) SELECT e.event_type AS variable, count(*) AS observations, count(*) FILTER (flag = 'PASS') AS passed,
    count(*) FILTER (flag = 'SUSPECT') AS suspect, count(*) FILTER (flag = 'ERROR') AS errors, round(count(*) FILTER (flag = 'PASS') * 100.0 / count(*), 4) AS passed_pct
    FROM flags JOIN events e USING (event_id) GROUP BY ALL""",
)
def flag_totals(spark, sf_dir):
    flagged = TP.apply_checks(
        B.long(spark, sf_dir), ["station_id"], ["ts", "event_id"], [TP.step("flag", "value", "ts", 40.0, 30, 90)]
    )
    return SM.flag_totals(flagged, ["variable"], "flag")


# --- products -----------------------------------------------------------------------------------


@query(
    "agg_11_monthly_climatology",
    """SELECT o_orderpriority AS station_id, CAST(month(o_orderdate) AS INT) AS month, round(avg(o_totalprice), 6) AS mean, min(o_totalprice) AS minimum,
    max(o_totalprice) AS maximum, count(o_totalprice) AS n FROM orders GROUP BY ALL""",
)
def monthly(spark, sf_dir):
    df = B.table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "station_id")
    out = SM.monthly_climatology(df, ["station_id"], "o_orderdate", "o_totalprice")
    return out.withColumn("mean", F.round("mean", 6))


@query(
    "agg_12_daily_extremes",
    f"""WITH {B.WIDE_CTE}, {B.STATION_CTE}, l AS (SELECT obs.*, CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE coalesce(s.timezone, 'America/Lima') AS DATE) AS local_date
      FROM obs LEFT JOIN stations s ON obs.user_id = s.user_id)
    SELECT user_id AS station_id, local_date, max(air_temperature_c) AS maximum_temperature,
    min(air_temperature_c) AS minimum_temperature, round(sum(accumulated_precipitation_mm), 6) AS precipitation_total FROM l GROUP BY ALL""",
)
def extremes(spark, sf_dir):
    zones = B.stations(spark, sf_dir).select(F.col("user_id").alias("station_id"), "timezone")
    obs = B.wide(spark, sf_dir).select(F.col("user_id").alias("station_id"), "ts", "air_temperature_c", "accumulated_precipitation_mm")
    df = TP.with_station_zone(obs, zones).withColumn("local_date", F.to_date(S.local_time(F.col("ts"), F.col("timezone"))))
    out = SM.daily_extremes(df, ["station_id"], "local_date", "air_temperature_c", "accumulated_precipitation_mm")
    return out.withColumn("precipitation_total", F.round("precipitation_total", 6))


@query(
    "agg_14_histogram",
    f"""WITH {B.LONG_CTE} SELECT variable, CAST(floor(value / 25.0) AS BIGINT) AS bin, count(*) AS n, floor(value / 25.0) * 25.0 AS bin_start
    FROM long GROUP BY ALL""",
)
def histogram(spark, sf_dir):
    return SM.histogram(B.long(spark, sf_dir), ["variable"], 25.0)


_HOURS = list(range(24))


@query(
    "agg_15_heat_map",
    f"""WITH {B.LONG_CTE} SELECT station_id, {", ".join(f"round(avg(value) FILTER (hour(ts) = {h}), 6) AS mean_{h}" for h in _HOURS)} FROM long GROUP BY station_id""",
)
def heat(spark, sf_dir):
    return SM.heat_map(
        B.long(spark, sf_dir), "station_id", F.hour("ts"), _HOURS, F.round(F.avg("value"), 6), "mean"
    )


@query(
    "agg_16_wind_rose",
    f"""WITH {B.WIDE_CTE}, w AS (SELECT CASE WHEN wind_speed_kt = 0 THEN -1 ELSE CAST(floor(((wind_direction_deg + 11.25) - 360 * floor((wind_direction_deg + 11.25) / 360)) / 22.5) AS INT) END AS sector,
      CASE WHEN wind_speed_kt = 0 THEN 0 WHEN wind_speed_kt < 1 THEN 0 WHEN wind_speed_kt < 7 THEN 1 WHEN wind_speed_kt < 14 THEN 2 WHEN wind_speed_kt < 21 THEN 3
        WHEN wind_speed_kt < 28 THEN 4 ELSE 5 END AS speed_class FROM obs WHERE wind_speed_kt IS NOT NULL AND (wind_speed_kt = 0 OR wind_direction_deg IS NOT NULL))
    SELECT sector, speed_class, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM w), 4) AS share_pct FROM w GROUP BY ALL""",
)
def rose(spark, sf_dir):
    return SM.wind_rose(B.wide(spark, sf_dir), "wind_direction_deg", "wind_speed_kt")


@query(
    "agg_17_missing_summary",
    f"""WITH {B.WIDE_CTE}, m AS ({_MELT_SQL}) SELECT user_id AS station_id, variable, count(*) AS observations, count(*) FILTER (value IS NULL) AS missing,
    round(count(*) FILTER (value IS NULL) * 100.0 / count(*), 4) AS missing_pct FROM m GROUP BY user_id, variable""",
)
def missing(spark, sf_dir):
    long_df = C.melt(B.wide(spark, sf_dir), ["event_id", "user_id"], MELTED).withColumnRenamed("user_id", "station_id")
    return SM.missing_summary(long_df, ["station_id", "variable"])


@query(
    "agg_17_duplicate_summary",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_groups(spark, sf_dir):
    return SM.duplicate_summary(B.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "agg_18_time_series",
    " UNION ALL ".join(
        f"SELECT '{p}' AS resolution, user_id AS station_id, event_type AS variable, date_trunc('{p}', ts) AS period, round(avg(value), 6) AS mean, count(value) AS n FROM events GROUP BY ALL"
        for p in ("hour", "day", "month")
    ),
)
def series(spark, sf_dir):
    means = SM.rolled_means(B.long(spark, sf_dir), ["station_id", "variable"], "ts", ["hour", "day", "month"])
    return means.withColumn("mean", F.round("mean", 6))


# The import report is the statistics of AGG-02 as a metric table; the others are the tables above.
_METRICS = [
    "files_processed", "files_successful", "files_failed", "files_skipped", "stations_found", "sheets_read",
    "empty_sheets_ignored", "rows_before_cleanup", "empty_rows_removed", "rows_read", "empty_columns_removed",
    "headerless_columns_with_data",
]


@query(
    "agg_19_import_report",
    "WITH s AS (" + _INGEST_STATS + ") "
    + " UNION ALL ".join(
        f"SELECT 'run-1' AS run_id, 'stage02' AS stage, '{m}' AS metric, CAST({m} AS VARCHAR) AS value FROM s" for m in _METRICS
    ),
)
def import_report(spark, sf_dir):
    return run_log(spark, "run-1", "stage02", G.ingestion_statistics(rollup(spark, sf_dir)))


@query(
    "agg_19_preprocessing_report",
    f"""WITH {_TEXT_CTE}, c AS (SELECT 'station_id' AS field, 'normalize_case' AS reason FROM txt
      UNION ALL SELECT 'report_status', 'normalize_case' FROM txt)
    SELECT field, reason, count(*) AS corrections FROM c GROUP BY ALL""",
)
def preprocessing_report(spark, sf_dir):
    """What preparation changed, by field and reason."""
    entries = prepared(spark, sf_dir).select(F.explode("corrections").alias("c"))
    return entries.groupBy(F.col("c.field").alias("field"), F.col("c.reason").alias("reason")).agg(F.count(F.lit(1)).alias("corrections"))


@query(
    "agg_19_graphics_data",
    f"""WITH {B.LONG_CTE} SELECT 'histogram' AS product, variable AS series, CAST(floor(value / 25.0) * 25.0 AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS y FROM long GROUP BY variable, floor(value / 25.0)
    UNION ALL SELECT 'hourly_mean', variable, CAST(hour(ts) AS DOUBLE), round(avg(value), 8) FROM long GROUP BY variable, hour(ts)
    UNION ALL SELECT 'daily_count', variable, CAST(epoch_us(date_trunc('day', ts)) / 86400000000 AS DOUBLE), CAST(count(*) AS DOUBLE) FROM long GROUP BY variable, date_trunc('day', ts)""",
)
def graphics(spark, sf_dir):
    """The points behind the charts as one tidy table: histogram, day curve, series; one scan and one exchange."""
    long_df = B.long(spark, sf_dir)
    x = F.col("value")
    points = F.array(
        F.struct(F.lit("histogram").alias("product"), (F.floor(x / 25.0) * 25.0).cast("double").alias("x")),
        F.struct(F.lit("hourly_mean").alias("product"), F.hour("ts").cast("double").alias("x")),
        F.struct(F.lit("daily_count").alias("product"), F.unix_date(F.to_date("ts")).cast("double").alias("x")),
    )
    spread = long_df.select(F.col("variable").alias("series"), "value", F.explode(points).alias("p"))
    rolled = spread.groupBy("p.product", "series", "p.x").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("m"))
    y = F.when(F.col("product") == "hourly_mean", F.round("m", 8)).otherwise(F.col("n").cast("double"))
    return rolled.select("product", "series", "x", y.alias("y"))
