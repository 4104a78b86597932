"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from coverage_queries import bindings as B
from coverage_queries.registry import query
from obsguard.catalogs import dimensions as dim
from obsguard.functions import scalars as S
from obsguard.operators import canonical as C

_NB = " "


@query(
    "str_01_trim_and_collapse",
    f"SELECT doc_id, sha256(trim(regexp_replace(text, '[\\s{_NB}]+', ' ', 'g'))) AS squeezed FROM documents",
)
def squeeze(spark, sf_dir):
    return B.table(spark, sf_dir, "documents").select("doc_id", F.sha2(S.squeeze(F.col("text")), 256).alias("squeezed"))


@query(
    "str_02_case_normalisation",
    f"WITH {B.WIDE_CTE} SELECT event_id, upper(station_id) AS station_id, upper(report_type) AS report_type,"
    " upper(report_status) AS report_status, upper(present_weather_1) AS present_weather_1 FROM obs",
)
def upper_case(spark, sf_dir):
    fields = ["station_id", "report_type", "report_status", "present_weather_1"]
    return S.upper_fields(B.wide(spark, sf_dir).select("event_id", *fields), fields)


@query(
    "str_03_decimal_separator",
    "SELECT event_id, CAST(value AS DOUBLE) AS parsed FROM events",
)
def decimals(spark, sf_dir):
    text = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    return B.table(spark, sf_dir, "events").select("event_id", S.parse_double(text).alias("parsed"))


@query(
    "str_04_unicode_folding",
    """WITH s AS (SELECT DISTINCT source, lang FROM documents)
    SELECT source, lang, '1o ' || source || ' °C 2 x ' || lang AS folded FROM s""",
)
def folding(spark, sf_dir):
    heads = B.table(spark, sf_dir, "documents").select("source", "lang").distinct()
    raw = F.concat(F.lit("1º" + _NB), F.col("source"), F.lit(" °C  ２ x "), F.col("lang"), F.lit(" "))
    return heads.select("source", "lang", S.normalize_header(S.nfkc(raw)).alias("folded"))


_SIZE_SQL = """CASE WHEN s < 1024 THEN format('{{:,.2f}} B', s) WHEN s < 1048576 THEN format('{{:,.2f}} KB', s / 1024)
  WHEN s < 1073741824 THEN format('{{:,.2f}} MB', s / 1048576) WHEN s < 1099511627776 THEN format('{{:,.2f}} GB', s / 1073741824)
  ELSE format('{{:,.2f}} TB', s / 1099511627776) END"""


@query(
    "str_05_human_readable_size",
    f"""WITH t AS (SELECT doc_id, CAST(n_chars AS DOUBLE) * pow(2, doc_id % 45) AS s FROM documents)
    SELECT doc_id, {_SIZE_SQL.replace('{{', '{').replace('}}', '}')} AS size FROM t""",
)
def sizes(spark, sf_dir):
    docs = B.table(spark, sf_dir, "documents")
    size = F.col("n_chars") * F.pow(F.lit(2.0), F.col("doc_id") % 45)
    return docs.select("doc_id", S.format_size(size).alias("size"))


_TOKEN = (
    "CASE event_id % 9 WHEN 0 THEN ' NA ' WHEN 1 THEN '--' WHEN 2 THEN 'nan' WHEN 3 THEN '' WHEN 4 THEN NULL"
    " WHEN 5 THEN '9999' WHEN 6 THEN '-999' ELSE CAST(k AS STRING) END"
)


@query(
    "str_06_missing_tokens",
    f"""WITH {B.BASE_CTE}, t AS (SELECT event_id, {_TOKEN} AS raw FROM base), p AS (SELECT event_id, CASE WHEN trim(raw) NOT IN
      ('', '-', '--', '---', 'NA', 'N/A', 'NULL', 'NONE', 'NaN', 'nan') THEN raw END AS text FROM t)
    SELECT event_id, text, CASE WHEN CAST(text AS DOUBLE) NOT IN (-999, -9999, 9999, 99999) THEN CAST(text AS DOUBLE) END AS temperature,
      CAST(text AS DOUBLE) AS visibility FROM p""",
)
def missing_tokens(spark, sf_dir):
    df = B.base(spark, sf_dir).selectExpr("event_id", f"{_TOKEN} AS text")
    df = df.withColumn("text", S.missing_text_to_null(F.col("text")))
    number = S.parse_double(F.col("text"))
    return df.select(
        "event_id", "text", S.missing_number_to_null(number).alias("temperature"), number.alias("visibility")
    )


@query(
    "str_07_column_letters",
    """SELECT p_partkey, CASE WHEN n < 26 THEN chr(CAST(65 + n AS INT))
      WHEN n < 702 THEN chr(CAST(64 + n // 26 AS INT)) || chr(CAST(65 + n % 26 AS INT))
      ELSE chr(CAST(65 + (n - 702) // 676 AS INT)) || chr(CAST(65 + (n - 702) % 676 // 26 AS INT)) || chr(CAST(65 + (n - 702) % 26 AS INT)) END AS letter
    FROM (SELECT p_partkey, p_partkey % 18278 AS n FROM part)""",
)
def letters(spark, sf_dir):
    return B.table(spark, sf_dir, "part").select(
        "p_partkey", S.column_letter(F.col("p_partkey") % 18278 + 1).alias("letter")
    )


_TOKENS_SQL = "SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents"


@query(
    "str_08_weather_groups",
    f"""WITH {B.WIDE_CTE}, codes AS (SELECT present_weather_1 AS code FROM obs UNION ALL SELECT present_weather_2 FROM obs
      UNION ALL SELECT present_weather_3 FROM obs), P AS (SELECT 'DZ|RA|SN|SG|IC|PL|GR|GS|UP|FG|BR|HZ|FU|DU|SA|VA|PO|SQ|FC|SS|DS' AS p)
    SELECT code, regexp_matches(code, '^[+-]?((MI|BC|PR|DR|BL|SH|TS|FZ)(' || p || ')*|(' || p || ')+)$') AS valid,
      regexp_matches(code, '^([+-]|VC)?((MI|BC|PR|DR|BL|SH|TS|FZ)(' || p || ')*|(' || p || ')+)$') AS valid_with_vicinity, count(*) AS n
    FROM codes, P WHERE code IS NOT NULL GROUP BY ALL""",
)
def weather_groups(spark, sf_dir):
    codes = B.wide(spark, sf_dir).select(F.explode(S.weather_codes()).alias("code"))
    counted = codes.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        "code",
        S.weather_code_valid(F.col("code")).alias("valid"),
        S.weather_code_valid(F.col("code"), allow_vicinity=True).alias("valid_with_vicinity"),
        "n",
    )


# value in a spelled unit -> target unit
_CONVERT = (
    "given AS (SELECT event_id, value, CASE event_id % 8 WHEN 0 THEN 'kt' WHEN 1 THEN 'mps' WHEN 2 THEN 'K' WHEN 3 THEN 'ft'"
    " WHEN 4 THEN 'mbar' WHEN 5 THEN 'km' WHEN 6 THEN 'furlong' ELSE 'pct' END AS unit,"
    " CASE event_id % 8 WHEN 0 THEN 'speed_meter_per_second' WHEN 1 THEN 'speed_knot' WHEN 2 THEN 'temperature_celsius'"
    " WHEN 3 THEN 'length_meter' WHEN 4 THEN 'pressure_pascal' WHEN 5 THEN 'length_foot' WHEN 6 THEN 'length_meter'"
    " ELSE 'temperature_kelvin' END AS target_unit FROM events)"
)


@query(
    "num_01_unit_conversion",
    f"""WITH {_CONVERT} SELECT event_id, CASE unit WHEN 'kt' THEN round(value * 0.5144444444, 1)
      WHEN 'mps' THEN round(value / 0.5144444444, 1) WHEN 'K' THEN CAST(round(CAST(value AS DECIMAL(18,4)) - 273.15, 1) AS DOUBLE) WHEN 'ft' THEN round(value * 0.3048, 0)
      WHEN 'mbar' THEN round(value * 100, 0) WHEN 'km' THEN round(value * 1000 / 0.3048, 0) END AS converted FROM given""",
)
def unit_conversion(spark, sf_dir):
    given = B.table(spark, sf_dir, "events").selectExpr(
        "event_id", "value",
        "CASE event_id % 8 WHEN 0 THEN 'kt' WHEN 1 THEN 'mps' WHEN 2 THEN 'K' WHEN 3 THEN 'ft'"
        " WHEN 4 THEN 'mbar' WHEN 5 THEN 'km' WHEN 6 THEN 'furlong' ELSE 'pct' END AS unit",
        "CASE event_id % 8 WHEN 0 THEN 'speed_meter_per_second' WHEN 1 THEN 'speed_knot' WHEN 2 THEN 'temperature_celsius'"
        " WHEN 3 THEN 'length_meter' WHEN 4 THEN 'pressure_pascal' WHEN 5 THEN 'length_foot' WHEN 6 THEN 'length_meter'"
        " ELSE 'temperature_kelvin' END AS target_unit",
    )
    out = C.convert_units(given, "value", dim.unit_aliases(spark), dim.units(spark))
    return out.select("event_id", F.col("converted_value").alias("converted"))


@query(
    "num_02_angles",
    f"""WITH {B.BASE_CTE}, a AS (SELECT event_id, CAST(c - 20000 AS DOUBLE) AS x, CAST(k * 7 AS DOUBLE) AS y FROM base)
    SELECT event_id, x - 360 * floor(x / 360) AS wrapped,
      least((x - y) - 360 * floor((x - y) / 360), (y - x) - 360 * floor((y - x) / 360)) AS apart FROM a""",
)
def angles(spark, sf_dir):
    x, y = (F.col("c") - 20000).cast("double"), (F.col("k") * 7).cast("double")
    return B.base(spark, sf_dir).select(
        "event_id", S.wrap_angle(x).alias("wrapped"), S.angle_difference(x, y).alias("apart")
    )


@query(
    "num_03_rounding",
    # Both sides round the decimal value: noise of the binary quotient is cleared first.
    "WITH q AS (SELECT event_id, round(value / 7, 9) AS x FROM events) SELECT event_id, round(x, 2) AS two, round(x, 0) AS zero,"
    " CASE event_id % 3 WHEN 0 THEN round(x, 0) WHEN 1 THEN round(x, 1) ELSE round(x, 2) END AS per_row FROM q",
)
def rounding(spark, sf_dir):
    x = F.col("value") / 7
    return B.table(spark, sf_dir, "events").select(
        "event_id", S.round_half_up(x, 2).alias("two"), S.round_half_up(x, 0).alias("zero"),
        S.round_to(x, F.col("event_id") % 3).alias("per_row"),
    )


_HAVERSINE = (
    "2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin((radians({b}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({b}))"
    " * pow(sin(radians({d} - {c}) / 2), 2))))"
)


@query(
    "num_04_haversine_distance",
    f"WITH {B.STATION_CTE} SELECT station_id, round({_HAVERSINE.format(a='latitude', b='(-12.0)', c='longitude', d='(-77.0)')}, 6) AS km FROM stations",
)
def distances(spark, sf_dir):
    d = S.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(-12.0), F.lit(-77.0))
    return B.stations(spark, sf_dir).select("station_id", F.round(d, 6).alias("km"))


@query(
    "num_05_relative_humidity",
    f"""WITH {B.WIDE_CTE} SELECT event_id, round(100 * exp(17.62 * dew_point_temperature_c / (243.12 + dew_point_temperature_c))
      / exp(17.62 * air_temperature_c / (243.12 + air_temperature_c)), 6) AS rh FROM obs""",
)
def humidity(spark, sf_dir):
    rh = S.relative_humidity(F.col("air_temperature_c"), F.col("dew_point_temperature_c"))
    return B.wide(spark, sf_dir).select("event_id", F.round(rh, 6).alias("rh"))


_RAW_INT = (
    "CASE event_id % 5 WHEN 0 THEN CAST(k AS STRING) WHEN 1 THEN concat(CAST(k AS STRING), ',5') WHEN 2 THEN 'x'"
    " WHEN 3 THEN NULL ELSE ' 7 ' END"
)


@query(
    "num_06_typed_parse",
    f"""WITH {B.BASE_CTE}, r AS (SELECT event_id, {_RAW_INT} AS raw FROM base),
    n AS (SELECT event_id, raw, TRY_CAST(replace(trim(raw), ',', '.') AS DOUBLE) AS x FROM r)
    SELECT event_id, CASE WHEN x = floor(x) THEN CAST(x AS BIGINT) END AS as_integer, x AS as_number,
      coalesce(raw IS NOT NULL AND x IS NULL, FALSE) AS number_failed FROM n""",
)
def typed(spark, sf_dir):
    df = B.base(spark, sf_dir).selectExpr("event_id", f"{_RAW_INT} AS raw")
    number = S.typed_parse(F.col("raw"), "number")
    return df.select(
        "event_id", S.typed_parse(F.col("raw"), "integer").alias("as_integer"), number.alias("as_number"),
        F.coalesce(S.parse_failed(F.col("raw"), number), F.lit(False)).alias("number_failed"),
    )


@query(
    "dat_01_datetime_from_parts",
    f"WITH {B.WIDE_CTE} SELECT event_id, {B.SQL_TIME} AS datetime_utc FROM obs",
)
def from_parts(spark, sf_dir):
    return C.with_datetime(B.wide(spark, sf_dir)).select("event_id", "datetime_utc")


@query(
    "dat_02_local_time",
    f"""WITH {B.STATION_CTE} SELECT event_id, ts AT TIME ZONE 'UTC' AT TIME ZONE s.timezone AS local_ts,
    CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE s.timezone AS DATE) AS local_date FROM events e JOIN stations s ON e.user_id = s.user_id""",
)
def local(spark, sf_dir):
    zones = B.stations(spark, sf_dir).select("user_id", "timezone")
    ts = S.local_time(F.col("ts"), F.col("timezone"))
    return B.table(spark, sf_dir, "events").join(zones, "user_id").select(
        "event_id", ts.alias("local_ts"), F.to_date(ts).alias("local_date")
    )


@query(
    "dat_03_component_ranges",
    f"""WITH {B.WIDE_CTE} SELECT event_id, month BETWEEN 1 AND 12 AS month_ok, hour_utc BETWEEN 0 AND 23 AS hour_ok,
    minute BETWEEN 0 AND 59 AS minute_ok FROM obs""",
)
def component_ranges(spark, sf_dir):
    return B.wide(spark, sf_dir).select(
        "event_id", F.col("month").between(1, 12).alias("month_ok"), F.col("hour_utc").between(0, 23).alias("hour_ok"),
        F.col("minute").between(0, 59).alias("minute_ok"),
    )


@query("dat_04_iso_format", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso FROM events")
def iso(spark, sf_dir):
    return B.table(spark, sf_dir, "events").select("event_id", S.iso_utc(F.col("ts")).alias("iso"))


_LAYERS = [1, 2, 3]


@query(
    "arr_01_cloud_layers",
    f"""WITH {B.WIDE_CTE} SELECT event_id,
    {" + ".join(f"CASE WHEN cloud_amount_{i} IS NOT NULL THEN 1 ELSE 0 END" for i in _LAYERS)} AS layers,
    least({", ".join(f"CASE WHEN cloud_amount_{i} IN ('BKN','OVC') THEN cloud_base_height_{i}_ft END" for i in _LAYERS)}) AS ceiling_ft FROM obs""",
)
def layers(spark, sf_dir):
    ls = S.cloud_layers()
    covered = F.filter(ls, lambda c: F.coalesce(c["amount"].isin("BKN", "OVC"), F.lit(False)))
    return B.wide(spark, sf_dir).select(
        "event_id",
        F.size(F.filter(ls, lambda c: c["amount"].isNotNull())).alias("layers"),
        F.array_min(F.transform(covered, lambda c: c["height"])).alias("ceiling_ft"),
    )


@query(
    "arr_02_present_weather_array",
    f"WITH {B.WIDE_CTE} SELECT event_id, concat_ws(' ', present_weather_1, present_weather_2, present_weather_3) AS codes FROM obs",
)
def weather_array(spark, sf_dir):
    return B.wide(spark, sf_dir).select("event_id", F.concat_ws(" ", S.weather_codes()).alias("codes"))


@query(
    "jsn_01_json_output",
    """SELECT event_type, '{"event_type":"' || event_type || '","n":' || count(*) || ',"users":' || count(DISTINCT user_id) || '}' AS state
    FROM events GROUP BY event_type""",
)
def json_state(spark, sf_dir):
    state = B.table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users")
    )
    return state.select("event_type", F.to_json(F.struct("event_type", "n", "users")).alias("state"))


@query(
    "map_01_code_descriptions",
    f"""WITH {B.WIDE_CTE} SELECT event_id, CASE cloud_amount_1 WHEN 'SKC' THEN 'Sky Clear' WHEN 'CLR' THEN 'Clear' WHEN 'FEW' THEN 'Few Clouds'
      WHEN 'SCT' THEN 'Scattered Clouds' WHEN 'BKN' THEN 'Broken Clouds' WHEN 'OVC' THEN 'Overcast' WHEN 'NSC' THEN 'No Significant Clouds'
      WHEN 'NCD' THEN 'No Cloud Detected' WHEN 'VV' THEN 'Vertical Visibility' END AS description,
      CASE cloud_amount_1 WHEN 'SKC' THEN '0' WHEN 'CLR' THEN '0' WHEN 'FEW' THEN '1-2' WHEN 'SCT' THEN '3-4' WHEN 'BKN' THEN '5-7' WHEN 'OVC' THEN '8' END AS oktas
    FROM obs""",
)
def descriptions(spark, sf_dir):
    c = F.col("cloud_amount_1")
    return B.wide(spark, sf_dir).select(
        "event_id", S.describe_code(c, "cloud_codes").alias("description"), S.cloud_oktas(c).alias("oktas")
    )
