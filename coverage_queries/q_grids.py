"""Cell grids: every supplier is a file, every return flag a sheet, line items are its rows.

The header row is deformed in a different way for each supplier, some rows and columns are blank,
and a sheet of blanks is added per file. Lines are made as text and split in each engine.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from coverage_queries import bindings as B
from coverage_queries.registry import query, register
from obsguard.catalogs import contract
from obsguard.operators import canonical as C
from obsguard.operators import grid as G
from obsguard.plans import quality as Q

NBSP = " "
HEADERS = [
    "Order", "Part", "Line", "Quantity", "Price", "Discount", "Tax", "Return flag", "Status", "Ship date", "Mode",
]
NAMES = ["order_key", "part_key", "line", "quantity", "price", "discount", "tax", "flag", "status", "ship_date", "mode"]
ALIASES = {"Pedido": "Order", "Fecha": "Ship date"}


def _line(headers: list[str]) -> str:
    return "'" + "|".join(headers) + "'"


def _swap(h: list[str], i: int, text: str) -> list[str]:
    return h[:i] + [text] + h[i + 1:]


_HEADER_LINE = (
    "CASE s_suppkey % 9 "
    f"WHEN 1 THEN {_line([HEADERS[1], HEADERS[0], *HEADERS[2:]])} "
    f"WHEN 2 THEN {_line(HEADERS[:-1])} "
    f"WHEN 3 THEN {_line([*HEADERS, 'Note'])} "
    f"WHEN 4 THEN {_line([*HEADERS, 'Line'])} "
    f"WHEN 5 THEN {_line(_swap(HEADERS, 2, ' '))} "
    f"WHEN 6 THEN {_line(_swap(HEADERS, 0, 'Pedido'))} "
    f"WHEN 7 THEN {_line(_swap(HEADERS, 7, f'  Return{NBSP} flag '))} "
    f"ELSE CASE WHEN s_suppkey % 10 = 0 THEN {_line(_swap(HEADERS, 6, ''))} ELSE {_line(HEADERS)} END END"
)
_DATA_LINE = (
    f"CASE WHEN l_orderkey % 11 = 0 THEN ' ||\t| |{NBSP}||||||' ELSE concat("
    "CAST(l_orderkey AS STRING), '|', CAST(l_partkey AS STRING), '|', CAST(l_linenumber AS STRING), '|',"
    " CASE WHEN l_orderkey % 3 = 0 THEN '  ' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END, '|',"
    " CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS STRING), '|', CAST(CAST(round(l_discount * 100) AS INT) AS STRING), '|',"
    " CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE CAST(CAST(round(l_tax * 100) AS INT) AS STRING) END, '|',"
    " l_returnflag, '|', l_linestatus, '|', substr(CAST(l_shipdate AS STRING), 1, 10), '|') END"
)
_FILE = "concat('sup_', CAST({} AS STRING), '.csv')"
_ROW = "CAST(l_orderkey * 10 + l_linenumber + 2 AS BIGINT)"

_GRID_CTE = rf"""lines AS (
    SELECT {_FILE.format('s_suppkey')} AS source_file, sheet AS source_sheet, 1 AS source_row, {_HEADER_LINE} AS line
      FROM supplier, (VALUES ('A'), ('N'), ('R')) v(sheet)
    UNION ALL SELECT {_FILE.format('s_suppkey')}, 'blank', 1, ' |  | ' FROM supplier
    UNION ALL SELECT {_FILE.format('l_suppkey')}, l_returnflag, {_ROW}, {_DATA_LINE} FROM lineitem),
  grid AS (SELECT source_file, source_sheet, source_row,
    list_transform(string_split(line, '|'), lambda c: CASE WHEN regexp_matches(c, '^[\s{NBSP}]*$') THEN NULL ELSE c END) AS cells FROM lines),
  marked AS (SELECT *, len(list_filter(cells, lambda c: c IS NOT NULL)) > 0 AS has FROM grid),
  cellpos AS (SELECT source_file, source_sheet, unnest(cells) AS cell, generate_subscripts(cells, 1) AS pos FROM grid),
  colstat AS (SELECT source_file, source_sheet, pos, count(cell) AS n FROM cellpos GROUP BY ALL),
  keep AS (SELECT source_file, source_sheet, coalesce(list(pos ORDER BY pos) FILTER (n > 0), []) AS kept,
    coalesce(list(pos ORDER BY pos) FILTER (n = 0), []) AS emptied FROM colstat GROUP BY ALL),
  sheet AS (SELECT source_file, source_sheet, count(*) AS rows_before, max(len(cells)) AS columns_before,
    count(*) FILTER (NOT has) AS empty_rows, arg_min(cells, source_row) FILTER (has) AS first FROM marked GROUP BY ALL),
  profile AS (SELECT s.*, rows_before - empty_rows AS rows, kept, emptied,
    list_transform(kept, lambda p: first[p]) AS header FROM sheet s JOIN keep USING (source_file, source_sheet)),
  heads AS (SELECT *, list_transform(header, lambda h: coalesce(trim(regexp_replace(h, '[\s{NBSP}]+', ' ', 'g')), '')) AS headers
    FROM profile WHERE rows > 0)"""


def raw_grid(spark, sf_dir):
    sheets = F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R")))
    supplier = B.table(spark, sf_dir, "supplier")
    heads = supplier.select(
        F.expr(_FILE.format("s_suppkey")).alias("source_file"), sheets.alias("source_sheet"),
        F.lit(1).alias("source_row"), F.expr(_HEADER_LINE).alias("line"),
    )
    blanks = supplier.select(
        F.expr(_FILE.format("s_suppkey")).alias("source_file"), F.lit("blank").alias("source_sheet"),
        F.lit(1).alias("source_row"), F.lit(" |  | ").alias("line"),
    )
    rows = B.table(spark, sf_dir, "lineitem").select(
        F.expr(_FILE.format("l_suppkey")).alias("source_file"), F.col("l_returnflag").alias("source_sheet"),
        F.expr(_ROW).alias("source_row"), F.expr(_DATA_LINE).alias("line"),
    )
    lines = heads.unionByName(blanks).unionByName(rows)
    return lines.withColumn("cells", F.split("line", "\\|", -1)).drop("line")


def grid(spark, sf_dir):
    return G.blank_cells_to_null(raw_grid(spark, sf_dir))


def profile(spark, sf_dir):
    return G.profile_sheets(grid(spark, sf_dir))


def validated(spark, sf_dir):
    return G.validate_headers(G.normalize_headers(profile(spark, sf_dir)), HEADERS)


def _text(c):
    return F.concat_ws(",", F.col(c).cast("array<string>"))


@query(
    "prj_01_blank_cells_to_null",
    f"""WITH {_GRID_CTE} SELECT source_file, source_sheet, count(*) AS rows, sum(len(cells)) AS cells,
    sum(len(list_filter(cells, lambda c: c IS NULL))) AS nulls FROM grid GROUP BY ALL""",
)
def blanks(spark, sf_dir):
    return grid(spark, sf_dir).groupBy(*G.SHEET).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.size("cells")).alias("cells"),
        F.sum(F.size(F.filter("cells", lambda c: c.isNull()))).alias("nulls"),
    )


@query(
    "prj_02_drop_empty_rows",
    f"WITH {_GRID_CTE} SELECT source_file, source_sheet, source_row, array_to_string(list_transform(cells, lambda c: coalesce(c, '~')), ',') AS cells FROM marked WHERE has",
)
def nonempty_rows(spark, sf_dir):
    text = F.concat_ws(",", F.transform("cells", lambda c: F.coalesce(c, F.lit("~"))))
    return G.drop_empty_rows(grid(spark, sf_dir)).select(*G.SHEET, "source_row", text.alias("cells"))


@query(
    "prj_03_drop_empty_columns",
    f"""WITH {_GRID_CTE} SELECT m.source_file, m.source_sheet, m.source_row,
    array_to_string(list_transform(p.kept, lambda i: coalesce(m.cells[i], '~')), ',') AS cells, array_to_string(p.emptied, ',') AS empty_positions
    FROM marked m JOIN profile p USING (source_file, source_sheet) WHERE has AND p.rows > 0""",
)
def nonempty_columns(spark, sf_dir):
    g = grid(spark, sf_dir)
    p = G.profile_sheets(g)
    text = F.concat_ws(",", F.transform("cells", lambda c: F.coalesce(c, F.lit("~"))))
    return G.clean_grid(g, p, ["empty_column_positions"]).select(
        *G.SHEET, "source_row", text.alias("cells"), _text("empty_column_positions").alias("empty_positions")
    )


@query(
    "prj_04_empty_sheets",
    f"WITH {_GRID_CTE} SELECT source_file, source_sheet FROM profile WHERE rows = 0",
)
def empty_sheets(spark, sf_dir):
    return G.empty_sheets(profile(spark, sf_dir))


@query(
    "prj_05_headerless_columns",
    f"""WITH {_GRID_CTE}, pos AS (SELECT source_file, source_sheet, unnest(header) AS h, generate_subscripts(header, 1) AS position FROM profile WHERE rows > 0)
    SELECT source_file, source_sheet, CAST(position AS INT) AS position, chr(CAST(64 + position AS INT)) AS excel_column,
    'UNKNOWN_' || lpad(CAST(position AS VARCHAR), 2, '0') AS suggested_name FROM pos WHERE h IS NULL""",
)
def headerless(spark, sf_dir):
    return profile(spark, sf_dir).select(*G.SHEET, F.inline("headerless_columns_with_data"))


@query(
    "prj_06_header_normalisation",
    f"WITH {_GRID_CTE} SELECT source_file, source_sheet, array_to_string(headers, '|') AS headers FROM heads",
)
def normalised_headers(spark, sf_dir):
    sheets = G.normalize_headers(profile(spark, sf_dir).filter("rows > 0"))
    return sheets.select(*G.SHEET, F.concat_ws("|", "headers").alias("headers"))


_EXPECT = "[" + ", ".join(f"'{h}'" for h in HEADERS) + "]"


def _validate_cte(column: str = "headers", source: str = "heads") -> str:
    return f"""v0 AS (SELECT source_file, source_sheet, {column} AS f, {_EXPECT} AS w FROM {source}),
  v1 AS (SELECT *, list_filter(w, lambda h: NOT list_contains(f, h)) AS missing, list_filter(f, lambda h: h <> '' AND NOT list_contains(w, h)) AS extra,
    list_sort(list_filter(list_distinct(f), lambda h: h <> '' AND len(list_filter(f, lambda g: g = h)) > 1)) AS dup,
    list_filter(list_transform(f, lambda h, i: CASE WHEN h = '' THEN i END), lambda p: p IS NOT NULL) AS empties FROM v0),
  v2 AS (SELECT *, len(f) = len(w) AS count_ok, f = w AS order_ok, len(dup) = 0 AS dup_ok, len(missing) = 0 AS missing_ok, len(extra) = 0 AS extra_ok,
    len(empties) = 0 AS empty_ok FROM v1),
  v3 AS (SELECT *, empty_ok AND dup_ok AND missing_ok AND extra_ok AS headers_ok FROM v2),
  val AS (SELECT *, CAST(count_ok AS INT) + CAST(order_ok AS INT) + CAST(headers_ok AS INT) + CAST(dup_ok AS INT) + CAST(missing_ok AS INT)
    + CAST(extra_ok AS INT) + CAST(empty_ok AS INT) AS passed FROM v3)"""


_VALIDATION_OUT = """SELECT source_file, source_sheet, array_to_string(missing, ',') AS missing_columns, array_to_string(extra, ',') AS extra_columns,
    array_to_string(dup, ',') AS duplicate_headers, array_to_string(empties, ',') AS empty_positions, count_ok AS column_count_valid, order_ok AS header_order_valid,
    headers_ok AS headers_valid, passed AS validation_passed, round(passed * 100.0 / 7, 2) AS integrity, passed = 7 AS structure_valid FROM val"""


def _validation_out(df):
    return df.select(
        *G.SHEET, _text("missing_columns").alias("missing_columns"), _text("extra_columns").alias("extra_columns"),
        _text("duplicate_headers").alias("duplicate_headers"), _text("empty_header_positions").alias("empty_positions"),
        "column_count_valid", "header_order_valid", "headers_valid", "validation_passed", "integrity", "structure_valid",
    )


@query("prj_07_structural_validation", f"WITH {_GRID_CTE}, {_validate_cte()} {_VALIDATION_OUT}")
def validation(spark, sf_dir):
    return _validation_out(validated(spark, sf_dir))


# Files: the suppliers, and one per nation that has no readable sheet.
_FILES_CTE = (
    f"files AS (SELECT {_FILE.format('s_suppkey')} AS source_file, 'ST' || s_nationkey AS station_id, TRUE AS supported, NULL AS read_error FROM supplier"
    " UNION ALL SELECT 'nat_' || n_nationkey || '.csv', CASE WHEN n_regionkey = 2 THEN 'UNKNOWN' ELSE 'ST' || n_nationkey END, n_regionkey <> 1,"
    " CASE WHEN n_regionkey = 0 THEN 'unreadable' END FROM nation)"
)


def files(spark, sf_dir):
    suppliers = B.table(spark, sf_dir, "supplier").select(
        F.expr(_FILE.format("s_suppkey")).alias("source_file"),
        F.concat(F.lit("ST"), F.col("s_nationkey").cast("string")).alias("station_id"),
        F.lit(True).alias("supported"), F.lit(None).cast("string").alias("read_error"),
    )
    others = B.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("nat_"), F.col("n_nationkey").cast("string"), F.lit(".csv")).alias("source_file"),
        F.when(F.col("n_regionkey") == 2, "UNKNOWN").otherwise(F.concat(F.lit("ST"), F.col("n_nationkey").cast("string"))).alias("station_id"),
        (F.col("n_regionkey") != 1).alias("supported"),
        F.when(F.col("n_regionkey") == 0, "unreadable").alias("read_error"),
    )
    return suppliers.unionByName(others)


_FILE_VALID = """fv AS (SELECT f.source_file, count(v.source_file) AS sheets, coalesce(bool_and(v.passed = 7), FALSE) AS structure_valid,
    coalesce(sum(CAST(NOT count_ok AS INT) + CAST(NOT empty_ok AS INT) + CAST(NOT dup_ok AS INT) + CAST(NOT missing_ok AS INT)
      + CAST(NOT extra_ok AS INT) + CAST(NOT order_ok AS INT)), 0) AS error_count
    FROM files f LEFT JOIN val v USING (source_file) GROUP BY f.source_file)"""


@query(
    "prj_08_file_validity",
    f"WITH {_GRID_CTE}, {_validate_cte()}, {_FILES_CTE}, {_FILE_VALID} SELECT source_file, sheets, structure_valid, CAST(error_count AS BIGINT) AS error_count FROM fv",
)
def validity(spark, sf_dir):
    out = G.file_validity(files(spark, sf_dir), validated(spark, sf_dir))
    return out.select("source_file", "sheets", "structure_valid", "error_count")


_ALIAS = "CASE h WHEN 'Pedido' THEN 'Order' WHEN 'Fecha' THEN 'Ship date' ELSE h END"


@query(
    "prj_09_header_aliases",
    f"""WITH {_GRID_CTE}, fixed AS (SELECT source_file, source_sheet, list_transform(headers, lambda h: {_ALIAS}) AS headers FROM heads),
    {_validate_cte('headers', 'fixed')} {_VALIDATION_OUT}""",
)
def aliased(spark, sf_dir):
    sheets = G.resolve_header_aliases(G.normalize_headers(profile(spark, sf_dir)), ALIASES)
    return _validation_out(G.validate_headers(sheets, HEADERS))


_PROMOTED = ", ".join(
    f"r.vals[list_position(r.headers, '{h}')] AS {n}" for h, n in zip(HEADERS, NAMES, strict=True)
)
_ROWS_CTE = """rows_ AS (SELECT m.source_file, m.source_sheet, m.source_row, p.headers, list_transform(p.kept, lambda i: m.cells[i]) AS vals
    FROM marked m JOIN heads p USING (source_file, source_sheet) WHERE m.has AND m.source_row > 1)"""


@query(
    "prj_10_header_promotion",
    f"WITH {_GRID_CTE}, {_ROWS_CTE} SELECT source_file, source_sheet, source_row, {_PROMOTED} FROM rows_ r",
)
def promoted(spark, sf_dir):
    g = grid(spark, sf_dir)
    p = G.profile_sheets(g)
    sheets = G.normalize_headers(p.filter("rows > 0"))
    return C.promote_headers(G.clean_grid(g, p), sheets, dict(zip(HEADERS, NAMES, strict=True)))


@query(
    "prj_11_consolidation",
    f"""WITH {_GRID_CTE}, {_validate_cte()}, {_ROWS_CTE} SELECT r.source_file, r.source_sheet, r.source_row, sha256(r.source_file) AS source_hash, {_PROMOTED}
    FROM rows_ r JOIN val v USING (source_file, source_sheet) WHERE v.passed = 7""",
)
def consolidated(spark, sf_dir):
    g = grid(spark, sf_dir)
    p = G.profile_sheets(g)
    ok = G.validate_headers(G.normalize_headers(p), HEADERS)
    inventory = files(spark, sf_dir).select(
        F.col("source_file").alias("path"), F.sha2("source_file", 256).alias("sha256")
    )
    return C.consolidate(G.clean_grid(g, p), ok, dict(zip(HEADERS, NAMES, strict=True)), inventory)


# --- canonical projection and preparation --------------------------------------------------------


@query(
    "prj_12_canonical_projection",
    f"""WITH {B.WIDE_CTE} SELECT upper(trim(station_id)) AS station_id, CAST(year AS SMALLINT) AS year, CAST(month AS TINYINT) AS month,
    CAST(air_temperature_c AS FLOAT) AS air_temperature_c, elevation_m, source_file, CAST(source_row AS INT) AS source_row, 67 AS columns FROM obs""",
)
def canonical(spark, sf_dir):
    schema = contract.canonical_schema()
    df = B.wide(spark, sf_dir).withColumn("station_id", F.upper(F.trim("station_id")))
    df = df.select(*[c for c in df.columns if c in schema.fieldNames()])
    out = C.to_canonical(df, schema, fill_missing=True)
    width = len(out.columns)
    return out.select(
        "station_id", "year", "month", "air_temperature_c", F.col("elevation_m").cast("double").alias("elevation_m"),
        "source_file", "source_row", F.lit(width).alias("columns"),
    )


# A month and an hour that one byte cannot hold, an elevation in words; every column of the contract is audited.
_STRAINED = {"month": "month * 25", "hour_utc": "hour_utc * 10", "elevation_m": "CASE WHEN event_id % 9 = 0 THEN 'high' ELSE CAST(elevation_m AS STRING) END"}
_SCHEMA = contract.canonical_schema()
_CARRIED = [f.name for f in _SCHEMA.fields if f.name in B.WIDE]


def _audit_sql() -> str:
    casts = {"month": "month * 25 > 127", "hour_utc": "hour_utc * 10 > 127", "elevation_m": "event_id % 9 = 0"}
    branches = [f"SELECT '{c}' AS \"column\", 'cast_failed' AS problem, count(*) AS n FROM obs WHERE {bad}" for c, bad in casts.items()]
    for f in _SCHEMA.fields:
        if not f.nullable:
            lost = f"({f.name} IS NULL" + (f" OR {casts[f.name]})" if f.name in casts else ")") if f.name in _CARRIED else "TRUE"
            branches.append(f"SELECT '{f.name}', 'required_null', count(*) FROM obs WHERE {lost}")
    return f"WITH {B.WIDE_CTE}, found AS ({' UNION ALL '.join(branches)}) SELECT * FROM found WHERE n > 0"


@query("prj_12_contract_findings", _audit_sql())
def contract_findings(spark, sf_dir):
    rows = B.wide(spark, sf_dir).selectExpr(*[f"{_STRAINED.get(c, c)} AS {c}" for c in _CARRIED])
    found = C.canonical_with_findings(rows).select(F.explode("contract_findings").alias("f"))
    return found.groupBy(F.col("f.column").alias("column"), F.col("f.problem").alias("problem")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "prj_12_repeated_keys",
    f"WITH {B.WIDE_CTE} SELECT station_id, year, month, day, hour_utc, count(*) AS rows FROM obs GROUP BY ALL HAVING count(*) > 1",
)
def repeated_keys(spark, sf_dir):
    return C.key_violations(B.wide(spark, sf_dir), ["station_id", "year", "month", "day", "hour_utc"])


@query(
    "prj_12_required_columns",
    f"""WITH {B.WIDE_CTE} SELECT 'station_id' AS column_name, count(*) FILTER (station_id IS NULL) AS null_count FROM obs
    UNION ALL SELECT 'year', count(*) FILTER (year IS NULL) FROM obs UNION ALL SELECT 'source_file', count(*) FILTER (source_file IS NULL) FROM obs""",
)
def required(spark, sf_dir):
    return C.null_violations(B.wide(spark, sf_dir), ["station_id", "year", "source_file"])


_ID = "coalesce(CAST({} AS VARCHAR), '')"


@query(
    "prj_13_technical_columns",
    f"""WITH {B.WIDE_CTE}, timed AS (SELECT *, {B.SQL_TIME} AS datetime_utc FROM obs)
    SELECT event_id, sha256({_ID.format('station_id')} || '~' || coalesce(strftime(datetime_utc, '%Y-%m-%d %H:%M:%S'), '') || '~' || {_ID.format('source_file')}
      || '~' || 's1' || '~' || {_ID.format('source_row')}) AS record_id, 'run-1' AS pipeline_run_id, TIMESTAMP '2024-02-01 00:00:00' AS processing_timestamp,
      '0.1' AS pipeline_version, '0.2' AS dictionary_version FROM timed""",
)
def technical(spark, sf_dir):
    df = C.with_datetime(B.wide(spark, sf_dir)).withColumn("source_sheet", F.lit("s1"))
    out = C.with_technical_columns(df, "run-1", "2024-02-01 00:00:00", "0.1", "0.2")
    return out.select(
        "event_id", "record_id", "pipeline_run_id", "processing_timestamp", "pipeline_version", "dictionary_version"
    )


@query(
    "prj_14_computed_time_fields",
    f"""WITH {B.WIDE_CTE}, timed AS (SELECT event_id, {B.SQL_TIME} AS datetime_utc FROM obs)
    SELECT event_id, datetime_utc, CAST(datetime_utc AS DATE) AS date, year(datetime_utc) - CASE WHEN month(datetime_utc) < 7 THEN 1 ELSE 0 END AS climatological_year FROM timed""",
)
def time_fields(spark, sf_dir):
    out = C.with_datetime(B.wide(spark, sf_dir), start_month=7)
    return out.select("event_id", "datetime_utc", "date", F.col("climatological_year").cast("bigint").alias("climatological_year"))


MELTED = ["air_temperature_c", "relative_humidity_pct", "qnh_hpa", "wind_speed_kt", "prevailing_visibility_m"]
_MELT_SQL = " UNION ALL ".join(f"SELECT event_id, user_id, '{v}' AS variable, {v} AS value FROM obs" for v in MELTED)


@query(
    "prj_15_variable_subset",
    f"WITH {B.WIDE_CTE}, m AS ({_MELT_SQL}) SELECT event_id, variable, value FROM m WHERE variable IN ('air_temperature_c','qnh_hpa','wind_speed_kt','prevailing_visibility_m')",
)
def variable_subset(spark, sf_dir):
    from obsguard.catalogs import dimensions as dim

    chosen = dim.select_variables(dim.variables(spark), enabled=True, implemented=True, product="METAR")
    wanted = {r[0] for r in chosen.select("canonical_name").collect()}
    columns = [c for c in MELTED if c in wanted]
    return C.melt(B.wide(spark, sf_dir), ["event_id"], columns)


@query("prj_16_wide_to_long", f"WITH {B.WIDE_CTE} {_MELT_SQL}")
def melt(spark, sf_dir):
    return C.melt(B.wide(spark, sf_dir), ["event_id", "user_id"], MELTED)


@query(
    "prj_17_known_typing_errors",
    f"""WITH {B.WIDE_CTE} SELECT event_id, CASE report_type WHEN 'SYNOP' THEN 'HISTORICAL_OBSERVATION' ELSE report_type END AS report_type,
    CASE WHEN report_type = 'SYNOP' THEN 1 ELSE 0 END AS corrections FROM obs""",
)
def typos(spark, sf_dir):
    fixes = spark.createDataFrame([("report_type", "SYNOP", "HISTORICAL_OBSERVATION")], "field string, wrong string, right string")
    df = B.wide(spark, sf_dir).select("event_id", "report_type")
    out = C.fix_known_typos(df, fixes, "report_type", "2024-02-01")
    return out.select("event_id", "report_type", F.size("corrections").alias("corrections"))


# Texts as read from a file: decimal commas, stray blanks, missing tokens.
_TEXT_ROW = {
    "event_id": "event_id",
    "station_id": "concat(' st', CAST(user_id AS STRING), ' ')",
    "report_status": "CASE WHEN event_id % 6 = 0 THEN 'rutinario' ELSE 'Especial' END",
    "year": "CAST(year(ts) AS STRING)",
    "month": "CAST(month(ts) AS STRING)",
    "day": "CASE WHEN event_id % 61 = 0 THEN '31,5' ELSE CAST(day(ts) AS STRING) END",
    "hour_utc": "CAST(hour(ts) AS STRING)",
    "minute": "CASE WHEN event_id % 13 = 0 THEN '--' ELSE CAST(minute(ts) AS STRING) END",
    "air_temperature_c": "CASE WHEN event_id % 7 = 0 THEN '-999' WHEN event_id % 5 = 0 THEN concat(CAST(k AS STRING), ',5') ELSE CAST(k AS STRING) END",
    "prevailing_visibility_m": "CASE WHEN event_id % 3 = 0 THEN '9999' ELSE CAST(k * 97 AS STRING) END",
    "source_file": "'f.csv'",
    "source_sheet": "'s1'",
    "source_row": "event_id",
}
_TEXT_CTE = f"{B.BASE_CTE}, txt AS (SELECT {', '.join(f'{e} AS {n}' for n, e in _TEXT_ROW.items())} FROM base)"


def text_rows(spark, sf_dir):
    return B.base(spark, sf_dir).selectExpr(*[f"{e} AS {n}" for n, e in _TEXT_ROW.items()])


def prepared(spark, sf_dir):
    return Q.prepare(text_rows(spark, sf_dir), contract.input_types(), "2024-02-01 00:00:00", "run-1")


PREPARED_SQL = f"""WITH {_TEXT_CTE}, t AS (SELECT event_id, upper(trim(station_id)) AS station_id, upper(report_status) AS report_status,
      TRY_CAST(year || '-' || month || '-' || day || ' ' || hour_utc || ':' || minute || ':00' AS TIMESTAMP) AS datetime_utc,
      CASE WHEN air_temperature_c <> '-999' THEN CAST(replace(air_temperature_c, ',', '.') AS DOUBLE) END AS air_temperature_c,
      CAST(prevailing_visibility_m AS DOUBLE) AS prevailing_visibility_m FROM txt)
    SELECT event_id, station_id, report_status, datetime_utc, air_temperature_c, prevailing_visibility_m, 2 AS corrections FROM t"""


@query("prj_18_preprocessing", PREPARED_SQL)
def preprocessing(spark, sf_dir):
    return prepared(spark, sf_dir).select(
        "event_id", "station_id", "report_status", "datetime_utc", "air_temperature_c", "prevailing_visibility_m",
        F.size("corrections").alias("corrections"),
    )


# --- statistics ---------------------------------------------------------------------------------

_ROLLUP_CTE = f"""{_FILES_CTE}, per AS (SELECT source_file, count(*) FILTER (rows > 0) AS sheet_count, count(*) FILTER (rows = 0) AS empty_sheets,
    sum(rows_before) FILTER (rows > 0) AS rows_before, sum(empty_rows) FILTER (rows > 0) AS empty_rows, sum(len(emptied)) FILTER (rows > 0) AS empty_columns,
    sum(rows) FILTER (rows > 0) AS total_rows, max(columns_before) FILTER (rows > 0) AS columns_before, max(len(kept)) FILTER (rows > 0) AS total_columns,
    sum(len(list_filter(header, lambda h: h IS NULL))) FILTER (rows > 0) AS headerless FROM profile GROUP BY source_file),
  roll AS (SELECT f.*, coalesce(sheet_count, 0) AS sheet_count, coalesce(empty_sheets, 0) AS empty_sheets, coalesce(rows_before, 0) AS rows_before,
    coalesce(empty_rows, 0) AS empty_rows, coalesce(empty_columns, 0) AS empty_columns, coalesce(total_rows, 0) AS total_rows,
    coalesce(columns_before, 0) AS columns_before, coalesce(total_columns, 0) AS total_columns, coalesce(headerless, 0) AS headerless,
    CASE WHEN read_error IS NOT NULL THEN 'error' WHEN NOT supported THEN 'skipped' WHEN coalesce(sheet_count, 0) > 0 THEN 'success' ELSE 'skipped' END AS status
    FROM files f LEFT JOIN per USING (source_file))"""


def rollup(spark, sf_dir):
    return G.file_rollup(files(spark, sf_dir), profile(spark, sf_dir))


@query(
    "agg_03_file_rollup",
    f"""WITH {_GRID_CTE}, {_ROLLUP_CTE} SELECT source_file, status, sheet_count, empty_sheets, CAST(rows_before AS BIGINT) AS rows_before,
    CAST(empty_rows AS BIGINT) AS empty_rows, CAST(empty_columns AS BIGINT) AS empty_columns, CAST(total_rows AS BIGINT) AS total_rows,
    columns_before, total_columns, CAST(headerless AS BIGINT) AS headerless FROM roll""",
)
def file_rollup(spark, sf_dir):
    return rollup(spark, sf_dir).select(
        "source_file", "status", "sheet_count", F.col("empty_sheets_ignored").alias("empty_sheets"),
        F.col("total_rows_before_cleanup").alias("rows_before"), F.col("empty_rows_removed").alias("empty_rows"),
        F.col("empty_columns_removed").alias("empty_columns"), "total_rows",
        F.col("total_columns_before_cleanup").alias("columns_before"), "total_columns",
        F.col("headerless_columns_with_data").alias("headerless"),
    )


register(
    "src_13_ingest_status",
    lambda spark, sf_dir: rollup(spark, sf_dir).select("source_file", "station_id", "status"),
    f"WITH {_GRID_CTE}, {_ROLLUP_CTE} SELECT source_file, station_id, status FROM roll",
)

_INGEST_STATS = f"""WITH {_GRID_CTE}, {_ROLLUP_CTE} SELECT count(*) AS files_processed, count(*) FILTER (status = 'success') AS files_successful,
    count(*) FILTER (status = 'error') AS files_failed, count(*) FILTER (status = 'skipped') AS files_skipped,
    count(DISTINCT station_id) FILTER (station_id <> 'UNKNOWN') AS stations_found, CAST(sum(sheet_count) FILTER (status = 'success') AS BIGINT) AS sheets_read,
    CAST(sum(empty_sheets) AS BIGINT) AS empty_sheets_ignored, CAST(sum(rows_before) FILTER (status = 'success') AS BIGINT) AS rows_before_cleanup,
    CAST(sum(empty_rows) FILTER (status = 'success') AS BIGINT) AS empty_rows_removed, CAST(sum(total_rows) FILTER (status = 'success') AS BIGINT) AS rows_read,
    CAST(sum(empty_columns) FILTER (status = 'success') AS BIGINT) AS empty_columns_removed,
    CAST(sum(headerless) FILTER (status = 'success') AS BIGINT) AS headerless_columns_with_data FROM roll"""


@query("agg_02_ingestion_statistics", _INGEST_STATS)
def ingestion(spark, sf_dir):
    return G.ingestion_statistics(rollup(spark, sf_dir))


@query(
    "agg_04_structure_statistics",
    f"""WITH {_GRID_CTE}, {_validate_cte()}, {_FILES_CTE}, {_FILE_VALID},
    a AS (SELECT count(*) AS files_validated, count(*) FILTER (structure_valid) AS files_valid, count(*) FILTER (NOT structure_valid) AS files_invalid FROM fv),
    b AS (SELECT count(*) AS sheets_validated, count(*) FILTER (passed = 7) AS sheets_valid, count(*) FILTER (passed < 7) AS sheets_invalid,
      CAST(sum(len(missing)) AS BIGINT) AS missing_columns, CAST(sum(len(extra)) AS BIGINT) AS extra_columns, CAST(sum(len(dup)) AS BIGINT) AS duplicate_headers,
      CAST(sum(len(empties)) AS BIGINT) AS empty_headers, count(*) * 7 AS validation_checks, CAST(sum(passed) AS BIGINT) AS validation_passed,
      CAST(count(*) * 7 - sum(passed) AS BIGINT) AS validation_failed, round(sum(passed) * 100.0 / (count(*) * 7), 2) AS integrity FROM val)
    SELECT * FROM a, b""",
)
def structure(spark, sf_dir):
    sheets = validated(spark, sf_dir)
    return G.structure_statistics(G.file_validity(files(spark, sf_dir), sheets), sheets)
