"""Discovery, readers, writers, ordering and set operations.

``documents`` are the files of an inventory (source -> source type, language -> extension, text ->
content); the readers and writers write the tables to a fresh folder and read them back.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from coverage_queries import bindings as B
from coverage_queries.q_grids import (
    _FILE_VALID, _GRID_CTE, PREPARED_SQL, _validate_cte, files, grid, prepared, validated,
)
from coverage_queries.q_grids import (
    _FILES_CTE as _GRID_FILES_CTE,
)
from coverage_queries.registry import query, register
from obsguard.catalogs import contract
from obsguard.catalogs import dimensions as dim
from obsguard.operators import grid as G
from obsguard.sinks import writers as W
from obsguard.sources import files as SF
from obsguard.sources import readers as SR
from obsguard.session import shared_folder


def scratch(spark) -> str:
    """A fresh folder in the shared one."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


# --- files of the inventory ---------------------------------------------------------------------

# Also some names that are never data.
_FILE_PATH = (
    "concat('data/', source, '/st', CAST(doc_id % 37 AS STRING), CASE doc_id % 17 WHEN 3 THEN '/~$' WHEN 5 THEN '/.' WHEN 7 THEN '/.old/'"
    " WHEN 9 THEN '/_' ELSE '/' END, CASE WHEN doc_id % 19 = 4 THEN 'Thumbs.db' ELSE concat('D', CAST(doc_id AS STRING), '.',"
    " CASE WHEN doc_id % 2 = 0 THEN upper(lang) ELSE lang END) END)"
)
_FILES_CTE = (
    f"f0 AS (SELECT doc_id, source AS source_type, CAST(substr(source, 4) AS INT) AS source_ordinal, {_FILE_PATH} AS path, text FROM documents),"
    " f1 AS (SELECT doc_id, source_type, source_ordinal, path, lower(regexp_extract(path, '[^/]+$', 0)) AS low, text FROM f0),"
    " inv AS (SELECT doc_id, source_type, source_ordinal, path, lower(regexp_extract(regexp_extract(path, '[^/]+$', 0), '^.+([.][^.]+)$', 1)) AS extension,"
    " strlen(text) AS size_bytes, sha256(text) AS sha256 FROM f1"
    " WHERE low NOT IN ('thumbs.db', 'desktop.ini', '.ds_store') AND NOT starts_with(low, '~$') AND NOT contains(path, '/.'))"
)


def listing(spark, sf_dir):
    return B.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("source").alias("source_type"), F.substr("source", F.lit(4)).cast("int").alias("source_ordinal"),
        F.expr(_FILE_PATH).alias("path"), F.octet_length("text").cast("bigint").alias("size_bytes"),
        F.sha2("text", 256).alias("sha256"),
    )


def inventory(spark, sf_dir):
    found = SF.select_files(listing(spark, sf_dir), ["en", ".FR", " de", "es", "", "zh"])
    return found.withColumns(
        {
            "relative_path": F.col("path"), "filename": SF.filename_of(F.col("path")),
            "stem": SF.stem_of(F.col("path")), "extension": SF.extension_of(F.col("path")),
        }
    )


_LANGS = "extension IN ('.en', '.fr', '.de', '.es', '.zh')"


@query(
    "src_02_extension_filter",
    rf"""WITH u AS (SELECT page_id, lower(regexp_extract(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '[^/]+$', 0), '^.+([.][^.]+)$', 1)) AS extension FROM pages)
    SELECT page_id, extension FROM u WHERE extension IN ('.html', '.pdf', '.com')""",
)
def extensions(spark, sf_dir):
    pages = B.table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^[^?#]*", 0).alias("path"))
    found = SF.select_files(pages, ["HTML", ".pdf ", "com"])
    return found.select("page_id", SF.extension_of(F.col("path")).alias("extension"))


@query(
    "src_03_ignored_files",
    f"WITH {_FILES_CTE} SELECT doc_id, path FROM f0 WHERE doc_id NOT IN (SELECT doc_id FROM inv)",
)
def ignored(spark, sf_dir):
    return listing(spark, sf_dir).filter(SF.is_ignored(F.col("path"))).select("doc_id", "path")


@query(
    "src_04_empty_files",
    """SELECT doc_id, CASE WHEN n_chars % 10 = 0 THEN 'empty' ELSE 'kept' END AS outcome FROM documents""",
)
def empty_files(spark, sf_dir):
    sizes = B.table(spark, sf_dir, "documents").select("doc_id", (F.col("n_chars") % 10).alias("size_bytes"))
    kept, empty = SF.split_empty(sizes)
    return kept.select("doc_id", F.lit("kept").alias("outcome")).unionByName(
        empty.select("doc_id", F.lit("empty").alias("outcome"))
    )


# Orders written as text files, one a customer group, in folders named like it; the content of each follows from the table.
_GROUPS = 24
_FOLDER_SQL = f"""filed AS (SELECT 'g' || (o_custkey % {_GROUPS}) AS folder, string_agg(o_orderkey || ';' || o_orderpriority || chr(10), '' ORDER BY o_orderkey) AS content FROM orders GROUP BY ALL)"""


def filed_orders(spark, sf_dir):
    """A folder with one file a customer group, written from orders, and what discovery passes over."""
    root = scratch(spark)
    rows = B.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("g"), (F.col("o_custkey") % _GROUPS).cast("string")).alias("folder"), "o_orderkey",
        F.concat_ws(";", F.col("o_orderkey").cast("string"), "o_orderpriority").alias("value"),
    )
    ordered = rows.repartition(8, "folder").sortWithinPartitions("folder", "o_orderkey").select("folder", "value")
    ordered.write.partitionBy("folder").text(f"{root}/raw")
    return root


def discovered(spark, sf_dir):
    root = filed_orders(spark, sf_dir)
    sources = [
        {"type": "txt", "directory": f"{root}/raw", "extensions": ["TXT"], "recursive": True, "enabled": True},
        {"type": "csv", "directory": f"{root}/absent", "extensions": [".csv"], "enabled": True},
        {"type": "bufr", "directory": f"{root}/raw", "extensions": [".bufr"], "enabled": False},
    ]
    return SF.discover(spark, sources, root)


def _folder(path: str):
    return F.regexp_extract(path, "folder=([^/]+)/", 1).alias("folder")


@query(
    "src_01_discover_sources",
    f"WITH {_FOLDER_SQL} SELECT 'txt' AS source_type, folder, '.txt' AS extension, strlen(content) AS size_bytes FROM filed",
)
def discovery_of_sources(spark, sf_dir):
    return discovered(spark, sf_dir).select("source_type", _folder("relative_path"), "extension", "size_bytes")


@query(
    "src_05_metadata_and_hash",
    f"WITH {_FOLDER_SQL} SELECT folder, '.txt' AS extension, strlen(content) AS size_bytes, sha256(content) AS sha256, TRUE AS dated FROM filed",
)
def metadata_and_hash(spark, sf_dir):
    return discovered(spark, sf_dir).select(
        _folder("relative_path"), "extension", "size_bytes", "sha256", F.col("modified_utc").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}[+-]\d\d:\d\d$").alias("dated")
    )


@query(
    "src_01_discovery_warnings",
    """SELECT 'folder_missing' AS problem, 'priority ' || o_orderpriority AS source_type FROM orders GROUP BY o_orderpriority HAVING min(o_custkey) % 2 = 0
    UNION ALL SELECT CASE min(o_custkey) % 3 WHEN 0 THEN 'no_path' ELSE 'no_extensions' END, 'priority ' || o_orderpriority FROM orders GROUP BY o_orderpriority HAVING min(o_custkey) % 2 <> 0""",
)
def warnings_of_discovery(spark, sf_dir):
    root = scratch(spark)
    first = B.table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.min("o_custkey").alias("k")).collect()
    sources = [
        {
            "type": f"priority {r['o_orderpriority']}", "enabled": True,
            "directory": None if r["k"] % 2 and r["k"] % 3 == 0 else f"{root}/{i}", "extensions": [".csv"] if r["k"] % 2 == 0 else [],
        }
        for i, r in enumerate(first)
    ]
    return SF.discovery_warnings(spark, sources).select("problem", "source_type")


_DEDUP_SQL = f"""WITH {_FILES_CTE}, r AS (SELECT *, row_number() OVER w AS rn, first_value(path) OVER w AS first_path FROM inv WHERE {_LANGS}
    WINDOW w AS (PARTITION BY sha256 ORDER BY source_ordinal, lower(path), path))
    SELECT doc_id, path, CASE WHEN rn > 1 THEN first_path END AS duplicate_of FROM r"""


@query("src_06_exact_duplicates", _DEDUP_SQL)
def file_duplicates(spark, sf_dir):
    return SF.mark_duplicate_files(inventory(spark, sf_dir)).select("doc_id", "path", "duplicate_of")


@query(
    "src_07_station_from_path",
    """SELECT page_id, CASE WHEN contains(url, '/en/') THEN upper(trim(split_part(url, '/en/', 2).split_part('/', 1))) ELSE 'UNKNOWN' END AS station_id FROM pages""",
)
def path_station(spark, sf_dir):
    return B.table(spark, sf_dir, "pages").select(
        "page_id", SF.station_from_path(F.col("url"), F.lit("EN")).alias("station_id")
    )


_STAT_SQL = f"""WITH {_FILES_CTE}, u AS (SELECT * FROM inv WHERE {_LANGS} QUALIFY row_number() OVER (PARTITION BY sha256 ORDER BY source_ordinal, lower(path), path) = 1)
    SELECT CAST(grouping_id(extension, source_type) AS BIGINT) AS level, extension, source_type, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS bytes
    FROM u GROUP BY GROUPING SETS ((), (extension), (source_type))"""


@query("agg_01_discovery_statistics", _STAT_SQL)
def discovery(spark, sf_dir):
    unique = SF.unique_files(SF.mark_duplicate_files(inventory(spark, sf_dir)))
    out = SF.discovery_statistics(unique)
    return out.withColumns({"level": F.col("level").cast("bigint"), "bytes": F.col("bytes").cast("bigint")})


# --- readers ------------------------------------------------------------------------------------


@query(
    "src_08_raw_grid",
    "SELECT CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS a, CAST(l_partkey AS VARCHAR) AS b, CASE WHEN l_orderkey % 5 = 0 THEN '' ELSE l_returnflag END AS c,"
    " CAST(l_linenumber AS VARCHAR) AS d, 4 AS width FROM lineitem",
)
def raw_grid(spark, sf_dir):
    folder = scratch(spark)
    lines = B.table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            ",", F.when(F.col("l_linenumber") % 3 == 0, "").otherwise(F.col("l_orderkey").cast("string")), F.col("l_partkey").cast("string"),
            F.when(F.col("l_orderkey") % 5 == 0, "").otherwise(F.col("l_returnflag")),
            F.col("l_linenumber").cast("string"),
        ).alias("value")
    )
    lines.write.text(folder)
    cells = F.col("cells")
    return SR.read_grid(spark, folder).select(
        cells[0].alias("a"), cells[1].alias("b"), cells[2].alias("c"), cells[3].alias("d"), F.size(cells).alias("width")
    )


_ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
_ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def orders(spark, sf_dir):
    return B.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("src_09_csv_observations", _ORDERS_SQL)
def csv_source(spark, sf_dir):
    folder = scratch(spark)
    orders(spark, sf_dir).write.option("header", "true").csv(folder)
    return SR.read_table(spark, folder, _ORDERS).filter("_corrupt_record IS NULL").drop("_corrupt_record")


@query("src_10_report_text", f"WITH {B.WIDE_CTE} SELECT metar || ' ' || event_id AS report FROM obs WHERE metar IS NOT NULL")
def report_text(spark, sf_dir):
    folder = scratch(spark)
    text = B.wide(spark, sf_dir).filter("metar IS NOT NULL").select(
        F.concat("metar", F.lit(" "), F.col("event_id").cast("string")).alias("value")
    )
    text.write.text(folder)
    return SR.read_reports(spark, folder).select("report")


@query("src_11_parquet_source", _ORDERS_SQL)
def parquet_source(spark, sf_dir):
    folder = scratch(spark)
    W.write_parquet(orders(spark, sf_dir), folder, overwrite=False)
    return SR.read_parquet(spark, folder)


# The variables of the catalogue that the observations carry, and their attributes as SQL rows.
_CATALOGUE = [r for r in dim._rows(dim.VARIABLES_TEXT) if r[1] in B.WIDE]
_UNITS = {r[0]: r for r in dim._rows(dim.UNITS_TEXT)}


def _sql_rows() -> str:
    quoted = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    base = lambda r: _UNITS[r[4]][3] if r[4] in _UNITS else None
    return ", ".join(f"({', '.join(map(quoted, (r[1], r[2], r[4], base(r), r[9])))})" for r in _CATALOGUE)


@query(
    "src_12_reference_dimensions",
    f"""WITH {B.WIDE_CTE}, found(variable, n) AS ({' UNION ALL '.join(f"SELECT '{r[1]}', count({r[1]}) FROM obs" for r in _CATALOGUE)}),
    dims(variable, var_group, unit, base_unit, enabled) AS (VALUES {_sql_rows()})
    SELECT variable, n, var_group, unit, base_unit, enabled = 'true' AS enabled FROM found JOIN dims USING (variable)""",
)
def dimensions(spark, sf_dir):
    names = [r[1] for r in _CATALOGUE]
    cells = B.wide(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "variable", "value")
    found = cells.groupBy("variable").agg(F.count("value").alias("n"))
    units = dim.units(spark).select(F.col("unit_id").alias("unit"), "base_unit")
    named = dim.variables(spark).select(F.col("canonical_name").alias("variable"), "var_group", "unit", "enabled")
    return found.join(named, "variable").join(units, "unit", "left").select("variable", "n", "var_group", "unit", "base_unit", "enabled")


# --- sinks --------------------------------------------------------------------------------------


@query(
    "exp_01_inventory_json",
    f"WITH {_FILES_CTE} SELECT doc_id, path, extension, size_bytes, sha256 FROM inv WHERE {_LANGS}",
)
def inventory_json(spark, sf_dir):
    folder = scratch(spark)
    W.write_json(inventory(spark, sf_dir).select("doc_id", "path", "extension", "size_bytes", "sha256"), folder)
    return spark.read.schema("doc_id bigint, path string, extension string, size_bytes bigint, sha256 string").json(folder)


_EXPORT_SQL = f"""WITH {B.WIDE_CTE} SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS ts, concat_ws(';', present_weather_1, present_weather_2, present_weather_3) AS codes,
    air_temperature_c FROM obs"""


def exported(spark, sf_dir):
    from obsguard.functions import scalars as S

    return B.wide(spark, sf_dir).select("event_id", "ts", S.weather_codes().alias("codes"), "air_temperature_c")


@query("exp_02_canonical_csv", _EXPORT_SQL.replace("concat_ws(';'", "nullif(concat_ws(';'").replace("present_weather_3) AS codes", "present_weather_3), '') AS codes"))
def csv_sink(spark, sf_dir):
    folder = scratch(spark)
    W.write_csv(exported(spark, sf_dir), folder)
    return spark.read.option("header", "true").schema("event_id bigint, ts string, codes string, air_temperature_c double").csv(folder)


@query(
    "exp_03_canonical_parquet",
    f"WITH {B.WIDE_CTE} SELECT event_id, ts, len(list_filter([present_weather_1, present_weather_2, present_weather_3], lambda c: c IS NOT NULL)) AS codes, air_temperature_c FROM obs",
)
def parquet_sink(spark, sf_dir):
    folder = scratch(spark)
    W.write_parquet(exported(spark, sf_dir), folder)
    return spark.read.parquet(folder).withColumn("codes", F.size("codes"))


@query("exp_04_json_dataset", _EXPORT_SQL)
def json_sink(spark, sf_dir):
    folder = scratch(spark)
    W.write_json(exported(spark, sf_dir), folder)
    back = spark.read.schema("event_id bigint, ts timestamp_ntz, codes array<string>, air_temperature_c double").json(folder)
    return back.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"), F.concat_ws(";", "codes").alias("codes"), "air_temperature_c"
    )


@query(
    "exp_06_period_layouts",
    "SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL",
)
def layouts(spark, sf_dir):
    folder = scratch(spark)
    df = orders(spark, sf_dir).withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    W.write_layout(df, folder, "monthly")
    return spark.read.parquet(folder).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


# Layout -> (table, time, amount, rows that are written again). Events span a month of days, orders seven years.
_LAYOUTS = {
    "daily": ("events", "ts", "value", "day(ts) <= 10", ["year", "month", "day"]),
    "yearly": ("orders", "o_orderdate", "o_totalprice", "year(o_orderdate) <= 1995", ["year"]),
}


def _layout_query(layout: str):
    source, at, amount, again, keys = _LAYOUTS[layout]

    def run(spark, sf_dir):
        """Written twice, the second time some folders only and with doubled amounts; the other folders stay."""
        folder = scratch(spark)
        parts = {"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)}
        df = B.table(spark, sf_dir, source).select(at, amount).withColumns({k: parts[k] for k in keys})
        W.write_layout(df, folder, layout)
        W.write_layout(df.filter(again).withColumn(amount, F.col(amount) * 2), folder, layout)
        return spark.read.parquet(folder).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(amount), 2).alias("total"))

    columns = ", ".join(f"CAST({k}({at}) AS INT) AS {k}" for k in keys)
    sql = f"SELECT {columns}, count(*) AS n, round(sum(CASE WHEN {again} THEN {amount} * 2 ELSE {amount} END), 2) AS total FROM {source} GROUP BY ALL"
    register(f"exp_06_{layout}_layout", run, sql)


for _layout in _LAYOUTS:
    _layout_query(_layout)


@query(
    "exp_07_quarantined_files",
    f"WITH {_GRID_CTE}, {_validate_cte()}, {_GRID_FILES_CTE}, {_FILE_VALID} SELECT f.source_file, count(g.source_row) AS rows, any_value(f.error_count) AS errors"
    " FROM fv f LEFT JOIN grid g USING (source_file) WHERE NOT f.structure_valid GROUP BY f.source_file",
)
def quarantined_files(spark, sf_dir):
    folder = scratch(spark)
    W.quarantine_files(grid(spark, sf_dir), G.file_validity(files(spark, sf_dir), validated(spark, sf_dir)), folder)
    return spark.read.parquet(folder).groupBy("source_file").agg(
        F.count("source_row").alias("rows"), F.max(F.size("validation_errors")).cast("bigint").alias("errors")
    )


@query("exp_07_quarantine", f"WITH {B.WIDE_CTE} SELECT event_id, month, day FROM obs WHERE coalesce(month > 12 OR day > 29, TRUE)")
def quarantined(spark, sf_dir):
    folder = scratch(spark)
    df = B.wide(spark, sf_dir).select("event_id", "month", "day")
    W.quarantine(df, (F.col("month") > 12) | (F.col("day") > 29), folder)
    return spark.read.parquet(folder)


@query(
    "exp_08_publication_manifest",
    f"WITH {_FOLDER_SQL} SELECT folder, strlen(content) AS size_bytes, sha256(content) AS sha256 FROM filed",
)
def publication(spark, sf_dir):
    return W.manifest(spark, filed_orders(spark, sf_dir)).select(_folder("path"), "size_bytes", "sha256")


@query(
    "exp_09_stop_on_error",
    "SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 'error' ELSE 'success' END AS status, (SELECT count(*) FROM nation WHERE n_regionkey = 0) AS failed FROM nation",
)
def stop_gate(spark, sf_dir):
    results = B.table(spark, sf_dir, "nation").select(
        "n_nationkey", F.when(F.col("n_regionkey") == 0, "error").otherwise("success").alias("status")
    )
    failed = W.raise_if_failed(results, stop=False)
    return results.withColumn("failed", F.lit(failed).cast("bigint"))


@query("exp_10_overwrite_guard", "SELECT o_orderkey, o_totalprice, TRUE AS refused FROM orders")
def overwrite_guard(spark, sf_dir):
    folder = scratch(spark)
    df = orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    W.write_parquet(df, folder, overwrite=False)
    refused = False
    try:
        W.write_parquet(df, folder, overwrite=False)
    except AnalysisException as error:
        refused = "PATH_ALREADY_EXISTS" in str(error)
    W.write_parquet(df, folder, overwrite=True)
    return spark.read.parquet(folder).withColumn("refused", F.lit(refused))


@query("exp_11_stage_checkpoint", "SELECT o_orderkey, o_totalprice, TRUE AS absent_before FROM orders")
def stage_checkpoint(spark, sf_dir):
    folder = scratch(spark)
    before = W.load_stage(spark, folder, "run-1", "stage04")
    W.save_stage(spark, orders(spark, sf_dir).select("o_orderkey", "o_totalprice"), folder, "run-1", "stage04", {"files": 1})
    return W.load_stage(spark, folder, "run-1", "stage04").withColumn("absent_before", F.lit(before is None))


@query("exp_12_export_columns", "SELECT o_orderkey, o_orderdate FROM orders")
def export_selection(spark, sf_dir):
    return W.export_columns(orders(spark, sf_dir), {"o_orderkey": True, "o_custkey": False, "o_orderdate": True})


@query("exp_13_prepared_dataset", PREPARED_SQL.replace(", 2 AS corrections FROM t", " FROM t"))
def prepared_export(spark, sf_dir):
    folder = scratch(spark)
    columns = ["event_id", "station_id", "report_status", "datetime_utc", "air_temperature_c", "prevailing_visibility_m"]
    W.write_parquet(prepared(spark, sf_dir).select(*columns), folder)
    return spark.read.parquet(folder)


# --- ordering and sets --------------------------------------------------------------------------


@query("ord_01_inventory_sort", f"WITH {_FILES_CTE} SELECT doc_id, source_type, path FROM inv WHERE {_LANGS} ORDER BY source_type, lower(path)")
def inventory_sort(spark, sf_dir):
    return SF.sort_inventory(inventory(spark, sf_dir)).select("doc_id", "source_type", "path")


@query("ord_02_file_order", f"WITH {_FILES_CTE} SELECT doc_id, path FROM inv WHERE {_LANGS} ORDER BY lower(path), path")
def file_order(spark, sf_dir):
    return inventory(spark, sf_dir).orderBy(F.lower("path"), "path").select("doc_id", "path")


@query("ord_03_sorted_extension_counts", f"WITH {_FILES_CTE} SELECT extension, count(*) AS files FROM inv WHERE {_LANGS} GROUP BY extension ORDER BY extension")
def extension_counts(spark, sf_dir):
    return inventory(spark, sf_dir).groupBy("extension").agg(F.count(F.lit(1)).alias("files")).orderBy("extension")


_ALL_FILES = "SELECT doc_id AS id, 'documents' AS source_type FROM documents UNION ALL SELECT page_id, 'pages' FROM pages UNION ALL SELECT conv_id, 'conversations' FROM conversations"


@query("set_01_union_of_sources", _ALL_FILES)
def union_sources(spark, sf_dir):
    parts = [("documents", "doc_id"), ("pages", "page_id"), ("conversations", "conv_id")]
    frames = [B.table(spark, sf_dir, t).select(F.col(k).alias("id"), F.lit(t).alias("source_type")) for t, k in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "set_02_distinct_stations_and_paths",
    "SELECT count(DISTINCT source) AS stations, count(DISTINCT sha256(text)) AS contents, count(DISTINCT source || '/' || lang) AS folders FROM documents",
)
def distinct_values(spark, sf_dir):
    docs = B.table(spark, sf_dir, "documents").select(
        "source", F.sha2("text", 256).alias("sha"), F.concat_ws("/", "source", "lang").alias("folder")
    )
    return docs.agg(
        F.countDistinct("source").alias("stations"), F.countDistinct("sha").alias("contents"),
        F.countDistinct("folder").alias("folders"),
    )


@query(
    "set_03_word_set_difference",
    r"""WITH w AS (SELECT doc_id, list_distinct(string_split_regex(lower(text), '\s+')) AS words, ['the','and','of','de','to','is','la'] AS want FROM documents)
    SELECT doc_id, array_to_string(list_sort(list_filter(want, lambda h: NOT list_contains(words, h))), ',') AS missing,
    array_to_string(list_sort(list_filter(want, lambda h: list_contains(words, h))), ',') AS present FROM w""",
)
def header_sets(spark, sf_dir):
    want = F.array(*[F.lit(w) for w in ("the", "and", "of", "de", "to", "is", "la")])
    words = F.split(F.lower("text"), r"\s+")
    return B.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat_ws(",", F.array_sort(F.array_except(want, words))).alias("missing"),
        F.concat_ws(",", F.array_sort(F.array_intersect(want, words))).alias("present"),
    )
