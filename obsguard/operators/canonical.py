"""From valid sheets to the canonical observation table, and its preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsguard.catalogs import contract
from obsguard.functions import scalars as S
from obsguard.operators.framework import correct
from obsguard.operators.grid import SHEET


def header_positions(sheets: DataFrame, expected: list[str], column: str = "headers") -> DataFrame:
    """Per sheet, where each contract column sits (0 = absent)."""
    where = F.array(*[F.array_position(F.col(column), h).cast("int") for h in expected])
    return sheets.select(*SHEET, where.alias("_where"), F.col("header_row").alias("_header_row"))


def promote_headers(grid: DataFrame, sheets: DataFrame, names: dict[str, str], column: str = "headers") -> DataFrame:
    """Data rows with cells named by the contract: ``names`` maps header -> column name.

    ``grid`` is a cleaned grid; ``sheets`` is its profile with the compared headers.
    """
    expected = list(names)
    where = header_positions(sheets, expected, column)
    cell = [
        F.when(F.col("_where")[i] > 0, F.get(F.col("cells"), F.col("_where")[i] - 1)).alias(name)
        for i, name in enumerate(names.values())
    ]
    return (
        grid.join(where, SHEET)
        .filter(F.col("source_row") > F.col("_header_row"))
        .select(*cell, *SHEET, "source_row")
    )


def consolidate(
    grid: DataFrame, validated: DataFrame, names: dict[str, str], inventory: DataFrame | None = None
) -> DataFrame:
    """Rows of all structurally valid sheets in one table with file, sheet, row and content hash."""
    rows = promote_headers(grid, validated.filter(F.col("structure_valid")), names)
    if inventory is None:
        return rows.withColumn("source_hash", F.lit(None).cast("string"))
    hashes = inventory.select(F.col("path").alias("source_file"), F.col("sha256").alias("source_hash"))
    return rows.join(hashes, "source_file", "left")


def normalize_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Trim, collapse blanks, empty and missing tokens to null."""
    return df.withColumns({c: S.missing_text_to_null(S.squeeze(F.col(c))) for c in columns})


def parse_columns(df: DataFrame, types: dict[str, str], exempt: tuple[str, ...] = S.MISSING_EXEMPT) -> DataFrame:
    """Text columns to their input types; numeric sentinels become null unless exempt."""
    out = {}
    for c, dtype in types.items():
        if c not in df.columns:
            continue
        parsed = S.typed_parse(F.col(c), dtype)
        if dtype in ("number", "integer") and c not in exempt:
            parsed = S.missing_number_to_null(parsed)
        out[c] = parsed
    return df.withColumns(out)


def with_datetime(df: DataFrame, start_month: int = 1) -> DataFrame:
    """datetime_utc, date and climatological_year from the five components."""
    ts = S.datetime_from_parts(*[F.col(c) for c in ("year", "month", "day", "hour_utc", "minute")])
    return (
        df.withColumn("datetime_utc", ts)
        .withColumn("date", F.to_date("datetime_utc"))
        .withColumn("climatological_year", S.climatological_year(F.col("datetime_utc"), start_month))
    )


def record_id(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("~", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def with_technical_columns(
    df: DataFrame, run_id: str, processed_at: str, pipeline_version: str, dictionary_version: str
) -> DataFrame:
    """Identity and run columns; the time of processing is an argument, so a rerun gives equal rows."""
    key = [F.col("station_id"), F.date_format("datetime_utc", "yyyy-MM-dd HH:mm:ss")]
    key += [F.col(c) for c in ("source_file", "source_sheet", "source_row")]
    return df.withColumns(
        {
            "record_id": record_id(*key),
            "pipeline_run_id": F.lit(run_id),
            "processing_timestamp": F.lit(processed_at).cast("timestamp_ntz"),
            "pipeline_version": F.lit(pipeline_version),
            "dictionary_version": F.lit(dictionary_version),
        }
    )


def to_canonical(df: DataFrame, schema: T.StructType | None = None, fill_missing: bool = False) -> DataFrame:
    """Canonical columns in order with their types; anything else is rejected.

    With ``fill_missing`` absent columns become null instead of an error.
    """
    schema = schema or contract.canonical_schema()
    have, want = set(df.columns), set(schema.fieldNames())
    extra = sorted(have - want)
    absent = sorted(want - have)
    if extra:
        raise ValueError(f"columns outside the contract: {extra}")
    if absent and not fill_missing:
        raise ValueError(f"columns missing from the contract: {absent}")
    picked = []
    for f in schema.fields:
        source = F.col(f.name) if f.name in have else F.lit(None)
        picked.append(source.try_cast(f.dataType).alias(f.name))
    return df.select(*picked)


FINDING = "array<struct<column:string,problem:string,value:string>>"


def canonical_with_findings(
    df: DataFrame, schema: T.StructType | None = None, into: str = "contract_findings"
) -> DataFrame:
    """The canonical columns, and per row what the contract objects to; one projection, no row is lost.

    ``cast_failed``: a value that its type cannot hold, with the value as it came; ``required_null``: no value, or
    none left, in a column that must have one. Columns that the frame lacks count as null, others are rejected.
    """
    schema = schema or contract.canonical_schema()
    have = set(df.columns)
    extra = sorted(have - set(schema.fieldNames()))
    if extra:
        raise ValueError(f"columns outside the contract: {extra}")
    # casts first, as columns of their own: value and finding read the same one
    cast = df.select(
        *[F.col(f.name).alias(f"_raw_{f.name}") for f in schema.fields if f.name in have],
        *[(F.col(f.name) if f.name in have else F.lit(None)).try_cast(f.dataType).alias(f.name) for f in schema.fields],
    )

    def finding(column: str, problem: str, bad: Column, value: Column) -> Column:
        entry = F.struct(F.lit(column).alias("column"), F.lit(problem).alias("problem"), value.cast("string").alias("value"))
        return F.when(bad, entry)

    found = []
    for f in schema.fields:
        if f.name in have and df.schema[f.name].dataType != f.dataType:
            raw = F.col(f"_raw_{f.name}")
            found.append(finding(f.name, "cast_failed", raw.isNotNull() & F.col(f.name).isNull(), raw))
        if not f.nullable:
            found.append(finding(f.name, "required_null", F.col(f.name).isNull(), F.lit(None)))
    findings = F.array_compact(F.array(*found)) if found else F.array()
    return cast.withColumn(into, findings.cast(FINDING)).select(*schema.fieldNames(), into)


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Keys that more than one row has, with the number of rows; counted on the map side, so copies never gather."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def null_violations(df: DataFrame, required: list[str]) -> DataFrame:
    """One row per required column: how many nulls it holds (one aggregate for all of them)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "column_name", "null_count")


def melt(df: DataFrame, ids: list[str], variables: list[str]) -> DataFrame:
    """Wide to long (ids, variable, value); values are doubles, nulls are kept."""
    typed = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in variables])
    return typed.unpivot(ids, variables, "variable", "value")


def fix_known_typos(df: DataFrame, fixes: DataFrame, field: str, at: str) -> DataFrame:
    """Replace known wrong spellings (fixes: field, wrong, right) and log the change."""
    table = fixes.filter(F.col("field") == field).select(F.col("wrong").alias("_wrong"), F.col("right").alias("_right"))
    joined = df.join(table, F.col(field) == F.col("_wrong"), "left")
    return correct(joined, field, F.coalesce(F.col("_right"), F.col(field)), "fix_known_typing_errors", at).drop(
        "_wrong", "_right"
    )


def normalize_case(df: DataFrame, at: str, fields: list[str] | None = None) -> DataFrame:
    """Upper case for the coded fields, with a trace of every change."""
    fields = fields or [
        "station_id", "report_type", "report_status", "present_weather_1", "present_weather_2", "present_weather_3",
    ]
    for f in fields:
        if f in df.columns:
            df = correct(df, f, F.upper(F.col(f)), "normalize_case", at)
    return df


def convert_units(
    df: DataFrame, value: str, aliases: DataFrame, units: DataFrame, unit: str = "unit", target: str = "target_unit"
) -> DataFrame:
    """Add ``converted_value``: the value in the target unit, rounded to the target's precision.

    Incompatible or unknown units give null; the original value and unit stay as they are.
    """
    from obsguard.operators.joins import resolve_units

    into = units.select(
        F.col("unit_id").alias(target), F.col("base_unit").alias("target_base"), F.col("factor").alias("_f2"),
        F.col("offset").alias("_o2"), F.col("precision").alias("_p2"),
    )
    joined = resolve_units(df, unit, aliases, units).join(into, target, "left")
    x = S.convert_unit(F.col(value), F.col("factor"), F.col("offset"), F.col("_f2"), F.col("_o2"))
    ok = F.col("base_unit") == F.col("target_base")
    return joined.withColumn("converted_value", F.when(ok, S.round_to(x, F.col("_p2")))).drop("_f2", "_o2", "_p2")
