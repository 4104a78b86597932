"""Raw cell grids: physical cleaning, sheet profile, header validation.

A grid has one row per sheet line: ``(source_file, source_sheet, source_row, cells)``. What a sheet
looks like as a whole (which columns hold data, which row is the header) comes from one stored profile with
a small record per sheet; which columns hold data travels as bit masks of 62 columns each, so cells
are never exploded and a sheet of any length and width is combined on the map side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsguard.functions import scalars as S
from obsguard.session import stored

SHEET = ["source_file", "source_sheet"]
#: Columns in one bit mask.
MASK_COLUMNS = 62


def blank_cells_to_null(grid: DataFrame) -> DataFrame:
    """Cells of white space only become null.

    A filter on ``cells`` would take the whole expression below it and work it out a second and third time; what a
    generator gives is worked out once a row, and filters stay above it.
    """
    cells = F.transform("cells", lambda c: S.blank_to_null(c))
    rest = [c for c in grid.columns if c != "cells"]
    return grid.select(*rest, F.explode_outer(F.array(cells)).alias("cells")).select(*grid.columns)


def _masks(cells: Column) -> Column:
    """Masks of MASK_COLUMNS cells each: bit i is set where cell i of the mask holds data."""

    def mask(k: Column) -> Column:
        part = F.reverse(F.slice(cells, k * MASK_COLUMNS + 1, MASK_COLUMNS))
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda a, c: a * 2 + c.isNotNull().cast("bigint"))

    last = F.floor((F.greatest(F.size(cells), F.lit(1)) - 1) / MASK_COLUMNS).cast("int")
    return F.transform(F.sequence(F.lit(0), last), mask)


def drop_empty_rows(grid: DataFrame) -> DataFrame:
    return grid.filter(F.exists("cells", lambda c: c.isNotNull()))


def sheet_sizes(grid: DataFrame) -> DataFrame:
    """Rows, widths, the mask of columns with data and the first row with data of every sheet: numbers only, so
    that a map task keeps one small record a sheet in a hash table."""
    # a row has one mask for every 62 columns, nearly always one
    marked = grid.select(*SHEET, "source_row", F.size("cells").alias("_width"), _masks(F.col("cells")).alias("_masks"))
    kept = F.exists("_masks", lambda m: m != 0).alias("_kept")
    # there is always a mask; the outer form keeps Spark from adding a filter that works the masks out once more
    spread = marked.select(*SHEET, "source_row", "_width", kept, F.posexplode_outer("_masks").alias("_part", "_bits"))
    parts = spread.groupBy(*SHEET, "_part").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.max("_width").alias("_width"),
        F.count_if(~F.col("_kept")).alias("_empty"),
        F.bit_or("_bits").alias("_bits"),
        F.min(F.when(F.col("_bits") != 0, F.col("source_row"))).alias("_row"),
    )
    return parts.groupBy(*SHEET).agg(
        F.max(F.when(F.col("_part") == 0, F.col("_rows"))).alias("rows_before_cleanup"),
        F.max("_width").alias("columns_before_cleanup"),
        F.max(F.when(F.col("_part") == 0, F.col("_empty"))).alias("empty_rows_removed"),
        F.sort_array(F.collect_list(F.struct("_part", "_bits"))).alias("_mask"),
        F.min("_row").alias("header_row"),
    )


def first_rows(grid: DataFrame, sizes: DataFrame) -> DataFrame:
    """(sheet, _first): the cells of every sheet's first row with data. ``sizes`` is stored, so Spark
    broadcasts its row numbers where they are few; a semi join goes below the cleaning of cells, which only these
    rows need."""
    heads = sizes.filter(F.col("header_row").isNotNull()).select(*SHEET, F.col("header_row").alias("source_row"))
    return grid.join(heads, [*SHEET, "source_row"], "left_semi").groupBy(*SHEET).agg(F.min("cells").alias("_first"))


def profile_sheets(grid: DataFrame) -> DataFrame:
    """One record per sheet of a grid whose blanks are null, whatever its width.

    Rows and columns before and after cleanup, positions of empty columns before cleanup, the
    columns kept, the header (first surviving row) and the headerless columns that hold data
    (positions after cleanup). A sheet without data has ``rows`` = 0.

    The grid is read twice, for the numbers and for the header rows they name; the profile is stored in the shared
    folder, so whatever is joined to it, however often, reads the profile and not the grid.
    """
    sizes = stored(sheet_sizes(grid), "sheet-sizes")
    base = sizes.join(first_rows(grid, sizes), SHEET, "left")
    positions = F.when(F.col("columns_before_cleanup") > 0, F.sequence(F.lit(1), F.col("columns_before_cleanup")))

    def filled(p: Column) -> Column:
        part = F.element_at(F.col("_mask"), F.floor((p - 1) / MASK_COLUMNS).cast("int") + 1)
        return F.getbit(part["_bits"], (p - 1) % MASK_COLUMNS) == 1

    kept = F.filter(positions, filled)
    with_kept = base.withColumns(
        {
            "kept_positions": F.coalesce(kept, F.array().cast("array<int>")),
            "empty_column_positions": F.coalesce(
                F.filter(positions, lambda p: ~filled(p)), F.array().cast("array<int>")
            ),
            "rows": F.col("rows_before_cleanup") - F.col("empty_rows_removed"),
        }
    )
    header = F.transform("kept_positions", lambda p: F.get(F.col("_first"), p - 1))
    out = with_kept.withColumns(
        {
            "header": header,
            "columns": F.size("kept_positions"),
            "empty_columns_removed": F.size("empty_column_positions"),
        }
    )
    missing = F.filter(
        F.transform(
            F.col("header"),
            lambda h, i: F.struct(
                (i + 1).alias("position"),
                S.column_letter(i + 1).alias("excel_column"),
                F.concat(F.lit("UNKNOWN_"), F.when(i < 9, F.lpad((i + 1).cast("string"), 2, "0")).otherwise((i + 1).cast("string"))).alias("suggested_name"),
                h.isNull().alias("_empty"),
            ),
        ),
        lambda s: s["_empty"],
    )
    profile = out.withColumn("headerless_columns_with_data", F.transform(missing, lambda s: s.dropFields("_empty")))
    return stored(profile.drop("_mask", "_first"), "sheet-profile")


def empty_sheets(profile: DataFrame) -> DataFrame:
    return profile.filter(F.col("rows") == 0).select(*SHEET)


def clean_grid(grid: DataFrame, profile: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Rows and columns that hold data; sheets without any disappear.

    ``carry`` names profile columns to keep on the rows.
    """
    kept = profile.filter(F.col("rows") > 0).select(*SHEET, "kept_positions", *(carry or []))
    return (
        drop_empty_rows(grid)
        .join(kept, SHEET)
        .withColumn("cells", F.transform("kept_positions", lambda p: F.get(F.col("cells"), p - 1)))
        .drop("kept_positions")
    )


# --- header validation --------------------------------------------------------------------------

CHECKS_PER_SHEET = 7


def normalize_headers(profile: DataFrame) -> DataFrame:
    """Add ``headers``: the header row folded and squeezed for comparison (one row per sheet)."""
    folded = profile.withColumn("_folded", S.nfkc_array(F.col("header")))
    return folded.withColumn("headers", F.transform("_folded", lambda h: S.normalize_header(h))).drop("_folded")


def resolve_header_aliases(headers: DataFrame, aliases: dict[str, str], column: str = "headers") -> DataFrame:
    """Replace known alternative header texts by the contract's."""
    table = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
    return headers.withColumn(column, F.transform(column, lambda h: F.coalesce(F.element_at(table, h), h)))


def validate_headers(profile: DataFrame, expected: list[str], column: str = "headers") -> DataFrame:
    """Seven structural checks of each sheet with data, in the order of the defects they name."""
    found = F.col(column)
    want = F.array(*[F.lit(h) for h in expected])
    named = F.filter(found, lambda h: h != "")
    repeated = F.array_sort(
        F.filter(F.array_distinct(named), lambda h: F.size(F.filter(found, lambda g: g == h)) > 1)
    )
    sheets = profile.filter(F.col("rows") > 0).withColumns(
        {
            "missing_columns": F.filter(want, lambda h: ~F.array_contains(found, h)),
            "extra_columns": F.filter(named, lambda h: ~F.array_contains(want, h)),
            "duplicate_headers": repeated,
            "empty_header_positions": F.filter(
                F.transform(found, lambda h, i: F.when(h == "", i + 1)), lambda p: p.isNotNull()
            ),
            "columns_expected": F.lit(len(expected)),
            "columns_found": F.size(found),
        }
    )
    sheets = sheets.withColumns(
        {
            "column_count_valid": F.col("columns_found") == len(expected),
            "header_order_valid": found == want,
            "no_duplicates": F.size("duplicate_headers") == 0,
            "no_missing": F.size("missing_columns") == 0,
            "no_extra": F.size("extra_columns") == 0,
            "no_empty": F.size("empty_header_positions") == 0,
        }
    )
    sheets = sheets.withColumn(
        "headers_valid", F.col("no_empty") & F.col("no_duplicates") & F.col("no_missing") & F.col("no_extra")
    )
    tests = [
        "column_count_valid", "header_order_valid", "headers_valid", "no_duplicates", "no_missing", "no_extra",
        "no_empty",
    ]
    passed = sum((F.col(t).cast("int") for t in tests), F.lit(0))

    def note(ok: str, text: str, detail: Column) -> Column:
        return F.when(~F.col(ok), F.concat(F.lit(text), detail))

    errors = F.array_compact(
        F.array(
            note("column_count_valid", "column count: ", F.col("columns_found").cast("string")),
            note("no_empty", "empty headers at: ", F.concat_ws(", ", F.col("empty_header_positions").cast("array<string>"))),
            note("no_duplicates", "repeated headers: ", F.concat_ws(", ", "duplicate_headers")),
            note("no_missing", "missing columns: ", F.concat_ws(", ", "missing_columns")),
            note("no_extra", "extra columns: ", F.concat_ws(", ", "extra_columns")),
            note("header_order_valid", "header order differs", F.lit("")),
        )
    )
    return (
        sheets.withColumn("validation_passed", passed)
        .withColumns(
            {
                "validation_checks": F.lit(CHECKS_PER_SHEET),
                "validation_failed": F.lit(CHECKS_PER_SHEET) - F.col("validation_passed"),
                "integrity": F.round(F.col("validation_passed") * 100.0 / CHECKS_PER_SHEET, 2),
                "validation_errors": errors,
                "structure_valid": F.size(errors) == 0,
            }
        )
        .drop("no_duplicates", "no_missing", "no_extra", "no_empty")
    )


def file_validity(files: DataFrame, sheets: DataFrame, file: str = "source_file") -> DataFrame:
    """A file is valid when it has at least one sheet and all its sheets are."""
    rolled = sheets.groupBy(file).agg(
        F.bool_and("structure_valid").alias("_all"),
        F.count(F.lit(1)).alias("_sheets"),
        F.sum(F.size("validation_errors")).alias("_errors"),
        F.array_sort(F.collect_list(F.struct("source_sheet", "validation_errors"))).alias("_by_sheet"),
    )
    return files.join(rolled, file, "left").select(
        *files.columns,
        F.coalesce("_sheets", F.lit(0)).cast("bigint").alias("sheets"),
        F.coalesce("_all", F.lit(False)).alias("structure_valid"),
        F.coalesce("_errors", F.lit(0)).cast("bigint").alias("error_count"),
        F.coalesce(
            F.flatten(F.transform("_by_sheet", lambda s: s["validation_errors"])), F.array().cast("array<string>")
        ).alias("validation_errors"),
    )


# --- statistics ---------------------------------------------------------------------------------


def file_rollup(files: DataFrame, profile: DataFrame, file: str = "source_file") -> DataFrame:
    """Per file: sums of rows and removals, the widest sheet, and the ingest status."""
    useful = F.col("rows") > 0
    rolled = profile.groupBy(file).agg(
        F.count_if(useful).alias("sheet_count"),
        F.count_if(~useful).alias("empty_sheets_ignored"),
        *[
            F.sum(F.when(useful, F.col(c))).alias(n)
            for c, n in (
                ("rows_before_cleanup", "total_rows_before_cleanup"),
                ("empty_rows_removed", "empty_rows_removed"),
                ("empty_columns_removed", "empty_columns_removed"),
                ("rows", "total_rows"),
            )
        ],
        F.max(F.when(useful, F.col("columns_before_cleanup"))).alias("total_columns_before_cleanup"),
        F.max(F.when(useful, F.col("columns"))).alias("total_columns"),
        F.sum(F.when(useful, F.size("headerless_columns_with_data"))).alias("headerless_columns_with_data"),
    )
    numbers = [c for c in rolled.columns if c != file]
    out = files.join(rolled, file, "left").withColumns(
        {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in numbers}
    )
    return out.withColumn("status", ingest_status(out))


def ingest_status(files: DataFrame) -> Column:
    """error when unreadable, skipped when the type is unsupported or no sheet holds data, else success."""
    status = F.when(F.col("sheet_count") > 0, "success").otherwise("skipped")
    if "supported" in files.columns:
        status = F.when(~F.col("supported"), "skipped").otherwise(status)
    if "read_error" in files.columns:
        status = F.when(F.col("read_error").isNotNull(), "error").otherwise(status)
    return status


def ingestion_statistics(files: DataFrame, station: str = "station_id") -> DataFrame:
    """One row: files by status, stations, sheets, rows; sums cover successful files only."""
    good = F.col("status") == "success"

    def over_good(c: str) -> Column:
        return F.coalesce(F.sum(F.when(good, F.col(c))), F.lit(0)).cast("bigint")

    return files.agg(
        F.count(F.lit(1)).alias("files_processed"),
        F.count_if(good).alias("files_successful"),
        F.count_if(F.col("status") == "error").alias("files_failed"),
        F.count_if(F.col("status") == "skipped").alias("files_skipped"),
        F.countDistinct(F.when(F.col(station) != "UNKNOWN", F.col(station))).alias("stations_found"),
        over_good("sheet_count").alias("sheets_read"),
        F.coalesce(F.sum("empty_sheets_ignored"), F.lit(0)).cast("bigint").alias("empty_sheets_ignored"),
        over_good("total_rows_before_cleanup").alias("rows_before_cleanup"),
        over_good("empty_rows_removed").alias("empty_rows_removed"),
        over_good("total_rows").alias("rows_read"),
        over_good("empty_columns_removed").alias("empty_columns_removed"),
        over_good("headerless_columns_with_data").alias("headerless_columns_with_data"),
    )


def structure_statistics(files: DataFrame, sheets: DataFrame) -> DataFrame:
    """One row: valid and invalid files and sheets, defects, integrity as a ratio of sums."""
    sized = {
        "missing_columns": F.size("missing_columns"), "extra_columns": F.size("extra_columns"),
        "duplicate_headers": F.size("duplicate_headers"), "empty_headers": F.size("empty_header_positions"),
        "validation_checks": F.col("validation_checks"), "validation_passed": F.col("validation_passed"),
        "validation_failed": F.col("validation_failed"),
    }
    # files and sheets in one frame, so that one aggregate gives one row
    both = files.select(F.lit(True).alias("_file"), "structure_valid").unionByName(
        sheets.select(F.lit(False).alias("_file"), "structure_valid", *[c.alias(n) for n, c in sized.items()]),
        allowMissingColumns=True,
    )
    file, valid = F.col("_file"), F.col("structure_valid")
    return both.agg(
        F.count_if(file).alias("files_validated"),
        F.count_if(file & valid).alias("files_valid"),
        F.count_if(file & ~valid).alias("files_invalid"),
        F.count_if(~file).alias("sheets_validated"),
        F.count_if(~file & valid).alias("sheets_valid"),
        F.count_if(~file & ~valid).alias("sheets_invalid"),
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in sized],
    ).withColumn(
        "integrity",
        F.when(
            F.col("validation_checks") > 0,
            F.round(F.col("validation_passed") * 100.0 / F.col("validation_checks"), 2),
        ).otherwise(0.0),
    )
