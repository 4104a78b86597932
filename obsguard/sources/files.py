"""File inventory: discovery, fingerprints, exact duplicates, station from path."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsguard.sources.listing import folder_exists, list_files, with_digests

# Names of system files that are never data.
SYSTEM_NAMES = ["thumbs.db", "desktop.ini", ".ds_store"]

INVENTORY_SCHEMA = (
    "source_ordinal int, source_type string, path string, relative_path string, filename string, stem string,"
    " extension string, size_bytes bigint, modified_utc string, sha256 string"
)


def normalize_extensions(extensions: Iterable[str]) -> list[str]:
    cleaned = (e.strip().lower() for e in extensions)
    return sorted({e if e.startswith(".") else f".{e}" for e in cleaned if e})


def filename_of(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def extension_of(path: Column) -> Column:
    """Lower-case suffix with its dot; a name that only starts with a dot has none."""
    return F.lower(F.regexp_extract(filename_of(path), r"^.+(\.[^.]+)$", 1))


def stem_of(path: Column) -> Column:
    return F.regexp_replace(filename_of(path), r"^(.+)\.[^.]+$", "$1")


def is_ignored(path: Column) -> Column:
    """Temporary, hidden and system files, and anything below a hidden folder."""
    name = filename_of(path)
    return F.lower(name).isin(SYSTEM_NAMES) | name.startswith("~$") | path.rlike(r"(^|/)\.[^./][^/]*|(^|/)\.\.[^/]+")


def select_files(listing: DataFrame, extensions: Iterable[str], path: str = "path") -> DataFrame:
    wanted = normalize_extensions(extensions)
    return listing.filter(~is_ignored(F.col(path)) & extension_of(F.col(path)).isin(wanted))


def split_empty(listing: DataFrame, size: str = "size_bytes") -> tuple[DataFrame, DataFrame]:
    """(files with content, empty files to warn about)."""
    return listing.filter(F.col(size) > 0), listing.filter(F.col(size) == 0)


def inventory_of_source(
    spark: SparkSession, source_type: str, ordinal: int, directory: str, extensions: Iterable[str],
    recursive: bool = True, root: str | None = None,
) -> DataFrame:
    """Inventory rows of one source folder; a folder that does not exist gives none."""
    listed = select_files(list_files(spark, directory, recursive), extensions).filter(F.col("size_bytes") > 0)
    files = with_digests(spark, listed, directory)
    local = F.regexp_replace(F.col("path"), "^file:/*", "/")
    relative = F.regexp_replace(local, f"^{re.escape(root.rstrip('/'))}/", "") if root else local
    return files.select(
        F.lit(ordinal).alias("source_ordinal"),
        F.lit(source_type).alias("source_type"),
        local.alias("path"),
        relative.alias("relative_path"),
        filename_of(local).alias("filename"),
        stem_of(local).alias("stem"),
        extension_of(local).alias("extension"),
        "size_bytes",
        F.date_format(F.timestamp_micros("modified_us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("modified_utc"),
        "sha256",
    )


def _usable(source: dict) -> bool:
    return bool(source.get("enabled", False) and source.get("directory") and normalize_extensions(source.get("extensions", [])))


def discover(spark: SparkSession, sources: list[dict], root: str | None = None) -> DataFrame:
    """Inventory of all enabled sources, in their configured order.

    A source is ``{"type", "directory", "extensions", "recursive", "enabled"}``.
    """
    out = spark.createDataFrame([], INVENTORY_SCHEMA)
    for i, s in enumerate(sources):
        if _usable(s):
            out = out.unionByName(
                inventory_of_source(spark, s["type"], i, s["directory"], s["extensions"], s.get("recursive", True), root)
            )
    return out


WARNINGS = "source_ordinal int, source_type string, problem string, path string"


def discovery_warnings(spark: SparkSession, sources: list[dict]) -> DataFrame:
    """What discovery passes over: enabled sources without a folder, without extensions, with a folder that does not
    exist; and files of a wanted extension that are empty. Ignored names are not empty files."""
    told: list[tuple[int, str, str, str | None]] = []
    out = spark.createDataFrame([], WARNINGS)
    for i, s in enumerate(sources):
        if not s.get("enabled", False):
            continue
        if not s.get("directory"):
            told.append((i, s["type"], "no_path", None))
        elif not normalize_extensions(s.get("extensions", [])):
            told.append((i, s["type"], "no_extensions", s["directory"]))
        elif not folder_exists(spark, s["directory"]):
            told.append((i, s["type"], "folder_missing", s["directory"]))
        else:
            listed = select_files(list_files(spark, s["directory"], s.get("recursive", True)), s["extensions"])
            _, empty = split_empty(listed)
            out = out.unionByName(empty.select(
                F.lit(i).alias("source_ordinal"), F.lit(s["type"]).alias("source_type"), F.lit("empty_file").alias("problem"),
                F.regexp_replace("path", "^file:/*", "/").alias("path"),
            ))
    return out.unionByName(spark.createDataFrame(told, WARNINGS))


def mark_duplicate_files(inventory: DataFrame) -> DataFrame:
    """Add ``duplicate_of``: the path of the first file with equal content, null for the first itself.

    First means configured source order, then lower-case path. Only contents seen more than once
    are joined back, one row each, so many copies of one file never meet in one task.
    """
    rank = F.struct(F.col("source_ordinal"), F.lower("path").alias("lower_path"), F.col("path"), F.col("relative_path"))
    firsts = (
        inventory.groupBy("sha256")
        .agg(F.count(F.lit(1)).alias("_copies"), F.min(rank).alias("_first"))
        .filter(F.col("_copies") > 1)
    )
    return (
        inventory.join(firsts, "sha256", "left")
        .withColumn("duplicate_of", F.when(F.col("_first") != rank, F.col("_first.relative_path")))
        .drop("_copies", "_first")
    )


def unique_files(marked: DataFrame) -> DataFrame:
    return marked.filter(F.col("duplicate_of").isNull()).drop("duplicate_of")


def sort_inventory(inventory: DataFrame) -> DataFrame:
    return inventory.orderBy("source_type", F.lower("relative_path"))


def station_from_path(relative_path: Column, source_type: Column) -> Column:
    """Folder after the one named like the source type, upper case; UNKNOWN when there is none."""
    parts = F.split(relative_path, "/")
    at = F.array_position(F.transform(parts, lambda p: F.lower(p)), F.lower(source_type))
    after = F.when(at > 0, F.get(parts, at.cast("int")))
    return F.coalesce(F.upper(F.trim(after)), F.lit("UNKNOWN"))


def discovery_statistics(inventory: DataFrame) -> DataFrame:
    """Files and bytes in total, by extension and by source type, in one pass."""
    return (
        inventory.groupingSets([[], ["extension"], ["source_type"]], "extension", "source_type")
        .agg(
            F.grouping_id().alias("level"),
            F.count(F.lit(1)).alias("files"),
            F.sum("size_bytes").alias("bytes"),
        )
        .select("level", "extension", "source_type", "files", "bytes")
    )
