"""Writers and the guards around them."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from obsguard.sources.listing import list_files, with_digests

TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
JDBC_BATCH = 5000


def _mode(overwrite: bool) -> str:
    return "overwrite" if overwrite else "errorifexists"


def flatten_arrays(df: DataFrame, sep: str = ";") -> DataFrame:
    """Arrays of text joined: the delimited format has no arrays."""
    return df.select(
        *[
            F.concat_ws(sep, F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str, overwrite: bool = True, sep: str = ",") -> None:
    (
        flatten_arrays(df).write.mode(_mode(overwrite))
        .option("header", "true").option("sep", sep).option("encoding", "UTF-8")
        .option("timestampFormat", TIME_FORMAT).option("timestampNTZFormat", TIME_FORMAT)
        .csv(path)
    )


def write_parquet(
    df: DataFrame, path: str, overwrite: bool = True, partition_by: list[str] | None = None
) -> None:
    writer = df.write.mode(_mode(overwrite)).option("compression", "snappy")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_json(df: DataFrame, path: str, overwrite: bool = True) -> None:
    df.write.mode(_mode(overwrite)).json(path)


#: Folder columns of the layouts.
LAYOUTS = {"yearly": ["year"], "monthly": ["year", "month"], "daily": ["year", "month", "day"]}


def write_layout(df: DataFrame, path: str, layout: str, overwrite: bool = True) -> None:
    """Daily, monthly or yearly folders; a rerun replaces the folders that it has rows for and leaves the others.

    Rows are rebalanced by the folder columns: adaptive execution splits a large folder into as many
    tasks as its size asks for and merges small ones.
    """
    keys = LAYOUTS[layout]
    spread = df.hint("rebalance", *[F.col(k) for k in keys])
    writer = spread.write.mode(_mode(overwrite)).option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Append to a database table in batches; arrays are joined first."""
    flatten_arrays(df).write.jdbc(
        url, table, mode="append", properties={"batchsize": str(JDBC_BATCH), **(properties or {})}
    )


def quarantine(df: DataFrame, bad, path: str, overwrite: bool = True) -> None:
    """Copy the rows for which ``bad`` holds or cannot be told; the input keeps them."""
    write_parquet(df.filter(F.coalesce(bad, F.lit(True))), path, overwrite)


def quarantine_files(grid: DataFrame, files: DataFrame, path: str, overwrite: bool = True) -> None:
    """Copy all rows of the files that are not valid, with the reasons; the grid keeps them.

    ``files`` has source_file, structure_valid and validation_errors; a file that could not be read has no rows, and
    one row without a sheet stands for it.
    """
    bad = files.filter(~F.coalesce("structure_valid", F.lit(False))).select("source_file", "validation_errors")
    write_parquet(bad.join(grid, "source_file", "left"), path, overwrite)


def manifest(spark: SparkSession, directory: str) -> DataFrame:
    """Path, name, size and SHA-256 of every product file below a folder; markers and checksum files are none."""
    files = list_files(spark, directory).withColumn("filename", F.regexp_extract("path", r"([^/]+)$", 1))
    products = files.filter(~F.col("filename").rlike("^[._]")).select("path", "filename", "size_bytes")
    return with_digests(spark, products, directory)


def export_columns(df: DataFrame, flags: dict[str, bool]) -> DataFrame:
    """Only the columns whose export flag is set, in their order."""
    return df.select(*[c for c in df.columns if flags.get(c, False)])


class StopOnError(RuntimeError):
    """Files failed and the caller asked to stop."""


def raise_if_failed(results: DataFrame, stop: bool = True) -> int:
    """Number of files with status error; raises after statistics were recorded when asked to."""
    failed = results.filter(F.col("status") == "error").count()
    if failed and stop:
        raise StopOnError(f"{failed} file(s) could not be read")
    return failed


def save_stage(spark: SparkSession, df: DataFrame, folder: str, run_id: str, stage: str, metrics: dict) -> DataFrame:
    """Dataset and one-row metadata of a finished stage; returns the stored dataset.

    The dataset goes to a new folder, which the metadata, written last, names: a run that breaks off
    leaves what was stored before in force, or nothing.
    """
    base, data = f"{folder.rstrip('/')}/{run_id}_{stage}", f"data-{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/{data}")
    record = json.dumps({"run_id": run_id, "stage": stage, **metrics, "data": data}, sort_keys=True)
    spark.createDataFrame([(record,)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/meta")
    return spark.read.parquet(f"{base}/{data}")


def load_stage(spark: SparkSession, folder: str, run_id: str, stage: str) -> DataFrame | None:
    """The stored dataset when the stage finished (its metadata is written last), else None."""
    base = f"{folder.rstrip('/')}/{run_id}_{stage}"
    try:
        spark.read.text(f"{base}/meta/_SUCCESS")
        record = json.loads(spark.read.text(f"{base}/meta").first()["value"])
        return spark.read.parquet(f"{base}/{record['data']}")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def run_log(spark: SparkSession, run_id: str, stage: str, statistics: DataFrame) -> DataFrame:
    """A one-row statistics table as (run_id, stage, metric, value) rows."""
    names = statistics.columns
    typed = statistics.select(*[F.col(c).cast("string").alias(c) for c in names])
    return typed.unpivot([], names, "metric", "value").select(
        F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), "metric", "value"
    )


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column], partition_by: list[str] | None = None) -> dict:
    """Write ``df`` and return the aggregates ``metrics`` of what was written, taken while it was written.

    The numbers cost no second pass, and belong to the rows of the export, not to a later reading.
    """
    seen = Observation()
    observed = df.observe(seen, *[c.alias(n) for n, c in metrics.items()])
    write_parquet(observed, path, True, partition_by)
    return dict(seen.get)
