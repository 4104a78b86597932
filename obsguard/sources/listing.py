"""File listings and digests made by the executors, without a file ever being one value.

Spark's own file scan hides empty files, hidden files and missing folders, and hands on a file's content
as one value of at most 2 GiB. Here folders are listed, and files read in blocks, through a file system
that Python can open; folders in any other store fall back on the scan, with its limits.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

LISTING = "path string, size_bytes bigint, modified_us bigint"
#: Bytes of a file read at once.
BLOCK = 1 << 20
#: The driver goes down level by level until it has so many folders for tasks to list, or so many levels.
FOLDERS, LEVELS = 64, 3


def qualified(spark: SparkSession, directory: str) -> str:
    """The folder's full address under the session's default file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def opened(address: str) -> tuple[pafs.FileSystem, str, str] | None:
    """(file system, path there, what to put before a path to get an address); None for other stores."""
    if address.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + address[len("file:"):].lstrip("/"), ""
    try:
        system, path = pafs.FileSystem.from_uri(address)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    return system, path, address[: len(address) - len(path)] if address.endswith(path) else ""


def _rows(found: list[pafs.FileInfo], prefix: str) -> list[tuple[str, int, int]]:
    files = [f for f in found if f.type == pafs.FileType.File]
    return [(prefix + f.path, int(f.size or 0), (f.mtime_ns or 0) // 1000) for f in files]


def folder_exists(spark: SparkSession, directory: str) -> bool:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(path) and system.getFileStatus(path).isDirectory()


def list_files(spark: SparkSession, directory: str, recursive: bool = True) -> DataFrame:
    """LISTING rows of all files below ``directory``, hidden and empty ones too; none where it does not exist.

    The driver lists the first levels only; what lies below their folders is listed by tasks.
    """
    store = opened(qualified(spark, directory))
    if store is None:
        return _scanned(spark, directory, recursive)
    system, path, prefix = store
    files: list[tuple[str, int, int]] = []
    folders, levels = [path], 0
    while folders and levels < LEVELS and (levels == 0 or (recursive and len(folders) < FOLDERS)):
        below: list[str] = []
        for folder in folders:
            found = system.get_file_info(pafs.FileSelector(folder, allow_not_found=True))
            files += _rows(found, prefix)
            below += [f.path for f in found if f.type == pafs.FileType.Directory]
        folders, levels = below, levels + 1
    out = spark.createDataFrame(files, LISTING)
    if not recursive or not folders:
        return out
    seeds = spark.createDataFrame([(prefix + f,) for f in folders], "path string").repartition(min(len(folders), 1000))

    def list_below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                where, at, before = opened(folder if prefix else f"file:{folder}")
                rows = _rows(where.get_file_info(pafs.FileSelector(at, recursive=True, allow_not_found=True)), before)
                for a in range(0, len(rows), 10_000):
                    columns = list(zip(*rows[a : a + 10_000], strict=True))
                    kinds = (pa.string(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "size_bytes", "modified_us"])

    return out.unionByName(seeds.mapInArrow(list_below, LISTING))


def _scanned(spark: SparkSession, directory: str, recursive: bool) -> DataFrame:
    """The listing of Spark's scan, for stores that only Spark opens; it leaves out hidden and empty files."""
    try:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(directory)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LISTING)
    return found.select("path", F.col("length").alias("size_bytes"), F.unix_micros("modificationTime").alias("modified_us"))


def with_digests(spark: SparkSession, files: DataFrame, directory: str, name: str = "sha256") -> DataFrame:
    """``files`` (path and other columns) with the SHA-256 of each, read in blocks by the tasks.

    A file is one running digest, so one of any size needs one block of memory. ``directory`` tells the store.
    """
    if opened(qualified(spark, directory)) is None:
        content = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
        return files.join(content.select("path", F.sha2("content", 256).alias(name)), "path", "left").select(*files.columns, name)
    schema = files.schema

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                system, at, _ = opened(path if ":" in path.split("/", 1)[0] else f"file:{path}")
                running = hashlib.sha256()
                with system.open_input_stream(at) as stream:
                    while block := stream.read(BLOCK):
                        running.update(block)
                out.append(running.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, name])

    # a task's work is in the files, not in these rows: the number of tasks is set, not left to their bytes
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInArrow(digest, schema.add(name, "string"))
