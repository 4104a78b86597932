"""Session settings the library relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods above 8000 bytes of bytecode. A projection of many checks
    # fused into one method would be interpreted; above this limit Spark splits it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and measurements; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("obsguard")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Set the one performance setting the wide row checks depend on in a session made elsewhere."""
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, SETTINGS[name])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, whose tasks share the driver's disk, gets a folder of its own where none is
    named; a cluster without one is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix="obsguard-")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: evaluated once, its size known to the joins after it."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
