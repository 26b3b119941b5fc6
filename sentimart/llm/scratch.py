"""Tables written once in the folder all executors share, to cut lineage between the steps of an operator."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting to delete a query's shuffle files when it has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one is made only on a local master, where all tasks share the machine."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="sentimart-llm-")
    spark.conf.set("spark.checkpoint.dir", f"file://{made}")
    return f"file://{made}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet under the shared folder and read it back: later steps restart from these files."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    # The written files are what later steps read, so the write's shuffle files go at its end and not at some later
    # garbage collection of the driver.
    kept = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, kept)
    if not _written:
        atexit.register(_remove)
    _written.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for df in tables:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _remove() -> None:
    """At the driver's normal end the stored tables go; files left by a killed driver are the cluster's to expire."""
    for spark, path in _written:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the JVM may already be gone
            return
