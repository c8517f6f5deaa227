"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_session(cpus: int | str = 8, app: str = "textloom", memory: str = "16g") -> SparkSession:
    """A local session for tests and timings, with scratch tables in the temporary folder.

    On a cluster use the session you are given.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", f"{tempfile.gettempdir()}/textloom-scratch")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else a folder below the warehouse.

    Executors can be lost at any time, so everything that cuts lineage is written here and read
    back as a table. On a cluster both settings name folders that all executors share.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the scratch root that no other run uses."""
    return f"{scratch_root(spark)}/textloom/{label}-{uuid.uuid4().hex}"


def write_and_read(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of ``df``: write it once to the shared folder and read it back."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return read_table(spark, path, df.schema)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a superseded scratch table (never anything outside the scratch root)."""
    if not path.startswith(f"{scratch_root(spark)}/textloom/"):
        raise ValueError(f"not a scratch table: {path}")
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)
