"""Session settings and the shared scratch folder."""

from __future__ import annotations

import io
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, name: str = "candlewick") -> SparkSession:
    """A local session for tests and benches; clusters bring their own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # call-site capture costs a stack walk per column expression
        .config("spark.sql.dataFrameQueryContext.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster. Only a local session gets a temporary one where none is named."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder: executors of {master} don't share local ones")
        root = tempfile.mkdtemp(prefix="candlewick-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """One folder per application, so all of its intermediate tables can be removed together."""
    return f"{scratch_root(spark)}/candlewick-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; call it once their results are stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, by way of the shared folder."""
    context = spark.sparkContext
    if getattr(context, "candlewick_shipped", False):
        return
    root, data = Path(__file__).parent, io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    path = scratch_path(spark, "code") + ".zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data.getvalue()))
    out.close()
    context.addPyFile(path)
    context.candlewick_shipped = True


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back: a lineage cut that survives executor loss."""
    path = scratch_path(df.sparkSession, label)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
