"""Session settings the library expects, and the few values it reads back from a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(app: str = "voxloom", cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, pass your own session instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    width = 8 if cores == "*" else int(cores)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(width))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Where none is set, a local session gets a temporary one; on a cluster that is an error, since a folder of
    one machine would lose rows.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="voxloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """Even out rows before work whose cost goes far beyond their bytes.

    Scan and join partitions are sized by bytes, and one file or one hot key may fill one of them. Adaptive
    execution cuts the moved rows into parts of the advisory size, as many as the data ask for.
    """
    return df.hint("rebalance")


def settle(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back, so that several consumers share the work and no lost task repeats it."""
    path = f"{shared_folder(df.sparkSession)}/voxloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
