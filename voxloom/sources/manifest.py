"""Reading manifests, tables and file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import py_round
from ..functions.paths import local_path
from ..operators.existence import check_exists
from ..schemas import MANIFEST, TSV

CORRUPT = "_corrupt_record"


def file_order() -> Column:
    """Place of a row in its input: file, split of the file, running number inside the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def number_rows(df: DataFrame, place: str = "place", name: str = "row_id") -> DataFrame:
    """Turn places into 0, 1, 2, … in file order.

    Rows are numbered inside their file split, which is bounded by ``spark.sql.files.maxPartitionBytes``;
    only one row per split goes into the running total that shifts them.
    """
    split = [F.col(f"{place}.file").alias("_file"), F.col(f"{place}.block").alias("_block")]
    placed = df.select("*", *split, F.col(f"{place}.line").alias("_line"))
    sizes = placed.groupBy("_file", "_block").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("_file", "_block").orderBy("_line")
    numbered = placed.withColumn("_at", F.row_number().over(inside)).join(shifts, ["_file", "_block"])
    return numbered.withColumn(name, F.col("_before") + F.col("_at") - 1).select(*df.columns, name)


def read_manifest(
    spark: SparkSession, path: str | list[str], schema: T.StructType = MANIFEST, row_id: bool = False
) -> DataFrame:
    """JSON-lines manifest with a declared schema.

    Lines that do not parse keep their text in ``_corrupt_record``. An input field ``row_id`` may be part of
    ``schema``; with ``row_id=True`` rows are numbered in file order instead.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = spark.read.schema(full).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    if not row_id:
        return df
    return number_rows(df.select("*", file_order().alias("place"))).drop("place")


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = TSV) -> DataFrame:
    """Tab-separated table with a header; columns are matched by name through the header."""
    header = spark.read.csv(path, sep="\t", header=True, escape='"')
    return header.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields], file_order().alias("place"))


def list_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """Path, length and time of the files below a folder; their bytes are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    files = reader.option("recursiveFileLookup", str(recursive).lower()).load(path)
    return files.select(local_path(F.col("path")).alias("path"), "length", "modificationTime")


def read_splits(spark: SparkSession, path: str, schema: T.StructType = MANIFEST) -> DataFrame:
    """Named splits of one folder laid out as ``split=train`` and so on; a filter on ``split`` prunes folders."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("split", T.StringType())])).json(path)


def preflight(split_files: DataFrame, manifest: DataFrame, listing: DataFrame, least: int = 2) -> DataFrame:
    """One row telling whether training can start: enough split files and no audio file missing."""
    missing = check_exists(manifest, listing).rejects.agg(F.count("*")).scalar()
    return split_files.agg(F.count("*").alias("n_files"), missing.alias("n_missing")).withColumn(
        "ready", (F.col("n_files") >= least) & (F.col("n_missing") == 0)
    )


def rounded_manifest(df: DataFrame) -> DataFrame:
    """Times with two decimals, as manifests store them."""
    times = [c for c in ("start_time", "duration") if c in df.columns]
    return df.withColumns({c: py_round(F.col(c), 2) for c in times})
