"""Sinks. Self-overwriting writes go to a new version beside the old one (``tables``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.functions.scalars import object_name
from loomwork.operators.routing import without_metadata
from loomwork.sources import tables

FORMATS = ("parquet", "json", "text", "avro")


def append(df: DataFrame, path: str, metadata: bool = False) -> None:
    (df if metadata else without_metadata(df)).write.mode("append").parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "append") -> None:
    """``append``, ``truncate`` or ``empty``; the last raises only if the place holds rows."""
    if mode == "empty" and _holds_rows(df.sparkSession, path):
        raise ValueError(f"{path} holds rows already")
    if mode not in ("append", "truncate", "empty"):
        raise ValueError(f"unknown disposition: {mode}")
    without_metadata(df).write.mode("append" if mode == "append" else "overwrite").parquet(path)


def _holds_rows(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return there and not spark.read.parquet(path).isEmpty()


def write_files(df: DataFrame, path: str, format: str = "parquet") -> None:
    if format not in FORMATS:
        raise ValueError(f"unknown format: {format}")
    df.write.format(format).save(path)


def as_messages(df: DataFrame) -> DataFrame:
    """(value): each row as a JSON message."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def publish(df: DataFrame, path: str) -> None:
    as_messages(df).write.mode("append").text(path)


def replaced(df: DataFrame, root: str, run: str, view: str | None = None, read: tables.Version | None = None) -> DataFrame:
    """``df``, which may read the table's present version, as the next version, read back; a named view is pointed at it
    last. Another writer's commit since ``read``, or since the call, raises."""
    spark = df.sparkSession
    new = tables.read(spark, root, tables.replace(df, root, run, read))
    if view:
        new.createOrReplaceTempView(view)
    return new


def current(spark: SparkSession, root: str) -> DataFrame:
    """The last version below ``root``, for any session: readers see the old one or the new one whole."""
    return tables.read(spark, root)


def write_rejects(rejects: DataFrame, path: str | None) -> None:
    """Rejected rows go to the error table if there is one."""
    if path:
        rejects.write.mode("append").parquet(path)


def lineage_rows(spark: SparkSession, path: str, process: str, run: str, target: str, format: str = "parquet", start: Column | None = None, end: Column | None = None) -> DataFrame:
    """(process, run, source_fqn, target_fqn, start_time, end_time) of a load: one row a source file, by file metadata
    alone where the times are not given."""
    read = spark.read.format(format).load(path).select("_metadata.file_path", "_metadata.file_modification_time")
    per = read.groupBy("file_path").agg(F.min("file_modification_time").alias("start"), F.max("file_modification_time").alias("end"))
    return per.select(F.lit(process).alias("process"), F.lit(run).alias("run"), object_name(F.col("file_path")).alias("source_fqn"), F.lit(f"table:{target}").alias("target_fqn"), (start if start is not None else F.col("start")).alias("start_time"), (end if end is not None else F.col("end")).alias("end_time"))


def bulk_load(spark: SparkSession, path: str, target: str, columns: Sequence[str] | None = None, format: str = "parquet", lineage: str | None = None, process: str = "bulk_load", run: str = "manual") -> DataFrame:
    """Files copied into a staging table and read back; lineage rows are appended to a table if one is named, and a
    failure to write them never fails the load."""
    df = spark.read.format(format).load(path)
    (df if columns is None else df.select(*columns)).write.mode("append").parquet(target)
    if lineage:
        try:
            lineage_rows(spark, path, process, run, target, format).write.mode("append").parquet(lineage)
        except Exception as e:  # noqa: BLE001
            print(f"lineage of {path} isn't written: {e}")
    return spark.read.parquet(target)
