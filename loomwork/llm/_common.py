"""What the training-data operators share: bounded Arrow batches, tables in the shared folder, byte-level words."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomwork.sources import workspace

#: Rows and bytes that one Arrow batch may carry to a Python worker.
BATCH_ROWS = 2_000
BATCH_BYTES = 16 << 20

#: ASCII separators of op5's words: every byte below 0x80 that is no digit or letter becomes a space, A-Z lower case.
WORD_TABLE = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


class Memo(dict):
    """Values that are worked out once for each key. Two generations of ``size`` keys are kept, so that common keys
    stay while memory is bounded."""

    def __init__(self, make: Callable, size: int = 200_000):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``). A local session without one, as in
    tests, gets a temporary folder; on a cluster that would be a folder of one machine, so there it raises."""
    return workspace.shared_folder(spark)


#: Spark drops a write's shuffle files at its end under this setting.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a Parquet table below the shared folder and read back: cuts the lineage, survives
    lost executors and stays small on disk. The table stays until the folder is cleared."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with _cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one operator, in a database of their own below the shared folder. They go when the
    block ends, so what the operator returns is written apart."""

    def __init__(self, spark: SparkSession):
        self.spark, self.name = spark, f"scratch_{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        self.spark.sql(f"CREATE DATABASE {self.name} LOCATION '{shared_folder(self.spark)}/{self.name}'")
        return self

    def __exit__(self, *_) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.name} CASCADE")

    def written(self, df: DataFrame, name: str) -> DataFrame:
        with _cleaned(self.spark):
            df.write.format("parquet").option("compression", "zstd").saveAsTable(f"{self.name}.{name}")
        return self.spark.table(f"{self.name}.{name}")

    def drop(self, *names: str) -> None:
        """Tables that are of no more use before the end."""
        for name in names:
            self.spark.sql(f"DROP TABLE {self.name}.{name}")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for texts of any length: at most BATCH_ROWS rows and about BATCH_BYTES. Spark reads
    these settings when a plan runs, which is later, so they stay with the session."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def in_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` under the batch bounds."""
    bounded_batches(df.sparkSession)
    return df.mapInArrow(work, schema)


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a text column, null as empty, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py() or b""


#: Bits of the maps that rows are screened by before they are dealt out. A map is broadcast as its rows of 64 bits that
#: aren't empty, so as one row for each key, and half a million at most.
MAP_BITS = 25


def _hashed(key: Column) -> Column:
    return F.xxhash64(key).bitwiseAND((1 << MAP_BITS) - 1)


def mapped(df: DataFrame, key: Column) -> DataFrame:
    """(word, map): a bit map of the hashes of ``key`` over the rows of ``df``. It lets every row in that has its key
    there, and some others: few up to two million keys, nearly all far beyond, where it only costs."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("h").bitwiseAND(63).cast("int"))
    words = df.select(_hashed(key).alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(F.bit_or(bit).alias("map"))
    return written(words, "bit-map")


def _probed(df: DataFrame, bit_map: DataFrame, key: Column, how: str) -> tuple[DataFrame, Column]:
    """``df`` with its word of the map, in columns of new names, and whether the key's bit is set there."""
    ours = "_" * (1 + max(map(len, df.columns)))
    h = _hashed(key)
    joined = df.join(F.broadcast(bit_map.toDF(f"{ours}w", f"{ours}m")), F.shiftright(h, 6) == F.col(f"{ours}w"), how)
    return joined, F.getbit(F.col(f"{ours}m"), h.bitwiseAND(63).cast("int")) == 1


def inside(df: DataFrame, bit_map: DataFrame, key: Column) -> DataFrame:
    """The rows whose key may be in the map: all that are, and few others."""
    joined, there = _probed(df, bit_map, key, "inner")
    return joined.where(there).select([F.col(f"`{c}`") for c in df.columns])


def outside(df: DataFrame, bit_map: DataFrame, key: Column) -> DataFrame:
    """The other rows: no key of theirs is in the map."""
    joined, there = _probed(df, bit_map, key, "left")
    return joined.where(~F.coalesce(there, F.lit(False))).select([F.col(f"`{c}`") for c in df.columns])


def placed(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` in the shared folder with each row's place in ``order``, from zero on. One sort over the cluster by ranges; a
    place is that in the row's range and the number of rows in the ranges before, so no task holds more than a range."""
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(sorted_.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}), "ranges")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = rows.groupBy("_part").agg(F.count("*").alias("_rows")).select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return rows.join(offsets, "_part").withColumn(name, F.col("_before") + F.col("_at")).drop("_part", "_at", "_before")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def renamed(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names, whatever else ``df`` carries."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def sha256_of(column: Column) -> Column:
    return F.sha2(column, 256)
