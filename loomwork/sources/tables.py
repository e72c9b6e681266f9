"""Tables with versions. A version is a small file that says where the table's rows lie; the next one is written beside it
and moved to its number, which fails if another writer was first. So readers of any session see the version before or the
one after, whole, whatever the names of runs, and of two writers that read the same version one raises ``Conflict``. This is
as safe as the file system's move that doesn't overwrite. Data files are never changed: a new version names old and new ones.
"""

from __future__ import annotations

import dataclasses
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from loomwork.operators.joins import backfill, upserted


class Conflict(RuntimeError):
    """Another writer has committed since the table was read."""


@dataclasses.dataclass(frozen=True)
class Version:
    """``number`` is 0 and ``entry`` empty before the first commit."""

    number: int
    entry: dict


def _versions(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/_versions")
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def latest(spark: SparkSession, root: str) -> Version:
    folder, fs = _versions(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return numbered(spark, root, max((int(n) for n in names if n.isdigit()), default=0))


def numbered(spark: SparkSession, root: str, number: int) -> Version:
    """A version by its number."""
    if not number:
        return Version(0, {})
    jvm = spark.sparkContext._jvm
    folder, fs = _versions(spark, root)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(folder, f"{number:020d}"))
    try:
        return Version(number, json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, read: Version, entry: dict) -> Version:
    """``entry`` as the version after ``read``."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    folder, fs = _versions(spark, root)
    number = read.number + 1
    draft, final = (jvm.org.apache.hadoop.fs.Path(folder, name) for name in (f".{uuid.uuid4().hex}", f"{number:020d}"))
    out = fs.create(draft, False)
    out.write(json.dumps(entry).encode())
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(draft, final, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Exception as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"{root}: version {number} was written by another") from None
        raise
    return Version(number, entry)


def _at(spark: SparkSession, entry: dict, paths: Sequence[str]) -> DataFrame:
    schema = StructType.fromJson(entry["schema"])
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _data(root: str) -> str:
    return f"{root}/data/{uuid.uuid4().hex}"


def read(spark: SparkSession, root: str, version: Version | None = None) -> DataFrame:
    """The rows of a version, the latest one by default."""
    version = version or latest(spark, root)
    if not version.number:
        raise ValueError(f"{root} has no finished version")
    return _at(spark, version.entry, [f["path"] for f in version.entry["files"]])


def replace(df: DataFrame, root: str, run: str, read: Version | None = None) -> Version:
    """``df``, which may read the table's present version, as the next one."""
    spark = df.sparkSession
    read = read or latest(spark, root)
    df.write.parquet(path := _data(root))
    return commit(spark, root, read, {"run": run, "schema": json.loads(df.schema.json()), "files": [{"path": path}]})


def replace_once(make: Callable[[], DataFrame], root: str, run: str, spark: SparkSession) -> Version:
    """The table as ``run`` made it: if the last version is that run's, nothing is made again."""
    now = latest(spark, root)
    return now if now.number and now.entry.get("run") == run else replace(make(), root, run, now)


def append_once(df: DataFrame, root: str, run: str) -> Version:
    """The table with the rows of ``df`` added, once a run."""
    spark = df.sparkSession
    now = latest(spark, root)
    files = now.entry.get("files", [])
    if any(f["run"] == run for f in files):
        return now
    df.write.parquet(path := _data(root))
    return commit(spark, root, now, {"schema": json.loads(df.schema.json()), "files": [*files, {"path": path, "run": run}]})


# --- upserts by buckets of the key's hash

BUCKETS = 64


def upsert(rows: DataFrame, root: str, key: str, order: Sequence[Column], source: str = "", batch: int = -1, buckets: int = BUCKETS) -> Version:
    """The table with ``rows`` put in, one row a key, the first in ``order`` and new ones before old on a tie. Only buckets
    that rows fall in are read and written; the other files stay as they are. A batch of a source that is in the table
    already changes nothing."""
    spark = rows.sparkSession
    now = latest(spark, root)
    done = now.entry.get("batches", {})
    if source and done.get(source, -1) >= batch:
        return now
    if now.number and (now.entry["key"] != key or StructType.fromJson(now.entry["schema"]).names != rows.columns):
        raise ValueError(f"{root} has another key or other columns")
    buckets = now.entry.get("buckets", buckets)
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    rows = rows.persist()
    try:
        touched = {r[0] for r in rows.select(bucket).distinct().collect()}
        if not touched:
            return now
        files = now.entry.get("files", [])
        entry = now.entry or {"schema": json.loads(rows.schema.json())}
        old = _at(spark, entry, [f["path"] for f in files if f["bucket"] in touched])
        path = _data(root)
        upserted(old, rows, key, *order).withColumn("_bucket", bucket).repartition("_bucket").write.partitionBy("_bucket").parquet(path)
    finally:
        rows.unpersist()
    kept = [f for f in files if f["bucket"] not in touched]
    new = [{"path": f"{path}/_bucket={b}", "bucket": b} for b in sorted(touched)]
    batches = done | {source: batch} if source else done
    return commit(spark, root, now, entry | {"key": key, "buckets": buckets, "batches": batches, "files": [*kept, *new]})


def upsert_stream(stream: DataFrame, root: str, key: str, order: Sequence[Column], source: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Each micro-batch upserted once, whatever is repeated."""
    work = lambda batch, batch_id: upsert(batch, root, key, order, source, batch_id)
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


# --- merges that leave files without a match alone


def _ranges(spark: SparkSession, schema: dict, path: str, key: str) -> list[dict]:
    """Each file with its rows and the lowest and highest key, as text."""
    df = spark.read.schema(StructType.fromJson(schema)).parquet(path)
    each = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("rows"), F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high"))
    return [r.asDict() for r in each.orderBy("path").collect()]


def cluster(df: DataFrame, root: str, key: str, files: int) -> Version:
    """``df`` as the table's next version, dealt out by ranges of the key, which the version notes for each file."""
    spark = df.sparkSession
    now = latest(spark, root)
    df.repartitionByRange(files, key).write.parquet(path := _data(root))
    schema = json.loads(df.schema.json())
    return commit(spark, root, now, {"schema": schema, "key": key, "files": _ranges(spark, schema, path, key)})


def _touched(spark: SparkSession, entry: dict, source: DataFrame) -> set[str]:
    """The files that hold a key of ``source``: of those whose range meets the source's, the ones whose keys do. Only the
    key column is read."""
    key, kind = entry["key"], StructType.fromJson(entry["schema"])[entry["key"]].dataType
    ranged = spark.createDataFrame([(f["path"], f["low"], f["high"]) for f in entry["files"]], "path string, low string, high string")
    ends = source.agg(F.min(key).alias("a"), F.max(key).alias("b"))
    near = ranged.join(F.broadcast(ends), (F.col("low").cast(kind) <= F.col("b")) & (F.col("high").cast(kind) >= F.col("a")))
    paths = [r[0] for r in near.select("path").collect()]
    if not paths:
        return set()
    keys = _at(spark, entry, paths).select(key, F.col("_metadata.file_path").alias("path"))
    return {r[0] for r in keys.join(source.select(key).distinct(), key, "left_semi").select("path").distinct().collect()}


def merge(root: str, source: DataFrame, columns: Sequence[tuple[str, str, str]], as_of: Column) -> tuple[Version, int]:
    """``joins.backfill`` on a clustered table, and the number of files written anew: those with a matched key. Without a
    match there is no new version."""
    spark = source.sparkSession
    now = latest(spark, root)
    key = now.entry["key"]
    touched = _touched(spark, now.entry, source)
    if not touched:
        return now, 0
    rows = _at(spark, now.entry, sorted(touched))
    merged = backfill(rows, source, columns, key, as_of)
    # a file's rows stay together
    names = StructType.fromJson(now.entry["schema"]).names
    merged.select(names).repartitionByRange(len(touched), key).write.parquet(path := _data(root))
    kept = [f for f in now.entry["files"] if f["path"] not in touched]
    return commit(spark, root, now, now.entry | {"files": [*kept, *_ranges(spark, now.entry["schema"], path, key)]}), len(touched)

