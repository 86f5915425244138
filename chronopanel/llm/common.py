"""Helpers that the corpus operators share."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that the contracts name.
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
FOLDS = 5


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where none is named and both are one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="chronopanel-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def _remove(jvm, conf, path: str) -> None:
    try:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    except Exception:  # the gateway is already gone when Python ends first
        return


class _Tables:
    """Paths written by this process, removed at its end."""

    paths: list[tuple[weakref.ref, str]] = []

    @classmethod
    def clear(cls) -> None:
        for ref, path in cls.paths:
            if (spark := ref()) is not None and spark.sparkContext._jsc is not None:
                _remove(spark._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path)
        cls.paths.clear()


atexit.register(_Tables.clear)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage: the rows as a Parquet table in the shared folder, which outlives any executor."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = f"{shared_dir(spark)}/chronopanel-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _Tables.paths.append((weakref.ref(spark), path))
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    bounded_batches(spark)
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*columns) if columns else df


def shuffled(df: DataFrame) -> DataFrame:
    """For a join: neither side is broadcast. Spark takes the result of an explode or a Python step to be as large as what goes in, so a table many times
    as large could be sent to the driver."""
    return df.hint("merge")


#: Bits of a filter at most: 8 MB.
FILTER_BITS = 1 << 26


def among(df: DataFrame, key: str, ids: DataFrame, n: int) -> DataFrame:
    """The rows of `df` whose key may be one of `ids` (one column, n rows): all that are, and few others. A bitmap of hashed ids, bounded whatever
    their number, is broadcast, so rows of no use are gone before a join moves them."""
    bits = min(FILTER_BITS, 1 << max(15, (32 * n).bit_length()))
    at = lambda c: F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(bits))
    place = at(ids.columns[0])
    maps = ids.groupBy(F.shiftright(place, 15).alias("__bucket")).agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(32767))).alias("__bits"))
    spot = F.col("__at").bitwiseAND(F.lit(32767))
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(spot, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.getbit(byte, spot.bitwiseAND(F.lit(7)).cast("int")) == 1
    held = df.withColumn("__at", at(key)).withColumn("__bucket", F.shiftright("__at", 15))
    return held.join(F.broadcast(maps), "__bucket").where(hit).select(*df.columns)


def fold(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id as text, mod 5: the held-out rule of the contracts."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % FOLDS


def parts(spark: SparkSession, least: int = 2) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Arrow batches of texts go to Python workers in pieces of this size at most, unless the session asks for smaller ones.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds what a task holds between JVM and Python, whatever the length of the texts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key, None)
    if now is None or not now.rstrip("bB").isdigit() or int(now.rstrip("bB")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def release() -> None:
    """Gives freed memory of a worker back to the system: other processes share an executor's limit."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches, rows: int = 256):
    """Arrow batches in pieces of a few rows, so that a worker holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    release()


os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
