"""Readers and writers: typed files, case-insensitive columns, archives, pages, tables and views."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import no_nan


def parquet(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """A table of the data folder; columns and filters reach the scan. Time stamps without zone stay so."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if where:
        df = df.where(where)
    return df.select(*columns) if columns else df


def clean(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating column, once, where data comes in."""
    return df.select(*[no_nan(c).alias(c) if k in ("double", "float") else F.col(c) for c, k in df.dtypes])


def csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, **options) -> DataFrame:
    """A CSV file or folder, typed by a schema (inferred only without one). Files are split, so no chunks are needed."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").options(**options)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def pick(df: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """The first present spelling of each wanted column, in any case; NULL if there is none."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for name, spellings in wanted.items():
        hit = next((have[s.lower()] for s in spellings if s.lower() in have), None)
        out.append(F.col(f"`{hit}`").alias(name) if hit else F.lit(None).cast("string").alias(name))
    return df.select(*out)


def has_columns(df: DataFrame, *columns: str) -> bool:
    return set(columns) <= set(df.columns)


def labelled_files(spark: SparkSession, pattern: str) -> DataFrame:
    """A folder with one parquet file for each label, the label being the file's name."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)\.[^.]*$", 1)
    return spark.read.parquet(pattern).withColumn("label", name)


def zipped_csv(spark: SparkSession, path: str, member: str, schema: str) -> DataFrame:
    """One CSV member of zip archives. An archive cannot be split: one task for each."""

    def lines(batches):
        import pyarrow as pa

        for batch in batches:
            for body in batch.column(0).to_pylist():
                with zipfile.ZipFile(io.BytesIO(body)) as z, z.open(member) as f:
                    rows = f.read().decode("utf-8").splitlines()[1:]
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], names=["line"])

    text = spark.read.format("binaryFile").load(path).select("content").mapInArrow(lines, "line string")
    return text.select(F.from_csv("line", schema).alias("r")).select("r.*")


def html_tables(pages: DataFrame, html_col: str, keys: list[str]) -> DataFrame:
    """Cells of all tables of pages: keys, table, row, col, text. Built-in expressions only."""
    cut = lambda c, tag: F.regexp_extract_all(c, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))
    t = pages.select(*keys, F.posexplode(cut(F.col(html_col), "table")).alias("table", "__t"))
    r = t.select(*keys, "table", F.posexplode(cut(F.col("__t"), "tr")).alias("row", "__r"))
    c = r.select(*keys, "table", "row", F.posexplode(cut(F.regexp_replace(F.col("__r"), r"(?i)(</?)th\b", "$1td"), "td")).alias("col", "__c"))
    from ..functions.text import plain_text

    return c.select(*keys, "table", "row", "col", plain_text("__c").alias("text"))


def write_prices(df: DataFrame, path: str, by: str = "ticker", then: str = "date") -> None:
    """Parquet with zstd, sorted within files, small row groups: a reader of one label skips the rest."""
    (
        df.repartitionByRange(by).sortWithinPartitions(by, then)
        .write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", 8 << 20).parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `old` whose key is not in `new`, and all of `new`."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def register(spark: SparkSession, **views: DataFrame) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
