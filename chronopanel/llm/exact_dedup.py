"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

A first scan counts groups of (length, prefix hash) with map-side combination, so no row of a
document is moved. Only groups of two or more survive, and only their rows get the full SHA-256 of
the content. Groups of equal rows are aggregated before any shuffle; the answer is joined back on the
group's key, which adaptive execution splits when one group holds a large share of the rows.

Defined results: a null text counts as empty, and all empty texts are one group; repeated rows are
counted each and `kept` marks the rows that carry the smallest id; a null id never is the smallest
unless all ids of the group are null (then keep_id is null and the rows are kept); an empty table
gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE_RUN, documents, written

#: Survivor keys are broadcast up to this many rows (about 24 bytes each); beyond it they are joined by shuffle.
BROADCAST_KEYS = 250_000


def normalised(text: Column | str = "text") -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def exact_groups(
    docs: DataFrame,
    content: Column,
    id_col: str = "doc_id",
    prefix: int = 64,
    carry: dict[str, Column] | None = None,
    group_key: bool = False,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, and the carried columns.

    `content` is what must be equal; `prefix` code points of it feed the second level. With `group_key` also __len and __full, the length and the
    full hash, which is NULL where length or prefix tell a row apart from all others.
    """
    spark = docs.sparkSession
    carry = carry or {}
    keyed = docs.withColumn("__content", content).select(
        F.col(id_col).alias("__id"),
        "__content",
        F.octet_length("__content").alias("__len"),
        *[c.alias(n) for n, c in carry.items()],
    )
    lengths = keyed.select("__len", F.xxhash64(F.substring("__content", 1, prefix)).alias("__prefix"))
    cells = lengths.groupBy("__len", "__prefix").agg(F.count("*").alias("__n"))
    survivors = written(
        cells.where("__n > 1").select("__len", F.col("__prefix"), F.lit(True).alias("__again")), "exact-cells"
    )
    side = F.broadcast(survivors) if survivors.count() <= BROADCAST_KEYS else survivors
    deep = (
        keyed.withColumn("__prefix", F.xxhash64(F.substring("__content", 1, prefix)))
        .join(side, ["__len", "__prefix"], "left")
        .withColumn("__full", F.when(F.col("__again"), F.unhex(F.sha2("__content", 256))))
        .drop("__content", "__again")
    )
    deep = written(deep, "exact-rows")
    groups = (
        deep.where("__full IS NOT NULL")
        .groupBy("__len", "__full")
        .agg(F.min("__id").alias("__keep"), F.count("*").alias("__size"))
        .where("__size > 1")
    )
    keep = F.when(F.col("__size").isNull(), F.col("__id")).otherwise(F.col("__keep"))
    return deep.join(groups, ["__len", "__full"], "left").select(
        F.col("__id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("__id").eqNullSafe(keep), F.lit(False)).alias("kept"),
        *carry,
        *(["__len", "__full"] if group_key else []),
    )


def keep_first(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of `docs` without those whose text an earlier id has; a row that occurs several times (id and text)
    stays once. All columns are kept."""
    row = "__row"
    while row in docs.columns:
        row += "_"
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "exact-texts")
    marks = exact_groups(rows, normalised(text_col), id_col, carry={row: F.col(row)}, group_key=True).where("kept")
    # a group's first id may have several rows of the text: one of them stays
    first = marks.where("__full IS NOT NULL").groupBy(id_col, "__len", "__full").agg(F.min(row).alias(row))
    stay = marks.where("__full IS NULL").select(row).unionByName(first.select(row))
    return rows.join(stay, row, "left_semi").drop(row).select(*docs.columns)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text")
    return exact_groups(docs, normalised(), carry={"text_sha256": F.sha2(F.col("__content"), 256)})


SQL = {
    "op4_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM n)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       CAST(count(*) OVER (PARTITION BY text_sha256) AS BIGINT) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM h
"""
}
QUERIES = {"op4_exact_dedup": op4_exact_dedup}
