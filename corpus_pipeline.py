"""Corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing to target weights, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next stage's
`docs`. All but the last return the columns of `documents`. Every stage works on all rows that it gets, and its
decisions take effect. Null and empty texts: language ID rejects them (no letter). Rows with a null id are documents of their own: they are
kept by the near-dedup stage, which goes by ids, and treated like others by all other stages; rows that share an id are kept or
dropped by it together, by their texts elsewhere. An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronopanel import ship
from chronopanel.llm import exact_dedup, language, mixing, packing, simhash
from chronopanel.llm.common import documents, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document is rejected if it has no letter, or if its language is as uncertain as this.
LEAST_CERTAIN = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is recognised; one without a language gets the recognised one."""
    ship(spark)
    docs = docs.select(*COLUMNS)
    model = language.fit(docs)
    found = language.predict(docs, model, names=("__lang", "__sure"), keep=True)
    return found.where((F.col("__lang") != language.UNKNOWN) & (F.col("__sure") >= LEAST_CERTAIN)).select(
        *[F.coalesce("lang", "__lang").alias("lang") if c == "lang" else F.col(c) for c in COLUMNS]
    )


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest id of each group of equal texts."""
    ship(spark)
    return exact_dedup.keep_first(docs.select(*COLUMNS))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the one with the smallest id."""
    ship(spark)
    return simhash.keep_first(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix to the target weights takes it (0 to 3 times). Rows are told apart by a number of their own, so null
    and repeated ids are taken like any other."""
    ship(spark)
    rows = written(docs.select(*COLUMNS).withColumn("__row", F.monotonically_increasing_id()), "mix-rows")
    plan = mixing.mix(rows.select("__row", "doc_id", "text", "source"), mixing.word_count(), carry=["__row"])
    plan = plan.where("copies > 0").select("__row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("__copy"))
    return rows.join(plan, "__row").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    ship(spark)
    return packing.pack(docs.select("doc_id", "text"), packing.default_vocabulary())


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("packing", pack)]
#: The network's decisions cannot be said in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
