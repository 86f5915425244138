"""Mixing sources to target weights by entropy balancing.

Every document gets a rate: one is its own share, two is two copies. The rates minimise the
size-weighted relative entropy to the corpus under token constraints, one for each source and one for each class of any further column
(languages, length classes), with an upper bound on a rate. The convex dual has one multiplier per source or class, and a document's rate is
min(bound, exp(sum of its multipliers)). Newton steps solve it: each is one distributed aggregation of the tilted sizes of all
documents, and of their slopes (the tilted sizes below the bound), by source and classes. From these cells come the gradient and the
Hessian; sources are eliminated from it first, as a document has one source, so that a dense system remains for the classes only. A step that lowers the dual
is halved. Sums are taken over decimals, so reruns agree to the last bit.

Rates become copies by one pass: every document is taken floor(rate) times, and the fraction is made
up from whole documents in the order of the MD5 of their id, as long as the middle of a document's
span of words lies below the missing words. The error of a source is at most half a document.
Running sums are taken in hash buckets of a bounded number of rows and joined by the buckets'
offsets, so a source with a third of all rows is no single task.

Defined results: a null text has size 0, is in its source's group and is taken 0 words; null sources are one source,
last in the order; sources without words have target 0; repeated rows are separate documents that share
their order key; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, documents, written

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3.0
#: Sources (and classes of further columns) come to the driver, so their numbers have bounds; more raise an error.
MAX_SOURCES = 200_000
MAX_CLASSES = 2_000
MAX_CELLS = 2_000_000
BUCKET_ROWS = 4_000
NEWTON_STEPS = 100
CLOSE = 1e-11


def word_count(text: Column | str = "text") -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: list[tuple[str | None, int]], weights=WEIGHTS, most: float = MOST) -> dict[str | None, float]:
    """Shares of all words by repeating weights; what a source cannot take is shared again."""
    order = sorted((s for s, _ in totals if s is not None)) + [s for s, _ in totals if s is None]
    size, weight = dict(totals), {s: weights[i % len(weights)] for i, s in enumerate(order)}
    # sources reach their bound in the order of size by weight; once one does not, none after it does
    ranked = sorted(range(len(order)), key=lambda i: (size[order[i]] / weight[order[i]], i))
    left, open_, out = sum(size.values()), sum(weight.values()), {}
    for k, i in enumerate(ranked):
        s = order[i]
        if weight[s] * left <= most * size[s] * open_:
            return out | {order[j]: weight[order[j]] * left / open_ for j in ranked[k:]}
        out[s] = most * size[s]
        left -= out[s]
        open_ -= weight[s]
    return out


def _cells(rows: DataFrame, keys: list[str], lam: list[dict], most: float) -> list[tuple]:
    """One Newton step's sums over all documents: (classes, tilted size, slope) by source and classes."""
    spark = rows.sparkSession
    tilt = F.lit(0.0)
    for k, (key, values) in enumerate(zip(keys, lam, strict=True)):
        kind = rows.schema[key].dataType.simpleString()
        table = spark.createDataFrame([(v, float(x)) for v, x in values.items()], f"__v{k} {kind}, __lam{k} double")
        rows = rows.join(F.broadcast(table), F.col(key).eqNullSafe(F.col(f"__v{k}")))  # bounded by MAX_SOURCES and MAX_CLASSES
        tilt = tilt + F.col(f"__lam{k}")
    rate = F.least(F.lit(most), F.exp(tilt))
    rows = rows.select(*keys, (F.col("size") * rate).cast("decimal(32,12)").alias("__tilted"), (tilt <= math.log(most) + 1e-12).alias("__free"))
    sums = rows.groupBy(*keys).agg(F.sum("__tilted").alias("t"), F.sum(F.when(F.col("__free"), F.col("__tilted"))).alias("f")).take(MAX_CELLS + 1)
    if len(sums) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} combinations of sources and classes")
    return [(*r[: len(keys)], float(r["t"] or 0), float(r["f"] or 0)) for r in sums]


def balance(rows: DataFrame, keys: list[str], goals: list[dict], most: float = MOST, steps: int = NEWTON_STEPS) -> list[dict]:
    """Multipliers of the dual, for each key the multiplier of each of its values. `rows` has `size` and the keys; goals are the
    words that each value is to have. The first key is the sources. Goals of zero switch a value off."""
    at = [{v: i for i, v in enumerate(g)} for g in goals]
    ends, bound = np.cumsum([0, *map(len, goals)]), math.log(most)
    goal = np.concatenate([np.fromiter(g.values(), float, len(g)) for g in goals])
    off = goal <= 0
    x, step, best = np.where(off, -700.0, 0.0), None, -np.inf
    for _ in range(steps):
        lam = [dict(zip(g, x[a:b], strict=True)) for g, a, b in zip(goals, ends, ends[1:], strict=False)]
        cells = _cells(rows, keys, lam, most)
        if not cells:
            return lam
        where = np.array([[ends[k] + at[k][c[k]] for k in range(len(keys))] for c in cells])
        mass, slope = (np.array([c[-j] for c in cells]) for j in (2, 1))
        have = np.zeros(len(goal))
        for k in range(len(keys)):
            np.add.at(have, where[:, k], mass)
        gap = np.where(off, 0.0, goal - have)
        worst = float(np.max(np.abs(gap) / np.maximum(goal, 1.0)))
        if worst < CLOSE:
            return lam
        # the dual is concave: its value tells whether a step went too far
        tilt = x[where].sum(axis=1)
        value = float((goal * np.where(off, 0.0, x)).sum() - (mass * (1 + np.maximum(0.0, tilt - bound))).sum())
        if step is not None and value < best - 1e-12 * abs(best):
            step = step / 2
            x = np.where(off, x, x - step)
            continue
        best = value
        # Hessian: diagonal for sources, dense for the classes beside them
        n = ends[1]
        diag = np.zeros(n)
        np.add.at(diag, where[:, 0], slope)
        diag = np.maximum(diag, 1e-9 * np.maximum(goal[:n], 1.0))
        step = gap / np.concatenate([diag, np.ones(len(goal) - n)])
        if len(keys) > 1:
            m = len(goal) - n
            dense, cross = np.zeros((m, m)), np.zeros((m, n))
            for a in range(1, len(keys)):
                np.add.at(cross, (where[:, a] - n, where[:, 0]), slope)
                for b in range(1, len(keys)):
                    np.add.at(dense, (where[:, a] - n, where[:, b] - n), slope)
            schur = dense - (cross / diag) @ cross.T
            part = np.linalg.lstsq(schur + 1e-12 * np.eye(m) * max(1.0, np.trace(dense)), gap[n:] - (cross / diag) @ gap[:n], rcond=1e-13)[0]
            step = np.concatenate([(gap[:n] - part @ cross) / diag, part])
        to = np.where(off, x, x + np.clip(step, -5.0, 5.0))
        for k in range(len(keys)):
            # a multiplier above which all its documents are at the bound changes nothing: it stops there
            rest = to[where].sum(axis=1) - to[where[:, k]]
            most_of = np.full(len(goal), -np.inf)
            np.maximum.at(most_of, where[:, k], bound - rest)
            to = np.where(np.isfinite(most_of) & ~off, np.minimum(to, most_of), to)
        step, x = to - x, to
    raise RuntimeError("the multipliers did not settle: the constraints cannot be met together")


def mix(
    docs: DataFrame,
    size: Column,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights=WEIGHTS,
    most: float = MOST,
    carry: list[str] = (),
) -> DataFrame:
    """One row per input row: id, the carried columns, source, size, source_size, target, rate, copies, taken."""
    spark = docs.sparkSession
    rows = written(docs.select(F.col(id_col), *carry, F.col(source_col).alias("source"), size.alias("size")), "mix-sizes")
    totals = rows.groupBy("source").agg(F.sum("size").alias("s"), F.count("*").alias("n")).take(MAX_SOURCES + 1)
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    goal = targets([(r["source"], int(r["s"])) for r in totals], weights, most)
    lam = balance(rows.select("source", "size"), ["source"], [goal], most)[0]
    plan = []
    for r in totals:
        s, total = r["source"], int(r["s"])
        rate = min(most, math.exp(lam[s])) if total and goal[s] else 0.0
        whole = math.floor(rate + 1e-9)
        missing = max(0.0, goal[s] - whole * total)
        plan.append((s, total, float(goal[s]), rate, whole, missing, max(1, int(r["n"]) // BUCKET_ROWS)))
    schema = "source string, source_size long, target double, rate double, whole long, missing double, buckets int"
    table = spark.createDataFrame(plan, schema)
    order = F.md5(F.col(id_col).cast("string").cast("binary"))
    spread = (
        rows.join(F.broadcast(table), rows.source.eqNullSafe(table.source), "inner")
        .drop(table.source)
        .withColumn("__key", F.coalesce(order, F.lit("")))
        .withColumn("__bucket", F.floor(F.conv(F.substring("__key", 1, 8), 16, 10).cast("long") * F.col("buckets") / F.lit(4294967296)))
        .withColumn("__bucket", F.coalesce("__bucket", F.lit(0)).cast("long"))
    )
    sums = spread.groupBy("source", "__bucket").agg(F.sum("size").alias("__sum"))
    ahead = W.partitionBy("source").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("source").alias("__source"), F.col("__bucket").alias("__b"), F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__before")
    )
    within = W.partitionBy("source", "__bucket").orderBy("__key", "size", *carry).rowsBetween(W.unboundedPreceding, 0)
    placed = (
        spread.withColumn("__upto", F.sum("size").over(within))
        .join(offsets, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__bucket") == F.col("__b")), "left")
        .withColumn("__middle", F.col("__before") + F.col("__upto") - F.col("size") / F.lit(2.0))
    )
    copies = F.col("whole") + F.when(F.col("__middle") < F.col("missing"), 1).otherwise(0)
    return placed.select(
        id_col, *carry, "source", "size", "source_size", "target", "rate", copies.cast("long").alias("copies"),
        (copies * F.col("size")).cast("long").alias("taken"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "source")
    target = F.floor(F.col("target") * 1e4 + 0.5) / 1e4
    return mix(docs, word_count()).select("doc_id", "size", "source_size", target.alias("target"), "taken", "copies")


QUERIES = {"op7_mixing": op7_mixing}
SQL = {
    "op7_mixing": r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS DOUBLE) AS w
  FROM d GROUP BY source
), k AS (
  SELECT *, row_number() OVER (ORDER BY 3 * total / w, source NULLS LAST) AS j,
    sum(total) OVER () - coalesce(sum(3 * total) OVER (ORDER BY 3 * total / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remains,
    sum(w) OVER (ORDER BY 3 * total / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w
  FROM s
), u AS (SELECT min_by(remains / open_w, j) AS unit FROM k WHERE remains / open_w <= 3 * total / w),
t AS (
  SELECT source, total, least(CAST(3 * total AS DOUBLE), CAST(w * coalesce((SELECT unit FROM u), 1e300) AS DOUBLE)) AS target FROM s
), p AS (
  SELECT d.doc_id, d.size, t.total, t.target,
    CASE WHEN t.total > 0 THEN floor(t.target / t.total + CAST(1e-9 AS DOUBLE)) ELSE 0 END AS whole,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size / CAST(2 AS DOUBLE) AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), c AS (SELECT *, CAST(whole + CASE WHEN middle < greatest(CAST(0 AS DOUBLE), target - whole * total) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, total AS source_size, floor(target * CAST(1e4 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1e4 AS DOUBLE) AS target,
  CAST(copies * size AS BIGINT) AS taken, copies
FROM c
"""
}
