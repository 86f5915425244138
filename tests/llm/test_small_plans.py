"""What keeps plans small and texts where they are: filters before joins, and components of few edges in one task."""

import random

import numpy as np
from pyspark.sql import functions as F

from chronopanel.llm import common, overlap
from chronopanel.llm.components import components


def test_among_keeps_all_that_are(spark):
    df = spark.range(-3000, 3000).withColumn("x", F.col("id") * 2).unionByName(spark.createDataFrame([(None, 1)], "id long, x long"))
    ids = spark.range(-3000, 3000, 10).select(F.col("id").alias("k"))
    got = [r["id"] for r in common.among(df, "id", ids, ids.count()).collect()]
    assert set(range(-3000, 3000, 10)) <= set(got) and len(got) == len(set(got)) < 900
    assert common.among(df, "id", ids.where("false"), 0).count() == 0
    assert common.among(df, "id", ids, ids.count()).columns == ["id", "x"]


def test_texts_without_a_partner_are_not_moved(spark):
    """The texts that reach the join with their clusters are those of clusters, whatever is broadcast."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(999)) for _ in range(40))) for i in range(200)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, real = [], overlap.among

    def spy(*args):
        out = real(*args)
        seen.append(out.count())
        return out

    overlap.among = spy
    try:
        sets, links = overlap.links(docs, "doc_id", "text", 5)
        sid = {r["id"]: r["sid"] for r in sets.collect()}
        got = {frozenset((r["a"], r["b"])) for r in links.collect()}
    finally:
        overlap.among = real
    assert got == {frozenset((sid[i], sid[1000 + i])) for i in range(5)}
    assert 10 <= seen[0] < 30


def test_components_of_few_edges_are_those_of_rounds(spark):
    rng = np.random.default_rng(9)
    ids = rng.integers(-(2**62), 2**62, 300)
    pairs = [(int(ids[i]), int(ids[i + 1])) for i in range(120)] + [(int(a), int(b)) for a, b in rng.choice(ids[130:], (80, 2))] + [(7, 7)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    once, rounds = ({r["node"]: r["root"] for r in components(edges, few=n).collect()} for n in (1 << 20, 0))
    assert once == rounds and len({once[int(i)] for i in ids[:121]}) == 1 and once[int(ids[0])] == int(ids[:121].min())
    assert components(edges.where("false")).count() == 0
