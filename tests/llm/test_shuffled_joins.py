"""Tables whose size Spark sets too low are not broadcast: results of an explode or a Python step."""

from pyspark.sql import functions as F

from chronopanel.llm import overlap, simhash


def plans_of_edges(spark, monkeypatch, module, make):
    """Plans of the edges that reach `components` in a module."""
    seen, real = [], module.components

    def spy(edges):
        seen.append(edges._jdf.queryExecution().executedPlan().toString())
        return real(edges)

    monkeypatch.setattr(module, "components", spy)
    make()
    return seen


def test_dealt_fingerprints_are_not_broadcast(spark, monkeypatch):
    """Every fingerprint is dealt to 28 places, and the table of places, the other side, is larger than Spark takes that to be."""
    rows = spark.range(300).select((F.col("id") * 3).alias("fp"), F.col("id").alias("rep"))
    plan = plans_of_edges(spark, monkeypatch, simhash, lambda: simhash.link_groups(rows, most=6, segments=8))[0]
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_exploded_bands_are_not_broadcast(spark, monkeypatch):
    docs = spark.range(30).select(F.col("id").alias("doc_id"), F.concat(F.lit("one two three four five six seven eight nine ten "), F.col("id") % 15).alias("text"))
    plan = plans_of_edges(spark, monkeypatch, overlap, lambda: overlap.links(docs, "doc_id", "text", 5))[0]
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
