"""Hot keys, hubs and ranges against plain Python."""

import numpy as np
from conftest import rows
from pyspark.sql import functions as F

from adjudica.operators import components, scale


def test_skew_join(spark):
    many = spark.range(5000).select(F.when(F.col("id") < 4000, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("x"))
    facts = many.groupBy("k").agg(F.count("*").alias("n"), F.max("x").alias("top"))
    got = scale.skew_join(many, facts, "k", "n", 5000, "x")
    assert got.columns == ["k", "x", "top"] and got.count() == 5000 and got.filter("k = 1 and top <> 3999 or k > 1 and top <> x").count() == 0
    assert scale.skew_join(many.limit(0), facts.limit(0), "k", "n", 0, "x").count() == 0


def test_numbered(spark):
    df = spark.createDataFrame([(v,) for v in (5, None, 3, 3, 9)], "v int")
    assert sorted((r["at"], r["v"] or 0) for r in scale.numbered(df, ["v"], "at").collect()) == [(0, 0), (1, 3), (2, 3), (3, 5), (4, 9)]
    assert scale.numbered(df.limit(0), ["v"], "at").count() == 0


def test_components_with_a_hub(spark):
    random = np.random.default_rng(1)
    edges = [(0, k) for k in range(1, 1200)] + [tuple(int(v) for v in random.integers(1200, 3000, 2)) for _ in range(1500)]
    label = list(range(3000))

    def find(k):
        while label[k] != k:
            k = label[k]
        return k

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    nodes = {k for e in edges for k in e}
    got = rows(components.components(spark.createDataFrame(edges, "a int, b int")))
    assert got == sorted((k, find(k)) for k in nodes)
    assert components.components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_components_of_few_edges_take_no_rounds(spark, monkeypatch):
    random = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in random.permutation(400)[np.stack([np.arange(399), np.arange(1, 400)], 1)]] + [(500, 500), (602, 601)]
    df = spark.createDataFrame(edges, "a int, b int")
    spark.sparkContext.setJobGroup("few edges", "")
    got = rows(components.components(df))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few edges"))
    spark.sparkContext.setJobGroup("", "")
    assert jobs < 20  # rounds took more than a hundred
    assert got == [(k, 0) for k in range(400)] + [(500, 500), (601, 601), (602, 601)]
    named = df.select(F.unhex(F.lpad(F.hex("a"), 8, "0")).alias("a"), F.unhex(F.lpad(F.hex("b"), 8, "0")).alias("b"))
    number = lambda c: F.conv(F.hex(c), 16, 10).cast("int").alias(c)
    assert rows(components.components(named).select(number("node"), number("label"))) == got
    monkeypatch.setattr(components, "FEW", 0)
    assert rows(components.components(df)) == got
