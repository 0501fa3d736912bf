import random

from helioframe.llm import common


def brute(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(up) if root(x) != x}


def test_components_with_large_stars(spark):
    rng = random.Random(3)
    low = [(0, i) for i in range(1, 400)]
    high = [(9_999, i) for i in range(1_000, 1_500)]  # the centre is the largest
    chain = [(i, i + 1) for i in range(2_000, 2_060)]
    loose = [(rng.randrange(3_000, 6_000), rng.randrange(3_000, 6_000)) for _ in range(1_200)]
    edges = low + high + chain + loose + [(7, 7), (0, 1)]
    found = common.components(spark, spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == brute(edges)
    assert common.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


def test_scratch_tables_are_packed_tightly(spark):
    from helioframe.llm.common import Scratch
    scratch = Scratch(spark)
    kept = scratch.keep(spark.range(10).selectExpr("id", "repeat('word ', 50) AS text"), "texts")
    assert kept.count() == 10 and all(f.endswith(".zstd.parquet") for f in kept.inputFiles())
    scratch.drop(kept)
