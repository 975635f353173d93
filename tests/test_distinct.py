"""Distinct counts from bitmaps, merged over parts and grains."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from martloom.operators.distinct import bitmaps, distinct_counts, merged
from tests.samples import bag, plan


def test_bitmaps_count_like_distinct_counts(spark):
    draw = random.Random(6)
    ids = [None, 0, 1, 32767, 32768, 32769, 65536, 1 << 40, -1, -40000]
    rows = [(draw.choice("ab"), draw.randrange(3), draw.choice(ids), draw.randrange(90000)) for _ in range(3000)] + [(None, 1, 5, None)]
    df = spark.createDataFrame(rows, "place string, month int, x bigint, y int")
    state = bitmaps(df, ["place", "month"], ["x", "y"])
    direct = [F.count_distinct(c).alias(f"n_{c}") for c in "xy"]
    got = distinct_counts(state, ["place", "month"], n_x="x", n_y="y")
    assert bag(got) == bag(df.groupBy("place", "month").agg(*direct))
    assert bag(distinct_counts(merged(state, ["place"]), ["place"], n_x="x", n_y="y")) == bag(df.groupBy("place").agg(*direct))
    # States of parts of the rows, put together.
    early, late = (bitmaps(df.where(c), ["place", "month"], ["x", "y"]) for c in ("y % 2 = 0", "y % 2 = 1 OR y IS NULL"))
    both = merged(early.unionByName(late), ["place", "month"])
    assert bag(distinct_counts(both, ["place", "month"], n_x="x", n_y="y")) == bag(got)
    assert "partial_bitmap_construct_agg" in plan(state)
    assert bitmaps(df.where("false"), ["place"], ["x"]).collect() == []


def test_sparse_ids_take_little(spark):
    """Ids that lie apart: a state of 32 bytes each, and no 4 KB bitmaps in a shuffle or a sort."""
    df = spark.range(50).selectExpr("CAST(id % 2 AS STRING) AS place", "id * 100000 AS n")
    state = bitmaps(df, ["place"], ["n"])
    assert {len(r["bits"]) for r in state.collect()} == {32}
    for found in (bitmaps(df, ["place"], ["n"]), merged(bitmaps(df, ["place"], ["n"]), ["place"])):
        # Of the aggregates only the one that finds each id once sends its rows on.
        assert plan(found).count("ENSURE_REQUIREMENTS") == 1
    assert bag(distinct_counts(state, ["place"], n="n")) == bag(df.groupBy("place").agg(F.count_distinct("n").alias("n")))
