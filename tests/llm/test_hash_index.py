"""The extendible-hash index decides where texts meet and where documents look them up."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martloom.llm import exact_dedup


@pytest.fixture(scope="module")
def copies(spark):
    rows = [(k, f"text {k % 300}" + " " * (k % 3)) for k in range(900)] + [(k, "hot text") for k in range(900, 1400)] + [(None, None), (2000, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_result_does_not_depend_on_the_size_of_buckets(copies):
    found = [Counter(tuple(r) for r in exact_dedup.exact_duplicates(copies, capacity=c).collect()) for c in (8, 64, 1 << 16)]
    assert found[0] == found[1] == found[2] and found[0].total() == 1402
    sizes = {r[4]: r[2] for r in found[0]}
    assert sizes[hashlib.sha256(b"hottext").hexdigest()] == 500 and sizes[hashlib.sha256(b"").hexdigest()] == 2


def test_every_text_goes_through_the_directory(copies, monkeypatch):
    """Without one of its buckets, the documents of that bucket are lost: nothing finds them in another way."""
    whole, lost = exact_dedup.directory, {}

    def short(keys, capacity):
        buckets = whole(keys, capacity)
        gone = buckets.orderBy("depth", "bucket").first()
        lost.update(gone.asDict())
        return buckets.where((F.col("depth") != gone["depth"]) | (F.col("bucket") != gone["bucket"]))

    everything = {r["text_sha256"] for r in exact_dedup.exact_duplicates(copies, capacity=16).collect()}
    monkeypatch.setattr(exact_dedup, "directory", short)
    found = {r["text_sha256"] for r in exact_dedup.exact_duplicates(copies, capacity=16).collect()}
    assert len(everything) - len(found) == lost["entries"] > 0


def test_owners_hold_neighbouring_buckets(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS key")
    buckets = exact_dedup.directory(keys, 32)
    rows = exact_dedup.owned(buckets, 500).collect()
    assert Counter((r["depth"], r["bucket"]) for r in rows) == Counter((r["depth"], r["bucket"]) for r in buckets.collect())
    ranges = sorted(((r["bucket"] << (64 - r["depth"])) % (1 << 64), r["owner"]) for r in rows)
    owners = [owner for _, owner in ranges]
    assert owners == sorted(owners) and len(set(owners)) == 10
    held = Counter(r["owner"] for r in exact_dedup.placed(keys, exact_dedup.owned(buckets, 500)).collect())
    assert held.total() == 5000 and max(held.values()) < 600
