from __future__ import annotations

from martloom.operators import quality


def listed(df) -> dict:
    return {(r["table_name"], r["column_name"], r["test"]): r["failures"] for r in df.collect()}


def test_declared_checks():
    assert sum(map(len, quality.NOT_NULL.values())) == 62
    assert sum(map(len, quality.UNIQUE.values())) == 32
    assert sum(map(len, quality.RELATIONSHIPS.values())) == 10


def test_failures(spark):
    child = spark.createDataFrame(
        [(1, "a", 10), (1, "a", 10), (2, None, 20), (None, "b", 30), (3, "c", None), (3, "d", 99), (3, "e", 99)],
        "id int, name string, parent int",
    )
    parent = spark.createDataFrame([(10,), (20,), (None,)], "key bigint")
    assert listed(quality.not_null(child, "t", ["id", "name"])) == {
        ("t", "id", "not_null"): 1, ("t", "name", "not_null"): 1
    }
    # Values that repeat, not rows; NULLs do not count.
    assert listed(quality.unique(child, "t", ["id", "name", "parent"])) == {
        ("t", "id", "unique"): 2, ("t", "name", "unique"): 1, ("t", "parent", "unique"): 2
    }
    # Rows without a parent, not values.
    names = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",)], "n string")
    assert listed(quality.relationships(child, "t", {"parent": (parent, "key"), "name": (names, "n")})) == {
        ("t", "parent", "relationships"): 3, ("t", "name", "relationships"): 0
    }


def test_empty_table_passes(spark):
    empty = spark.createDataFrame([], "id int, parent int")
    assert listed(quality.not_null(empty, "t", ["id"])) == {("t", "id", "not_null"): 0}
    assert listed(quality.unique(empty, "t", ["id"])) == {("t", "id", "unique"): 0}
    parents = {"parent": (spark.createDataFrame([(1,)], "k int"), "k")}
    assert listed(quality.relationships(empty, "t", parents)) == {("t", "parent", "relationships"): 0}


def test_hashes_are_counted_as_bytes(spark):
    one, two = "ab" * 16, "cd" * 16
    df = spark.createDataFrame([(one,), (one,), (two,), (one.upper(),), (None,)], "k string")
    assert {len(r["value"]) for r in quality._value_counts(df, ["k"]).collect()} == {16, 17 + 32}
    assert listed(quality.unique(df, "t", ["k"])) == {("t", "k", "unique"): 1}
    parent = spark.createDataFrame([(one,)], "k string")
    assert listed(quality.relationships(df, "t", {"k": (parent, "k")})) == {("t", "k", "relationships"): 2}


def test_stored_checks_are_the_checks(spark, tmp_path):
    """One check after the other, each stored: the same rows, and none of their shuffle files is left."""
    from martloom.plans.registry import queries
    from tests.test_incremental import shuffle_files

    asked = []

    def tables(name):
        asked.append(name)
        rows = spark.range(9000 if name == "stg_orders" else 3)
        columns = {c for declared in (quality.NOT_NULL, quality.UNIQUE) for c in declared.get(name, ())}
        return rows.select(*[rows.id.alias(c) for c in sorted(columns)])

    before = shuffle_files(spark)
    stored = quality.all_unique(tables, str(tmp_path / "checks"))
    assert not {p for p in shuffle_files(spark) - before if p.stat().st_size > 20_000}
    assert asked == list(quality.UNIQUE)
    assert listed(stored) == listed(quality.all_unique(tables)) and stored.count() == 32
    found = queries()["dq_unique"](spark, "/root/testdata/sf0.001")
    assert found.columns == ["table_name", "column_name", "test", "failures"] and found.count() == 32
    # What is returned reads the stored results, and no model.
    assert all("unique-" in f for f in found.inputFiles()) and "Union" not in found._jdf.queryExecution().executedPlan().toString()
