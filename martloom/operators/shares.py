"""Amounts shared out in whole cents, so that the parts add up to the whole."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shared_out(
    df: DataFrame, whole: str, weights: dict[str, Column], keys: Sequence[str], order: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """df with a column for each weight: the part of ``whole`` that a row gets by its weight among the rows of its keys.

    ``whole`` is an amount of money, the same in all rows of a key; ``weights`` are whole numbers from 0 on, by the name of
    the part (a decimal like the whole). Parts are rounded down to cents, and what is left goes, a cent each, to the largest remainders, ties in
    ``order``, which must tell the rows of a key apart. The parts of a key add up to the whole; where all its weights are 0,
    or the whole is NULL, they are NULL. A negative amount is shared out like the positive one. Of df's columns those in
    ``columns`` come back, or all.

    One task holds a key's rows in turn, as a list in ``order``: keys should be as narrow as a purchase or a day. Rows are
    sorted by key as they come, with nothing but their weights added; all parts are worked out on the list.
    """
    columns = df.columns if columns is None else list(columns)
    kind = df.schema[whole].dataType.simpleString()
    carried = [*order, *[c for c in columns if c not in keys and c not in order]]
    row = F.struct(
        *carried, (F.abs(F.col(whole)) * 100).cast("decimal(20,0)").alias("_cents"), (F.col(whole) < 0).alias("_minus"),
        *[w.cast("decimal(18,0)").alias(f"_{n}_w") for n, w in weights.items()],
    )
    out = df.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_rows"))

    def step(made: str, text: str) -> list[Column]:
        return [F.expr(text.replace("{n}", n)).alias(f"_{n}_{made}") for n in weights]

    total = "aggregate(_rows, CAST(0 AS DECIMAL(28,0)), (a, r) -> CAST(a + coalesce(r._{n}_w, 0) AS DECIMAL(28,0)), a -> nullif(a, 0))"
    out = out.select("*", *step("all", total))
    # Both factors are whole numbers and so are quotient and remainder.
    split = (
        "transform(_rows, r -> named_struct('cents', r._cents, 'minus', r._minus,"
        " 'base', (r._cents * r._{n}_w) DIV _{n}_all, 'rest', (r._cents * r._{n}_w) % _{n}_all))"
    )
    out = out.select("*", *step("split", split))
    place = "named_struct('none', s.rest IS NULL, 'most', -s.rest, 'at', i)"
    out = out.select(
        "*", *step("given", "aggregate(_{n}_split, 0L, (a, s) -> a + coalesce(s.base, 0L))"),
        *step("places", f"array_sort(transform(_{{n}}_split, (s, i) -> {place}))"),
    )
    # The cents that are left go to the first places: a row gets one if its place is not behind that of the last cent.
    left = "s.cents - _{n}_given"
    more = (
        f"CASE WHEN {left} IS NULL THEN NULL WHEN {left} < 1 THEN 0"
        f" WHEN {place} <= get(_{{n}}_places, CAST(least({left}, size(_{{n}}_places)) AS INT) - 1) THEN 1 ELSE 0 END"
    )
    amount = f"CAST((s.base + {more}) * CASE WHEN s.minus THEN -1 ELSE 1 END AS DECIMAL(20,0))"
    part = f"transform(_{{n}}_split, (s, i) -> CAST({amount} * CAST(0.01 AS DECIMAL(3,2)) AS {kind}))"
    listed = out.select(*keys, "_rows", *step("part", part))
    shared = listed.select(*keys, F.inline(F.arrays_zip("_rows", *[f"_{n}_part" for n in weights])))
    kept = [F.col(c) if c in keys else F.col("_rows")[c].alias(c) for c in columns]
    return shared.select(*kept, *[F.col(f"_{n}_part").alias(n) for n in weights])
