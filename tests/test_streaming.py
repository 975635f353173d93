from __future__ import annotations

import os
from datetime import datetime

import pytest

from martloom.sources import star
from martloom.streaming import ads as streams
from tests.samples import bag

EVENTS = [
    ("2024-01-01T01:00:00", 1, "view", 1.25), ("2024-01-01T02:30:00", 1, "click", 2.25),
    ("2024-01-01T02:45:00", 1, "click", 0.25), ("2024-01-01T23:59:59", 1, "purchase", 9.0),
    ("2024-01-02T00:00:00", 1, "click", 1.0), ("2024-01-02T05:00:00", 2, "view", 3.0),
    ("2024-01-02T06:00:00", 1, "view", 0.5), ("2024-01-01T12:00:00", 2, "purchase", 4.0),
]


def events(spark, rows):
    data = [(i, datetime.fromisoformat(t), u, k, v, "{}") for i, (t, u, k, v) in enumerate(rows)]
    return spark.createDataFrame(data, star.SCHEMAS["events"])


def write_file(spark, rows, folder, name, age):
    """One file of events; files are read in the order of their times."""
    events(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    (new,) = [f for f in os.listdir(folder) if f.startswith("part-")]
    os.replace(f"{folder}/{new}", f"{folder}/{name}.parquet")
    os.utime(f"{folder}/{name}.parquet", (1_700_000_000 + age, 1_700_000_000 + age))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_stream_equals_batch(spark, tmp_path, zone):
    """Days are those of the zoneless time, whatever the session's zone; a day split over batches is summed."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        folder = str(tmp_path / "events")
        for n, part in enumerate((EVENTS[:3], EVENTS[3:5], EVENTS[5:])):
            write_file(spark, part, folder, f"e{n}", n)
        table = streams.stream_ad_daily(spark, folder, str(tmp_path / "out"), files_per_batch=1)
        expected = star.insight_columns(star.daily_counts(events(spark, EVENTS)))
        assert bag(table.read().select(expected.columns)) == bag(expected)
        assert expected.where("unique_clicks = 1 AND clicks = 2").count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_events_behind_the_watermark_are_dropped(spark, tmp_path):
    """The watermark lies a day behind the newest event; it takes hold one batch later."""
    folder = str(tmp_path / "events")
    batches = [
        EVENTS[:1],
        [("2024-01-09T00:00:00", 1, "view", 1.0)],
        [("2024-01-09T01:00:00", 1, "view", 1.0)],
        [("2024-01-01T03:00:00", 1, "view", 5.0), ("2024-01-08T06:00:00", 1, "view", 2.0)],
    ]
    for n, rows in enumerate(batches):
        write_file(spark, rows, folder, f"e{n}", n)
    table = streams.stream_ad_daily(spark, folder, str(tmp_path / "out"), files_per_batch=1)
    found = {str(r["date"]): str(r["spend"]) for r in table.read().collect()}
    assert found == {"2024-01-01": "1.25", "2024-01-08": "2.00", "2024-01-09": "2.00"}


def test_sales_from_two_streams(spark, tmp_path):
    """Lines ahead of and behind their order, in other micro-batches; state that is too old is given up."""
    from datetime import timedelta

    from martloom.streaming.sales import stream_fact_sales
    from tests.samples import at, bag, line, order, shop

    orders = [order(n, day=f"2024-01-{10 + n}") for n in range(1, 9)]
    lines = [line(n, 1 + n % 8) for n in range(1, 25)]
    w = shop(spark, orders, lines)
    late = 7  # received long after its order
    received = {}
    for n, r in enumerate(lines):
        when = orders[r["order_id"] - 1]["order_date"] + timedelta(hours=(-30, 0, 30)[n % 3])
        received[str(r["order_item_id"])] = when + timedelta(days=30) if r["order_item_id"] == late else when

    def stamped(df, times, key):
        table = spark.createDataFrame([(str(k), t) for k, t in times.items()], "k string, received_at timestamp")
        return df.join(table, df[key].cast("string") == table.k).drop("k")

    heads = stamped(w["stg_orders"], {o["order_id"]: o["order_date"] for o in orders}, "order_id").cache()
    parts = stamped(w["stg_order_items"], received, "order_item_id").cache()

    def stream(name, like):
        return spark.readStream.schema(like.schema).parquet(f"{tmp_path}/{name}")

    limits = [at("2024-01-01"), at("2024-01-14T12:00:00"), at("2024-03-30")]
    table = None
    for since, until in zip(limits, limits[1:], strict=False):
        for name, df in (("orders", heads), ("lines", parts)):
            df.where((df.received_at >= since) & (df.received_at < until)).write.mode("append").parquet(f"{tmp_path}/{name}")
        table = stream_fact_sales(
            stream("orders", heads), stream("lines", parts), str(tmp_path), w["dim_customer"], w["dim_product"], w["dim_date"]
        )
    wanted = w["fact_sales"].where(f"order_item_id <> {late}")
    assert bag(table.read().select(wanted.columns)) == bag(wanted)
    crossed = [k for k, t in received.items() if (t < limits[1]) != (orders[lines[int(k) - 1]["order_id"] - 1]["order_date"] < limits[1])]
    assert len(crossed) >= 2


def test_a_stream_keeps_two_states_and_leaves_the_session_as_it_was(spark, tmp_path):
    folder = str(tmp_path / "events")
    names = [*streams.STATE]
    before = [spark.conf.get(n, None) for n in names]
    for n in range(5):
        write_file(spark, EVENTS[n : n + 1], folder, f"e{n}", n)
    seen = []
    stream = streams.ad_daily(streams.read_events(spark, folder, files_per_batch=1))
    streams.run_to_end(stream, str(tmp_path / "at"), lambda batch: seen.append(batch.sparkSession.conf.get(names[-1])) or batch.count())
    assert set(seen) == {"2"} and len(seen) >= 5
    assert [spark.conf.get(n, None) for n in names] == before
    # Of the batches' commits no more than the last ones are kept.
    assert len([f for f in os.listdir(tmp_path / "at" / "commits") if f.isdigit()]) <= 4
