"""The sales fact from two streams: orders and their lines meet while both are on the way.

Lines carry no time; they are stamped with the time they were received, and so are orders. Both sides have a watermark, and
an order waits for its lines, and lines for their order, for a bounded time: state older than that is given up. What the
join finds goes into the stored fact by key, so a repeated micro-batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators import facts
from martloom.operators.incremental import FactTable, month_of_key
from martloom.streaming.ads import run_to_end

# Time an order and its lines may be received apart.
WAIT = "2 days"


def joined(orders: DataFrame, lines: DataFrame, wait: str = WAIT) -> DataFrame:
    """Streams of orders and lines, each with a time ``received_at`` (a timestamp), as one stream of lines with their order.

    A pair is found whichever side comes first, if they are received no more than ``wait`` apart.
    """
    order_columns = [c for c in orders.columns if c not in ("order_id", "received_at")]
    left = lines.withColumnRenamed("received_at", "line_at").withWatermark("line_at", wait)
    right = orders.select(F.col("order_id").alias("_order_id"), F.col("received_at").alias("order_at"), *order_columns)
    right = right.withWatermark("order_at", wait)
    near = F.expr(
        f"order_id = _order_id AND line_at >= order_at - INTERVAL {wait} AND line_at <= order_at + INTERVAL {wait}"
    )
    return left.join(right, near).drop("_order_id", "order_at", "line_at")


def stream_fact_sales(
    orders: DataFrame, lines: DataFrame, folder: str, customer: DataFrame, product: DataFrame, calendar: DataFrame,
    wait: str = WAIT,
) -> FactTable:
    """The sales fact, stored and kept up to date from the streams of orders and lines, up to what there is now.

    The dimensions are read by each micro-batch as they are then.
    """
    key, time_column, date_key = facts.LOADS["fact_sales"]
    table = FactTable(orders.sparkSession, f"{folder}/fact_sales", key, time_column, month_of_key(date_key))

    def write(batch: DataFrame) -> None:
        # One row for each line that has met its order. It is read once, so nothing of it is kept beside the table.
        table.upsert(facts.fact_sales_of_pairs(batch, customer, product, calendar))

    run_to_end(joined(orders, lines, wait), f"{folder}/checkpoint", write, mode="append")
    return table
