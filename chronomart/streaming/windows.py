"""Daily sales as an event-time window over append-only facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronomart.operators.latest import latest_state
from chronomart.operators.marts import daily_measures
from chronomart.streaming.ingest import EVERY, write_batch


def daily_sales_stream(facts: DataFrame, late: str | None = None) -> DataFrame:
    """Every fact updates its day, however late it comes. State: one row per day.

    ``late`` closes days that are further behind the newest fact and so forgets their
    state; Spark then drops the facts of closed days, so give it only where none come.
    Facts that change later (a new status) need the incremental warehouse instead.
    """
    columns = facts.columns
    day = F.window("_at", "1 day")
    timed = facts.withColumn("_at", F.col("order_date").cast("timestamp_ntz").cast("timestamp"))
    if late is not None:
        timed = timed.withWatermark("_at", late)
    grouped = timed.groupBy(day).agg(*daily_measures())
    measures = [c for c in grouped.columns if c != "window" and c not in columns]
    return grouped.select(F.to_date("window.start").alias("sale_date"), *measures)


def start_windows(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Stores every update of a day; ``read_windows`` shows the last one."""
    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id))
        .trigger(**(trigger or EVERY))
        .start()
    )


def read_windows(spark: SparkSession, path: str, key: str = "sale_date") -> DataFrame:
    return latest_state(spark.read.parquet(path), [key], ["batch_id"]).drop("batch_id")
