"""Arrival counts per window, late arrivals, and suppression of repeated deliveries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def count_arrivals(
    arrivals: DataFrame,
    path: str,
    checkpoint: str,
    at: str,
    by: list[str],
    window: str = "1 day",
    delay: str = "1 hour",
) -> StreamingQuery:
    """Count arrivals per window and group, and how many of them came late.

    An arrival is late when its time is more than `delay` before the highest time of the
    micro-batches before its own. Every row is judged before it is counted, and none is left
    out. Each micro-batch writes its own small counts, and beside them the highest time so far,
    of which the next one reads only the last; a replay overwrites both. Read the totals with
    `arrival_windows`.
    """
    marks = f"{path.rstrip('/')}-highest"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = None
        if batch_id > 0:
            earlier = spark.read.parquet(f"{marks}/batch_id={batch_id - 1}").first()["highest"]
        moment = F.col(at).cast("timestamp")
        late = F.lit(False)
        if earlier is not None:
            late = moment < F.lit(earlier) - F.expr(f"INTERVAL {delay}")
        counts = batch.groupBy(F.window(moment, window).alias("window"), *by).agg(
            F.count(F.lit(1)).alias("arrivals"),
            F.count_if(late).alias("late"),
            F.max(moment).alias("highest"),
        )
        counts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        highest = spark.read.parquet(f"{path}/batch_id={batch_id}").agg(F.max("highest").alias("highest"))
        if earlier is not None:
            highest = highest.select(F.greatest("highest", F.lit(earlier)).alias("highest"))
        highest.write.mode("overwrite").parquet(f"{marks}/batch_id={batch_id}")

    return (
        arrivals.filter(F.col(at).isNotNull())
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def arrival_windows(spark: SparkSession, path: str, by: list[str]) -> DataFrame:
    """Arrivals and late arrivals per window and group, over all micro-batches so far."""
    counts = spark.read.parquet(path).groupBy("window", *by).agg(
        F.sum("arrivals").alias("arrivals"), F.sum("late").alias("late")
    )
    return counts.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by,
        "arrivals", "late",
    )


def silences(
    arrivals: DataFrame, at: str, by: list[str], gap: str = "25 hours", delay: str = "1 hour"
) -> DataFrame:
    """A row for each time that a source fell silent for longer than `gap`.

    Columns: `by`, first_seen and last_seen of the arrivals before the silence, their number, and
    `overdue_at`, when the gap was full. A row comes once the highest time of all sources is
    `delay` past that, so a source that has stopped for good is reported while others go on. State
    is one open stretch for each source. Arrivals more than `delay` behind the highest time may
    come too late to break a silence; `count_arrivals` counts those.
    """
    timed = arrivals.filter(F.col(at).isNotNull()).select(*by, F.col(at).cast("timestamp").alias("_at"))
    stretch = F.session_window("_at", gap)
    found = timed.withWatermark("_at", delay).groupBy(stretch.alias("stretch"), *by).agg(
        F.count(F.lit(1)).alias("arrivals")
    )
    return found.select(
        *by, F.col("stretch.start").alias("first_seen"),
        (F.col("stretch.end") - F.expr(f"INTERVAL {gap}")).alias("last_seen"), "arrivals",
        F.col("stretch.end").alias("overdue_at"),
    )


def suppress_repeats(
    arrivals: DataFrame, at: str, keys: list[str], delay: str = "1 day"
) -> DataFrame:
    """The first delivery of each key; state is kept only for `delay`."""
    timed = arrivals.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    return timed.dropDuplicatesWithinWatermark(keys)


def append_to(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
