"""Structured Streaming over event files.

Every stream reads files with an explicit schema, casts the naive event time
to TIMESTAMP right after the source (``withWatermark`` needs it), and runs
with ``trigger(availableNow=True)``: it processes everything present, emits
what the watermark has closed, and stops — the batch-style run of a
continuously deployable query. Sinks are Parquet with a checkpoint folder
under ``spark.checkpoint.dir``, so a restarted run resumes exactly once.

Windowed aggregates run in append mode: a window is written once, when the
watermark (max event time seen minus the allowed lateness) has passed its
end; rows later than the watermark are dropped by Spark. A stream that ends
(a backfill, a test) closes its last windows by an end marker, one event a day
behind the last (:func:`closed_stream`), whose own window never closes; so every
event is in the result and the batch twin of each stream is the plain query.
Rows behind the watermark need not be lost: :func:`windows_with_late_rows` puts
them into a sink of their own.

A session holds one user's events until their gap; in the state store a user
with very many events is one group, as sessions have it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.functions.labels import sensor_condition
from martlake.functions.numeric import money_sum, to_double
from martlake.session import scratch_path

EVENTS_SCHEMA = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                 "value double, props string")
WATERMARK = "10 minutes"


def event_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File source over ``source`` (a file, directory or glob of Parquet
    files). Without ``max_files_per_trigger`` all files that are there are one
    micro-batch, so that none of their rows is late."""
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(source).withColumn("ts", F.col("ts").cast("timestamp"))


def closed_stream(spark: SparkSession, source: str) -> DataFrame:
    """The events of ``source`` and their end marker as one stream: the
    watermark that closes the last windows moves once all of them are in."""
    marker = scratch_path(spark, "end-marker")
    end_marker(spark.read.schema(EVENTS_SCHEMA).parquet(source)).write.parquet(marker)
    return event_stream(spark, source).unionByName(event_stream(spark, marker))


def end_marker(events: DataFrame) -> DataFrame:
    """One event a day behind the last."""
    last = (F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts")
    return events.agg(last).where(F.col("ts").isNotNull()).select(
        F.lit(-1).cast("bigint").alias("event_id"), "ts", F.lit(-1).cast("bigint").alias("user_id"),
        F.lit("end").alias("event_type"), F.lit(0.0).alias("value"), F.lit("{}").alias("props"))


def run_to_end(query) -> None:
    """Wait for a started query; raise what ended it."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def run_to_parquet(df: DataFrame, name: str, output_mode: str = "append",
                   partition_by=None, arrivals: Iterable[Callable[[], None]] = ()) -> str:
    """Run a streaming frame to completion into a Parquet sink, and again from
    its checkpoint after each of ``arrivals`` (calls that add files to the
    source); return the sink path."""
    spark = df.sparkSession
    out, ckpt = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-ckpt")
    w = (df.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode(output_mode)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    run_to_end(w.start())
    for arrive in arrivals:
        arrive()
        run_to_end(w.start())
    return out


def _flatten_window(col: str = "window") -> list[Column]:
    return [F.col(f"{col}.start").cast("timestamp_ntz").alias("window_start"),
            F.col(f"{col}.end").cast("timestamp_ntz").alias("window_end")]


def tumbling_counts(events: DataFrame, size: str = "1 hour", lateness: str = WATERMARK) -> DataFrame:
    """Events and value per (window, event_type)."""
    g = (events.withWatermark("ts", lateness)
         .groupBy(F.window("ts", size), "event_type")
         .agg(F.count(F.lit(1)).alias("n_events"), money_sum("value").alias("_v")))
    return g.select(*_flatten_window(), "event_type", "n_events", to_double("_v").alias("total_value"))


def sliding_counts(events: DataFrame, size: str = "1 hour", slide: str = "30 minutes",
                   lateness: str = WATERMARK) -> DataFrame:
    """Overlapping windows (each event lands in size/slide windows)."""
    g = (events.withWatermark("ts", lateness)
         .groupBy(F.window("ts", size, slide), "event_type")
         .agg(F.count(F.lit(1)).alias("n_events"), money_sum("value").alias("_v")))
    return g.select(*_flatten_window(), "event_type", "n_events", to_double("_v").alias("total_value"))


def sessions(events: DataFrame, gap: str = "10 minutes", lateness: str = WATERMARK) -> DataFrame:
    """Per-user sessions closed by ``gap`` of inactivity."""
    g = (events.withWatermark("ts", lateness)
         .groupBy(F.session_window("ts", gap).alias("s"), "user_id")
         .agg(F.count(F.lit(1)).alias("n_events"), money_sum("value").alias("_v")))
    return g.select("user_id", F.col("s.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("s.end").cast("timestamp_ntz").alias("session_end"),
                    "n_events", to_double("_v").alias("total_value"))


def classify(events: DataFrame, hot: float = 300.0) -> DataFrame:
    """Stateless threshold classification (value plays the
    temperature, the JSON ``k`` the humidity)."""
    humidity = F.get_json_object("props", "$.k").cast("double")
    return events.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id",
                         "value", humidity.alias("humidity"),
                         sensor_condition(F.col("value") / F.lit(hot / 30.0), humidity)
                         .alias("condition"))


def route_valid_invalid(events: DataFrame, valid: Column, name: str = "routing",
                        arrivals: Iterable[Callable[[], None]] = ()) -> tuple[str, str]:
    """T4 / Q6: each micro-batch split into a valid and an invalid sink
    (``foreachBatch``; both writes are idempotent per batch id); run again
    after each of ``arrivals``."""
    spark = events.sparkSession
    ok_path, bad_path = scratch_path(spark, f"{name}-valid"), scratch_path(spark, f"{name}-invalid")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    flag = F.coalesce(valid, F.lit(False))

    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("_ok", flag).persist()  # read by both writes
        # overwrite only this batch's partition: a replayed batch rewrites itself
        try:
            (b.where("_ok").drop("_ok").write.mode("overwrite")
             .parquet(f"{ok_path}/batch_id={batch_id}"))
            (b.where(~F.col("_ok")).drop("_ok").write.mode("overwrite")
             .parquet(f"{bad_path}/batch_id={batch_id}"))
        finally:
            b.unpersist()

    w = events.writeStream.foreachBatch(write).option("checkpointLocation", ckpt).trigger(availableNow=True)
    run_to_end(w.start())
    for arrive in arrivals:
        arrive()
        run_to_end(w.start())
    return ok_path, bad_path


def windows_with_late_rows(spark: SparkSession, source: str, size_minutes: int = 60, lateness_minutes: int = 10,
                           arrivals: Iterable[Callable[[], None]] = ()) -> tuple[DataFrame, DataFrame]:
    """T2 with a dead letter: (counts by window and type, late rows).

    A row is late when its window had ended ``lateness_minutes`` or more before
    the latest event of the micro-batches before. Each micro-batch splits its
    rows by that watermark, read from the parts that the batches before have
    left: rows in time are added up by window and type, late rows are kept as
    they are. A part holds sums, so the windows of all parts are one more
    aggregate, and a batch that is run again rewrites its own part. Rows without
    a time belong to no window and are late ones too. Counts and late rows
    together are the input, which no drop inside an operator allows.
    """
    root = scratch_path(spark, "late-split")
    ckpt = scratch_path(spark, "late-split-ckpt")
    parts = "window_start timestamp, window_end timestamp, event_type string, n_events bigint, _v decimal(28,6)"
    seen = "batch_id bigint, latest timestamp"

    def write(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        before = 0
        if batch_id:
            before = s.read.schema(seen).parquet(f"{root}/seen").where(F.col("batch_id") < batch_id).agg(
                F.max(F.unix_micros("latest"))).first()[0]
        width = size_minutes * 60_000_000
        start = F.unix_micros("ts") - F.pmod(F.unix_micros("ts"), F.lit(width))
        closed = start + F.lit(width + lateness_minutes * 60_000_000) <= F.lit(before or 0)
        b = (batch.withColumn("window_start", F.timestamp_micros(start)).withColumn("window_end", F.timestamp_micros(start + width))
             .withColumn("_late", F.coalesce(closed, F.lit(True))).persist())
        try:
            (b.where(~F.col("_late")).groupBy("window_start", "window_end", "event_type")
             .agg(F.count(F.lit(1)).alias("n_events"), money_sum("value").alias("_v"))
             .write.mode("overwrite").parquet(f"{root}/windows/batch_id={batch_id}"))
            (b.where("_late").drop("_late", "window_start", "window_end").write.mode("overwrite").parquet(f"{root}/late/batch_id={batch_id}"))
            (b.agg(F.max("ts").alias("latest")).select(F.lit(batch_id).cast("bigint").alias("batch_id"), "latest")
             .write.mode("overwrite").parquet(f"{root}/seen/part={batch_id}"))
        finally:
            b.unpersist()

    w = (event_stream(spark, source).writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
         .trigger(availableNow=True))
    run_to_end(w.start())
    for arrive in arrivals:
        arrive()
        run_to_end(w.start())
    windows = spark.read.schema(parts).parquet(f"{root}/windows/*").groupBy("window_start", "window_end", "event_type").agg(
        F.sum("n_events").alias("n_events"), F.sum("_v").alias("_v"))
    late = spark.read.schema(EVENTS_SCHEMA.replace("ts timestamp_ntz", "ts timestamp")).parquet(f"{root}/late/*")
    return (windows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                           F.col("window_end").cast("timestamp_ntz").alias("window_end"), "event_type", "n_events",
                           to_double("_v").alias("total_value")),
            late.withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def distinct_events(events: DataFrame, lateness: str = "1 hour", key: str = "event_id") -> DataFrame:
    """Each event once, however often its file is delivered again
    within ``lateness``; the state holds the keys of that time alone."""
    return events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark([key])
