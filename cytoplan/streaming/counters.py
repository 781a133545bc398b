"""An extension over the batch operators: incremental counters per user and window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Events, distinct types and value per user and tumbling window; state is dropped behind the watermark."""
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "user_id")
        .agg(F.count("*").alias("n"), F.size(F.collect_set("event_type")).cast("long").alias("types"), F.round(F.sum("value"), 2).alias("total"))
        .select("user_id", F.col("w.start").alias("start"), "n", "types", "total")
    )


def replay(spark: SparkSession, path: str) -> DataFrame:
    """Stream a stored table once to its end; the counters are written to shared storage batch by batch."""
    from ..sources.stage import stage_path

    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    out, state = stage_path(spark), stage_path(spark)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)
    counts = windowed_counts(stream)

    def keep(df: DataFrame, batch: int) -> None:  # a batch that is run again replaces its rows
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    counts.writeStream.outputMode("update").option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    last = spark.read.parquet(out).groupBy("user_id", "start").agg(F.max_by(F.struct("n", "types", "total"), "batch").alias("last"))
    return last.select("user_id", "start", "last.n", "last.types", "last.total")
