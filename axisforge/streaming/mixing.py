"""Events mixed as they arrive. Thrust, hemispheres and weights need one event at a time, so the batch plan is the stream's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from axisforge.config import MixConfig
from axisforge.plans.pipeline import mix


def read_events(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def start_mixing(events: DataFrame, path: str, checkpoint: str, config: MixConfig | None = None, weight: Column | None = None, once: bool = True) -> StreamingQuery:
    """Appends the mixed events to the Parquet table at path; `once` handles what is there and ends."""
    writer = mix(events, config, weight).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start()


def windowed_cutflow(events: DataFrame, time: str, window: str, delay: str, n_jets: int = 5) -> DataFrame:
    """(start, end, n_read, n_pass) by windows of event time; events later than `delay` are left out."""
    counts = events.withWatermark(time, delay).groupBy(F.window(time, window).alias("w")).agg(F.count(F.lit(1)).alias("n_read"), F.count_if(F.size("jets") == n_jets).alias("n_pass"))
    return counts.select("w.start", "w.end", "n_read", "n_pass")
