"""Reconstruction of streams: each micro-batch runs the plan again over the look-back of the sensors it touched."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.config import PRODUCTION, Profile
from tidegrid.operators import state
from tidegrid.plans.pipeline import reconstruct


def slot_counts(stream: DataFrame, width: str = "15 minutes", late: str = "1 hour") -> DataFrame:
    """Readings for each sensor and tumbling window; rows later than ``late`` are left out."""
    return stream.withWatermark("ts", late).groupBy("sensor_id", F.window("ts", width)).agg(F.count("*").alias("n"), F.avg("value").alias("value"))


def on_batch(history: Callable[[DataFrame], DataFrame], topology: DataFrame, table: str, minutes: float, profile: Profile = PRODUCTION) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: history(touched sensors) gives their readings; fills go to the Parquet table by conditional upsert, so a repeated batch changes nothing."""

    def run(batch: DataFrame, _: int) -> None:
        touched = batch.select("sensor_id").distinct()
        x = state.persist_masks(reconstruct(history(touched), topology, minutes, profile), profile.ref).where("persistable")
        new = x.select("sensor_id", "slot", *profile.continuous, "imputation_method", "confidence_level", "filled_flag")
        state.upsert_into(table, new, ["sensor_id", "slot"])

    return run


def start(spark: SparkSession, stream: DataFrame, handler: Callable, checkpoint: str):
    return stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
