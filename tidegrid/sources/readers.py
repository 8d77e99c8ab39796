"""Readers and writers of observations and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.scalars import number
from tidegrid.operators import ingest


def observations_csv(spark: SparkSession, path: str, variables: list[str], time: str = "TimeStamp", sensor: str | None = None) -> DataFrame:
    """All CSV files at path in one scan: (sensor_id, ts, arrival, variables). Without a sensor column the file's name is the sensor. Variables that a file lacks are null."""
    raw = spark.read.option("header", True).csv(path)
    name = F.col(sensor) if sensor else F.regexp_extract(F.input_file_name(), r"([^/]+)\.csv$", 1)
    cols = [number(F.col(v)).alias(v) if v in raw.columns else F.lit(None).cast("double").alias(v) for v in variables]
    x = raw.select(name.alias("sensor_id"), F.col(time).alias("ts_text"), F.monotonically_increasing_id().alias("arrival"), *cols)
    x = ingest.autodetect_times(x).drop("ts_text", "day_first")
    return ingest.sane(x.withColumn("ts", F.col("ts").cast("timestamp_ntz")))


def key_range(spark: SparkSession, path: str, sensors: list[str] | None = None, start=None, key: str = "sensor_id") -> DataFrame:
    """Rows of sensors from start on; both filters reach the scan."""
    x = spark.read.parquet(path)
    x = x if sensors is None else x.where(F.col(key).isin(sensors))
    return x if start is None else x.where(F.col("ts") >= F.lit(start))


def active_sensors(meta: DataFrame, limit: int | None = None) -> DataFrame:
    x = meta.where(F.col("status") == "ACTIVE").select("device_id")
    return x if limit is None else x.limit(limit)


def report_csv(df: DataFrame, path: str) -> None:
    """A small report as one CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def live_results(df: DataFrame, now: int) -> DataFrame:
    return df.where(F.col("ttl") > now)


def mae_chart(points: list[tuple[str, int, float]]) -> str:
    """SVG of MAE by gap size, one line for each variable; no points give an empty chart."""
    top = max([m for _, _, m in points], default=1.0) or 1.0
    wide = max([s for _, s, _ in points], default=1)
    lines = []
    for v in sorted({v for v, _, _ in points}):
        at = " ".join(f"{40 + 340 * s / wide:.1f},{260 - 220 * m / top:.1f}" for w, s, m in sorted(points) if w == v)
        lines.append(f'<polyline fill="none" stroke="currentColor" points="{at}"><title>{v}</title></polyline>')
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="400" height="280">{"".join(lines)}</svg>'
