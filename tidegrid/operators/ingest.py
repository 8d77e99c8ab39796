"""Cleaning of raw observations (sensor_id, ts, arrival, variables)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.functions.scalars import is_original, parse_two_ways, slot


def autodetect_times(raw: DataFrame, column: str = "ts_text") -> DataFrame:
    """raw with ts: per sensor the reading (default or day-first) that fails less often; a tie keeps the default. Unparseable rows have a null ts."""
    a, b = parse_two_ways(F.col(column))
    x = raw.withColumn("_a", a).withColumn("_b", b)
    fails = x.groupBy("sensor_id").agg(F.count_if(F.col("_a").isNull()).alias("_fa"), F.count_if(F.col("_b").isNull()).alias("_fb"))
    x = x.join(fails, "sensor_id")
    return x.withColumn("day_first", F.col("_fb") < F.col("_fa")).withColumn("ts", F.when(F.col("day_first"), F.col("_b")).otherwise(F.col("_a"))).drop("_a", "_b", "_fa", "_fb")


def sane(obs: DataFrame, last_year: int = 2030) -> DataFrame:
    """Rows with a time up to the end of last_year; a range on the raw column, so that it reaches the scan."""
    return obs.where(F.col("ts").isNotNull() & (F.col("ts") < F.lit(f"{last_year + 1}-01-01 00:00:00").cast("timestamp_ntz")))


def originals(obs: DataFrame) -> DataFrame:
    return obs.where(is_original(F.col("imputation_method"), F.col("filled_flag")))


def pick_unit(obs: DataFrame, ref: str, unit: str = "unit", only: str | int | None = None) -> DataFrame:
    """Per sensor the rows of the unit with the most numeric reference values (ties: least unit), or those of the unit ``only``; sensors without any keep all rows."""
    if only is not None:
        return obs.where(F.col(unit) == F.lit(only))
    counts = obs.where(F.col(ref).isNotNull() & F.col(unit).isNotNull()).groupBy("sensor_id", unit).agg(F.count("*").alias("n"))
    best = counts.groupBy("sensor_id").agg(F.min_by(unit, F.struct(-F.col("n"), F.col(unit))).alias("_unit"))
    return obs.join(best, "sensor_id", "left").where(F.col("_unit").isNull() | (F.col(unit) == F.col("_unit"))).drop("_unit")


def read_window(obs: DataFrame, start=None, lookback_days: int | None = None, now=None) -> DataFrame:
    """Rows from start on, else from lookback_days before now on, else all."""
    if start is not None:
        return obs.where(F.col("ts") >= F.lit(start))
    return obs if lookback_days is None else obs.where(F.col("ts") >= F.lit(now) - F.expr(f"interval {lookback_days} days"))


def round_dedup(obs: DataFrame, minutes: float | Column, by_time: bool = True) -> DataFrame:
    """A row for each sensor and slot: the first by (ts, arrival), or by arrival alone. A minimum over structs, which combines before the shuffle."""
    rest = [c for c in obs.columns if c not in ("sensor_id", "ts", "arrival")]
    order = ["ts", "arrival"] if by_time else ["arrival", "ts"]
    x = obs.withColumn("slot", slot(F.col("ts"), minutes))
    best = x.groupBy("sensor_id", "slot").agg(F.min(F.struct(*order, *rest)).alias("_r"))
    return best.select("sensor_id", "slot", *[F.col(f"_r.{c}").alias(c) for c in ("ts", "arrival", *rest)])


def quality_summary(obs: DataFrame, minutes: float) -> DataFrame:
    """Per sensor: rows, distinct slots, duplicates, first and last slot."""
    x = obs.withColumn("slot", slot(F.col("ts"), minutes))
    total, unique = F.count("*"), F.countDistinct("slot")
    return x.groupBy("sensor_id").agg(total.alias("total_rows"), unique.alias("unique_slots"), (total - unique).alias("duplicates"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))


def newest_original(obs: DataFrame) -> DataFrame:
    """Per sensor the newest row that no earlier run wrote: its attributes are copied to written rows, its time is the watermark."""
    rest = [c for c in obs.columns if c != "sensor_id"]
    best = originals(obs).groupBy("sensor_id").agg(F.max_by(F.struct(*rest), F.struct("ts", "arrival")).alias("_r"))
    return best.select("sensor_id", "_r.*")


def first_keys(keys: DataFrame, limit: int | None = None) -> DataFrame:
    """Keys (pos, key) in order, ``limit`` first and repeats after that left out."""
    x = keys if limit is None else keys.orderBy("pos").limit(limit)
    return x.groupBy("key").agg(F.min("pos").alias("pos"))


def rank_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
