"""Neighbour topology, alignment, quality and reliability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.config import Profile
from tidegrid.functions.scalars import slot
from tidegrid.operators.grid import classify, gap_counts

EARTH_KM = 6371.0


def unpivot(topology: DataFrame) -> DataFrame:
    """(target_id, rank, neighbor_id, topic, dist_km) of rows with neighbor_{1..3}_{id,raw_id,topic,dist}; the raw id counts first, absent ones go."""
    parts = ", ".join(f"{k}, coalesce(neighbor_{k}_raw_id, neighbor_{k}_id), neighbor_{k}_topic, cast(neighbor_{k}_dist as double)" for k in (1, 2, 3))
    return topology.selectExpr("target_id", f"stack(3, {parts}) as (rank, neighbor_id, topic, dist_km)").where("neighbor_id IS NOT NULL")


def resolve_table(keys: DataFrame, prefixes: DataFrame, default: str) -> DataFrame:
    """keys(topic) with table_name: that of the longest prefix of the topic, else the default. prefixes is a configuration list."""
    hit = keys.select("topic").distinct().join(F.broadcast(prefixes), F.col("topic").startswith(F.col("prefix")) & (F.col("topic") != ""))
    best = hit.groupBy("topic").agg(F.max_by("table_name", F.length("prefix")).alias("table_name"))
    return keys.join(best, "topic", "left").withColumn("table_name", F.coalesce("table_name", F.lit(default)))


def nearest(points: DataFrame, k: int = 2, most_km: float = 30.0) -> DataFrame:
    """(target_id, neighbor_id, rank, dist_km) of points(id, lat, lon): the k nearest within most_km by great circle, ties by id.

    Points meet in cells of latitude and longitude at least most_km wide (longitude cells by the narrowest latitude of their
    band, round the globe), so far pairs are never made.
    """
    band = float(most_km / 111.0)
    cosine = F.greatest(F.cos(F.radians((F.abs(F.col("_y")) + 1) * F.lit(band))), F.lit(0.0))
    columns = F.greatest(F.floor(F.lit(360.0) / F.lit(band) * cosine), F.lit(1)).cast("long")
    x = points.withColumn("_y", F.floor(F.col("lat") / band))
    home = x.withColumn("_n", columns).withColumn("_x", F.least(F.floor((F.col("lon") + 180.0) / 360.0 * F.col("_n")), F.col("_n") - 1))
    probe = x.withColumn("_y", F.explode(F.array(F.col("_y") - 1, F.col("_y"), F.col("_y") + 1))).withColumn("_n", columns)
    at = F.least(F.floor((F.col("lon") + 180.0) / 360.0 * F.col("_n")), F.col("_n") - 1)
    probe = probe.withColumn("_x", F.explode(F.array_distinct(F.transform(F.array(at - 1, at, at + 1), lambda c: F.pmod(c, F.col("_n"))))))
    a = home.select("_y", "_x", F.col("id").alias("target_id"), F.col("lat").alias("la"), F.col("lon").alias("lo"))
    b = probe.select("_y", "_x", F.col("id").alias("neighbor_id"), F.col("lat").alias("lb"), F.col("lon").alias("lp"))
    h = F.pow(F.sin(F.radians(F.col("lb") - F.col("la")) / 2), 2) + F.cos(F.radians("la")) * F.cos(F.radians("lb")) * F.pow(F.sin(F.radians(F.col("lp") - F.col("lo")) / 2), 2)
    pairs = a.join(b, ["_y", "_x"]).where("target_id <> neighbor_id").withColumn("d", 2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))).where(F.col("d") <= most_km)
    pairs = pairs.withColumn("dist_km", F.bround("d", 2)).withColumn("rank", F.row_number().over(W.partitionBy("target_id").orderBy("dist_km", "neighbor_id")))
    return pairs.where(F.col("rank") <= k).select("target_id", "neighbor_id", "rank", "dist_km")


def around(main: DataFrame, topology: DataFrame, slots: DataFrame, variables: list[str]) -> DataFrame:
    """(sensor_id, rank, neighbor_id, dist_km, slot, variables) of the neighbours on every slot of the target's grid; one scan of the observations serves all targets."""
    line = main.select("sensor_id", "slot").join(topology.withColumnRenamed("target_id", "sensor_id"), "sensor_id")
    seen = slots.select(F.col("sensor_id").alias("neighbor_id"), "slot", *variables)
    return line.join(seen, ["neighbor_id", "slot"], "left")


def around_rounded(main: DataFrame, topology: DataFrame, obs: DataFrame, intervals: DataFrame, variables: list[str]) -> DataFrame:
    """As around(), where sensors have intervals of their own: a neighbour's readings obs are rounded to the target's interval; intervals(sensor_id, minutes)."""
    pairs = topology.join(intervals.withColumnRenamed("sensor_id", "target_id"), "target_id").select("target_id", "neighbor_id", "minutes")
    seen = obs.select(F.col("sensor_id").alias("neighbor_id"), "ts", "arrival", *variables).join(pairs, "neighbor_id").withColumn("slot", slot(F.col("ts"), F.col("minutes")))
    best = seen.groupBy("target_id", "neighbor_id", "slot").agg(F.min(F.struct("ts", "arrival", *variables)).alias("r")).select(F.col("target_id").alias("sensor_id"), "neighbor_id", "slot", *[F.col(f"r.{v}").alias(v) for v in variables])
    line = main.select("sensor_id", "slot").join(topology.withColumnRenamed("target_id", "sensor_id"), "sensor_id")
    return line.join(best, ["sensor_id", "neighbor_id", "slot"], "left")


def attach(main: DataFrame, near: DataFrame, names: dict[str, str], ranks: int = 3) -> DataFrame:
    """main with the neighbours' variables as {name}_n{rank}."""
    each = [F.max(F.when(F.col("rank") == r, F.col(v))).alias(f"{n}_n{r}") for v, n in names.items() for r in range(1, ranks + 1)]
    return main if not each else main.join(near.groupBy("sensor_id", "slot").agg(*each), ["sensor_id", "slot"], "left")


def quality(near: DataFrame, profile: Profile) -> DataFrame:
    """Per target and neighbour: coverage of the quality columns in per cent, rows there, share missing; research also counts the gaps of availability."""
    pct = lambda c: F.bround(100.0 * F.avg(c.isNotNull().cast("double")), 2)
    there = F.coalesce(*[F.col(c) for c in profile.quality])
    key = ["sensor_id", "rank", "neighbor_id"]
    out = near.groupBy(*key).agg(*[pct(F.col(c)).alias(f"coverage_{c}") for c in profile.quality], F.count(there).alias("rows_present"), F.bround(100.0 * F.avg(there.isNull().cast("double")), 2).alias("missing_pct"))
    if profile.name == "production":
        return out
    out = out.withColumn("coverage_avg", F.bround(sum(F.col(f"coverage_{c}") for c in profile.quality) / len(profile.quality), 2))
    each = near.select(F.concat_ws("|", "sensor_id", F.col("rank").cast("string")).alias("sensor_id"), "slot", there.alias("avail"))
    counts = gap_counts(classify(each, "avail", profile.isolated, profile.medium)).withColumnRenamed("sensor_id", "_key")
    return out.withColumn("_key", F.concat_ws("|", "sensor_id", F.col("rank").cast("string"))).join(counts, "_key").drop("_key")


def reliability(main: DataFrame, near: DataFrame, profile: Profile) -> DataFrame:
    """(sensor_id, rank, reliability): 0.6 coverage + 0.4 share of the target's missing rows that the neighbour has."""
    share = sum(F.col(c).isNotNull().cast("double") for c in profile.quality) / len(profile.quality)
    x = near.join(main.select("sensor_id", "slot", F.col(profile.ref).isNull().alias("_miss")), ["sensor_id", "slot"]).withColumn("_s", share)
    overlap = F.count_if(F.col("_miss") & (F.col("_s") > 0)) / F.greatest(F.count_if(F.col("_miss")), F.lit(1))
    return x.groupBy("sensor_id", "rank").agg(F.bround(0.6 * F.avg("_s") + 0.4 * overlap, 4).alias("reliability"))


def batches(topology: DataFrame, sensors: DataFrame, size: int) -> DataFrame:
    """(device_id, cluster, batch_id): sensors in order of their sorted neighbours, ``size`` to a batch.

    The order is numbered without one task for all: counts of each cluster are summed up over a summary of clusters and added to ranks inside.
    """
    if size < 1:
        raise ValueError("a batch holds one sensor at least")
    names = topology.groupBy("target_id").agg(F.array_join(F.array_sort(F.collect_set("neighbor_id")), "|").alias("cluster"))
    x = sensors.join(names, F.col("device_id") == F.col("target_id"), "left").select("device_id", F.coalesce("cluster", F.lit("~none~")).alias("cluster"))
    counts = x.groupBy("cluster").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(W.orderBy("cluster").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inside = F.row_number().over(W.partitionBy("cluster").orderBy("device_id"))
    return x.join(counts.drop("n"), "cluster").select("device_id", "cluster", F.floor((F.col("before") + inside - 1) / size).alias("batch_id"))
