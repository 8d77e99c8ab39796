"""Runs over many sensors: which to do, what became of each, what is stored, when a run has failed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.config import PRODUCTION, Profile
from tidegrid.functions.scalars import key_parts
from tidegrid.functions.stage import written
from tidegrid.operators import grid, ingest, neighbors, state
from tidegrid.plans import pipeline

FAILED = "error"
#: Attributes that written rows take over from the sensor's newest original row. Fixed values.
IDENTITY = ("Topic", "Latitude", "Longitude", "IMEINumber", "FirmwareVersion")


def discover(topology: DataFrame, key: str = "deviceId_topic", keys: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """(pos, key, sensor_id, topic) of the sensors to run, each once, in order: explicit ``keys``, or all of the topology; ``limit`` counts before repeats go."""
    spark = topology.sparkSession
    if keys is not None:
        x = spark.createDataFrame(list(enumerate(keys)), "pos long, key string")
    else:
        x = topology.where(F.col(key).isNotNull()).select(F.col(key).alias("key")).withColumn("pos", F.monotonically_increasing_id())
    a, b = key_parts(F.col("key"))
    return ingest.first_keys(x, limit).select("pos", "key", a.alias("sensor_id"), b.alias("topic"))


def metadata(meta: DataFrame, sensor: str) -> DataFrame:
    """(device_id, ref_col, status, rank, neighbor_id, distance_km) of one sensor's item with its nested neighbours; no rows if it is not there."""
    x = meta.where(F.col("device_id") == sensor).select("device_id", "ref_col", "status", F.posexplode_outer("neighbors").alias("rank", "n"))
    return x.select("device_id", "ref_col", "status", (F.col("rank") + 1).alias("rank"), F.col("n.id").alias("neighbor_id"), F.col("n.distance_km").alias("distance_km"))


@dataclass
class Batch:
    """results: a row for each key in order; table: the sensors' rows after the write; watermarks: after the run; frame: the reconstructed grids."""

    results: DataFrame
    table: DataFrame
    watermarks: DataFrame
    frame: DataFrame


def plan(keys: DataFrame, readings: DataFrame, watermarks: DataFrame, profile: Profile = PRODUCTION, minutes: float | None = None) -> DataFrame:
    """(pos, key, sensor_id, status, interval_min, last_ts): skipped_no_new_data, no_data, skipped_no_gaps or ok; sensors without a watermark have new data."""
    latest = readings.groupBy("sensor_id").agg(F.max("ts").alias("latest_ts"))
    latest = keys.select("sensor_id").distinct().join(latest, "sensor_id", "left")
    if minutes is None:
        intervals = grid.detect_interval(readings, profile.fallback_minutes).select("sensor_id", "interval_min")
    else:
        intervals = latest.select("sensor_id", F.lit(float(minutes)).alias("interval_min"))
    slots = ingest.round_dedup(readings.join(intervals, "sensor_id"), F.col("interval_min")).drop("interval_min")
    work = grid.work_check(grid.grid(slots, [profile.ref, *profile.rain]), profile.ref, list(profile.rain))
    said = state.statuses(latest, watermarks, work)
    return keys.join(said, "sensor_id").join(latest, "sensor_id").join(intervals, "sensor_id", "left").select("pos", "key", "sensor_id", "status", "interval_min", F.col("latest_ts").alias("last_ts"))


def run_batch(keys: DataFrame, obs: DataFrame, topology: DataFrame, watermarks: DataFrame, profile: Profile = PRODUCTION, minutes: float | None = None, unit: str | None = None, identity: tuple[str, ...] = IDENTITY) -> Batch:
    """All sensors of ``keys`` in one plan; obs holds readings and earlier fills, topology (target_id, neighbor_id, rank, dist_km) the neighbours.

    Only sensors with new readings and with work are reconstructed. Fills whose reference is there are written by conditional upsert, rounded
    to 4 digits, with the identity attributes that obs has; a sensor that should have a frame and has none is an error.
    """
    names = [*profile.continuous, *profile.rain]
    readings = written(pipeline.load_series(obs, profile, unit))
    todo = written(plan(keys, readings, watermarks, profile, minutes))
    targets = todo.where("status = 'ok'").select("sensor_id").distinct()
    done = pipeline.run(readings, topology, minutes, profile, targets=targets)
    frame = written(done.frame)
    width = todo.select("sensor_id", "interval_min").distinct()
    masked = state.persist_masks(frame, profile.ref).join(width, "sensor_id")
    ts = F.timestamp_micros(F.col("slot") * F.round(F.col("interval_min") * 60_000_000, 0).cast("long")).cast("timestamp_ntz")
    attributes = [c for c in identity if c in obs.columns]
    flags = {c: F.lit(None).cast(t) for c, t in (("imputation_method", "string"), ("filled_flag", "int")) if c not in obs.columns}
    stored = obs.withColumns(flags) if flags else obs
    newest = ingest.newest_original(stored).select("sensor_id", *attributes)
    new = masked.where("persistable").join(newest, "sensor_id", "left")
    new = new.select("sensor_id", ts.alias("ts"), *[F.bround(F.col(v), 4).alias(v) for v in names], *attributes, "imputation_method", "confidence_level", "filled_flag")
    old = stored.select(*[F.col(c) if c in stored.columns else F.lit(None).cast("string").alias(c) for c in new.columns])
    table, outcome = state.upsert(old, written(new), ["sensor_id", "ts"])
    wrote = outcome.groupBy("sensor_id").agg(F.count_if(F.col("outcome") == "written").alias("filled"), F.count_if(F.col("outcome") == "skipped_existing").alias("skipped_existing"))
    counts = masked.groupBy("sensor_id").agg(F.count("*").alias("rows"), F.count_if("unresolved").alias("unresolved"), (F.count_if("persistable") + F.count_if("unresolved")).alias("gap_count"))
    results = todo.join(counts, "sensor_id", "left").join(wrote, "sensor_id", "left")
    status = F.when((F.col("status") == "ok") & F.col("rows").isNull(), FAILED).otherwise(F.col("status"))
    zero = lambda c: F.when(F.col("status") == "ok", F.coalesce(c, F.lit(0))).alias(c)
    results = written(results.select("pos", "key", "sensor_id", status.alias("status"), zero("rows"), zero("filled"), zero("unresolved"), zero("skipped_existing"), zero("gap_count"), "interval_min", "last_ts"))
    marks = results.where("status IN ('ok', 'skipped_no_gaps')").select("sensor_id", "last_ts", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gap_count", "filled", "unresolved")])
    marks = marks.dropDuplicates(["sensor_id"])
    for c in ("gap_count", "filled", "unresolved"):
        watermarks = watermarks if c in watermarks.columns else watermarks.withColumn(c, F.lit(None).cast("long"))
    return Batch(results, table, state.merge_watermarks(watermarks.select(*marks.columns), marks), frame)


def summary(results: DataFrame) -> DataFrame:
    """One row: sensors by status, sensors that had a row written (reconstructed), filled and unresolved slots."""
    statuses = ("ok", "skipped_no_gaps", "skipped_no_new_data", "no_data", FAILED)
    return results.agg(F.count("*").alias("sensors"), F.count_if((F.col("status") == "ok") & (F.col("filled") >= 1)).alias("reconstructed"), *[F.count_if(F.col("status") == s).alias(s) for s in statuses], F.coalesce(F.sum("filled"), F.lit(0)).alias("filled"), F.coalesce(F.sum("unresolved"), F.lit(0)).alias("unresolved"))


def exit_code(results: DataFrame) -> int:
    """1 if every sensor failed, else 0; no sensors: 0."""
    n, failed = results.agg(F.count("*"), F.count_if(F.col("status") == FAILED)).first()
    return int(n > 0 and n == failed)


def run_sensor(key: str | None, obs: DataFrame, topology: DataFrame, profile: Profile = PRODUCTION, minutes: float | None = None) -> tuple[int, Batch | None]:
    """(exit code, outcome) of one sensor, whatever its watermark: 2 without a key, 1 unless it is reconstructed or has no gaps."""
    if not key:
        return 2, None
    spark = obs.sparkSession
    keys = discover(topology, keys=[key])
    none = spark.createDataFrame([], "sensor_id string, last_ts timestamp_ntz")
    batch = run_batch(keys, obs, topology, none, profile, minutes)
    good = batch.results.where("status IN ('ok', 'skipped_no_gaps')").count()
    return (0 if good else 1), batch


def execution_summary(frame: DataFrame) -> DataFrame:
    """Per sensor: rows, a map of rows by method, filled rows."""
    by_method = frame.groupBy("sensor_id", "imputation_method").agg(F.count("*").alias("n"), F.sum("filled_flag").alias("f"))
    counts = F.map_from_entries(F.array_sort(F.collect_list(F.struct("imputation_method", "n"))))
    return by_method.groupBy("sensor_id").agg(F.sum("n").alias("rows_total"), counts.alias("method_counts"), F.sum("f").alias("filled_rows"))


def metric_lines(frame: DataFrame, now: int, namespace: str = "GapReconstruction") -> DataFrame:
    """(sensor_id, line): a JSON record of rows by method for a log that turns such lines into metrics."""
    methods = [*state.METHODS, "unresolved"]
    x = frame.groupBy("sensor_id").agg(*[F.count_if(F.col("imputation_method") == m).alias(m) for m in methods], F.count("*").alias("rows_total"))
    record = F.struct(F.lit(namespace).alias("namespace"), F.lit(now).cast("long").alias("timestamp"), "sensor_id", *methods, "rows_total")
    return x.select("sensor_id", F.to_json(record).alias("line"))


def cost(seconds: DataFrame, cores: float, gigabytes: float, per_core_hour: float, per_gigabyte_hour: float) -> DataFrame:
    """seconds(sensor_id, seconds) with usd: time at the price of a task's cores and memory."""
    hourly = cores * per_core_hour + gigabytes * per_gigabyte_hour
    return seconds.withColumn("usd", F.bround(F.col("seconds") / 3600.0 * hourly, 6))


def pack_batches(keys: DataFrame, size: int) -> DataFrame:
    """(batch_id, device_ids, size) of keys(pos, sensor_id) in order; the order is numbered over counts of ranges, not in one task."""
    if size < 1:
        raise ValueError("a batch holds one sensor at least")
    ranged = keys.withColumn("range", F.floor(F.col("pos") / 100_000))
    before = ranged.groupBy("range").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    at = F.col("before") + F.row_number().over(W.partitionBy("range").orderBy("pos")) - 1
    x = ranged.join(before.drop("n"), "range").withColumn("at", at).withColumn("batch_id", F.floor(F.col("at") / size))
    x = x.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("at", "sensor_id"))).alias("r"))
    return x.select("batch_id", F.transform("r", lambda r: r["sensor_id"]).alias("device_ids"), F.size("r").alias("size"))


def save_reports(folder: str, gaps: DataFrame, audit: DataFrame, quality: DataFrame, evaluation: DataFrame | None = None, selection: DataFrame | None = None) -> list[str]:
    """The reports as CSV files with header below ``folder``; those that are None are left out. Returns their paths."""
    out = []
    for name, df in (("gap_report", gaps), ("audit_report", audit), ("neighbor_quality", quality), ("evaluation_report", evaluation), ("model_selection", selection)):
        if df is not None:
            df.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")
            out.append(f"{folder}/{name}")
    return out


def dump(frame: DataFrame, folder: str, run_date: str, kind: str = "parquet", on: bool = True) -> str | None:
    """The whole frame for inspection, a folder for each run and sensor; nothing if it is switched off."""
    if not on:
        return None
    path = f"{folder}/filled/run_date={run_date}"
    frame.write.mode("overwrite").option("header", True).partitionBy("sensor_id").format(kind).save(path)
    return path


def topology_from_coordinates(spark: SparkSession, path: str, k: int = 2, most_km: float = 30.0) -> DataFrame:
    """(device_id, status, ref_col, neighbors) of a CSV file of device_id, latitude, longitude: the k nearest within most_km, nested, in order."""
    points = spark.read.option("header", True).csv(path).selectExpr("device_id id", "try_cast(latitude as double) lat", "try_cast(longitude as double) lon")
    near = neighbors.nearest(points.where("lat IS NOT NULL AND lon IS NOT NULL"), k, most_km)
    nested = near.groupBy("target_id").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("neighbor_id").alias("id"), F.col("dist_km").alias("distance_km")))).alias("n"))
    nested = nested.select(F.col("target_id").alias("device_id"), F.transform("n", lambda e: F.struct(e["id"].alias("id"), e["distance_km"].alias("distance_km"))).alias("neighbors"))
    return points.select(F.col("id").alias("device_id"), F.lit("ACTIVE").alias("status"), F.lit("CorrectedTemp").alias("ref_col")).join(nested, "device_id", "left")
