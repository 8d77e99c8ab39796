"""Reports, write-back and control of incremental runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.stage import written

TRACKING = ("gap_type", "gap_id", "gap_size", "imputation_method", "confidence_level", "filled_flag")
METHODS = ("original", "interpolation", "model", "neighbor")


def finalise(df: DataFrame) -> DataFrame:
    """Without neighbour columns, tracking columns last."""
    keep = [c for c in df.columns if c not in TRACKING and not c[-3:-1] == "_n" and not c.startswith("jump_")]
    return df.select(*keep, *[c for c in TRACKING if c in df.columns])


def sync_flags(df: DataFrame) -> DataFrame:
    """filled_flag is 1 where the method is not original."""
    return df.withColumn("filled_flag", (F.col("imputation_method") != "original").cast("int"))


def method_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy("sensor_id", "imputation_method", "confidence_level").agg(F.count("*").alias("n"))


def audit(df: DataFrame, variables: list[str]) -> DataFrame:
    """Per sensor and variable: rows by method, and values still missing."""
    per = df.groupBy("sensor_id").agg(*[F.count_if(F.col("imputation_method") == m).alias(m) for m in METHODS], *[F.count_if(F.col(v).isNull()).alias(f"_{v}") for v in variables])
    return per.selectExpr("sensor_id", *METHODS, f"stack({len(variables)}, {', '.join(f"'{v}', _{v}" for v in variables)}) as (variable, still_missing)")


def persist_masks(df: DataFrame, ref: str) -> DataFrame:
    """df with persistable (filled and the reference there) and unresolved (other filled rows)."""
    done = F.col("imputation_method").isin("interpolation", "model", "neighbor") & F.col(ref).isNotNull()
    return df.withColumn("persistable", done).withColumn("unresolved", (F.col("imputation_method") != "original") & ~done)


def counts(df: DataFrame, ref: str) -> DataFrame:
    x = persist_masks(df, ref).groupBy("sensor_id").agg(F.count_if("persistable").alias("persistable"), F.count_if("unresolved").alias("unresolved"))
    return x.withColumn("gap_count", F.col("persistable") + F.col("unresolved"))


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(table after the write, outcome per key): a row is written if its key is free or holds an earlier fill (filled_flag 1), else skipped_existing."""
    old = existing.select(*keys, F.col("filled_flag").alias("_old"), F.lit(True).alias("_there"))
    met = new.join(old, keys, "left").withColumn("outcome", F.when(F.col("_there").isNull() | (F.col("_old") == 1), "written").otherwise("skipped_existing"))
    write = met.where("outcome = 'written'").select(*new.columns)
    return existing.join(write, keys, "left_anti").unionByName(write), met.select(*keys, "outcome")


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def upsert_into(path: str, new: DataFrame, keys: list[str], shards: int = 64) -> DataFrame:
    """Upserts ``new`` into the Parquet table at path, which is cut into ``shards`` by the hash of sensor_id; only the shards that new rows fall in are read and replaced. Returns the outcome per key."""
    spark = new.sparkSession
    new = new.withColumn("shard", F.pmod(F.xxhash64("sensor_id"), F.lit(shards)).cast("int"))
    touched = [r[0] for r in new.select("shard").distinct().collect()]  # at most ``shards``
    old = spark.read.parquet(path).where(F.col("shard").isin(touched)).select(*new.columns) if exists(spark, path) else new.limit(0)
    table, outcome = upsert(old, new, [*keys, "shard"])
    table, outcome = written(table), written(outcome.drop("shard"))
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard").parquet(path)
    return outcome


def new_data(latest: DataFrame, watermarks: DataFrame) -> DataFrame:
    """latest(sensor_id, latest_ts) with has_new: newer than the watermark, or no watermark or no time."""
    x = latest.join(watermarks.select("sensor_id", "last_ts"), "sensor_id", "left")
    return x.withColumn("has_new", F.coalesce(F.col("latest_ts") > F.col("last_ts"), F.lit(True)))


def statuses(latest: DataFrame, watermarks: DataFrame, work: DataFrame) -> DataFrame:
    """Per sensor: no_data, skipped_no_new_data, skipped_no_gaps or ok."""
    x = new_data(latest, watermarks).join(work.select("sensor_id", "has_work"), "sensor_id", "left")
    return x.select("sensor_id", F.when(F.col("latest_ts").isNull(), "no_data").when(~F.col("has_new"), "skipped_no_new_data").when(~F.coalesce("has_work", F.lit(True)), "skipped_no_gaps").otherwise("ok").alias("status"))


def merge_watermarks(old: DataFrame, new: DataFrame) -> DataFrame:
    """The later row of each sensor; on a tie the new one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    rest = [c for c in old.columns if c != "sensor_id"]
    return both.groupBy("sensor_id").agg(F.max_by(F.struct(*rest), F.struct("last_ts", "_new")).alias("r")).select("sensor_id", "r.*")


def retrain(registry: DataFrame, now: str, factor: float = 1.2) -> DataFrame:
    """Sensors to train again: forced, overdue or drifted (mae above ``factor`` times the baseline)."""
    why = F.when(F.col("forced"), "forced").when(F.col("next_train_after") <= F.lit(now).cast("timestamp_ntz"), "overdue").when(F.col("mae") > factor * F.col("baseline_mae"), "drift")
    return registry.withColumn("reason", why).where("reason IS NOT NULL").select("sensor_id", "reason")


def costs(runs: DataFrame) -> DataFrame:
    return runs.groupBy("project_tag", "run_date").agg(F.bround(F.sum("usd"), 4).alias("usd"), F.count("*").alias("runs"))


def run_results(runs: DataFrame, now: int, days: int = 180) -> DataFrame:
    """runs with the time after which a reader leaves them out."""
    return runs.withColumn("ttl", F.lit(now + days * 86400))
