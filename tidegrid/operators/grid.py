"""Regular grid per sensor, and its gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def by() -> WindowSpec:
    """The rows of a sensor in order of time."""
    return W.partitionBy("sensor_id").orderBy("slot")


def dominant_interval(obs: DataFrame, nominal: float = 5.0, digits: int | None = None) -> DataFrame:
    """Per sensor: the most frequent difference of consecutive distinct times in minutes (least on a tie; digits: rounded half even, positive ones only) and whether it is nominal."""
    x = obs.select("sensor_id", "ts").distinct()
    diff = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lag("ts").over(W.partitionBy("sensor_id").orderBy("ts")).cast("timestamp"))) / 6e7
    x = x.withColumn("minutes", diff if digits is None else F.bround(diff, digits)).where("minutes > 0")
    best = x.groupBy("sensor_id", "minutes").agg(F.count("*").alias("n")).groupBy("sensor_id").agg(F.max_by(F.struct("minutes", "n"), F.struct(F.col("n"), -F.col("minutes"))).alias("b"))
    return best.select("sensor_id", "b.minutes", "b.n", (F.abs(F.col("b.minutes") - nominal) < 0.1).alias("is_nominal"))


def detect_interval(obs: DataFrame, fallback: float = 5.0) -> DataFrame:
    """Per sensor (interval_min, freq): freq is '{n}min' for whole minutes, else '{seconds}s'."""
    known = dominant_interval(obs, digits=3).select("sensor_id", "minutes")
    x = obs.select("sensor_id").distinct().join(known, "sensor_id", "left").select("sensor_id", F.coalesce("minutes", F.lit(fallback)).alias("interval_min"))
    whole = F.col("interval_min") == F.floor("interval_min")
    return x.withColumn("freq", F.when(whole, F.concat(F.col("interval_min").cast("long").cast("string"), F.lit("min"))).otherwise(F.concat(F.bround(F.col("interval_min") * 60, 0).cast("long").cast("string"), F.lit("s"))))


def grid(slots: DataFrame, variables: list[str], stretch: int = 4096) -> DataFrame:
    """All slots between the first and last of each sensor, with the variables observed there. Slots are made stretch by stretch, so that no row holds a whole timeline."""
    ends = slots.groupBy("sensor_id").agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    line = ends.select("sensor_id", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / stretch), F.floor(F.col("hi") / stretch))).alias("part"))
    line = line.select("sensor_id", F.explode(F.sequence(F.greatest("lo", F.col("part") * stretch), F.least("hi", F.col("part") * stretch + (stretch - 1)))).alias("slot"))
    return line.join(slots.select("sensor_id", "slot", *variables), ["sensor_id", "slot"], "left")


def missing_report(main: DataFrame, ref: str) -> DataFrame:
    return main.groupBy("sensor_id").agg(F.count("*").alias("expected"), F.count(ref).alias("actual"), (F.count("*") - F.count(ref)).alias("missing"))


def classify(main: DataFrame, ref: str, isolated: int = 1, medium: int = 5) -> DataFrame:
    """main with gap_id (number of the run, counted over all runs), gap_size, gap_type; rows with a value have 0, 0, original."""
    miss = F.col(ref).isNull()
    x = main.withColumn("_new", F.coalesce((miss != F.lag(miss).over(by())).cast("int"), F.lit(1)))
    x = x.withColumn("_run", F.sum("_new").over(by()).cast("long"))
    x = x.withColumn("_size", F.count("*").over(W.partitionBy("sensor_id", "_run")))
    kind = F.when(~miss, "original").when(F.col("_size") <= isolated, "isolated").when(F.col("_size") <= medium, "medium").otherwise("long")
    return x.withColumn("gap_type", kind).withColumn("gap_id", F.when(miss, F.col("_run")).otherwise(F.lit(0)).cast("long")).withColumn("gap_size", F.when(miss, F.col("_size")).otherwise(F.lit(0)).cast("int")).drop("_new", "_run", "_size")


def gaps(classified: DataFrame) -> DataFrame:
    """(sensor_id, gap_id, start, end, size, gap_type)."""
    return classified.where("gap_id > 0").groupBy("sensor_id", "gap_id", "gap_type").agg(F.min("slot").alias("start"), F.max("slot").alias("end"), F.count("*").alias("size"))


def gap_report(classified: DataFrame) -> DataFrame:
    """Blocks and rows of each class; rows without a gap count as blocks."""
    label = F.when(F.col("gap_type") == "original", "no_gap").otherwise(F.col("gap_type"))
    per = classified.groupBy("sensor_id", label.alias("gap_class")).agg(F.count("*").alias("rows"), F.countDistinct(F.when(F.col("gap_id") > 0, F.col("gap_id"))).alias("b"), F.max("gap_size").cast("long").alias("largest"))
    return per.select("sensor_id", "gap_class", F.when(F.col("gap_class") == "no_gap", F.col("rows")).otherwise(F.col("b")).alias("blocks"), "rows", "largest")


def gap_counts(classified: DataFrame) -> DataFrame:
    """Per sensor: blocks of each kind of gap; a sensor without gaps has zeros."""
    blocks = classified.select("sensor_id", "gap_id", "gap_type").distinct()
    return blocks.groupBy("sensor_id").agg(*[F.count_if(F.col("gap_type") == t).alias(t) for t in ("isolated", "medium", "long")])


def work_check(main: DataFrame, ref: str, rain: list[str]) -> DataFrame:
    """Per sensor: has the reference a gap, has a rain column one, is there work. A sensor without any value has work, and null flags."""
    g = main.groupBy("sensor_id").agg(F.bool_or(F.col(ref).isNull()).alias("ref_gap"), F.coalesce(*[F.bool_or(F.col(c).isNull()) for c in rain], F.lit(False)).alias("rain_gap") if rain else F.lit(False).alias("rain_gap"))
    return g.withColumn("has_work", F.coalesce(F.col("ref_gap") | F.col("rain_gap"), F.lit(True)))


def track(classified: DataFrame) -> DataFrame:
    """With method, confidence and flag: original rows are certain, gaps unresolved."""
    there = F.col("gap_id") == 0
    return classified.withColumn("imputation_method", F.when(there, "original").otherwise("unresolved")).withColumn("confidence_level", F.when(there, "High").otherwise("unknown")).withColumn("filled_flag", F.when(there, 0).otherwise(1))
