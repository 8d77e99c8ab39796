"""Isolated gaps, long gaps, rain, continuity: fills that need no model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.config import Profile
from tidegrid.functions.scalars import clipped
from tidegrid.operators.grid import by, gaps


def interpolate_isolated(tracked: DataFrame, ref: str, variables: list[str]) -> DataFrame:
    """In isolated gaps: each variable that is null after a value and before some later one, on the line to the next value. Rows whose reference is there now are tagged.

    The next value is the last one seen from the end, so that the frame runs and each row is read once.
    """
    later = W.partitionBy("sensor_id").orderBy(F.desc("slot")).rowsBetween(W.unboundedPreceding, -1)
    known = {v: F.nullif(F.col(v), F.lit(-99999.0)) for v in variables}
    out = tracked.withColumns({f"_next_{v}": F.last(F.when(x.isNotNull(), F.struct("slot", x.alias("v"))), ignorenulls=True).over(later) for v, x in known.items()})
    out = out.withColumns({f"_last_{v}": F.lag(x).over(by()) for v, x in known.items()})
    for v, x in known.items():
        last, ahead = F.col(f"_last_{v}"), F.col(f"_next_{v}")
        value = last + (ahead["v"] - last) / (ahead["slot"] - F.col("slot") + 1)
        out = out.withColumn(v, F.when((F.col("gap_type") == "isolated") & x.isNull(), value).otherwise(F.col(v)))
    out = out.drop(*(f"_{k}_{v}" for k in ("next", "last") for v in variables))
    return tag(out, (F.col("gap_type") == "isolated") & F.col(ref).isNotNull(), "interpolation", F.lit("High"))


def tag(df: DataFrame, when: Column, method: str, confidence: Column) -> DataFrame:
    return df.withColumn("confidence_level", F.when(when, confidence).otherwise(F.col("confidence_level"))).withColumn("imputation_method", F.when(when, F.lit(method)).otherwise(F.col("imputation_method"))).withColumn("filled_flag", F.when(when, 1).otherwise(F.col("filled_flag")))


def long_gap_values(tracked: DataFrame, around: DataFrame, reliability: DataFrame, profile: Profile) -> DataFrame:
    """(sensor_id, slot, var, filled, confidence) of long gaps, blended from neighbours.

    around: (sensor_id, rank, dist_km, slot, variables) of the neighbours on the target's slots. A neighbour's course over
    the gap, its edges included, is interpolated and laid between the target's own values beside the gap; weights are
    reliability, nearness and coverage. Gaps don't touch, so all are done at once.
    """
    names = list(profile.continuous)
    stack = f"stack({len(names)}, {', '.join(f"'{v}', {v}" for v in names)}) as (var, v)"
    long = gaps(tracked).where("gap_type = 'long'").select("sensor_id", "gap_id", "start", "end", "size")
    own = tracked.selectExpr("sensor_id", "slot", stack)
    wide = long.withColumn("var", F.explode(F.array(*[F.lit(v) for v in names])))
    edge = lambda at, name: own.select("sensor_id", F.col("slot").alias(at), "var", F.col("v").alias(name))
    wide = wide.withColumn("_p", F.col("start") - 1).withColumn("_n", F.col("end") + 1)
    wide = wide.join(edge("_p", "p"), ["sensor_id", "_p", "var"], "left").join(edge("_n", "n"), ["sensor_id", "_n", "var"], "left")
    near = around.select("sensor_id", "rank", "dist_km").distinct()
    rows = wide.join(near, "sensor_id").select("*", F.explode(F.sequence("_p", "_n")).alias("slot"))
    seen = around.selectExpr("sensor_id", "rank", "slot", stack).withColumnRenamed("v", "raw")
    rows = rows.join(seen, ["sensor_id", "rank", "slot", "var"], "left").withColumn("pos", F.col("slot") - F.col("_p"))
    part = W.partitionBy("sensor_id", "gap_id", "var", "rank")
    inside = F.when(F.col("pos").between(1, F.col("size")), F.col("raw"))
    rows = rows.withColumn("cov", F.count(inside).over(part))
    known = F.coalesce(F.col("raw"), F.when(F.col("pos") == 0, F.min_by(inside, F.when(inside.isNotNull(), F.col("pos"))).over(part)), F.when(F.col("pos") == F.col("size") + 1, F.max_by(inside, F.when(inside.isNotNull(), F.col("pos"))).over(part)))
    rows = rows.withColumn("known", known).where("cov > 0")
    point = F.when(F.col("known").isNotNull(), F.struct("pos", "known"))
    rows = rows.withColumn("last", F.last(point, ignorenulls=True).over(part.orderBy("pos").rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.withColumn("next", F.last(point, ignorenulls=True).over(part.orderBy(F.desc("pos")).rowsBetween(W.unboundedPreceding, 0)))  # from the end: a running frame
    line = F.expr("last.known + (next.known - last.known) * (pos - last.pos) / (next.pos - last.pos)")
    rows = rows.withColumn("t", F.when(F.col("known").isNotNull(), F.col("known")).otherwise(line))
    rows = rows.withColumn("mn", F.min("t").over(part)).withColumn("mx", F.max("t").over(part))
    frac = F.when(F.col("mx") - F.col("mn") < 0.3, F.col("pos") / (F.col("size") + 1)).otherwise((F.col("t") - F.col("mn")) / F.nullif(F.col("mx") - F.col("mn"), F.lit(0.0)))
    rec = F.when(F.col("p").isNotNull() & F.col("n").isNotNull(), F.col("p") + frac * (F.col("n") - F.col("p"))).otherwise(F.col("t"))
    near_ = F.lit(1.0) / F.greatest(F.col("dist_km"), F.lit(profile.least_distance)) if profile.least_distance else F.when(F.coalesce(F.col("dist_km"), F.lit(0.0)) == 0, 0.0).otherwise(1.0 / F.nullif(F.col("dist_km"), F.lit(0.0)))
    rows = rows.where("pos BETWEEN 1 AND size").join(reliability, ["sensor_id", "rank"], "left")
    rows = rows.withColumn("rec", rec).withColumn("w", F.coalesce("reliability", F.lit(0.0)) * near_ * F.col("cov") / F.col("size"))
    total = F.sum("w")
    mix = F.sum(F.col("rec") * F.col("w")) / F.nullif(total, F.lit(0.0))
    if profile.zero_weight_is_floor:
        mix = F.when(total == 0, F.sum(F.col("rec") * F.col("w"))).otherwise(mix)
    out = rows.groupBy("sensor_id", "slot", "var").agg(mix.alias("mix"), F.count("*").alias("sources"))
    fill = F.lit(None).cast("double")
    for v in names:
        fill = F.when(F.col("var") == v, clipped(F.col("mix"), profile.clip.get(v))).otherwise(fill)
    return out.select("sensor_id", "slot", "var", fill.alias("filled"), F.when(F.col("sources") == 2, "Medium").otherwise("Low").alias("confidence"))


def apply_long(tracked: DataFrame, values: DataFrame, profile: Profile) -> DataFrame:
    """Writes the blended values into long gaps, present ones included; a row's confidence is that of its last variable with a value."""
    names = list(profile.continuous)
    order = F.lit(0)
    for k, v in enumerate(names):
        order = F.when(F.col("var") == v, F.lit(k)).otherwise(order)
    wide = values.where("filled IS NOT NULL").groupBy("sensor_id", "slot").agg(F.max_by("confidence", order).alias("_conf"), *[F.max(F.when(F.col("var") == v, F.col("filled"))).alias(f"_{v}") for v in names])
    out = tracked.join(wide, ["sensor_id", "slot"], "left")
    out = tag(out, F.col("_conf").isNotNull(), "neighbor", F.col("_conf"))
    return out.withColumns({v: F.coalesce(F.col(f"_{v}"), F.col(v)) for v in names}).drop("_conf", *[f"_{v}" for v in names])


def rain_zero(main: DataFrame, variables: list[str], neighbours: list[str], evidence: bool, ref: str | None = None) -> DataFrame:
    """Null rain to 0. Without evidence: no rain within three slots nor at a neighbour, nulls counting as dry. With: some reading there and none above 0, and the row not unresolved."""
    frame = by().rowsBetween(-3, 3)
    out = main
    for v in variables:
        if evidence:
            near = F.greatest(F.max(v).over(frame), *[F.col(n) for n in neighbours]) if neighbours else F.max(v).over(frame)
            dry = near <= 0
            if ref:
                dry = dry & ~((F.col("imputation_method") != "original") & F.col(ref).isNull())
        else:
            dry = F.max(F.coalesce(v, F.lit(0.0))).over(frame) == 0
            for n in neighbours:
                dry = dry & (F.coalesce(n, F.lit(0.0)) == 0)
        out = out.withColumn(f"_{v}", F.when(F.col(v).isNull() & F.coalesce(dry, F.lit(False)), 0.0).otherwise(F.col(v)))
    return out.drop(*variables).withColumnsRenamed({f"_{v}": v for v in variables})


def jump_flags(df: DataFrame, variables: dict[str, float]) -> DataFrame:
    """jump_{v}: a filled row that differs from the row before or after by more than the threshold."""
    out = df
    for v, most in variables.items():
        far = lambda other: F.coalesce(F.abs(F.col(v) - other.over(by())) > most, F.lit(False))  # noqa: B023, E731
        out = out.withColumn(f"jump_{v}", (F.col("imputation_method") != "original") & (far(F.lag(v)) | far(F.lead(v))))
    return out


def correct_jumps(flagged: DataFrame, variables: list[str]) -> DataFrame:
    """Flagged rows (jump_{v}) in time order: 0.6 x + 0.4 mean(row before, already corrected, and row after, not yet).

    Runs of flagged rows are folded; a run needs only its own rows and one on either side. All variables go in one pass.
    """
    x = flagged.select("sensor_id", "slot", *variables, *(f"jump_{v}" for v in variables))
    around = []
    for v in variables:
        jump = F.col(f"jump_{v}")
        fresh = F.coalesce((~(jump.eqNullSafe(F.lag(jump).over(by())))).cast("int"), F.lit(1))
        x = x.withColumns({f"_b_{v}": F.lag(v).over(by()), f"_a_{v}": F.lead(v).over(by()), f"_n_{v}": fresh})
        around.append(F.struct(F.lit(v).alias("var"), jump.alias("jump"), F.col(f"_run_{v}").alias("run"), F.struct("slot", F.col(v).alias("x"), F.col(f"_b_{v}").alias("b"), F.col(f"_a_{v}").alias("a")).alias("row")))
    x = x.withColumns({f"_run_{v}": F.sum(f"_n_{v}").over(by()) for v in variables})
    hot = x.select("sensor_id", F.inline(F.array(*around))).where("jump").groupBy("sensor_id", "var", "run").agg(F.array_sort(F.collect_list("row")).alias("r"))

    def step(acc: Column, e: Column) -> Column:
        before = F.when(F.size(acc["out"]) == 0, e["b"]).otherwise(acc["prev"])
        mean = F.when(before.isNotNull() & e["a"].isNotNull(), (before + e["a"]) / 2).otherwise(F.coalesce(before, e["a"]))
        new = F.when(e["x"].isNull(), e["x"]).otherwise(F.coalesce(0.6 * e["x"] + 0.4 * mean, e["x"]))
        return F.struct(F.concat(acc["out"], F.array(F.struct(e["slot"].alias("slot"), new.alias("v")))).alias("out"), new.alias("prev"))

    start = F.struct(F.expr("cast(array() as array<struct<slot:bigint,v:double>>)").alias("out"), F.lit(None).cast("double").alias("prev"))
    new = hot.select("sensor_id", "var", F.explode(F.aggregate("r", start, step, lambda acc: acc["out"])).alias("e"))
    new = new.groupBy("sensor_id", F.col("e.slot").alias("slot")).agg(*[F.max(F.when(F.col("var") == v, F.col("e.v"))).alias(f"_new_{v}") for v in variables])
    out = flagged.join(new, ["sensor_id", "slot"], "left")
    return out.withColumns({v: F.when(F.col(f"jump_{v}"), F.col(f"_new_{v}")).otherwise(F.col(v)) for v in variables}).drop(*(f"_new_{v}" for v in variables))
