"""Accuracy on gaps cut into known data."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.config import Profile
from tidegrid.functions.scalars import slot_time
from tidegrid.operators import trees
from tidegrid.operators.grid import by

BACK = 6


def test_rows(tracked: DataFrame, share: float = 0.8) -> DataFrame:
    """tracked with in_test: the slots of a sensor after the first ``share`` of its timeline."""
    x = tracked.withColumn("_i", F.row_number().over(by())).withColumn("_n", F.count("*").over(W.partitionBy("sensor_id")))
    return x.withColumn("in_test", F.col("_i") > F.floor(F.col("_n") * share)).drop("_i", "_n")


def candidates(tracked: DataFrame, size: int) -> DataFrame:
    """(sensor_id, start): blocks of ``size`` original test rows whose neighbours on both sides are original test rows too."""
    ok = (F.col("imputation_method") == "original") & F.col("in_test")
    around = by().rowsBetween(-1, size)
    return tracked.withColumn("_ok", F.sum(ok.cast("int")).over(around)).where(F.col("_ok") == size + 2).select("sensor_id", F.col("slot").alias("start"))


def sample(found: DataFrame, n: int = 150, seed: int = 42) -> DataFrame:
    """Per sensor ``n`` candidates with the least md5 of seed and start: a sampling operator, the same on every run."""
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("start").cast("string")))
    return found.withColumn("_r", F.row_number().over(W.partitionBy("sensor_id").orderBy(key, "start"))).where(F.col("_r") <= n).drop("_r")


def metrics(pairs: DataFrame, keys: list[str], least: int = 5) -> DataFrame:
    """n, MAE, RMSE, R2 (null where the truth is constant) and bias of pairs(y, predicted) per key, 4 digits; fewer than ``least`` are left out."""
    x = pairs.withColumn("_e", F.col("predicted") - F.col("y"))
    g = x.groupBy(*keys).agg(F.count("*").alias("n_samples"), F.avg(F.abs("_e")).alias("_a"), F.avg(F.col("_e") * F.col("_e")).alias("_s"), F.var_pop("y").alias("_v"), F.avg("_e").alias("_b"))
    r4 = lambda c: F.bround(c, 4)
    return g.where(F.col("n_samples") >= least).select(*keys, "n_samples", r4(F.col("_a")).alias("mae"), r4(F.sqrt("_s")).alias("rmse"), r4(1 - F.col("_s") / F.nullif(F.col("_v"), F.lit(0.0))).alias("r2"), r4(F.col("_b")).alias("bias"))


def blocks(done: DataFrame, sizes: tuple[int, ...], n: int = 150, seed: int = 42, share: float = 0.8) -> DataFrame:
    """(sensor_id, size, start) of the synthetic gaps of each size, sampled in the tail of a reconstructed frame."""
    tail, out = test_rows(done, share), None
    for size in sizes:
        one = sample(candidates(tail, size), n, seed).withColumn("size", F.lit(size))
        out = one if out is None else out.unionByName(one)
    return out


def lags(before: np.ndarray, j: int) -> np.ndarray:
    """(lag_1..3, rolling mean, rolling deviation) of slot j of blocks whose last known values (carried forward) are ``before`` (rows of BACK): within the block the value before it repeats."""
    seen = np.concatenate([before, np.repeat(before[:, -1:], j, axis=1)], axis=1)[:, -BACK:]
    n = (~np.isnan(seen)).sum(axis=1)
    mean = np.nansum(seen, axis=1) / np.maximum(n, 1)
    std = np.sqrt(np.nansum((seen - mean[:, None]) ** 2, axis=1) / np.maximum(n - 1, 1))
    enough = n >= 3
    return np.column_stack([seen[:, -1], seen[:, -2], seen[:, -3], np.where(enough, mean, np.nan), np.where(enough, std, np.nan)])


def synthetic(done: DataFrame, gaps: DataFrame, kinds: DataFrame, minutes: float, profile: Profile, more: tuple[str, ...] = (), share: float = 0.8, rounds: int | None = None) -> DataFrame:
    """(sensor_id, var, size, slot, y, predicted): the chosen models (kinds(var, kind) or per sensor), fitted on the first ``share`` of each timeline only, on blocks hidden one at a time.

    Features see what comes before a block, carried forward, fills included. Predictions are clamped to the values beside the block, give or take
    the variable's jump threshold, then clipped. Blocks with a null value are left out; so are variables with fewer training rows than the profile asks for.
    A task holds one sensor's variable.
    """
    names, t = list(profile.continuous), slot_time(F.col("slot"), minutes)
    x = test_rows(done, share).select("sensor_id", "slot", "in_test", (F.col("imputation_method") == "original").alias("original"), F.hour(t).alias("hour"), F.weekday(t).alias("day_of_week"), F.month(t).alias("month"), *more, F.inline(F.array(*[F.struct(F.lit(v).alias("var"), F.col(v).alias("y")) for v in names])))
    x = x.join(kinds, [c for c in ("sensor_id", "var") if c in kinds.columns])
    each = gaps.select(F.col("sensor_id").alias("of"), F.explode(F.array(*[F.lit(v) for v in names])).alias("name"), "size", "start")
    empty = {"sensor_id": object, "var": object, "size": "int32", "slot": "int64", "y": float, "predicted": float}

    def run(rows: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({c: pd.Series(dtype=k) for c, k in empty.items()})
        if rows.empty or held.empty:
            return none
        rows = rows.sort_values("slot").reset_index(drop=True)
        v, y, test = rows["var"].iloc[0], rows["y"].to_numpy(float), rows["in_test"].to_numpy(bool)
        known = rows["y"].ffill().to_numpy(float)
        padded = np.concatenate([np.full(BACK, np.nan), known])
        before = np.lib.stride_tricks.sliding_window_view(padded, BACK)[: len(y)]
        rest = rows[["hour", "day_of_week", "month"]].to_numpy(float)
        near = rows[[c for c in more if rows[c].notna().any()]].to_numpy(float)
        f = np.column_stack([rest, lags(before, 0), near])
        good = rows["original"].to_numpy(bool) & ~test & ~np.isnan(y) & ~np.isnan(f).any(axis=1)
        if good.sum() < profile.least_training_rows:
            return none
        model, out = trees.fit(rows["kind"].iloc[0], f[good], y[good], rounds), []
        low, high = profile.clip.get(v, (-np.inf, np.inf))
        jump, first = profile.jump.get(v, 5.0), int(rows["slot"].iloc[0])
        for size, some in held.groupby("size"):
            at = np.sort(some["start"].to_numpy()) - first
            at = at[~np.isnan(y[at[:, None] + np.arange(size)]).any(axis=1)]
            side = np.stack([y[at - 1], y[at + size]], axis=1)
            clear = ~np.isnan(side).any(axis=1)
            for j in range(size):
                g = np.column_stack([rest[at + j], lags(before[at], j), near[at + j]])
                ok = ~np.isnan(g).any(axis=1)
                p = np.full(len(at), np.nan)
                if ok.any():
                    p[ok] = model.predict(g[ok])
                p = np.where(clear, np.clip(p, np.fmin(side[:, 0], side[:, 1]) - jump, np.fmax(side[:, 0], side[:, 1]) + jump), p)
                p = np.clip(p, low, high)
                out.append(pd.DataFrame({"sensor_id": rows["sensor_id"].iloc[0], "var": v, "size": np.int32(size), "slot": rows["slot"].to_numpy()[at[ok] + j], "y": y[at[ok] + j], "predicted": p[ok]}))
        return pd.concat(out) if out else none

    schema = "sensor_id string, var string, size int, slot long, y double, predicted double"
    return x.groupBy("sensor_id", "var").cogroup(each.groupBy("of", "name")).applyInPandas(run, schema)
