"""Features, models and the fill of medium gaps.

A sensor's models are fitted on its own rows in one grouped task (``operators.trees``), and travel as rows (sensor_id, var,
kind, n, used, medians, model). The fill needs the rows beside medium gaps only: gaps within the look-back of each other
form islands, which go to tasks by stretches of the timeline, so that a sensor's size bounds no task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegrid.config import Profile
from tidegrid.functions.scalars import safe_name, slot_time
from tidegrid.operators import trees
from tidegrid.operators.grid import by
from tidegrid.operators.state import exists

FEATURES = ("hour", "day_of_week", "month", "lag_1", "lag_2", "lag_3", "rolling_mean", "rolling_std")
BACK = 6
#: Training rows of a sensor and variable that a fit takes, by hash of the slot.
TRAIN_ROWS = 200_000
STRETCH = 65_536
MODEL = "sensor_id string, var string, kind string, n long, used array<string>, medians array<double>, model binary"


def _columns(variable: str, minutes: float | Column) -> dict[str, Column]:
    o, frame = F.col(f"_o_{variable}"), by().rowsBetween(-BACK, -1)
    enough, t = F.count(o).over(frame) >= 3, slot_time(F.col("slot"), minutes)
    clock = {"hour": F.hour(t), "day_of_week": F.weekday(t), "month": F.month(t)}
    lags = {f"lag_{n}": F.lag(o, n).over(by()) for n in (1, 2, 3)}
    return {"y": o, **clock, **lags, "rolling_mean": F.when(enough, F.avg(o).over(frame)), "rolling_std": F.when(enough, F.stddev_samp(o).over(frame))}


def features(tracked: DataFrame, variable: str, minutes: float | Column, more: tuple[str, ...] = ()) -> DataFrame:
    """(sensor_id, slot, y, FEATURES, more): clock (Monday 0), the last three values and mean and deviation of the six rows before, from original rows only."""
    x = tracked.withColumn(f"_o_{variable}", F.when(F.col("imputation_method") == "original", F.col(variable)))
    return x.select("sensor_id", "slot", *[c.alias(n) for n, c in _columns(variable, minutes).items()], *more)


def all_features(tracked: DataFrame, variables: list[str], minutes: float | Column, more: tuple[str, ...] = ()) -> DataFrame:
    """(sensor_id, var, slot, y, FEATURES, more) of all variables in one pass over the rows."""
    x = tracked.withColumns({f"_o_{v}": F.when(F.col("imputation_method") == "original", F.col(v)) for v in variables})
    each = F.array(*[F.struct(F.lit(v).alias("var"), *[c.cast("double").alias(n) for n, c in _columns(v, minutes).items()]) for v in variables])
    return x.select("sensor_id", "slot", *more, each.alias("_e")).select("sensor_id", "slot", *more, F.inline("_e"))


def training_rows(feats: DataFrame, least: int = 100, more: tuple[str, ...] = ()) -> DataFrame:
    """Rows without any null; sensors with fewer than ``least`` go."""
    x = feats.na.drop(subset=["y", *FEATURES, *more])
    enough = x.groupBy("sensor_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select("sensor_id")
    return x.join(enough, "sensor_id", "left_semi")


def medians(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sensor_id").agg(*[F.percentile(c, 0.5).alias(c) for c in FEATURES])


def folds(rows: DataFrame, n: int = 3) -> DataFrame:
    """rows with rn, and fold f (1..n) as tested by expanding splits: the last n blocks of rows // (n + 1) are tested in turn on all rows before; fold 0 is never tested."""
    x = rows.withColumn("rn", F.row_number().over(by())).withColumn("_n", F.count("*").over(W.partitionBy("sensor_id")))
    size = F.floor(F.col("_n") / (n + 1))
    first = F.col("_n") - n * size
    return x.withColumn("fold", F.when(F.col("rn") > first, F.floor((F.col("rn") - 1 - first) / size) + 1).otherwise(0).cast("int")).drop("_n")


def knn_errors(folded: DataFrame, n: int = 3) -> DataFrame:
    """(sensor_id, fold, slot, y, predicted) of nearest-neighbour models over expanding splits."""

    def run(x: pd.DataFrame) -> pd.DataFrame:
        x = x.sort_values("slot")
        f, q, y = x["fold"].to_numpy(), x[list(FEATURES)].to_numpy(float), x["y"].to_numpy(float)
        out = []
        for k in range(1, n + 1):
            test = np.flatnonzero(f == k)
            if len(test) and test[0]:
                p = trees.Nearest(q[: test[0]], y[: test[0]]).predict(q[test])
                out.append(pd.DataFrame({"sensor_id": x["sensor_id"].iloc[0], "fold": k, "slot": x["slot"].to_numpy()[test], "y": y[test], "predicted": p}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype=t) for c, t in (("sensor_id", object), ("fold", "int32"), ("slot", "int64"), ("y", float), ("predicted", float))})

    return folded.groupBy("sensor_id").applyInPandas(run, "sensor_id string, fold int, slot long, y double, predicted double")


def fold_scores(errors: DataFrame, model: str) -> DataFrame:
    """(sensor_id, model, mae): mean over folds of the mean absolute error."""
    per = errors.groupBy("sensor_id", "fold").agg(F.avg(F.abs(F.col("y") - F.col("predicted"))).alias("m"))
    return per.groupBy("sensor_id").agg(F.avg("m").alias("mae")).select("sensor_id", F.lit(model).alias("model"), "mae")


def best_models(scores: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """(sensor_id, var, model, mae): the least error, ties to the model named first."""
    rank = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return scores.groupBy("sensor_id", "var").agg(F.min(F.struct("mae", rank.alias("rank"), "model")).alias("b")).select("sensor_id", "var", "b.model", "b.mae")


def bounded(rows: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """rows(sensor_id, var, slot, ...) with about ``most`` of each sensor and variable, by hash of the slot; all where there are fewer."""
    n = rows.groupBy("sensor_id", "var").agg(F.count("*").alias("_n"))
    kept = rows.join(n, ["sensor_id", "var"]).where(F.pmod(F.xxhash64("slot"), F.lit(1 << 30)) * (F.col("_n") / F.lit(float(1 << 30))) < most)
    return kept.drop("_n")


def _known(x: pd.DataFrame, more: tuple[str, ...], least: int) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """(features, rows, y) that a fit takes, in order of time: neighbour features without any value go, then rows with a null; None if too few."""
    x = x.sort_values("slot")
    used = [*FEATURES, *(c for c in more if x[c].notna().any())]
    q, y = x[used].to_numpy(float), x["y"].to_numpy(float)
    good = ~(np.isnan(q).any(axis=1) | np.isnan(y))
    return (used, q[good], y[good]) if good.sum() >= least else None


def _splits(n: int, parts: int) -> list[tuple[int, int]]:
    """(first, end) of the tested blocks of expanding splits."""
    size = n // (parts + 1)
    return [(n - (parts - k) * size, n - (parts - k - 1) * size) for k in range(parts)]


def tournament(rows: DataFrame, models: tuple[str, ...], n: int = 3, rounds: int | None = None, more: tuple[str, ...] = (), least: int = 100) -> DataFrame:
    """(sensor_id, var, model, mae) of every model over expanding splits of rows as of all_features(); a task for each sensor, variable and model."""

    def run(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        known = _known(x, more, least)
        if not known:
            return pd.DataFrame({"sensor_id": [], "var": [], "model": [], "mae": []}).astype({"mae": float})
        _, q, y = known
        errors = [np.abs(trees.fit(key[2], q[:a], y[:a], rounds).predict(q[a:b]) - y[a:b]).mean() for a, b in _splits(len(y), n)]
        return pd.DataFrame({"sensor_id": [key[0]], "var": [key[1]], "model": [key[2]], "mae": [float(np.mean(errors))]})

    each = bounded(rows.na.drop(subset=["y", *FEATURES])).withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))
    return each.groupBy("sensor_id", "var", "model").applyInPandas(run, "sensor_id string, var string, model string, mae double")


def chosen(variables: list[str], profile: Profile, spark: SparkSession) -> DataFrame:
    """(var, kind): the fixed model of each variable."""
    return spark.createDataFrame([(v, profile.fixed_models.get(v, profile.default_model)) for v in variables], "var string, kind string")


def wanted(tracked: DataFrame, variables: list[str]) -> DataFrame:
    """(sensor_id, var) that need a model: with a null in a row of a medium gap."""
    g = tracked.where("gap_type = 'medium'").groupBy("sensor_id").agg(*[F.count_if(F.col(v).isNull()).alias(v) for v in variables])
    return g.selectExpr("sensor_id", f"stack({len(variables)}, {', '.join(f"'{v}', `{v}`" for v in variables)}) as (var, _n)").where("_n > 0").drop("_n")


def fit_models(rows: DataFrame, kinds: DataFrame, profile: Profile, more: tuple[str, ...] = (), rounds: int | None = None) -> DataFrame:
    """MODEL rows fitted on rows as of all_features(); kinds(var, kind) or (sensor_id, var, kind) names the models. Fewer rows than the profile asks for give none."""

    def run(key: tuple, x: pd.DataFrame) -> pd.DataFrame:
        known = _known(x, more, profile.least_training_rows)
        names = [c.split()[0] for c in MODEL.split(", ")]
        if not known:
            return pd.DataFrame({c: pd.Series(dtype=object) for c in names}).astype({"n": "int64"})
        used, q, y = known
        model = trees.fit(x["kind"].iloc[0], q, y, rounds)
        return pd.DataFrame([(key[0], key[1], x["kind"].iloc[0], len(y), used, np.median(q, axis=0).tolist(), trees.to_bytes(model))], columns=names)

    each = bounded(rows.na.drop(subset=["y", *FEATURES])).join(kinds, [c for c in ("sensor_id", "var") if c in kinds.columns])
    return each.groupBy("sensor_id", "var").applyInPandas(run, MODEL)


def save_models(fitted: DataFrame, path: str) -> None:
    """Stores models under their variable and a name safe for paths; later models replace earlier ones of the store."""
    fitted.withColumn("store_key", F.concat_ws("/", safe_name(F.col("sensor_id")), safe_name(F.col("var")))).write.mode("overwrite").parquet(path)


def load_models(spark: SparkSession, path: str) -> DataFrame | None:
    """The store's models, or None if there is none; any other failure is raised."""
    return spark.read.parquet(path).drop("store_key") if exists(spark, path) else None


def mapping_lines(fitted: DataFrame) -> DataFrame:
    """The text of a store: a line 'var -> kind' for each sensor's variable."""
    return fitted.select("sensor_id", F.concat_ws(" -> ", "var", "kind").alias("line"))


def fill_medium(tracked: DataFrame, fitted: DataFrame, minutes: float | Column, profile: Profile, variables: list[str], more: tuple[str, ...] = ()) -> DataFrame:
    """(sensor_id, slot, var, filled) for every slot of medium gaps of sensors that have a model for the variable.

    Blocks go by falling size, then time; each slot's features come from the values so far, fills included; a missing
    feature takes its training median; predictions are clipped and fed back. Blocks further apart than the look-back cannot see
    each other, so islands advance side by side, a slot at a time.
    """
    clip = {v: profile.clip.get(v, (-np.inf, np.inf)) for v in variables}
    t = slot_time(F.col("slot"), minutes)
    x = tracked.withColumn("_near", F.max((F.col("gap_type") == "medium").cast("int")).over(by().rowsBetween(0, BACK))).where("_near = 1")
    x = x.withColumn("island", F.col("slot") - F.row_number().over(by()))
    x = x.select("sensor_id", F.floor(F.col("island") / STRETCH).alias("stretch"), "slot", "island", (F.col("gap_type") == "medium").alias("medium"), "gap_id", "gap_size", F.hour(t).alias("hour"), F.weekday(t).alias("day_of_week"), F.month(t).alias("month"), *variables, *more)

    def run(rows: pd.DataFrame, models: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot").reset_index(drop=True)
        medium = np.flatnonzero(rows["medium"].to_numpy())
        out = []
        if len(medium) and len(models):
            island, size, gap = (rows[c].to_numpy()[medium] for c in ("island", "gap_size", "gap_id"))
            order = np.lexsort((medium, gap, -size, island))  # in an island: by size, then time
            rank = np.arange(len(order)) - np.searchsorted(island[order], island[order])
            steps = [medium[order[rank == k]] for k in range(rank.max() + 1)]
            for m in models.itertuples():
                model, middle, v = trees.from_bytes(m.model), np.array(m.medians, float), m.var
                # a null before each island, so that none looks into another
                work, place = _spread(rows[v].to_numpy(float), rows["island"].to_numpy())
                rest = rows[[c for c in m.used if c not in FEATURES]].to_numpy(float)
                clock = rows[["hour", "day_of_week", "month"]].to_numpy(float)
                for at in steps:
                    last = work[place[at][:, None] - np.arange(BACK, 0, -1)]
                    n = (~np.isnan(last)).sum(axis=1)
                    mean = np.where(n > 0, np.nansum(last, axis=1) / np.maximum(n, 1), np.nan)
                    std = np.sqrt(np.nansum((last - mean[:, None]) ** 2, axis=1) / np.maximum(n, 1))
                    f = np.column_stack([clock[at], last[:, -1], last[:, -2], last[:, -3], mean, np.where(n > 0, std, np.nan), rest[at]])
                    f = np.where(np.isnan(f), middle, f)
                    work[place[at]] = np.clip(model.predict(f), *clip[v])
                out.append(pd.DataFrame({"sensor_id": m.sensor_id, "slot": rows["slot"].to_numpy()[medium], "var": v, "filled": work[place[medium]]}))
        if out:
            return pd.concat(out)
        return pd.DataFrame({"sensor_id": pd.Series(dtype=object), "slot": pd.Series(dtype="int64"), "var": pd.Series(dtype=object), "filled": pd.Series(dtype=float)})

    fitted = fitted.select(F.col("sensor_id").alias("of"), *[c for c in fitted.columns if c != "sensor_id"])
    each = x.select(F.col("sensor_id").alias("at"), F.col("stretch").alias("part")).distinct().join(fitted, F.col("at") == F.col("of")).withColumnRenamed("of", "sensor_id")
    return x.groupBy("sensor_id", "stretch").cogroup(each.groupBy("at", "part")).applyInPandas(run, "sensor_id string, slot long, var string, filled double")


def _spread(values: np.ndarray, island: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values with BACK nulls before each island, and the place of each value there."""
    fresh = np.concatenate([[True], island[1:] != island[:-1]])[: len(island)]
    place = np.arange(len(values)) + BACK * np.cumsum(fresh)
    out = np.full(int(place[-1]) + 1 if len(place) else 0, np.nan)
    out[place] = values
    return out, place


def apply_medium(tracked: DataFrame, values: DataFrame, variables: list[str]) -> DataFrame:
    """Writes fills of medium gaps, present values included; rows with any are tagged model, Medium."""
    from tidegrid.operators.fill import tag

    wide = values.where("filled IS NOT NULL").groupBy("sensor_id", "slot").agg(F.lit(True).alias("_hit"), *[F.max(F.when(F.col("var") == v, F.col("filled"))).alias(f"_{v}") for v in variables])
    out = tag(tracked.join(wide, ["sensor_id", "slot"], "left"), F.col("_hit").isNotNull(), "model", F.lit("Medium"))
    return out.withColumns({v: F.coalesce(F.col(f"_{v}"), F.col(v)) for v in variables}).drop("_hit", *[f"_{v}" for v in variables])
