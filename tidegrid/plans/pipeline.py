"""The whole reconstruction as one plan over all sensors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.config import PRODUCTION, Profile
from tidegrid.functions.stage import written
from tidegrid.operators import fill, grid, ingest, models, neighbors, state


@dataclass
class Result:
    """A run's tables: the reconstructed grid, the readings behind it, what is known of neighbours, and the models (None where none were needed)."""

    frame: DataFrame
    readings: DataFrame
    quality: DataFrame
    reliability: DataFrame
    models: DataFrame | None


def load_series(obs: DataFrame, profile: Profile = PRODUCTION, unit: str | None = None, only: str | int | None = None) -> DataFrame:
    """Readings fit for a run: no rows that earlier runs wrote, one physical unit a sensor, sane times; needed columns only, absent ones null."""
    names = [*profile.continuous, *profile.rain]
    if profile.originals_only and {"imputation_method", "filled_flag"} & set(obs.columns):
        absent = {c: F.lit(None).cast(t) for c, t in (("imputation_method", "string"), ("filled_flag", "int")) if c not in obs.columns}
        obs = ingest.originals(obs.withColumns(absent) if absent else obs)
    if profile.one_unit and unit:
        obs = ingest.pick_unit(obs, profile.ref, unit, only)
    return ingest.sane(obs).select("sensor_id", "ts", "arrival", *[F.col(v) if v in obs.columns else F.lit(None).cast("double").alias(v) for v in names])


def prepare(obs: DataFrame, minutes: float | Column, profile: Profile = PRODUCTION) -> tuple[DataFrame, DataFrame]:
    """(slots, tracked): a row per sensor and slot, and the classified grid."""
    names = [v for v in (*profile.continuous, *profile.rain) if v in obs.columns]
    slots = ingest.round_dedup(ingest.sane(obs), minutes, by_time=profile.name == "production")
    main = grid.grid(slots, names)
    return slots, grid.track(grid.classify(main, profile.ref, profile.isolated, profile.medium))


def reconstruct(obs: DataFrame, topology: DataFrame, minutes: float | None = None, profile: Profile = PRODUCTION, **options) -> DataFrame:
    """The grid of run()."""
    return run(obs, topology, minutes, profile, **options).frame


def run(obs: DataFrame, topology: DataFrame, minutes: float | None = None, profile: Profile = PRODUCTION, unit: str | None = None, fitted: DataFrame | None = None, rounds: int | None = None, targets: DataFrame | None = None) -> Result:
    """obs (sensor_id, ts, arrival, variables; earlier fills and a unit if need be) reconstructed on each sensor's grid.

    In order: interval (``minutes``, the profile's, or each sensor's own), isolated gaps, medium gaps by models (``fitted``, or fitted here: the
    profile's fixed ones or a tournament's winners), long gaps from neighbours, rain, jumps. Each row has method, confidence and flag.
    With ``targets`` (sensor_id) only those are reconstructed; the others serve as neighbours. Tables are written where more than one later
    step reads them, so no step is planned twice.
    """
    names, minutes = list(profile.continuous), minutes or profile.interval_minutes
    readings = load_series(obs, profile, unit)
    detected = minutes is None
    if detected:
        readings = written(readings)
        intervals = written(grid.detect_interval(readings, profile.fallback_minutes).select("sensor_id", F.col("interval_min").alias("minutes")))
        slots = ingest.round_dedup(readings.join(intervals, "sensor_id"), F.col("minutes"), by_time=profile.name == "production").drop("minutes")
    else:
        slots = ingest.round_dedup(readings, minutes, by_time=profile.name == "production")
    slots = written(slots)
    mine = slots if targets is None else slots.join(targets.select("sensor_id"), "sensor_id", "left_semi")
    main = grid.classify(grid.grid(mine, [*names, *profile.rain]), profile.ref, profile.isolated, profile.medium)
    tracked = written(grid.track(main))
    near = neighbors.around_rounded(tracked, topology, readings, intervals, [*names, *profile.rain]) if detected else neighbors.around(tracked, topology, slots, [*names, *profile.rain])
    near = written(near)
    quality, rely = neighbors.quality(near, profile), written(neighbors.reliability(tracked, near, profile))

    lent = {v: v for v in (*profile.neighbour_features, *profile.rain[:1])}
    more = tuple(f"{v}_n{r}" for v in profile.neighbour_features for r in range(1, profile.ranks + 1))
    base = neighbors.attach(fill.interpolate_isolated(tracked, profile.ref, names), near, lent, profile.ranks)
    if detected:
        base = base.join(intervals, "sensor_id")
    base, every = written(base), F.col("minutes") if detected else minutes
    if fitted is None:
        fitted = fit(base, every, profile, more, rounds)
    x = models.apply_medium(base, models.fill_medium(base, fitted, every, profile, names, more), names)
    x = fill.apply_long(x, fill.long_gap_values(tracked, near, rely, profile), profile)
    if profile.rain:
        x = fill.rain_zero(x, list(profile.rain), [f"{profile.rain[0]}_n{r}" for r in range(1, profile.ranks + 1)], profile.rain_needs_evidence, profile.ref if profile.rain_needs_evidence else None)
    flagged = written(fill.jump_flags(x.drop(*(f"{v}_n{r}" for v in lent for r in range(1, profile.ranks + 1))), profile.jump))
    done = state.sync_flags(fill.correct_jumps(flagged, list(profile.jump)))
    return Result(state.finalise(done.drop("minutes") if detected else done), readings, quality, rely, fitted)


def fit(base: DataFrame, minutes: float | Column, profile: Profile, more: tuple[str, ...] = (), rounds: int | None = None) -> DataFrame:
    """Models of the variables that medium gaps need, written: a tournament's winners refitted on all rows, or the fixed ones."""
    names = list(profile.continuous)
    rows = models.all_features(base, names, minutes, more).join(models.wanted(base, names), ["sensor_id", "var"], "left_semi")
    if profile.tournament:
        rows = written(rows)
        scores = models.tournament(rows, profile.models, profile.folds, rounds, more, profile.least_training_rows)
        kinds = models.best_models(scores, profile.models).select("sensor_id", "var", F.col("model").alias("kind"))
    else:
        kinds = models.chosen(names, profile, base.sparkSession)
    return written(models.fit_models(rows, kinds, profile, more, rounds))
