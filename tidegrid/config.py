"""Parameters of gap reconstruction: two profiles that differ in semantics, never blended."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Profile:
    """``research`` fixes the interval and rates neighbours by several columns; ``production`` detects it and reads one."""

    name: str = "production"
    ref: str = "value"
    continuous: tuple[str, ...] = ("value", "k")
    interval_minutes: float | None = None  # None: detected
    isolated: int = 1
    medium: int = 5
    quality: tuple[str, ...] = ("value",)
    models: tuple[str, ...] = ("xgb", "lgbm", "rf")
    folds: int = 3
    least_distance: float | None = None  # None: 1 / d, or 0 where d is 0 or absent
    zero_weight_is_floor: bool = True
    rain_needs_evidence: bool = True
    clip: dict[str, tuple[float, float]] = field(default_factory=lambda: {"value": (0.0, 500.0), "k": (0.0, 100.0)})
    jump: dict[str, float] = field(default_factory=lambda: {"value": 40.0, "k": 30.0})
    least_training_rows: int = 100
    rain: tuple[str, ...] = ()
    #: Neighbours' variables that models read; nearest neighbours first.
    neighbour_features: tuple[str, ...] = ("value",)
    ranks: int = 3
    #: Model of each variable where no tournament is held; others take ``default_model``.
    fixed_models: dict[str, str] = field(default_factory=lambda: {"value": "xgb", "k": "rf"})
    default_model: str = "xgb"
    tournament: bool = False
    originals_only: bool = True
    one_unit: bool = True
    fallback_minutes: float = 5.0


PRODUCTION = Profile()
RESEARCH = replace(PRODUCTION, name="research", interval_minutes=5.0, quality=("value", "k"), models=("xgb", "lgbm", "rf", "knn"), folds=5, least_distance=0.001, zero_weight_is_floor=False, rain_needs_evidence=False, tournament=True, originals_only=False, one_unit=False)

TRUE_WORDS = frozenset({"1", "true", "yes", "y", "on"})


def from_env(name: str, default: str | None = None, kind: type = str):
    """An environment setting as str, int or bool; without a default it must be set."""
    value = os.environ.get(name, default)
    if value is None:
        raise ValueError(f"{name} is not set")
    return value.strip().lower() in TRUE_WORDS if kind is bool else kind(value)


def from_yaml(path: str, profile: Profile = RESEARCH) -> Profile:
    """profile with the keys that a YAML file sets."""
    import yaml

    with open(path) as f:
        keys = yaml.safe_load(f) or {}
    known = {k: tuple(v) if isinstance(v, list) else v for k, v in keys.items() if k in Profile.__dataclass_fields__}
    if "clip" in known:
        known["clip"] = {k: tuple(v) for k, v in known["clip"].items()}
    return replace(profile, **known)


def check_neighbours(files: list, ids: list, distances: list) -> None:
    """Neighbour lists of unequal length are an error."""
    if not len(files) == len(ids) == len(distances):
        raise ValueError("neighbour files, ids and distances differ in number")
