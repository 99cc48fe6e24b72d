"""Engine parameters. Passed explicitly; there is no global configuration."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class EngineConfig:
    # lag features
    lag_days: tuple[int, ...] = (1, 7, 14, 28)

    # fixed one-hot vocabularies
    store_types: tuple[str, ...] = ("a", "b", "c", "d")
    assortments: tuple[str, ...] = ("a", "b", "c")

    # training
    random_state: int = 42
    train_time_ratio: float = 0.8
    holdout_ratio: float = 0.15
    cv_splits: int = 3
    search_trials: int = 10

    # MAPE bands, percent
    mape_excellent: float = 10.0
    mape_good: float = 15.0

    # run monitoring
    max_stored_runs: int = 50
    freshness_hours: float = 24.0
    success_rate_alert: float = 80.0
    failure_streak_alert: int = 2

    # reporting
    top_features: int = 20
    top_stores: int = 15
    detail_rows: int = 1000


DEFAULT_CONFIG = EngineConfig()
