"""Job settings with defaults; unset keys keep them."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

# Where each setting lives in a nested settings file: section, key.
_FILE_KEYS = {
    "raw_dir": ("data", "raw_dir"),
    "interim_dir": ("data", "interim_dir"),
    "processed_dir": ("data", "processed_dir"),
    "transaction_file": ("data", "transaction_file"),
    "identity_file": ("data", "identity_file"),
    "test_size": ("split", "test_size"),
    "val_size": ("split", "val_size"),
    "missing_threshold": ("features", "missing_threshold"),
    "forest_trees": ("models.isolation_forest", "n_estimators"),
    "contamination": ("models.isolation_forest", "contamination"),
    "seed": ("models.isolation_forest", "random_state"),
    "patience": ("models.lightgbm", "early_stopping_rounds"),
    "search_trials": ("models.optuna", "n_trials"),
    "search_timeout": ("models.optuna", "timeout"),
}


@dataclass(frozen=True)
class Settings:
    raw_dir: str = "data/raw"
    interim_dir: str = "data/interim"
    processed_dir: str = "data/processed"
    transaction_file: str = "train_transaction.csv"
    identity_file: str = "train_identity.csv"
    test_size: float = 0.2
    val_size: float = 0.15
    missing_threshold: float = 0.7
    smoothing: float = 10.0
    forest_trees: int = 200
    forest_sample: int = 256
    contamination: float = 0.035
    seed: int = 42
    max_rounds: int = 5_000
    patience: int = 50
    search_trials: int = 50
    search_timeout: float | None = None
    search_sample: float = 0.3
    search_rounds: int = 300
    search_patience: int = 30
    explain_rows: int = 5_000

    @classmethod
    def from_mapping(cls, values: Mapping) -> "Settings":
        """Settings from a nested mapping; keys it lacks keep their default."""
        found = {}
        for name, (section, key) in _FILE_KEYS.items():
            node = values
            for part in section.split("."):
                node = (node or {}).get(part) or {}
            if node.get(key) is not None:
                found[name] = node[key]
        flat = {f.name for f in fields(cls)}
        found.update({k: v for k, v in values.items() if k in flat})
        return replace(cls(), **found)


def load_settings(path: str) -> Settings:
    """Read settings from a YAML file (or JSON, where no YAML reader is installed)."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    try:
        import yaml
    except ImportError:
        return Settings.from_mapping(json.loads(text))
    return Settings.from_mapping(yaml.safe_load(text) or {})
