"""Job configuration: the data-relevant keys, typed and bounds-checked."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, replace
from pathlib import Path
from typing import Any

CONFIG_ENV = "LABELLOOM_CONFIG"


@dataclass(frozen=True)
class JobConfig:
    data_dir: str = "data/processed"
    output_dir: str = "outputs"
    label_mapping_file: str = "label_mapping.json"
    max_length: int = 256
    padding_side: str = "right"
    eval_batch_size: int = 8
    seed: int = 42
    max_train_samples: int | None = None
    metric_for_best_model: str = "f1_macro"
    eval_splits: tuple[str, ...] = ("validation", "test")
    max_eval_samples: int | None = None
    run_baseline: bool = True
    comparison_filename: str = "evaluation_comparison.json"
    val_size: float = 0.1
    dedupe: bool = True

    def __post_init__(self) -> None:
        if not 32 <= self.max_length <= 4096:
            raise ValueError("max_length must lie between 32 and 4096")
        if self.padding_side not in ("left", "right"):
            raise ValueError("padding_side must be 'left' or 'right'")
        if self.eval_batch_size < 1:
            raise ValueError("eval_batch_size must be at least 1")
        if not 0.0 < self.val_size < 1.0:
            raise ValueError("val_size must lie strictly between 0 and 1")
        if not self.eval_splits:
            raise ValueError("eval_splits must name at least one split")
        for name in ("max_train_samples", "max_eval_samples"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} must be at least 1")

    def override(self, **changes: Any) -> JobConfig:
        """A copy with the given values; None leaves a value as it is."""
        return replace(self, **{k: v for k, v in changes.items() if v is not None})

    @classmethod
    def load(cls, path: str | None = None, root: str | None = None) -> JobConfig:
        """Read the sections ``paths``, ``model``, ``training``, ``evaluation``
        and ``preprocess`` of a JSON file; keys without a meaning here are
        ignored. The path may come from the environment. Relative folders are
        taken from ``root`` (the folder of the file)."""
        chosen = path or os.environ.get(CONFIG_ENV)
        if chosen is None:
            return cls()
        file = Path(chosen).expanduser()
        if not file.is_file():
            raise FileNotFoundError(f"Config file not found: {file}")
        data = json.loads(file.read_text(encoding="utf-8"))
        base = root or str(file.resolve().parent)
        values: dict[str, Any] = {}
        for section, keys in _KEYS.items():
            for key, field in keys.items():
                if key in data.get(section, {}):
                    values[field] = data[section][key]
        for field in ("data_dir", "output_dir"):
            if field in values:
                values[field] = _resolve(values[field], base)
        if "eval_splits" in values:
            values["eval_splits"] = tuple(values["eval_splits"])
        return cls(**values)


# Section and key names of the configuration file.
_KEYS = {
    "paths": {
        "data_dir": "data_dir",
        "output_dir": "output_dir",
        "label_mapping_file": "label_mapping_file",
    },
    "model": {"max_length": "max_length", "padding_side": "padding_side"},
    "training": {
        "seed": "seed",
        "max_train_samples": "max_train_samples",
        "metric_for_best_model": "metric_for_best_model",
        "per_device_eval_batch_size": "eval_batch_size",
    },
    "evaluation": {
        "splits": "eval_splits",
        "max_eval_samples": "max_eval_samples",
        "run_baseline_before_training": "run_baseline",
        "comparison_filename": "comparison_filename",
    },
    "preprocess": {"val_size": "val_size", "dedupe": "dedupe"},
}


def _resolve(folder: str, base: str) -> str:
    """Absolute paths and URIs stay as they are."""
    if "://" in folder or folder.startswith("/"):
        return folder
    return f"{base.rstrip('/')}/{folder}"
