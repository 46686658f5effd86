"""Settings of the mixing and stitching steps, and how they are read from JSON."""

from __future__ import annotations

import json
from dataclasses import dataclass


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class MixConfig:
    version: str = "v1"
    thrust_scan_points: int = 180
    hist_bins: int = 90
    n_jets: int = 5

    def __post_init__(self):
        if not isinstance(self.version, str):
            raise ConfigError("metadata.version must be a string")
        for name, least in (("thrust_scan_points", 2), ("hist_bins", 1), ("n_jets", 1)):
            value = getattr(self, name)
            if isinstance(value, bool) or not isinstance(value, int):
                raise ConfigError(f"mixer.{name} must be an integer, not {type(value).__name__}")
            if value < least:
                raise ConfigError(f"mixer.{name} must be {least} or more")

    @classmethod
    def from_dict(cls, raw: dict) -> MixConfig:
        """From {"metadata": {"version"}, "mixer": {"thrust_scan_points", "hist_bins", "n_jets"}}, all required."""
        needed = {"metadata": ("version",), "mixer": ("thrust_scan_points", "hist_bins", "n_jets")}
        for section, keys in needed.items():
            if section not in raw:
                raise ConfigError(f"no section {section}")
            for key in keys:
                if key not in raw[section]:
                    raise ConfigError(f"no key {section}.{key}")
        return cls(**{k: raw[s][k] for s, keys in needed.items() for k in keys})

    @classmethod
    def load(cls, path: str) -> MixConfig:
        try:
            with open(path) as f:
                return cls.from_dict(json.load(f))
        except FileNotFoundError:
            raise ConfigError(f"no such config: {path}") from None
        except json.JSONDecodeError as e:
            raise ConfigError(f"invalid JSON in {path}: {e}") from None


@dataclass(frozen=True)
class StitchConfig:
    max_distance: float | None = 0.5
    pt_tolerance: float | None = 0.10
    seed: int = 42
    jets_per_hemisphere: int = 3
    scan_points: int = 180
    distance_bins: int = 100
