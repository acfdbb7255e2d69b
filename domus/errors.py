"""Exceptions raised by domus operators."""

from __future__ import annotations


class DomusError(Exception):
    """Base class."""


class ConfigError(DomusError):
    """The session lacks a setting that a cluster run needs."""


class DataError(DomusError):
    """Input data is missing or malformed (no files, bad header)."""


class ContractError(DomusError):
    """A data contract was violated; ``violations`` holds (rule, column, n_bad)."""

    def __init__(self, message: str, violations: list[tuple[str, str, int]] | None = None):
        super().__init__(message)
        self.violations = violations or []


class StorageError(DomusError):
    """Table store failure (bad name, missing table)."""


class FeatureError(DomusError):
    """Feature pipeline misuse (transform before fit, no target)."""


class TrainingError(DomusError):
    """Training, split, calibration or evaluation failure."""


class MonitoringError(DomusError):
    """Drift detection cannot run (empty input, no shared columns)."""


class RegistryError(DomusError):
    """Registry or promotion failure."""


class ModelNotFoundError(RegistryError):
    """No version at the requested stage."""


class ModelNotLoadedError(DomusError):
    """Model and version could not be loaded together."""


class LocationError(DomusError):
    """Unknown district choice for a city."""
