"""Sessions and configuration."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Config:
    """Settings of a run; `load` reads them from YAML, unknown keys are an error."""

    window_s: float = 1.0
    id_pattern: str = r"^p?(\d+)$"
    id_separator: str = "_"
    start_from: str | None = None
    signals: tuple[str, ...] = ()
    thresholds: dict[str, Any] = field(default_factory=dict)
    format: str = "parquet"

    @classmethod
    def load(cls, path: str) -> Config:
        import yaml

        own = yaml.safe_load(Path(path).read_text()) or {}
        if unknown := set(own) - {f.name for f in fields(cls)}:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in own.items()})


def session(name: str = "tidegauge", **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; the cluster's own settings win where they are set."""
    builder = SparkSession.builder.appName(name)
    for k, v in {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.sources.partitionOverwriteMode": "dynamic", **conf}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
