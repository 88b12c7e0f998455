"""Named algorithms, chosen by a job's ``processing_config``."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame

from millrace.operators.metrics import moving_average_range, moving_average_rows

Algorithm = Callable[[DataFrame, dict[str, Any]], DataFrame]

_ALGORITHMS: dict[str, Algorithm] = {}


def register(name: str) -> Callable[[Algorithm], Algorithm]:
    """Decorator: make ``fn(df, params)`` available as ``name``."""

    def add(fn: Algorithm) -> Algorithm:
        if name in _ALGORITHMS:
            raise ValueError(f"algorithm {name} is already registered")
        _ALGORITHMS[name] = fn
        return fn

    return add


def run(df: DataFrame, config: dict[str, Any]) -> DataFrame:
    """Apply the algorithm named by ``config["algorithm"]``."""
    name = config.get("algorithm")
    if name not in _ALGORITHMS:
        raise ValueError(f"unknown algorithm: {name}")
    return _ALGORITHMS[name](df, config)


@register("moving_average")
def _moving_average(df: DataFrame, params: dict[str, Any]) -> DataFrame:
    """Over the last ``window_size`` rows, or the last ``window_seconds`` if given."""
    key, ts, value = params.get("key", "source_id"), params.get("ts", "created_at"), params.get("value", "value")
    if "window_seconds" in params:
        return moving_average_range(df, key, ts, value, int(params["window_seconds"]))
    return moving_average_rows(df, key, ts, params.get("tie", "id"), value, int(params.get("window_size", 10)))
