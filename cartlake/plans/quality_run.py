"""Quality run: checks, document, metrics and alert (D1-D4, S13, AL5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from cartlake.operators import alerts, quality
from cartlake.sinks.writers import write_quality


def run_checks(
    events: DataFrame, state: DataFrame, keys: list[str], updated: str, as_of: Column, time: str = "ts"
) -> DataFrame:
    """The three checks of a run, one row each."""
    return quality.as_checks(
        quality.hourly_gaps(events, as_of, time=time),
        quality.count_anomaly(events, as_of, time=time),
        quality.state_health(state, keys, updated, as_of),
    )


def run(events, state, keys, updated, as_of: Column, path: str, time: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Write the quality document; returns (status metrics, alert rows) computed from it."""
    checks = run_checks(events, state, keys, updated, as_of, time)
    write_quality(quality.quality_result(checks, as_of.cast("string")), path)
    return quality.status_metrics(checks, as_of), alerts.quality_alert(checks)
