"""AI spend reports, controls and pre-flight estimates as Spark DataFrame functions."""

from spendlens.operators import (
    anomaly,
    attribution,
    controls,
    prompts,
    report,
    tracking,
    waste,
)

__all__ = [
    "anomaly",
    "attribution",
    "controls",
    "prompts",
    "report",
    "tracking",
    "waste",
]
