"""All registered queries and oracles."""

from checks import (  # noqa: F401
    anomaly_checks,
    attribution_checks,
    control_checks,
    prompt_checks,
    report_checks,
    streaming_checks,
    tracking_checks,
    waste_checks,
)
from checks import exactness_checks  # noqa: F401, I001  it builds on the others
from checks.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
