"""All registered queries."""

from __future__ import annotations

from orewright.plans import (  # noqa: F401  (importing registers)
    integrate, ledger, metrics, quality, reports, retail, sensors, storage, stored, streams,
    workforce,
)
from orewright.plans.registry import REGISTRY, Query

QUERIES: dict[str, Query] = REGISTRY
