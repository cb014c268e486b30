"""All registered queries by name."""

from __future__ import annotations

from suite import churn, models, preparation, relational, sources
from suite.tables import Check

CHECKS: dict[str, Check] = {}
for _module in (churn, sources, relational, preparation, models):
    CHECKS.update(_module.CHECKS)
