"""Named queries over the benchmark tables, with the SQL that states their expected result."""

from __future__ import annotations

from orderlens.plans.catalogue.registry import ORACLES, QUERIES

from orderlens.plans.catalogue import warehouse  # noqa: F401  isort: skip
from orderlens.plans.catalogue import relational  # noqa: F401  isort: skip
from orderlens.plans.catalogue import timeseries  # noqa: F401  isort: skip
from orderlens.plans.catalogue import learning  # noqa: F401  isort: skip
from orderlens.plans.catalogue import storage  # noqa: F401  isort: skip
from orderlens.plans.catalogue import triggered  # noqa: F401  isort: skip

__all__ = ["ORACLES", "QUERIES"]
