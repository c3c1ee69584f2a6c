"""The library's reports, jobs and rules run on the driver's tables."""

from __future__ import annotations

import importlib

MODULES = ("sales_cases", "rental_cases", "job_cases", "rule_cases", "function_cases", "extra_cases")


def load_cases() -> tuple[dict, dict]:
    """All registered queries and their SQL twins."""
    from ledgerline.testbed import registry

    for module in MODULES:
        importlib.import_module(f"ledgerline.testbed.{module}")
    return registry.QUERIES, registry.ORACLE
