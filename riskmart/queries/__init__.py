"""Registered queries, one per operator, each with an equivalent plain SQL text where SQL can say it."""

from __future__ import annotations

import importlib

from riskmart.queries.registry import ORACLE, QUERIES

FAMILIES = ("load", "clean", "conform", "generate", "keys", "marts", "scores", "runlog", "validate", "repair", "ifrs9", "reports", "compose")

for _family in FAMILIES:
    importlib.import_module(f"riskmart.queries.{_family}")

__all__ = ["QUERIES", "ORACLE"]
