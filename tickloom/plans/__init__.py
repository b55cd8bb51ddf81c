"""Registered queries over the driver's tables, and their SQL oracles."""

from importlib import import_module

from tickloom.plans.registry import ORACLES, QUERIES

for _part in ("market", "ingest", "ledgers", "signals", "streams"):
    import_module(f"tickloom.plans.{_part}")

from tickloom.plans.market import flagship  # noqa: E402

__all__ = ["ORACLES", "QUERIES", "flagship"]
