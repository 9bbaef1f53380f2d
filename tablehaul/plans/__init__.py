"""Registered catalogue queries, one module per area."""

from importlib import import_module

MODULES = [
    "warehouse", "ecommerce", "web", "relational", "scalars", "augmented", "conforming",
    "profiling", "validation", "rollups", "scans", "ledger", "benchmarks", "streams",
]


def load_all() -> None:
    for name in MODULES:
        import_module(f"tablehaul.plans.{name}")
